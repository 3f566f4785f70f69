"""Registered queries of the document operators, on catalogue documents made from the driver's tables.

A document holds the customers of a nation, a thousand keys at a time: a series for each
market segment, a file for each customer, a link for each order.  What a query expects is
said in SQL on the tables themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartulary.operators import xmledit, xmltree
from cartulary.operators.materialise import written
from cartulary.plans import catalogue, rewrite
from cartulary.plans.queries import query, table

L = F.lit


def _text(*parts: Column | str) -> Column:
    return F.concat(*(L(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _listed(order: str, what: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, what))), lambda x: x[what]), "")


_ROLE = "CASE o_orderpriority WHEN '1-URGENT' THEN 'image' WHEN '2-HIGH' THEN 'mp3' WHEN '3-MEDIUM' THEN 'access:image' WHEN '4-NOT SPECIFIED' THEN 'preservation:image' ELSE 'pdf' END"
_EXT = "CASE o_orderpriority WHEN '1-URGENT' THEN '.jpg' WHEN '2-HIGH' THEN '.mp3' WHEN '3-MEDIUM' THEN '.jpg' WHEN '4-NOT SPECIFIED' THEN '.tif' ELSE '.pdf' END"
_DOC = "'N' || c_nationkey || '_' || CAST(floor(c_custkey / 1000) AS BIGINT)"


def documents(spark, sf) -> DataFrame:
    """(doc, content)."""
    href = F.expr(f"'d/h_' || (o_orderkey % 30) || {_EXT}")
    link = lambda tag: _text(f"<{tag} href='", href, "' role='", F.expr(_ROLE), f"'/>")
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.when(F.col("o_orderstatus") == "O", link("dao")).otherwise(link("daoloc")).alias("x"))
    group = lambda s: F.array_join(F.transform(F.filter("links", lambda v: v["o_orderstatus"] == s), lambda v: v["x"]), "")
    boxed = lambda s: F.when(group(s) != "", _text("<daogrp><daodesc><p>Pages</p></daodesc>", group(s), "</daogrp>")).otherwise("")
    per = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "x"))).alias("links"))
    k, seg, owner = F.col("c_custkey"), F.col("c_mktsegment"), _text("<name>Owner ", F.col("c_custkey") % 3, "</name>")
    some = lambda test, x: F.when(test, x).otherwise("")
    did = _text(
        "<did><unitid>", F.col("c_name"), "</unitid><unittitle>Papers &amp;amp; ", k, "</unittitle>", some(k % 2 == 0, _text("<origination>", owner, "</origination>")),
        some(k % 5 == 0, L("<repository>Branch</repository>")), "<physdesc note=''> </physdesc></did>",
    )
    subject = lambda t: _text("<subject source='th_", seg, "'>", t, "</subject>")
    terms = _text(
        "<controlaccess>", subject(_text(" ", seg, " ")), some(k % 3 == 0, subject(seg)), some(k % 2 == 1, owner), "<geogname source=''>N", F.col("c_nationkey"),
        "</geogname><genreform>list</genreform></controlaccess>",
    )
    file = _text("<c level='file'", some(k % 4 == 0, _text(" id='K", k, "'")), ">", did, terms, F.coalesce(boxed("P"), L("")), F.coalesce(boxed("F"), L("")), F.coalesce(group("O"), L("")), "</c>")
    files = table(spark, sf, "customer").join(per, k == F.col("o_custkey"), "left").select(F.expr(_DOC).alias("doc"), seg.alias("seg"), k.alias("k"), file.alias("x"))
    series = files.groupBy("doc", "seg").agg(_listed("k", "x").alias("inside"))
    head = _text("<c level='series' id='S", F.col("seg"), "'><did><unitid>", F.col("doc"), "/", F.col("seg"), "</unitid><unittitle>", F.col("seg"), "</unittitle></did>", F.col("inside"), "</c>")
    whole = series.withColumn("x", head).groupBy("doc").agg(_listed("seg", "x").alias("dsc"))
    text = _text(
        "<?xml version='1.0' encoding='UTF-8'?>\n<ead><eadheader><eadid>old</eadid><filedesc><titlestmt><titleproper>Title ", F.col("doc"), "</titleproper></titlestmt></filedesc></eadheader>",
        "<archdesc level='fonds' id='A'><did><unitid>", F.col("doc"), "</unitid><unittitle>Fonds</unittitle><repository>Old</repository></did><dsc>", F.col("dsc"), "</dsc></archdesc></ead>",
    )
    return whole.select(F.concat("doc", L(".xml")).alias("doc"), F.encode(text, "UTF-8").alias("content"))


_C = f"c AS (SELECT {_DOC} || '.xml' AS doc, {_DOC} AS fonds, c_custkey AS k, c_name AS name, c_mktsegment AS seg, c_nationkey AS nation FROM customer)"
_E = f"e AS (SELECT c.*, o_orderkey AS o, o_orderstatus AS status, 'd/h_' || (o_orderkey % 30) || {_EXT} AS href, {_ROLE} AS role FROM c JOIN orders ON o_custkey = k)"


def _nodes(spark, sf) -> DataFrame:
    return xmltree.nodes(documents(spark, sf))


# ---- extraction ----


@query(f"WITH {_C} SELECT doc, name AS unitid, 'c' AS tag, 2 AS comp_depth, true AS leaf FROM c UNION ALL SELECT DISTINCT doc, fonds || '/' || seg, 'c', 1, false FROM c UNION ALL SELECT DISTINCT doc, fonds, 'archdesc', 0, false FROM c")
def q_doc_components(spark, sf):
    return xmltree.components(_nodes(spark, sf)).select("doc", "unitid", "tag", "comp_depth", "leaf")


@query(f"WITH {_C}, {_E} SELECT doc, name AS unitid, CASE status WHEN 'O' THEN 'dao' ELSE 'daoloc' END AS kind, href, role, count(*) AS n FROM e GROUP BY ALL")
def q_doc_links(spark, sf):
    n = _nodes(spark, sf)
    return xmltree.links(n).join(xmltree.components(n).select("doc", "comp_id", "unitid"), ["doc", "comp_id"]).groupBy("doc", "unitid", "kind", "href", "role").agg(F.count("*").alias("n"))


@query(
    f"WITH {_C}, t AS (SELECT doc, 'subject' AS tag, seg AS text, 'th_' || seg AS source FROM c UNION ALL SELECT doc, 'subject', seg, 'th_' || seg FROM c WHERE k % 3 = 0 UNION ALL SELECT doc, 'name', 'Owner ' || (k % 3), NULL FROM c WHERE k % 2 = 1 "
    "UNION ALL SELECT doc, 'geogname', 'N' || nation, '' FROM c UNION ALL SELECT doc, 'genreform', 'list', NULL FROM c) SELECT doc, tag, text, source, count(*) AS n FROM t GROUP BY ALL"
)
def q_doc_terms(spark, sf):
    return xmltree.terms(_nodes(spark, sf)).groupBy("doc", "tag", "text", "source").agg(F.count("*").alias("n"))


@query(f"WITH {_C} SELECT DISTINCT doc, 'old' AS eadid, 'Title ' || fonds AS titleproper, fonds AS unitid, 'Old' AS repository FROM c")
def q_doc_heads(spark, sf):
    return xmltree.finding_aids(_nodes(spark, sf))


@query(
    f"WITH {_C}, {_E}, r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY CASE status WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END, o) AS i FROM e WHERE role IN ('image', 'access:image')) "
    "SELECT c.doc, c.name AS unitid, r.href, CASE WHEN r.k IS NULL THEN 'sans' ELSE 'avec' END AS dao FROM c LEFT JOIN r ON r.k = c.k AND i = 1"
)
def q_doc_leaves(spark, sf):
    return xmltree.leaf_statistics(_nodes(spark, sf), ["image", "access:image"]).select("doc", "unitid", "href", "dao")


@query(f"WITH {_C} SELECT 'K' || k AS id FROM c WHERE k % 4 = 0 UNION SELECT 'S' || seg FROM c")
def q_doc_ids(spark, sf):
    return xmltree.component_ids(_nodes(spark, sf))


@query(f"WITH {_C}, {_E} SELECT array_to_string((SELECT list(DISTINCT role ORDER BY role) FROM e), '|') AS roles, array_to_string((SELECT list(DISTINCT 'th_' || seg ORDER BY 'th_' || seg) FROM c), '|') AS sources")
def q_doc_known(spark, sf):
    return xmltree.known(_nodes(spark, sf)).select(F.array_join("roles", "|").alias("roles"), F.array_join("sources", "|").alias("sources"))


@query(
    f"WITH {_C} SELECT doc, name AS unitid, fonds || '/' || seg AS above, name || ' — Papers &amp; ' || k AS label FROM c UNION ALL SELECT DISTINCT doc, fonds || '/' || seg, fonds, fonds || '/' || seg || ' — ' || seg FROM c "
    "UNION ALL SELECT DISTINCT doc, fonds, NULL, fonds || ' — Fonds' FROM c"
)
def q_doc_navigator(spark, sf):
    nav = xmltree.navigator(_nodes(spark, sf))
    above = nav.select("doc", F.col("comp_id").alias("parent_comp"), F.col("unitid").alias("above"))
    return nav.join(above, ["doc", "parent_comp"], "left").select("doc", "unitid", "above", "label")


@query(
    f"WITH {_C}, {_E}, g AS (SELECT *, o % 30 AS stem, CASE status WHEN 'O' THEN 'o' || o ELSE status END AS box FROM e) SELECT doc AS ir, name AS unitid, role, href, count(*) AS n FROM g WHERE role = 'access:image' "
    "AND NOT EXISTS (SELECT 1 FROM g p WHERE p.k = g.k AND p.box = g.box AND p.role = 'preservation:image' AND p.stem = g.stem) GROUP BY ALL"
)
def q_doc_orphans(spark, sf):
    return xmltree.orphan_links(_nodes(spark, sf), "x_", "y_").groupBy("ir", "unitid", "role", "href").agg(F.count("*").alias("n"))


@query(f"WITH {_C} SELECT DISTINCT 'th_' || seg AS source, seg AS concept, lower(seg) AS slug FROM c")
def q_doc_concepts(spark, sf):
    return xmltree.concepts(xmltree.terms(_nodes(spark, sf)), "th_")


@query(
    f"WITH {_C}, s AS (SELECT DISTINCT 'http://t.example/th_' || seg AS scheme, seg FROM c) SELECT scheme || '#' || lower(seg) AS s, p, CASE p WHEN 'type' THEN 'Concept' WHEN 'prefLabel' THEN seg ELSE scheme END AS o, "
    "CASE p WHEN 'prefLabel' THEN 'fr' END AS lang FROM s, (VALUES ('type'), ('prefLabel'), ('inScheme')) v(p)"
)
def q_doc_triples(spark, sf):
    t = xmltree.triples(xmltree.concepts(xmltree.terms(_nodes(spark, sf)), "th_"), "http://t.example/")
    return t.select("s", F.regexp_extract("p", "([A-Za-z]+)$", 1).alias("p"), F.when(F.col("p").endswith("type"), F.regexp_extract("o", "([A-Za-z]+)$", 1)).otherwise(F.col("o")).alias("o"), "lang")


# ---- ranges ----


def _range_documents(spark, sf) -> DataFrame:
    """A document for each thousand of orders; of each order a group with the bounds of its lines."""
    b = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_linenumber").alias("x"), F.max("l_linenumber").alias("y"))
    loc = lambda head, n, ext, role: _text(f"<daoloc href='{head}", n, f"{ext}' role='{role}'/>")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    k, x, y = F.col("k"), F.col("x"), F.col("y")
    access = F.when(k % 5 == 0, F.concat(loc("A_1_", x, ".jpg", "access:image:first"), loc("A_2_", y + 1, ".jpg", "access:image:last"))).otherwise(F.concat(loc("P_", two(x), ".jpg", "access:image:first"), loc("P_", two(y), ".jpg", "access:image:last")))
    kept = F.when(k % 2 == 0, F.concat(loc("M_", two(x), ".tif", "preservation:image:first"), loc("M_", two(y), ".tif", "preservation:image:last"))).otherwise("")
    c = _text("<c id='c", k, "'><did><unitid>u", k, "</unitid></did><daogrp>", access, kept, "</daogrp></c>")
    docs = b.select(_text("R", F.floor(k / 1000), ".xml").alias("doc"), "k", c.alias("x")).groupBy("doc").agg(_listed("k", "x").alias("dsc"))
    return docs.select("doc", F.encode(_text("<ead><archdesc><dsc>", F.col("dsc"), "</dsc></archdesc></ead>"), "UTF-8").alias("content"))


_R = "b AS (SELECT l_orderkey AS k, min(l_linenumber) AS x, max(l_linenumber) AS y FROM lineitem GROUP BY 1)"
_M = (
    _R + ", w AS (SELECT 'R' || CAST(floor(k / 1000) AS BIGINT) || '.xml' AS ir, 'c' || k AS id_composant, 'u' || k AS unitid, k, x, y, CASE WHEN k % 2 = 0 THEN 'preservation:image' ELSE 'access:image' END AS prefix, CASE WHEN k % 2 = 0 THEN 'M_' ELSE 'P_' END AS head, CASE WHEN k % 2 = 0 THEN '.tif' ELSE '.jpg' END AS ext FROM b), "
    "m AS (SELECT *, unnest(range(x, y + 1)) AS i FROM w WHERE x <> y AND (k % 2 = 0 OR k % 5 <> 0))"
)


@query(f"WITH {_M} SELECT ir, id_composant, unitid, prefix || ':plage' AS role, head || lpad(CAST(i AS VARCHAR), 2, '0') || ext AS href, CASE i WHEN x THEN 'first' WHEN y THEN 'last' ELSE 'intermediaire' END AS position, CAST(y - x + 1 AS INTEGER) AS taille_plage FROM m")
def q_doc_bounds(spark, sf):
    clear, _ = catalogue.expand_bounds(xmltree.nodes(_range_documents(spark, sf)))
    return clear.select("ir", "id_composant", "unitid", "role", "href", "position", "taille_plage")


@query(
    f"WITH {_M}, v AS (SELECT *, k % 2 = 1 AND k % 5 = 0 AS two FROM w WHERE (k % 2 = 1 AND k % 5 = 0) OR x = y) SELECT ir, unitid, prefix || ':plage:ambigu' AS role, position, "
    "CASE WHEN two THEN CASE position WHEN 'first' THEN 'A_1_' || x ELSE 'A_2_' || (y + 1) END || '.jpg' ELSE head || lpad(CAST(x AS VARCHAR), 2, '0') || ext END AS href FROM v, (VALUES ('first'), ('last')) p(position)"
)
def q_doc_vague_bounds(spark, sf):
    _, vague = catalogue.expand_bounds(xmltree.nodes(_range_documents(spark, sf)))
    return vague.select("ir", "unitid", "role", "position", "href")


def _line_files(spark, sf) -> DataFrame:
    n = F.lpad(F.col("l_linenumber").cast("string"), 2, "0")
    lines = table(spark, sf, "lineitem").where("l_returnflag = 'R' and l_linenumber <> 4").select("l_linenumber", n.alias("n")).distinct()
    return lines.select(_text("M_", F.col("n"), ".tif").alias("name"), _text("u", F.col("n")).alias("uuid"), F.when(F.col("l_linenumber") % 2 == 0, _text("k/M_", F.col("n"), ".tif")).alias("s3_key"))


_H = "h AS (SELECT DISTINCT l_linenumber AS i FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber <> 4)"


@query(f"WITH {_M}, {_H} SELECT ir, id_composant, head || lpad(CAST(m.i AS VARCHAR), 2, '0') || ext AS href, h.i IS NOT NULL AND head = 'M_' AS dans_ref, coalesce(h.i % 2 = 0, false) AND head = 'M_' AS sur_s3 FROM m LEFT JOIN h USING (i)")
def q_doc_checked_ranges(spark, sf):
    clear, _ = catalogue.expand_bounds(xmltree.nodes(_range_documents(spark, sf)))
    return catalogue.check_ranges(clear, _line_files(spark, sf)).select("ir", "id_composant", "href", "dans_ref", "sur_s3")


@query(
    f"WITH {_M}, {_H} SELECT ir, id_composant, prefix || ':plage' AS role, min(CASE WHEN m.i = x THEN head || lpad(CAST(m.i AS VARCHAR), 2, '0') || ext END) AS href_first, max(CASE WHEN m.i = y THEN head || lpad(CAST(m.i AS VARCHAR), 2, '0') || ext END) AS href_last, "
    "count(*) AS total, count(h.i) AS presents, CAST(round_even(CAST(100 * count(h.i) AS DECIMAL(20,6)) / count(*), 1) AS DOUBLE) AS taux, count(*) - count(h.i) AS manquants FROM m LEFT JOIN h USING (i) WHERE prefix = 'preservation:image' GROUP BY ir, id_composant, prefix"
)
def q_doc_range_gaps(spark, sf):
    clear, _ = catalogue.expand_bounds(xmltree.nodes(_range_documents(spark, sf)))
    return catalogue.range_gaps(catalogue.check_ranges(clear, _line_files(spark, sf)))


# ---- counted edits ----


def _counted(spark, sf, operation, **parameters) -> DataFrame:
    return xmledit.batch(documents(spark, sf), operation, parameters).select("doc", "n_changes", "error")


def _expects(source: str, test: str) -> str:
    return f"WITH {_C}, {_E}, x AS ({source}) SELECT d.doc, coalesce(n, 0) AS n_changes, CAST(NULL AS VARCHAR) AS error FROM (SELECT DISTINCT doc FROM c) d LEFT JOIN (SELECT doc, count(*) AS n FROM x WHERE {test} GROUP BY 1) USING (doc)"


@query(_expects("SELECT * FROM e", "contains(href, 'h_1')"))
def q_edit_href(spark, sf):
    return _counted(spark, sf, "replace_in_href", find="h_1", new="g_1")


@query(_expects("SELECT * FROM e", "role = 'mp3' AND href LIKE '%0.mp3'"))
def q_edit_href_regex(spark, sf):
    return _counted(spark, sf, "replace_in_href", find=r"0\.mp3$", new="0.ogg", regex=True, role="mp3")


@query(_expects("SELECT * FROM e", "role = 'access:image'"))
def q_edit_role(spark, sf):
    return _counted(spark, sf, "rename_role", old="access:image", new="access:picture")


@query(_expects("SELECT * FROM e", "role = 'pdf'"))
def q_edit_audience(spark, sf):
    return _counted(spark, sf, "set_audience", audience="internal", role="pdf")


@query(_expects("SELECT doc, k FROM c WHERE seg = 'BUILDING' UNION ALL SELECT doc, k FROM c WHERE seg = 'BUILDING' AND k % 3 = 0", "true"))
def q_edit_term_text(spark, sf):
    return _counted(spark, sf, "replace_term_text", old="BUILDING", new="BUILDING")


@query(_expects("SELECT * FROM c", "k % 3 = 0"))
def q_edit_term_text_anywhere(spark, sf):
    """Names stand in originations and among terms; both count."""
    return _counted(spark, sf, "replace_term_text", old="Owner 0", new="Owner", tag="name")


@query(_expects("SELECT doc, k, seg FROM c UNION ALL SELECT doc, k, seg FROM c WHERE k % 3 = 0 UNION ALL SELECT doc, k, 'MACHINERY' FROM c", "seg = 'MACHINERY'"))
def q_edit_source(spark, sf):
    docs = documents(spark, sf).withColumn("content", F.encode(F.replace(F.decode("content", "UTF-8"), L("source=''"), L("source='none'")), "UTF-8"))
    return xmledit.batch(docs, "normalize_source", {"mapping": {"th_MACHINERY": "m.xml", "none": "places.xml", "th_BUILDING": "th_BUILDING"}}).select("doc", "n_changes", "error")


@query(_expects("SELECT * FROM c", "k % 3 = 0"))
def q_edit_dedupe(spark, sf):
    return _counted(spark, sf, "dedupe_terms")


def _single_edits(root) -> int:
    """Of every file: a link, changed; a term, changed; one more of each, removed."""
    n = 0
    for c in [e for e in root.iter("c") if e.get("level") == "file"]:
        link = xmledit.add_dao(c, "new.jpg", "access:image")
        n += xmledit.set_dao_attr(link, "new.jpg", "access:image", "internal") + xmledit.set_dao_attr(link, "new.jpg", "access:image", "internal")
        n += xmledit.remove_dao(xmledit.add_dao(c, "gone.jpg", "access:image", into_group=True))
        access = xmledit.controlaccess(c)
        term = xmledit.add_term(access, "subject", "Boats", "t")
        n += xmledit.edit_term(term, "geogname", "Harbour", "g") + xmledit.edit_term(term, "geogname", "Harbour", "g")
        n += xmledit.remove_term(xmledit.add_term(access, "subject", "Gone"))
    return n


@query(f"WITH {_C}, {_E}, l AS (SELECT k, count(*) AS n FROM e GROUP BY 1) SELECT c.doc, name AS unitid, 1 AS places, coalesce(n, 0) + 1 AS links, 1 AS internal FROM c LEFT JOIN l USING (k)")
def q_edit_single(spark, sf):
    n = xmltree.nodes(xmledit.batch(documents(spark, sf), _single_edits, {}, write=True).select("doc", "content"))
    comps = xmltree.components(n).where("leaf").select("doc", "comp_id", "unitid")
    l = xmltree.links(n).groupBy("doc", "comp_id").agg(F.count("*").alias("links"), F.count_if(F.col("audience") == "internal").alias("internal"))
    t = xmltree.terms(n).where("tag = 'geogname' and text = 'Harbour' and source = 'g'").groupBy("doc", "comp_id").agg(F.count("*").alias("places"))
    return comps.join(l, ["doc", "comp_id"]).join(t, ["doc", "comp_id"]).select("doc", "unitid", "places", "links", "internal")


# ---- the rewrite ----

_FILES = (
    "SELECT 'h_' || n_nationkey || '.tif' AS name, 'M/h_' || n_nationkey || '.tif' AS s3_key, 'tiff' AS file_type FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT 'h_' || n_nationkey || '.xml', 'O/h_' || n_nationkey || '.xml', 'ocr xml' FROM nation WHERE n_nationkey % 3 = 0 "
    "UNION ALL SELECT 'h_' || n_nationkey || '_TI.wav', 'W/h_' || n_nationkey || '_TI.wav', 'audio' FROM nation WHERE n_nationkey % 4 = 0 UNION ALL SELECT 'h_' || n_nationkey || '_96kHz24B.wav', 'W/h_' || n_nationkey || '_96kHz24B.wav', 'audio' FROM nation WHERE n_nationkey % 4 = 0 "
    "UNION ALL SELECT 'h_' || n_nationkey || '_TI.mp3', 'W/h_' || n_nationkey || '_TI.mp3', 'audio' FROM nation WHERE n_nationkey % 8 = 0"
)


def _sources(spark, sf) -> rewrite.Sources:
    nation, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    k = F.col("n_nationkey")
    kinds = [(2, ".tif", "M", "tiff"), (3, ".xml", "O", "ocr xml"), (4, "_TI.wav", "W", "audio"), (4, "_96kHz24B.wav", "W", "audio"), (8, "_TI.mp3", "W", "audio")]
    files = None
    for step, end, folder, kind in kinds:
        some = nation.where(k % step == 0).select(_text("h_", k, end).alias("name"), _text(folder, "/h_", k, end).alias("s3_key"), L(kind).alias("file_type"))
        files = some if files is None else files.unionByName(some)
    fonds = c.select(F.expr(_DOC).alias("fonds")).distinct()
    heads = fonds.select(F.concat("fonds", L(".xml")).alias("doc"), F.concat(L("E_"), "fonds").alias("eadid"), F.concat(L("U_"), "fonds").alias("unitid"), L("Reading room").alias("repository"))
    key = F.col("c_custkey")
    stored = c.where(key % 4 != 0).select(F.concat(L("E_"), F.expr(_DOC)).alias("ir"), F.col("c_name").alias("unitid"), _text("Q", key).alias("id"), key.alias("n"))
    records = c.where(key % 6 == 0).select(F.col("c_name").alias("unitid"), _text("old", key).alias("osiros_id"), key.alias("n"))
    names = spark.createDataFrame([("Owner 0", "persname"), ("Owner 0", "corpname"), ("Owner 1", "corpname"), (None, "persname")], rewrite.SHAPES["names"])
    return rewrite.Sources(heads, stored, records, names, files)


RULES = rewrite.Rules("http://l.example/", "m0", 1_700_000_000, {"genreform": "g.xml"}, {("subject", "th_BUILDING"): "b.xml"})


def _rewritten(spark, sf) -> DataFrame:
    return rewrite.rewrite_all(documents(spark, sf), _sources(spark, sf), RULES)[0]


def _rewritten_nodes(spark, sf) -> DataFrame:
    return written(xmltree.nodes(_rewritten(spark, sf).where("error is null").select("doc", "content"), above=True), "rewritten-nodes")


@query(f"WITH {_C} SELECT DISTINCT doc, 'E_' || fonds AS eadid, 'Title ' || fonds AS titleproper, 'U_' || fonds AS unitid, 'Reading room' AS repository FROM c")
def q_rewrite_heads(spark, sf):
    return xmltree.finding_aids(_rewritten_nodes(spark, sf))


@query(f"WITH {_C} SELECT doc, name AS unitid, 'Papers & ' || k AS unittitle, CASE WHEN k % 4 = 0 THEN 'K' ELSE 'Q' END || k AS id FROM c")
def q_rewrite_ids(spark, sf):
    return xmltree.components(_rewritten_nodes(spark, sf)).where("leaf").select("doc", "unitid", "unittitle", "id")


@query(
    f"WITH {_C}, t AS (SELECT doc, 'subject' AS tag, seg AS text, CASE seg WHEN 'BUILDING' THEN 'b.xml' ELSE 'th_' || seg END AS source FROM c UNION ALL SELECT doc, 'subject', seg, CASE seg WHEN 'BUILDING' THEN 'b.xml' ELSE 'th_' || seg END FROM c WHERE k % 3 = 0 "
    "UNION ALL SELECT doc, CASE k % 6 WHEN 0 THEN 'persname' WHEN 3 THEN 'corpname' WHEN 1 THEN 'corpname' WHEN 4 THEN 'corpname' ELSE 'name' END, 'Owner ' || (k % 3), NULL FROM c "
    "UNION ALL SELECT doc, 'geogname', 'N' || nation, NULL FROM c UNION ALL SELECT doc, 'genreform', 'list', 'g.xml' FROM c) SELECT doc, tag, text, source, count(*) AS n FROM t GROUP BY ALL"
)
def q_rewrite_terms(spark, sf):
    return xmltree.terms(_rewritten_nodes(spark, sf)).groupBy("doc", "tag", "text", "source").agg(F.count("*").alias("n"))


@query(f"WITH {_C} SELECT doc, 1 AS repositories, 0 AS originations, 0 AS notes, count(*) AS files FROM c GROUP BY 1")
def q_rewrite_removed(spark, sf):
    tag = lambda t: F.count_if(F.col("tag") == t)
    return _rewritten_nodes(spark, sf).groupBy("doc").agg(
        tag("repository").alias("repositories"), tag("origination").alias("originations"), tag("physdesc").alias("notes"), F.count_if((F.col("tag") == "c") & F.try_element_at("attrs", L("level")).eqNullSafe("file")).alias("files")
    )


_LINKS = f"""WITH {_C}, {_E}, f AS ({_FILES}),
v AS (SELECT regexp_replace(regexp_extract(name, '^(.*)[.]', 1), '_(TI|96kHz24B)$', '') AS stem, CASE WHEN name LIKE '%.tif' THEN 'image' ELSE 'audio' END AS family, CASE WHEN name LIKE '%96kHz24B%' THEN 0 WHEN name LIKE '%TI%' THEN 2 ELSE 3 END AS rank, s3_key FROM f WHERE name LIKE '%.tif' OR name LIKE '%.wav'),
a0 AS (SELECT k, name, CASE status WHEN 'P' THEN 1 WHEN 'F' THEN 2 ELSE 1000 + o END AS box, status <> 'O' AS grouped, [o] AS seq, href, role FROM e),
a1 AS (SELECT *, min(CASE WHEN grouped THEN box END) OVER (PARTITION BY k) AS lead, row_number() OVER (PARTITION BY k, grouped, href, role ORDER BY box, seq) > 1 AS earlier FROM a0),
a2 AS (SELECT k, name, CASE WHEN grouped THEN lead ELSE box END AS box, grouped, [CASE WHEN grouped AND box <> lead THEN 1 ELSE 0 END, box] || seq AS seq, href, role FROM a1 WHERE NOT (grouped AND box <> lead AND earlier)),
b0 AS (SELECT c.k, min(CASE WHEN grouped THEN box END) AS lead, min(CASE WHEN NOT grouped THEN box END) AS lone FROM c LEFT JOIN a2 ON a2.k = c.k GROUP BY 1),
p AS (SELECT k, 1 AS i, 'http://l.example/' || CASE WHEN k % 4 = 0 THEN 'K' ELSE 'Q' END || k AS href, 'publication:current' AS role FROM c UNION ALL SELECT k, 2, 'http://l.example/old' || k, 'publication:previous' FROM c WHERE k % 6 = 0),
a3 AS (SELECT a2.k, CASE WHEN b0.lead IS NULL AND box = lone THEN 999999999 ELSE box END AS box, grouped OR (b0.lead IS NULL AND box = lone) AS grouped, seq, href, role FROM a2 JOIN b0 USING (k)
 UNION ALL SELECT p.k, coalesce(b0.lead, 999999999), b0.lead IS NOT NULL OR lone IS NOT NULL OR p.k % 6 = 0, [2, i], p.href, p.role FROM p JOIN b0 USING (k)),
a4 AS (SELECT k, box, grouped, seq, href, CASE WHEN role = 'image' THEN 'access:image' WHEN role = 'mp3' THEN 'access:audio' WHEN role = 'pdf' THEN 'access:pdf' ELSE role END AS role, regexp_extract(href, '([^/]*)[.][a-z0-9]*$', 1) AS stem,
 CASE WHEN href LIKE '%.jpg' OR href LIKE '%.tif' THEN 'image' WHEN href LIKE '%.mp3' THEN 'audio' WHEN href LIKE '%.pdf' THEN 'pdf' END AS family, row_number() OVER () AS id FROM a3),
m AS (SELECT id, list(v.s3_key ORDER BY v.rank) AS keys FROM a4 JOIN v USING (stem, family) GROUP BY 1),
a5 AS (SELECT a4.*, keys, o.s3_key AS ocr, s.s3_key AS spoken FROM a4 LEFT JOIN m USING (id) LEFT JOIN f o ON o.name = stem || '.xml' AND family IN ('image', 'pdf') LEFT JOIN f s ON s.name = stem || '_TI.mp3' AND family = 'audio' AND keys IS NOT NULL),
a6 AS (SELECT k, box, grouped OR keys IS NOT NULL OR ocr IS NOT NULL AS grouped, seq, CASE WHEN spoken IS NOT NULL THEN spoken WHEN keys IS NOT NULL THEN keys[1][1:2] || regexp_extract(href, '([^/]*)$', 1) ELSE href END AS href, role FROM a5
 UNION ALL SELECT k, box, true, [3] || seq || [i], keys[i], replace(role, 'access:', 'preservation:') FROM (SELECT *, unnest(range(1, len(keys) + 1)) AS i FROM a5 WHERE keys IS NOT NULL)
 UNION ALL SELECT k, box, true, [3] || seq || [9], ocr, 'access:ocr' FROM a5 WHERE ocr IS NOT NULL),
a7 AS (SELECT *, min(CASE WHEN grouped THEN box END) OVER (PARTITION BY k) AS lead, row_number() OVER (PARTITION BY k, grouped, href, role ORDER BY box, seq) > 1 AS earlier FROM a6),
a8 AS (SELECT k, grouped, href, role, CASE WHEN grouped THEN row_number() OVER (PARTITION BY k, grouped ORDER BY CASE WHEN role LIKE 'preservation%' THEN 1 WHEN role LIKE 'access%' THEN 2 WHEN role LIKE 'publication%' THEN 3 ELSE 4 END, box <> lead, box, seq) ELSE 1 END AS place FROM a7 WHERE NOT (grouped AND box <> lead AND earlier))
"""


@query(_LINKS + "SELECT c.doc, c.name AS unitid, CASE WHEN grouped THEN 'daoloc' ELSE 'dao' END AS kind, href, role, place, count(*) AS n FROM a8 JOIN c USING (k) GROUP BY ALL")
def q_rewrite_links(spark, sf):
    n = _rewritten_nodes(spark, sf)
    groups = n.where("tag in ('daoloc', 'daodesc')").select("doc", "parent_id", "node_id", "tag")
    first = groups.groupBy("doc", "parent_id").agg(F.count_if(F.col("tag") == "daodesc").alias("before"))
    spot = n.where("tag = 'daoloc'").join(first, ["doc", "parent_id"]).select("doc", "node_id", (F.col("ord") + 1 - F.col("before")).alias("place"))
    links = xmltree.links(n).join(spot, ["doc", "node_id"], "left").join(xmltree.components(n).where("leaf").select("doc", "comp_id", "unitid"), ["doc", "comp_id"])
    return links.groupBy("doc", "unitid", "kind", "href", "role", F.coalesce("place", L(1)).cast("long").alias("place")).agg(F.count("*").alias("n"))


@query(f"WITH {_C} SELECT DISTINCT doc, CAST(NULL AS VARCHAR) AS error, true AS whole FROM c UNION ALL SELECT 'broken.xml', 'ValueError', false")
def q_rewrite_documents(spark, sf):
    """Every document, and one that isn't well-formed, which keeps its error."""
    broken = spark.createDataFrame([("broken.xml", bytearray(b"<ead><c></ead>"))], "doc string, content binary")
    out, _ = rewrite.rewrite_all(documents(spark, sf).unionByName(broken), _sources(spark, sf), RULES)
    return out.select("doc", F.split_part("error", L(":"), L(1)).alias("error"), F.col("content").isNotNull().alias("whole"))


@query("SELECT 'f' || p_partkey AS jhove_uri, 'TIFF' AS jhove_format, CAST(p_size AS VARCHAR) AS \"jhove_imageWidth\", p_size * 10.0 / 2 AS jhove_x_resolution FROM part")
def q_technical_metadata(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    x = _text("<repInfo uri='f", k, "'><format>JPEG</format><format>TIFF</format><m><imageWidth>", size, "</imageWidth><xSamplingFrequency><numerator>", size * 10, "</numerator><denominator>2</denominator></xSamplingFrequency></m></repInfo>")
    docs = table(spark, sf, "part").select(F.floor(k / 500).cast("string").alias("doc"), k.alias("k"), x.alias("x")).groupBy("doc").agg(_listed("k", "x").alias("x"))
    n = xmltree.nodes(docs.select("doc", F.encode(_text("<jhove>", F.col("x"), "</jhove>"), "UTF-8").alias("content")))
    return xmltree.technical(n).select("jhove_uri", "jhove_format", "jhove_imageWidth", "jhove_x_resolution")


@query(
    "WITH o AS (SELECT 'R' || left(o_orderpriority, 1) AS code, CAST(o_custkey AS BIGINT) || ' D ' || (o_orderkey % 3) AS mark FROM orders) SELECT DISTINCT code || '.xml' AS doc, mark AS unitid, 'file' AS level FROM o"
)
def q_generated_registers(spark, sf):
    o = table(spark, sf, "orders")
    files = o.select(
        _text("R", F.left("o_orderpriority", L(1))).alias("corpus_code"), _text(F.col("o_custkey"), "_D_", F.col("o_orderkey") % 3).alias("unitid"), _text("r_", F.col("o_orderkey"), ".tif").alias("name"),
        L("/r (1900-1905)").alias("path"), L(None).cast("string").alias("s3_key"),
    )
    made = catalogue.register_parts(files, F.concat(L("m0"), F.md5(F.col("key"))))
    doc = F.concat("corpus_code", L(".xml")).alias("doc")
    around = catalogue.whole_document(F.col("corpus_code"), F.col("corpus_code"), L(""), F.concat(L("m0"), F.col("corpus_code")), "Library")
    frames = made.select("corpus_code").distinct().select(doc, F.encode(around, "UTF-8").alias("content"))
    n = written(xmltree.nodes_in_parts(frames, made.select(doc, "part", F.encode("dsc", "UTF-8").alias("content")), "dsc"), "register-nodes")
    return xmltree.components(n).where("tag = 'c'").select("doc", "unitid", "level")
