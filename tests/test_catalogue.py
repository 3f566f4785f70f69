"""Documents, their edits, extraction, generation and rewrite, on a small harbour archive."""

from __future__ import annotations

import datetime
import random
import xml.etree.ElementTree as ET
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cartulary.operators import xmledit as X, xmltree
from cartulary.operators.materialise import written
from cartulary.operators.xmldoc import Document, Element
from cartulary.plans import catalogue, document_queries as D, queries as Q, rewrite as W

HARBOUR = """<?xml version="1.0" encoding="utf-8"?>
<?view plain?>
<ead>
\t<eadheader><eadid>H-0</eadid><filedesc><titlestmt><titleproper>Harbour &lt;office&gt;</titleproper></titlestmt></filedesc></eadheader>
\t<archdesc level='fonds' id="top">
\t\t<did><unitid> H </unitid><unittitle>Harbour</unittitle><repository>Cellar</repository><origination><persname role="p">Ida Berg</persname> and <name>Pilots</name></origination></did>
\t\t<dsc>
\t\t\t<c level="series"><did><unitid>H/1</unitid><unittitle>Log books</unittitle></did>
\t\t\t\t<controlaccess><!-- kept --><subject>Tide</subject><subject source=""> Tide </subject><subject source="s">Tide</subject><name>Pilots</name><name>Nobody</name></controlaccess>
\t\t\t\t<c id="k7"><did><unitid>H/1/7</unitid><repository>Attic</repository></did>
\t\t\t\t\t<daogrp><daodesc><p>Scans</p></daodesc><daoloc href="b/log_7.jpg" role="image"/><daoloc href="b/log_8.jpg" role="image"/></daogrp>
\t\t\t\t\t<daogrp><daodesc><p>Scans </p></daodesc><daoloc href="b/log_7.jpg" role="image"/><daoloc href="b/log_9.jpg" role="image" audience="internal"/></daogrp>
\t\t\t\t</c>
\t\t\t\t<c><did><unitid>H/1/8</unitid></did><dao href="song_1.mp3" role="mp3"/><dao href="film.mov" role="access:video"/></c>
\t\t\t\t<c><did><unittitle>Unnumbered</unittitle></did></c>
\t\t\t</c>
\t\t</dsc>
\t</archdesc>
</ead>
<!-- end -->
""".encode()


@pytest.fixture
def harbour():
    return Document.load(HARBOUR)


def table(spark, *contents):
    return spark.createDataFrame([(f"{n}.xml", None if c is None else bytearray(c)) for n, c in contents], "doc string, content binary")


def unit(document, mark):
    return document.component(mark)


def links(e):
    return [(x.tag, x.get("href"), x.get("role")) for x in Document.dao_entries(e)]


# ---- what is read is written ----


@pytest.mark.parametrize("text", [HARBOUR, b"\xef\xbb\xbf<a x='1'>&#233;<b/><![CDATA[<]]></a>", "<?xml version='1.0' encoding='iso-8859-1'?><é>ü</é>".encode("latin-1").replace(b"\xe9", b"e"), b"<!DOCTYPE a [<!ENTITY x 'y'>]><a >\r\n</a >"])
def test_unedited_documents_keep_every_byte(text):
    assert Document.load(text).to_bytes() == text


@pytest.mark.parametrize("text", [b"", b"words", b"<a>", b"</a>", b"<a></b>", b"<a/><a/>"])
def test_what_is_not_well_formed_is_refused(text):
    with pytest.raises(ValueError):
        Document.load(text)


def test_views(harbour):
    assert [(e.tag, e.get("id"), depth) for e, depth in harbour.components()] == [("archdesc", "top", 1), ("c", None, 3), ("c", "k7", 4), ("c", None, 4), ("c", None, 4)]
    assert unit(harbour, "H/1/9") is None and unit(harbour, "H").tag == "archdesc"
    assert len(links(unit(harbour, "H/1/7"))) == 4 and links(unit(harbour, "H/1")) == []
    assert [t.tag for t in harbour.term_entries(unit(harbour, "H/1"))] == ["subject"] * 3 + ["name"] * 2
    assert harbour.known_roles() == ["access:video", "image", "mp3"] and harbour.known_sources() == ["s"]


def test_sources_are_known_outside_of_terms_too():
    d = Document.load(b"<ead><archdesc><did><origination><persname source='list'>A</persname></origination></did><controlaccess><p source='no'/></controlaccess></archdesc></ead>")
    assert d.known_sources() == ["list"]


# ---- single edits ----


def test_a_link_is_put_and_taken_without_a_trace(harbour):
    for mark in ("H", "H/1", "H/1/7", "H/1/8"):
        made = X.add_dao(unit(harbour, mark), "n.jpg", "image", "internal")
        where = made.parent.children()
        later = where[where.index(made) + 1 :]
        assert made.attrs == {"href": "n.jpg", "role": "image", "audience": "internal"} and all(c.tag in ("c", "dsc") for c in later)
        assert X.remove_dao(made) == 1 and X.remove_dao(made) == 0
    assert harbour.to_bytes() == HARBOUR


def test_a_group_goes_with_its_last_link(harbour):
    e = unit(harbour, "H/1/7")
    first = X.add_dao(e, "n.jpg", "image", into_group=True).parent
    assert first is e.find("daogrp") and len(first.children()) == 4
    for x in first.children()[1:]:
        X.remove_dao(x)
    assert first.parent is e  # its description stays
    assert X.remove_dao(first.children()[0]) == 1 and first.parent is None
    assert X.add_dao(unit(harbour, "H/1/8"), "n.jpg", "image", into_group=True).tag == "dao"  # there is no group


@pytest.mark.parametrize("href, role", [("", "image"), ("x", ""), ("", "")])
def test_links_need_href_and_role(harbour, href, role):
    with pytest.raises(ValueError):
        X.add_dao(unit(harbour, "H"), href, role)


def test_attributes_tell_whether_they_changed():
    e = Element("dao", {"href": "a", "role": "r"})
    assert [X.set_dao_attr(e, *x) for x in (("a", "r"), ("b", "r"), ("b", "r", "external"), ("b", "r", "external"), ("b", "r"))] == [0, 1, 1, 0, 1]


def test_terms_are_added_edited_and_removed(harbour):
    e = unit(harbour, "H/1/8")
    access = X.controlaccess(e)
    assert [c.tag for c in e.children()] == ["did", "controlaccess", "dao", "dao"] and X.controlaccess(e) is access
    t = X.add_term(access, "", "Ropes & sails")
    assert t.tag == "subject" and b"<subject>Ropes &amp; sails</subject>" in harbour.to_bytes()
    assert [X.edit_term(t, "title", "Ropes", "x"), X.edit_term(t, "title", "Ropes", "x"), X.edit_term(t, "title", "Ropes")] == [1, 0, 1]
    assert X.remove_term(t) == 1 and X.remove_term(t) == 0
    with pytest.raises(ValueError):
        X.add_term(access, "subject", " ")


# ---- counted edits ----


def test_counted_edits_of_links(harbour):
    r = harbour.root
    assert X.replace_in_href(r, "b/log_", "c/log_") == 4 and X.replace_in_href(r, "b/log_", "c/log_") == 0
    assert X.replace_in_href(r, r"_(\d)\.", r"-\1.", regex=True, role="mp3") == 1 and links(unit(harbour, "H/1/8"))[0][1] == "song-1.mp3"
    assert X.rename_role(r, "image", "access:image") == 4 and X.rename_role(r, "image", "x") == 0
    assert X.set_audience(r, "internal", "access:image") == 3 and X.set_audience(r, "internal") == 2 and X.set_audience(r, "") == 6


def test_counted_edits_of_terms_reach_the_whole_tree(harbour):
    r = harbour.root
    assert X.replace_term_text(r, "Pilots", "Pilots") == 2  # in the origination and among the terms; no change counts too
    assert X.replace_term_text(r, "Ida Berg", "I. Berg", "persname") == 1 and X.replace_term_text(r, "Tide", "Tides", "title") == 0
    assert X.normalize_source(r, {"s": "list"}) == 1 and X.normalize_source(r, {"list": "list"}) == 0 and X.normalize_source(r, {"": "own"}) == 6
    assert {e.get("source") for e in r.iter("persname", "name")} == {"own"}


def test_no_source_and_an_empty_one_are_alike(harbour):
    access = unit(harbour, "H/1").find("controlaccess")
    assert X.dedupe_terms(access) == 1 and [(t.text, t.get("source")) for t in access.children()][:2] == [("Tide", None), ("Tide", "s")]
    assert X.dedupe_all(harbour.root) == 0 and b"<!-- kept -->" in harbour.to_bytes()


def test_a_batch_changes_nothing_unless_told(spark):
    docs = table(spark, ("h", HARBOUR), ("bad", b"<a>"), ("none", None))
    for write in (False, True):
        out = X.batch(docs, "rename_role", {"old": "image", "new": "still"}, write)
        got = {r.doc: r for r in out.collect()}
        assert (got["h.xml"].n_changes, got["h.xml"].error) == (4, None) and got["bad.xml"].error and got["none.xml"].error
        assert (got["h.xml"].content == HARBOUR.replace(b'role="image"', b'role="still"')) == write
        assert tuple(X.batch_totals(out).first()) == (3, 1, 4, 2)
    assert X.batch(docs.limit(1), lambda root: len(root.children()), {}).first().n_changes == 2


# ---- nodes and extraction ----


def test_nodes_agree_with_the_tree(spark):
    got = xmltree.nodes(table(spark, ("h", HARBOUR), ("bad", b"<ead><c>"))).orderBy("node_id").collect()
    tree = list(ET.fromstring(HARBOUR).iter())
    assert [(r.tag, dict(r.attrs), r.text, r.tail) for r in got] == [(e.tag, e.attrib, e.text or "", e.tail or "" if i else "") for i, e in enumerate(tree)]
    assert [r.last_id - r.node_id + 1 for r in got] == [len(list(e.iter())) for e in tree]
    assert [r.inner for r in got if r.inner is not None] == ["Scans", "Scans "]


def test_extractions(spark):
    docs = table(spark, ("h", HARBOUR), ("bad", b"<ead><c>"))
    n = xmltree.nodes(docs).cache()
    assert [r.doc for r in xmltree.unparsed(docs, n).collect()] == ["bad.xml"] and xmltree.nodes(docs, tolerant=True).where("doc = 'bad.xml'").count() == 2
    comps = {r.unitid: r for r in xmltree.components(n).collect()}
    assert {u: (r.comp_depth, r.leaf) for u, r in comps.items()} == {"H": (0, False), "H/1": (1, False), "H/1/7": (2, True), "H/1/8": (2, True), None: (2, True)}
    assert xmltree.components(n, trimmed=False).where("unitid = ' H '").count() == 1
    assert sorted((r.unitid or "", r.dao) for r in xmltree.leaf_statistics(n, ["image"]).collect()) == [("", "sans"), ("H/1/7", "avec"), ("H/1/8", "sans")]
    assert tuple(xmltree.known(n).first()) == (["access:video", "image", "mp3"], ["s"])
    head = xmltree.finding_aids(n).first()
    assert (head.eadid, head.titleproper, head.unitid, head.repository) == ("H-0", "Harbour <office>", "H", "Cellar")
    nav = {r.unitid: r for r in xmltree.navigator(n).collect()}
    assert nav["H/1/8"].parent_comp == comps["H/1"].comp_id and nav[None].label == "? — Unnumbered" and nav["H/1"].label == "H/1 — Log books"
    assert sorted(r.id for r in xmltree.component_ids(n).collect()) == ["k7"]
    made = xmltree.concepts(xmltree.terms(n), "s")
    assert [tuple(r) for r in made.collect()] == [("s", "Tide", "tide")]
    from cartulary.sources.writers import rdf_documents

    rdf = rdf_documents(xmltree.triples(made, "http://t.example/")).first()
    assert rdf.doc == "s.rdf" and b"Tide" in ET.tostring(ET.fromstring(rdf.content.encode())) and xmltree.triples(made, "http://t.example/").count() == 3


# ---- the rewrite ----


def sources(spark):
    heads = spark.createDataFrame([("h.xml", "H-1", "HH", "Tower")], W.SHAPES["heads"])
    stored = spark.createDataFrame([("H-1", "H/1/8", "m0second", 1), ("H-1", "H/1/8", "m0third", 2), ("other", "H/1", "no", 1)], W.SHAPES["concordance"])
    records = spark.createDataFrame([("H/1/7", "older", 1), ("H/1/7", "old7", 2), (" H ", "never", 3)], W.SHAPES["records"])
    names = spark.createDataFrame([("Pilots", "persname"), ("Pilots", "corpname"), (None, "corpname")], W.SHAPES["names"])
    files = spark.createDataFrame(
        [("log_7.tif", "m/log_7.tif", "tiff"), ("log_9.tif", "m/log_9.tif", "tiff"), ("log_9.xml", "t/log_9.xml", "ocr xml"), ("sound_1_TI.wav", "w/sound_1_TI.wav", "audio"), ("sound_1_96kHz24B.wav", "w/sound_1_96kHz24B.wav", "audio"), ("sound_1_TI.mp3", "w/sound_1_TI.mp3", "audio"), ("film.mp4", None, "video")],
        W.SHAPES["files"],
    )
    return W.Sources(heads, stored, records, names, files)


def test_a_rewrite(spark):
    rules = W.Rules("http://p/", "m0", 5, {"name": "people"}, {("subject", "s"): "subjects"}, ("song", "sound"))
    out, new = W.rewrite_all(table(spark, ("h", HARBOUR), ("bad", b"<a>")), sources(spark), rules)
    got = {r.doc: r for r in out.collect()}
    assert got["bad.xml"].error.startswith("ValueError") and got["bad.xml"].content is None
    d = Document.load(got["h.xml"].content)
    r = d.root
    assert [e.text for e in r.iter("eadid", "repository")] == ["H-1", "Tower"] and unit(d, "HH").get("id") == "top"
    assert [(e.tag, e.text, e.get("source"), e.get("role")) for e in unit(d, "HH").find("controlaccess").children()] == [("persname", "Ida Berg", None, "p"), ("persname", "Pilots", None, None)]
    assert [e.all_text().strip() for e in r.iter("origination")] == ["and"]
    assert [(e.tag, e.text, e.get("source")) for e in unit(d, "H/1").find("controlaccess").children()] == [
        ("subject", "Tide", None), ("subject", "Tide", None), ("subject", "Tide", "subjects"), ("corpname", "Pilots", None), ("name", "Nobody", "people"),
    ]
    assert links(unit(d, "H/1/7")) == [
        ("daoloc", "m/log_7.tif", "preservation:image"), ("daoloc", "m/log_9.tif", "preservation:image"), ("daoloc", "m/log_7.jpg", "access:image"), ("daoloc", "b/log_8.jpg", "access:image"),
        ("daoloc", "m/log_9.jpg", "access:image"), ("daoloc", "t/log_9.xml", "access:ocr"), ("daoloc", "http://p/k7", "publication:current"), ("daoloc", "http://p/old7", "publication:previous"),
    ]
    assert [len(e.children()) for e in unit(d, "H/1/7").children() if e.tag == "daogrp"] == [9] and unit(d, "H/1/7").find("daogrp").children()[5].get("audience") == "internal"
    assert links(unit(d, "H/1/8")) == [
        ("dao", "film.mov", "access:video"), ("daoloc", "w/sound_1_96kHz24B.wav", "preservation:audio"), ("daoloc", "w/sound_1_TI.wav", "preservation:audio"), ("daoloc", "w/sound_1_TI.mp3", "access:audio"),
        ("daoloc", "http://p/m0second", "publication:current"),
    ]
    ids = {r.unitid: r.id for r in new.collect()}
    assert set(ids) == {"H/1"} and unit(d, "H/1").get("id") == ids["H/1"] and ids["H/1"].startswith("m05")
    assert links(unit(d, "H/1")) == [("dao", f"http://p/{ids['H/1']}", "publication:current")]
    lone = [e for e, _ in d.components() if e.find("did/unittitle") is not None and e.find("did/unittitle").text == "Unnumbered"][0]
    assert lone.get("id") and links(lone) == [("dao", f"http://p/{lone.get('id')}", "publication:current")]
    again, _ = W.rewrite_all(table(spark, ("h", HARBOUR)), sources(spark), rules)
    assert again.first().content == got["h.xml"].content


def test_a_rewrite_without_lookups_and_of_nothing(spark):
    out, new = W.rewrite_all(table(spark, ("h", HARBOUR)), W.Sources(), W.Rules("http://p/"))
    d = Document.load(out.first().content)
    assert d.root.find("eadheader/eadid").text == "H-0" and new.count() == 2 and len({e.get("id") for e, _ in d.components()}) == 5
    none, new = W.rewrite_all(table(spark, ("h", HARBOUR)).limit(0), W.Sources(), W.Rules("http://p/"))
    assert none.count() == 0 and new.count() == 0


def test_groups_that_hold_nothing_take_links_and_copies_go(spark):
    text = b"""<ead><archdesc id="a"><did><unitid>u</unitid></did><daogrp/><dao href="x.jpg" role="image"/><daogrp><daoloc href="y.jpg" role="r"/><daoloc href="y.jpg" role="r"/></daogrp>
    <daogrp><daoloc href="y.jpg" role="r"/><dao href="z" role="q"/></daogrp></archdesc></ead>"""
    files = spark.createDataFrame([("x.tif", "m/x.tif", "tiff")], W.SHAPES["files"])
    out, _ = W.rewrite_all(table(spark, ("e", text)), W.Sources(files=files), W.Rules("http://p/"))
    d = Document.load(out.first().content)
    assert [(x.tag, x.get("href")) for x in d.root.iter("dao", "daoloc")] == [("daoloc", "m/x.tif"), ("daoloc", "m/x.jpg"), ("daoloc", "http://p/a"), ("daoloc", "y.jpg"), ("dao", "z")]
    assert len(list(d.root.iter("daogrp"))) == 1


def test_document_queries_take_every_customer(spark, tmp_path):
    rng = random.Random(4)
    customers = [(k, f"Customer {k}", k % 3, rng.choice(["BUILDING", "MACHINERY"])) for k in range(40)]
    orders = [(k, rng.randrange(40), rng.choice("POF"), rng.choice(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])) for k in range(150)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    assert D.q_doc_components(spark, str(tmp_path)).where("leaf").count() == 40
    assert D.q_doc_links(spark, str(tmp_path)).agg(F.sum("n")).first()[0] == 150


def test_preservation_range_beats_access(spark):
    text = b"""<ead><archdesc><dsc><c id="k"><did><unitid>u</unitid></did><daogrp><daoloc href="P_1.jpg" role="access:image:first"/><daoloc href="P_3.jpg" role="access:image:last"/>
    <daoloc href="M_1.tif" role="preservation:image:first"/><daoloc href="M_3.tif" role="preservation:image:last"/></daogrp>
    <daogrp><daoloc href="A_1_1.jpg" role="access:image:first"/><daoloc href="A_2_3.jpg" role="access:image:last"/></daogrp></c></dsc></archdesc></ead>"""
    n = xmltree.nodes(spark.createDataFrame([("x.xml", bytearray(text))], "doc string, content binary"))
    clear, vague = catalogue.expand_bounds(n)
    assert {r.href for r in clear.collect()} == {"M_1.tif", "M_2.tif", "M_3.tif"} and vague.count() == 2
    files = spark.createDataFrame([("M_1.tif", "u1", "k1"), ("M_1.tif", "u0", None), ("M_3.tif", "u3", None)], "name string, uuid string, s3_key string")
    checked = catalogue.check_ranges(clear.withColumn("role", F.lit("preservation:image")), files)
    assert sorted((r.href, r.dans_ref, r.sur_s3) for r in checked.collect()) == [("M_1.tif", True, True), ("M_2.tif", False, False), ("M_3.tif", True, False)]
    g = catalogue.range_gaps(checked).first()
    assert (g.total, g.presents, g.manquants, g.taux) == (3, 2, 1, 66.7)


def test_generated_finding_aids(spark):
    files = spark.createDataFrame(
        [("P", "P_19050302", "x_2.tif", "/p", None), ("P", "P_19050302", "x_1.xml", "/p", None), ("P", "P_19050302", "x_1.tif", "/p", "k/x_1.tif"), ("P", "P_19041201", "y_1.tif", "/p", None), ("P", "undated", "z.tif", "/p", None)],
        "corpus_code string, unitid string, name string, path string, s3_key string",
    )
    identity = F.md5(F.col("key"))
    row = catalogue.press_finding_aid(files, identity).select(catalogue.whole_document(F.lit("E1"), F.lit("Title & x"), F.col("dsc"), F.lit("m0"), "Library").alias("x")).first()
    root = ET.fromstring(row.x.encode())
    assert [d.text for d in root.iter("unittitle")] == ["Title & x", "1904", "décembre 1904", "1 décembre 1904", "1905", "mars 1905", "2 mars 1905"]
    last = [g for g in root.iter("daogrp")][-1]
    assert [(d.get("href"), d.get("role")) for d in last] == [("k/x_1.tif", "preservation:image"), ("/p/x_1.xml", "preservation:ocr"), ("/p/x_2.tif", "preservation:image")]
    assert len({c.get("id") for c in root.iter("c")}) == 6
    registers = spark.createDataFrame([("R", "1_D_10", "r_1.tif", "/r (1900-1905)/", None), ("R", "1 D  2", "r_1.tif", "/r", None), ("R", "2 D 1", "r_1.tif", "/r (1801)", None)], files.schema)
    dsc = ET.fromstring("<x>" + catalogue.register_finding_aid(registers, identity).first().dsc + "</x>")
    assert [d.text for d in dsc.iter("unitid")] == ["1 D 10", "1 D 2", "2 D 1"]
    assert [(d.get("normal"), d.text) for d in dsc.iter("unitdate")] == [("1900-01-01/1905-12-31", "1900-1905"), ("1801-01-01/1801-12-31", "1801")]


def test_finding_aids_take_every_order(spark, tmp_path):
    days = [(i, f"{1 + i % 2}-X", datetime.date(1996, 1 + i % 3, 1 + i % 28)) for i in range(1, 120)]
    spark.createDataFrame(days, "o_orderkey long, o_orderpriority string, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    links = Q.q_extracted_links(spark, str(tmp_path)).collect()
    assert sorted(r.href for r in links) == sorted(f"/p/p_{k}.tif" for k, _, _ in days)
    docs = {f"PRA_{p[0]}_{d:%Y%m}.xml" for _, p, d in days}
    assert {r.doc for r in links} == docs
    assert {r.doc: r.leaves for r in Q.q_generated_components(spark, str(tmp_path)).collect()} == {x: len({d for _, p, d in days if x == f"PRA_{p[0]}_{d:%Y%m}.xml"}) for x in docs}
    assert sum(r.n_changes for r in Q.q_batch_dryrun(spark, str(tmp_path)).collect()) == len(days)


def test_technical_metadata(spark):
    text = b"""<jhove><repInfo uri="f1"><format>TIFF</format><size>12</size><mix:x xmlns:mix="m"><mix:imageWidth>100</mix:imageWidth><mix:xSamplingFrequency><mix:numerator>600</mix:numerator><mix:denominator>2</mix:denominator></mix:xSamplingFrequency></mix:x></repInfo>
    <repInfo uri="f2"><format>JPEG</format><format>JPEG2</format></repInfo></jhove>"""
    got = {r.jhove_uri: r for r in xmltree.technical(xmltree.nodes(spark.createDataFrame([("j", bytearray(text))], "doc string, content binary"))).collect()}
    assert got["f1"].jhove_x_resolution == 300.0 and got["f1"].jhove_imageWidth == "100" and got["f2"].jhove_format == "JPEG2"


def test_sniffing(spark):
    rows = [("/a/x.xml", bytearray(HARBOUR)), ("/a/y.xml", bytearray(b"<other/>")), ("/a/x.txt", bytearray(HARBOUR)), ("/a/Z.XML", bytearray(b"<ead>")), ("/a/late.xml", bytearray(b" " * 5000 + b"<ead>"))]
    assert {r.path for r in xmltree.sniff(spark.createDataFrame(rows, "path string, content binary")).collect()} == {"/a/x.xml", "/a/Z.XML"}


def test_a_document_in_parts_has_the_nodes_of_the_whole(spark):
    frame = "<ead><archdesc><did><unitid>F</unitid></did>{}<dsc a='1'>{}</dsc><odd>x<c/></odd></archdesc> t </ead>"
    inside = ["<c id='1'><did><unitid>1</unitid></did><c/>two</c> tail <p/>", "", "<c><c><c/></c></c>", "<daogrp><daodesc>a<b>c</b></daodesc></daogrp><c/>"]
    deep = "<c>{}</c>"
    documents = {"a.xml": frame.format("", "{}"), "b.xml": frame.format("", deep.format("<dsc>{}</dsc>")).replace("<dsc a='1'>", "").replace("</dsc><odd>", "<odd>"), "lone.xml": "<ead><dsc>{}</dsc></ead>", "none.xml": "<ead><p/></ead>"}
    whole = spark.createDataFrame([(d, bytearray(t.format("".join(inside)).encode())) for d, t in documents.items()], "doc string, content binary")
    bad = [("bad.xml", "<ead><dsc></dsc></ead>"), ("text.xml", "<ead><dsc></dsc></ead>"), ("frame.xml", "<ead><dsc></ead>")]
    frames = spark.createDataFrame([(d, bytearray(t.encode())) for d, t in [*((d, t.format("")) for d, t in documents.items()), *bad]], "doc string, content binary")
    rows = [(d, i, bytearray(t.encode())) for d in documents if d != "none.xml" for i, t in enumerate(inside, 5)]
    rows += [("bad.xml", 1, bytearray(b"<c/>")), ("bad.xml", 2, bytearray(b"<c>")), ("text.xml", 1, bytearray(b"t<c/>")), ("frame.xml", 1, bytearray(b"<c/>"))]
    got = xmltree.nodes_in_parts(frames, spark.createDataFrame(rows, "doc string, part long, content binary"), "dsc")
    key = lambda n: sorted((str([sorted(x.items()) if isinstance(x, dict) else x for x in r]) for r in n.collect()))
    assert key(got) == key(xmltree.nodes(whole)) and got.columns == xmltree.nodes(whole).columns


def test_a_long_register_is_made_in_parts(spark):
    files = spark.range(5000).select(
        F.concat(F.lit("R"), (F.col("id") % 2).cast("string")).alias("corpus_code"), F.concat(F.lit("V_"), (F.col("id") % 1999).cast("string")).alias("unitid"),
        F.format_string("p_%04d.tif", "id").alias("name"), F.lit("/r (1900-1905)").alias("path"), F.lit(None).cast("string").alias("s3_key"),
    )
    parts = catalogue.register_parts(files, F.md5("key")).orderBy("corpus_code", "part").collect()
    want = {r.corpus_code: r.dsc for r in catalogue.register_finding_aid(files, F.md5("key")).collect()}
    assert {c: "".join(r.dsc for r in parts if r.corpus_code == c) for c in want} == want
    assert max(r.dsc.count("<c ") for r in parts) <= 1024 and len(parts) > len(want)


def test_a_rewrite_runs_once_and_in_small_batches(spark):
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    for k in keys:
        spark.conf.unset(k)
    out, _ = W.rewrite_all(table(spark, ("h", HARBOUR), ("g", HARBOUR)), W.Sources(), W.Rules("http://l.example/"))
    assert "MapInArrow" not in out._jdf.queryExecution().toString()  # several readers don't carry out the scripts again
    assert [int(spark.conf.get(k)) for k in keys] == [2000, 8 << 20] and out.where("error is null and content is not null").count() == 2
    batch = pa.RecordBatch.from_pylist([{"doc": str(i), "ids": [{"comp": i, "id": "x"}]} for i in range(3)])
    rows = W._each(batch)
    assert next(rows) == batch.to_pylist()[0] and list(rows) == batch.to_pylist()[1:]


def test_tables_of_texts_have_small_row_groups(spark):
    """A reader decodes up to 4096 rows of a row group at once."""
    texts = spark.range(0, 400, 1, 1).select("id", F.expr("array_join(transform(sequence(1, 1000), x -> sha2(concat(id, '-', x), 256)), '')").alias("content"))
    out = written(texts, "texts", texts=True)
    [path] = Path(out.written_to.removeprefix("file:")).glob("*.parquet")
    meta = pq.ParquetFile(path).metadata
    assert meta.num_rows == out.count() == 400 and meta.num_row_groups >= 3 and max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) < 256


def test_links_are_gathered_by_document_once(spark):
    n = written(xmltree.nodes(table(spark, ("h", HARBOUR)), above=True), "nodes")
    comps = written(W.with_ids(n, sources(spark), W.Rules("http://p/")), "ids")
    rows = W.rewritten_links(n, comps, sources(spark), W.Rules("http://p/"))
    per = rows.groupBy("doc", "comp", "box").agg(F.count("*").alias("n")).groupBy("doc").agg(F.sum("n").alias("n"))
    plan = per._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange hashpartitioning(doc") == 1 and "REPARTITION_BY_COL" in plan and per.first().n == rows.count()


def test_links_are_the_same_by_what_is_above_and_by_joins(spark):
    text = b"<dao href='r'><c><did><unitid> 1 </unitid><did><unitid>no</unitid></did></did><daogrp><daoloc href='x'/><daogrp><dao href='y'/><daodesc>t</daodesc></daogrp></daogrp><p><dao href='z'/></p></c></dao>"
    docs = table(spark, ("h", HARBOUR), ("g", text))
    plain, above = xmltree.nodes(docs), xmltree.nodes(docs, above=True)
    key = lambda n: sorted(map(str, n.collect()))
    for f in (xmltree.links, xmltree.components):
        assert key(f(plain).select(*sorted(f(plain).columns))) == key(f(above).select(*sorted(f(plain).columns)))
    assert "Join" not in xmltree.links(above)._jdf.queryExecution().toString()


def test_terms_are_the_same_by_what_is_above_and_by_a_join(spark):
    docs = table(spark, ("h", HARBOUR), ("g", b"<controlaccess><name>x</name><controlaccess><p><name>no</name></p><subject> y </subject></controlaccess></controlaccess>"))
    plain, above = xmltree.terms(xmltree.nodes(docs)), xmltree.terms(xmltree.nodes(docs, above=True))
    key = lambda t: sorted(map(str, t.collect()))
    assert key(plain) == key(above) and above.where("doc = 'g.xml'").count() == 4
    assert "Join" not in above._jdf.queryExecution().toString()
