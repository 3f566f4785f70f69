"""XML documents as rows: nodes in document order, and the extractions over them.

Parsing is per document in Python; everything after it is DataFrame work on the node table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartulary.functions import keys as K, ranges as R
from cartulary.operators.materialise import bounded_batches, written

COMPONENTS = ("c", "archdesc")
FIELDS = "doc string, node_id int, parent_id int, ord int, depth int, tag string, attrs map<string,string>, text string, tail string, comp_id int, comp_depth int, last_id int, inner string"
#: What ``nodes`` adds on demand, so that nobody joins nodes to look up what they stand in.
ABOVE = "parent_tag string, up_id int, up_tag string"
#: Tags that index, wherever they stand.
TERMS = ("subject", "geogname", "persname", "corpname", "famname", "genreform", "function", "occupation", "title", "name")  # fixed values
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Builder:
    """Collects nodes; text and tail as in an element tree, ``inner`` the whole text of a description of links."""

    def __init__(self, outside: tuple[int | None, int] = (None, -1)) -> None:
        self.outside = outside  # component around the root, and its depth
        self.rows: list[list] = []
        self.stack: list[int] = []
        self.children: list[int] = []
        self.last: int | None = None  # the element whose tail comes next

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        parent = self.stack[-1] if self.stack else None
        node = len(self.rows)
        order = 0
        if parent is not None:
            order = self.children[parent]
            self.children[parent] += 1
        above = self.rows[parent] if parent is not None else None
        comp, depth = (above[9], above[10]) if above else self.outside
        if tag in COMPONENTS:
            comp, depth = node, 0 if tag == "archdesc" else max(depth, 0) + 1
        self.rows.append([None, node, parent, order, len(self.stack), tag, attrs, "", "", comp, depth, node, "" if tag == "daodesc" else None])
        self.children.append(0)
        self.stack.append(node)
        self.last = None

    def end(self) -> None:
        self.last = self.stack.pop()
        self.rows[self.last][11] = len(self.rows) - 1

    def data(self, text: str) -> None:
        for k in self.stack:
            if self.rows[k][12] is not None:
                self.rows[k][12] += text
        if self.last is not None:
            self.rows[self.last][8] += text
        elif self.stack:
            self.rows[self.stack[-1]][7] += text


def parse_strict(content: bytes, outside: tuple[int | None, int] = (None, -1)) -> list[list]:
    """Nodes of a well-formed document; raises ``ValueError`` for others."""
    b = _Builder(outside)
    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler = b.start
    parser.EndElementHandler = lambda _: b.end()
    parser.CharacterDataHandler = b.data
    try:
        parser.Parse(content, True)
    except expat.ExpatError as e:
        raise ValueError(str(e)) from e
    return b.rows


def parse_tolerant(content: bytes) -> list[list]:
    """Nodes of any text: what isn't closed is closed, what wasn't opened is skipped."""
    try:
        return parse_strict(content)
    except ValueError:
        pass
    b = _Builder()
    names = {m[1].lower(): m[1] for m in re.finditer(r"<([A-Za-z_][\w.:-]*)", content.decode("utf-8", "replace"))}

    class Reader(HTMLParser):
        def handle_starttag(self, tag, attrs):
            b.start(names.get(tag, tag), {k: v or "" for k, v in attrs})
            if tag in VOID:
                b.end()

        def handle_startendtag(self, tag, attrs):
            b.start(names.get(tag, tag), {k: v or "" for k, v in attrs})
            b.end()

        def handle_endtag(self, tag):
            name = names.get(tag, tag)
            if any(b.rows[i][5] == name for i in b.stack):
                while b.rows[b.stack[-1]][5] != name:
                    b.end()
                b.end()

        def handle_data(self, data):
            b.data(data)

    reader = Reader(convert_charrefs=True)
    reader.feed(content.decode("utf-8", "replace"))
    reader.close()
    while b.stack:
        b.end()
    return b.rows


NAMES = [f.split()[0] for f in FIELDS.split(", ")]
KINDS = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]


ABOVE_NAMES, ABOVE_KINDS = [f.split()[0] for f in ABOVE.split(", ")], [pa.string(), pa.int32(), pa.string()]


def _batches(doc: str, rows: list[list], above: bool = False) -> Iterator[pa.RecordBatch]:
    names, kinds = (NAMES + ABOVE_NAMES, KINDS + ABOVE_KINDS) if above else (NAMES, KINDS)
    for i in range(0, len(rows), 4096):
        part = rows[i : i + 4096]
        for r in part:
            r[0], r[6] = doc, list(r[6].items())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names)


def _add_above(rows: list[list]) -> None:
    """Append to each node its parent's tag, and id and tag of the parent's parent."""
    for r in rows:
        parent = rows[r[2]] if r[2] is not None else None
        up = parent[2] if parent else None
        r += [parent[5] if parent else None, up, rows[up][5] if up is not None else None]


def nodes(docs: DataFrame, tolerant: bool = False, above: bool = False) -> DataFrame:
    """Node rows of ``docs`` (doc, content binary); documents that don't parse have none.  ``above``: with the columns ``ABOVE``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, content in zip(b.column("doc").to_pylist(), b.column("content")):
                raw = content.as_py()
                if raw is None:
                    continue
                try:
                    rows = parse_tolerant(raw) if tolerant else parse_strict(raw)
                except ValueError:
                    continue
                if above:
                    _add_above(rows)
                yield from _batches(doc, rows, above)

    bounded_batches(docs)
    return docs.select("doc", "content").mapInArrow(run, f"{FIELDS}, {ABOVE}" if above else FIELDS)


def _wrapped(content: bytes) -> bytes:
    """A sequence of elements below a root of their own."""
    return b"<x>" + content + b"</x>"


def _sizes(content: bytes) -> tuple[int, int]:
    """Elements of a sequence, and its outermost ones; raises ``ValueError`` for what isn't one or begins with text."""
    n = depth = roots = 0

    def start(_, attrs) -> None:
        nonlocal n, depth, roots
        n, depth, roots = n + 1, depth + 1, roots + (depth == 1)
        if n == 2:
            parser.CharacterDataHandler = None

    def end(_) -> None:
        nonlocal depth
        depth -= 1

    early: list[str] = []
    parser = expat.ParserCreate()
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, early.append
    try:
        parser.Parse(_wrapped(content), True)
    except expat.ExpatError as e:
        raise ValueError(str(e)) from e
    if early:
        raise ValueError("text before the first element")
    return n - 1, roots


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for doc, part, content in zip(b.column("doc").to_pylist(), b.column("part").to_pylist(), b.column("content")):
            try:
                rows.append((doc, part, *_sizes(content.as_py() or b"")))
            except ValueError:
                rows.append((doc, part, None, None))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, (pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["doc", "part", "n", "roots"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of parts, numbered and placed as in the whole document."""
    at = ("doc", "node_id", "depth", "comp_id", "comp_depth", "n_before", "roots_before")
    for b in batches:
        for doc, hole, depth, comp, comp_depth, n, roots, content in zip(*(b.column(c).to_pylist() for c in at), b.column("content")):
            rows, low = parse_strict(_wrapped(content.as_py() or b""), (-1, comp_depth)), hole + n
            for r in rows[1:]:
                r[1] += low
                r[11] += low
                r[4] += depth
                r[9] = comp if r[9] == -1 else r[9] + low
                if r[2] == 0:
                    r[2], r[3] = hole, r[3] + roots
                else:
                    r[2] += low
            yield from _batches(doc, rows[1:])


def nodes_in_parts(frames: DataFrame, parts: DataFrame, hole: str) -> DataFrame:
    """Node rows of documents that are too long for a row, as ``nodes`` would give of each in one piece.

    ``frames`` (doc, content binary): documents without what their first element ``hole``, which is empty, contains;
    ``parts`` (doc, part long, content binary), written: that, cut before elements, in the order of part.  Parts are parsed
    side by side: their nodes are counted first.  A document of which something doesn't parse has none."""
    bounded_batches(parts)
    counts = written(parts.mapInArrow(_count, "doc string, part long, n long, roots long"), "part-sizes")
    before = Window.partitionBy("doc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    offsets = counts.select("doc", "part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "roots")))
    sums = counts.groupBy("doc").agg(F.sum("n").alias("more"), F.count_if(F.col("n").isNull()).alias("bad"))
    frame = nodes(frames)
    first = frame.where(F.col("tag") == hole).groupBy("doc").agg(F.min(F.struct("node_id", "depth", "comp_id", "comp_depth")).alias("at"))
    spots = sums.join(first, "doc").where("bad = 0").select("doc", "at.*", "more")
    inside = parts.join(offsets, ["doc", "part"]).join(spots.drop("more"), "doc").mapInArrow(_placed, FIELDS)
    sizes = sums.join(first, "doc", "left").select("doc", "more", "bad", F.col("at.node_id").alias("at"))
    around = frame.join(sizes, "doc", "left").where("bad is null or bad = 0 and at is not null")
    later = lambda c, own=False: F.when(F.col(c) >= F.col("at") if own else F.col(c) > F.col("at"), F.col(c) + F.col("more")).otherwise(F.col(c)).cast("int").alias(c)
    moved = {"node_id": later("node_id"), "parent_id": later("parent_id"), "comp_id": later("comp_id"), "last_id": later("last_id", own=True)}
    return around.select(*(moved.get(c, F.col(c)) for c in NAMES)).unionByName(inside)


def sniff(files: DataFrame, root: str = "ead", size: int = 4096) -> DataFrame:
    """Files (path, content) named .xml whose first bytes hold the root element."""
    head = F.decode(F.substring("content", 1, size), "ISO-8859-1")
    return files.where(F.lower(K.splitext_extension(K.basename(F.col("path")))).eqNullSafe(".xml") & head.rlike(rf"<{root}[\s>]"))


def unparsed(docs: DataFrame, node_table: DataFrame) -> DataFrame:
    return docs.select("doc").join(node_table.select("doc").distinct(), "doc", "left_anti")


def _attr(name: str) -> Column:
    return F.try_element_at(F.col("attrs"), F.lit(name))


def _placed_nodes(n: DataFrame) -> bool:
    return set(ABOVE_NAMES) <= set(n.columns)


def components(n: DataFrame, trimmed: bool = True) -> DataFrame:
    """Components in document order: doc, comp_id, tag, level, id, unitid, unittitle, comp_depth, leaf."""
    said = F.trim("text") if trimmed else F.col("text")
    fields = n.where(F.col("tag").isin("unitid", "unittitle"))
    if _placed_nodes(n):
        fields = fields.where("parent_tag = 'did'").select("doc", F.col("up_id").alias("comp_id"), "tag", "ord", "text")
    else:
        did = n.where("tag = 'did'").select("doc", F.col("node_id").alias("did_id"), F.col("parent_id").alias("comp_id"))
        fields = fields.select("doc", F.col("parent_id").alias("did_id"), "tag", "ord", "text").join(did, ["doc", "did_id"])
    first = fields.groupBy("doc", "comp_id").agg(
        F.min_by(F.when(F.col("tag") == "unitid", said), F.when(F.col("tag") == "unitid", F.col("ord"))).alias("unitid"),
        F.min_by(F.when(F.col("tag") == "unittitle", said), F.when(F.col("tag") == "unittitle", F.col("ord"))).alias("unittitle"),
    )
    inner = n.where("tag = 'c'").select("doc", F.col("parent_id").alias("comp_id"), F.lit(False).alias("_leaf")).distinct()
    comps = n.where(F.col("tag").isin(*COMPONENTS)).select("doc", F.col("node_id").alias("comp_id"), "tag", _attr("level").alias("level"), _attr("id").alias("id"), "comp_depth")
    out = comps.join(first, ["doc", "comp_id"], "left").join(inner, ["doc", "comp_id"], "left")
    return out.withColumn("leaf", F.coalesce("_leaf", F.col("tag") == "c")).drop("_leaf")


def links(n: DataFrame) -> DataFrame:
    """Digital object links with their group: doc, node_id, kind, href, role, audience, group_id, comp_id, comp_depth."""
    found = n.where(F.col("tag").isin("dao", "daoloc"))
    if _placed_nodes(n):
        found = found.withColumn("_grouped", F.col("parent_tag") == "daogrp")
    else:
        groups = n.where("tag = 'daogrp'").select("doc", F.col("node_id").alias("parent_id"), F.lit(True).alias("_grouped"))
        found = found.join(groups, ["doc", "parent_id"], "left")
    return found.select(
        "doc", "node_id", F.col("tag").alias("kind"), _attr("href").alias("href"), _attr("role").alias("role"), _attr("audience").alias("audience"),
        F.when(F.col("_grouped"), F.col("parent_id")).otherwise(F.col("node_id")).alias("group_id"), "comp_id", "comp_depth",
    )


def expanded_links(n: DataFrame, source: str, roles: Sequence[str] | None = None, preserved_first: bool = False) -> DataFrame:
    """Files of all links: ranges expanded, ambiguous ones by their bounds, other links as they are.

    Columns as in the raw link table.  ``preserved_first`` drops an access range whose group
    has the preservation range of the same medium.
    """
    all_links = links(n)
    if roles is not None:
        all_links = all_links.where(F.col("role").isin(list(roles)))
    ends = all_links.withColumn("b", R.bound(F.col("role"))).where("b is not null")
    last = lambda c, p: F.max_by(F.when(F.col("b.position") == p, F.col(c)), F.when(F.col("b.position") == p, F.col("node_id")))
    pairs = ends.groupBy("doc", "group_id", F.col("b.prefix").alias("prefix")).agg(
        last("node_id", "first").alias("first_id"), last("node_id", "last").alias("last_id"), last("href", "first").alias("f"), last("href", "last").alias("l"),
        last("comp_id", "first").alias("comp_id"), last("comp_depth", "first").alias("comp_depth"), last("comp_id", "last").alias("last_comp"),
    ).where("first_id is not null and last_id is not null")
    if preserved_first:
        media = F.regexp_extract("prefix", "^preservation:(.*)$", 1)
        kept = pairs.where(F.col("prefix").startswith("preservation:")).select("doc", "group_id", F.concat(F.lit("access:"), media).alias("prefix")).distinct()
        pairs = pairs.join(kept, ["doc", "group_id", "prefix"], "left_anti")
    pairs = R.with_span(pairs, F.coalesce("f", F.lit("")), F.coalesce("l", F.lit("")))
    clear = R.members(pairs).select("doc", "comp_id", "comp_depth", F.concat("prefix", F.lit(":plage")).alias("role"), F.col("size").alias("taille_plage"), "href", "position")
    vague = pairs.where("span is null").select(
        "doc", "comp_depth", F.concat("prefix", F.lit(":plage:ambigu")).alias("role"),
        F.explode(F.array(F.struct(F.lit("first").alias("position"), F.col("f").alias("href"), F.col("comp_id").alias("comp_id")), F.struct(F.lit("last").alias("position"), F.col("l").alias("href"), F.col("last_comp").alias("comp_id")))).alias("e"),
    ).select("doc", "e.comp_id", "comp_depth", "role", F.lit(None).cast("int").alias("taille_plage"), F.coalesce("e.href", F.lit("")).alias("href"), "e.position")
    used = pairs.select("doc", F.explode(F.array("first_id", "last_id")).alias("node_id"))
    single = all_links.join(used, ["doc", "node_id"], "left_anti").where("href is not null and href <> ''")
    single = single.select("doc", "comp_id", "comp_depth", "role", F.lit(1).alias("taille_plage"), "href", F.lit("isole").alias("position"))
    rows = clear.unionByName(vague).unionByName(single)
    who = components(n).select("doc", "comp_id", F.col("id").alias("id_composant"), "unitid")
    named = F.concat(F.lit(source + "_"), K.stem(K.basename(F.col("doc"))), F.lit(".xml"))
    return rows.join(who, ["doc", "comp_id"], "left").select(
        F.lit(source).alias("source"), F.col("doc").alias("ir"), named.alias("finding_aid"), "id_composant", "unitid", F.coalesce("comp_depth", F.lit(-1)).alias("profondeur"),
        "role", "href", K.basename(F.col("href")).alias("href_base"), "position", "taille_plage",
    )


def orphan_links(n: DataFrame, before: str, after: str) -> DataFrame:
    """Access links (not OCR) without a preservation link of their family and a common key in their group."""
    from cartulary.operators.matching import missing_in_group

    l = links(n).where("href is not null and href <> ''").withColumn("family", K.role_family(F.col("role"))).withColumn("g", F.concat_ws("|", "doc", F.col("group_id").cast("string")))
    wanted = F.coalesce(F.col("role").startswith("access:") & (F.col("role") != "access:ocr"), F.lit(False))
    present = F.coalesce(F.col("role").startswith("preservation:"), F.lit(False))
    found = missing_in_group(l, "g", wanted, present, "family", K.exact_keys(F.col("href"), before, after))
    return found.join(components(n).select("doc", "comp_id", F.col("id").alias("id_composant"), "unitid"), ["doc", "comp_id"], "left").select(F.col("doc").alias("ir"), "id_composant", "unitid", "role", "href")


def terms(n: DataFrame) -> DataFrame:
    """Indexing terms: children of controlaccess, with their text trimmed."""
    if _placed_nodes(n):
        inside = n.where("parent_tag = 'controlaccess'")
    else:
        inside = n.join(n.where("tag = 'controlaccess'").select("doc", F.col("node_id").alias("parent_id")), ["doc", "parent_id"], "left_semi")
    return inside.select(
        "doc", "node_id", "comp_id", "parent_id", "ord", "tag", F.trim("text").alias("text"), _attr("source").alias("source"), _attr("role").alias("role"), _attr("normal").alias("normal")
    )


def known(n: DataFrame) -> DataFrame:
    """One row: the roles of links and the sources of indexing tags anywhere, sorted; empty ones don't count."""
    said = lambda tags, name: F.array_sort(F.collect_set(F.when(F.col("tag").isin(*tags), F.nullif(_attr(name), F.lit("")))))
    return n.agg(said(("dao", "daoloc"), "role").alias("roles"), said(TERMS, "source").alias("sources"))


def finding_aids(n: DataFrame) -> DataFrame:
    """Per document the first eadid, title, unitid and repository."""
    first = lambda tag: F.min_by(F.when(F.col("tag") == tag, F.trim("text")), F.when(F.col("tag") == tag, F.col("node_id"))).alias(tag)
    return n.groupBy("doc").agg(*map(first, ("eadid", "titleproper", "unitid", "repository")))


def leaf_statistics(n: DataFrame, roles: Sequence[str] | None = None) -> DataFrame:
    """Leaf components with their first digital file, if any."""
    l = links(n).where("href is not null and href <> ''")
    if roles is not None:
        l = l.where(F.col("role").isin(list(roles)))
    first = l.groupBy("doc", "comp_id").agg(F.min_by("href", "node_id").alias("href"))
    return components(n).where("leaf").join(first, ["doc", "comp_id"], "left").withColumn("dao", F.when(F.col("href").isNotNull(), "avec").otherwise("sans"))


def component_ids(n: DataFrame) -> DataFrame:
    return n.where("tag = 'c'").select(_attr("id").alias("id")).where("id is not null").distinct()


def navigator(n: DataFrame) -> DataFrame:
    """Components with the component above and a label."""
    ups = n.select("doc", "node_id", F.col("comp_id").alias("up"))
    at = n.where(F.col("tag").isin(*COMPONENTS)).select("doc", F.col("node_id").alias("comp_id"), "parent_id")
    above = at.join(ups, (at["doc"] == ups["doc"]) & (at["parent_id"] == ups["node_id"]), "left").select(at["doc"], "comp_id", F.col("up").alias("parent_comp"))
    label = F.concat_ws(" — ", F.coalesce("unitid", F.lit("?")), "unittitle")
    return components(n).join(above, ["doc", "comp_id"], "left").withColumn("label", label)


def technical(n: DataFrame, record: str = "repInfo") -> DataFrame:
    """Flat technical metadata: per record the last value of each leaf, resolutions as quotients."""
    heads = n.where(F.col("tag") == record).select("doc", F.col("node_id").alias("head"), _attr("uri").alias("jhove_uri"))
    top = Window.partitionBy("doc").orderBy("node_id").rowsBetween(Window.unboundedPreceding, 0)
    marked = n.withColumn("head", F.max(F.when(F.col("tag") == record, F.col("node_id"))).over(top)).where("head is not null")
    local = F.regexp_replace("tag", "^.*:", "")
    last = lambda name: F.max_by(F.when(local == name, F.nullif(F.trim("text"), F.lit(""))), F.when((local == name) & (F.trim("text") != ""), F.col("node_id")))
    part = lambda name: last(name).try_cast("double")
    wide = marked.groupBy("doc", "head").agg(
        *(last(s).alias(f"jhove_{s}") for s in ("lastModified", "format", "version", "mimeType", "size", "imageWidth", "imageHeight")),
        last("samplingFrequencyUnit").alias("jhove_samplingFrequencyUnit"), last("xSamplingFrequency").try_cast("double").alias("jhove_x_resolution"), last("ySamplingFrequency").try_cast("double").alias("jhove_y_resolution"),
        part("numerator").alias("_n"), part("denominator").alias("_d"),
    )
    quotient = F.coalesce(F.try_divide("_n", "_d"), F.col("_n"))
    wide = wide.withColumn("jhove_x_resolution", F.coalesce("jhove_x_resolution", quotient)).withColumn("jhove_y_resolution", F.coalesce("jhove_y_resolution", quotient))
    return heads.join(wide.drop("_n", "_d"), ["doc", "head"]).drop("head", "doc")


def concepts(t: DataFrame, prefix: str) -> DataFrame:
    """Distinct concepts of the sources with a prefix, without backslashes and blanks: source, concept, slug."""
    text = F.trim(F.replace("text", F.lit("\\"), F.lit("")))
    c = t.where(F.coalesce(F.col("source").startswith(prefix), F.lit(False))).select("source", text.alias("concept")).where("concept <> ''").distinct()
    return c.withColumn("slug", K.uri_slug(F.col("concept")))


def triples(c: DataFrame, base: str, language: str = "fr") -> DataFrame:
    """SKOS statements (s, p, o, lang) of concepts, distinct."""
    skos, rdf = "http://www.w3.org/2004/02/skos/core#", "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
    scheme = F.concat(F.lit(base), F.regexp_replace("source", r"[^A-Za-z0-9_.-]", "_"))
    subject = F.concat(scheme, F.lit("#"), F.col("slug"))
    rows = F.array(
        F.struct(subject.alias("s"), F.lit(rdf + "type").alias("p"), F.lit(skos + "Concept").alias("o"), F.lit(None).cast("string").alias("lang")),
        F.struct(subject.alias("s"), F.lit(skos + "prefLabel").alias("p"), F.col("concept").alias("o"), F.lit(language).alias("lang")),
        F.struct(subject.alias("s"), F.lit(skos + "inScheme").alias("p"), scheme.alias("o"), F.lit(None).cast("string").alias("lang")),
    )
    return c.select(F.explode(rows).alias("t")).select("t.*").distinct()
