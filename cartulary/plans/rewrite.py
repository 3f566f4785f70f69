"""The whole rewrite of catalogue documents, as relations between their nodes and what they look up.

Links, names and components are rows.  What a row needs of a lookup is joined to it; what
becomes of a component's links is decided by ranks and windows over its rows.  The result
is an edit script per document, which a single writer carries out on the document's text,
so that no task holds a lookup table.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartulary.functions import keys as K
from cartulary.operators import ids as I, survive, xmledit, xmltree
from cartulary.operators.materialise import bounded_batches, discard, written
from cartulary.operators.xmldoc import Document, Element
from cartulary.plans import catalogue

#: Place of what is put behind all links of a component.
BEHIND = 1 << 40
#: Phases of the entries of a group: its own or its first group's, those of further groups, publications, masters.
OWN, FURTHER, PUBLISHED, MASTERS = range(4)
# Roles.
CURRENT, PREVIOUS, OCR = "publication:current", "publication:previous", "access:ocr"


@dataclass
class Rules:
    """What a rewrite of one collection's documents takes; no default names a place or product."""

    link_base: str
    id_prefix: str = "m0"
    epoch: int = 0
    term_sources: Mapping[str, str] = field(default_factory=dict)  # tag to source, where there is none
    source_map: Mapping[tuple[str, str], str] = field(default_factory=dict)  # (tag, source) to source
    renamed_prefix: tuple[str, str] = ("", "")


@dataclass
class Sources:
    """Tables that a rewrite looks up; None is an empty one.

    heads: doc, eadid, unitid, repository · concordance: ir, unitid, id, n · records: unitid, osiros_id, n ·
    names: contenu, type · files: name, s3_key, file_type."""

    heads: DataFrame | None = None
    concordance: DataFrame | None = None
    records: DataFrame | None = None
    names: DataFrame | None = None
    files: DataFrame | None = None


SHAPES = {
    "heads": "doc string, eadid string, unitid string, repository string", "concordance": "ir string, unitid string, id string, n long",
    "records": "unitid string, osiros_id string, n long", "names": "contenu string, type string", "files": "name string, s3_key string, file_type string",
}


def _table(docs: DataFrame, sources: Sources, name: str) -> DataFrame:
    found = getattr(sources, name)
    return docs.sparkSession.createDataFrame([], SHAPES[name]) if found is None else found


# ---- links ----


def entries(n: DataFrame) -> DataFrame:
    """A row per thing in a group, per link outside of groups, and per group itself (tag ``#``), of nodes with what is above.

    doc, comp (the component it is directly in, or null), box (its group, or the link itself), grouped, pos (place of the
    box), at (place in the box, ordered as an array), node, tag, href, role, inner."""
    attr = lambda name: F.try_element_at("attrs", F.lit(name)).alias(name)
    component = lambda node, tag: F.when(F.col(tag).isin(*xmltree.COMPONENTS), F.col(node))
    grouped = F.col("parent_tag").eqNullSafe("daogrp")
    comp = F.when(grouped, component("up_id", "up_tag")).otherwise(component("parent_id", "parent_tag"))
    links = n.where(grouped | F.col("tag").isin("dao", "daoloc")).select(
        "doc", comp.alias("comp"), F.when(grouped, F.col("parent_id")).otherwise(F.col("node_id")).cast("long").alias("box"), grouped.alias("grouped"),
        F.col("node_id").alias("node"), "tag", attr("href"), attr("role"), "inner",
    )
    nothing = lambda kind, name: F.lit(None).cast(kind).alias(name)
    marks = n.where("tag = 'daogrp'").select(
        "doc", component("parent_id", "parent_tag").alias("comp"), F.col("node_id").cast("long").alias("box"), F.lit(True).alias("grouped"),
        nothing("int", "node"), F.lit("#").alias("tag"), nothing("string", "href"), nothing("string", "role"), nothing("string", "inner"),
    )
    at = F.array(F.coalesce("node", F.lit(-1)).cast("long"))
    return links.unionByName(marks).select("doc", "comp", "box", "grouped", F.col("box").alias("pos"), at.alias("at"), "node", "tag", "href", "role", "inner")


def _same() -> Column:
    text = F.when(F.col("tag") == "daodesc", F.trim("inner"))
    return F.struct(F.when(F.col("tag") == "#", F.col("box")).alias("box"), text.alias("text"), F.when(text.isNull(), F.col("href")).alias("href"), F.when(text.isNull(), F.col("role")).alias("role"))


def united(e: DataFrame) -> DataFrame:
    """A component's groups as its first one, without the entries of further groups that came before."""
    own = Window.partitionBy("doc", "comp")
    lead = F.when(F.col("comp").isNotNull() & F.col("grouped"), F.min(F.when(F.col("grouped"), F.struct("pos", "box"))).over(own))
    e = e.withColumn("lead", lead).withColumn("further", F.coalesce(F.col("lead.box") != F.col("box"), F.lit(False))).withColumn("same", _same())
    before = F.row_number().over(Window.partitionBy("doc", "comp", "grouped", "same").orderBy("pos", "at")) > 1
    e = e.withColumn("before", before).where("not (further and (before or tag = '#'))")
    at = F.concat(F.array(F.when(F.col("further"), F.lit(FURTHER)).otherwise(F.lit(OWN)).cast("long"), "pos"), "at")
    return e.withColumn("at", at).withColumn("box", F.coalesce("lead.box", "box")).withColumn("pos", F.coalesce("lead.pos", "pos")).drop("lead", "further", "same", "before")


def publications(comps: DataFrame, records: DataFrame, base: str) -> DataFrame:
    """Entries, in no box yet, that link to each component's page (k 1), and to its former one (k 2) where ``records`` know it."""
    known = survive.last_per_key(records, "unitid", "osiros_id", "n")
    href = lambda c: F.concat(F.lit(base), c)
    now = comps.where("id <> ''").select("doc", "comp", F.lit(1).alias("k"), href(F.col("id")).alias("href"), F.lit(CURRENT).alias("role"))
    was = comps.where("tag = 'c'").join(known, "unitid").select("doc", "comp", F.lit(2).alias("k"), href(F.col("osiros_id")).alias("href"), F.lit(PREVIOUS).alias("role"))
    nothing = lambda kind: F.lit(None).cast(kind)
    return now.unionByName(was).select(
        "doc", "comp", nothing("long").alias("box"), F.lit(False).alias("grouped"), F.lit(BEHIND).alias("pos"), F.array(F.lit(-1).cast("long")).alias("at"),
        nothing("int").alias("node"), F.lit("daoloc").alias("tag"), "href", "role", nothing("string").alias("inner"), "k",
    )


def published(e: DataFrame) -> DataFrame:
    """With the publications among the entries (k not null) in their boxes.

    They go to a component's first group, unless it has a link of that role; else into a new one, with the first link
    outside of groups; a single one, where there is no link, stays outside."""
    own = Window.partitionBy("doc", "comp")
    old, new = F.col("k").isNull(), F.col("k").isNotNull()
    over = {
        "lead": F.min(F.when(old & F.col("grouped"), F.struct("pos", "box"))), "roles": F.collect_set(F.when(old & F.col("grouped") & (F.col("tag") == "daoloc"), F.col("role"))),
        "first": F.min(F.when(old & ~F.col("grouped") & (F.col("tag") == "dao"), F.col("node"))), "news": F.count("k"),
    }
    e = e.select("*", *(F.when(F.col("comp").isNotNull(), c.over(own)).alias(name) for name, c in over.items()))
    e = e.where(old | F.col("lead").isNull() | ~F.array_contains("roles", F.col("role")))
    made = -F.col("comp").cast("long") - 1  # a box that is new
    taken = F.coalesce(old & F.col("lead").isNull() & (F.col("news") > 0) & (F.col("node") == F.col("first")), F.lit(False))
    pick = lambda fresh, moved, name: F.when(new, fresh).when(taken, moved).otherwise(F.col(name)).alias(name)
    return e.select(
        "doc", "comp", pick(F.coalesce("lead.box", made), made, "box"), pick(F.expr("lead is not null or first is not null or news > 1"), F.lit(True), "grouped"),
        pick(F.coalesce("lead.pos", F.lit(BEHIND)), F.lit(BEHIND), "pos"), F.when(new, F.array(F.lit(PUBLISHED).cast("long"), F.col("k").cast("long"))).otherwise(F.col("at")).alias("at"),
        "node", pick(F.col("tag"), F.lit("daoloc"), "tag"), "href", "role", "inner", *(c for c in e.columns if c in FOUND),
    )


def access_role(role: Column) -> Column:
    """Images and media get the prefix of access; media by their kind."""
    kind = F.when(role == "mp3", "audio").when(role == "mp4", "video").otherwise(role)
    return F.when(role.startswith("image") | role.isin("mp3", "mp4", "pdf"), F.concat(F.lit("access:"), kind)).otherwise(role)


#: What there is for a file: keys of its masters, its spoken variant, its text.
FOUND = ("masters", "spoken", "ocr")


def with_files(e: DataFrame, files: DataFrame, renamed: tuple[str, str]) -> DataFrame:
    """Entries with what there is for their link's file (``FOUND``), looked up once for each stem and family.

    Audio is asked for by its renamed stem too."""
    order = F.coalesce(*(F.when(F.col("variant") == v, F.lit(i)) for i, v in enumerate(K.AUDIO_VARIANT_ORDER)), F.lit(len(K.AUDIO_VARIANT_ORDER)))
    held = F.array_sort(F.collect_list(F.struct(order.alias("o"), "variant", "s3_key")))
    index = catalogue.media_index(files).groupBy(F.col("stem").alias("known"), "family").agg(F.transform(held, lambda v: v["s3_key"]).alias("masters"))
    spoken = catalogue.spoken_files(files).select(F.col("stem").alias("known"), F.col("s3_key").alias("spoken"))
    texts = files.where("file_type = 'ocr xml' and s3_key is not null").groupBy(K.stem(F.col("name")).alias("stem")).agg(F.max("s3_key").alias("ocr"))
    base = K.basename(F.col("href"))
    stem, family, link = F.nullif(K.stem(base), F.lit("")), K.media_family(K.splitext_extension(base)), F.col("tag").isin(*xmledit.LINKS)
    hrefs = written(e.where(link).select("href").distinct().select(stem.alias("stem"), family.alias("family")), "files-named")
    wanted = hrefs.where("stem is not null and family is not null").distinct()
    tries = wanted.withColumn("known", F.col("stem")).withColumn("turn", F.lit(1))
    if renamed[0]:
        tries = tries.unionByName(wanted.where("family = 'audio'").withColumn("known", K.renamed(F.col("stem"), *renamed)).withColumn("turn", F.lit(2)))
    hits = tries.join(index, ["known", "family"]).groupBy("stem", "family").agg(F.min_by(F.struct("known", "masters"), "turn").alias("hit")).select("stem", "family", "hit.known", "hit.masters")
    heard = hits.where("family = 'audio'").join(spoken, "known").select("stem", "family", "spoken")
    read = wanted.where("family in ('image', 'pdf')").join(texts, "stem").select("stem", "family", "ocr")
    found = written(hits.drop("known").join(heard, ["stem", "family"], "left").join(read, ["stem", "family"], "full"), "files-found")
    return e.withColumn("stem", stem).withColumn("family", F.when(link, family)).join(found, ["stem", "family"], "left").drop("stem", "family")


def masters(e: DataFrame) -> DataFrame:
    """With links to the master files and texts found for each link's file; the link itself moves to the masters' folder.

    Where the spoken variant of audio is there, the link leads to that."""
    first = F.col("masters")[0]
    moved = F.coalesce("spoken", F.concat(F.regexp_extract(first, "^(.*/)[^/]*$", 1), K.basename(F.col("href"))))
    kept_role = F.coalesce("role", F.lit(""))
    master_role = F.when(F.contains(kept_role, F.lit("access:")), F.concat(F.regexp_extract(kept_role, "^(.*?)access:", 1), F.lit("preservation:"), F.regexp_extract(kept_role, "^.*?access:(.*)$", 1))).otherwise(kept_role)
    link = lambda href, role: F.struct(href.alias("href"), role.alias("role"))
    no = F.array().cast("array<struct<href:string,role:string>>")
    added = F.concat(F.coalesce(F.transform("masters", lambda key: link(key, F.col("master_role"))), no), F.when(F.col("ocr").isNotNull(), F.array(link(F.col("ocr"), F.lit(OCR)))).otherwise(no))
    takes = F.col("grouped") & (F.col("tag") == "daoloc") | ~F.col("grouped") & (F.col("tag") == "dao")
    e = e.withColumn("master_role", master_role).withColumn("added", F.when(takes, added).otherwise(no))
    here = F.struct(F.lit(None).cast("int").alias("k"), F.when(F.col("masters").isNotNull(), moved).otherwise(F.col("href")).alias("href"), F.col("role").alias("role"))
    more = F.transform("added", lambda x, k: F.struct(k.alias("k"), x["href"].alias("href"), x["role"].alias("role")))
    e = e.select("doc", "comp", "box", (F.col("grouped") | (F.size("added") > 0)).alias("grouped"), "pos", "at", "node", "tag", "inner", F.explode(F.concat(F.array(here), more)).alias("x"))
    own = F.col("x.k").isNull()
    mine = lambda name: F.when(own, F.col(name)).alias(name)
    return e.select(
        "doc", "comp", "box", "grouped", "pos", F.when(own, F.col("at")).otherwise(F.concat(F.array(F.lit(MASTERS).cast("long")), "at", F.array(F.col("x.k").cast("long")))).alias("at"),
        mine("node"), F.when(own, F.col("tag")).otherwise("daoloc").alias("tag"), "x.href", "x.role", mine("inner"),
    )


def group_rank() -> Column:
    """Description, preservation, access, publication, others."""
    prefixes = ("preservation", "access", "publication")
    ranks = (F.when(F.col("role").startswith(p), F.lit(i + 1)) for i, p in enumerate(prefixes))
    return F.when(F.col("tag") == "daodesc", F.lit(0)).otherwise(F.coalesce(*ranks, F.lit(len(prefixes) + 1)))


def rewritten_links(n: DataFrame, comps: DataFrame, sources: Sources, rules: Rules) -> DataFrame:
    """What the links of the documents become: entries with ``position`` in their box, from 1.

    ``comps``: doc, comp, tag, id, unitid (as written).  Groups are united, publications added, roles prefixed, masters
    added, groups united again and sorted.  All rows that this takes are gathered by document once; its windows and
    aggregates then only sort."""
    e = entries(n).withColumn("k", F.lit(None).cast("int")).unionByName(publications(comps, _table(n, sources, "records"), rules.link_base))
    e = published(united(with_files(e, _table(n, sources, "files"), rules.renamed_prefix).repartition("doc")))
    e = e.withColumn("role", F.when(F.col("tag").isin(*xmledit.LINKS), access_role(F.col("role"))).otherwise(F.col("role")))
    e = united(masters(e)).withColumn("rank", group_rank())
    place = F.row_number().over(Window.partitionBy("doc", "box").orderBy(F.col("tag") == "#", "rank", "at"))
    return e.withColumn("position", F.when(F.col("tag") != "#", place))


# ---- names, ids ----


def name_tags(n: DataFrame, names: DataFrame) -> DataFrame:
    """Names in originations, which move to the terms of their component (comp), and names among terms (comp null): doc,
    node, tag, comp.  Of a name in both lists the list of persons counts in originations, that of bodies among terms."""
    known = names.where("contenu is not null").groupBy("contenu").agg(F.bool_or(F.col("type") == "persname").alias("person"), F.bool_or(F.col("type") == "corpname").alias("body"))
    said = n.where("tag in ('name', 'persname')").select("doc", "node_id", "tag", F.trim("text").alias("contenu"))
    spans = lambda tag: n.where(F.col("tag") == tag).select("doc", F.col("node_id").alias("lo"), F.col("last_id").alias("hi"), "parent_id", F.col("up_id").alias("comp"))
    origins = spans("origination").where("parent_id is not null").drop("parent_id")
    among = lambda s: (said["doc"] == s["doc"]) & (said["node_id"] > s["lo"]) & (said["node_id"] <= s["hi"])
    moved = said.join(origins, among(origins)).groupBy(said["doc"], "node_id", "tag", "contenu").agg(F.max("comp").alias("comp"))
    access = spans("controlaccess").drop("parent_id", "comp")
    inside = said.where("tag = 'name'").join(access, among(access), "left_semi").join(moved.select("doc", "node_id"), ["doc", "node_id"], "left_anti")
    both = moved.unionByName(inside.withColumn("comp", F.lit(None).cast("int"))).join(known, "contenu", "left")
    person, body = F.when(F.col("person"), "persname"), F.when(F.col("body"), "corpname")
    tag = F.when(F.col("tag") != "name", F.col("tag")).otherwise(F.when(F.col("comp").isNotNull(), F.coalesce(person, body, F.lit("name"))).otherwise(F.coalesce(body, person, F.lit("name"))))
    return both.select("doc", F.col("node_id").alias("node"), tag.alias("tag"), "comp")


def with_ids(n: DataFrame, sources: Sources, rules: Rules) -> DataFrame:
    """Components as written with their id, old or new: doc, comp, tag, unitid, id, made (a new one that is to be stored).

    Those without an id take the stored ids of their unitid in order; the others get new ones that none has."""
    comps = xmltree.components(n, trimmed=False).select("doc", F.col("comp_id").alias("comp"), "tag", "unitid", F.nullif("id", F.lit("")).alias("id"))
    heads = _table(n, sources, "heads").select("doc", F.col("eadid").alias("ir"))
    comps = written(comps.join(heads, "doc", "left").withColumn("mark", F.nullif(F.trim("unitid"), F.lit(""))), "components")
    stored = _table(n, sources, "concordance").select("ir", F.col("unitid").alias("mark"), F.col("id").alias("stored"), "n")
    lack = I.aligned_ids(comps.where("id is null and mark is not null").drop("id"), stored, ["ir", "mark"], ["doc", "comp"], ["n"], "stored")
    lack = written(lack.unionByName(comps.where("id is null and mark is null").drop("id"), allowMissingColumns=True), "components-without-id")
    taken = comps.where("id is not null").select("id").unionByName(stored.select(F.col("stored").alias("id")))
    new = I.new_ids(lack.where("stored is null").drop("stored"), taken, rules.id_prefix, rules.epoch, ["doc", "comp"])
    columns = ["doc", "comp", "tag", "unitid"]
    out = comps.where("id is not null").select(*columns, "id", F.lit(False).alias("made"))
    out = out.unionByName(lack.where("stored is not null").select(*columns, F.col("stored").alias("id"), F.lit(False).alias("made")))
    return out.unionByName(new.select(*columns, "id", F.col("mark").isNotNull().alias("made")))


# ---- the writer ----

ENTRY = "struct<position:int,node:int,href:string,role:string>"
BOXES = f"array<struct<comp:int,box:long,grouped:boolean,entries:array<{ENTRY}>>>"
TAGS = "array<struct<node:int,tag:string,comp:int>>"
IDS = "array<struct<comp:int,id:string>>"


def _write_box(nodes: list[Element], box: dict) -> Element:
    """Put the entries of a box where they belong; returns the group, or the single link."""
    at = box["box"]
    old = nodes[at] if at >= 0 else None
    put = lambda made: xmledit.put(nodes[box["comp"]], made, "c", "dsc")
    if not box["grouped"]:
        [x] = box["entries"]
        attrs = {k: x[k] for k in ("href", "role") if x[k] is not None}
        if old is None:
            return put(Element("dao", attrs))
        old.attrs.update(attrs)
        return old
    group = old if old is not None and old.tag == "daogrp" else Element("daogrp")
    if old is None:
        put(group)
    elif group is not old:
        old.parent.insert_before(group, old)
    order = []
    for x in box["entries"]:
        mine = nodes[x["node"]] if x["node"] is not None else None
        attrs = (dict(mine.attrs) if mine is not None else {}) | {k: x[k] for k in ("href", "role") if x[k] is not None}
        if mine is not None and mine.parent is group:
            if attrs != mine.attrs:
                mine.attrs.update(attrs)
        else:
            grouped = mine is not None and mine.parent.tag == "daogrp"
            if mine is not None:
                mine.parent.remove(mine)
            if grouped:
                mine.attrs.update(attrs)
            else:
                mine = Element("daoloc", attrs)
            group.append(mine)
        order.append(mine)
    held = set(map(id, order))
    group.order_children([*order, *(c for c in group.children() if id(c) not in held)])
    return group


def carry_out(d: Document, ids: list[dict], tags: list[dict], boxes: list[dict], rules: Rules) -> None:
    """An edit script on a document whose nodes are numbered in document order."""
    root = d.root
    nodes = list(root.iter())
    for x in sorted(tags, key=lambda x: x["node"]):
        e = nodes[x["node"]]
        if x["comp"] is None:
            e.tag = x["tag"]
            continue
        component = nodes[x["comp"]]
        access = component.find("controlaccess") or component.append(Element("controlaccess"))
        e.parent.remove(e)
        term = Element(x["tag"], e.attrs)
        term.text = e.text
        access.append(term)
    for e in nodes:
        if e.tag == "origination" and e.parent is not None and xmledit.is_empty(e):
            e.parent.remove(e)
    for x in ids:
        nodes[x["comp"]].attrs["id"] = x["id"]
    kept: dict[int, list] = {}
    for box in sorted(boxes, key=lambda b: (b["box"] < 0, b["box"])):
        kept.setdefault(box["comp"], []).append(_write_box(nodes, box))
    for comp, places in kept.items():  # what went into other groups, or was there already, goes
        for c in nodes[comp].children() if comp is not None else ():
            if c.tag in ("daogrp", "dao") and not any(c is x for x in places):
                nodes[comp].remove(c)
    xmledit.remove_repositories(root)
    xmledit.set_term_sources(root, rules.term_sources, rules.source_map)
    xmledit.remove_empty(root)


def _each(b: pa.RecordBatch) -> Iterator[dict]:
    """Rows one at a time: a document's edit script takes many times its bytes as Python objects."""
    for i in range(b.num_rows):
        yield from b.slice(i, 1).to_pylist()


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for row in _each(b):
            try:
                d = Document.load(row["content"] or b"")
                xmledit.set_head(d.root, {k: row[k] for k in ("eadid", "unitid", "repository")})
                xmledit.decode_entities(d.root)
                xmledit.strip_terms(d.root)
                rows.append((row["doc"], d.to_bytes(), None))
            except Exception as e:  # noqa: BLE001 - one document's failure is its row's error
                rows.append((row["doc"], None, f"{type(e).__name__}: {e}"[:500]))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.binary(), pa.string()))], ["doc", "content", "error"])


def _finished(rules: Rules, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for row in _each(b):
            content, error = None, row["error"]
            if error is None:
                try:
                    d = Document.load(row["content"])
                    carry_out(d, row["ids"] or [], row["tags"] or [], row["boxes"] or [], rules)
                    content = d.to_bytes()
                except Exception as e:  # noqa: BLE001 - one document's failure is its row's error
                    error = f"{type(e).__name__}: {e}"[:500]
            rows.append((row["doc"], content, error))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.binary(), pa.string()))], ["doc", "content", "error"])


SHAPE = "doc string, content binary, error string"


def prepared(docs: DataFrame, sources: Sources) -> DataFrame:
    """(doc, content, error) with new heads, plain references and terms without blanks around them, written."""
    heads = _table(docs, sources, "heads")
    with_heads = docs.select("doc", "content").join(heads, "doc", "left")
    bounded_batches(docs)
    return written(with_heads.mapInArrow(_prepared, SHAPE), "prepared", texts=True)


def rewrite_all(docs: DataFrame, sources: Sources, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Rewritten ``docs`` (doc, content): (doc, content, error), written, and the new ids (doc, unitid, id) for the concordance.

    A document that fails keeps its error and has no content."""
    ready = prepared(docs, sources)
    n = written(xmltree.nodes(ready.where("error is null"), above=True), "nodes")
    comps = written(with_ids(n, sources, rules), "ids")
    rows = rewritten_links(n, comps, sources, rules)
    one = F.struct(F.col("position").cast("int").alias("position"), "node", "href", "role")
    boxes = rows.groupBy("doc", "comp", "box").agg(F.bool_or("grouped").alias("grouped"), F.array_sort(F.collect_list(F.when(F.col("tag") != "#", one))).alias("entries"))
    boxes = boxes.groupBy("doc").agg(F.collect_list(F.struct("comp", "box", "grouped", "entries")).alias("boxes"))
    tags = name_tags(n, _table(n, sources, "names")).groupBy("doc").agg(F.collect_list(F.struct("node", "tag", "comp")).alias("tags"))
    new = comps.groupBy("doc").agg(F.collect_list(F.struct("comp", "id")).alias("ids"))
    full = ready.join(boxes, "doc", "left").join(tags, "doc", "left").join(new, "doc", "left")
    full = full.select("doc", "content", "error", F.col("ids").cast(IDS).alias("ids"), F.col("tags").cast(TAGS).alias("tags"), F.col("boxes").cast(BOXES).alias("boxes"))
    out = written(full.mapInArrow(functools.partial(_finished, rules), SHAPE), "rewritten", texts=True)
    discard(n)
    discard(ready)
    return out, comps.where("made").select("doc", F.trim("unitid").alias("unitid"), "id")
