"""Catalogue jobs: lookups for rewrites, the diagnosis of links against the file reference, generated finding aids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cartulary.functions import keys as K, ranges as R
from cartulary.operators import matching, survive, xmltree
from cartulary.operators.materialise import discard, written


def media_index(files: DataFrame) -> DataFrame:
    """stem, family, variant, s3_key, ext: of each, the file of the best extension, first by name and key."""
    f = _media(files)
    order = [e for exts in K.FAMILIES.values() for e in exts]
    return survive.best_format(f, ["stem", "family", "variant"], "ext", order, ["name", "s3_key"]).select("stem", "family", "variant", "s3_key", "ext")


def _media(files: DataFrame) -> DataFrame:
    """Files with a key, one per name, with stem (an audio variant cut off), family, variant and extension."""
    named = survive.first_per_key(files.where("s3_key is not null"), ["name"], ["s3_key"])
    ext = F.lower(K.splitext_extension(K.basename(F.col("s3_key"))))
    audio = F.col("family") == "audio"
    f = named.select("name", "s3_key", ext.alias("ext"), K.stem(F.col("name")).alias("_stem")).withColumn("family", K.media_family(F.col("ext"))).where("family is not null")
    return f.withColumn("variant", F.when(audio, F.regexp_extract("_stem", K.AUDIO_VARIANT, 1)).otherwise("")).withColumn(
        "stem", F.when(audio, K.strip_audio_variant(F.col("_stem"))).otherwise(F.col("_stem"))
    )


def spoken_files(files: DataFrame) -> DataFrame:
    """stem, s3_key: the MP3 of the variant TI of each stem, the last by key."""
    return _media(files).where("upper(variant) = 'TI' and ext = '.mp3'").groupBy("stem").agg(F.max("s3_key").alias("s3_key"))


def finding_aid_names(lists: DataFrame, source: str) -> DataFrame:
    """New file name to the finding aid it came from (new_name, finding_aid), by the newest list that there is.

    lists: list (its name, which ends in its date), position, nom_fichier, nouveau_nom_fichier; of a new name's several
    sources the first by position."""
    newest = lists.agg(F.max("list").alias("list"))
    rows = lists.join(newest, "list", "left_semi").where("nom_fichier is not null and nouveau_nom_fichier is not null")
    first = rows.groupBy(F.col("nouveau_nom_fichier").alias("new_name")).agg(F.min_by("nom_fichier", "position").alias("old"))
    return first.select("new_name", F.concat(F.lit(source + "_"), K.stem(F.col("old")), F.lit(".xml")).alias("finding_aid"))


def extract_all(sources: dict[str, DataFrame], roles: dict[str, Sequence[str]] | None = None, names: DataFrame | None = None) -> DataFrame:
    """Links of the documents of several sources, one below the other; documents with "test" in their name are left out.

    ``names`` (new_name, finding_aid) gives the finding aid of documents that were renamed."""
    out = None
    for source, docs in sources.items():
        n = xmltree.nodes(docs.where(~F.contains(F.lower("doc"), F.lit("test"))))
        part = xmltree.expanded_links(n, source, (roles or {}).get(source))
        out = part if out is None else out.unionByName(part)
    if names is not None:
        known = names.select(F.col("new_name").alias("ir"), F.col("finding_aid").alias("_old"))
        out = out.join(known, "ir", "left").withColumn("finding_aid", F.coalesce("_old", "finding_aid")).drop("_old").select(*out.columns)
    return out


def check_ranges(members: DataFrame, files: DataFrame) -> DataFrame:
    """Expanded members (columns with href) with whether the reference and the object store have the file.

    Files count by name alone; of equal names one with a key stands."""
    one = survive.first_per_key(files.select("name", "uuid", "s3_key"), ["name"], [F.col("s3_key").asc_nulls_last(), "uuid"])
    hit = members.withColumn("name", K.basename(F.col("href"))).join(one, "name", "left")
    return hit.select(*members.columns, F.col("uuid").isNotNull().alias("dans_ref"), F.col("s3_key").isNotNull().alias("sur_s3"))


def range_gaps(checked: DataFrame, keys: Sequence[str] = ("ir", "id_composant", "role")) -> DataFrame:
    """Preservation ranges with how many members are there; blank component ids are left out."""
    from cartulary.operators.aggregates import percent

    known = checked.where(F.col("role").startswith("preservation:"))
    for k in keys:
        known = known.where(F.nullif(F.col(k), F.lit("")).isNotNull())
    first = F.min(F.when(F.col("position") == "first", F.col("href")))
    last = F.max(F.when(F.col("position") == "last", F.col("href")))
    g = known.groupBy(*keys).agg(first.alias("href_first"), last.alias("href_last"), F.count("*").alias("total"), F.count_if(F.col("dans_ref")).alias("presents"))
    return g.withColumn("taux", percent(F.col("presents"), F.col("total"))).withColumn("manquants", F.col("total") - F.col("presents"))


def associate(links: DataFrame, files: DataFrame, rename: tuple[str, str]) -> DataFrame:
    """Association table file - unitid: the deepest component of each link, stems matched in three tiers."""
    l = links.where("href_base <> '' and nullif(unitid, '') is not null")
    l = survive.at_group_maximum(l, ["href_base", "ir"], "profondeur").withColumn("stem", K.strip_media(K.stem(F.col("href_base"))))
    f = files.where("uuid is not null").withColumn("stem", K.strip_media(K.stem(F.col("name"))))
    renamed = lambda c: K.renamed(c, *rename) if rename[0] else c
    tiers = [("exacte", lambda c: c), ("normalisee", lambda c: K.normalise(renamed(c))), ("padding", lambda c: K.unpad(K.normalise(renamed(c))))]
    pairs = matching.tiered(l, f, tiers)
    return matching.fan_out(pairs, l, f.select("uuid", "name", F.col("stem").alias("file_stem")), "stem", "file_stem", ["uuid", "name", "source", "finding_aid", "unitid", "methode"])


def orphan_candidates(orphans: DataFrame, files: DataFrame) -> DataFrame:
    """Candidates in the reference for links without a master, by the strictest key that agrees."""
    o = orphans.withColumn("fam", K.role_family(F.col("role"))).withColumn("stem", K.strip_media(K.stem(K.basename(F.col("href"))), K.ALL_MEDIA_EXTENSIONS, repeated=True))
    ext = F.lower(K.splitext_extension(F.col("name")))
    r = files.select(
        K.strip_media(K.stem(F.col("name")), K.ALL_MEDIA_EXTENSIONS, repeated=True).alias("stem"), K.media_family(ext).alias("fam"), F.col("uuid").alias("ref_id"), ext.isin(".tif", ".tiff").alias("is_master")
    )
    bare = lambda c: K.strip_audio_variant(c)
    keys = [("exacte", bare), ("normalisee", lambda c: K.normalise(bare(c))), ("padding", lambda c: K.unpad(K.normalise(bare(c))))]
    return matching.loosest_then_classify(o, r, "fam", keys).join(files.select(F.col("uuid").alias("ref_id"), F.col("name").alias("ref_name"), F.col("path").alias("ref_path"), "conservation_statut", "s3_key"), "ref_id", "left")


def expand_bounds(n: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Expanded ranges (preservation beats access) and ambiguous ranges."""
    rows = xmltree.expanded_links(n, "ir", preserved_first=True).where("position <> 'isole'")
    vague = F.col("role").endswith(":ambigu")
    return rows.where(~vague), rows.where(vague)


def _xml(tag: str, inside: Column, **attrs: Column) -> Column:
    esc = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    parts = [F.lit(f"<{tag}")]
    for k, v in attrs.items():
        parts += [F.lit(f' {k}="'), esc(v), F.lit('"')]
    return F.concat(*parts, F.lit(">"), inside, F.lit(f"</{tag}>"))


def _text(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _files(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per unit its group of links, pages in order, image before text."""
    ext = F.lower(K.splitext_extension(F.col("name")))
    role = F.when(ext == ".tif", "preservation:image").otherwise("preservation:ocr")
    link = _xml("daoloc", F.lit(""), href=K.preferred_href(F.col("s3_key"), F.col("path"), F.col("name")), role=role)
    item = F.struct(K.page_number(F.col("name")).alias("p"), (ext != ".tif").alias("t"), F.col("name"), link.alias("x"))
    listed = F.array_sort(F.collect_list(item))
    group = _xml("daogrp", F.array_join(F.transform(listed, lambda i: i["x"]), ""))
    return df.groupBy(*keys).agg(group.alias("group"), F.min("path").alias("path"))


def _unit(level: str, title: Column, normal: Column | None, inside: Column, unitid: Column | None = None, dated: Column | None = None, identity: Column | None = None) -> Column:
    did = [_xml("unittitle", _text(title))]
    if unitid is not None:
        did.append(_xml("unitid", _text(unitid)))
    if normal is not None:
        did.append(F.coalesce(_xml("unitdate", _text(dated if dated is not None else title), normal=normal), F.lit("")))
    return _xml("c", F.concat(_xml("did", F.concat(*did)), inside), id=identity if identity is not None else F.lit(""), level=F.lit(level))


def press_finding_aid(files: DataFrame, identity: Column) -> DataFrame:
    """(corpus_code, dsc): years, months and issues of dated files (corpus_code, unitid, name, path, s3_key).

    ``identity`` makes a component's id from the column ``key``."""
    dated = files.distinct().withColumn("d", K.date_parts(F.col("unitid"))).where("d is not null")
    issue = _files(dated.withColumn("y", F.col("d.year")).withColumn("m", F.col("d.month")).withColumn("day", F.col("d.day")), ["corpus_code", "y", "m", "day", "unitid"])
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    date = K.long_date(F.col("y"), F.col("m"), F.col("day"))
    normal = F.concat_ws("-", F.col("y").cast("string"), two(F.col("m")), two(F.col("day")))
    issue = issue.withColumn("key", F.concat_ws("|", "corpus_code", "unitid")).withColumn("x", _unit("file", date, normal, F.col("group"), F.col("unitid"), identity=identity))
    joined = lambda order: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "x"))), lambda i: i["x"]), "")
    month = issue.groupBy("corpus_code", "y", "m").agg(joined("unitid").alias("inside"))
    name = F.concat_ws(" ", F.get(F.array(*map(F.lit, K.MONTHS)), F.col("m") - 1), F.col("y").cast("string"))
    month = month.withColumn("key", F.concat_ws("|", "corpus_code", "y", "m")).withColumn("x", _unit("subseries", name, F.concat_ws("-", F.col("y").cast("string"), two(F.col("m"))), F.col("inside"), identity=identity))
    year = month.groupBy("corpus_code", "y").agg(joined("m").alias("inside"))
    y = F.col("y").cast("string")
    year = year.withColumn("key", F.concat_ws("|", "corpus_code", y)).withColumn("x", _unit("series", y, F.concat(y, F.lit("-01-01/"), y, F.lit("-12-31")), F.col("inside"), identity=identity))
    return year.groupBy("corpus_code").agg(joined("y").alias("dsc"))


def _register_units(files: DataFrame, identity: Column) -> DataFrame:
    """(corpus_code, o, unitid, x): one file component per shelf-mark, by its first number, dated by its folder's span."""
    units = _files(files.withColumn("unitid", K.shelfmark(F.col("unitid"))).distinct(), ["corpus_code", "unitid"])
    span = K.year_span(F.col("path"))
    normal = F.concat(span["first"], F.lit("-01-01/"), span["last"], F.lit("-12-31"))
    said = F.when(span["first"] == span["last"], span["first"]).otherwise(F.concat_ws("-", span["first"], span["last"]))
    x = _unit("file", F.col("unitid"), normal, F.col("group"), F.col("unitid"), said, identity)
    rows = units.withColumn("key", F.concat_ws("|", "corpus_code", "unitid")).withColumn("x", x).withColumn("o", K.first_number(F.col("unitid")))
    return rows.select("corpus_code", "o", "unitid", "x")


def _register_list() -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "unitid", "x"))), lambda i: i["x"]), "")


def register_finding_aid(files: DataFrame, identity: Column) -> DataFrame:
    """(corpus_code, dsc): the file components of a corpus in one text; ``register_parts`` has those that are too long for that."""
    return _register_units(files, identity).groupBy("corpus_code").agg(_register_list().alias("dsc"))


def register_parts(files: DataFrame, identity: Column) -> DataFrame:
    """(corpus_code, part, dsc), written: ``dsc`` of ``register_finding_aid`` in the order of part, up to 1024 components in each.

    Components are sorted by ranges, so that no task holds a corpus."""
    order = ["corpus_code", "o", "unitid"]
    units = written(_register_units(files, identity), "register-units")
    # partition numbers stand far above row numbers, so that no part holds rows of two partitions
    rows = units.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.shiftright(F.monotonically_increasing_id(), 10))
    parts = written(rows.groupBy("corpus_code", "part").agg(_register_list().alias("dsc")), "register-parts")
    discard(units)
    return parts


def whole_document(eadid: Column, title: Column, dsc: Column, identity: Column, publisher: str) -> Column:
    """A finding aid as text around its components."""
    head = _xml("eadheader", F.concat(_xml("eadid", _text(eadid)), _xml("filedesc", F.concat(_xml("titlestmt", _xml("titleproper", _text(title))), _xml("publicationstmt", _xml("publisher", _text(F.lit(publisher))))))))
    body = _xml("archdesc", F.concat(_xml("did", F.concat(_xml("unittitle", _text(title)), _xml("unitid", _text(eadid), identifier=eadid))), _xml("dsc", dsc, type=F.lit("in-depth"))), level=F.lit("collection"), id=identity)
    return F.concat(F.lit("<?xml version='1.0' encoding='UTF-8'?>\n"), _xml("ead", F.concat(head, body), audience=F.lit("external")), F.lit("\n"))
