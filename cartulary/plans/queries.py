"""Registered queries of the reconciliation operators on the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cartulary.functions import keys as K, measures as M, ranges as R
from cartulary.operators import aggregates as A, enrich, ids, linkage, matching, sampling, survive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str) -> F.Column:
    return F.col(c).cast("decimal(18,2)")


# ---- scans, filters, projections ----


@query("SELECT p_partkey, p_name FROM part WHERE p_name IS NULL OR NOT (right(p_name, 3) IN ('.db', 'lnk'))")
def q_filter_suffix(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name").where(~K.is_junk(F.col("p_name")))


_FLAGGED = "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'True' WHEN 1 THEN ' true ' WHEN 2 THEN 'false' WHEN 3 THEN NULL ELSE 'no' END AS f FROM orders"


@query(f"SELECT o_orderkey FROM ({_FLAGGED}) WHERE NOT coalesce(lower(trim(f)) = 'true', false)")
def q_flag_filter_text(spark, sf):
    m = F.col("o_orderkey") % 5
    f = F.when(m == 0, "True").when(m == 1, " true ").when(m == 2, "false").when(m == 3, F.lit(None)).otherwise("no")
    return survive.to_transfer(table(spark, sf, "orders").select("o_orderkey", f.alias("f")), "f").select("o_orderkey")


@query(
    "SELECT part, count(*) AS n FROM (SELECT CASE WHEN nullif(c_mktsegment, 'MACHINERY') IS NOT DISTINCT FROM 'BUILDING' THEN 'az' ELSE 'other' END AS part FROM customer) GROUP BY part"
)
def q_partition_null_safe(spark, sf):
    c = table(spark, sf, "customer").select(F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("seg"))
    a, b = linkage.partition_source(c, "seg", "BUILDING")
    return a.select(F.lit("az").alias("part")).unionByName(b.select(F.lit("other").alias("part"))).groupBy("part").agg(F.count("*").alias("n"))


_EXT = "CASE p_partkey % 12 WHEN 0 THEN '.jpg' WHEN 1 THEN '.jp2' WHEN 2 THEN '.tif' WHEN 3 THEN '.txt' WHEN 4 THEN '.pdf' WHEN 5 THEN '.xml' WHEN 6 THEN '.alto' WHEN 7 THEN '.mp4' WHEN 8 THEN '.MTS' WHEN 9 THEN '.mp3' WHEN 10 THEN '.zip' ELSE '' END"
_TYPE = "CASE p_partkey % 12 WHEN 0 THEN 'jpeg' WHEN 1 THEN 'jpeg2000' WHEN 2 THEN 'tiff' WHEN 3 THEN 'ocr txt' WHEN 4 THEN 'pdf' WHEN 5 THEN 'ocr xml' WHEN 6 THEN 'ocr xml' WHEN 7 THEN 'video' WHEN 8 THEN 'video' WHEN 9 THEN 'audio' ELSE 'autre' END"


def _with_extension(spark, sf):
    ends = [".jpg", ".jp2", ".tif", ".txt", ".pdf", ".xml", ".alto", ".mp4", ".MTS", ".mp3", ".zip", ""]
    ext = F.get(F.array(*map(F.lit, ends)), (F.col("p_partkey") % 12).cast("int"))
    return table(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice", F.concat(F.lit("f_"), F.col("p_partkey").cast("string"), ext).alias("name"))


@query(f"SELECT p_partkey, 'f_' || p_partkey || {_EXT} AS name, nullif({_EXT}, '') AS extension, {_TYPE} AS file_type FROM part")
def q_file_type(spark, sf):
    name = F.col("name")
    return _with_extension(spark, sf).select("p_partkey", "name", K.last_extension(name).alias("extension"), K.file_type(K.mime_type(name), K.last_extension(name)).alias("file_type"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE left(strftime(o_orderdate, '%Y-%m-%d'), 4) = '1996'")
def q_year_prefix(spark, sf):
    o = table(spark, sf, "orders").withColumn("d", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return linkage.new_files(o, "d", "d", 1996)[0].select("o_orderkey", "o_orderdate")


@query("SELECT p_type, count(*) AS n FROM part WHERE contains(p_type, 'AND') OR contains(p_type, 'MED') OR starts_with(p_type, 'PROMO') GROUP BY p_type")
def q_contains_any(spark, sf):
    t = F.col("p_type")
    return table(spark, sf, "part").where(K.contains_any(t, ["AND", "MED"]) | F.coalesce(t.startswith("PROMO"), F.lit(False))).groupBy("p_type").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, CAST(round_even(CAST(p_size AS DOUBLE) * 1000 / 12, 0) AS BIGINT) AS jpeg, CAST(round_even(CAST(p_size AS DOUBLE) * 1000 / 15, 0) AS BIGINT) AS jp2, round_even(p_size * 1234567.0 / 1048576, 2) AS mo FROM part")
def q_size_estimates(spark, sf):
    s = F.col("p_size") * 1000
    return table(spark, sf, "part").select("p_partkey", M.estimate(s, 12).alias("jpeg"), M.estimate(s, 15).alias("jp2"), M.convert_size(F.col("p_size") * F.lit(1234567.0), 2).alias("mo"))


@query(
    "SELECT p_partkey, scale, CAST(round_even(w * scale, 0) AS BIGINT) AS new_width, CAST(round_even(w * 2 * scale, 0) AS BIGINT) AS new_height, CAST(round_even(300 * scale, 0) AS BIGINT) AS new_dpi "
    "FROM (SELECT *, CASE WHEN w IS NOT NULL THEN least(1.0, greatest(0.5, 2000.0 / w)) END AS scale FROM (SELECT p_partkey, CAST(CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_size * 131 END AS DOUBLE) AS w FROM part))"
)
def q_resolution_formula(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 10 != 0, F.col("p_size") * 131).cast("double").alias("w"))
    return p.select("p_partkey", *M.reduced(F.col("w"), F.col("w") * 2, F.lit(300), 0.5))


@query("SELECT page_id, split_part(url, '/', 1) AS path0, split_part(url, '/', 2) AS path1, split_part(url, '/', 3) AS path2, nullif(substr(url, length(split_part(url, '/', 1) || '/' || split_part(url, '/', 2) || '/' || split_part(url, '/', 3) || '/') + 1), '') AS path3 FROM pages")
def q_split_path(spark, sf):
    cols = K.split_path(F.col("url"), 3)
    return table(spark, sf, "pages").select("page_id", *cols[:3], F.nullif(cols[3], F.lit("")).alias("path3"))


@query(
    "SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, regexp_replace(left(url, length(url) - length(regexp_extract(url, '([^/]*)$', 1))), '/+$', '') AS folder, "
    "CASE WHEN regexp_matches(regexp_extract(url, '([^/]*)$', 1), '^\\.*[^.].*\\.[^.]*$') THEN regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^(\\.*[^.].*)\\.[^.]*$', 1) ELSE regexp_extract(url, '([^/]*)$', 1) END AS stem FROM pages"
)
def q_path_functions(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select("page_id", K.basename(u).alias("base"), K.dirname(u).alias("folder"), K.stem(K.basename(u)).alias("stem"))


@query(r"SELECT p_partkey, trim(regexp_replace(replace(replace(p_name, ' ', '_ '), '_', ' '), '\s+', ' ', 'g')) AS mark, regexp_replace(lower(replace(p_brand, '#', '-00')), '(^|[^0-9])0+([0-9])', '\1\2', 'g') AS key FROM part")
def q_shelfmark(spark, sf):
    key = K.unpad(F.lower(F.replace("p_brand", F.lit("#"), F.lit("-00"))))
    return table(spark, sf, "part").select("p_partkey", K.shelfmark(F.replace("p_name", F.lit(" "), F.lit("_ "))).alias("mark"), key.alias("key"))


@query("SELECT event_id, strftime(to_timestamp(epoch(ts)) AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS number, CAST(NULL AS INTEGER) AS bad FROM events")
def q_dates(spark, sf):
    e = table(spark, sf, "events")
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    return e.select("event_id", M.epoch_day(seconds).alias("day"), M.day_number(F.col("ts").cast("string")).alias("number"), M.day_number(F.concat(F.lit("x"), F.col("event_type"))).alias("bad"))


@query(
    r"SELECT o_orderkey, coalesce(nullif(regexp_extract(s, '^XX_([a-zA-Z0-9]+_[a-zA-Z0-9]+)_[a-zA-Z0-9]+', 1), ''), nullif(regexp_extract(s, '^([a-zA-Z0-9]+_[a-zA-Z0-9]+)_[a-zA-Z0-9]+', 1), ''), 'INCONNU') AS root, "
    r"coalesce(try_cast(nullif(regexp_extract(s || '.tif', '_(\d+)\.\w+$', 1), '') AS INTEGER), 0) AS page FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'XX_' WHEN 1 THEN '' ELSE '-' END || replace(o_orderpriority, '-', '_') || '_' || o_orderstatus || '_' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS s FROM (SELECT *  REPLACE (regexp_replace(o_orderpriority, '[^A-Za-z0-9-]', '', 'g') AS o_orderpriority) FROM orders))"
)
def q_fonds_root(spark, sf):
    p = F.replace(F.regexp_replace("o_orderpriority", "[^A-Za-z0-9-]", ""), F.lit("-"), F.lit("_"))
    lead = F.when(F.col("o_orderkey") % 3 == 0, "XX_").when(F.col("o_orderkey") % 3 == 1, "").otherwise("-")
    s = F.concat(lead, p, F.lit("_"), F.col("o_orderstatus"), F.lit("_"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"))
    return table(spark, sf, "orders").select("o_orderkey", K.collection_root(s, "XX_").alias("root"), K.page_number(F.concat(s, F.lit(".tif"))).alias("page"))


@query(
    r"SELECT p_partkey, nullif(regexp_extract('img_' || p_partkey || '_jp2_q' || p_size || CASE WHEN p_partkey % 2 = 0 THEN '_f50_rmin2000' ELSE '' END, '([a-z0-9]+_q\d+(?:_f\d+_rmin\d+)?)$', 1), '') AS signature, nullif(regexp_extract('/a/corpus_' || lower(p_brand) || '_20260630_5/x', 'corpus_(.+?)_\d{8}_\d+', 1), '') AS corpus FROM part"
)
def q_signature(spark, sf):
    n = F.concat(F.lit("img_"), F.col("p_partkey").cast("string"), F.lit("_jp2_q"), F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 2 == 0, "_f50_rmin2000").otherwise(""), F.lit(".jp2"))
    path = F.concat(F.lit("/a/corpus_"), F.lower("p_brand"), F.lit("_20260630_5/x"))
    return table(spark, sf, "part").select("p_partkey", K.parameter_signature(n).alias("signature"), K.corpus_of_path(path).alias("corpus"))


@query("SELECT doc_id, regexp_replace(lower(translate(strip_accents(text), ' -', '__')), '[^a-z0-9_]', '', 'g') AS slug FROM documents")
def q_slug(spark, sf):
    return table(spark, sf, "documents").select("doc_id", K.uri_slug(F.col("text")).alias("slug"))


@query("SELECT doc_id, md5(text) AS checksum FROM documents UNION ALL SELECT item_id, md5(text) FROM benchmark")
def q_md5_rows(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("checksum"))
    return d.unionByName(table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.md5("text").alias("checksum")))


# ---- linkage ----

_OLD = """old AS (SELECT CAST(o_custkey AS VARCHAR) AS path, CAST(o_orderkey AS VARCHAR) AS name, CAST(o_totalprice AS DOUBLE) AS size, strftime(o_orderdate, '%Y-%m-%d') AS d1, o_orderpriority AS d2,
 CAST(o_orderkey AS VARCHAR) AS uuid, md5(o_orderkey || '|' || o_orderstatus || '|' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)) AS checksum, o_orderkey AS k FROM orders)"""
_NEW = """new AS (SELECT CASE WHEN k % 7 = 2 THEN CAST(CAST(path AS BIGINT) + 100000 AS VARCHAR) ELSE path END AS path, name, CASE WHEN k % 7 = 3 THEN size + 1 ELSE size END AS size,
 CASE WHEN k % 7 = 1 THEN d1 || '+' ELSE d1 END AS d1, d2, CASE WHEN k % 7 = 3 THEN md5('changed' || checksum) ELSE checksum END AS checksum FROM old WHERE k % 11 <> 0
 UNION ALL SELECT path, '-' || name, size, d1, d2, md5('new' || checksum) FROM old WHERE k % 13 = 0)"""


def snapshots(spark, sf):
    """Two inventories of the orders: some deleted, some with another date, moved, changed, or new."""
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    old = o.select(
        F.col("o_custkey").cast("string").alias("path"), key.cast("string").alias("name"), F.col("o_totalprice").cast("double").alias("size"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("d1"), F.col("o_orderpriority").alias("d2"), key.cast("string").alias("uuid"),
        F.md5(F.concat_ws("|", key.cast("string"), "o_orderstatus", money("o_totalprice").cast("string"))).alias("checksum"), key.alias("k"),
    )
    m = F.col("k") % 7
    changed = old.where(F.col("k") % 11 != 0).select(
        F.when(m == 2, (F.col("path").cast("long") + 100000).cast("string")).otherwise(F.col("path")).alias("path"), "name",
        F.when(m == 3, F.col("size") + 1).otherwise(F.col("size")).alias("size"), F.when(m == 1, F.concat("d1", F.lit("+"))).otherwise(F.col("d1")).alias("d1"), "d2",
        F.when(m == 3, F.md5(F.concat(F.lit("changed"), "checksum"))).otherwise(F.col("checksum")).alias("checksum"),
    )
    added = old.where(F.col("k") % 13 == 0).select("path", F.concat(F.lit("-"), "name").alias("name"), "size", "d1", "d2", F.md5(F.concat(F.lit("new"), "checksum")).alias("checksum"))
    return old.drop("k"), changed.unionByName(added)


def _tiers(spark, sf):
    old, new = snapshots(spark, sf)
    l = new.withColumnRenamed("checksum", "new_checksum")
    one = linkage.match_exact(l, old, ["name", "path", "size", "d1", "d2"], ["checksum", "uuid"], write=True)
    two = linkage.match_unique(one.left, one.right, ["name", "path", "size"], ["checksum", "uuid"], write=True)
    three = linkage.match_unique(two.left.withColumnRenamed("new_checksum", "checksum"), two.right, ["name", "checksum"], ["uuid"], write=True)
    return new, old, one, two, three


_CASCADE = f"""WITH {_OLD}, {_NEW},
t1 AS (SELECT n.*, o.uuid FROM new n JOIN (SELECT DISTINCT * FROM old) o ON n.name IS NOT DISTINCT FROM o.name AND n.path IS NOT DISTINCT FROM o.path AND n.size IS NOT DISTINCT FROM o.size AND n.d1 IS NOT DISTINCT FROM o.d1 AND n.d2 IS NOT DISTINCT FROM o.d2),
l1 AS (SELECT * FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE n.name = o.name AND n.path = o.path AND n.size = o.size AND n.d1 = o.d1 AND n.d2 = o.d2)),
r1 AS (SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.name = o.name AND n.path = o.path AND n.size = o.size AND n.d1 = o.d1 AND n.d2 = o.d2)),
l1u AS (SELECT *, count(*) OVER (PARTITION BY name, path, size) AS c FROM l1), r1u AS (SELECT *, count(*) OVER (PARTITION BY name, path, size) AS c FROM r1),
t2 AS (SELECT l.*, r.uuid FROM l1u l JOIN r1u r ON l.c = 1 AND r.c = 1 AND l.name = r.name AND l.path = r.path AND l.size = r.size),
l2 AS (SELECT * FROM l1 WHERE (name, path, size) NOT IN (SELECT (name, path, size) FROM t2)), r2 AS (SELECT * FROM r1 WHERE uuid NOT IN (SELECT uuid FROM t2)),
l2u AS (SELECT *, count(*) OVER (PARTITION BY name, checksum) AS c FROM l2), r2u AS (SELECT *, count(*) OVER (PARTITION BY name, checksum) AS c FROM r2),
t3 AS (SELECT l.*, r.uuid FROM l2u l JOIN r2u r ON l.c = 1 AND r.c = 1 AND l.name = r.name AND l.checksum = r.checksum),
l3 AS (SELECT * FROM l2 WHERE (name, checksum) NOT IN (SELECT (name, checksum) FROM t3)), r3 AS (SELECT * FROM r2 WHERE uuid NOT IN (SELECT uuid FROM t3))
"""


@query(
    _CASCADE + "SELECT tier, role, CAST(n AS BIGINT) AS n FROM (SELECT 1 AS tier, 'ok' AS role, count(*) AS n FROM t1 UNION ALL SELECT 1, 'left', count(*) FROM l1 UNION ALL SELECT 1, 'right', count(*) FROM r1 "
    "UNION ALL SELECT 2, 'ok', count(*) FROM t2 UNION ALL SELECT 2, 'left', count(*) FROM l2 UNION ALL SELECT 2, 'right', count(*) FROM r2 "
    "UNION ALL SELECT 3, 'ok', count(*) FROM t3 UNION ALL SELECT 3, 'left', count(*) FROM l3 UNION ALL SELECT 3, 'right', count(*) FROM r3)"
)
def q_link_full(spark, sf):
    _, _, *tiers = _tiers(spark, sf)
    out = None
    for i, t in enumerate(tiers, 1):
        for role in ("ok", "left", "right"):
            n = getattr(t, role).agg(F.lit(i).alias("tier"), F.lit(role).alias("role"), F.count("*").alias("n"))
            out = n if out is None else out.unionByName(n)
    return out


@query(_CASCADE + "SELECT name, path, uuid FROM t1")
def q_link_exact(spark, sf):
    return _tiers(spark, sf)[2].ok.select("name", "path", "uuid")


@query(_CASCADE + "SELECT name, path, uuid FROM t2")
def q_link_relaxed(spark, sf):
    return _tiers(spark, sf)[3].ok.select("name", "path", "uuid")


@query(_CASCADE + "SELECT name, path, uuid, checksum FROM t3")
def q_link_checksum(spark, sf):
    return _tiers(spark, sf)[4].ok.select("name", "path", "uuid", "checksum")


@query(_CASCADE + "SELECT tier, whole, parts, whole = parts AS holds FROM (SELECT 1 AS tier, (SELECT count(*) FROM new) AS whole, (SELECT count(*) FROM t1) + (SELECT count(*) FROM l1) AS parts UNION ALL SELECT 2, (SELECT count(*) FROM l1), (SELECT count(*) FROM t2) + (SELECT count(*) FROM l2) UNION ALL SELECT 3, (SELECT count(*) FROM l2), (SELECT count(*) FROM t3) + (SELECT count(*) FROM l3))")
def q_conservation_laws(spark, sf):
    new, _, one, two, three = _tiers(spark, sf)
    out = None
    for i, (whole, t) in enumerate(((new, one), (one.left, two), (two.left, three)), 1):
        row = linkage.conserved(whole, t.ok, t.left).select(F.lit(i).alias("tier"), "whole", "parts", "holds")
        out = row if out is None else out.unionByName(row)
    return out


_SIDES = "a AS (SELECT md5(text) AS checksum, source AS name, lang AS path, doc_id FROM documents), b AS (SELECT md5(text) AS checksum, source AS name, lang AS path, doc_id AS uuid FROM documents WHERE doc_id % 3 <> 0)"


@query(f"WITH {_SIDES}, d AS (SELECT * FROM b QUALIFY count(*) OVER (PARTITION BY checksum) > 1) SELECT a.doc_id, d.uuid FROM a JOIN d ON a.checksum IS NOT DISTINCT FROM d.checksum AND a.name IS NOT DISTINCT FROM d.name AND a.path IS NOT DISTINCT FROM d.path")
def q_link_duplicates(spark, sf):
    d = table(spark, sf, "documents").select(F.md5("text").alias("checksum"), F.col("source").alias("name"), F.col("lang").alias("path"), "doc_id")
    right = linkage.mark_multiple(d.where("doc_id % 3 <> 0").withColumnRenamed("doc_id", "uuid"), ["checksum"]).where("multiple").drop("multiple")
    return linkage.match_duplicates(d, right, ["checksum", "name", "path"], ["uuid"]).select("doc_id", "uuid")


@query("SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer WHERE NOT EXISTS (SELECT 1 FROM customer o WHERE o.c_custkey % 4 <> 0 AND o.c_nationkey = customer.c_nationkey AND nullif(o.c_mktsegment, 'BUILDING') IS NOT DISTINCT FROM nullif(customer.c_mktsegment, 'BUILDING') AND o.c_custkey // 10 = customer.c_custkey // 10)")
def q_snapshot_diff(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"), F.floor(F.col("c_custkey") / 10).alias("g"))
    return linkage.unknown_files(c, c.where("c_custkey % 4 <> 0"), ["c_nationkey", "seg", "g"]).select("c_custkey", "seg")


@query("SELECT o_orderkey AS uuid, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 9 = 0) AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 5 = 0)")
def q_still_wanted(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("uuid"), F.col("o_custkey").alias("checksum_md5"), "o_orderstatus")
    return linkage.still_wanted(o.where("uuid % 3 = 0"), o.where("uuid % 9 = 0"), [o.where("uuid % 10 = 0"), o.where("uuid % 10 = 5")]).select("uuid", "o_orderstatus")


# ---- enrichment ----


@query("SELECT o_orderkey, r.l_shipmode AS s3_key, r.l_shipmode IS NOT NULL AS s3_uploaded FROM orders LEFT JOIN (SELECT l_orderkey, l_returnflag || '/' || l_partkey || '/' || l_suppkey || '/' || l_linenumber AS l_shipmode FROM lineitem WHERE l_linenumber > 2 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag || '/' || l_partkey || '/' || l_suppkey || '/' || l_linenumber) = 1) r ON r.l_orderkey = o_orderkey")
def q_enrich_authoritative(spark, sf):
    l = table(spark, sf, "lineitem").where("l_linenumber > 2")
    key = F.concat_ws("/", "l_returnflag", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string"))
    listing = l.select(F.col("l_orderkey").alias("uuid"), key.alias("key"), F.lit("2026-01-01").alias("last_modified"), F.lit("b").alias("s3_bucket"))
    base = table(spark, sf, "orders").select(F.col("o_orderkey").alias("uuid"))
    return enrich.add_objects(base, listing).select(F.col("uuid").alias("o_orderkey"), "s3_key", "s3_uploaded")


@query("SELECT p_partkey, f.finding_aid AS dao_finding_aid, f.unitid AS dao_unitid FROM part LEFT JOIN (SELECT l_partkey, l_returnflag AS source, 'ir' || (l_suppkey % 7) AS finding_aid, 'u' || l_orderkey AS unitid FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 9 END, 'ir' || (l_suppkey % 7), 'u' || l_orderkey) = 1) f ON f.l_partkey = p_partkey")
def q_enrich_first_per_key(spark, sf):
    links = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("uuid"), F.col("l_returnflag").alias("source"), F.concat(F.lit("ir"), (F.col("l_suppkey") % 7).cast("string")).alias("finding_aid"), F.concat(F.lit("u"), F.col("l_orderkey").cast("string")).alias("unitid")
    )
    return enrich.add_links(table(spark, sf, "part").select(F.col("p_partkey").alias("uuid")), links, ["R", "A"]).select(F.col("uuid").alias("p_partkey"), "dao_finding_aid", "dao_unitid")


@query("SELECT s_suppkey, coalesce(n.seg, o.seg) AS oai_set, o.bal AS mix, coalesce(o.st, n.st) AS statut FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS seg, 'new' AS st FROM supplier) n LEFT JOIN (SELECT s_suppkey, 'old' || s_name AS seg, s_acctbal AS bal, CASE WHEN s_suppkey % 3 = 0 THEN 'old' END AS st FROM supplier WHERE s_suppkey % 5 <> 0) o USING (s_suppkey)")
def q_coalesce_merge(spark, sf):
    s, k = table(spark, sf, "supplier"), F.col("s_suppkey")
    new = s.select(k, F.when(k % 2 == 0, F.col("s_name")).alias("oai_set"), F.lit("new").alias("statut"))
    old = s.where(k % 5 != 0).select(k, F.concat(F.lit("old"), "s_name").alias("oai_set"), F.col("s_acctbal").alias("mix"), F.when(k % 3 == 0, F.lit("old")).alias("statut"))
    return enrich.merge(new, old.unionByName(old), ["s_suppkey"], {"oai_set": "new_or_old", "statut": "old_or_new", "mix": "old"}, ["mix"]).select("s_suppkey", "oai_set", "mix", "statut")


@query("SELECT c_custkey, o.oai_set, o.osiros_id FROM (SELECT c_custkey, trim(regexp_replace(replace(c_name, '#', '_ '), '[_ ]+', ' ', 'g')) AS mark FROM customer) c LEFT JOIN (SELECT trim(regexp_replace(replace(c_name, '#', '  '), '[_ ]+', ' ', 'g')) AS mark, c_mktsegment AS oai_set, 'ID' || c_custkey AS osiros_id FROM customer WHERE c_custkey % 2 = 0) o ON o.mark = c.mark")
def q_enrich_records(spark, sf):
    c = table(spark, sf, "customer")
    records = c.where("c_custkey % 2 = 0").select(
        F.col("c_custkey").cast("string").alias("identifier"), F.replace("c_name", F.lit("#"), F.lit("  ")).alias("cote"), F.col("c_mktsegment").alias("setname"), F.concat(F.lit("ID"), F.col("c_custkey").cast("string")).alias("osiros_id")
    )
    base = c.select("c_custkey", F.replace("c_name", F.lit("#"), F.lit("_ ")).alias("unitid"))
    return enrich.add_records(base, records).select("c_custkey", "oai_set", "osiros_id")


@query("SELECT coalesce(a.k, b.k) AS k, a.x, b.y FROM (SELECT c_nationkey AS k, count(*) AS x FROM customer WHERE c_nationkey < 15 GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS k, count(*) AS y FROM supplier WHERE s_nationkey > 10 GROUP BY 1) b ON a.k = b.k")
def q_full_outer(spark, sf):
    a = table(spark, sf, "customer").where("c_nationkey < 15").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("x"), F.lit(1).alias("z"))
    b = table(spark, sf, "supplier").where("s_nationkey > 10").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("y"), F.lit(2).alias("z"))
    return enrich.full_outer_using(a, b, "k").select("k", "x", "y")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, m) AS status FROM orders LEFT JOIN (SELECT l_orderkey, max(l_linestatus) AS m FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def q_fill_from(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("status"))
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("status"))
    return enrich.fill_from(o, l, "o_orderkey", "status")


# ---- matching ----

_LS = "l AS (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN 'RBX_' || p_partkey WHEN 1 THEN 'rbx-' || p_partkey ELSE 'Rbx_00' || p_partkey END AS s FROM part)"
_RS = "r AS (SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN 'RBX_' || p_partkey ELSE 'RBX_0' || p_partkey END AS s FROM part WHERE p_partkey % 5 <> 0)"


@query(
    rf"WITH {_LS}, {_RS}, n1 AS (SELECT translate(lower(s), '-', '_') AS k, min(s) AS s FROM r GROUP BY 1), n2 AS (SELECT regexp_replace(translate(lower(s), '-', '_'), '(^|[^0-9])0+([0-9])', '\1\2', 'g') AS k, min(s) AS s FROM r GROUP BY 1), "
    r"t1 AS (SELECT l.s AS left_stem, r.s AS right_stem, 'exacte' AS methode FROM l JOIN r ON l.s = r.s), t2 AS (SELECT l.s AS left_stem, n1.s AS right_stem, 'normalisee' AS methode FROM l JOIN n1 ON translate(lower(l.s), '-', '_') = n1.k WHERE l.s NOT IN (SELECT left_stem FROM t1)), "
    r"t3 AS (SELECT l.s AS left_stem, n2.s AS right_stem, 'padding' AS methode FROM l JOIN n2 ON regexp_replace(translate(lower(l.s), '-', '_'), '(^|[^0-9])0+([0-9])', '\1\2', 'g') = n2.k WHERE l.s NOT IN (SELECT left_stem FROM t1) AND l.s NOT IN (SELECT left_stem FROM t2)) "
    "SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3"
)
def q_tiered_match(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    ks = k.cast("string")
    left = p.select(F.when(k % 3 == 0, F.concat(F.lit("RBX_"), ks)).when(k % 3 == 1, F.concat(F.lit("rbx-"), ks)).otherwise(F.concat(F.lit("Rbx_00"), ks)).alias("stem"))
    right = p.where(k % 5 != 0).select(F.when(k % 2 == 0, F.concat(F.lit("RBX_"), ks)).otherwise(F.concat(F.lit("RBX_0"), ks)).alias("stem"))
    return matching.tiered(left, right, [("exacte", lambda c: c), ("normalisee", K.normalise), ("padding", lambda c: K.unpad(K.normalise(c)))])


@query(
    r"WITH o AS (SELECT p_partkey, 'Im-' || lpad(CAST(p_partkey % 300 AS VARCHAR), CAST(1 + (p_partkey % 4) AS INTEGER), '0') AS stem, CASE WHEN p_partkey % 2 = 0 THEN 'image' ELSE 'audio' END AS fam FROM part WHERE p_partkey % 3 = 0), "
    r"r AS (SELECT p_partkey AS ref_id, CASE WHEN p_partkey % 2 = 0 THEN 'Im-' ELSE 'im_' END || (p_partkey % 300) AS ref_stem, CASE WHEN p_partkey % 2 = 0 THEN 'image' ELSE 'audio' END AS f2, p_size > 25 AS is_master FROM part WHERE p_partkey % 3 = 1), "
    r"j AS (SELECT o.*, ref_stem, ref_id, is_master, CASE WHEN stem = ref_stem THEN 'exacte' WHEN translate(lower(stem), '-', '_') = translate(lower(ref_stem), '-', '_') THEN 'normalisee' WHEN ref_id IS NULL THEN 'aucun' ELSE 'padding' END AS methode "
    r"FROM o LEFT JOIN r ON fam = f2 AND regexp_replace(translate(lower(stem), '-', '_'), '(^|[^0-9])0+([0-9])', '\1\2', 'g') = regexp_replace(translate(lower(ref_stem), '-', '_'), '(^|[^0-9])0+([0-9])', '\1\2', 'g')) "
    "SELECT DISTINCT p_partkey, stem, fam, ref_stem, ref_id, methode FROM (SELECT *, max(CASE WHEN is_master THEN 1 ELSE 0 END) OVER (PARTITION BY p_partkey, stem, fam) AS any_master FROM j) WHERE any_master = 0 OR is_master"
)
def q_loosest_then_classify(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    fam = F.when(k % 2 == 0, "image").otherwise("audio").alias("fam")
    number = (k % 300).cast("string")
    pad = F.when(F.length(number) > 1 + k % 4, F.left(number, (1 + k % 4).cast("int"))).otherwise(F.lpad(number, (1 + k % 4).cast("int"), F.lit("0")))
    o = p.where(k % 3 == 0).select("p_partkey", F.concat(F.lit("Im-"), pad).alias("stem"), fam)
    r = p.where(k % 3 == 1).select(k.alias("ref_id"), F.concat(F.when(k % 2 == 0, "Im-").otherwise("im_"), number).alias("stem"), fam, (F.col("p_size") > 25).alias("is_master"))
    keys = [("exacte", lambda c: c), ("normalisee", K.normalise), ("padding", lambda c: K.unpad(K.normalise(c)))]
    return matching.loosest_then_classify(o, r, "fam", keys)


@query("SELECT conv_id, turn, text FROM conversations c WHERE role = 'user' AND NOT EXISTS (SELECT 1 FROM conversations d WHERE d.conv_id = c.conv_id AND d.role = 'assistant' AND left(d.text, 1) = left(c.text, 1))")
def q_group_anti_match(spark, sf):
    c = table(spark, sf, "conversations").withColumn("fam", F.lit("text"))
    found = matching.missing_in_group(c, "conv_id", F.col("role") == "user", F.col("role") == "assistant", "fam", F.array(F.left("text", F.lit(1))))
    return found.select("conv_id", "turn", "text")


@query("SELECT o_orderkey, coalesce(a.p_name, b.p_name) AS p_name, CASE WHEN a.p_partkey IS NOT NULL THEN 'first' WHEN b.p_partkey IS NOT NULL THEN 'second' ELSE 'none' END AS found FROM orders LEFT JOIN part a ON a.p_partkey = o_orderkey LEFT JOIN part b ON b.p_partkey = o_orderkey // 4")
def q_radical_lookup(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return matching.radical_lookup(o, table(spark, sf, "part"), F.col("o_orderkey"), F.floor(F.col("o_orderkey") / 4).cast("long"), "p_partkey", ["p_name"])


# ---- ranges ----

_BOUNDS = "b AS (SELECT l_orderkey AS k, 'd/P_' || lpad(CAST(min(l_linenumber) AS VARCHAR), 2, '0') || '.tif' AS f, 'd/P_' || lpad(CAST(max(l_linenumber) AS VARCHAR), 2, '0') || '.tif' AS l, min(l_linenumber) AS x, max(l_linenumber) AS y FROM lineitem GROUP BY 1)"


def _ranges(spark, sf):
    n = lambda c: F.concat(F.lit("d/P_"), F.lpad(c.cast("string"), 2, "0"), F.lit(".tif"))
    b = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_linenumber").alias("x"), F.max("l_linenumber").alias("y"))
    return b.select("k", n(F.col("x")).alias("f"), n(F.col("y")).alias("l"))


def _members(spark, sf):
    return R.members(R.with_span(_ranges(spark, sf), F.col("f"), F.col("l")))


@query(f"WITH {_BOUNDS}, m AS (SELECT k, x, y, unnest(range(x, y + 1)) AS n FROM b WHERE x <> y) SELECT k, 'd/P_' || lpad(CAST(n AS VARCHAR), 2, '0') || '.tif' AS href, CAST(y - x + 1 AS INTEGER) AS size, CASE n WHEN x THEN 'first' WHEN y THEN 'last' ELSE 'intermediaire' END AS position FROM m")
def q_range_expand(spark, sf):
    return _members(spark, sf).select("k", "href", "size", "position")


_GAPS = f"""WITH {_BOUNDS}, m AS (SELECT k, x, y, unnest(range(x, y + 1)) AS n FROM b WHERE x <> y), h AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem),
g AS (SELECT m.k, count(*) AS total, count(h.n) AS present FROM m LEFT JOIN h USING (k, n) GROUP BY 1), t AS (SELECT *, round_even(CAST(100 * present AS DECIMAL(20,6)) / total, 1) AS taux FROM g)"""


def _gaps(spark, sf):
    """Ranges of each order's lines held against the lines that there are, through the catalogue's checks."""
    from cartulary.plans import catalogue

    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    l, k = table(spark, sf, "lineitem"), F.col("l_orderkey").cast("string")
    b = l.groupBy(k.alias("k")).agg(F.min("l_linenumber").alias("x"), F.max("l_linenumber").alias("y"))
    name = lambda n: F.concat(F.lit("d/P_"), F.col("k"), F.lit("_"), two(n), F.lit(".tif"))
    members = R.members(R.with_span(b, name(F.col("x")), name(F.col("y")))).withColumn("role", F.lit("preservation:image"))
    files = l.select(F.concat(F.lit("P_"), k, F.lit("_"), two(F.col("l_linenumber")), F.lit(".tif")).alias("name"), k.alias("uuid"), F.lit(None).cast("string").alias("s3_key"))
    g = catalogue.range_gaps(catalogue.check_ranges(members, files), ["k", "role"])
    return g.select(F.col("k").cast("long").alias("k"), "total", F.col("presents").alias("present"), "taux")


@query(_GAPS + " SELECT k, total, present, CAST(taux AS DOUBLE) AS taux FROM t WHERE present < total")
def q_range_gaps(spark, sf):
    return _gaps(spark, sf).where("present < total")


@query(_GAPS + " SELECT bin, count(*) AS n FROM (SELECT CASE WHEN taux <= 25 THEN '[0, 25]' WHEN taux <= 50 THEN '(25, 50]' WHEN taux <= 75 THEN '(50, 75]' WHEN taux <= 99 THEN '(75, 99]' ELSE '(99, 100]' END AS bin FROM t) GROUP BY bin")
def q_range_bins(spark, sf):
    return _gaps(spark, sf).groupBy(M.right_closed_bin(F.col("taux"), [0, 25, 50, 75, 99, 100]).alias("bin")).agg(F.count("*").alias("n"))


# ---- survivors and windows ----


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_partkey FROM lineitem QUALIFY l_quantity = max(l_quantity) OVER (PARTITION BY l_orderkey)")
def q_transform_max_ties(spark, sf):
    return survive.at_group_maximum(table(spark, sf, "lineitem"), ["l_orderkey"], "l_quantity").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey")


@query("SELECT doc_id, count(*) OVER (PARTITION BY md5(text)) > 1 AS multiple FROM documents")
def q_mark_multiple(spark, sf):
    return linkage.mark_multiple(table(spark, sf, "documents").select("doc_id", F.md5("text").alias("c")), ["c"]).select("doc_id", "multiple")


@query("""WITH d AS (SELECT doc_id, md5(text) AS checksum_md5, source AS name, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(n_chars // 200 AS DOUBLE) END AS m FROM documents),
w AS (SELECT *, count(*) OVER g AS copies, row_number() OVER (PARTITION BY checksum_md5, name ORDER BY m DESC NULLS LAST, name, doc_id) = 1 AS stands, max(m) OVER g AS newest FROM d WINDOW g AS (PARTITION BY checksum_md5, name)),
v AS (SELECT *, sum(CASE WHEN m = newest THEN 1 ELSE 0 END) OVER (PARTITION BY checksum_md5, name) AS tops, stands AND sum(CAST(stands AS INTEGER)) OVER (PARTITION BY checksum_md5) > 1 AS c1, stands AND sum(CAST(stands AS INTEGER)) OVER (PARTITION BY name) > 1 AS c2 FROM w)
SELECT doc_id, CASE WHEN stands AND NOT c1 AND NOT c2 THEN 'transférer' ELSE 'ne pas transférer' END AS action,
CASE WHEN NOT stands THEN 'doublon (' || copies || ' copies, ' || (copies - 1) || ' écartée(s)) : écarté — copie non retenue'
 WHEN c1 AND c2 THEN 'doublon résiduel sur checksum_md5, name : non transféré (même contenu sous des noms différents ; même nom pour des contenus différents)'
 WHEN c1 THEN 'doublon résiduel sur checksum_md5 : non transféré (même contenu sous des noms différents)'
 WHEN c2 THEN 'doublon résiduel sur name : non transféré (même nom pour des contenus différents)'
 WHEN copies = 1 THEN 'unique : à transférer'
 ELSE 'doublon (' || copies || ' copies, ' || (copies - 1) || ' écartée(s)) : conservé — ' || CASE WHEN tops = 1 THEN 'modif. la plus récente' WHEN m IS NULL THEN '1er (dates absentes)' ELSE '1er (dates égales)' END END AS traitement FROM v""")
def q_dedup_decision(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("checksum_md5"), F.col("source").alias("name"), F.when(F.col("doc_id") % 4 != 0, F.floor(F.col("n_chars") / 200).cast("double")).alias("m"))
    return survive.decide_transfers(d, ["checksum_md5", "name"], ["name"], "m", ["doc_id"]).select("doc_id", "action", "traitement")


@query("SELECT p_brand, p_partkey, p_type FROM (SELECT *, CASE split_part(p_type, ' ', 1) WHEN 'ECONOMY' THEN 0 WHEN 'SMALL' THEN 1 WHEN 'PROMO' THEN 2 ELSE 3 END AS r FROM part) WHERE r < 3 QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY r, p_partkey) = 1")
def q_best_format(spark, sf):
    p = table(spark, sf, "part").withColumn("e", F.split_part("p_type", F.lit(" "), F.lit(1)))
    return survive.best_format(p, ["p_brand"], "e", ["ECONOMY", "SMALL", "PROMO"], ["p_partkey"]).select("p_brand", "p_partkey", "p_type")


@query("SELECT c_nationkey, max_by(c_name, c_custkey) AS c_name FROM customer GROUP BY 1")
def q_last_wins(spark, sf):
    return survive.last_per_key(table(spark, sf, "customer"), "c_nationkey", "c_name", "c_custkey")


_SHUFFLED = "SELECT p_brand, p_partkey, CAST(p_size AS BIGINT) AS p_size, row_number() OVER w AS rank, CAST(sum(p_size) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY md5('5|' || p_partkey))"


@query(_SHUFFLED)
def q_running_budget(spark, sf):
    p = table(spark, sf, "part").select("p_brand", "p_partkey", F.col("p_size").cast("long").alias("p_size"))
    return sampling.running_budget(p, "p_brand", "p_size", sampling.shuffled_order(5, "p_partkey"))


@query(f"WITH s AS ({_SHUFFLED}), g AS (SELECT rank, sum(p_size) AS s, count(*) AS c FROM s GROUP BY 1), a AS (SELECT count(DISTINCT p_brand) AS n FROM part), t AS (SELECT rank, sum(s) OVER (ORDER BY rank) AS total FROM g, a WHERE c = n AND rank * n <= 600), m AS (SELECT coalesce(max(rank), 0) AS n FROM t WHERE total <= 9000) SELECT p_brand, p_partkey, p_size, rank FROM s, m WHERE rank <= n")
def q_balanced_sample(spark, sf):
    p = table(spark, sf, "part").select("p_brand", "p_partkey", F.col("p_size").cast("long").alias("p_size"))
    return sampling.balanced_sample(p, "p_brand", "p_size", sampling.shuffled_order(5, "p_partkey"), 600, 9000)


@query("SELECT c_custkey, c_nationkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY md5('7|' || c_custkey)) <= ceil(count(*) OVER (PARTITION BY c_nationkey) * 0.02)")
def q_share_sample(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return sampling.share_sample(c, "c_nationkey", 0.02, sampling.shuffled_order(7, "c_custkey"))


@query("SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, s.id FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS n FROM lineitem) l LEFT JOIN (SELECT l_orderkey, l_linenumber, 'm' || l_suppkey || '-' || l_partkey AS id, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, l_partkey) AS n FROM lineitem WHERE l_quantity > 20) s USING (l_orderkey, l_linenumber, n)")
def q_align_duplicates(spark, sf):
    l = table(spark, sf, "lineitem")
    stored = l.where("l_quantity > 20").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.concat(F.lit("m"), F.col("l_suppkey").cast("string"), F.lit("-"), F.col("l_partkey").cast("string")).alias("id"))
    out = ids.aligned_ids(l, stored, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"], ["l_suppkey", "l_partkey"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "id")


@query("SELECT o_orderkey, n AS number, 'file_' || lpad(CAST(n AS VARCHAR), 8, '0') AS id, CAST((n - 1) // 500 + 1 AS BIGINT) AS chunk FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS n FROM orders)")
def q_surrogate_id(spark, sf):
    o = ids.global_numbers(table(spark, sf, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"])
    return o.select("o_orderkey", "number", ids.numbered_id(F.col("number"), "file_").alias("id"), ids.chunk(F.col("number"), 500).alias("chunk"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS ids, true AS well_formed FROM customer")
def q_new_ids(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    made = ids.new_ids(c, c.limit(0).select(F.lit("x").alias("id")), "m0", 1_780_000_000, ["c_custkey"])
    return made.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.min(F.col("id").rlike("^m01780000000[0-9a-zA-Z]{6}$")).alias("well_formed"))


# ---- aggregates ----


@query("SELECT l_returnflag, count(*) AS total, count(*) FILTER (WHERE l_linestatus = 'O') AS ouverts, count(*) - count(*) FILTER (WHERE l_linestatus = 'O') AS reste FROM lineitem GROUP BY 1")
def q_named_aggregates(spark, sf):
    return A.role_counts(table(spark, sf, "lineitem"), ["l_returnflag"], {"ouverts": F.col("l_linestatus") == "O"})


@query("SELECT o_custkey, string_agg(v || ' (' || n || ')', ' ; ' ORDER BY n DESC, v) AS repartition FROM (SELECT o_custkey, coalesce(nullif(o_orderstatus, 'P'), 'NON RENSEIGNÉ') AS v, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1")
def q_histogram_text(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("s"))
    return A.histogram_text(o, ["o_custkey"], "s", "repartition")


@query("""WITH o AS (SELECT CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE 'C' || (o_custkey % 10) END AS code, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey END AS uuid, CAST(o_totalprice AS DECIMAL(18,2)) AS size, nullif(o_orderstatus, 'P') AS st, CASE WHEN o_orderkey % 3 = 0 THEN 'oui' ELSE 'non' END AS pub FROM orders),
h AS (SELECT code, string_agg(v || ' (' || n || ')', ' ; ' ORDER BY n DESC, v) AS st FROM (SELECT code, coalesce(st, 'NON RENSEIGNÉ') AS v, count(*) AS n FROM o GROUP BY 1, 2) GROUP BY 1)
SELECT o.code, CAST(count(uuid) AS BIGINT) AS fichiers, CAST(round_even(sum(size) / 1000000000, 2) AS DOUBLE) AS volume_go, CAST(round_even(CAST(100 * count(*) FILTER (WHERE contains(o.st, 'F')) AS DECIMAL(20,6)) / count(*), 1) AS DOUBLE) AS traitement_s3, count(*) FILTER (WHERE pub = 'oui') AS fichiers_publies, h.st FROM o JOIN h ON h.code = o.code GROUP BY o.code, h.st
UNION ALL SELECT 'TOTAL', count(*), CAST(round_even(sum(size) / 1000000000, 2) AS DOUBLE), CAST(round_even(CAST(100 * count(*) FILTER (WHERE contains(o.st, 'F')) AS DECIMAL(20,6)) / count(*), 1) AS DOUBLE), count(*) FILTER (WHERE pub = 'oui'), NULL FROM o""")
def q_dashboard_total(spark, sf):
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(
        F.when(F.col("o_custkey") % 10 != 0, F.concat(F.lit("C"), (F.col("o_custkey") % 10).cast("string"))).alias("code"), F.when(k % 6 != 0, k).alias("uuid"),
        money("o_totalprice").alias("size"), F.nullif("o_orderstatus", F.lit("P")).alias("st"), F.when(k % 3 == 0, "oui").otherwise("non").alias("pub"),
    )
    return A.dashboard(o, "code", "uuid", "size", "st", "pub", K.contains_any(F.col("st"), ["F"])).select("code", "fichiers", "volume_go", "traitement_s3", "fichiers_publies", "st")


@query("""WITH o AS (SELECT 'd' || (o_custkey % 40) AS path, nullif(o_orderstatus, 'P') AS st FROM orders WHERE NOT coalesce(contains(nullif(o_orderstatus, 'P'), 'F'), false)),
h AS (SELECT path, string_agg(v || ' (' || n || ')', ' ; ' ORDER BY n DESC, v) AS repartition FROM (SELECT path, coalesce(st, 'NON RENSEIGNÉ') AS v, count(*) AS n FROM o GROUP BY 1, 2) GROUP BY 1)
SELECT path, count(*) AS nb_fichiers, repartition FROM o JOIN h USING (path) GROUP BY path, repartition""")
def q_directory_report(spark, sf):
    o = table(spark, sf, "orders").select(F.concat(F.lit("d"), (F.col("o_custkey") % 40).cast("string")).alias("path"), F.nullif("o_orderstatus", F.lit("P")).alias("st"))
    return A.directory_report(o, "path", "st", K.contains_any(F.col("st"), ["F"]))


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY 1")
def q_crosstab(spark, sf):
    return A.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


_MARGIN = "CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = '{0}'), 0) AS DOUBLE) AS {0}"


@query(
    "SELECT coalesce(code, 'Total') AS o_orderpriority, F, O, P, Total FROM (SELECT o_orderpriority AS code, " + ", ".join(_MARGIN.format(x) for x in "FOP")
    + ", CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS Total FROM orders GROUP BY ROLLUP (o_orderpriority))"
)
def q_pivot_margins(spark, sf):
    measure = F.sum(money("o_totalprice")).cast("double")
    return A.pivot_with_margins(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"], measure)


@query("SELECT CASE WHEN GROUPING(l_returnflag) = 1 THEN 'Total' ELSE l_returnflag END AS l_returnflag, CASE WHEN GROUPING(l_returnflag) = 1 THEN '' ELSE l_linestatus END AS l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), ())")
def q_total_by(spark, sf):
    return A.total_by(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], F.count("*"), "n")


@query("SELECT l_returnflag, l_linestatus, CAST(round_even(sum(CAST(l_quantity AS DECIMAL(18,2))), 2) AS DOUBLE) AS q_sum, round_even(median(l_quantity), 2) AS q_median, count(l_quantity) AS q_count FROM (SELECT * FROM lineitem) GROUP BY 1, 2")
def q_pivot_mean_median(spark, sf):
    l = table(spark, sf, "lineitem").withColumn("q", money("l_quantity"))
    return A.generic_pivot(l, ["l_returnflag", "l_linestatus"], [], ["q"], ["sum", "median", "count"])


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, min(t) / 1048576 AS min_mib, max(t) / 1048576 AS max_mib, round(avg(t) / 1048576, 5) AS mean_mib, round(avg(l_extendedprice / t), 5) AS mean_ratio, round(avg(100 * (1 - t / l_extendedprice)), 5) AS mean_gain FROM (SELECT *, l_extendedprice * (1 - l_discount) AS t FROM lineitem) WHERE l_extendedprice > 0 AND t > 0 GROUP BY 1, 2")
def q_parameter_summary(spark, sf):
    l = table(spark, sf, "lineitem").withColumn("t", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    out = A.parameter_summary(l, ["l_returnflag", "l_linestatus"], "l_extendedprice", "t")
    return out.select("l_returnflag", "l_linestatus", "n", "min_mib", "max_mib", *(F.round(c, 5).alias(c) for c in ("mean_mib", "mean_ratio", "mean_gain")))


@query("SELECT l_orderkey, " + ", ".join(f"max_by(l_partkey, struct_pack(a := l_linenumber, b := l_partkey)) FILTER (WHERE l_returnflag = '{x}') AS {x}" for x in "ANR") + " FROM lineitem GROUP BY 1")
def q_wide_by_signature(spark, sf):
    l = table(spark, sf, "lineitem").withColumn("pos", F.struct("l_linenumber", "l_partkey"))
    return A.wide_by_signature(l, "l_orderkey", "l_returnflag", ["A", "N", "R"], "l_partkey", "pos")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def q_value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "events"), "event_type")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 15")
def q_topk(spark, sf):
    return A.value_counts(table(spark, sf, "events"), "user_id").orderBy(F.desc("n"), "user_id").limit(15)


@query("SELECT n_nationkey, coalesce(n, 0) AS n FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_suppkey % 9 = 0 GROUP BY 1) ON s_nationkey = n_nationkey")
def q_zero_groups(spark, sf):
    s = table(spark, sf, "supplier").where("s_suppkey % 9 = 0").withColumnRenamed("s_nationkey", "n_nationkey")
    return A.counts_with_zero(table(spark, sf, "nation"), s, "n_nationkey")


@query("SELECT count(*) AS keys, count(*) FILTER (WHERE k > 1) AS several, max(k) AS most FROM (SELECT l_partkey, count(DISTINCT l_suppkey) AS k FROM lineitem GROUP BY 1)")
def q_nunique_multi(spark, sf):
    return A.multiple_members(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


@query("SELECT s_suppkey AS k, s_name AS name, s_acctbal AS bal, CAST(NULL AS VARCHAR) AS seg FROM supplier UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer")
def q_union_missing_cols(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"))
    return linkage.stacked([s, c])


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def q_distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("SELECT r_name, q, rmin, CASE WHEN r_regionkey % 2 = 0 THEN 50 ELSE 75 END AS facteur, 'jp2_q' || q || '_f' || CASE WHEN r_regionkey % 2 = 0 THEN 50 ELSE 75 END || '_rmin' || rmin AS signature FROM region, (VALUES (80), (85), (90)) a(q), (VALUES (2000), (2500)) b(rmin)")
def q_param_sweep(spark, sf):
    from cartulary.plans.images import sweep

    corpora = table(spark, sf, "region").select("r_name", F.when(F.col("r_regionkey") % 2 == 0, 50).otherwise(75).alias("facteur"))
    return sweep(corpora, "jp2", [80, 85, 90], [2000, 2500]).select("r_name", "q", "rmin", "facteur", "signature")


# ---- semi-structured text ----


@query("SELECT CAST(page_id AS VARCHAR) AS doc, tag, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)[ />]', 1)) AS tag FROM pages) GROUP BY ALL")
def q_html_nodes(spark, sf):
    from cartulary.operators import xmltree

    pages = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("doc"), F.col("html").cast("binary").alias("content"))
    return xmltree.nodes(pages, tolerant=True).groupBy("doc", "tag").agg(F.count("*").alias("n"))


@query("SELECT 1.0 AS r2, 0.0 AS mae, round(sum(3 * l_extendedprice - 200 * l_quantity + 1000 * l_tax + 5) / 1000) AS predicted_total FROM lineitem")
def q_size_regression(spark, sf):
    """Sizes that are linear in their features are predicted as they are."""
    from cartulary.operators.regression import size_model

    price, quantity, tax = F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_tax")
    l = table(spark, sf, "lineitem").select(price.alias("size"), quantity.alias("height"), tax.alias("width"), (3 * price - 200 * quantity + 1000 * tax + 5).alias("target"), "l_orderkey", "l_linenumber", "l_partkey")
    made = size_model(l, ["size", "height", "width"], "target", ["l_orderkey", "l_linenumber", "l_partkey"])
    total = made.total(l).select(F.round(F.col("predicted_total") / 1000).alias("predicted_total"))
    return made.report.select(F.round("r2", 6).alias("r2"), F.abs(F.round("mae", 3)).alias("mae")).join(total, F.lit(True))


# ---- more of the function and report surface ----


@query(
    "SELECT o_orderkey, 'BNR' || o_orderkey AS record, '/' || o_custkey AS path, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 's3/' || o_orderkey END, 'disk/' || o_custkey || '/' || o_orderkey) AS href, 'uuid=' || o_orderkey || '&checksum_md5=' || md5(CAST(o_orderkey AS VARCHAR)) AS tags, "
    "o_orderkey % 100000000 BETWEEN 100 AND 5000 AS chosen, 'corpus_' || o_orderkey AS manifest FROM orders"
)
def q_key_functions(spark, sf):
    k, s = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    path = F.concat(F.lit("disk\\"), F.col("o_custkey").cast("string"))
    return table(spark, sf, "orders").select(
        "o_orderkey", K.record_id(F.concat(F.lit("oai:x:"), s), "oai:x:", "BNR").alias("record"), K.without_prefix(K.forward_slashes(path), "disk").alias("path"),
        K.preferred_href(F.when(k % 3 == 0, F.concat(F.lit("s3/"), s)), K.forward_slashes(path), s).alias("href"), K.transfer_tags(s, F.md5(s)).alias("tags"),
        K.suffix_between(F.concat(F.lit("f_"), F.lpad(s, 8, "0")), 100, 5000).alias("chosen"), K.manifest_stem(F.concat(F.lit("/m/corpus_"), s, F.lit(".csv.gz"))).alias("manifest"),
    )


@query(
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS d, "
    "day(o_orderdate) || ' ' || ['janvier','février','mars','avril','mai','juin','juillet','août','septembre','octobre','novembre','décembre'][month(o_orderdate)] || ' ' || year(o_orderdate) AS said, "
    "CAST(year(o_orderdate) AS VARCHAR) AS first, CASE WHEN o_orderkey % 2 = 0 THEN CAST(year(o_orderdate) + 5 AS VARCHAR) ELSE CAST(year(o_orderdate) AS VARCHAR) END AS last, CAST(o_custkey % 1000 AS INTEGER) AS n FROM orders"
)
def q_date_parts(spark, sf):
    d = K.date_parts(F.concat(F.lit("PRA_"), F.date_format("o_orderdate", "yyyyMMdd")))
    y = F.year("o_orderdate")
    span = K.year_span(F.concat(F.lit("/r ("), y.cast("string"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("-"), (y + 5).cast("string"))).otherwise(""), F.lit(")/x")))
    mark = F.concat(F.lit("D "), (F.col("o_custkey") % 1000).cast("string"), F.lit(" x 7"))
    return table(spark, sf, "orders").select(
        "o_orderkey", d["year"].alias("y"), d["month"].alias("m"), d["day"].alias("d"), K.long_date(d["year"], d["month"], d["day"]).alias("said"), span["first"].alias("first"), span["last"].alias("last"), K.first_number(mark).alias("n")
    )


@query(
    "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'image' WHEN 1 THEN 'audio' WHEN 2 THEN 'video' END AS family, 'audio' AS role_family, 'X_' || p_partkey AS bare, "
    "array_to_string(CASE WHEN p_partkey % 2 = 0 THEN ['A_X_' || p_partkey || '_TI', 'X_' || p_partkey || '_TI', 'A_X_' || p_partkey, 'X_' || p_partkey] ELSE ['A_X_' || p_partkey, 'X_' || p_partkey] END, '|') AS keys FROM part"
)
def q_media_keys(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_partkey").cast("string")
    ext = F.get(F.array(*map(F.lit, (".JPG", ".wav", ".mov", ".txt"))), (k % 4).cast("int"))
    variant = F.when(k % 2 == 0, "_TI").otherwise("")
    keys = K.exact_keys(F.concat(F.lit("d/A_X_"), s, variant, F.lit(".wav")), "A_X_", "X_")
    return table(spark, sf, "part").select(
        "p_partkey", K.media_family(ext).alias("family"), K.role_family(F.lit("access:audio:first")).alias("role_family"), K.strip_audio_variant(F.concat(F.lit("X_"), s, F.lit("_44kHz24B"))).alias("bare"), F.array_join(keys, "|").alias("keys")
    )


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'MED/X/' || c_custkey ELSE split_part(replace(c_mktsegment, 'I', '_'), '_', 1) || '/' || replace(c_mktsegment, 'I', '_') || '/' || c_name END AS dst FROM customer")
def q_destination_key(spark, sf):
    from cartulary.sources.writers import destination_key

    key = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("MED/X/"), F.col("c_custkey").cast("string"))).otherwise(F.lit(" "))
    return table(spark, sf, "customer").select("c_custkey", destination_key(key, F.replace("c_mktsegment", F.lit("I"), F.lit("_")), F.col("c_name")).alias("dst"))


@query("SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS q, count(*) AS n FROM lineitem GROUP BY 1, 2 UNION ALL SELECT l_returnflag, 'Total', CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE), count(*) FROM lineitem GROUP BY 1 UNION ALL SELECT 'Total', 'Total', CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE), count(*) FROM lineitem")
def q_pivot_two_values(spark, sf):
    return A.totals_by(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", {"q": F.sum(money("l_quantity")).cast("double"), "n": F.count("*")})


@query("SELECT p_brand AS corpus_code, count(*) AS n, median(CAST(p_size * 2 AS DOUBLE)) AS pixels, quantile_cont(CAST(p_size AS DOUBLE), 0.25) AS size_q1, quantile_cont(CAST(p_size AS DOUBLE), 0.75) AS size_q3, count(*) FILTER (WHERE p_size < 20) AS small FROM part WHERE contains(p_brand, '1') AND p_type IN ('ECONOMY', 'SMALL') GROUP BY 1")
def q_media_mix(spark, sf):
    from cartulary.plans.images import media_mix

    files = table(spark, sf, "part").select(F.col("p_brand").alias("corpus_code"), F.col("p_type").alias("file_type"), F.col("p_size").cast("double").alias("mix_imageWidth"), F.lit(2).alias("mix_imageHeight"))
    size = F.col("mix_imageWidth")
    return A.spread(media_mix(files, "1", ("ECONOMY", "SMALL")), ["corpus_code"], {"pixels": F.col("resolution")}, {"size": size}, {"small": size < 20})


@query("SELECT l_orderkey, array_to_string(list(DISTINCT l_returnflag ORDER BY l_returnflag), '|') AS flags, CAST(len(list_intersect(list(DISTINCT l_returnflag), ['A', 'R'])) AS INTEGER) AS shared FROM lineitem GROUP BY 1")
def q_set_operations(spark, sf):
    flags = F.array_sort(F.collect_set("l_returnflag"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_join(flags, "|").alias("flags"), F.size(F.array_intersect(flags, F.array(F.lit("A"), F.lit("R")))).alias("shared"))


@query("SELECT l_orderkey, first(l_partkey ORDER BY CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 9 END, l_linenumber, l_partkey) AS best FROM lineitem GROUP BY 1")
def q_custom_order(spark, sf):
    l = table(spark, sf, "lineitem").withColumn("r", survive.ranked_choice("l_returnflag", ["R", "A"]))
    return survive.first_per_key(l, ["l_orderkey"], ["r", "l_linenumber", "l_partkey"]).select("l_orderkey", F.col("l_partkey").alias("best"))


@query("SELECT p_brand, p_type, min_by(m, r) AS methode FROM (SELECT *, CASE p_partkey % 4 WHEN 0 THEN 'exacte' WHEN 1 THEN 'normalisee' WHEN 2 THEN 'padding' ELSE 'aucun' END AS m, p_partkey % 4 AS r FROM part) GROUP BY 1, 2")
def q_best_method(spark, sf):
    names = ["exacte", "normalisee", "padding", "aucun"]
    p = table(spark, sf, "part").withColumn("methode", F.get(F.array(*map(F.lit, names)), (F.col("p_partkey") % 4).cast("int")))
    return matching.best_method(p, ["p_brand", "p_type"], names)


def _finding_aids(orders):
    """Press finding aids of the orders: a corpus for each priority and month, which bounds a document's days."""
    from cartulary.plans import catalogue

    code = F.concat(F.lit("PRA_"), F.left("o_orderpriority", F.lit(1)), F.lit("_"), F.date_format("o_orderdate", "yyyyMM"))
    files = orders.select(
        code.alias("corpus_code"), F.concat(F.lit("PRA_"), F.date_format("o_orderdate", "yyyyMMdd")).alias("unitid"),
        F.concat(F.lit("p_"), F.col("o_orderkey").cast("string"), F.lit(".tif")).alias("name"), F.lit("/p").alias("path"), F.lit(None).cast("string").alias("s3_key"),
    )
    made = catalogue.press_finding_aid(files, F.concat(F.lit("m0"), F.md5(F.col("key"))))
    text = catalogue.whole_document(F.col("corpus_code"), F.col("corpus_code"), F.col("dsc"), F.concat(F.lit("m0"), F.col("corpus_code")), "Library")
    return made.select(F.concat("corpus_code", F.lit(".xml")).alias("doc"), F.encode(text, "UTF-8").alias("content"))


_AID = "'PRA_' || left(o_orderpriority, 1) || '_' || strftime(o_orderdate, '%Y%m') || '.xml'"


def _aids(spark, sf):
    return _finding_aids(table(spark, sf, "orders"))


@query(f"SELECT {_AID} AS doc, count(DISTINCT strftime(o_orderdate, '%Y%m%d')) + 3 AS components, count(DISTINCT strftime(o_orderdate, '%Y%m%d')) AS leaves, 3 AS deepest FROM orders GROUP BY 1")
def q_generated_components(spark, sf):
    from cartulary.operators import xmltree

    c = xmltree.components(xmltree.nodes(_aids(spark, sf)))
    return c.groupBy("doc").agg(F.count("*").alias("components"), F.count_if(F.col("leaf")).alias("leaves"), F.max("comp_depth").alias("deepest"))


@query(f"SELECT {_AID} AS doc, 'PRA_' || strftime(o_orderdate, '%Y%m%d') AS unitid, '/p/p_' || o_orderkey || '.tif' AS href, 'preservation:image' AS role, 'isole' AS position FROM orders")
def q_extracted_links(spark, sf):
    from cartulary.operators import xmltree

    links = xmltree.expanded_links(xmltree.nodes(_aids(spark, sf)), "gen")
    return links.select(F.col("ir").alias("doc"), "unitid", "href", "role", "position")


@query(f"SELECT {_AID} AS doc, count(DISTINCT o_orderkey) AS n_changes, CAST(NULL AS VARCHAR) AS error FROM orders GROUP BY 1")
def q_batch_dryrun(spark, sf):
    from cartulary.operators import xmledit

    return xmledit.batch(_aids(spark, sf), "rename_role", {"old": "preservation:image", "new": "preservation:tif"}).drop("content")


@query(
    f"WITH l AS (SELECT 'l_' || n_regionkey AS list, n_nationkey AS position, 'old_' || n_name || '.xml' AS nom_fichier, 'N' || (n_nationkey % 4) || '.xml' AS nouveau_nom_fichier FROM nation), t AS (SELECT * FROM l WHERE list = (SELECT max(list) FROM l)) "
    "SELECT nouveau_nom_fichier AS new_name, 'src_old_' || replace(min_by(nom_fichier, position), 'old_', '') AS finding_aid FROM t GROUP BY 1"
)
def q_finding_aid_names(spark, sf):
    from cartulary.plans import catalogue

    k = F.col("n_nationkey")
    lists = table(spark, sf, "nation").select(
        F.concat(F.lit("l_"), F.col("n_regionkey").cast("string")).alias("list"), k.alias("position"), F.concat(F.lit("old_"), F.col("n_name"), F.lit(".xml")).alias("nom_fichier"), F.concat(F.lit("N"), (k % 4).cast("string"), F.lit(".xml")).alias("nouveau_nom_fichier")
    )
    return catalogue.finding_aid_names(lists, "src")


@query(
    "SELECT CASE source WHEN 'b' THEN 'aid' ELSE source || '_' || left(doc, length(doc) - 4) || '.xml' END AS finding_aid, source, count(*) AS n FROM (SELECT 'a' AS source, {0} AS doc FROM orders UNION ALL SELECT 'b', {0} FROM orders WHERE o_orderstatus = 'O') GROUP BY ALL".format(_AID)
)
def q_extract_all(spark, sf):
    from cartulary.plans import catalogue

    a, b = _aids(spark, sf), _finding_aids(table(spark, sf, "orders").where("o_orderstatus = 'O'"))
    b = b.withColumn("doc", F.concat(F.lit("b_"), "doc")).unionByName(b.limit(1).withColumn("doc", F.lit("A Test.xml")))
    names = b.select(F.col("doc").alias("new_name"), F.lit("aid").alias("finding_aid"))
    out = catalogue.extract_all({"a": a, "b": b}, None, names)
    return out.groupBy("finding_aid", "source").agg(F.count("*").alias("n"))


@query(
    "WITH f AS (SELECT o_custkey || '/' || o_orderkey AS uri, CASE o_orderstatus WHEN 'F' THEN 'image/tiff' WHEN 'O' THEN 'image/jpeg' END AS mimetype, o_orderkey FROM orders), j AS (SELECT o_custkey || '/' || o_orderkey AS uri, CASE WHEN o_orderkey % 7 <> 0 THEN 'image/tiff' END AS jt FROM orders WHERE o_orderkey % 3 <> 0) "
    "SELECT o_orderkey, mimetype, jt AS \"jhove_mimeType\" FROM f JOIN j USING (uri) WHERE mimetype IS NULL OR jt IS NULL OR mimetype <> jt"
)
def q_type_mismatches(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    o = table(spark, sf, "orders")
    files = o.select(c.alias("path"), k.cast("string").alias("name"), F.when(F.col("o_orderstatus") == "F", "image/tiff").when(F.col("o_orderstatus") == "O", "image/jpeg").alias("mimetype"), k)
    technical = o.where(k % 3 != 0).select(F.concat(c, F.lit("/"), k.cast("string")).alias("jhove_uri"), F.when(k % 7 != 0, "image/tiff").alias("jhove_mimeType"))
    return enrich.type_mismatches(enrich.with_technical(files, technical)).select("o_orderkey", "mimetype", "jhove_mimeType")


@query("SELECT o_orderkey FROM orders WHERE lower(o_orderstatus) = 'f' OR (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')")
def q_sent_or_exempt(spark, sf):
    s = F.col("o_orderstatus")
    sent = F.when(s == "F", " True ").when(s == "O", "false")
    return table(spark, sf, "orders").where(K.sent_or_exempt(sent, F.col("o_orderpriority"), s, [("5-LOW", "P"), ("none", "O")])).select("o_orderkey")


@query("SELECT doc_id FROM documents WHERE contains(coalesce(source, ''), '1') OR regexp_matches(coalesce(lang, ''), '^f')")
def q_mentions(spark, sf):
    return table(spark, sf, "documents").where(K.mentions(F.col("source"), "1") | K.mentions(F.col("lang"), "^f", regex=True)).select("doc_id")


@query("SELECT c_custkey, c_mktsegment AS c_name, c_name AS c_mktsegment FROM customer")
def q_swapped_columns(spark, sf):
    return enrich.swapped(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "c_name", "c_mktsegment")


@query(
    "WITH i AS (SELECT p_brand AS corpus, p_size * 131.0 AS w, p_size * 200.0 AS h, 300.0 AS d, CASE WHEN p_brand < 'Brand#2' THEN 0.5 ELSE 0.75 END AS f FROM part WHERE p_partkey % 10 <> 0), s AS (SELECT *, least(1.0, greatest(f, 2000.0 / w)) AS s FROM i) "
    "SELECT corpus, CAST(floor(median(w)) AS BIGINT) AS x_before, CAST(floor(median(round_even(w * s, 0))) AS BIGINT) AS x_after, CAST(floor(median(round_even(d * s, 0))) AS BIGINT) AS dpi_after, CAST(round_even(100 * sum(round_even(w * s, 0) * round_even(h * s, 0)) / sum(w * h), 0) AS BIGINT) AS pixels_left, "
    "count(*) FILTER (WHERE s < 0.999) AS reduced, count(*) FILTER (WHERE s < 0.999 AND w * f < 2000) AS at_floor, count(*) FILTER (WHERE s >= 0.999) AS unchanged FROM s GROUP BY 1"
)
def q_resolution_recap(spark, sf):
    from cartulary.plans.images import resolution_recap

    size = F.col("p_size").cast("double")
    images = table(spark, sf, "part").select(F.col("p_brand").alias("corpus"), F.when(F.col("p_partkey") % 10 != 0, size * 131).alias("width"), (size * 200).alias("height"), F.lit(300.0).alias("dpi"))
    return resolution_recap(images, F.when(F.col("corpus") < "Brand#2", 0.5).otherwise(0.75))
