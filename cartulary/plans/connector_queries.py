"""Registered queries of the readers, writers and small functions: what is written in the shared folder and read back
must be the tables again.  Stores and services are played by functions over that folder or over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cartulary.functions import keys as K, measures as M
from cartulary.operators import enrich, ids, xmltree
from cartulary.operators.materialise import shared_dir, written
from cartulary.plans import catalogue, images
from cartulary.plans.document_queries import _C, documents
from cartulary.plans.queries import query, table
from cartulary.sources import clients, readers, writers
from cartulary.sources.workbook import Sheet, read, to_bytes

L = F.lit
CUSTOMER = StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType()), StructField("c_mktsegment", StringType())])
COLUMNS = CUSTOMER.fieldNames()


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- tables in files ----


@query("SELECT c_custkey, nullif(c_name, 'Customer#000000007') AS c_name, c_mktsegment || ' \"x\", y' AS c_mktsegment FROM customer")
def q_csv_roundtrip(spark, sf):
    """Quotes, commas and nulls in gzipped CSV of several files."""
    at = _folder(spark, "csv")
    c = table(spark, sf, "customer").select("c_custkey", F.nullif("c_name", L("Customer#000000007")).alias("c_name"), F.concat("c_mktsegment", L(' "x", y')).alias("c_mktsegment"))
    writers.write_csv(c.withColumn("extra", L(1)), at, COLUMNS, rows_per_file=500)
    return readers.read_csv(spark, at, CUSTOMER, COLUMNS)


@query("SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS code, c_name AS name FROM customer")
def q_text_csv(spark, sf):
    """Numbers keep their zeros where all columns are text."""
    at = _folder(spark, "text-csv")
    c = table(spark, sf, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("code"), F.col("c_name").alias("name"))
    writers.write_csv(c, at)
    return readers.read_text_csv(spark, at, ["code", "name"])


@query("SELECT c_custkey, c_name, c_mktsegment, 'seg=' || c_mktsegment AS folder FROM customer WHERE c_mktsegment <> 'BUILDING'")
def q_strict_union(spark, sf):
    """A tree of CSV files; those of one folder have another header and are left out."""
    at = _folder(spark, "strict")
    c = table(spark, sf, "customer").select(*COLUMNS).withColumn("seg", F.col("c_mktsegment"))
    c.where("seg <> 'BUILDING'").write.partitionBy("seg").option("header", True).csv(at)
    c.where("seg = 'BUILDING'").select("c_custkey", "c_mktsegment", "c_name").write.option("header", True).csv(f"{at}/seg=BUILDING")
    rows, bad = readers.read_strict(spark, at, CUSTOMER, pattern="*.csv")
    if bad.where("problem like 'unexpected header: c_custkey,c_mktsegment,c_name'").isEmpty():
        raise ValueError("the other header wasn't seen")
    return rows.select(*COLUMNS, F.regexp_extract("fichier_source_csv", "(seg=[A-Z]+)", 1).alias("folder"))


@query("SELECT max(strftime(o_orderdate, '%Y%m%d')) AS newest, count(DISTINCT strftime(o_orderdate, '%Y%m%d')) AS files FROM orders WHERE o_orderkey < 60")
def q_latest_file(spark, sf):
    """Of dated file names the newest, and how many there are without the excluded ones."""
    at = _folder(spark, "dated")
    days = table(spark, sf, "orders").where("o_orderkey < 60").select(F.concat(L("recap_"), F.date_format("o_orderdate", "yyyyMMdd"), L(".xml")).alias("doc")).distinct()
    days = days.unionByName(spark.createDataFrame([("other_99999999.xml",)], "doc string")).withColumn("content", F.col("doc"))
    if not writers.write_documents(days, at).where("error is not null").isEmpty():
        raise ValueError("a file wasn't written")
    newest = readers.latest(spark, at, r"^recap_(\d{8})\.xml$")
    n = readers.discover(spark, at, "*.xml", exclude="^other_").count()
    return spark.createDataFrame([(newest.rsplit("recap_", 1)[-1][:8], n)], "newest string, files long")


@query("SELECT c_nationkey AS nation, count(*) AS n, max(c_name) AS top FROM customer GROUP BY 1")
def q_workbook(spark, sf):
    """A small table through a workbook."""
    t = table(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("long").alias("nation")).agg(F.count("*").alias("n"), F.max("c_name").alias("top"))
    data = to_bytes({"Nations": Sheet(t.columns, [tuple(r) for r in t.collect()], {"n": "#,##0"})})
    header, *rows = read(data, "Nations")
    return spark.createDataFrame([tuple(r) for r in rows], "nation long, n long, top string").toDF(*header)


# ---- files ----

_FILES = "SELECT 'd' || (doc_id % 7) || '_' || doc_id || '.xml' AS name, octet_length(encode(coalesce(text, ''))) AS size, md5(coalesce(text, '')) AS checksum_md5 FROM documents"


def _text_files(spark, sf, where: str):
    name = F.concat(L("d"), (F.col("doc_id") % 7).cast("string"), L("_"), F.col("doc_id").cast("string"), L(".xml"))
    docs = table(spark, sf, "documents").select(name.alias("doc"), F.coalesce("text", L("")).alias("content"))
    log = written(writers.write_documents(docs, where), "log")
    if not log.where("error is not null").isEmpty():
        raise ValueError("a document wasn't written")
    return log


@query(_FILES)
def q_inventory(spark, sf):
    """Documents written one by one, listed, and hashed a block at a time."""
    at = _folder(spark, "inventory")
    _text_files(spark, sf, at)
    return readers.junk_free(readers.inventory(spark, at, checksums=True)).select("name", "size", "checksum_md5")


@query(f"SELECT state, count(*) AS n, sum(CASE WHEN state = 'absent' THEN 0 ELSE size END) AS size FROM (SELECT size, unnest(['copie', 'deja_present']) AS state FROM ({_FILES}) UNION ALL SELECT 0, unnest(['absent', 'absent'])) GROUP BY 1")
def q_copied_files(spark, sf):
    """A manifest copied twice: the second time all is there; one file is missing at the source."""
    at = _folder(spark, "copies")
    files = _text_files(spark, sf, f"{at}/from")
    m = files.select(L("MED_X").alias("corpus_code"), F.col("doc").alias("name"), L("").alias("path"), L(None).cast("string").alias("s3_key"), "size")
    m = m.unionByName(spark.createDataFrame([("MED_X", "none.xml", "", "k/none.xml", 0)], "corpus_code string, name string, path string, s3_key string, size long"))
    logs = [written(writers.copy_files(m, f"{at}/from", f"{at}/to", "m"), "copy") for _ in range(2)]
    both = logs[0].unionByName(logs[1]).join(m.select("name", "size"), "name")
    return both.groupBy(F.col("statut").alias("state")).agg(F.count("*").alias("n"), F.sum("size").cast("decimal(38,0)").alias("size"))


@query("SELECT key, size FROM (SELECT 'k/' || o_orderkey AS key, o_orderkey % 9 AS size, o_orderkey FROM orders) WHERE o_orderkey % 5 <> 0")
def q_uploaded(spark, sf):
    """An upload to a store that holds a third already, refuses a fifth and is asked for the rest."""
    k = F.col("o_orderkey")
    batch = table(spark, sf, "orders").select(k.cast("string").alias("name"), L("p").alias("path"), k.cast("string").alias("uuid"), F.md5(k.cast("string")).alias("checksum_md5"), (k % 9).alias("size"), F.concat(L("k/"), k.cast("string")).alias("s3_key"))

    held = {}

    def head(key):
        n = int(key[2:])
        return held.get(key) or ({"size": n % 9, "last_modified": "d"} if n % 3 == 0 and n % 5 else None)

    def put(path, key, tags):
        n = int(key[2:])
        if n % 5 == 0:
            raise OSError("refused")
        assert path == f"p/{n}" and tags.startswith(f"uuid={n}&checksum_md5=")
        held[key] = {"size": n % 9, "last_modified": "d"}

    return writers.upload(batch, head, put).where("uploaded").select("key", F.col("uploaded_file_size").alias("size"))


@query("SELECT 'k/' || c_custkey AS key, c_custkey % 4 <> 0 AS deleted, CASE WHEN c_custkey % 4 = 0 THEN 'locked' END AS error FROM customer")
def q_deleted(spark, sf):
    def delete(key):
        if int(key[2:]) % 4 == 0:
            raise OSError("locked")

    key = F.concat(L("k/"), F.col("c_custkey").cast("string"))
    twice = table(spark, sf, "customer").select(F.explode(F.array(key, key)).alias("key"))
    return writers.delete_keys(twice, delete, confirmed=True)


@query("SELECT 'p' || c_nationkey || '/' || i AS key, CAST(c_nationkey AS BIGINT) * i AS size, 'u' || i AS uuid, 'bucket' AS s3_bucket FROM (SELECT DISTINCT c_nationkey FROM customer), range(0, 30) t(i)")
def q_listed_objects(spark, sf):
    def lister(bucket, prefix):
        return ({"key": f"{prefix}/{i}", "size": int(prefix[1:]) * i, "uuid": f"u{i}"} for i in range(30))

    prefixes = table(spark, sf, "customer").select(L("bucket").alias("bucket"), F.concat(L("p"), F.col("c_nationkey").cast("string")).alias("prefix")).distinct()
    return readers.list_objects(spark, prefixes, lister).select("key", "size", "uuid", "s3_bucket")


@query("SELECT 'oai:x:' || n_nationkey || '_' || i AS identifier, 'X ' || i AS cote, 'A ; B' AS title, n_name AS setname, 'R' || n_nationkey || '_' || i AS osiros_id FROM nation, range(0, 7) t(i) WHERE i <> 3")
def q_harvested(spark, sf):
    """Sets that answer in two pages, with a deleted record each."""
    base = '<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>{}</ListRecords></OAI-PMH>'
    record = '<record><header{}><identifier>oai:x:{}_{}</identifier></header><metadata><d:dc xmlns:d="http://purl.org/dc/elements/1.1/"><d:source>Library, X {}</d:source><d:title>A</d:title><d:title>B</d:title></d:dc></metadata></record>'

    def get(url):
        spec = url.rsplit("=", 1)[-1]
        own, part = (spec[1:], range(4, 7)) if spec.startswith("t") else (spec[1:], range(4))
        rows = "".join(record.format(' status="deleted"' if i == 3 else "", own, i, i) for i in part)
        return base.format(rows + ("" if spec.startswith("t") else f"<resumptionToken>t{own}</resumptionToken>")).encode()

    sets = table(spark, sf, "nation").select(F.concat(L("s"), F.col("n_nationkey").cast("string")).alias("setspec"), F.col("n_name").alias("setname"))
    return readers.harvest(spark, sets, clients.harvest_records("http://h/", get), "oai:x:", "R")


@query("SELECT c_custkey AS path, upper(c_name) AS output FROM customer")
def q_tool_output(spark, sf):
    """A tool that is run on batches of names, its output cut into lines again."""
    c = table(spark, sf, "customer").select(F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name").alias("path"))
    out = readers.tool_output(c, lambda names: "\n".join(names).upper(), batch=64)
    lines = out.select(F.explode(F.split("output", "\n")).alias("line"))
    return lines.select(F.split_part("line", L("|"), L(1)).cast("long").alias("path"), F.split_part("line", L("|"), L(2)).alias("output"))


@query(f"WITH {_C} SELECT DISTINCT doc, true AS same, true AS found FROM c")
def q_xml_files(spark, sf):
    """Documents written, found by their first bytes among other files, and read back byte by byte."""
    at = _folder(spark, "xml")
    docs = written(documents(spark, sf), "documents")
    more = spark.createDataFrame([("other.xml", bytearray(b"<html/>")), ("a_Test.xml", bytearray(b"<ead/>"))], "doc string, content binary")
    if not writers.write_documents(docs.unionByName(more), at).where("error is not null").isEmpty():
        raise ValueError("a document wasn't written")
    back = readers.documents(spark, at)
    found = xmltree.sniff(back).select("doc", L(True).alias("found"))
    return back.join(found, "doc").join(docs.withColumnRenamed("content", "was"), "doc").select("doc", (F.col("content") == F.col("was")).alias("same"), "found")


@query("SELECT 'th_' || c_mktsegment || '.rdf' AS doc, 1 AS concepts FROM (SELECT DISTINCT c_mktsegment FROM customer)")
def q_thesauri(spark, sf):
    t = xmltree.terms(xmltree.nodes(documents(spark, sf)))
    rdf = writers.rdf_documents(xmltree.triples(xmltree.concepts(t, "th_"), "http://t.example/"))
    n = xmltree.nodes(rdf.select("doc", F.encode("content", "UTF-8").alias("content")))
    return n.groupBy("doc").agg(F.count_if(F.col("tag") == "skos:Concept").cast("int").alias("concepts"))


# ---- functions ----


@query(
    "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'image/tiff' WHEN 1 THEN 'text/csv' END AS mime, CASE p_partkey % 3 WHEN 0 THEN 'Scan_007-X' WHEN 1 THEN 'Scan_007-X.csv' ELSE 'Scan_007-X.unknown' END AS stripped, "
    "CASE p_partkey % 3 WHEN 0 THEN 'scan_7_x' WHEN 1 THEN 'scan_7_x.csv' ELSE 'scan_7_x.unknown' END AS loose, CASE p_partkey % 3 WHEN 0 THEN 'scan_007_x' WHEN 1 THEN 'scan_007_x.csv' ELSE 'scan_007_x' END AS radical, 'F ' || p_partkey AS mark, "
    "CASE WHEN p_size > 2 THEN p_size / 2.0 END AS ratio, 'é < ' || p_partkey AS plain FROM part"
)
def q_more_functions(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_partkey").cast("string")
    name = F.get(F.array(*map(L, ("Scan_007-X.tif", "Scan_007-X.csv.gz", "Scan_007-X.unknown"))), (k % 3).cast("int"))
    bare = K.strip_media(F.regexp_replace(name, r"\.gz$", ""))
    size = F.col("p_size").cast("double")
    return table(spark, sf, "part").select(
        "p_partkey", K.mime_type(name).alias("mime"), bare.alias("stripped"), K.unpad(K.normalise(bare)).alias("loose"), K.radical(F.when(k % 3 == 0, "Scan_007-X.tif.JPG").otherwise(name)).alias("radical"),
        K.shelfmark_of_source(F.concat(L("Library, Room, F "), s)).alias("mark"), M.compression_ratio(F.when(size > 2, size).otherwise(-1.0), L(2.0)).alias("ratio"), K.unescape_html(F.concat(L("&eacute; &lt; "), s)).alias("plain"),
    )


@query("SELECT count(*) AS n, count(*) AS different, true AS plain FROM customer")
def q_new_uuids(spark, sf):
    made = ids.new_uuids(table(spark, sf, "customer").select("c_custkey"))
    return made.agg(F.count("*").alias("n"), F.count_distinct("uuid").alias("different"), F.min(F.col("uuid").rlike("^[0-9a-f]{32}$")).alias("plain"))


@query("SELECT c_name AS name, c_custkey AS size, CAST(NULL AS VARCHAR) AS missing FROM customer")
def q_projected(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("size"), F.col("c_name").alias("name"), "c_nationkey")
    return enrich.project(c, ["name", "size", "missing"])


@query("SELECT 'i' || p_partkey AS path, CASE WHEN p_partkey % 50 <> 0 THEN p_size * 100 // 15 BETWEEN 0 AND 100000 END AS near, CASE WHEN p_partkey % 50 = 0 THEN 'broken' END AS error FROM part")
def q_calibrated(spark, sf):
    """An encoder whose size grows with its quality is calibrated to a ratio; what it refuses is its row's error."""

    def encode(data, quality):
        if data.startswith(b"bad"):
            raise ValueError("broken")
        return b"x" * max(1, len(data) * quality // 400)

    k = F.col("p_partkey")
    content = F.encode(F.when(k % 50 == 0, "bad").otherwise(F.repeat(L("d"), F.col("p_size") * 100)), "UTF-8")
    i = table(spark, sf, "part").select(F.concat(L("i"), k.cast("string")).alias("path"), (F.col("p_size") * 100).cast("long").alias("raw"), content.alias("content"))
    got = images.calibrate_images(i, encode)
    return got.select("path", F.when(F.col("error").isNull(), F.col("ratio").between(13.5, 17.0)).alias("near"), "error")


@query(
    "SELECT 'd' || (doc_id % 7) || '_' || doc_id || '.xml' AS name, octet_length(encode(coalesce(text, ''))) // 2 AS w1800, CASE WHEN octet_length(encode(coalesce(text, ''))) < 5000 THEN octet_length(encode(coalesce(text, ''))) // 3 END AS w2500 FROM documents"
)
def q_image_versions(spark, sf):
    """Files copied, then converted at two widths by a stand-in encoder that fails for large files at one of them."""
    at = _folder(spark, "versions")
    files = _text_files(spark, sf, f"{at}/from")

    def encode(data, job):
        wide = job["signature"] == "w2500"
        if wide and len(data) >= 5000:
            raise ValueError("too large")
        return data[: len(data) // (3 if wide else 2)], 1, 1

    m = files.select(L("MED_X").alias("corpus_code"), F.col("doc").alias("name"), L("").alias("path"), L(None).cast("string").alias("s3_key"), L(4000.0).alias("width"))
    parameters = spark.createDataFrame([("MED_X", "w1800", 45, 1800), ("MED_X", "w2500", 62, 2500)], "corpus string, signature string, facteur int, rmin int")
    _, log = images.chain(m, f"{at}/from", f"{at}/to", "m", parameters, f"{at}/out", ".jpg", encode)
    return images.versions(log, ["w1800", "w2500"]).select(K.basename(F.col("source")).alias("name"), "w1800", "w2500")


@query(
    "WITH l AS (SELECT c_custkey, 'S_' || (c_custkey % 40) AS stem, c_custkey % 3 AS kind, c_name FROM customer), f AS (SELECT 'U' || i AS uuid, i, 's_' || CASE WHEN i % 2 = 0 THEN '0' ELSE '' END || i AS name FROM range(0, 50) t(i)) "
    "SELECT DISTINCT 'U' || (c_custkey % 40) AS uuid, c_name AS unitid, CASE WHEN (c_custkey % 40) % 2 = 0 THEN 'padding' ELSE 'normalisee' END AS methode FROM l WHERE kind <> 2"
)
def q_associated(spark, sf):
    """Links of components to files by stems that agree exactly, normalised, or without leading zeros."""
    k = F.col("c_custkey")
    links = table(spark, sf, "customer").select(
        L("s").alias("source"), F.col("c_name").alias("ir"), L("a").alias("finding_aid"), F.when(k % 3 == 2, "").otherwise(F.col("c_name")).alias("unitid"), L(1).alias("profondeur"),
        F.concat(L("S_"), (k % 40).cast("string"), L(".tif")).alias("href_base"),
    )
    i = F.col("id")
    files = spark.range(50).select(F.concat(L("U"), i.cast("string")).alias("uuid"), F.concat(L("s_"), F.when(i % 2 == 0, "0").otherwise(""), i.cast("string"), L(".jpg")).alias("name"))
    return catalogue.associate(links, files, ("", "")).select("uuid", "unitid", "methode")


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def q_landed_events(spark, sf):
    """Events that land as files, counted by a stream that takes what is there and stops."""
    from cartulary.streaming import landing

    at, out = _folder(spark, "landed"), _folder(spark, "counted")
    e = table(spark, sf, "events").select("user_id", "event_type")
    e.repartition(6).write.parquet(at)
    landing.run_available(landing.landed(spark, at, e.schema, files_per_batch=2), lambda b, i: b.groupBy("user_id", "event_type").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{out}/batch={i}"), _folder(spark, "stream"))
    return spark.read.parquet(out).groupBy("user_id", "event_type").agg(F.sum("n").alias("n"))
