from __future__ import annotations

import gzip
import hashlib
import zipfile

import pytest
from pyspark.sql import functions as F

from cartulary.schemas import OBJECT_LISTING, RECAP, RATIO_RECAP
from cartulary.sources import clients, readers, workbook, writers
from cartulary.streaming import landing


def test_strict_union_reports_other_headers(spark, tmp_path):
    head = ",".join(f.name for f in RECAP)
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text(f"{head}\ns1,tif,10,1,2,f1,jp2,80,5,1,2\n")
    (tmp_path / "sub" / "b.csv.gz").write_bytes(gzip.compress(f"{head}\r\ns2,tif,10,1,2,\"f,2\",jp2,N/A,5,1,2\r\n".encode()))
    (tmp_path / "c.csv").write_text(",".join(reversed(head.split(","))) + "\n")
    (tmp_path / "d.csv").write_text(",".join(f.name for f in RATIO_RECAP) + "\n")
    (tmp_path / "recap_global_20260101.csv").write_text(f"{head}\nold,tif,1,1,1,f,jp2,1,1,1,1\n")
    rows, bad = readers.read_strict(spark, str(tmp_path), RECAP, exclude="^recap_global_")
    got = {r.source: r for r in rows.collect()}
    assert set(got) == {"s1", "s2"} and got["s2"].qualite is None and got["s2"].fichier == "f,2" and got["s1"].fichier_source_csv.endswith("a.csv")
    assert sorted(r.path.rsplit("/", 1)[-1] for r in bad.collect()) == ["c.csv", "d.csv"]
    assert readers.latest(spark, str(tmp_path), r"^recap_global_(\d{8})\.csv$").endswith("recap_global_20260101.csv")


def test_inventory_and_csv_roundtrip(spark, tmp_path):
    (tmp_path / "in" / "x").mkdir(parents=True)
    (tmp_path / "in" / "x" / "a.txt").write_bytes(b"hello")
    (tmp_path / "in" / "b.lnk").write_bytes(b"")
    inv = readers.junk_free(readers.inventory(spark, str(tmp_path / "in"), checksums=True))
    r = inv.first()
    assert inv.count() == 1 and (r.name, r.size, r.checksum_md5) == ("a.txt", 5, hashlib.md5(b"hello").hexdigest()) and r.path.endswith("/in/x")
    df = spark.createDataFrame([("a\"b", "007"), ("c,d", None), ("e\nf", "1")], "n string, i string")
    writers.write_csv(df, str(tmp_path / "out"), rows_per_file=2)
    back = readers.read_text_csv(spark, str(tmp_path / "out"), ["n", "i"]).collect()
    assert {(x.n, x.i) for x in back} == {("a\"b", "007"), ("c,d", None), ("e\nf", "1")} or {(x.n, x.i or None) for x in back} == {("a\"b", "007"), ("c,d", None), ("e\nf", "1")}


def test_connectors(spark):
    def lister(bucket, prefix):
        yield {"key": f"{prefix}/1", "last_modified": "2025-01-01", "size": 3, "uuid": "u"}

    got = readers.list_objects(spark, spark.createDataFrame([("b", "p"), ("b", "q")], "bucket string, prefix string"), lister)
    assert got.schema.names == OBJECT_LISTING.names and {r.key for r in got.collect()} == {"p/1", "q/1"}

    def fetch(spec):
        yield {"identifier": f"oai:h.example:{spec}", "source": "Library, Fonds, X_1", "titles": ["a", "b"]}

    r = readers.harvest(spark, spark.createDataFrame([("s", "Set")], "setspec string, setname string"), fetch, "oai:h.example:", "H").first()
    assert (r.cote, r.title, r.osiros_id, r.setname) == ("X_1", "a ; b", "Hs", "Set")
    t = readers.tool_output(spark.createDataFrame([("a",), ("b",)], "path string").coalesce(1), lambda part: "+".join(part), batch=1).collect()
    assert sorted(x.output for x in t) == ["a", "b"]


def test_copy_is_resumable_and_journalled(spark, tmp_path):
    (tmp_path / "src" / "p").mkdir(parents=True)
    (tmp_path / "src" / "p" / "a.tif").write_bytes(b"12345")
    m = spark.createDataFrame([("MED_X", "a.tif", "p", None), ("MED_X", "b.tif", "p", "K/b.tif")], "corpus_code string, name string, path string, s3_key string")
    run = lambda: {r.name: (r.statut, r.dst) for r in writers.copy_files(m, f"file://{tmp_path}/src", f"file://{tmp_path}/dst", "m1").collect()}
    one, two = run(), run()
    assert one["a.tif"][0] == "copie" and two["a.tif"][0] == "deja_present" and one["b.tif"][0] == "absent"
    assert (tmp_path / "dst" / "m1" / "conservation" / "MED" / "MED_X" / "a.tif").read_bytes() == b"12345"


def test_upload_and_delete_log_each_row(spark, tmp_path):
    store = str(tmp_path)

    def head(key):
        import os

        return {"size": os.path.getsize(f"{store}/{key}")} if os.path.exists(f"{store}/{key}") else None

    def put(path, key, tags):
        assert tags == "uuid=u&checksum_md5=c"
        if key == "bad":
            raise OSError("refused")
        with open(f"{store}/{key}", "wb") as f:
            f.write(b"x" * (3 if key == "ok" else 1))

    rows = [("n", "/p", "u", "c", 3, "ok"), ("n", "/p", "u", "c", 3, "short"), ("n", "/p", "u", "c", 3, "bad")]
    log = {r.key: r for r in writers.upload(spark.createDataFrame(rows, "name string, path string, uuid string, checksum_md5 string, size long, s3_key string"), head, put).collect()}
    assert log["ok"].uploaded and log["short"].error and log["bad"].error == "refused"
    keys = spark.createDataFrame([("ok",), ("ok",)], "key string")
    assert [r.deleted for r in writers.delete_keys(keys, lambda k: None).collect()] == [False]


def test_documents_written(spark, tmp_path):
    log = writers.write_documents(spark.createDataFrame([("a.xml", "é"), ("x/y", "b"), ("c", None)], "doc string, content string"), f"file://{tmp_path}/d").collect()
    assert {r.doc: r.size for r in log} == {"a.xml": 2, "x/y": None, "c": None} and (tmp_path / "d" / "a.xml").read_text() == "é"


def test_landing_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    folder, seen = str(tmp_path / "in"), []
    schema = "id long, ts timestamp"

    def write(lo, hi):
        spark.range(lo, hi).select("id", F.timestamp_seconds(F.col("id") * 60).alias("ts")).write.mode("append").parquet(folder)

    def run():
        df = landing.landed(spark, folder, spark.createDataFrame([], schema).schema)
        landing.run_available(df, lambda b, _: seen.append(b.count()), str(tmp_path / "cp"))

    write(0, 10)
    run()
    write(10, 15)
    run()
    assert sum(seen) == 15
    df = landing.landed(spark, folder, spark.createDataFrame([], schema).schema).withColumn("kind", F.lit("k"))
    rows = []
    landing.run_available(landing.event_counts(df, "ts", "kind", "5 minutes"), lambda b, _: rows.extend(b.collect()), str(tmp_path / "cp2"), "update")
    assert sum({r.start: r.n for r in rows}.values()) == 15


def test_workbooks_come_back_and_look_as_asked(spark, tmp_path):
    rows = [("a & <b>", 1, 2.5, True), ("é\n", None, -3.0, False), ("TOTAL", 12345678, 1e-3, None)]
    df = spark.createDataFrame(rows, "name string, n long, share double, ok boolean").coalesce(1)
    path = str(tmp_path / "r.xlsx")
    writers.write_report({"Files": df, "No rows": df.limit(0)}, path, Files={"formats": {"n": workbook.WHOLE, "share": workbook.PERCENT}, "scaled": ["share"], "total": True, "widths": {"name": 60}})
    data = (tmp_path / "r.xlsx").read_bytes()
    assert workbook.read(data) == [["name", "n", "share", "ok"], *map(list, rows)] and workbook.read(data, "No rows") == [["name", "n", "share", "ok"]]
    with zipfile.ZipFile(path) as z:
        sheet, styles = z.read("xl/worksheets/sheet1.xml").decode(), z.read("xl/styles.xml").decode()
    assert 'state="frozen"' in sheet and 'sqref="C2:C4"' in sheet and 'width="60"' in sheet and "#,##0" in styles and "D9D9D9" in styles
    got = readers.workbook(spark, path, "n long, share string, missing int, name string").collect()
    assert [tuple(r) for r in got] == [(1, "2.5", None, "a & <b>"), (None, "-3.0", None, "é\n"), (12345678, "0.001", None, "TOTAL")]
    assert [workbook.letters(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_files_are_hashed_in_blocks(spark, tmp_path):
    for name, data in (("a b+c.bin", b"x" * 5000), ("e", b"")):
        (tmp_path / name).write_bytes(data)
    files = spark.createDataFrame([(f"file://{tmp_path}/a b+c.bin".replace(" ", " "),), (str(tmp_path / "e"),), (str(tmp_path / "none"),)], "path string")
    got = {r.path.rsplit("/", 1)[-1]: r for r in readers.digests(files, block=64).collect()}
    assert got["e"].checksum_md5 == hashlib.md5(b"").hexdigest() and got["none"].error and got["none"].checksum_md5 is None
    inv = {r.name: r.checksum_md5 for r in readers.inventory(spark, str(tmp_path), checksums=True).collect()}
    assert inv["a b+c.bin"] == hashlib.md5(b"x" * 5000).hexdigest()


def test_a_backup_stays_beside_a_written_document(spark, tmp_path):
    one = lambda text: spark.createDataFrame([("a.xml", text)], "doc string, content string")
    for text in ("1", "2", "3"):
        assert writers.write_documents(one(text), f"file://{tmp_path}", backup=True).first().error is None
    assert (tmp_path / "a.xml").read_text() == "3" and (tmp_path / "a.xml.bak").read_text() == "2"


OAI = '<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/">{}</OAI-PMH>'
RECORD = '<record><header{}><identifier>oai:x:{}</identifier></header><metadata><d:dc xmlns:d="http://purl.org/dc/elements/1.1/"><d:source>S, {}</d:source><d:title>T</d:title><d:title>U</d:title></d:dc></metadata></record>'


def answers(url):
    if "ListSets" in url:
        return OAI.format("<ListSets><set><setSpec>s</setSpec><setName>Set</setName></set><set><setSpec>none</setSpec><setName>None</setName></set></ListSets>").encode()
    if "resumptionToken=t" in url:
        return OAI.format("<ListRecords>" + RECORD.format("", 2, 2) + "<resumptionToken/></ListRecords>").encode()
    if "set=none" in url:
        return OAI.format('<error code="noRecordsMatch"/>').encode()
    if "set=s" in url:
        return OAI.format("<ListRecords>" + RECORD.format("", 1, 1) + RECORD.format(' status="deleted"', 9, 9) + "<resumptionToken>t</resumptionToken></ListRecords>").encode()
    return OAI.format('<error code="badArgument">no</error>').encode()


def test_harvests_follow_their_tokens(spark):
    sets = clients.harvest_sets("http://h/", answers)
    assert sets == [("s", "Set"), ("none", "None")]
    fetch = clients.harvest_records("http://h/", answers)
    assert [r["identifier"] for r in fetch("s")] == ["oai:x:1", "oai:x:2"] and list(fetch("none")) == []
    with pytest.raises(ValueError):
        list(fetch("other"))


def test_profiles_and_stores():
    settings = {"endpoint_url": "https://s", "region_name": "r", "reader": {"access_key": "a", "secret_key": "b"}}
    p = clients.profile(settings, "reader")
    assert clients.hadoop_settings(p, "bucket")["spark.hadoop.fs.s3a.bucket.bucket.endpoint.region"] == "r" and len(clients.hadoop_settings(p, "b")) == 4
    with pytest.raises(KeyError):
        clients.profile(settings, "writer")

    class Store:
        held = {"p/1": 3}

        def get_paginator(self, _):
            return self

        def paginate(self, Bucket, Prefix):  # noqa: N803
            return [self.list_objects_v2(Bucket, Prefix)]

        def list_objects_v2(self, Bucket, Prefix):  # noqa: N803
            return {"Contents": [{"Key": k, "Size": n, "LastModified": "d"} for k, n in self.held.items() if k.startswith(Prefix)]}

        def get_object_tagging(self, Bucket, Key):  # noqa: N803
            return {"TagSet": [{"Key": "uuid", "Value": "u"}]}

        def upload_file(self, path, bucket, key, ExtraArgs):  # noqa: N803
            self.held[key] = len(path)

        def delete_object(self, Bucket, Key):  # noqa: N803
            del self.held[Key]

    store = Store()
    assert list(clients.object_lister(p, lambda _: store)("b", "p")) == [{"key": "p/1", "last_modified": "d", "size": 3, "storage_class": None, "uuid": "u", "checksum_md5": None}]
    head, put, delete = clients.object_writer(p, "b", lambda _: store)
    put("1234", "q", "t")
    assert head("q")["size"] == 4 and head("p") is None
    delete("q")
    assert head("q") is None


def test_first_rows_of_a_stream(spark, tmp_path):
    rows = [(1, "a", 0), (1, "a", 5), (2, "b", 9)]
    spark.createDataFrame(rows, "id long, name string, s long").select("id", "name", F.timestamp_seconds("s").alias("ts")).write.parquet(str(tmp_path / "in"))
    df = landing.landed(spark, str(tmp_path / "in"), spark.createDataFrame([], "id long, name string, ts timestamp").schema)
    seen = []
    landing.run_available(landing.first_seen(df, "ts", ["id", "name"]), lambda b, _: seen.extend(b.collect()), str(tmp_path / "cp"))
    assert sorted(r.id for r in seen) == [1, 2]
