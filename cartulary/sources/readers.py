"""Readers.  Every table states its schema; paths are read by Spark, wherever they are."""

from __future__ import annotations

import itertools
import re
import urllib.parse
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cartulary.functions import keys as K

#: Texts that stand for a missing value in exchanged files.
MISSING = "N/A"


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV or gzipped CSV with a header; ``columns`` are all that is parsed."""
    df = spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', nullValue=MISSING, emptyValue="")
    return df.select(*columns) if columns else df


def read_text_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """All columns as text, so that identifiers keep their zeros."""
    return read_csv(spark, path, StructType([StructField(c, StringType()) for c in columns]))


def discover(spark: SparkSession, root: str, pattern: str = "*.csv*", exclude: str | None = None) -> DataFrame:
    """Files below a folder: path, size, modified; names that match ``exclude`` are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    out = files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    return out.where(~K.basename(F.col("path")).rlike(exclude)) if exclude else out


def latest(spark: SparkSession, root: str, pattern: str) -> str:
    """The path whose name matches ``pattern``, the greatest by its first group (a date), then by path."""
    date = F.regexp_extract(K.basename(F.col("path")), pattern, 1)
    dated = discover(spark, root, "*").where(K.basename(F.col("path")).rlike(pattern))
    found = dated.agg(F.max(F.struct(date.alias("date"), "path"))["path"].alias("path")).first().path
    if found is None:
        raise FileNotFoundError(f"no {pattern} in {root}")
    return found


def headers(spark: SparkSession, root: str, pattern: str, exclude: str | None = None) -> DataFrame:
    """(path, header): the first line of each file of a tree, null for an empty one."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root)
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("i"), "value")
    first = lines.groupBy("path").agg(F.min_by("value", F.struct("at", "i")).alias("header"))
    return discover(spark, root, pattern, exclude).select("path").withColumn("_file", _same_file("path")).join(
        first.select(_same_file("path").alias("_file"), "header"), "_file", "left").drop("_file")


def _same_file(path: str) -> Column:
    """Paths of listings and of file metadata differ in slashes after the scheme, and the latter are escaped."""
    return F.regexp_replace(F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))), "^([a-z0-9]+:)/*", "$1/")


def read_strict(spark: SparkSession, root: str, schema: StructType, pattern: str = "*.csv*", exclude: str | None = None, provenance: str = "fichier_source_csv") -> tuple[DataFrame, DataFrame]:
    """Rows of all files whose header is exactly the schema's, with their file's path; and the
    files that were left out, with the reason.  Which files are good is joined to the rows."""
    want = ",".join(f.name for f in schema.fields)
    seen = headers(spark, root, pattern, exclude).withColumn("header", F.regexp_replace(F.regexp_replace("header", "^\ufeff", ""), '"|\r$', ""))
    bad = seen.where(~F.col("header").eqNullSafe(want)).select("path", F.concat(F.lit("unexpected header: "), F.coalesce("header", F.lit(""))).alias("problem"))
    good = seen.where(F.col("header") == want).select(_same_file("path").alias("_file"))
    tree = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("enforceSchema", "true")
    rows = tree.csv(root, schema=schema, header=True, multiLine=True, escape='"', nullValue=MISSING, emptyValue="").withColumn(provenance, F.col("_metadata.file_path"))
    return rows.withColumn("_file", _same_file(provenance)).join(good, "_file", "left_semi").drop("_file"), bad


def inventory(spark: SparkSession, root: str, checksums: bool = False, pattern: str = "*") -> DataFrame:
    """Files of a tree as an inventory; contents are read only for checksums, a block at a time.

    Spark's file listing has no metadata date, so that column is null."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    plain = F.regexp_replace("path", "^[a-z]+:(//[^/]*)?", "")
    if checksums:
        f = f.select("path", "length", "modificationTime").join(digests(f.select("path")).select("path", "checksum_md5"), "path", "left")
    return f.select(
        K.basename(plain).alias("name"), K.dirname(plain).alias("path"), F.col("length").alias("size"),
        (F.col("checksum_md5") if checksums else F.lit(None).cast("string")).alias("checksum_md5"),
        (F.unix_millis("modificationTime") / 1000).alias("last_content_modification_date"), F.lit(None).cast("double").alias("last_metadata_modification_date"),
    )


def digests(files: DataFrame, block: int = 1 << 20) -> DataFrame:
    """(path, checksum_md5, error) of the files at ``path``, read in blocks, so that their size doesn't matter."""
    import hashlib

    from pyarrow import fs as pafs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for path in b.column(0).to_pylist():
                try:
                    local = path.startswith(("/", "file:"))
                    fs, at = (pafs.LocalFileSystem(), re.sub("^file:/+", "/", path)) if local else pafs.FileSystem.from_uri(urllib.parse.quote(path, safe=":/%+@"))
                    digest = hashlib.md5(usedforsecurity=False)
                    with fs.open_input_stream(at, compression=None) as data:
                        while part := data.read(block):
                            digest.update(part)
                    rows.append((path, digest.hexdigest(), None))
                except Exception as e:  # noqa: BLE001 - one file's failure is its row's error
                    rows.append((path, None, str(e)[:500]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows) if rows else [[]] * 3)], ["path", "checksum_md5", "error"])

    return files.select("path").mapInArrow(run, "path string, checksum_md5 string, error string")


def documents(spark: SparkSession, root: str, pattern: str = "*.xml") -> DataFrame:
    """(doc, path, content) of the XML files of a tree; names with "test" are left out."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return f.select(K.basename(F.col("path")).alias("doc"), "path", "content").where(~F.contains(F.lower("doc"), F.lit("test")))


def workbook(spark: SparkSession, path: str, schema: StructType | str, sheet: str | int = 0) -> DataFrame:
    """A small workbook dimension: the columns of a schema, found by their header; values that don't fit become null."""
    from cartulary.sources.workbook import read

    data = spark.read.format("binaryFile").load(path).first()
    if data is None:
        raise FileNotFoundError(path)
    rows = read(bytes(data.content), sheet)
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    at = [rows[0].index(f.name) if rows and f.name in rows[0] else None for f in wanted.fields]
    texts = [tuple(None if i is None or r[i] is None else str(r[i]) for i in at) for r in rows[1:]]
    plain = spark.createDataFrame(texts, StructType([StructField(f.name, StringType()) for f in wanted.fields]))
    return plain.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted.fields))


def list_objects(spark: SparkSession, prefixes: DataFrame, lister: Callable[[str, str], Iterator[dict]]) -> DataFrame:
    """Objects below (bucket, prefix) rows; ``lister`` runs on the executors and gives dicts with
    key, last_modified, size, storage_class and tags (uuid, checksum_md5)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
        names = ["key", "last_modified", "size", "storage_class", "uuid", "checksum_md5", "s3_bucket"]
        for b in batches:
            for bucket, prefix in zip(b.column("bucket").to_pylist(), b.column("prefix").to_pylist()):
                rows = []
                for o in lister(bucket, prefix):
                    rows.append((o["key"], str(o.get("last_modified")), o.get("size"), o.get("storage_class"), o.get("uuid"), o.get("checksum_md5"), bucket))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    from cartulary.schemas import OBJECT_LISTING

    return prefixes.select("bucket", "prefix").mapInArrow(run, OBJECT_LISTING)


def harvest(spark: SparkSession, sets: DataFrame, fetch: Callable[[str], Iterator[dict]], prefix: str, replacement: str) -> DataFrame:
    """Records of harvested sets (setspec, setname): identifier, cote, title, setname, osiros_id.

    ``fetch`` runs on the executors and gives dicts with identifier, source and titles; an identifier of
    several sets has a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for spec, name in zip(b.column("setspec").to_pylist(), b.column("setname").to_pylist()):
                found = ((r["identifier"], r.get("source"), list(r.get("titles") or []), name) for r in fetch(spec))
                while rows := list(itertools.islice(found, 5000)):
                    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["identifier", "source", "titles", "setname"])

    raw = sets.select("setspec", "setname").mapInArrow(run, "identifier string, source string, titles array<string>, setname string")
    return raw.select(
        "identifier", K.shelfmark_of_source(F.col("source")).alias("cote"), F.array_join("titles", " ; ").alias("title"), "setname", K.record_id(F.col("identifier"), prefix, replacement).alias("osiros_id")
    )


def tool_output(files: DataFrame, command: Callable[[list[str]], str], path: str = "path", batch: int = 500) -> DataFrame:
    """Output of an external tool on batches of paths: (paths, output, error); a failing batch has its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column(0).to_pylist()
            for i in range(0, len(names), batch):
                part, out, error = names[i : i + batch], None, None
                try:
                    out = command(part)
                except Exception as e:  # noqa: BLE001 - one batch's failure is its row's error
                    error = str(e)[:500]
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.list_(pa.string())), pa.array([out], pa.string()), pa.array([error], pa.string())], ["paths", "output", "error"])

    return files.select(path).mapInArrow(run, "paths array<string>, output string, error string")


def junk_free(files: DataFrame, name: str = "name") -> DataFrame:
    return files.where(~K.is_junk(F.col(name)))
