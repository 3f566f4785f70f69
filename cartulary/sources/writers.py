"""Writers.  Whatever changes something outside returns a log row per item and never stops for one failing item."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, functions as F

from cartulary.functions import keys as K


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, rows_per_file: int = 0, mode: str = "error") -> None:
    """Gzipped CSV with a header and no index; ``rows_per_file`` splits it."""
    w = (df.select(*columns) if columns else df).write.mode(mode).option("header", True).option("compression", "gzip").option("escape", '"')
    (w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w).csv(path)


def write_report(sheets: dict[str, DataFrame], path: str, most_rows: int = 100_000, **looks: dict) -> None:
    """Small result tables as sheets of a workbook; ``looks`` has the formats, widths, scaled columns and total of a sheet."""
    from cartulary.sources.workbook import Sheet, to_bytes

    made = {}
    for name, df in sheets.items():
        rows = df.limit(most_rows + 1).collect()
        if len(rows) > most_rows:
            raise ValueError(f"{name} is too long for a report")
        made[name] = Sheet(df.columns, [tuple(r) for r in rows], **looks.get(name, {}))
    fs, at = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    with fs.open_output_stream(at, compression=None) as out:
        out.write(to_bytes(made))


def write_documents(docs: DataFrame, folder: str, backup: bool = False) -> DataFrame:
    """One file per row (doc, content) in a folder that executors reach; returns (doc, path, size, error) as written.

    With ``backup`` a file that is there already stays beside the new one, with .bak behind its name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        for b in batches:
            rows = []
            for doc, content in zip(b.column("doc").to_pylist(), b.column("content")):
                data = content.as_py()
                data = data.encode() if isinstance(data, str) else data
                try:
                    if data is None or "/" in doc:
                        raise ValueError("no content" if data is None else "a name can't have a slash")
                    if backup and fs.get_file_info(f"{root}/{doc}").type == pafs.FileType.File:
                        fs.copy_file(f"{root}/{doc}", f"{root}/{doc}.bak")
                    with fs.open_output_stream(f"{root}/{doc}", compression=None) as out:
                        out.write(data)
                    rows.append((doc, f"{root}/{doc}", len(data), None))
                except Exception as e:  # noqa: BLE001 - reported in the row
                    rows.append((doc, None, None, str(e)[:500]))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)], ["doc", "path", "size", "error"])

    return docs.select("doc", "content").mapInArrow(run, "doc string, path string, size long, error string")


def rdf_documents(triples: DataFrame) -> DataFrame:
    """(doc, content): one RDF/XML thesaurus per concept scheme from SKOS statements."""
    skos, rdf = "http://www.w3.org/2004/02/skos/core#", "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    per = triples.groupBy("s").agg(
        F.max(F.when(F.col("p") == skos + "prefLabel", F.col("o"))).alias("label"), F.max("lang").alias("lang"), F.max(F.when(F.col("p") == skos + "inScheme", F.col("o"))).alias("scheme")
    )
    entry = F.concat(
        F.lit('  <skos:Concept rdf:about="'), esc(F.col("s")), F.lit('">\n    <skos:prefLabel xml:lang="'), F.col("lang"), F.lit('">'), esc(F.col("label")),
        F.lit('</skos:prefLabel>\n    <skos:inScheme rdf:resource="'), esc(F.col("scheme")), F.lit('"/>\n  </skos:Concept>\n'),
    )
    body = F.array_join(F.array_sort(F.collect_list(entry)), "")
    head = f"<?xml version='1.0' encoding='UTF-8'?>\n<rdf:RDF xmlns:rdf=\"{rdf}\" xmlns:skos=\"{skos}\">\n"
    return per.groupBy("scheme").agg(F.concat(F.lit(head), body, F.lit("</rdf:RDF>\n")).alias("content")).select(F.concat(K.basename(F.col("scheme")), F.lit(".rdf")).alias("doc"), "content")


def destination_key(row_key: Column, corpus: Column, name: Column) -> Column:
    """The store key, or where a file without one belongs: prefix / corpus / name."""
    own = F.nullif(F.trim(row_key), F.lit(""))
    return F.when(own.isNotNull(), row_key).otherwise(F.concat_ws("/", F.get(F.split(corpus, "_"), F.lit(0)), corpus, name))


# States of a copied file, in the order of the tests.
ABSENT, THERE, COPIED, FAILED = "absent", "deja_present", "copie", "erreur"


def copy_files(manifest: DataFrame, source: str, destination: str, stem: str) -> DataFrame:
    """Copy the files of a manifest (corpus_code, name, path, s3_key); the log (corpus_code, name, statut, src, dst, erreur).

    A target of the same size counts as there, so that a run can be taken up again."""
    jobs = manifest.select(
        "corpus_code", "name", F.concat_ws("/", F.lit(source.rstrip("/")), F.regexp_replace("path", "^/+", ""), "name").alias("src"),
        F.concat_ws("/", F.lit(destination.rstrip("/")), F.lit(stem), F.lit("conservation"), destination_key(F.col("s3_key"), F.col("corpus_code"), F.col("name"))).alias("dst"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for code, name, src, dst in zip(*(c.to_pylist() for c in b.columns)):
                try:
                    fs, a = pafs.FileSystem.from_uri(src)
                    to, z = pafs.FileSystem.from_uri(dst)
                    here, there = fs.get_file_info(a), to.get_file_info(z)
                    if here.type != pafs.FileType.File:
                        state = ABSENT
                    elif there.type == pafs.FileType.File and there.size == here.size:
                        state = THERE
                    else:
                        to.create_dir(z.rsplit("/", 1)[0], recursive=True)
                        pafs.copy_files(a, z, source_filesystem=fs, destination_filesystem=to)
                        state = COPIED
                    rows.append((code, name, state, src, dst, None))
                except Exception as e:  # noqa: BLE001 - reported in the row
                    rows.append((code, name, FAILED, src, dst, str(e)[:500]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows) if rows else [[]] * 6)], ["corpus_code", "name", "statut", "src", "dst", "erreur"])

    return jobs.mapInArrow(run, "corpus_code string, name string, statut string, src string, dst string, erreur string")


def upload(batch: DataFrame, head: Callable[[str], dict | None], put: Callable[[str, str, str], None]) -> DataFrame:
    """Upload rows (name, path, uuid, checksum_md5, size, s3_key) with their tags; the log, one row each.

    ``head`` gives an object's size and date or None; ``put`` takes a local path, a key and tags.  An
    object of the same size isn't sent again; what arrives with another size is an error."""
    jobs = batch.select("name", "path", "checksum_md5", "uuid", "size", F.col("s3_key").alias("key"), K.transfer_tags(F.col("uuid"), F.col("checksum_md5")).alias("tags"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for name, path, checksum, uuid, size, key, tags in zip(*(c.to_pylist() for c in b.columns)):
                done, got, error = False, None, None
                try:
                    got = head(key)
                    if got is None or got["size"] != size:
                        put(f"{path}/{name}", key, tags)
                        got = head(key)
                    done = got is not None and got["size"] == size
                    error = None if done else "the object's size differs"
                except Exception as e:  # noqa: BLE001 - reported in the row
                    error = str(e)[:500]
                rows.append((name, path, checksum, uuid, size, key, done, got and got["size"], got and str(got.get("last_modified")), error))
            kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.string()]
            names = ["name", "path", "checksum_md5", "uuid", "size", "key", "uploaded", "uploaded_file_size", "uploaded_file_lastmodified", "error"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 10, kinds)], names)

    from cartulary.schemas import TRANSFER_LOG

    return jobs.mapInArrow(run, TRANSFER_LOG)


def delete_keys(keys: DataFrame, delete: Callable[[str], None], confirmed: bool = False) -> DataFrame:
    """Delete objects by key, and log (key, deleted, error).  Without ``confirmed`` nothing is deleted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key in b.column("key").to_pylist():
                try:
                    if confirmed:
                        delete(key)
                    rows.append((key, confirmed, None))
                except Exception as e:  # noqa: BLE001 - reported in the row
                    rows.append((key, False, str(e)[:500]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.bool_(), pa.string()))], ["key", "deleted", "error"])

    return keys.select("key").distinct().mapInArrow(run, "key string, deleted boolean, error string")
