"""Helpers that the corpus operators share: written intermediate tables and Arrow text access."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from cartulary.operators.materialise import bounded_batches, discard, written  # noqa: F401 - operators take the first from here


def stash(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the folder of ``spark.checkpoint.dir`` and read back.

    Cuts the lineage at files that outlive any executor, and gives the planner the
    true size of what was written, so that joins broadcast only what is small.
    """
    return written(df, label)


def drop_stash(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        discard(df)


def named_rows(docs: DataFrame, file: str, row: str) -> DataFrame:
    """``docs`` with the file of each row and its number therein, which name the same row whenever the files are read.

    What isn't merely columns and rows picked from files is written first.
    """
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if "LogicalRelation" not in plan.getClass().getName():
        docs = stash(docs, "rows")

    def named(df: DataFrame) -> DataFrame:
        place = df.metadataColumn("_metadata")  # also where a column has that name
        return df.select("*", place["file_path"].alias(file), place["row_index"].alias(row))

    try:
        return named(docs)
    except AnalysisException:  # files that number no rows, such as CSV
        return named(stash(docs, "rows"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores put before those that a column of ``df`` has."""
    used, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        out.append(name)
    return out


def utf8_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (rows + 1) and bytes of a string column, null as empty, without copying rows."""
    col = batch.column(batch.schema.get_field_index(name))
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    n = len(col)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off, raw


def row_blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes; a longer row stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j
