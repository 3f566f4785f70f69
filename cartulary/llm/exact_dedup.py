"""Exact dedup by content-defined chunk recipes.  DataFrame functions only.

Each text is cut, where its content says so, into chunks; a chunk is named by a
64-bit digest that is verified against the chunk's SHA-256, and a document becomes
the ordered list of its chunk names (its recipe).  Only recipes travel between
tasks; the texts are read once and never shuffled.

Defined cases: a null text counts as empty, and empty texts equal each other; a
null doc_id sorts after all others; a row that occurs several times stays once;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartulary.llm.shared import fresh, named_rows, stash

SPACE = r"[\x20\x09-\x0D]+"


def _class(residue: int, modulus: int = 8) -> str:
    """Regex class of the letters below U+0250 whose code point leaves ``residue``."""
    points = [p for p in range(0x30, 0x250) if p % modulus == residue and (chr(p).isalnum())]
    return "[" + "".join(f"\\x{{{p:x}}}" for p in points) + "]"


def chunk_pattern(least: int, most: int) -> str:
    """A chunk ends at the first pair of boundary letters past ``least`` characters, or at ``most``."""
    return f"(?s).{{{least},{most - 2}}}?{_class(1)}{_class(5)}|.{{1,{most}}}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def recipes(docs: DataFrame, least: int, most: int, digest: Callable[[Column], Column], *more: str) -> DataFrame:
    """One narrow row per document row: rid, doc_id, n, text_sha256, recipe array<struct<d, s>>, and the columns ``more``."""
    pattern = F.lit(chunk_pattern(least, most))
    return (
        docs.select("doc_id", "text", *more)
        .select(*more, "doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n"), normalised(F.col("text")).alias("t"))
        .select(
            *more,
            "doc_id",
            "n",
            F.sha2("t", 256).alias("text_sha256"),
            F.transform(
                F.regexp_extract_all("t", pattern, F.lit(0)),
                lambda c: F.struct(digest(c).alias("d"), F.unhex(F.sha2(c, 256)).alias("s")),
            ).alias("recipe"),
        )
        .withColumn("rid", F.monotonically_increasing_id())
    )


def verified(table: DataFrame) -> DataFrame:
    """Replace digests by verified identifiers: ``ids`` the digests, ``ords`` the rank of the
    content among those that share a digest; empty where no digest of the document is shared."""
    known = table.select(F.explode("recipe").alias("c")).select("c.d", "c.s").distinct()
    shared = known.groupBy("d").agg(F.count("*").alias("k")).where("k > 1").select("d")
    spread = table.select("rid", F.posexplode("recipe").alias("pos", "c")).select("rid", "pos", "c.d", "c.s")
    rank = F.row_number().over(Window.partitionBy("d").orderBy("s")) - 1
    ranked = known.join(shared, "d").select("d", "s", rank.alias("o"))
    ords = (
        spread.join(ranked, ["d", "s"])
        .groupBy("rid")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "o"))).alias("ords"))
    )
    return table.join(ords, "rid", "left").select(
        "rid",
        "doc_id",
        "n",
        "text_sha256",
        F.transform("recipe", lambda c: c["d"]).alias("ids"),
        F.coalesce("ords", F.array().cast("array<struct<pos:int,o:int>>")).alias("ords"),
    )


def _crowded(groups: DataFrame, rows: int) -> DataFrame:
    """(g, parts): how many parts a group of very many copies is split into for the join back.

    A group counts as crowded above 1000 rows and above 1/4096 of all, so that there are
    fewer than 4096 of them, however many rows there are.
    """
    least = max(1000, -(-rows // 4096))
    return groups.where(F.col("group_size") > least).groupBy("g").agg(F.ceil(F.max("group_size") / least).cast("long").alias("parts"))


def exact_dedup(
    docs: DataFrame, least: int = 512, most: int = 4096, digest: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """Return per row: rid, doc_id, n, keep_id, group_size, kept, text_sha256.

    Of equal texts the row of most code points, then of least doc_id, is kept.  Groups of
    several rows are pre-aggregated and joined back, crowded ones in parts.
    """
    return _decided(stash(recipes(docs, least, most, digest), "recipes"))


def _decided(read: DataFrame) -> DataFrame:
    g = F.xxhash64("ids", "ords").alias("g")
    table = verified(read).select("*", g)
    best = F.max(F.struct("n", F.bitwise_not("doc_id").alias("i"), F.bitwise_not("rid").alias("r"))).alias("best")
    groups = table.groupBy("g", "ids", "ords").agg(F.count("*").alias("group_size"), best).where("group_size > 1")
    groups = stash(groups, "groups")
    crowded = F.broadcast(stash(_crowded(groups, read.count()), "crowded"))  # fewer than 4096 rows
    parts = F.coalesce("parts", F.lit(1))
    spread = groups.join(crowded, "g", "left").select(
        "g", "ids", "ords", "group_size", "best", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part")
    )
    placed = table.join(crowded, "g", "left").select(*table.columns, F.pmod(F.xxhash64("rid"), parts).alias("part"))
    return placed.join(spread, ["g", "part", "ids", "ords"], "left").select(
        "rid",
        "doc_id",
        "n",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.bitwise_not("best.i")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.bitwise_not("best.r") == F.col("rid"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, least: int = 512, most: int = 4096) -> DataFrame:
    """``docs`` with its own columns, one row of each set of equal texts; the texts are read, not moved."""
    file, row = fresh(docs, "file", "row")
    named = named_rows(docs, file, row)
    mine = named.select("doc_id", "text", F.col(file).alias("file"), F.col(row).alias("row"))
    read = stash(recipes(mine, least, most, F.xxhash64, "file", "row"), "recipes")
    gone = _decided(read.drop("file", "row")).where(~F.col("kept")).select("rid")
    gone = gone.join(read.select("rid", "file", "row"), "rid").select(F.col("file").alias(file), F.col("row").alias(row))
    return named.join(stash(gone, "gone"), [file, row], "left_anti").select(*docs.columns)
