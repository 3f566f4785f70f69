"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments.  With three, two fingerprints that differ in at
most four bits agree but for one bit in the first or second segment, or wholly in the
third (radii 1, 1, 0 sum to 4 - 3 + 1); with two, they agree but for two bits in the
first or one in the second (radii 2, 1).  So every fingerprint looks up the Hamming
ball of that radius around each segment, and complete distances of what it meets are
verified.  Of a ball only the values up to the segment's own are looked up, so that
pairs of different values are met once.  The number of fingerprints tells which cut
has fewer lookups and candidates; both find the same links.

A segment value that more than ``hot`` fingerprints share is not paired.  Those
fingerprints, and those that look it up, go a linear way that loses no link: two
fingerprints are within four bits if and only if some value lies within two bits of
both, so each emits the values of its radius-2 ball and is linked to the least
fingerprint that emits the same value.

Defined cases: a null text and a text without words have the fingerprint zero and
are linked like any other; a null doc_id is never a component's id unless it has no
other; repeated rows share a component; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cartulary.llm.components import components
from cartulary.llm.shared import bounded_batches, fresh, named_rows, stash

CUTS = (((0, 22, 1), (22, 21, 1), (43, 21, 0)), ((0, 32, 2), (32, 32, 1)))  # first bit, bits, radius
SHINGLE, DISTANCE, SEED = 4, 4, 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles, unsigned; shingles go through in blocks."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    ones, total = np.zeros(64, np.int64), max(len(w) - shingle + 1, 1)
    for i in range(0, total, 16384):
        part = w[i : i + 16384 + shingle - 1]
        grams = [b" ".join(part)] if len(w) < shingle else map(b" ".join, zip(*(part[j:] for j in range(shingle))))
        digests = b"".join(map(xxhash.xxh64_digest, grams, repeat(SEED)))
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = b.column("text")
        fp = np.fromiter((fingerprint(t.as_py()) for t in text), np.uint64, len(text))
        yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(fp.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer."""
    bounded_batches(docs)
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def ball(bits: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` of the low ``bits`` bits."""
    return [sum(1 << i for i in some) for r in range(radius + 1) for some in combinations(range(bits), r)]


def best_cut(n: int) -> tuple:
    """The cut of least lookups and expected candidates for each of ``n`` fingerprints."""
    return min(CUTS, key=lambda cut: sum(len(ball(bits, r)) * (1 + n / 2**bits) for _, bits, r in cut))


def _segment(start: int, bits: int) -> Column:
    return F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << bits) - 1))


def _constant(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def _probes(s: int, start: int, bits: int, radius: int) -> Column:
    """(segment, value) that are looked up: of the ball around the segment's value those up to the value itself."""
    own = _segment(start, bits)
    near = F.filter(F.transform(_constant(ball(bits, radius)), lambda m: m.bitwiseXOR(own)), lambda v: v <= own)
    return F.transform(near, lambda v: F.struct(F.lit(s).alias("s"), v.alias("v")))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(nodes: DataFrame, hot: int = 2000, cut: tuple | None = None) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` whose components are those of all links."""
    cut = cut or best_cut(nodes.count())
    table = nodes.select(
        "fp", F.explode(F.array(*(F.struct(F.lit(s).alias("s"), _segment(*c[:2]).alias("v")) for s, c in enumerate(cut)))).alias("e")
    ).select("e.s", "e.v", "fp")
    crowded = stash(table.groupBy("s", "v").count().where(F.col("count") > hot).select("s", "v", F.lit(True).alias("crowd")), "crowded")
    marked = table.join(crowded, ["s", "v"], "left")
    entries = marked.where("crowd is null").select("s", "v", F.col("fp").alias("b")).unionByName(
        crowded.select("s", "v", F.lit(None).cast("long").alias("b"))
    )
    probes = nodes.select(
        "fp",
        F.explode(F.concat(*(_probes(s, *c) for s, c in enumerate(cut)))).alias("e"),
    ).select(F.col("fp").alias("a"), "e.s", "e.v")
    met = probes.join(entries, ["s", "v"]).where(
        F.col("b").isNull() | ((F.col("a") != F.col("b")) & (distance(F.col("a"), F.col("b")) <= DISTANCE))
    )
    met = stash(met.select("a", "b"), "met")
    pairs = met.where("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    dense = met.where("b is null").select(F.col("a").alias("fp")).unionByName(
        marked.where("crowd").select("fp")
    ).distinct()
    return pairs.unionByName(dense_links(dense))


def dense_links(nodes: DataFrame) -> DataFrame:
    """Star edges through common points of radius-2 balls; linear in the number of fingerprints."""
    masks = _constant([m - (1 << 64) if m >> 63 else m for m in ball(64, 2)])
    points = nodes.select("fp", F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("fp")))).alias("p"))
    least = points.groupBy("p").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").select("p", "b")
    return points.join(least, "p").where("fp <> b").select(F.col("b").alias("a"), F.col("fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, hot: int = 2000) -> DataFrame:
    """Per document row: doc_id, fingerprint (16 hex digits), component_id."""
    prints = stash(fingerprints(docs), "fingerprints")
    nodes = stash(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = components(links(nodes.select("fp"), hot), "a", "b")
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    ids = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = placed.join(ids, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, hot: int = 2000) -> DataFrame:
    """``docs`` with its own columns, one row of each component: that of the least doc_id (null last), then of the
    least fingerprint; of rows that agree in both, the first of the first file.

    Only names of rows and fingerprints are written; the rows that go are taken out of ``docs`` by name.
    """
    file, row = fresh(docs, "file", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("text")
            prints = np.fromiter((fingerprint(t.as_py()) for t in text), np.uint64, len(text))
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("row"), b.column("doc_id"), pa.array(prints.view(np.int64))], ["file", "row", "doc_id", "fp"])

    bounded_batches(docs)
    named = named_rows(docs, file, row)
    rows = named.select(F.col(file).alias("file"), F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stash(rows.mapInArrow(run, "file string, row long, doc_id long, fp long"), "prints")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("fp"), F.col("file"), F.col("row"))
    nodes = stash(rows.groupBy("fp").agg(F.min(order).alias("first"), F.count("*").alias("n")), "nodes")
    roots = components(links(nodes.select("fp"), hot), "a", "b")
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    best = placed.groupBy("root").agg(F.min("first").alias("best"), F.sum("n").alias("rows")).where("rows > 1")
    several = stash(placed.join(best, "root").select("fp", F.col("best.file").alias("kept_file"), F.col("best.row").alias("kept_row")), "several")
    gone = rows.join(several, "fp").where("file <> kept_file or row <> kept_row").select(F.col("file").alias(file), F.col("row").alias(row))
    return named.join(stash(gone, "gone"), [file, row], "left_anti").select(*docs.columns)
