"""Mixing sources to target weights, in blocks of a fixed number of words.

The words of each source are packed into blocks: documents go to bins by a hash of
their id, are laid end to end in each bin, the bins end to end, and every ``block``
words are one block (the source's last block may be shorter).  A source owes the slots
that its target in words makes: every block as often as its whole size goes into the
target, then whole blocks for the rest, then the first words of one more block, so that
the words taken are the target to the word.  Each output shard draws its source counts
from a multinomial over what the sources still owe, so that the sum over shards is what
they owe.  The driver draws so for at most ``GROUPS`` groups of consecutive shards, and a
task draws for the shards of its group.  A source's slots, counted over all shards, run
through a keyed pseudorandom permutation of its block indexes, and the blocks are joined
by index.

Defined cases: a null text has size zero and takes nothing; a null source is a
source of its own, last in order; sources without words have the target zero; a
source's target never exceeds ``ceiling`` times its size, and nothing is taken more
often; a source of fewer words than a block is one short block; rows repeated whole are
rows of their own; an empty table gives an empty result; other columns are ignored.  The
same input gives the same mix.  The list of sources is held by the driver and by the
tasks that draw, so the sources must be few enough to list; it is broadcast only up to
``FEW_SOURCES``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cartulary.llm.shared import stash

GAP = r"[\x20\x09-\x0D]+"
SEED = 20_240_601
GROUPS, FEW_SOURCES, BIN_GROUP = 4096, 20_000, 4096


def targets(sizes: Sequence[int], weights: Sequence[float], ceiling: float = 3.0) -> list[float]:
    """Shares of the sum of sizes by weight; what exceeds ``ceiling`` times a size is shared again by weight."""
    goal, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        unit = left / sum(weights[i] for i in free)
        over = {i for i in free if unit * weights[i] > ceiling * sizes[i]}
        if not over:
            for i in free:
                goal[i] = unit * weights[i]
            break
        for i in over:
            goal[i] = ceiling * float(sizes[i])
        left -= sum(goal[i] for i in over)
        free -= over
    return goal


def cyclic_weights(n: int) -> list[float]:
    return [float(i % 3 + 1) for i in range(n)]


def draw_shards(owed: np.ndarray, slots: int, *seed: int) -> Iterator[np.ndarray]:
    """Source counts of each shard of ``slots`` slots: multinomial by what is still owed, the last shard takes the rest."""
    left, k = owed.astype(np.int64).copy(), 0
    while left.sum() > 0:
        total = int(left.sum())
        if total <= slots:
            got = left.copy()
        else:
            rng, got, need = np.random.default_rng((*seed, k)), np.zeros_like(left), slots
            while need:  # a source that owes less than it drew gives its slots back
                room = left - got
                got += np.minimum(rng.multinomial(need, room / room.sum()), room)
                need = slots - int(got.sum())
        left -= got
        k += 1
        yield got


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Image of ``index`` in [0, n) under a keyed permutation: four Feistel rounds on the
    least even number of bits that holds n, walked until the value is below n."""
    half = ((np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.ones(len(index), bool)
    limit = n.astype(np.uint64)
    while todo.any():
        x, h, m, kk = out[todo], half[todo], mask[todo], key[todo]
        a, b = x >> h, x & m
        for r in range(4):
            f = (b + kk) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((r + 1) * 0xD1B54A32D192ED03 % (1 << 64))
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, a ^ ((f >> np.uint64(33)) & m)
        out[todo] = (a << h) | b
        todo[todo] = out[todo] >= limit[todo]
    return out.astype(np.int64)


@dataclass
class Dues:
    """What sources owe, an array entry each, from their sizes and their targets in whole words.

    ``blocks`` of them, of which ``whole`` are of full length; ``rounds`` times all; then ``rest`` whole blocks and the
    first ``extra`` words of another."""

    blocks: np.ndarray
    whole: np.ndarray
    rounds: np.ndarray
    rest: np.ndarray
    extra: np.ndarray

    @classmethod
    def of(cls, size: np.ndarray, words: np.ndarray, block: int) -> Dues:
        rounds = words // np.maximum(size, 1)
        left = words - rounds * size
        return cls(-(-size // block), size // block, rounds, left // block, left % block)

    def slots(self) -> np.ndarray:
        return self.rounds * self.blocks + self.rest + (self.extra > 0)

    def filled(self, i: np.ndarray, slot: np.ndarray, src: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block of each slot of the sources at ``i``, and how many of its first words count (-1: all)."""
        last = slot >= self.rounds[i] * self.blocks[i]  # the round that takes only a part
        own = np.where(last, slot - self.rounds[i] * self.blocks[i], slot % self.blocks[i])
        over = last & (own >= self.whole[i])  # all full blocks are taken; the short one is left
        n = np.where(last & ~over, self.whole[i], self.blocks[i])
        key = ((slot // self.blocks[i]).astype(np.uint64) + src.astype(np.uint64) * np.uint64(1000) + np.uint64(17)) * np.uint64(0x2545F4914F6CDD1D)
        block = np.where(over, self.blocks[i] - 1, permuted(np.where(over, 0, own), np.maximum(n, 1), key))
        return block, np.where(last & (own == self.rest[i]), self.extra[i], -1)


def _slots(shard: int, per_group: int, seed: int, block: int):
    """From a row per group of shards (grp; src, first, count, size, words per source) to a row per slot; a source's
    slots of the group follow its slot ``first``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                src, at, count, size, words = (np.array(row[c], np.int64) for c in ("src", "first", "count", "size", "words"))
                dues = Dues.of(size, words, block)
                for k, got in enumerate(draw_shards(count, shard, seed, row["grp"])):
                    i = np.repeat(np.arange(len(src)), got)
                    own = np.arange(len(i)) - np.repeat(np.cumsum(got) - got, got)
                    index, first = dues.filled(i, at[i] + own, src[i])
                    columns = [src[i].astype(np.int32), np.full(len(i), row["grp"] * per_group + k), own, index, first]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["src", "shard", "slot", "block", "first"])
                    at += got

    return run


class Mix:
    """A mix of ``docs``: ``sizes`` per document, ``slots`` (src, shard, slot, block, first) and ``taken`` per document."""

    def __init__(self, docs: DataFrame, block: int = 64, shard: int = 4096, bin_words: int = 1 << 18, ceiling: float = 3.0, seed: int = SEED):
        self.block, spark = block, docs.sparkSession
        self.docs = stash(
            docs.select(
                "doc_id",
                F.col("source").cast("string").alias("source"),
                F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), GAP), "")).cast("long").alias("size"),
                F.xxhash64(F.lit(seed), "doc_id").alias("r"),
                F.xxhash64("text").alias("h"),
            ),
            "sizes",
        )
        per = self.docs.groupBy("source").agg(F.sum("size").alias("source_size"))
        found = [tuple(r) for r in per.collect()]  # one row per source
        found.sort(key=lambda r: (r[0] is None, (r[0] or "").encode("utf-32-be")))
        goals = targets([r[1] for r in found], cyclic_weights(len(found)), ceiling)
        rows = [(i, s, int(n), float(g), max(1, -(-int(n) // bin_words))) for i, ((s, n), g) in enumerate(zip(found, goals))]
        self.sources = spark.createDataFrame(rows, "src int, source string, source_size long, target double, bins long")
        named = F.broadcast(self.sources) if len(rows) <= FEW_SOURCES else self.sources
        joined = self.docs.join(named, self.docs["source"].eqNullSafe(self.sources["source"])).drop(self.sources["source"])
        run = Window.partitionBy("src", "bin").orderBy("doc_id", "h").rowsBetween(Window.unboundedPreceding, -1)
        placed = joined.select("*", F.pmod("r", "bins").alias("bin")).select("*", F.coalesce(F.sum("size").over(run), F.lit(0)).alias("at"))
        self.placed = stash(placed.select("doc_id", "source", "size", "source_size", "target", "src", "bin", "at", F.monotonically_increasing_id().alias("rid")), "placed")
        self.bins = stash(self._bases(self.placed.groupBy("src", "bin").agg(F.sum("size").alias("words"))), "bins")
        size = np.array([r[2] for r in rows], np.int64)
        words = np.minimum(np.floor(np.array(goals, np.float64) + 0.5), np.floor(ceiling * size)).astype(np.int64)
        owed = Dues.of(size, words, block).slots()
        per_group = max(1, -(-int(owed.sum()) // (shard * GROUPS)))
        drawn, first = [], np.zeros(len(rows), np.int64)
        for k, got in enumerate(draw_shards(owed, shard * per_group, seed)):
            some = np.flatnonzero(got)
            drawn.append((k, *(x[some].tolist() for x in (np.arange(len(rows)), first, got, size, words))))
            first += got
        plan = spark.createDataFrame(drawn, "grp long, src array<int>, first array<long>, count array<long>, size array<long>, words array<long>")
        tasks = max(1, min(len(drawn), int(spark.conf.get("spark.sql.shuffle.partitions"))))
        self.slots = plan.repartition(tasks, "grp").mapInArrow(_slots(shard, per_group, seed, block), "src int, shard long, slot long, block long, first long")

    @staticmethod
    def _bases(bins: DataFrame) -> DataFrame:
        """(src, bin, base): words of the source before each bin, summed over groups of bins and then within them."""
        part = F.floor(F.col("bin") / BIN_GROUP).alias("part")
        before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.select("*", part)
        parts = bins.groupBy("src", "part").agg(F.sum("words").alias("words"))
        parts = parts.select("src", "part", F.coalesce(F.sum("words").over(before("src", "part")), F.lit(0)).alias("outer"))
        own = F.coalesce(F.sum("words").over(before("src", "part", "bin")), F.lit(0))
        return bins.select("src", "part", "bin", own.alias("own")).join(parts, ["src", "part"]).select("src", "bin", (F.col("outer") + F.col("own")).cast("long").alias("base"))

    def pieces(self) -> DataFrame:
        """(row columns, src, block, lo, hi): the words of a block, counted from 0, that a document fills."""
        begin = F.col("base") + F.col("at")
        spread = self.placed.where("size > 0").join(self.bins, ["src", "bin"]).select("rid", "src", begin.alias("at"), (begin + F.col("size")).alias("ends"))
        b = F.col("block")
        return spread.select(
            "rid", "src", "at", "ends",
            F.explode(F.sequence(F.floor(F.col("at") / self.block), F.floor((F.col("ends") - 1) / self.block))).alias("block"),
        ).select("rid", "src", "block", F.greatest(F.col("at") - b * self.block, F.lit(0)).alias("lo"), F.least(F.col("ends") - b * self.block, F.lit(self.block)).alias("hi"))

    def taken(self) -> DataFrame:
        """Per document row: doc_id, size, source_size, target, taken.

        The joins of blocks and of rows are sorted ones: their sides grow with the data, and compressed sizes, by which
        the planner would broadcast them, are far below what they take in memory."""
        times = self.slots.groupBy("src", "block").agg(F.count_if(F.col("first") < 0).alias("times"), F.max("first").alias("first"))
        words = F.col("times") * (F.col("hi") - F.col("lo")) + F.greatest(F.least("first", "hi") - F.col("lo"), F.lit(0))
        sums = self.pieces().join(times.hint("merge"), ["src", "block"]).groupBy("rid").agg(F.sum(words).alias("taken"))
        return (
            self.placed.join(sums.hint("merge"), "rid", "left")
            .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
        )


def mix(docs: DataFrame, **options) -> DataFrame:
    return Mix(docs, **options).taken()
