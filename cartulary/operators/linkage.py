"""Linking two snapshots of one inventory, tier by tier; each tier sees only what the last one left.

Keys match null to null.  No side is broadcast by hand: both grow with the inventory.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cartulary.operators.materialise import written


@dataclass
class Tier:
    """What a tier matched, and what is left on either side."""

    ok: DataFrame
    left: DataFrame
    right: DataFrame


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)))


def match_exact(left: DataFrame, right: DataFrame, keys: Sequence[str], carry: Sequence[str], write: bool = False) -> Tier:
    """Full outer match on all keys, split by side.  ``right`` rows repeated whole count once;
    ``ok`` has the left columns and ``carry`` from the right.

    ``write`` writes the join once for all three parts, so that a cascade's later tiers
    don't compute the earlier ones again."""
    r = _prefixed(right.distinct(), "r_").withColumn("r_here", F.lit(True))
    l = _prefixed(left, "l_").withColumn("l_here", F.lit(True))
    both = l.join(r, null_safe(["l_" + k for k in keys], ["r_" + k for k in keys]), "full_outer")
    if write:
        both = written(both, "tier")
    ok = both.where("l_here and r_here").select(*[F.col("l_" + c).alias(c) for c in left.columns if c not in carry], *[F.col("r_" + c).alias(c) for c in carry])
    return Tier(
        ok,
        both.where("r_here is null").select([F.col("l_" + c).alias(c) for c in left.columns]),
        both.where("l_here is null").select([F.col("r_" + c).alias(c) for c in right.columns]),
    )


def mark_multiple(df: DataFrame, keys: Sequence[str], name: str = "multiple") -> DataFrame:
    """Flag every row whose key occurs more than once (null keys together); a common key is counted before it meets its rows."""
    several = df.groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys)).count().where("count > 1").drop("count").withColumn("_several", F.lit(True))
    marked = df.join(several, null_safe(keys, [f"_k_{k}" for k in keys]), "left")
    return marked.select(*df.columns, F.coalesce("_several", F.lit(False)).alias(name))


def match_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], carry: Sequence[str], write: bool = False) -> Tier:
    """Match on keys that are unique on both sides; rows of repeated keys stay in the rest."""
    marked = [mark_multiple(d, keys) for d in (left, right)]
    single = [m.where(~F.col("multiple")).drop("multiple") for m in marked]
    hit = match_exact(single[0], single[1], keys, carry, write)
    rest = [m.where("multiple").drop("multiple") for m in marked]
    return Tier(hit.ok, hit.left.unionByName(rest[0]), hit.right.unionByName(rest[1]))


def still_wanted(right: DataFrame, consumed: DataFrame, known: Sequence[DataFrame], identity: str = "uuid", checksum: str = "checksum_md5") -> DataFrame:
    """Reference rows not consumed yet whose checksum occurs among the known rows."""
    sums = reduce(lambda a, b: a.unionByName(b), (k.select(checksum) for k in known)).distinct()
    return right.join(consumed.select(identity).distinct(), identity, "left_anti").join(_prefixed(sums, "k_"), F.col(checksum).eqNullSafe(F.col("k_" + checksum)), "left_semi")


def match_duplicates(left: DataFrame, right: DataFrame, keys: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Rows of repeated checksums, told apart by (name, path): those on both sides."""
    return match_exact(left, right, keys, carry).ok


def new_files(left: DataFrame, created: str, modified: str, year: int) -> tuple[DataFrame, DataFrame]:
    """Rows created and modified in ``year`` (dates as text), and the others."""
    is_new = F.coalesce((F.left(F.col(created), F.lit(4)) == str(year)) & (F.left(F.col(modified), F.lit(4)) == str(year)), F.lit(False))
    return left.where(is_new), left.where(~is_new)


def partition_source(ref: DataFrame, column: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``column`` is ``value``, and all others, null with the others."""
    same = F.col(column).eqNullSafe(F.lit(value))
    return ref.where(same), ref.where(~same)


def unknown_files(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows without a null-safe match on the right."""
    r = _prefixed(right.select(*keys).distinct(), "r_")
    return left.join(r, null_safe(keys, ["r_" + k for k in keys]), "left_anti")


def conserved(whole: DataFrame, *parts: DataFrame) -> DataFrame:
    """One row: rows of the whole, of the parts, and whether they agree."""
    n = whole.agg(F.count("*").alias("whole"))
    m = reduce(lambda a, b: a.unionByName(b), (p.agg(F.count("*").alias("n")) for p in parts)).agg(F.sum("n").alias("parts"))
    return n.join(m, F.lit(True)).select("whole", "parts", (F.col("whole") == F.col("parts")).alias("holds"))


def column_difference(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns that only one of two tables has, sorted."""
    return sorted(set(a.columns) ^ set(b.columns))


def stacked(tables: Sequence[DataFrame]) -> DataFrame:
    """Tables one below the other by column name; what a table lacks is null there."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
