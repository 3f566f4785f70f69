"""Constrained samples that repeat: order by a seeded digest, never by a random generator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def shuffled_order(seed: int, *keys: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def _slices(df: DataFrame, order: Column) -> DataFrame:
    """With the shuffled order and the slice that its first three hex digits make, so that no group is sorted in one task."""
    return df.withColumn("_o", order).withColumn("_s", F.left("_o", F.lit(3)))


def running_budget(df: DataFrame, group: str, size: str, order: Column) -> DataFrame:
    """Rank and running size within each group in the shuffled order: over slices of a group, and within them."""
    sliced = _slices(df, order)
    before = Window.partitionBy("_g").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy(F.col(group).alias("_g"), "_s").agg(F.count("*").alias("_n"), F.sum(size).alias("_z"))
    sums = sums.select("_g", F.col("_s").alias("_t"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"), F.coalesce(F.sum("_z").over(before), F.lit(0)).alias("_z"))
    w = Window.partitionBy(group, "_s").orderBy("_o")
    own = sliced.select("*", F.row_number().over(w).alias("_r"), F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_x"))
    met = own.join(sums, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_s") == F.col("_t")))
    return met.select(*df.columns, (F.col("_n") + F.col("_r")).cast("int").alias("rank"), (F.col("_z") + F.col("_x")).alias("running"))


def balanced_sample(df: DataFrame, group: str, size: str, order: Column, most_rows: int, most_size: float) -> DataFrame:
    """The same number N of rows of every group: the greatest N that every group has, of which all
    groups together stay within ``most_rows`` and ``most_size``."""
    w = Window.partitionBy(group).orderBy("_o")  # only the first ranks of a group leave a task
    ranked = df.where(F.col(group).isNotNull()).withColumn("_o", order).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most_rows)
    per = ranked.groupBy("rank").agg(F.sum(size).alias("s"), F.count("*").alias("groups"))
    total = df.agg(F.count_distinct(group).alias("all"))
    steps = per.join(total, F.lit(True)).where((F.col("groups") == F.col("all")) & (F.col("rank") * F.col("all") <= most_rows))
    sums = steps.select("rank", F.sum("s").over(Window.orderBy("rank")).alias("total"))  # at most most_rows / groups rows
    n = sums.where(F.col("total") <= most_size).agg(F.coalesce(F.max("rank"), F.lit(0)).alias("n"))
    return ranked.join(n, F.col("rank") <= F.col("n"), "left_semi").drop("_o")


def share_sample(df: DataFrame, group: str, share: float, order: Column) -> DataFrame:
    """The first ceil(share) of each group in the shuffled order: whole slices, and the first rows of one more."""
    sliced = _slices(df, order)
    w = Window.partitionBy("_g")
    sums = sliced.groupBy(F.col(group).alias("_g"), "_s").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(w.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("_g", F.col("_s").alias("_t"), (F.ceil(F.sum("_n").over(w) * share) - before).alias("_left"), "_n").where("_left > 0")
    met = sliced.join(sums, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_s") == F.col("_t")))
    part = met.where("_n > _left").select("*", F.row_number().over(Window.partitionBy(group, "_s").orderBy("_o")).alias("_r")).where("_r <= _left")
    return met.where("_n <= _left").select(*df.columns).unionByName(part.select(*df.columns))


def codes_with_prefix(df: DataFrame, column: str, spec: Sequence[str]) -> DataFrame:
    """Rows of the listed codes; a code that ends in an underscore stands for all that begin with it."""
    keep = F.lit(False)
    for s in spec:
        keep = keep | F.coalesce(F.col(column).startswith(s) if s.endswith("_") else F.col(column) == s, F.lit(False))
    return df.where(keep)
