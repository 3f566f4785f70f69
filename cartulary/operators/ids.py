"""Identifiers that stay: concordances, numbers by order, chunks and seeded ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed value: letters of generated ids.
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVW"


def aligned_ids(rows: DataFrame, stored: DataFrame, keys: Sequence[str], row_order: Sequence[str], stored_order: Sequence[str], identity: str = "id") -> DataFrame:
    """The i-th row of a key takes the key's i-th stored id; null when there are fewer."""
    a = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*row_order)))
    b = stored.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*stored_order))).select(*keys, "_n", identity)
    return a.join(b, [*keys, "_n"], "left").drop("_n")


def global_numbers(df: DataFrame, order: Sequence[str], name: str = "number") -> DataFrame:
    """1, 2, ... over the whole table in a total order, without one task for all rows: a range
    partitioned sort, a count per partition, and an offset for each."""
    from cartulary.operators.materialise import written

    parts = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()), "numbered")
    counts = parts.groupBy("_p").agg(F.count("*").alias("_c"), F.min("_i").alias("_low"))
    offsets = counts.select("_p", "_low", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))  # a row per partition
    return parts.join(F.broadcast(offsets), "_p").withColumn(name, F.col("_i") - F.col("_low") + F.col("_o") + 1).drop("_p", "_i", "_low", "_o")


def numbered_id(number: Column, prefix: str) -> Column:
    return F.format_string(prefix + "%08d", number)


def chunk(number: Column, size: int) -> Column:
    return F.floor((number - 1) / size) + 1


def seeded_id(prefix: str, epoch: int, *keys: Column, salt: int = 0) -> Column:
    """Prefix, epoch seconds and six letters that depend on the keys alone; a new salt gives new letters."""
    h = F.xxhash64(F.lit(salt), *keys)
    letters = [F.substring(F.lit(ALPHABET), (F.pmod(F.shiftright(h, 10 * i), F.lit(len(ALPHABET))) + 1).cast("int"), F.lit(1)) for i in range(6)]
    return F.concat(F.lit(f"{prefix}{epoch}"), *letters)


def new_ids(df: DataFrame, taken: DataFrame, prefix: str, epoch: int, keys: Sequence[str], rounds: int = 8) -> DataFrame:
    """``df`` with an id no row of ``taken`` (id) has and no other row gets; clashes are hashed again."""
    from cartulary.operators.materialise import written

    done, rest = None, df
    for salt in range(rounds):
        tried = written(rest.withColumn("id", seeded_id(prefix, epoch, *(F.col(k) for k in keys), salt=salt)), "new-ids")
        first = F.row_number().over(Window.partitionBy("id").orderBy(*keys)) == 1
        free = tried.withColumn("_first", first).join(taken.select(F.col("id"), F.lit(True).alias("_taken")), "id", "left")
        ok = free.where("_first and _taken is null").drop("_first", "_taken")
        done = ok if done is None else done.unionByName(ok)
        rest = free.where("not _first or _taken").drop("_first", "_taken", "id")
        taken = taken.select("id").unionByName(ok.select("id"))
        if rest.isEmpty():
            return done
    raise RuntimeError("ids still clash; lengthen them")


def new_uuids(df: DataFrame, name: str = "uuid") -> DataFrame:
    """A random uuid without hyphens for each row, written at once, as another run would draw others."""
    from cartulary.operators.materialise import written

    return written(df.withColumn(name, F.replace(F.uuid(), F.lit("-"), F.lit(""))), "uuids")
