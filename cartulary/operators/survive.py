"""Which row of several stands: ranks with total orders, best formats, and the transfer decision table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartulary.operators.materialise import written


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key (null keys together) in a stated order, which must be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.select("*", F.row_number().over(w).alias("_rank")).where("_rank = 1").drop("_rank")


def last_per_key(df: DataFrame, key: str, value: str, position: str) -> DataFrame:
    """The value of the last row of each key, as a mapping built row by row would keep; pre-aggregated."""
    return df.groupBy(key).agg(F.max_by(value, position).alias(value))


def at_group_maximum(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows that have their group's greatest value, all ties; the greatest is found before it meets the rows."""
    top = df.groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys)).agg(F.max(column).alias("_top"))
    same = F.col(column) == F.col("_top")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(top, same, "left_semi")


def ranked_choice(column: str, values: Sequence[str], default: int = 9) -> Column:
    c = F.lit(default)
    for i, v in reversed(list(enumerate(values))):
        c = F.when(F.col(column) == v, F.lit(i)).otherwise(c)
    return c


def best_format(df: DataFrame, keys: Sequence[str], extension: str, order: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Per key the file of the extension that comes first in ``order``; unlisted extensions never win."""
    rank = ranked_choice(extension, order, len(order))
    listed = df.withColumn("_format", rank).where(F.col("_format") < len(order))
    return first_per_key(listed, keys, ["_format", *tie]).drop("_format")


# Texts of the decision table.
TRANSFER, KEEP_BACK = "transférer", "ne pas transférer"
COPIES, PUT_ASIDE, RESIDUAL, NOT_SENT = "doublon (%d copies, %d écartée(s))", " : écarté — copie non retenue", "doublon résiduel sur ", " : non transféré ("
UNIQUE, KEPT, NEWEST, UNDATED, SAME_DATE = "unique : à transférer", " : conservé — ", "modif. la plus récente", "1er (dates absentes)", "1er (dates égales)"
CONFLICT = {"checksum_md5": "même contenu sous des noms différents", "name": "même nom pour des contenus différents"}


def decide_transfers(df: DataFrame, key: Sequence[str], sort: Sequence[str], date: str, tie: Sequence[str] = ()) -> DataFrame:
    """Adds ``action`` and ``traitement`` to every row.

    Of the rows of a key the newest stands, then the first by ``sort`` and ``tie``; a row
    that stands but shares one part of the key with another that stands isn't sent.  A
    null key is a key; at its greatest date no rows are counted (0).
    """
    dated = df.withColumns({"_date": F.col(date).cast("string").try_cast("double"), "_rid": F.monotonically_increasing_id()})
    rows = written(dated, "transfers")
    place = F.struct(*(x for i, c in enumerate((*sort, *tie)) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))), F.col("_rid").alias("rid"))
    days = rows.groupBy(*key, "_date").agg(F.count("*").alias("_n"), F.min(place).alias("_first"))
    undated = F.max(F.when(F.col("_date").isNull(), F.col("_first")))
    groups = days.groupBy(*(F.col(k).alias(f"_k_{k}") for k in key)).agg(
        F.sum("_n").alias("_copies"), F.max_by("_n", "_date").alias("_newest"), F.coalesce(F.max_by("_first", "_date"), undated)["rid"].alias("_stand")
    )
    same, complete = F.lit(True), F.lit(True)
    for k in key:
        same, complete = same & F.col(k).eqNullSafe(F.col(f"_k_{k}")), complete & F.col(k).isNotNull()
    marked = rows.join(groups, same).withColumns({"_stands": F.col("_rid") == F.col("_stand"), "_at_newest": F.when(complete, F.coalesce("_newest", F.lit(0))).otherwise(0)})
    marked = written(marked, "marked")
    for k in key:  # a common part of the key is counted before it meets its rows
        several = marked.where("_stands").groupBy(F.col(k).alias("_part")).count().where("count > 1").select("_part", F.lit(True).alias("_several"))
        marked = marked.join(several, F.col(k).eqNullSafe(F.col("_part")), "left").withColumn(f"_clash_{k}", F.col("_stands") & F.coalesce("_several", F.lit(False))).drop("_part", "_several")
    clashes = F.filter(F.array(*(F.when(F.col(f"_clash_{k}"), F.lit(k)) for k in key)), lambda c: c.isNotNull())
    reasons = F.filter(F.array(*(F.when(F.col(f"_clash_{k}"), F.lit(CONFLICT.get(k, k))) for k in key)), lambda c: c.isNotNull())
    n = F.col("_copies")
    copies = F.format_string(COPIES, n, n - 1)
    motive = (
        F.when(F.col("_at_newest") == 1, F.lit(NEWEST))
        .when(F.col("_date").isNull(), F.lit(UNDATED))
        .otherwise(F.lit(SAME_DATE))
    )
    treatment = (
        F.when(~F.col("_stands"), F.concat(copies, F.lit(PUT_ASIDE)))
        .when(F.size(clashes) > 0, F.concat(F.lit(RESIDUAL), F.array_join(clashes, ", "), F.lit(NOT_SENT), F.array_join(reasons, " ; "), F.lit(")")))
        .when(n == 1, F.lit(UNIQUE))
        .otherwise(F.concat(copies, F.lit(KEPT), motive))
    )
    sent = F.col("_stands") & (F.size(clashes) == 0)
    return marked.select(*df.columns, F.when(sent, F.lit(TRANSFER)).otherwise(F.lit(KEEP_BACK)).alias("action"), treatment.alias("traitement"))


def to_transfer(df: DataFrame, flag_column: str) -> DataFrame:
    """Rows not flagged as transferred yet (boolean or text)."""
    from cartulary.functions.keys import flag

    return df.where(~flag(F.col(flag_column)))
