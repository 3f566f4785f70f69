"""Reports: histograms as text, crosstabs, pivots with margins, dashboards with a grand total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MISSING = "NON RENSEIGNÉ"


def histogram_text(df: DataFrame, keys: Sequence[str], column: str, name: str, missing: str = MISSING) -> DataFrame:
    """Per key "value (n) ; value (n)", the most frequent first, then by value; two pre-aggregated steps."""
    counts = df.groupBy(*keys, F.coalesce(F.col(column).cast("string"), F.lit(missing)).alias("_v")).agg(F.count("*").alias("_n"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v"))))
    text = F.array_join(F.transform(listed, lambda x: F.concat(x["v"], F.lit(" ("), (-x["n"]).cast("string"), F.lit(")"))), " ; ")
    return counts.groupBy(*keys).agg(text.alias(name))


def role_counts(df: DataFrame, keys: Sequence[str], flags: dict[str, Column], total: str = "total", rest: str = "reste") -> DataFrame:
    """Per key the rows, the rows of each flag, and the rows without the first flag."""
    counts = df.groupBy(*keys).agg(F.count("*").alias(total), *(F.count_if(c).alias(n) for n, c in flags.items()))
    return counts.withColumn(rest, F.col(total) - F.col(next(iter(flags))))


def totals_by(df: DataFrame, row: str, column: str, measures: dict[str, Column], total: str = "Total") -> DataFrame:
    """Several measures by row and column, in long form, with a total of each row and one of all; null keys are left out."""
    known = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    rolled = known.rollup(row, column).agg(*(m.alias(n) for n, m in measures.items()), F.grouping_id().alias("_g"))
    return rolled.select(
        F.when(F.col("_g") == 3, total).otherwise(F.col(row).cast("string")).alias(row), F.when(F.col("_g") > 0, total).otherwise(F.col(column).cast("string")).alias(column), *measures
    )


def spread(df: DataFrame, keys: Sequence[str], medians: dict[str, Column], quartiles: dict[str, Column], counts: dict[str, Column]) -> DataFrame:
    """Per key the rows, exact medians, first and third quartiles (name_q1, name_q3), and rows that pass tests."""
    at = lambda c, p: F.percentile(c, F.lit(p))
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), *(at(c, 0.5).alias(n) for n, c in medians.items()), *(at(c, p).alias(f"{n}_{q}") for n, c in quartiles.items() for q, p in (("q1", 0.25), ("q3", 0.75))),
        *(F.count_if(c).alias(n) for n, c in counts.items()),
    )


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole in decimals, half to even; null for an empty whole."""
    return F.bround(F.try_divide(F.lit(100).cast("decimal(20,6)") * part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")), digits).cast("double")


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """Counts of row by column, zero where none; null keys are left out."""
    known = df.where(F.col(row).isNotNull() & F.col(column).isNotNull()).groupBy(row)
    return (known.pivot(column, list(values)) if values else known.pivot(column)).count().na.fill(0)


def pivot_with_margins(df: DataFrame, index: str, column: str, values: Sequence[str], measure: Column, total: str = "Total") -> DataFrame:
    """Pivot with a total row and column, from one cube; zero where none."""
    known = df.where(F.col(index).isNotNull() & F.col(column).isNotNull())
    cube = known.cube(index, column).agg(measure.alias("_m"), F.grouping(index).alias("_gi"), F.grouping(column).alias("_gc"))
    labelled = cube.select(
        F.when(F.col("_gi") == 1, F.lit(total)).otherwise(F.col(index).cast("string")).alias(index),
        F.when(F.col("_gc") == 1, F.lit(total)).otherwise(F.col(column).cast("string")).alias("_c"),
        "_m",
    )
    return labelled.groupBy(index).pivot("_c", [*values, total]).agg(F.max("_m")).na.fill(0)


def total_by(df: DataFrame, keys: Sequence[str], measure: Column, name: str, total: str = "Total") -> DataFrame:
    """Grouped measure with one grand-total row; null keys are left out."""
    known = df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    rolled = known.rollup(*keys).agg(measure.alias(name), F.grouping_id().alias("_g")).where(F.col("_g").isin(0, (1 << len(keys)) - 1))
    label = [F.when(F.col("_g") > 0, F.lit(total if i == 0 else "")).otherwise(F.col(k).cast("string")).alias(k) for i, k in enumerate(keys)]
    return rolled.select(*label, name)


def generic_pivot(df: DataFrame, index: Sequence[str], columns: Sequence[str], values: Sequence[str], functions: Sequence[str], decimals: int = 2) -> DataFrame:
    """Chosen index, columns, values and functions (mean, median, sum, count), rounded."""
    made = {
        "mean": lambda c: F.bround(F.avg(c), decimals),
        "median": lambda c: F.bround(F.percentile(c, F.lit(0.5)), decimals),
        "sum": lambda c: F.bround(F.sum(c).cast("double"), decimals),
        "count": lambda c: F.count(c),
    }
    aggs = [made[f](F.col(v)).alias(f"{v}_{f}") for v in values for f in functions]
    if not columns:
        return df.groupBy(*index).agg(*aggs)
    label = F.concat_ws("_", *(F.col(c).cast("string") for c in columns))
    return df.withColumn("_c", label).groupBy(*index).pivot("_c").agg(*aggs)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def counts_with_zero(groups: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Rows per listed group, zero for groups without rows."""
    return groups.select(key).distinct().join(df.groupBy(key).agg(F.count("*").alias("n")), key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def multiple_members(df: DataFrame, key: str, member: str) -> DataFrame:
    """One row: keys, keys of several members, most members of a key."""
    per = df.groupBy(key).agg(F.count_distinct(member).alias("k"))
    return per.agg(F.count("*").alias("keys"), F.count_if(F.col("k") > 1).alias("several"), F.max("k").alias("most"))


def wide_by_signature(df: DataFrame, key: str, signature: str, values: Sequence[str], value: str, position: str) -> DataFrame:
    """One row per key, one column per signature; of repeats the last by position."""
    return df.groupBy(key).pivot(signature, list(values)).agg(F.max_by(value, position))


def parameter_summary(df: DataFrame, keys: Sequence[str], source: str, target: str) -> DataFrame:
    """Per parameter set: images, sizes in MiB, mean of each image's ratio and gain; only positive sizes count."""
    ok = df.where((F.col(source) > 0) & (F.col(target) > 0))
    mib = lambda c: c / F.lit(1048576.0)
    return ok.groupBy(*keys).agg(
        F.count("*").alias("n"),
        mib(F.sum(target)).alias("total_mib"),
        mib(F.avg(target)).alias("mean_mib"),
        mib(F.min(target)).alias("min_mib"),
        mib(F.max(target)).alias("max_mib"),
        F.avg(F.col(source) / F.col(target)).alias("mean_ratio"),
        F.avg(100 * (1 - F.col(target) / F.col(source))).alias("mean_gain"),
    )


def dashboard(df: DataFrame, key: str, identity: str, size: str, status: str, published: str, treated: Column, yes: str = "oui", total: str = "TOTAL") -> DataFrame:
    """Per corpus: files (rows with an id), volume, status histogram, share treated, published; and a total over
    all rows, those without a corpus too, whose file count is of rows."""
    volume = F.bround(F.sum(size).cast("decimal(30,2)") / F.lit(1_000_000_000), 2).cast("double")
    share = percent(F.count_if(treated), F.count("*"))
    public = F.count_if(F.col(published) == yes)
    known = df.where(F.col(key).isNotNull())
    rows = known.groupBy(key).agg(F.count(identity).alias("fichiers"), volume.alias("volume_go"), share.alias("traitement_s3"), public.alias("fichiers_publies"))
    rows = rows.join(histogram_text(known, [key], status, status), key)
    sums = df.agg(F.count("*").alias("fichiers"), volume.alias("volume_go"), share.alias("traitement_s3"), public.alias("fichiers_publies"))
    return rows.unionByName(sums.withColumn(key, F.lit(total)), allowMissingColumns=True)


def directory_report(df: DataFrame, path: str, status: str, treated: Column) -> DataFrame:
    """Directories with files that aren't treated: how many, and their status histogram."""
    left = df.where(~treated)
    return left.where(F.col(path).isNotNull()).groupBy(path).agg(F.count("*").alias("nb_fichiers")).join(histogram_text(left, [path], status, "repartition"), path)
