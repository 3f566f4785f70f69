"""Loose matching by keys: tiers, loosest key then classification, in-group anti-match, radical lookup."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def tiered(left: DataFrame, right: DataFrame, tiers: Sequence[tuple[str, Callable[[Column], Column]]], stem: str = "stem") -> DataFrame:
    """Pairs (left_stem, right_stem, methode) of distinct stems, each tier on what the last one left.

    The first tier keeps every equal key; looser tiers reduce the right to the least stem per key.
    """
    rest = left.select(F.col(stem).alias("left_stem")).where("left_stem is not null").distinct()
    refs = right.select(F.col(stem).alias("right_stem")).where("right_stem is not null").distinct()
    out = None
    for i, (name, key) in enumerate(tiers):
        l = rest.withColumn("_key", key(F.col("left_stem")))
        r = refs.withColumn("_key", key(F.col("right_stem")))
        if i:
            r = r.groupBy("_key").agg(F.min("right_stem").alias("right_stem"))
        hit = l.join(r, "_key").select("left_stem", "right_stem", F.lit(name).alias("methode"))
        out = hit if out is None else out.unionByName(hit)
        rest = l.join(r.select("_key"), "_key", "left_anti").select("left_stem")
    return out


def fan_out(pairs: DataFrame, links: DataFrame, files: DataFrame, link_stem: str, file_stem: str, columns: Sequence[str]) -> DataFrame:
    """Matched stems back to all links and all files of theirs, distinct rows."""
    a = links.withColumnRenamed(link_stem, "left_stem").join(pairs, "left_stem")
    return a.join(files.withColumnRenamed(file_stem, "right_stem"), "right_stem").select(*columns).distinct()


def loosest_then_classify(
    orphans: DataFrame, refs: DataFrame, family: str, keys: Sequence[tuple[str, Callable[[Column], Column]]], name: str = "stem", none: str = "aucun"
) -> DataFrame:
    """Candidates by the loosest (last) key within a family; ``methode`` is the strictest key under which they agree.

    Orphans without a candidate stay, with ``none``.  Where a candidate is of a master format
    (``is_master``), the others go.
    """
    loosest = keys[-1][1]
    o = orphans.withColumn("_k", loosest(F.col(name)))
    r = refs.select(F.col(name).alias("ref_stem"), F.col(family).alias("_f"), "ref_id", "is_master").withColumn("_k2", loosest(F.col("ref_stem")))
    both = o.join(r, (F.col("_k") == F.col("_k2")) & (F.col(family) == F.col("_f")), "left")
    method = F.coalesce(*(F.when(key(F.col(name)) == key(F.col("ref_stem")), F.lit(label)) for label, key in keys), F.lit(none))
    w = Window.partitionBy(*orphans.columns)
    kept = both.withColumn("methode", method).withColumn("_any", F.max(F.coalesce(F.col("is_master"), F.lit(False))).over(w))
    return kept.where(~F.col("_any") | F.col("is_master")).select(*orphans.columns, "ref_stem", "ref_id", "methode").distinct()


def best_method(df: DataFrame, keys: Sequence[str], ranks: Sequence[str]) -> DataFrame:
    from cartulary.operators.survive import ranked_choice

    return df.groupBy(*keys).agg(F.min_by("methode", ranked_choice("methode", ranks)).alias("methode"))


def missing_in_group(links: DataFrame, group: str, wanted: Column, present: Column, family: str, keys: Column) -> DataFrame:
    """``wanted`` links of a group that share no key of their family with a ``present`` link of the group."""
    spread = links.withColumn("_keys", keys)
    have = spread.where(present).select(F.col(group).alias("_g"), F.col(family).alias("_f"), F.explode("_keys").alias("_key")).distinct()
    need = spread.where(wanted).withColumn("_id", F.monotonically_increasing_id())
    met = (
        need.select("_id", group, family, F.explode("_keys").alias("_k"))
        .join(have, (F.col(group) == F.col("_g")) & (F.col(family) == F.col("_f")) & (F.col("_k") == F.col("_key")), "left_semi")
        .select("_id").distinct()
    )
    return need.join(met, "_id", "left_anti").drop("_id", "_keys")


def radical_lookup(links: DataFrame, files: DataFrame, first: Column, second: Column, radical: str, columns: Sequence[str]) -> DataFrame:
    """The file of a link's first radical, or else of its second; ``found`` says which (first, second, none)."""
    a = files.select(F.col(radical).alias("_a"), *[F.col(c).alias(f"_a_{c}") for c in columns], F.lit(True).alias("_in_a"))
    b = files.select(F.col(radical).alias("_b"), *[F.col(c).alias(f"_b_{c}") for c in columns], F.lit(True).alias("_in_b"))
    out = links.withColumn("_first", first).withColumn("_second", second)
    out = out.join(a, F.col("_first") == F.col("_a"), "left").join(b, F.col("_second") == F.col("_b"), "left")
    found = F.when(F.col("_in_a"), F.lit("first")).when(F.col("_in_b"), F.lit("second")).otherwise(F.lit("none"))
    pick = [F.when(F.col("_in_a"), F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")).alias(c) for c in columns]
    return out.select(*links.columns, *pick, found.alias("found"))
