"""Enrichment joins: one right row per key, authoritative or coalesced columns, and the final merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cartulary.functions import keys as K
from cartulary.functions.measures import day_number
from cartulary.operators.survive import first_per_key, ranked_choice


def overwrite(df: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join that replaces ``columns`` by the right side's, null where it has none."""
    return df.drop(*(c for c in columns if c in df.columns)).join(right.select(key, *columns), key, "left")


def add_objects(df: DataFrame, listing: DataFrame) -> DataFrame:
    """Object-store columns by uuid; the listing counts once per uuid, the first by key."""
    one = first_per_key(listing.where("uuid is not null"), ["uuid"], ["key", "s3_bucket"])
    right = one.select(
        "uuid", F.col("key").alias("s3_key"), F.lit(True).alias("s3_uploaded"), day_number(F.col("last_modified")).alias("s3_uploaded_date"), "s3_bucket"
    )
    out = overwrite(df, right, "uuid", ["s3_key", "s3_uploaded", "s3_uploaded_date", "s3_bucket"])
    return out.withColumn("s3_uploaded", F.coalesce("s3_uploaded", F.lit(False)))


def add_records(df: DataFrame, records: DataFrame, unitid: str = "unitid") -> DataFrame:
    """Harvested records by normalised shelf-mark; the first record by identifier counts."""
    keyed = records.withColumn("_mark", K.shelfmark(F.col("cote"))).where("_mark is not null and _mark <> ''")
    one = first_per_key(keyed, ["_mark"], ["identifier"]).select("_mark", F.col("setname").alias("oai_set"), "osiros_id")
    out = df.withColumn("_mark", K.shelfmark(F.col(unitid)))
    return overwrite(out, one, "_mark", ["oai_set", "osiros_id"]).drop("_mark")


def add_links(df: DataFrame, associations: DataFrame, sources: Sequence[str]) -> DataFrame:
    """One (finding aid, unitid) per uuid: by rank of its source, then by name."""
    ranked = associations.withColumn("_source", ranked_choice("source", sources))
    one = first_per_key(ranked, ["uuid"], ["_source", "finding_aid", "unitid"])
    right = one.select("uuid", F.col("finding_aid").alias("dao_finding_aid"), F.col("unitid").alias("dao_unitid"))
    return df.join(right, "uuid", "left")


def merge(new: DataFrame, old: DataFrame, key: Sequence[str], policy: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    """``new`` left-joined to the first ``old`` row per key (by ``order``).

    ``policy`` says for a column what the result takes: ``new``, ``old``, ``new_or_old`` or
    ``old_or_new``; unlisted columns come from ``new``, and from ``old`` if only it has them.
    """
    one = first_per_key(old, key, list(order))
    r = one.select([F.col(c).alias("o_" + c) for c in one.columns])
    on = None
    for k in key:
        c = F.col(k).eqNullSafe(F.col("o_" + k))
        on = c if on is None else on & c
    both = new.join(r, on, "left")

    def pick(c: str) -> Column:
        how = policy.get(c, "new" if c in new.columns else "old")
        n = F.col(c) if c in new.columns else F.lit(None)
        o = F.col("o_" + c) if c in old.columns else F.lit(None)
        return {"new": n, "old": o, "new_or_old": F.coalesce(n, o), "old_or_new": F.coalesce(o, n)}[how].alias(c)

    names = [*new.columns, *(c for c in old.columns if c not in new.columns)]
    return both.select([pick(c) for c in names])


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The stated columns in their order, null where missing."""
    return df.select([F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def fill_from(df: DataFrame, right: DataFrame, key: str, column: str) -> DataFrame:
    """Nulls of ``column`` filled by key."""
    r = right.groupBy(key).agg(F.max(column).alias("_fill"))
    return df.join(r, key, "left").withColumn(column, F.coalesce(column, "_fill")).drop("_fill")


def full_outer_using(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join; columns of the right replace those of the left that share their name."""
    shared = [c for c in left.columns if c in right.columns and c != key]
    return left.drop(*shared).join(right, key, "full_outer")


def with_technical(files: DataFrame, technical: DataFrame) -> DataFrame:
    """Files (path, name) that have technical metadata, with its columns, by their uri."""
    uri = F.concat_ws("/", "path", "name")
    return files.withColumn("uri", uri).join(technical, F.col("uri") == F.col("jhove_uri"))


def type_mismatches(files: DataFrame) -> DataFrame:
    """Rows of ``with_technical`` whose two media types differ; an unknown type differs from any."""
    return files.where(~F.coalesce(F.col("mimetype") == F.col("jhove_mimeType"), F.lit(False)))


def swapped(df: DataFrame, a: str, b: str) -> DataFrame:
    """Two columns with their values exchanged, as old snapshots need it whose dates were the wrong way round."""
    return df.withColumns({a: F.col(b), b: F.col(a)})
