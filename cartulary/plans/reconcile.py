"""Rebuilding the file reference from its last state and a new inventory."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cartulary.functions import keys as K
from cartulary.functions.measures import epoch_day
from cartulary.operators import enrich, ids, linkage

EXACT = ["name", "path", "size", "last_content_modification_date", "last_metadata_modification_date"]
RELAXED = ["name", "path", "size"]


@dataclass
class Reconciliation:
    """Matched rows with their uuid and tier, and what is left on either side."""

    matched: DataFrame
    left: DataFrame
    right: DataFrame


def cascade(old: DataFrame, new: DataFrame) -> Reconciliation:
    """Tiers: full metadata, then name, path and size where unique, then name and checksum where
    unique, then repeated checksums told apart by name and path.

    ``old`` needs uuid and checksum_md5.  ``new`` needs checksum_md5 for what the first two
    tiers leave (a null matches null only).
    """
    carry = ["checksum_md5", "uuid"]
    r = old.select(*EXACT, *carry)
    l = new.select(*EXACT, F.col("checksum_md5").alias("new_checksum"))
    one = linkage.match_exact(l, r, EXACT, carry, write=True)
    two = linkage.match_unique(one.left, one.right, RELAXED, carry, write=True)
    summed = two.left.withColumnRenamed("new_checksum", "checksum_md5")
    three = linkage.match_unique(summed, two.right, ["name", "checksum_md5"], ["uuid"], write=True)
    four = linkage.match_unique(three.left, three.right, ["name", "path", "checksum_md5"], ["uuid"], write=True)
    columns = [*EXACT, "checksum_md5", "uuid"]
    matched = (
        one.ok.select(*columns, F.lit(1).alias("tier"))
        .unionByName(two.ok.select(*columns, F.lit(2).alias("tier")))
        .unionByName(three.ok.select(*columns, F.lit(3).alias("tier")))
        .unionByName(four.ok.select(*columns, F.lit(4).alias("tier")))
    )
    return Reconciliation(matched, four.left, four.right)


def rebuild(old: DataFrame, new: DataFrame, year: int, source: str = "az", columns: list[str] | None = None) -> DataFrame:
    """The new reference: matched rows, files of ``year`` under new uuids, and rows of other sources as they were.

    Derived columns are computed anew; enriched ones are coalesced new over old, technical
    ones inherited, the status inherited where it is known.
    """
    clean = lambda d: d.where(~K.is_junk(F.col("name"))).withColumn("path", K.forward_slashes(F.col("path")))
    mine, foreign = linkage.partition_source(clean(old), "source2s3", source)
    found = cascade(mine, clean(new))
    days = found.left.withColumn("_c", epoch_day(F.col("last_content_modification_date"))).withColumn("_m", epoch_day(F.col("last_metadata_modification_date")))
    fresh, _ = linkage.new_files(days, "_c", "_m", year)
    minted = ids.new_uuids(fresh.drop("_c", "_m"))
    known = found.matched.drop("tier").unionByName(minted.select(*found.matched.drop("tier").columns))
    known = known.withColumn("source2s3", F.lit(source)).unionByName(foreign.select(*known.columns, "source2s3"))
    mime = K.mime_type(F.col("name"))
    extension = K.last_extension(F.col("name"))
    derived = known.withColumn("extension", extension).withColumn("file_type", K.file_type(mime, extension))
    keep = [c for c in old.columns if c not in derived.columns]
    policy = {c: "new" for c in derived.columns}
    merged = enrich.merge(derived, old.select(*["uuid", "checksum_md5"], *keep), ["uuid", "checksum_md5"], policy, keep[:1] or ["uuid"])
    return merged.select(*(columns or [c for c in old.columns if c in merged.columns]))
