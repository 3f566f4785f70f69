"""Command line of the jobs: ``python -m cartulary.cli JOB --input ... --output ...``.

Inputs are Parquet folders or CSV files with a header (all columns as text there);
outputs are gzipped CSV folders, or Parquet where the name ends in ``.parquet``.
"""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cartulary.functions import keys as K
from cartulary.operators import aggregates, enrich, sampling, survive
from cartulary.plans import catalogue
from cartulary.operators.materialise import written
from cartulary.plans.images import resolution_recap
from cartulary.plans.reconcile import rebuild
from cartulary.schemas import INVENTORY, RECAP, REFERENCE
from cartulary.sources import clients, readers, writers

IMAGES = StructType([StructField("corpus", StringType()), *(StructField(c, DoubleType()) for c in ("width", "height", "dpi"))])


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.csv(path, header=True, multiLine=True, escape='"', nullValue=readers.MISSING)


def save(df: DataFrame, path: str) -> None:
    if path.rstrip("/").endswith(".parquet"):
        df.write.mode("overwrite").parquet(path)
    else:
        writers.write_csv(df, path, mode="overwrite")


def typed(df: DataFrame, schema) -> DataFrame:
    """Columns of a schema cast to its types; texts that don't fit become null."""
    return df.select([F.col(f.name).cast("string").try_cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def s3_join(spark: SparkSession, a) -> DataFrame:
    return enrich.add_objects(load(spark, a.input), load(spark, a.listing))


def oai_join(spark: SparkSession, a) -> DataFrame:
    return enrich.add_records(load(spark, a.input), load(spark, a.records), a.unitid_col)


def dao_join(spark: SparkSession, a) -> DataFrame:
    return enrich.add_links(load(spark, a.input), load(spark, a.dao), a.sources)


def dao_match(spark: SparkSession, a) -> DataFrame:
    links = load(spark, a.brut).withColumn("profondeur", F.col("profondeur").try_cast("int"))
    return catalogue.associate(links, load(spark, a.ref), (a.renamed_from, a.renamed_to))


def dedup(spark: SparkSession, a) -> DataFrame:
    rows = survive.to_transfer(load(spark, a.input), a.flag_col)
    tie = [c for c in ("uuid",) if c in rows.columns]
    return survive.decide_transfers(rows, a.key, a.sort, a.date_col, tie).orderBy(*a.sort)


def sample(spark: SparkSession, a) -> DataFrame:
    rows = sampling.codes_with_prefix(load(spark, a.input), "corpus_code", a.codes).withColumn("size", F.col("size").try_cast("long"))
    return sampling.balanced_sample(rows, "corpus_code", "size", sampling.shuffled_order(a.seed, "uuid"), a.most_rows, a.most_gb * 1e9)


def concat(spark: SparkSession, a) -> DataFrame:
    rows, bad = readers.read_strict(spark, a.input, RECAP, exclude=a.exclude)
    for r in bad.toLocalIterator():
        print(f"left out: {r.path}: {r.problem}")
    return rows


def pivot(spark: SparkSession, a) -> DataFrame:
    rows = load(spark, a.input)
    for v in a.values:
        rows = rows.withColumn(v, F.col(v).try_cast("double"))
    if "corpus" not in rows.columns and "source" in rows.columns:
        rows = rows.withColumn("corpus", K.corpus_of_path(F.col("source")))
    return aggregates.generic_pivot(rows, a.index, a.columns, a.values, a.aggfunc, a.decimales)


def summary(spark: SparkSession, a) -> DataFrame:
    rows = typed(load(spark, a.input), RECAP)
    rows = rows.withColumn("corpus", K.corpus_after(F.col("source"), a.marqueur)).withColumn("signature", K.parameter_signature(F.col("fichier")))
    out = aggregates.parameter_summary(rows, ["corpus", "signature"], "source_taille_octets", "taille_octets")
    return out.select("corpus", "signature", "n", *(F.bround(c, a.decimales).alias(c) for c in out.columns[3:]))


def rebuild_reference(spark: SparkSession, a) -> DataFrame:
    old = typed(load(spark, a.ref), REFERENCE)
    return rebuild(old, typed(load(spark, a.input), INVENTORY), a.year, a.source, [f.name for f in REFERENCE.fields])


def harvest(spark: SparkSession, a) -> DataFrame:
    sets = spark.createDataFrame(clients.harvest_sets(a.input), "setspec string, setname string")
    return readers.harvest(spark, sets.repartition(max(1, sets.count())), clients.harvest_records(a.input), a.prefix, a.replacement)


def transfer(spark: SparkSession, a) -> DataFrame:
    """The log also tells how many files ended in each state."""
    log = written(writers.copy_files(load(spark, a.input), a.source, a.destination, Path(a.input.rstrip("/")).name.split(".")[0]), "copies")
    for r in log.groupBy("statut").count().orderBy("statut").collect():
        print(f"{r.statut}: {r['count']}")
    return log


def checksums(spark: SparkSession, a) -> DataFrame:
    return readers.digests(readers.discover(spark, a.input, a.pattern))


def images(spark: SparkSession, a) -> DataFrame:
    rows = typed(load(spark, a.input), IMAGES)
    return resolution_recap(rows, F.lit(a.factor), a.floor)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cartulary", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, *options: tuple[str, dict]) -> None:
        p = jobs.add_parser(name)
        p.add_argument("--input", required=not any(o == "--brut" for o, _ in options))
        p.add_argument("--output", "--out", required=True)
        for option, how in options:
            p.add_argument(option, **how)
        p.set_defaults(run=run)

    need, many = {"required": True}, {"nargs": "+", "required": True}
    job("s3-join", s3_join, ("--listing", need))
    job("oai-join", oai_join, ("--records", need), ("--unitid-col", {"default": "unitid"}))
    job("dao-join", dao_join, ("--dao", need), ("--sources", many))
    job("dao-match", dao_match, ("--ref", need), ("--brut", need), ("--renamed-from", {"default": ""}), ("--renamed-to", {"default": ""}))
    job("dedup", dedup, ("--key", {"nargs": "+", "default": ["checksum_md5", "name"]}), ("--sort", {"nargs": "+", "default": ["name", "path"]}), ("--date-col", {"default": "last_content_modification_date"}), ("--flag-col", {"default": "s3_uploaded"}))
    job("sample", sample, ("--codes", many), ("--seed", {"type": int, "default": 5}), ("--most-rows", {"type": int, "default": 600}), ("--most-gb", {"type": float, "default": 200.0}))
    job("concat", concat, ("--exclude", {"default": None}))
    job("pivot", pivot, ("--index", many), ("--columns", {"nargs": "*", "default": []}), ("--values", many), ("--aggfunc", {"nargs": "+", "default": ["mean"], "choices": ["mean", "median", "sum", "count"]}), ("--decimales", {"type": int, "default": 2}))
    job("summary", summary, ("--marqueur", need), ("--decimales", {"type": int, "default": 2}))
    job("rebuild", rebuild_reference, ("--ref", need), ("--year", {"type": int, "required": True}), ("--source", {"default": "az"}))
    job("harvest", harvest, ("--prefix", need), ("--replacement", need))
    job("transfer", transfer, ("--source", need), ("--destination", need))
    job("checksums", checksums, ("--pattern", {"default": "*"}))
    job("image-recap", images, ("--factor", {"type": float, "required": True}), ("--floor", {"type": float, "default": 2000.0}))
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(arguments)
    session = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    save(a.run(session, a), a.output)


if __name__ == "__main__":
    main()
