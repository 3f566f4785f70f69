"""Image conversion jobs: parameter sweeps, planned targets, calibration of a quality to a ratio."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cartulary.functions import keys as K, measures as M

# Defaults of the calibration.
RATIO, TOLERANCE, LOWEST, HIGHEST, STEPS = 15.0, 0.10, 1, 100, 8


def sweep(corpora: DataFrame, kind: str, qualities: Sequence[int], floors: Sequence[int]) -> DataFrame:
    """Every corpus with every quality and least width; the parameter lists are short and spread in place."""
    q = F.explode(F.array(*map(F.lit, qualities))).alias("q")
    wide = corpora.select("*", q).select("*", F.explode(F.array(*map(F.lit, floors))).alias("rmin"))
    return wide.withColumn("signature", F.format_string(kind + "_q%d_f%d_rmin%d", "q", "facteur", "rmin"))


def media_mix(files: DataFrame, mark: str, kinds: Sequence[str] = ("tiff", "ocr xml")) -> DataFrame:
    """Masters and texts of the corpora whose code holds a mark, with ``resolution`` (pixels) where dimensions are known."""
    some = files.where(F.contains("corpus_code", F.lit(mark)) & F.col("file_type").isin(*kinds))
    return some.withColumn("resolution", F.col("mix_imageHeight") * F.col("mix_imageWidth"))


def resolution_recap(images: DataFrame, factor: Column, floor: float = 2000.0) -> DataFrame:
    """Per corpus what a reduction by ``factor``, but not below ``floor`` pixels of width, does: median width before and
    after, median resolution after, percent of pixels left, and images reduced, held at the floor and unchanged.

    images: corpus, width, height, dpi; those without a width are left out."""
    scale = F.least(F.lit(1.0), F.greatest(F.col("_f"), F.lit(floor) / F.col("width")))
    r = images.withColumn("_f", factor).where("width is not null").withColumn("_s", scale)
    after = {n: F.bround(F.col(n) * F.col("_s")) for n in ("width", "height", "dpi")}
    median = lambda c: F.percentile(c, F.lit(0.5)).cast("long")
    left = F.bround(F.try_divide(100 * F.sum(after["width"] * after["height"]), F.sum(F.col("width") * F.col("height")))).cast("long")
    small = F.col("_s") < 0.999
    return r.groupBy("corpus").agg(
        median(F.col("width")).alias("x_before"), median(after["width"]).alias("x_after"), median(after["dpi"]).alias("dpi_after"), left.alias("pixels_left"),
        F.count_if(small).alias("reduced"), F.count_if(small & (F.col("width") * F.col("_f") < floor)).alias("at_floor"), F.count_if(~small).alias("unchanged"),
    )


def target_path(source: Column, root: str, signature: Column, extension: str) -> Column:
    return F.concat_ws("/", F.lit(root), signature, F.concat(K.stem(K.basename(source)), F.lit("_"), signature, F.lit(extension)))


def plan_jobs(images: DataFrame, parameters: DataFrame, root: str, extension: str, done: DataFrame) -> DataFrame:
    """Jobs (image, parameters, scale, target) of which the target isn't there yet.  ``parameters`` is joined on the
    images' ``corpus``."""
    jobs = images.join(parameters, "corpus")
    jobs = jobs.withColumn("scale", M.reduction(F.col("width"), 1.0).cast("double") if "facteur" not in jobs.columns else F.least(F.lit(1.0), F.greatest(F.col("facteur") / 100, F.col("rmin") / F.col("width"))))
    jobs = jobs.withColumn("target", target_path(F.col("source"), root, F.col("signature"), extension))
    return jobs.join(done.select(F.col("path").alias("target")), "target", "left_anti")


@dataclass
class Calibration:
    quality: int
    ratio: float
    size: int
    steps: int


def calibrate(raw: int, encode: Callable[[int], int], target: float = RATIO, tolerance: float = TOLERANCE, low: int = LOWEST, high: int = HIGHEST, steps: int = STEPS) -> Calibration:
    """Bisect the quality until raw / size is within ``tolerance`` of the target; the nearest try stands.

    ``encode`` gives the size in bytes at a quality, larger for higher quality.
    """
    best, tried = None, 0
    while low <= high and tried < steps:
        quality = (low + high) // 2
        size = encode(quality)
        ratio = raw / size if size else float("inf")
        tried += 1
        if best is None or abs(ratio - target) < abs(best.ratio - target):
            best = Calibration(quality, ratio, size, tried)
        if abs(ratio - target) <= tolerance * target:
            break
        low, high = (quality + 1, high) if ratio > target else (low, quality - 1)
    if best is None:
        raise ValueError("no quality to try")
    best.steps = tried
    return best


def calibrate_images(images: DataFrame, encoder: Callable[[bytes, int], bytes], raw_size: str = "raw", content: str = "content", **options) -> DataFrame:
    """Calibration of each image: path, quality, ratio, size, steps, error.  One failing image fails only its row."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for path, raw, data in zip(b.column("path").to_pylist(), b.column(raw_size).to_pylist(), b.column(content)):
                try:
                    payload = data.as_py()
                    got = calibrate(raw, lambda q: len(encoder(payload, q)), **options)
                    rows.append((path, got.quality, got.ratio, got.size, got.steps, None))
                except Exception as e:  # noqa: BLE001 - reported in the row
                    rows.append((path, None, None, None, None, str(e)[:500]))
            kinds = [pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], ["path", "quality", "ratio", "size", "steps", "error"])

    return images.select("path", raw_size, content).mapInArrow(run, "path string, quality int, ratio double, size long, steps int, error string")


RUN = "source string, target string, signature string, size long, width int, height int, error string"


def run_jobs(jobs: DataFrame, encode: Callable[[bytes, dict], tuple[bytes, int, int]]) -> DataFrame:
    """Convert planned jobs (source, target, signature, scale): read, encode, write; a log row each.

    ``encode`` takes a file's bytes and its job, and gives bytes, width and height.  One failing job fails only its row."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs

        for b in batches:
            rows = []
            for job in b.to_pylist():
                head = (job["source"], job["target"], job["signature"])
                try:
                    (fs, at), (to, z) = map(pafs.FileSystem.from_uri, head[:2])
                    with fs.open_input_stream(at, compression=None) as data:
                        made, width, height = encode(data.read(), job)
                    to.create_dir(z.rsplit("/", 1)[0], recursive=True)
                    with to.open_output_stream(z, compression=None) as out:
                        out.write(made)
                    rows.append((*head, len(made), width, height, None))
                except Exception as e:  # noqa: BLE001 - reported in the row
                    rows.append((*head, None, None, None, str(e)[:500]))
            kinds = [pa.string()] * 3 + [pa.int64(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)], ["source", "target", "signature", "size", "width", "height", "error"])

    return jobs.select("source", "target", "signature", "scale").mapInArrow(run, RUN)


def chain(manifest: DataFrame, source: str, destination: str, stem: str, parameters: DataFrame, root: str, extension: str, encode: Callable[[bytes, dict], tuple[bytes, int, int]]) -> tuple[DataFrame, DataFrame]:
    """Copy the files of a manifest (corpus_code, name, path, s3_key, width), then convert those that arrived by the
    parameters of their corpus (corpus, signature, facteur, rmin); the two logs, written.  A run can be taken up again."""
    from cartulary.operators.materialise import written
    from cartulary.sources import writers

    copied = written(writers.copy_files(manifest, source, destination, stem), "copied")
    here = copied.where(F.col("statut").isin(writers.COPIED, writers.THERE)).select(F.col("corpus_code").alias("corpus"), "name", F.col("dst").alias("source"))
    images = here.join(manifest.select(F.col("corpus_code").alias("corpus"), "name", "width"), ["corpus", "name"])
    done = images.sparkSession.createDataFrame([], "path string")
    return copied, written(run_jobs(plan_jobs(images, parameters, root, extension, done), encode), "converted")


def versions(log: DataFrame, signatures: Sequence[str]) -> DataFrame:
    """One row per source, a column of sizes per signature (widths to compare, say); failed versions are null."""
    from cartulary.operators.aggregates import wide_by_signature

    return wide_by_signature(log.where("error is null"), "source", "signature", list(signatures), "size", "target")
