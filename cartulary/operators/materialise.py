"""Written intermediate tables, in the folder that ``spark.checkpoint.dir`` names, and the size of Arrow batches."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share, one level per application.

    Only where the setting is unset and the master is local, a temporary folder serves
    (recorded in the session, deleted at exit).
    """
    root = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{KEY} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cartulary-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        root = f"file://{folder}"
        spark.conf.set(KEY, root)
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


#: Bytes of a Parquet row group of whole texts, compressed: writers hold one, readers decode up to 4096 of its rows at once.
TEXT_GROUP = 1 << 20


def written(df: DataFrame, label: str, texts: bool = False) -> DataFrame:
    """``df`` written as Parquet where all executors read it, and read back; ``texts``: its rows hold whole documents."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    (df.write.option("parquet.block.size", TEXT_GROUP) if texts else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` returned; nothing may read it any more."""
    path = getattr(df, "written_to", None)
    if path:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


#: Rows and bytes of an Arrow batch of texts, unless the session states its own.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def bounded_batches(df: DataFrame) -> None:
    """Keep Arrow batches small enough for a worker's memory where the session leaves their size open."""
    conf = df.sparkSession.conf
    for key, value in BATCH.items():
        if conf.get(key, None) is None:
            conf.set(key, value)
