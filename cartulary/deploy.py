"""Ships the package to Python workers that can't import it."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add this package to the application's Python files, once; not needed where PYTHONPATH has it."""
    root = Path(__file__).resolve().parent
    paths = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    app = spark.sparkContext.applicationId
    if str(root.parent) in paths or app in _shipped:
        return
    _shipped.add(app)
    with tempfile.TemporaryDirectory() as folder:
        archive = shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name)
        spark.sparkContext.addPyFile(archive)
        if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
            spark.range(1).rdd.count()  # local executors fetch the file from where it lies; have them do it now
