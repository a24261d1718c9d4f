"""The shared folder for tables between jobs."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local folder only where it is unset in local mode."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        made = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        at = f"file://{made}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def temporary(spark: SparkSession, path: str) -> str:
    """The path of a folder that is there and goes when the application ends."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path
