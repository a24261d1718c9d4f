"""Helpers that several corpus operators use: shared scratch tables, value ranges, stable row order."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it: space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def scratch_root(spark: SparkSession) -> str:
    """The folder all machines share (spark.checkpoint.dir); a local one only where the setting is absent in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        made = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        root = f"file://{made}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def materialize(df: DataFrame, name: str, small: bool = False) -> tuple[DataFrame, str]:
    """Write df as Parquet into the shared folder and read it back: cuts lineage and survives lost executors.

    The folder goes when the application ends. small: a table of narrow rows, possibly few of them; they are rebalanced by
    their bytes first, so a small table has few files and a large one as many as its size asks for.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    (df.hint("rebalance") if small else df).write.parquet(path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def arrow_rows(spark: SparkSession, most: int):
    """While this holds, jobs hand Python at most so many rows at once: for texts, whose rows are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark: SparkSession, most: int = 1000) -> None:
    """Hands Python at most so many rows at once from now on: rows hold whole texts, and the default of 10,000 is made for narrow ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= most:
        spark.conf.set(name, str(most))


def lean(run: Callable) -> Callable:
    """A function over batches that gives freed memory back when its task ends; workers live on and share an executor's memory."""

    def go(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return go


def release() -> None:
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def sweep(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of plans that are done: it does so when the driver collects garbage, which may be long after."""
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def range_bounds(df: DataFrame, key: str, rows_per_range: int = 1024, most: int = 32_768) -> tuple[list[int], int]:
    """Cut points that split `key` into about equal ranges, and the rows of a range. At most `most` numbers reach the driver."""
    n = df.count()
    ranges = min(most, max(1, math.ceil(n / rows_per_range)))
    width = max(rows_per_range, math.ceil(n / ranges))
    if ranges == 1:
        return [], width
    points = ", ".join(f"{i / ranges:.9f}D" for i in range(1, ranges))
    found = df.agg(F.expr(f"approx_percentile({key}, array({points}), {max(10_000, 4 * ranges)})").alias("b")).first()["b"]
    return sorted(set(found or [])), width


#: Places of the parts of a range number.
_SUB, _COPY = 1 << 40, 1 << 20


def dealt_by_id(docs: DataFrame, rows_per_range: int = 1024) -> tuple[DataFrame, int]:
    """doc_id, text, o, h, at for every document, and the number of ranges: `at` numbers ranges of the order (o, h).

    o: doc_id, with nulls first; h: a hash of the text (null: empty), by which documents of one id are ordered. A range holds
    few rows, whatever the ids: one id with many documents is cut by h, and many equal documents of one id, whose
    order makes no difference, are spread over ranges by their place in the table.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    slim = slim.withColumn("o", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("h", F.xxhash64("text"))
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("o"))
    bounds, width = range_bounds(ids, "o", rows_per_range)
    ranged = slim.withColumn("at", range_of(F.col("o"), bounds).cast("long") * _SUB)
    # an id with several ranges' rows is one of the bounds, so its range begins with it
    hot, _ = materialize(ids.groupBy("o").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 4 * width).select("o", F.least(F.ceil(F.col("c") / width), F.lit(_COPY - 2)).alias("m")), "hot-ids")
    if hot.isEmpty():
        return ranged, len(bounds) + 1
    many, _ = materialize(slim.select("o", "h").join(hot, "o", "left_semi").groupBy("o", "h").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 4 * width).select("o", "h", F.least(F.ceil(F.col("c") / width), F.lit(_COPY - 1)).alias("k")), "hot-copies")
    share = F.shiftright(F.col("h"), 32) + F.lit(1 << 31)  # 0 to 2^32, in the order of h
    sub = F.when(F.col("m").isNull(), F.lit(_COPY - 1)).otherwise(F.floor(share * F.col("m") / F.lit(1 << 32)))
    marked = ranged.withColumn("spot", F.monotonically_increasing_id()).join(hot, "o", "left").join(many, ["o", "h"], "left")
    copy = F.when(F.col("k").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("spot"), F.col("k")))
    out = marked.withColumn("at", F.col("at") + sub.cast("long") * _COPY + copy.cast("long"))
    total = hot.agg(F.sum("m")).first()[0] + (many.agg(F.sum("k")).first()[0] or 0)
    return out.select("doc_id", "text", "o", "h", "at"), len(bounds) + 1 + int(total)


def range_of(key: Column, bounds: list[int]) -> Column:
    """Index of the range that key falls in (null: the first), found in two steps of about sqrt(n) comparisons."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.expr("array(" + ",".join(f"{g[0]}L" for g in groups) + ")")
    table = F.expr("array(" + ",".join("array(" + ",".join(f"{b}L" for b in g) + ")" for g in groups) + ")")
    below = F.size(F.filter(heads, lambda b: b <= key))
    inside = F.size(F.filter(F.element_at(table, F.greatest(below, F.lit(1))), lambda b: b <= key))
    return F.when(key.isNull() | (below == 0), F.lit(0)).otherwise((below - 1) * step + inside).cast("int")
