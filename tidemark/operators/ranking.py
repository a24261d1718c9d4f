"""Row numbers of groups that may be too large for one task."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.streaming.scratch import root, temporary


def row_numbers(rows: DataFrame, by: list[str], order: list[str], out: str = "row") -> DataFrame:
    """Numbers from 1 in each group, in order; a group of any size is spread over ranges of the order.

    Rows are dealt by range of group and order, numbered in their range, and shifted by the group's rows in the ranges before.
    Ranges come from a sample, so the dealt rows are written once and read from there: a lost executor can't deal them anew.
    """
    spark = rows.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(spread, *by, *order).withColumn("_part", F.spark_partition_id())
    path = f"{root(spark)}/tidemark/ranked-{uuid.uuid4().hex}"
    dealt.withColumn("_row", F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order))).write.parquet(path)
    saved = spark.read.parquet(temporary(spark, path))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range that a group touches
    counted = saved.groupBy("_part", *by).agg(F.max("_row").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    starts = counted.select(F.col("_part").alias("_p"), "_start", *[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)])
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return saved.join(starts, same).select(*rows.columns, (F.col("_start") + F.col("_row")).alias(out))
