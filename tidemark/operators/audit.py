"""Before and after capture of transformed events, and what is asked of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.filters import CaptureFilter, without_control


def canonical_json(data: Column, nulls: bool = False) -> Column:
    """A map as JSON with sorted keys; nulls: keys without a value are written too."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(data))), {"ignoreNullFields": "false"} if nulls else {})


def payload_hash(data: Column, nulls: bool = False) -> Column:
    """SHA-256 of the canonical JSON."""
    return F.sha2(canonical_json(data, nulls), 256)


def before(events: DataFrame, chosen: CaptureFilter | None = None, sample: Column | None = None) -> DataFrame:
    """Audit rows of events about to be transformed; the correlation id is the event's own identity, so reruns agree."""
    chosen = chosen or CaptureFilter()
    rows = without_control(events)
    if not chosen.takes("before"):
        rows = rows.filter(F.lit(False))
    rows = rows.filter(chosen.column())
    if sample is not None:
        rows = rows.filter(sample)
    return rows.select(F.concat_ws("-", "table_schema", "table_name", "lsn", "seq").alias("correlation_id"), "table_schema", "table_name", "op", "lsn", "seq", F.lit("before").alias("capture_stage"), F.lit(False).alias("filtered"), canonical_json(F.col("data")).alias("payload"), payload_hash(F.col("data")).alias("payload_hash"), F.col("ts").alias("message_timestamp"))


def after(transformed: DataFrame, captured: DataFrame) -> DataFrame:
    """Audit rows of the events that came through, for those whose before was captured."""
    rows = transformed.withColumn("correlation_id", F.concat_ws("-", "table_schema", "table_name", "lsn", "seq"))
    mine = rows.join(captured.select("correlation_id"), "correlation_id", "left_semi")
    return mine.select("correlation_id", "table_schema", "table_name", "op", "lsn", "seq", F.lit("after").alias("capture_stage"), F.lit(False).alias("filtered"), canonical_json(F.col("data")).alias("payload"), payload_hash(F.col("data")).alias("payload_hash"), F.col("ts").alias("message_timestamp"))


def mark_filtered(captured: DataFrame, passed: DataFrame) -> DataFrame:
    """Before rows with `filtered` set where no event came through."""
    came = passed.select("correlation_id").distinct().withColumn("_came", F.lit(True))
    return captured.join(came, "correlation_id", "left").withColumn("filtered", F.col("_came").isNull()).drop("_came")


def changed_pairs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Events whose payload the transformation changed."""
    b = first.select("correlation_id", F.col("payload_hash").alias("before_hash"))
    a = second.select("correlation_id", F.col("payload_hash").alias("after_hash"))
    return b.join(a, "correlation_id").filter("before_hash <> after_hash")


def audit_counts(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("filtered").alias("n_filtered"))


def by_age(rows: DataFrame, now: Column, hours: int, column: str = "captured_at") -> DataFrame:
    """Rows captured in the last hours."""
    return rows.filter(F.col(column) >= now - F.make_dt_interval(hours=F.lit(int(hours))))


def newest(rows: DataFrame, most: int, order: list[Column]) -> DataFrame:
    """The first `most` rows of an order: a top-k, without a global sort."""
    return rows.orderBy(*order).limit(most)


def expired(rows: DataFrame, most: int, order: str, tie: str) -> DataFrame:
    """The rows beyond the newest `most`: those below the key of the last one kept."""
    edge = rows.orderBy(F.desc(order), F.desc(tie)).limit(most).agg(F.min(F.struct(order, tie)).alias("_edge"))
    return rows.crossJoin(F.broadcast(edge)).filter(F.struct(order, tie) < F.col("_edge")).drop("_edge")  # edge is one row


def latency_ms(rows: DataFrame, start: str, end: str) -> DataFrame:
    return rows.withColumn("processing_latency_ms", F.timestamp_diff("MILLISECOND", F.col(start), F.col(end)))


def rank_in_table(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("table_schema", "table_name").orderBy(F.desc("message_timestamp"), F.desc("lsn"))))


def schema_changes(changes: DataFrame, pipeline: str, sink: str, now: Column) -> DataFrame:
    """Audit rows of schema changes."""
    return changes.select(
        F.concat_ws("-", "table_schema", "table_name", "lsn", "seq").alias("correlation_id"), F.lit(pipeline).alias("pipeline_id"), "source_id", F.lit(sink).alias("sink_id"), "table_schema", "table_name",
        "op", canonical_json(F.col("data")).alias("payload"), now.alias("captured_at"), F.col("ts").alias("message_timestamp"),
    )
