"""Rollups over events, checkpoints and table statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timing import lag_ms


def batch_stats(events: DataFrame, by: list[str]) -> DataFrame:
    """Count of events and the last one by arrival (greatest lsn, seq): its LSN and time."""
    last = F.max_by(F.struct("lsn", "ts"), F.struct("lsn", "seq"))
    return events.groupBy(*by).agg(F.count(F.lit(1)).alias("n_events"), last.alias("_l")).select(*by, "n_events", F.col("_l.lsn").alias("last_lsn"), F.col("_l.ts").alias("last_ts"))


def table_stats(events: DataFrame, by: list[str], now: Column) -> DataFrame:
    return batch_stats(events, by).select(*by, F.col("n_events").alias("total_synced"), F.col("last_ts").alias("last_source_ts"), lag_ms(now, F.col("last_ts")).alias("lag_ms"))


def merge_stats(stored: DataFrame, fresh: DataFrame, by: list[str]) -> DataFrame:
    """Totals add up; the later state wins."""
    both = stored.unionByName(fresh, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (*by, "total_synced", "error_count")]
    newest = F.max_by(F.struct(*rest), "last_source_ts")
    return both.groupBy(*by).agg(F.sum("total_synced").alias("total_synced"), *([F.sum("error_count").alias("error_count")] if "error_count" in both.columns else []), newest.alias("_n")).select(*by, "total_synced", *(["error_count"] if "error_count" in both.columns else []), *[F.col(f"_n.{c}") for c in rest])


def error_counts(events: DataFrame, failed: Column, by: list[str]) -> DataFrame:
    return events.groupBy(*by).agg(F.count_if(failed).alias("error_count"))


def without_debug(stats: DataFrame, sinks: DataFrame) -> DataFrame:
    """Statistics of sinks that aren't for debugging."""
    return stats.join(sinks.filter("is_debug").select("sink_id"), "sink_id", "left_anti")


def max_of_sinks(stats: DataFrame, by: list[str]) -> DataFrame:
    return stats.groupBy(*by).agg(F.max("total_synced").alias("total_synced"), F.max("lag_ms").alias("lag_ms"))


def dashboard(tables: DataFrame, pipelines: DataFrame) -> DataFrame:
    """One row: pipelines by status, events in all, whole-number mean lag (0 without tables)."""
    states = pipelines.agg(*[F.count_if(F.lower("status") == s).alias(f"{s}_pipelines") for s in ("running", "error", "stopped")], F.count(F.lit(1)).alias("total_pipelines"))
    sums = tables.agg(F.coalesce(F.sum("total_synced"), F.lit(0)).alias("total_synced"), F.coalesce(F.floor(F.sum("lag_ms") / F.count("lag_ms")), F.lit(0)).alias("avg_lag_ms"))
    return states.crossJoin(sums)  # one row each


def pipeline_status(stats: DataFrame) -> DataFrame:
    """Latest status by update time (ties: the greater status), greatest count and lag of each pipeline."""
    return stats.groupBy("pipeline").agg(F.max(F.struct("updated_at", "status"))["status"].alias("status"), F.max("total_synced").alias("total_synced"), F.max("lag_ms").alias("lag_ms"), F.count(F.lit(1)).alias("n_sinks"))


def sink_breakdown(stats: DataFrame) -> DataFrame:
    """Tables, events and greatest lag of each sink of each pipeline, with its latest status (ties: the greater one)."""
    return stats.groupBy("pipeline", "sink_id").agg(F.count_distinct("table_name").alias("n_tables"), F.sum("total_synced").alias("total_synced"), F.max("lag_ms").alias("lag_ms"), F.max(F.struct("updated_at", "status"))["status"].alias("status"))


def max_lsn(events: DataFrame, by: list[str]) -> DataFrame:
    """Greatest LSN of each group."""
    return events.groupBy(*by).agg(F.max("lsn").alias("max_lsn"))


def counters(events: DataFrame, kinds: dict[str, Column], by: list[str]) -> DataFrame:
    """Counters by name and labels, as metrics have them: a row for each condition that holds somewhere in the group."""
    counted = events.groupBy(*by).agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(kinds.values())])
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(f"c{i}").alias("value")) for i, k in enumerate(kinds)])
    return counted.select(*by, F.inline(rows)).filter("value > 0")


def gauges(samples: DataFrame, by: list[str], value: str, order: list[str]) -> DataFrame:
    """The latest value of each series."""
    return samples.groupBy(*by).agg(F.max_by(value, F.struct(*order)).alias("value"))


def latest_checkpoints(events: DataFrame, by: list[str]) -> DataFrame:
    """Greatest LSN of real changes: snapshots and LSN 0 don't count."""
    return events.filter((F.col("op") != "snapshot") & (F.col("lsn") > 0)).groupBy(*by).agg(F.max("lsn").alias("checkpoint_lsn"))


def resume_floor(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.agg(F.min(F.when(F.col("checkpoint_lsn") > 0, F.col("checkpoint_lsn"))).alias("resume_lsn"))


def sink_frontier(checkpoints: DataFrame, sinks: list[str]) -> DataFrame:
    """Least of the sinks' greatest LSNs, null until each sink has a checkpoint."""
    per_sink = checkpoints.filter(F.col("sink_id").isin(*sinks)).groupBy("sink_id").agg(F.max("checkpoint_lsn").alias("m"))
    return per_sink.agg(F.when(F.count_if(F.col("m") > 0) == len(sinks), F.min("m")).alias("frontier_lsn"))


def grouped_tables(tables: DataFrame, text: str = "") -> DataFrame:
    """Tables of each schema, both sorted; text filters by part of the name."""
    if text:
        tables = tables.filter(F.lower(F.concat_ws(".", "table_schema", "table_name")).contains(text.lower()))
    return tables.groupBy("table_schema").agg(F.array_sort(F.collect_set("table_name")).alias("tables"))


def histogram(values: DataFrame, column: str, bounds: list[float]) -> DataFrame:
    """Cumulative counts below each bound, as histogram metrics have them."""
    counts = values.agg(*[F.count_if(F.col(column) <= b).alias(f"c{i}") for i, b in enumerate(bounds)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"c{i}").alias("n")) for i, b in enumerate(bounds)])))
