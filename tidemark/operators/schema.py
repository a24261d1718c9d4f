"""Additive schema evolution: drift in the data, diffs, the registry, rate limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import sink_type

REGISTRY = "table_schema string, table_name string, version bigint, columns map<string,string>, pk_columns array<string>"
UNKNOWN = "unknown"


def drift(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Columns that events carry and the registry lacks, with the LSN at which each first appears.

    Tables that the registry lacks start with the columns of their first event, so only later additions drift. Events are reduced to
    one row for each table and column before anything is compared.
    """
    by = ["table_schema", "table_name"]
    keys = events.select(*by, "lsn", "seq", F.explode(F.map_keys("data")).alias("column"))
    first = keys.groupBy(*by, "column").agg(F.min(F.struct("lsn", "seq")).alias("f"))
    known = registry.select(*by, F.explode(F.map_keys("columns")).alias("column"))
    listed = registry.select(*by).distinct().withColumn("_listed", F.lit(True))
    start = first.groupBy(*by).agg(F.min("f").alias("_s"))
    new = first.join(known, [*by, "column"], "left_anti").join(listed, by, "left").join(start, by)
    return new.filter(F.col("_listed").isNotNull() | (F.col("f") > F.col("_s"))).select(*by, "column", F.col("f.lsn").alias("first_lsn"))


def diffs(found: DataFrame) -> DataFrame:
    """One schema change a table: its added columns with the type that data alone gives them."""
    entries = F.array_sort(F.collect_list(F.struct("column", F.lit(UNKNOWN).alias("type"))))
    return found.groupBy("table_schema", "table_name").agg(F.map_from_entries(entries).alias("added"), F.min("first_lsn").alias("lsn"))


def declared_drift(discovered: DataFrame, registry: DataFrame) -> DataFrame:
    """Columns of rediscovered metadata that the registry lacks, with their declared types."""
    by = ["table_schema", "table_name"]
    have = discovered.select(*by, F.explode("columns").alias("column", "type"))
    return have.join(registry.select(*by, F.explode("columns").alias("column", "_t")).drop("_t"), [*by, "column"], "left_anti")


def type_changes(discovered: DataFrame, registry: DataFrame) -> DataFrame:
    """Columns whose declared type differs; they're reported, never altered."""
    by = ["table_schema", "table_name"]
    new = discovered.select(*by, F.explode("columns").alias("column", "new_type"))
    old = registry.select(*by, F.explode("columns").alias("column", "old_type"))
    return new.join(old, [*by, "column"]).filter("new_type <> old_type")


def evolve(registry: DataFrame, added: DataFrame) -> DataFrame:
    """The registry with the added columns (table, added map); a changed table's version grows by one, nothing is dropped."""
    by = ["table_schema", "table_name"]
    joined = registry.join(added.select(*by, "added"), by, "full")
    fresh = F.map_filter("added", lambda k, _: ~F.coalesce(F.map_contains_key("columns", k), F.lit(False)))
    merged = F.when(F.col("columns").isNull(), F.col("added")).when(F.col("added").isNull(), F.col("columns")).otherwise(F.map_concat("columns", fresh))
    grew = F.col("columns").isNull() | (F.coalesce(F.size(fresh), F.lit(0)) > 0)
    version = F.coalesce("version", F.lit(0)) + F.when(F.col("added").isNotNull() & grew, 1).otherwise(0)
    return joined.select(*by, version.cast("bigint").alias("version"), merged.alias("columns"), F.coalesce("pk_columns", F.array(F.lit("id"))).alias("pk_columns"))


def table_ddl(registry: DataFrame, tombstone: str = "deleted_at") -> DataFrame:
    """Column definitions of each table in name order, with the tombstone every sink table has."""
    entries = F.array_sort(F.map_entries("columns"))
    cols = F.transform(entries, lambda e: F.concat_ws(" ", e["key"], sink_type(e["value"])))
    return registry.select("table_schema", "table_name", F.concat_ws(", ", F.concat(cols, F.when(F.map_contains_key("columns", F.lit(tombstone)), F.array().cast("array<string>")).otherwise(F.array(F.lit(f"{tombstone} TIMESTAMP"))))).alias("columns"))


def resolve_keys(tables: DataFrame, registry: DataFrame, ddl: DataFrame, no_default: list[str] | None = None) -> DataFrame:
    """Key columns from the registry, else from the DDL, else id; schemas in no_default must have them and are marked unresolved."""
    from tidemark.functions.text import primary_key_columns

    by = ["table_schema", "table_name"]
    parsed = ddl.select(*by, primary_key_columns(F.col("ddl")).alias("_parsed"))
    joined = tables.join(registry.select(*by, "pk_columns"), by, "left").join(parsed, by, "left")
    found = F.coalesce("pk_columns", F.when(F.size("_parsed") > 0, F.col("_parsed")))
    strict = F.col("table_schema").isin(*(no_default or ["\x00"]))
    return joined.select(*by, F.coalesce(found, F.when(~strict, F.array(F.lit("id")))).alias("pk_columns"))


def missing_databases(targets: DataFrame, existing: DataFrame) -> DataFrame:
    """Sorted list of target databases that don't exist, in one row."""
    lost = targets.select("table_schema").distinct().join(existing.select("table_schema"), "table_schema", "left_anti")
    return lost.agg(F.array_sort(F.collect_set("table_schema")).alias("missing"))


def change_rate(changes: DataFrame, most: int = 5, seconds: int = 60) -> DataFrame:
    """Each schema change with its number in its minute window and whether the table is suspended at it.

    A window opens at a change and closes at the first one later than `seconds` after it opened, so where windows open depends on all
    before; a table's changes, a handful, are scanned in order.
    """
    schema = "table_schema string, table_name string, lsn bigint, ts timestamp_ntz, in_window int, suspended boolean"

    def scan(rows):
        rows = rows.sort_values(["ts", "lsn"], kind="stable")
        start, n, counts = None, 0, []
        for t in rows["ts"]:
            if start is None or (t - start).total_seconds() > seconds:
                start, n = t, 0
            n += 1
            counts.append(n)
        return rows.assign(in_window=counts, suspended=[c > most for c in counts])[["table_schema", "table_name", "lsn", "ts", "in_window", "suspended"]]

    return changes.select("table_schema", "table_name", "lsn", "ts").groupBy("table_schema", "table_name").applyInPandas(scan, schema)


def acknowledged(acks: DataFrame, sinks: int) -> DataFrame:
    """Schema changes (correlation_id) that all sinks have acknowledged."""
    return acks.groupBy("correlation_id").agg(F.count_distinct("sink_id").alias("n")).filter(F.col("n") >= sinks).select("correlation_id")
