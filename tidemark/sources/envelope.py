"""The change envelope and the sources that fill it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.identity import schema_or_default

# Operations of the envelope; processors may take the first six.
OPERATIONS = ("insert", "update", "delete", "snapshot", "schema_change", "schema_change_ack", "record_ack", "drain_marker")
DATA_OPERATIONS = ("insert", "update", "snapshot")
CONTROL_OPERATIONS = ("schema_change", "drain_marker")
#: Kind of a column that an update left out because its stored value didn't change.
UNCHANGED = "toasted_unchanged"

ENVELOPE = """source_id string, sink_id string, table_schema string, table_name string, op string, lsn bigint, seq bigint,
pk string, uuid string, data map<string,string>, column_kinds map<string,string>, ts timestamp_ntz, batch_id bigint, correlation_id string"""


def has(column: str) -> Column:
    """Whether an event carries the column at all; a carried null is present."""
    return F.map_contains_key("data", F.lit(column))


def value(column: str) -> Column:
    return F.element_at("data", F.lit(column))


def unchanged(column: str) -> Column:
    """Whether an event leaves the column out as unchanged."""
    kind = F.element_at("column_kinds", F.lit(column))
    return F.coalesce(kind == UNCHANGED, F.lit(False)) & ~has(column)


def without(*columns: str) -> Column:
    """An event's data without some columns."""
    return F.map_filter("data", lambda k, _: ~k.isin(*columns))


def names() -> Column:
    """Sorted names of the columns that an event carries, with commas."""
    return F.array_join(F.array_sort(F.map_keys("data")), ",")


def with_snapshot(log: DataFrame, rows: DataFrame) -> DataFrame:
    """The events of a log and of snapshots as one table; snapshots come before all by their LSN of 0."""
    return log.unionByName(rows, allowMissingColumns=True)


def decode(raw: DataFrame) -> DataFrame:
    """Row changes to envelopes.

    raw: kind (insert, update, snapshot, delete; others go), table_schema, table_name, lsn, seq, ts, new_row and old_keys as
    map<string,string>, unchanged as array<string>. Deletes carry their keys, snapshots have LSN 0, updates name the columns
    they left out.
    """
    kept = raw.filter(F.col("kind").isin("insert", "update", "snapshot", "delete"))
    kinds = F.map_from_arrays(F.coalesce("unchanged", F.array().cast("array<string>")), F.transform(F.coalesce("unchanged", F.array().cast("array<string>")), lambda _: F.lit(UNCHANGED)))
    return kept.select(
        schema_or_default(F.col("table_schema")).alias("table_schema"),
        "table_name",
        F.col("kind").alias("op"),
        F.when(F.col("kind") == "snapshot", F.lit(0)).otherwise(F.col("lsn")).cast("bigint").alias("lsn"),
        "seq",
        F.when(F.col("kind") == "delete", F.col("old_keys")).otherwise(F.map_filter("new_row", lambda k, _: ~F.array_contains(F.coalesce(F.col("unchanged"), F.array().cast("array<string>")), k))).alias("data"),
        F.when(F.col("kind") == "update", kinds).otherwise(F.create_map().cast("map<string,string>")).alias("column_kinds"),
        "ts",
    )


def known_tables(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Events of tables that the registry lists by schema and name."""
    return events.join(registry.select("table_schema", "table_name").distinct(), ["table_schema", "table_name"], "left_semi")


def unknown_tables(events: DataFrame, registry: DataFrame) -> DataFrame:
    """The other events; their LSNs count as confirmed at once."""
    return events.join(registry.select("table_schema", "table_name").distinct(), ["table_schema", "table_name"], "left_anti")


def snapshot(table: DataFrame, schema: str, name: str, keys: list[str]) -> DataFrame:
    """A table's rows as snapshot events with LSN 0; uuid is a hash of the key, so reruns agree."""
    from tidemark.functions.types import wire_text

    cells = [F.struct(F.lit(c).alias("key"), wire_text(F.col(c), t).alias("value")) for c, t in table.dtypes]
    key = F.to_json(F.struct(*keys))
    return table.select(
        F.lit(schema).alias("table_schema"), F.lit(name).alias("table_name"), F.lit("snapshot").alias("op"), F.lit(0).cast("bigint").alias("lsn"),
        key.alias("pk"), F.sha2(F.concat(F.lit(f"{schema}.{name}:"), key), 256).alias("uuid"), F.map_from_entries(F.array(*cells)).alias("data"),
    )


def after_key(keys: list[str], last: list) -> Column:
    """Row comparison (k1, k2, ...) > (l1, l2, ...), written so that bounds on the first key reach the scan."""
    out = F.lit(False)
    for i in reversed(range(len(keys))):
        here = F.col(keys[i])
        out = (here > F.lit(last[i])) | ((here == F.lit(last[i])) & out)
    return (F.col(keys[0]) >= F.lit(last[0])) & out


def keyset_page(table: DataFrame, keys: list[str], last: list | None, size: int) -> DataFrame:
    """The next `size` rows after the key `last` in key order; rows with a null in the key can't be paged."""
    if not keys:
        raise ValueError("keyset paging needs a primary key")
    rows = table if last is None else table.filter(after_key(keys, last))
    return rows.orderBy(*keys).limit(size)


def chunks(table: DataFrame, keys: list[str], size: int) -> DataFrame:
    """All pages at once: chunk_id by rank of the key, without sorting the table in one task."""
    from tidemark.operators.ranking import row_numbers

    return row_numbers(table, [], keys, "_nth").withColumn("chunk_id", F.floor((F.col("_nth") - 1) / size)).drop("_nth")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A landed change log as a batch."""
    return spark.read.schema(ENVELOPE).parquet(path)


def stream_log(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A landed change log as a stream; new files are new events, and files_per_trigger bounds what one batch takes."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def discover(spark: SparkSession, schemas: list[str] | None = None) -> DataFrame:
    """Base tables of the listed databases (none: public alone), without system schemas and snapshot helpers."""
    found = [(s, t.name) for s in (schemas or ["public"]) if spark.catalog.databaseExists(s) for t in spark.catalog.listTables(s) if t.tableType != "VIEW" and not t.isTemporary]
    df = spark.createDataFrame(found, "table_schema string, table_name string")
    return df.filter(~F.col("table_schema").isin("information_schema", "pg_catalog") & ~F.col("table_name").contains("cdc_snapshot"))


def slot_lag(log: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Distance from each source's confirmed LSN (source_id, lsn) to the end of its log."""
    end = log.groupBy("source_id").agg(F.max("lsn").alias("end_lsn"))
    return end.join(confirmed, "source_id", "left").select("source_id", "end_lsn", F.coalesce("confirmed_lsn", F.lit(0)).alias("confirmed_lsn"), (F.col("end_lsn") - F.coalesce("confirmed_lsn", F.lit(0))).alias("lag"))


def backlog(log: DataFrame, cursors: list[tuple[str, int]]) -> DataFrame:
    """Events that each sink's cursor (sink_id, applied LSN) has yet to take, all counted in one pass."""
    counts = log.agg(*[F.count_if(F.col("lsn") > lsn).alias(f"c{i}") for i, (_, lsn) in enumerate(cursors)])
    rows = F.array(*[F.struct(F.lit(s).alias("sink_id"), F.col(f"c{i}").alias("pending")) for i, (s, _) in enumerate(cursors)])
    return counts.select(F.inline(rows))
