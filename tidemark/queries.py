"""Queries over the operators, each with the SQL that a relational engine would run for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import identity, registry, text, timing, types
from tidemark.functions.registry import Processor
from tidemark.operators import apply, audit, chunking, filters, schema, stats, watermark
from tidemark.sources import catalog, envelope

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Salt and clock of the queries; fixed, so that results are.
SALT = "pepper"
NOW = "2024-02-01 00:00:00"
BATCH = 500


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def feed(spark: SparkSession, sf: str) -> DataFrame:
    """The change feed made of events: users in public, their purchases in sales; views leave props out as unchanged."""
    e = table(spark, sf, "events")
    kind = F.col("event_type")
    op = F.when(kind == "signup", "insert").when(kind == "error", "delete").otherwise("update")
    key = F.struct(F.lit("user_id").alias("key"), F.col("user_id").cast("string").alias("value"))
    val = F.struct(F.lit("value").alias("key"), F.col("value").cast("string").alias("value"))
    props = F.struct(F.lit("props").alias("key"), F.col("props").alias("value"))
    data = F.when(op == "delete", F.array(key)).when(kind == "view", F.array(key, val)).otherwise(F.array(key, val, props))
    kinds = F.when(kind == "view", F.create_map(F.lit("props"), F.lit(envelope.UNCHANGED))).otherwise(F.create_map().cast("map<string,string>"))
    return e.select(
        F.lit("pg1").alias("source_id"), F.lit(None).cast("string").alias("sink_id"), F.when(kind == "purchase", "sales").otherwise("public").alias("table_schema"), F.lit("users").alias("table_name"),
        op.alias("op"), (F.col("event_id") * 8 + 100).alias("lsn"), F.lit(0).cast("bigint").alias("seq"), F.lit(None).cast("string").alias("pk"), F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("uuid"),
        F.map_from_entries(data).alias("data"), kinds.alias("column_kinds"), "ts", F.floor(F.col("event_id") / BATCH).alias("batch_id"), F.lit(None).cast("string").alias("correlation_id"),
        "event_id", "event_type",
    )


FEED = f"""WITH feed AS (SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN 'sales' ELSE 'public' END AS table_schema, 'users' AS table_name,
 CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS op, event_id * 8 + 100 AS lsn, ts, user_id, value, props, event_id // {BATCH} AS batch_id FROM events)"""

KEYS = {"user_id": "bigint"}
COLUMNS = {"value": "double", "props": "string"}


def carried(c: str, kind: str):
    return types.typed(envelope.value(c), kind)


# --- sources -------------------------------------------------------------------------------------------------


@query(f"""{FEED} SELECT table_schema, table_name, op, lsn, ts, user_id, CASE WHEN op <> 'delete' THEN value END AS value,
 CASE WHEN op <> 'delete' AND event_type <> 'view' THEN props END AS props, (event_type = 'view') AS props_unchanged FROM feed""")
def src_3_event_decode(spark, sf):
    raw = table(spark, sf, "events").select(
        F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete").otherwise("update").alias("kind"),
        F.when(F.col("event_type") == "purchase", "sales").otherwise("").alias("table_schema"), F.lit("users").alias("table_name"), (F.col("event_id") * 8 + 100).alias("lsn"), F.lit(0).alias("seq"), "ts",
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string"), F.lit("value"), F.col("value").cast("string"), F.lit("props"), F.col("props")).alias("new_row"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("old_keys"), F.when(F.col("event_type") == "view", F.array(F.lit("props"))).alias("unchanged"),
    )
    return envelope.decode(raw).select("table_schema", "table_name", "op", "lsn", "ts", carried("user_id", "bigint").alias("user_id"), carried("value", "double").alias("value"), envelope.value("props").alias("props"), envelope.unchanged("props").alias("props_unchanged"))


@query(f"{FEED} SELECT event_id, lsn, op FROM feed WHERE (table_schema, table_name) IN (('sales', 'users'))")
def src_4_known_tables(spark, sf):
    known = spark.createDataFrame([("sales", "users")], "table_schema string, table_name string")
    return envelope.known_tables(feed(spark, sf), known).select("event_id", "lsn", "op")


@query(f"{FEED} SELECT event_id, lsn, op FROM feed WHERE NOT (table_schema = 'sales' AND table_name = 'users')")
def src_4_filtered_self_acked(spark, sf):
    known = spark.createDataFrame([("sales", "users")], "table_schema string, table_name string")
    return envelope.unknown_tables(feed(spark, sf), known).select("event_id", "lsn", "op")


@query("SELECT 'public' AS table_schema, 'customer' AS table_name, 'snapshot' AS op, CAST(0 AS BIGINT) AS lsn, c_custkey AS k, c_name AS name, c_acctbal AS bal FROM customer")
def src_6_snapshot(spark, sf):
    s = envelope.snapshot(table(spark, sf, "customer"), "public", "customer", ["c_custkey"])
    return s.select("table_schema", "table_name", "op", "lsn", carried("c_custkey", "bigint").alias("k"), envelope.value("c_name").alias("name"), carried("c_acctbal", "double").alias("bal"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey > 700 ORDER BY o_orderkey LIMIT 1000")
def src_7_keyset_page(spark, sf):
    return envelope.keyset_page(table(spark, sf, "orders"), ["o_orderkey"], [700], 1000).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("SELECT conv_id, turn, role FROM conversations WHERE (conv_id, turn) > (20, 1) ORDER BY conv_id, turn LIMIT 150")
def src_7_keyset_page_composite(spark, sf):
    return envelope.keyset_page(table(spark, sf, "conversations"), ["conv_id", "turn"], [20, 1], 150).select("conv_id", "turn", "role")


@query("SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS BIGINT) AS chunk_id FROM orders")
def src_7_snapshot_chunks(spark, sf):
    return envelope.chunks(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 1000).select("o_orderkey", F.col("chunk_id").cast("bigint").alias("chunk_id"))


@query(f"{FEED} SELECT max(lsn) AS end_lsn, CAST(4100 AS BIGINT) AS confirmed_lsn, max(lsn) - 4100 AS lag FROM feed")
def src_14_slot_lag(spark, sf):
    confirmed = spark.createDataFrame([("pg1", 4100)], "source_id string, confirmed_lsn bigint")
    return envelope.slot_lag(feed(spark, sf), confirmed).drop("source_id")


@query(f"""{FEED} SELECT 'a' AS sink_id, count(*) FILTER (WHERE lsn > 900) AS pending FROM feed UNION ALL SELECT 'b', count(*) FILTER (WHERE lsn > 20000) FROM feed""")
def snk_12_backlog(spark, sf):
    return envelope.backlog(feed(spark, sf), [("a", 900), ("b", 20_000)])


@query("SELECT 'public' AS table_schema, n_name AS table_name, 'age' AS column, 'int4' AS type FROM nation WHERE n_nationkey % 2 = 0")
def set_2_declared_drift(spark, sf):
    n = table(spark, sf, "nation").select(F.lit("public").alias("table_schema"), F.col("n_name").alias("table_name"), "n_nationkey")
    old = n.withColumn("columns", F.create_map(F.lit("id"), F.lit("int8"), F.lit("name"), F.lit("text")))
    new = n.withColumn("columns", F.when(F.col("n_nationkey") % 2 == 0, F.create_map(F.lit("id"), F.lit("int8"), F.lit("age"), F.lit("int4"))).otherwise(F.create_map(F.lit("id"), F.lit("int8"))))
    return schema.declared_drift(new, old)


# --- filters and transforms ----------------------------------------------------------------------------------


@query(f"""{FEED} SELECT event_id, op, CASE WHEN op = 'delete' THEN NULL WHEN event_type = 'view' THEN NULL WHEN op = 'insert' THEN sha256(concat(props, '{SALT}')) ELSE props END AS props FROM feed""")
def fil_1_routed_mask(spark, sf):
    events, _ = registry.apply_chain(feed(spark, sf), [Processor("mask", ["insert"], options={"column": "props", "salt": SALT})])
    return events.select("event_id", "op", envelope.value("props").alias("props"))


@query(f"{FEED} SELECT event_id, CASE WHEN event_type = 'view' OR op = 'delete' THEN NULL WHEN table_schema = 'sales' THEN upper(props) ELSE props END AS props FROM feed")
def fn_2_uppercase(spark, sf):
    events, _ = registry.apply_chain(feed(spark, sf), [Processor("uppercase", ["insert", "update"], schemas=["sales"], options={"column": "props"})])
    return events.select("event_id", envelope.value("props").alias("props"))


@query(f"SELECT c_custkey, sha256(concat(c_name, '{SALT}')) AS masked FROM customer")
def fn_1_mask(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.mask(F.col("c_name"), SALT).alias("masked"))


@query(f"{FEED} SELECT event_id, (table_schema IN ('sales') OR table_name IN ('orders')) AS matched FROM feed")
def fil_2_schema_or_table(spark, sf):
    return feed(spark, sf).select("event_id", filters.matches(["sales"], ["orders"]).alias("matched"))


@query(f"{FEED} SELECT event_id, NOT (op = 'delete' OR value > 10) AS dropped FROM feed")
def fil_3_row_drop(spark, sf):
    kept, gone = filters.split_rows(feed(spark, sf), (F.col("op") == "delete") | (carried("value", "double") > 10))
    return kept.select("event_id", F.lit(False).alias("dropped")).unionByName(gone.select("event_id", F.lit(True).alias("dropped")))


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(red.*|.*bolt)$') AND NOT regexp_matches(p_name, '^.*small.*$')")
def fil_5_globs(spark, sf):
    chosen = filters.CaptureFilter(include_tables=["red*", "*bolt"], exclude_tables=["*small*"])
    return table(spark, sf, "part").filter(chosen.column(F.col("p_name"))).select("p_partkey", "p_name")


@query(f"{FEED} SELECT event_id, op FROM feed WHERE table_schema || '.' || table_name LIKE 'public.%' AND op IN ('insert', 'delete')")
def fil_4_capture_filter(spark, sf):
    chosen = filters.CaptureFilter(include_tables=["public.*"], operations=["insert", "delete"])
    name = identity.qualified(F.col("table_schema"), F.col("table_name"))
    return feed(spark, sf).filter(chosen.column(name)).select("event_id", "op")


@query(f"{FEED} SELECT event_id FROM feed WHERE ('0x' || substr(md5('u' || event_id), 1, 8))::BIGINT % 10000 < 1000")
def fil_7_sample_share(spark, sf):
    return feed(spark, sf).filter(filters.sample_share(10, F.col("uuid"), {"orders": 100})).select("event_id")


@query(f"{FEED} SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY table_schema, table_name ORDER BY lsn) AS r FROM feed) WHERE r % 7 = 0")
def fil_8_every_nth(spark, sf):
    return filters.every_nth(feed(spark, sf), 7, ["lsn", "seq"], ["table_schema", "table_name"]).select("event_id")


@query(f"""{FEED} SELECT event_id FROM feed WHERE op <> 'delete' AND event_type <> 'view' AND props LIKE '%9%' AND user_id IN (1, 3, 5, 7, 9, 11, 13)""")
def fil_9_conditions(spark, sf):
    chosen = filters.CaptureFilter(conditions=[filters.Condition("props", "contains", "9"), filters.Condition("user_id", "in", [1, 3, 5, 7, 9, 11, 13])])
    return feed(spark, sf).filter(chosen.column()).select("event_id")


@query(f"{FEED} SELECT event_id FROM feed WHERE event_id % 50 <> 0 AND event_id % 70 <> 0")
def fil_10_without_control(spark, sf):
    e = feed(spark, sf).withColumn("op", F.when(F.col("event_id") % 50 == 0, "schema_change").when(F.col("event_id") % 70 == 0, "drain_marker").otherwise(F.col("op")))
    return filters.without_control(e).select("event_id")


PIPELINES_SQL = "pipelines AS (SELECT 'p' || n_nationkey AS id, n_name AS name, CASE n_nationkey % 3 WHEN 0 THEN 'Running' WHEN 1 THEN 'Error' ELSE 'Stopped' END AS status FROM nation)"


def pipelines(spark, sf):
    n = F.col("n_nationkey")
    return table(spark, sf, "nation").select(F.concat(F.lit("p"), n.cast("string")).alias("id"), F.col("n_name").alias("name"), F.when(n % 3 == 0, "Running").when(n % 3 == 1, "Error").otherwise("Stopped").alias("status"))


@query(f"WITH {PIPELINES_SQL} SELECT id, name, status FROM pipelines WHERE (lower(name) LIKE '%nation%' OR lower(id) LIKE '%nation%') AND lower(status) = 'running' ORDER BY name, id LIMIT 4 OFFSET 4")
def fil_12_pipeline_page(spark, sf):
    return filters.page(filters.search(pipelines(spark, sf), "NATION", "RUNNING"), ["name", "id"], 2, 4)


@query(f"{FEED} SELECT user_id, max(ts) AS updated_at FROM feed GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 60 SECONDS")
def fil_13_stale_heartbeats(spark, sf):
    beats = table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("updated_at"))
    return filters.stale(beats, F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"))


@query(f"""{FEED} SELECT CASE WHEN op = 'delete' THEN 'user_id' WHEN event_type = 'view' THEN 'user_id,value' ELSE 'props,user_id,value' END AS column_set, count(*) AS n FROM feed GROUP BY 1""")
def prj_1_column_sets(spark, sf):
    return feed(spark, sf).groupBy(F.array_join(apply.column_set(), ",").alias("column_set")).agg(F.count(F.lit(1)).alias("n"))


@query(f"{FEED} SELECT event_id, (op = 'update' AND event_type = 'click') AS filtered FROM feed")
def jon_3_transform_rejoin(spark, sf):
    e = feed(spark, sf)
    kept = e.filter(~((F.col("op") == "update") & (F.col("event_type") == "click")))
    return registry.rejoin(e, kept, ["uuid"]).select("event_id", "filtered")


@query(f"{FEED} SELECT event_id, CASE WHEN op = 'delete' THEN NULL ELSE value * 2 END AS doubled FROM feed WHERE op = 'delete' OR value >= 1")
def udf_2_batch_transformer(spark, sf):
    def double(frames):
        for d in frames:
            yield d.assign(x=d["x"] * 2)[~(d["x"] < 1)]

    e = feed(spark, sf).select("event_id", carried("value", "double").alias("x"))
    return registry.run_batch(e, registry.BatchTransformer(double)).select("event_id", F.col("x").alias("doubled"))


# --- apply ---------------------------------------------------------------------------------------------------

_FOLD = """, ups AS (SELECT *, row_number() OVER (PARTITION BY {by}user_id ORDER BY lsn DESC) AS r FROM feed WHERE op <> 'delete'),
 filled AS (SELECT {by}user_id, arg_max(props, lsn) FILTER (WHERE event_type <> 'view') AS props, min(batch_id) AS first_batch FROM feed WHERE op <> 'delete' GROUP BY ALL),
 dels AS (SELECT *, row_number() OVER (PARTITION BY {by}user_id ORDER BY batch_id DESC) AS r FROM (SELECT {by}user_id, batch_id, max(ts) AS ts FROM feed WHERE op = 'delete' GROUP BY ALL))
 SELECT {out}u.user_id, u.value, f.props, CASE WHEN d.batch_id >= f.first_batch THEN d.ts END AS deleted_at FROM ups u JOIN filled f ON {on_f}u.user_id = f.user_id LEFT JOIN dels d ON {on_d}u.user_id = d.user_id AND d.r = 1 WHERE u.r = 1"""
_PLAIN = _FOLD.format(by="", out="", on_f="", on_d="")
_SCHEMAS = _FOLD.format(by="table_schema, ", out="u.table_schema, ", on_f="u.table_schema = f.table_schema AND ", on_d="u.table_schema = d.table_schema AND ")


@query(f"{FEED}{_PLAIN}")
def app_4_tombstone_and_toast(spark, sf):
    return apply.fold(feed(spark, sf), KEYS, COLUMNS).drop("_first")


@query(f"{FEED}{_SCHEMAS}")
def app_11_cross_schema(spark, sf):
    return apply.fold(feed(spark, sf), KEYS, COLUMNS, by=["table_schema"]).drop("_first")


@query(f"{FEED}{_PLAIN}")
def app_10_incremental_replay(spark, sf):
    """Two halves merged one after the other, the second one twice."""
    e = feed(spark, sf)
    half = e.agg(F.max("batch_id")).first()[0] // 2
    first = apply.fold(e.filter(F.col("batch_id") <= half), KEYS, COLUMNS)
    late = e.filter(F.col("batch_id") > half)
    once = apply.fold(late, KEYS, COLUMNS, base=first)
    return apply.fold(late, KEYS, COLUMNS, base=once).drop("_first")


@query(f"{FEED} SELECT user_id, lsn, op, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS r FROM feed WHERE op <> 'delete') WHERE r = 1")
def win_3_latest_per_key(spark, sf):
    return apply.latest(feed(spark, sf), KEYS).select("user_id", "lsn", "op", F.element_at(F.map_from_entries("data"), F.lit("value")).try_cast("double").alias("value"))


@query(f"{FEED} SELECT event_id, last_value(CASE WHEN event_type <> 'view' THEN props END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY lsn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM feed WHERE op <> 'delete'")
def win_1_forward_fill(spark, sf):
    return apply.forward_fill(feed(spark, sf), KEYS, "props", "filled").select("event_id", "filled")


CUSTOMERS = "SELECT c_custkey AS user_id, c_name, CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2023-12-31 00:00:00' END AS deleted_at FROM customer"


def customers(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", F.when(F.col("c_custkey") % 5 == 0, F.lit("2023-12-31 00:00:00").cast("timestamp_ntz")).alias("deleted_at"))


@query(f"{FEED}, c AS ({CUSTOMERS}) SELECT k.user_id, c.c_name, c.deleted_at FROM (SELECT DISTINCT user_id FROM feed) k LEFT JOIN c USING (user_id)")
def jon_1_tombstone_read_back(spark, sf):
    keys = feed(spark, sf).select(carried("user_id", "bigint").alias("user_id"))
    return apply.read_back(keys, customers(spark, sf), ["user_id"], ["c_name", "deleted_at"])


@query(f"{FEED}, c AS ({CUSTOMERS}) SELECT c.user_id, c.c_name, coalesce(d.ts, c.deleted_at) AS deleted_at FROM c LEFT JOIN (SELECT user_id, max(ts) AS ts FROM feed WHERE op = 'delete' GROUP BY 1) d USING (user_id)")
def app_6_soft_delete(spark, sf):
    dels = feed(spark, sf).filter("op = 'delete'").select(carried("user_id", "bigint").alias("user_id"), "ts")
    return apply.soft_delete(customers(spark, sf), dels, ["user_id"])


@query(f"{FEED}, c AS ({CUSTOMERS}) SELECT c.user_id, c.c_name, c.deleted_at FROM c WHERE user_id NOT IN (SELECT user_id FROM feed) UNION ALL SELECT DISTINCT user_id, 'new', CAST(NULL AS TIMESTAMP) FROM feed")
def app_3_upsert_rows(spark, sf):
    rows = feed(spark, sf).select(carried("user_id", "bigint").alias("user_id"), F.lit("new").alias("c_name")).distinct()
    return apply.upsert(customers(spark, sf), rows, ["user_id"])


@query(f"{FEED} SELECT event_id, 'missing_pk_columns' AS reason FROM feed WHERE event_id % 11 = 0")
def app_7_missing_key(spark, sf):
    e = feed(spark, sf).withColumn("data", F.when(F.col("event_id") % 11 == 0, F.map_filter("data", lambda k, _: k != "user_id")).otherwise(F.col("data")))
    return apply.rejected(e, ["user_id"]).select("event_id", "reason")


@query(f"{FEED} SELECT user_id, max(ts) AS ts, count(*) AS n FROM feed WHERE op = 'delete' GROUP BY user_id")
def agg_13_delete_grouping(spark, sf):
    return apply.deletes_by_key(feed(spark, sf), KEYS)


@query(f"{FEED} SELECT DISTINCT user_id FROM feed WHERE event_type = 'view'")
def agg_14_keys_to_read_back(spark, sf):
    return apply.keys_to_read_back(feed(spark, sf), KEYS, ["props"])


# --- watermarks and stats ------------------------------------------------------------------------------------

_ACKS = """, seen AS (SELECT lsn, event_id % 13 = 0 AS self_acked, event_id FROM feed), told AS (SELECT lsn, 'a' AS sink_id FROM seen WHERE NOT self_acked UNION ALL SELECT lsn, 'b' FROM seen WHERE NOT self_acked AND event_id % 97 <> 96)"""
_COUNTS = """, counts AS (SELECT s.lsn, s.observed, s.self_acked, coalesce(a.n, 0) >= s.observed - s.self_acked AND coalesce(b.n, 0) >= s.observed - s.self_acked AS confirmed
 FROM (SELECT lsn, count(*) AS observed, count(*) FILTER (WHERE self_acked) AS self_acked FROM seen GROUP BY 1) s LEFT JOIN (SELECT lsn, count(*) AS n FROM told WHERE sink_id = 'a' GROUP BY 1) a USING (lsn) LEFT JOIN (SELECT lsn, count(*) AS n FROM told WHERE sink_id = 'b' GROUP BY 1) b USING (lsn))"""


def acks(spark, sf):
    e = feed(spark, sf).select("lsn", "event_id", (F.col("event_id") % 13 == 0).alias("self_acked"))
    data = e.filter(~F.col("self_acked"))
    told = data.select("lsn", F.lit("a").alias("sink_id")).unionByName(data.filter("event_id % 97 <> 96").select("lsn", F.lit("b").alias("sink_id")))
    return e.select("lsn", "self_acked"), told


@query(f"{FEED}{_ACKS}{_COUNTS} SELECT lsn, observed, self_acked, confirmed FROM counts")
def agg_11_ack_counts(spark, sf):
    return watermark.ack_counts(*acks(spark, sf), ["a", "b"])


@query(f"{FEED}{_ACKS}{_COUNTS} SELECT coalesce(max(lsn) FILTER (WHERE lsn < f), 0) AS watermark, any_value(f) AS first_unconfirmed FROM counts, (SELECT min(lsn) FILTER (WHERE NOT confirmed) AS f FROM counts)")
def str_2_ack_watermark(spark, sf):
    return watermark.ack_watermark(*acks(spark, sf), ["a", "b"])


@query(f"{FEED}{_ACKS}{_COUNTS} SELECT lsn, min(CAST(confirmed AS INT)) OVER (ORDER BY lsn) = 1 AS prefix_confirmed FROM counts")
def win_2_confirmed_prefix(spark, sf):
    return watermark.running_confirmed(watermark.ack_counts(*acks(spark, sf), ["a", "b"])).select("lsn", "prefix_confirmed")


@query(f"{FEED}{_ACKS} SELECT n.lsn, s.sink_id, n.required, count(t.lsn) AS confirmed FROM (SELECT lsn, count(*) FILTER (WHERE NOT self_acked) AS required FROM seen GROUP BY 1) n CROSS JOIN (SELECT unnest(['a', 'b']) AS sink_id) s LEFT JOIN told t ON t.lsn = n.lsn AND t.sink_id = s.sink_id GROUP BY ALL")
def jon_8_ack_requirement(spark, sf):
    return watermark.requirements(*acks(spark, sf), spark.createDataFrame([("a",), ("b",)], "sink_id string"))


@query(f"{FEED} SELECT event_id FROM feed WHERE lsn <= 5000")
def str_6_late_events(spark, sf):
    marks = spark.createDataFrame([("pg1", 5000)], "source_id string, watermark bigint")
    return watermark.late(feed(spark, sf), marks).select("event_id")


@query(f"{FEED} SELECT table_schema, table_name, count(*) AS n_events, max(lsn) AS last_lsn, arg_max(ts, lsn) AS last_ts FROM feed GROUP BY 1, 2")
def agg_1_batch_stats(spark, sf):
    return stats.batch_stats(feed(spark, sf), ["table_schema", "table_name"])


@query(f"{FEED} SELECT table_schema, table_name, count(*) AS total_synced, arg_max(ts, lsn) AS last_source_ts, CAST(date_diff('microsecond', arg_max(ts, lsn), TIMESTAMP '{NOW}') // 1000 AS BIGINT) AS lag_ms FROM feed GROUP BY 1, 2")
def agg_2_table_stats(spark, sf):
    return stats.table_stats(feed(spark, sf), ["table_schema", "table_name"], F.lit(NOW).cast("timestamp_ntz"))


@query(f"{FEED} SELECT table_schema, batch_id, count(*) FILTER (WHERE event_type = 'error') AS error_count FROM feed GROUP BY 1, 2")
def agg_3_error_counts(spark, sf):
    return stats.error_counts(feed(spark, sf), F.col("event_type") == "error", ["table_schema", "batch_id"])


_STATS = "stats AS (SELECT 'p' || (user_id % 7) AS pipeline, 'sink' || (event_id % 3) AS sink_id, event_type AS table_name, count(*) AS total_synced, max(event_id % 1000) AS lag_ms, max(ts) AS updated_at, arg_max(CASE WHEN event_id % 2 = 0 THEN 'Running' ELSE 'Error' END, ts) AS status FROM events GROUP BY 1, 2, 3)"


def sink_stats(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy(F.concat(F.lit("p"), (F.col("user_id") % 7).cast("string")).alias("pipeline"), F.concat(F.lit("sink"), (F.col("event_id") % 3).cast("string")).alias("sink_id"), F.col("event_type").alias("table_name")).agg(
        F.count(F.lit(1)).alias("total_synced"), F.max(F.col("event_id") % 1000).alias("lag_ms"), F.max("ts").alias("updated_at"), F.max_by(F.when(F.col("event_id") % 2 == 0, "Running").otherwise("Error"), "ts").alias("status")
    )


def debug_sinks(spark):
    return spark.createDataFrame([("sink0", False), ("sink1", False), ("sink2", True)], "sink_id string, is_debug boolean")


@query(f"WITH {_STATS} SELECT pipeline, sink_id, table_name, total_synced FROM stats WHERE sink_id <> 'sink2'")
def jon_9_without_debug_sinks(spark, sf):
    return stats.without_debug(sink_stats(spark, sf), debug_sinks(spark)).select("pipeline", "sink_id", "table_name", "total_synced")


@query(f"WITH {_STATS} SELECT pipeline, table_name, max(total_synced) AS total_synced, max(lag_ms) AS lag_ms FROM stats WHERE sink_id <> 'sink2' GROUP BY 1, 2")
def agg_4_max_of_sinks(spark, sf):
    return stats.max_of_sinks(stats.without_debug(sink_stats(spark, sf), debug_sinks(spark)), ["pipeline", "table_name"])


@query(f"""WITH {_STATS}, {PIPELINES_SQL}, t AS (SELECT pipeline, table_name, max(total_synced) AS total_synced, max(lag_ms) AS lag_ms FROM stats WHERE sink_id <> 'sink2' GROUP BY 1, 2)
 SELECT p.*, s.* FROM (SELECT count(*) FILTER (WHERE lower(status) = 'running') AS running_pipelines, count(*) FILTER (WHERE lower(status) = 'error') AS error_pipelines, count(*) FILTER (WHERE lower(status) = 'stopped') AS stopped_pipelines, count(*) AS total_pipelines FROM pipelines) p,
 (SELECT CAST(sum(total_synced) AS BIGINT) AS total_synced, CAST(sum(lag_ms) // count(lag_ms) AS BIGINT) AS avg_lag_ms FROM t) s""")
def agg_5_dashboard(spark, sf):
    tables = stats.max_of_sinks(stats.without_debug(sink_stats(spark, sf), debug_sinks(spark)), ["pipeline", "table_name"])
    return stats.dashboard(tables, pipelines(spark, sf))


@query(f"WITH {_STATS} SELECT pipeline, max({{'updated_at': updated_at, 'status': status}}).status AS status, max(total_synced) AS total_synced, max(lag_ms) AS lag_ms, count(*) AS n_sinks FROM stats GROUP BY 1")
def agg_6_pipeline_status(spark, sf):
    return stats.pipeline_status(sink_stats(spark, sf))


@query(f"{FEED} SELECT batch_id, max(lsn) AS max_lsn FROM feed GROUP BY 1")
def agg_7_max_lsn(spark, sf):
    return stats.max_lsn(feed(spark, sf), ["batch_id"])


_CHECKPOINTS = "points AS (SELECT 's' || (event_id % 3) AS sink_id, event_type AS table_name, max(lsn) AS checkpoint_lsn FROM feed WHERE op <> 'snapshot' AND lsn > 0 GROUP BY 1, 2)"


def checkpoints(spark, sf):
    e = feed(spark, sf).withColumn("sink_id", F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string"))).withColumn("table_name", F.col("event_type"))
    return stats.latest_checkpoints(e, ["sink_id", "table_name"])


@query(f"{FEED}, {_CHECKPOINTS} SELECT * FROM points")
def agg_8_checkpoints(spark, sf):
    return checkpoints(spark, sf)


@query(f"{FEED}, {_CHECKPOINTS} SELECT min(checkpoint_lsn) FILTER (WHERE checkpoint_lsn > 0) AS resume_lsn FROM points")
def agg_9_resume_floor(spark, sf):
    return stats.resume_floor(checkpoints(spark, sf))


@query(f"{FEED}, {_CHECKPOINTS} SELECT CASE WHEN count(*) = 3 THEN min(m) END AS frontier_lsn FROM (SELECT sink_id, max(checkpoint_lsn) AS m FROM points GROUP BY 1)")
def agg_10_sink_frontier(spark, sf):
    return stats.sink_frontier(checkpoints(spark, sf), ["s0", "s1", "s2"])


@query("SELECT string_agg(n_name, ',' ORDER BY n_name) AS missing FROM nation WHERE n_regionkey <> 1")
def agg_15_missing_databases(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_name").alias("table_schema"), "n_regionkey")
    return schema.missing_databases(n, n.filter("n_regionkey = 1")).select(F.array_join("missing", ",").alias("missing"))


@query(f"{FEED}, totals AS (SELECT batch_id, CAST(sum(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END) AS BIGINT) AS total FROM feed GROUP BY 1) SELECT batch_id, total, greatest(0, total - coalesce(lag(total) OVER (ORDER BY batch_id), total)) AS delta FROM totals")
def agg_17_throughput(spark, sf):
    totals = feed(spark, sf).groupBy(F.lit("p").alias("pipeline"), "batch_id").agg(F.sum(F.when(F.col("event_type") == "error", -1).otherwise(1)).alias("total"))
    return watermark.lag_series(totals, ["pipeline"], "batch_id", "total").drop("pipeline")


@query("SELECT r_name AS table_schema, string_agg(n_name, ',' ORDER BY n_name) AS tables FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def agg_18_tables_by_schema(spark, sf):
    n = table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # both tables are of fixed size
    return stats.grouped_tables(n.select(F.col("r_name").alias("table_schema"), F.col("n_name").alias("table_name"))).withColumn("tables", F.array_join("tables", ","))


@query(f"""{FEED.replace('WITH feed', 'WITH RECURSIVE feed')}, c AS (SELECT 'public' AS table_schema, 't' || (event_id % 50) AS table_name, lsn, ts, row_number() OVER (PARTITION BY event_id % 50 ORDER BY ts, lsn) AS i FROM feed WHERE event_type = 'signup'),
 r AS (SELECT table_schema, table_name, lsn, ts, i, ts AS opened, 1 AS n FROM c WHERE i = 1
 UNION ALL SELECT c.table_schema, c.table_name, c.lsn, c.ts, c.i, CASE WHEN date_diff('microsecond', r.opened, c.ts) > 86400000000 THEN c.ts ELSE r.opened END, CASE WHEN date_diff('microsecond', r.opened, c.ts) > 86400000000 THEN 1 ELSE r.n + 1 END FROM r JOIN c ON c.table_name = r.table_name AND c.i = r.i + 1)
 SELECT table_schema, table_name, lsn, ts, n AS in_window, n > 5 AS suspended FROM r""")
def agg_19_schema_change_rate(spark, sf):
    changes = feed(spark, sf).filter("event_type = 'signup'").select(F.lit("public").alias("table_schema"), F.concat(F.lit("t"), (F.col("event_id") % 50).cast("string")).alias("table_name"), "lsn", "ts")
    return schema.change_rate(changes, most=5, seconds=86_400)


@query("SELECT le, CAST(count(*) FILTER (WHERE value <= le) AS BIGINT) AS n FROM events, (SELECT unnest([1.0, 10.0, 100.0])::DOUBLE AS le) GROUP BY le")
def agg_20_histogram(spark, sf):
    return stats.histogram(table(spark, sf, "events"), "value", [1, 10, 100])


@query(f"""{FEED}, c AS (SELECT *, '"user_id":"' || user_id || '"' AS k, '"value":"' || (round(value * 100) :: BIGINT) || '"' AS v, '"props":"' || replace(props, '"', '\\"') || '",' AS p FROM feed)
 SELECT event_id, sha256('{{' || CASE WHEN op = 'delete' THEN k WHEN event_type = 'view' THEN k || coalesce(',' || v, ',"value":null') ELSE coalesce(p, '"props":null,') || k || coalesce(',' || v, ',"value":null') END || '}}') AS h FROM c""")
def agg_21_payload_hash(spark, sf):
    """Hashes of all payloads; values count in cents, whose text is the same everywhere."""
    cents = F.transform_values("data", lambda k, v: F.when(k == "value", F.round(v.cast("double") * 100).cast("bigint").cast("string")).otherwise(v))
    return feed(spark, sf).withColumn("data", cents).select("event_id", audit.payload_hash(F.col("data"), True).alias("h"))


# --- schema --------------------------------------------------------------------------------------------------


@query(f"{FEED} SELECT table_schema, 'props' AS column, min(lsn) AS first_lsn FROM feed WHERE op <> 'delete' AND event_type <> 'view' GROUP BY 1")
def str_12_drift_first_seen(spark, sf):
    reg = spark.createDataFrame([("public", "users", 1, {"user_id": "bigint", "value": "float8"}, ["user_id"]), ("sales", "users", 1, {"user_id": "bigint", "value": "float8"}, ["user_id"])], schema.REGISTRY)
    return schema.drift(feed(spark, sf), reg).select("table_schema", "column", "first_lsn")


@query(f"""{FEED}, carried AS (SELECT DISTINCT table_schema, unnest(CASE WHEN op = 'delete' THEN ['user_id'] WHEN event_type = 'view' THEN ['user_id', 'value'] ELSE ['user_id', 'value', 'props'] END) AS c FROM feed),
 known AS (SELECT s.table_schema, k.c, k.t FROM (SELECT DISTINCT table_schema FROM feed) s, (VALUES ('user_id', 'bigint'), ('value', 'float8')) k(c, t)),
 every AS (SELECT table_schema, c, t, 0 AS added FROM known UNION ALL SELECT table_schema, c, 'unknown', 1 FROM carried WHERE (table_schema, c) NOT IN (SELECT table_schema, c FROM known))
 SELECT table_schema, CAST(1 + max(added) AS BIGINT) AS version, string_agg(c || ':' || t, ',' ORDER BY c) AS columns FROM every GROUP BY 1""")
def snk_3_evolved_registry(spark, sf):
    reg = spark.createDataFrame([("public", "users", 1, {"user_id": "bigint", "value": "float8"}, ["user_id"]), ("sales", "users", 1, {"user_id": "bigint", "value": "float8"}, ["user_id"])], schema.REGISTRY)
    new = schema.evolve(reg, schema.diffs(schema.drift(feed(spark, sf), reg)))
    return new.select("table_schema", "version", F.array_join(F.transform(F.array_sort(F.map_entries("columns")), lambda e: F.concat_ws(":", e["key"], e["value"])), ",").alias("columns"))


_TYPES = ["boolean", "INT", "bigint[]", "_int4", "numeric(10,2)", "DECIMAL", "double precision", "real", "timestamptz", "date", "jsonb", "bytea", "uuid", "varchar(20)", "23", "1184", "money", "interval", "unknown"]
_TYPES_SQL = "types AS (SELECT unnest([" + ", ".join(f"'{t}'" for t in _TYPES) + "]) AS t)"


@query(f"""WITH {_TYPES_SQL} SELECT t, CASE WHEN l LIKE '%[]' OR starts_with(l, '_') OR l LIKE '%array%' THEN 'VARIANT' WHEN l = 'interval' THEN 'STRING' WHEN l LIKE '%bool%' THEN 'BOOLEAN' WHEN l LIKE '%int%' THEN 'INT64' WHEN l LIKE '%numeric%' OR l LIKE '%decimal%' THEN 'DECIMAL(38,9)'
 WHEN l LIKE '%float%' OR l LIKE '%double%' OR l LIKE '%real%' THEN 'FLOAT64' WHEN l LIKE '%timestamp%' THEN 'TIMESTAMP' WHEN l LIKE '%date%' THEN 'DATE' WHEN l LIKE '%json%' THEN 'VARIANT' WHEN l LIKE '%bytea%' THEN 'BINARY' WHEN l IN ('23') THEN 'INT64' WHEN l IN ('1184') THEN 'TIMESTAMP' ELSE 'STRING' END AS sink_type FROM (SELECT t, lower(t) AS l FROM types)""")
def fn_22_type_map(spark, sf):
    return spark.createDataFrame([(t,) for t in _TYPES], "t string").select("t", types.sink_type(F.col("t")).alias("sink_type"))


@query("SELECT c_custkey, CAST(c_custkey AS VARCHAR) || '|' || c_name AS k FROM customer")
def fn_24_key_string(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", identity.key_string([identity.key_text(F.col("c_custkey").cast("double"), "double"), identity.key_text(F.col("c_name"), "string")]).alias("k"))


@query("SELECT p_partkey, translate(p_name || '.' || p_brand || '>*', '. >*', '____') AS durable FROM part")
def fn_6_safe_component(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.safe_component(F.concat("p_name", F.lit("."), "p_brand", F.lit(">*"))).alias("durable"))


@query("SELECT n_nationkey, 'k' || n_nationkey || ',turn' AS pk FROM nation")
def fn_7_keys_of_ddl(spark, sf):
    ddl = F.concat(F.lit("CREATE TABLE t (a INT, PRIMARY KEY (`k"), F.col("n_nationkey").cast("string"), F.lit("` DESC, \"turn\" asc))"))
    return table(spark, sf, "nation").select("n_nationkey", F.array_join(text.primary_key_columns(ddl), ",").alias("pk"))


@query("SELECT n_nationkey + 1 AS attempt, CAST(least(1000 * 2 ** n_nationkey, 30000) AS BIGINT) AS wait_ms FROM nation")
def fn_8_backoff(spark, sf):
    n = (F.col("n_nationkey") + 1).alias("attempt")
    return table(spark, sf, "nation").select(n, timing.backoff_ms(F.col("n_nationkey") + 1, 1000, 30_000).alias("wait_ms"))


@query("SELECT l_quantity AS batch, CAST(greatest(15000, 5 * l_quantity) AS BIGINT) AS timeout_ms, CAST(least(greatest(l_quantity * greatest(15000, 5 * l_quantity) + 10000, 30000), 600000) AS BIGINT) AS ack_wait_ms FROM (SELECT DISTINCT l_quantity FROM lineitem)")
def fn_9_timeouts(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("batch")).distinct()
    return d.select("batch", timing.transform_timeout_ms(F.col("batch")).cast("bigint").alias("timeout_ms"), timing.ack_wait_ms(F.col("batch")).cast("bigint").alias("ack_wait_ms"))


@query("SELECT vec_id, to_json({'vec_id': vec_id, 'label': label}) AS j FROM embeddings")
def fn_17_json(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", types.wire_text(F.struct("vec_id", "label"), "struct<vec_id:bigint,label:int>").alias("j"))


@query("SELECT c_custkey, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS u, to_base64(encode(c_name)) AS b FROM (SELECT *, md5(c_name) AS h FROM customer)")
def fn_20_uuid_and_base64(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", types.uuid_text(F.unhex(F.md5("c_name"))).alias("u"), types.uuid_text(F.encode("c_name", "UTF-8")).alias("b"))


@query(f"{FEED} SELECT event_id, CASE WHEN table_schema = 'public' THEN table_name ELSE table_schema || '=' || table_name END AS token, table_schema || '.' || table_name AS qualified FROM feed")
def idn_key_tokens(spark, sf):
    return feed(spark, sf).select("event_id", identity.key_token(F.col("table_schema"), F.col("table_name")).alias("token"), identity.qualified(F.col("table_schema"), F.col("table_name")).alias("qualified"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey NOT IN (0, 1)")
def jon_11_new_tables(spark, sf):
    n = table(spark, sf, "nation").withColumn("table_schema", F.lit("public")).withColumn("table_name", F.col("n_name"))
    return envelope.unknown_tables(n, n.filter("n_regionkey IN (0, 1)")).select("n_nationkey", "n_name")


# --- audit ---------------------------------------------------------------------------------------------------


def audited(spark, sf):
    e = feed(spark, sf)
    captured = audit.before(e, filters.CaptureFilter(operations=["insert", "update"]))
    passed, _ = registry.apply_chain(e.filter("NOT (event_type = 'click' AND event_id % 4 = 0)"), [Processor("mask", ["insert"], options={"column": "props", "salt": SALT})])
    return captured, audit.after(passed, captured)


@query(f"{FEED} SELECT table_schema, op, count(*) AS n_rows, count(*) FILTER (WHERE event_type = 'click' AND event_id % 4 = 0) AS n_filtered FROM feed WHERE op <> 'delete' GROUP BY 1, 2")
def agg_16_audit_counts(spark, sf):
    captured, passed = audited(spark, sf)
    return audit.audit_counts(audit.mark_filtered(captured, passed), ["table_schema", "op"])


@query(f"{FEED} SELECT table_schema || '-users-' || lsn || '-0' AS correlation_id FROM feed WHERE op = 'insert'")
def jon_4_changed_pairs(spark, sf):
    return audit.changed_pairs(*audited(spark, sf)).select("correlation_id")


@query(f"{FEED} SELECT table_schema || '-users-' || lsn || '-0' AS correlation_id, op, 'after' AS capture_stage FROM feed WHERE op <> 'delete' AND NOT (event_type = 'click' AND event_id % 4 = 0)")
def dbg_2_after_capture(spark, sf):
    return audited(spark, sf)[1].select("correlation_id", "op", "capture_stage")


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 48 HOURS")
def fn_12_retention_by_age(spark, sf):
    return audit.by_age(table(spark, sf, "events"), F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"), 48, "ts").select("event_id", "ts")


@query("SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC OFFSET 1000")
def win_4_expired_by_count(spark, sf):
    return audit.expired(table(spark, sf, "events").select("event_id", "ts"), 1000, "ts", "event_id")


@query("SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def srt_8_recent_activity(spark, sf):
    return audit.newest(table(spark, sf, "events"), 100, [F.desc("ts"), F.desc("event_id")]).select("event_id", "ts")


# --- chunking and streams ------------------------------------------------------------------------------------


@query(f"{FEED} SELECT event_id, CAST((row_number() OVER (PARTITION BY table_schema ORDER BY lsn) - 1) // greatest(400 // 3, 1) AS BIGINT) AS statement FROM feed")
def win_6_statement_chunks(spark, sf):
    return chunking.statements(feed(spark, sf), ["table_schema"], ["lsn"], F.lit(3), 400).select("event_id", "statement")


@query("""WITH RECURSIVE d AS (SELECT source, doc_id, CAST(octet_length(encode(text)) AS INT) AS bytes, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
 r AS (SELECT source, doc_id, bytes, i, CAST(0 AS BIGINT) AS request, CAST(bytes AS BIGINT) AS used FROM d WHERE i = 1
 UNION ALL SELECT d.source, d.doc_id, d.bytes, d.i, CASE WHEN r.used > 0 AND r.used + d.bytes > 60800 THEN r.request + 1 ELSE r.request END, CASE WHEN r.used > 0 AND r.used + d.bytes > 60800 THEN d.bytes ELSE r.used + d.bytes END FROM r JOIN d ON d.source = r.source AND d.i = r.i + 1)
 SELECT source, doc_id, bytes, request FROM r""")
def win_7_byte_chunks(spark, sf):
    docs = table(spark, sf, "documents").select("source", "doc_id", F.octet_length("text").alias("bytes"))
    return chunking.byte_chunks(docs, ["source"], ["doc_id"], "bytes", 64_000)


@query(f"{FEED} SELECT event_id FROM feed")
def str_16_dedup_by_message_id(spark, sf):
    e = feed(spark, sf)
    return filters.once(e.unionByName(e.filter("event_id % 3 = 0"))).select("event_id")


@query(f"{FEED} SELECT event_id, CAST((SELECT count(*) FROM (VALUES (2100), (4100)) m(l) WHERE l <= feed.lsn AND feed.table_schema = 'public') AS INT) AS segment FROM feed")
def str_10_barrier_segments(spark, sf):
    from tidemark.streaming.pipeline import barrier_segments

    e = feed(spark, sf)
    marks = spark.createDataFrame([("public", "users", 2100), ("public", "users", 4100)], "table_schema string, table_name string, lsn bigint").withColumn("op", F.lit("schema_change")).withColumn("seq", F.lit(0).cast("bigint"))
    return barrier_segments(e.unionByName(marks, allowMissingColumns=True)).filter("op <> 'schema_change'").select("event_id", "segment")


@query(f"{FEED}{_PLAIN}".replace("FROM events)", "FROM events WHERE event_type <> 'purchase')"))
def str_1_stream_replay(spark, sf):
    """The log landed as files and streamed into a versioned table, one micro-batch for a few published batches."""
    import uuid

    from tidemark.plans.spec import PipelineSpec, TableSpec
    from tidemark.streaming.pipeline import Sink, run_all
    from tidemark.streaming.scratch import root

    base = f"{root(spark)}/replay-{uuid.uuid4().hex}"
    log = feed(spark, sf)
    log = log.select(*[c for c in log.columns if c not in ("event_id", "event_type")]).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    last = log.agg(F.max("batch_id")).first()[0]
    for part in range(4):  # published batches in order, landed as four files
        some = log.filter((F.col("batch_id") * 4 >= part * (last + 1)) & (F.col("batch_id") * 4 < (part + 1) * (last + 1)))
        some.coalesce(1).write.mode("append").parquet(f"{base}/log")
    spec = PipelineSpec("replay", "pg1", ["main"], [TableSpec("users", KEYS, COLUMNS)])
    run_all(spark, spec, f"{base}/log", base)
    return Sink(spark, spec, "main", base).table("users").read().drop("_first")


# --- more of the inventory -----------------------------------------------------------------------------------


@query(f"""{FEED}, base AS (SELECT user_id, arg_max(props, lsn) AS props FROM feed WHERE batch_id = 0 AND op <> 'delete' AND event_type <> 'view' GROUP BY 1),
 late AS (SELECT event_id, user_id, event_type, props, last_value(CASE WHEN event_type <> 'view' THEN props END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY lsn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS own FROM feed WHERE batch_id > 0 AND op <> 'delete')
 SELECT l.event_id, coalesce(l.own, b.props) AS props FROM late l LEFT JOIN base b USING (user_id)""")
def jon_2_toast_read_back(spark, sf):
    """The value of each later event: from its own batch, else read back from the table of the first batch."""
    e = feed(spark, sf)
    late = apply.forward_fill(e.filter("batch_id > 0"), KEYS, "props", "own")
    base = apply.fold(e.filter("batch_id = 0"), KEYS, COLUMNS)
    back = apply.read_back(late, base, ["user_id"], ["props"])
    return late.join(back, "user_id", "left").select("event_id", F.coalesce("own", "props").alias("props"))


@query(f"{FEED} SELECT event_id, CASE WHEN op = 'delete' THEN 'delete' ELSE 'upsert' END AS side FROM feed")
def app_1_partition_batch(spark, sf):
    ups, dels = apply.split_batch(feed(spark, sf))
    return ups.select("event_id", F.lit("upsert").alias("side")).unionByName(dels.select("event_id", F.lit("delete").alias("side")))


@query(f"{FEED} SELECT user_id, max(ts) FILTER (WHERE op = 'delete') AS deleted_at FROM feed GROUP BY user_id HAVING count(*) FILTER (WHERE op <> 'delete') > 0")
def app_2_delete_wins(spark, sf):
    """The whole feed as one flush: deletes come after all upserts, whatever their LSNs."""
    e = feed(spark, sf).withColumn("batch_id", F.lit(0).cast("bigint"))
    return apply.fold(e, KEYS, COLUMNS).select("user_id", "deleted_at")


@query(f"{FEED} SELECT table_schema || '-users-' || lsn || '-0' AS correlation_id, op, lsn, ts AS message_timestamp FROM feed WHERE op <> 'delete' AND event_id % 20 <> 0")
def dbg_1_before_capture(spark, sf):
    e = feed(spark, sf).withColumn("op", F.when(F.col("event_id") % 20 == 0, "schema_change").otherwise(F.col("op")))
    return audit.before(e, filters.CaptureFilter(operations=["insert", "update"])).select("correlation_id", "op", "lsn", "message_timestamp")


@query(f"{FEED} SELECT table_schema || '-users-' || lsn || '-0' AS correlation_id, (event_type = 'click' AND event_id % 4 = 0) AS filtered FROM feed WHERE op <> 'delete'")
def dbg_3_mark_filtered(spark, sf):
    captured, passed = audited(spark, sf)
    return audit.mark_filtered(captured, passed).select("correlation_id", "filtered")


@query(f"{FEED} SELECT table_schema, lsn, r AS rank FROM (SELECT table_schema, lsn, CAST(row_number() OVER (PARTITION BY table_schema, table_name ORDER BY ts DESC, lsn DESC) AS INT) AS r FROM feed WHERE op <> 'delete') WHERE r <= 50")
def dbg_6_recent_by_table(spark, sf):
    return audit.rank_in_table(audited(spark, sf)[0]).filter("rank <= 50").select("table_schema", "lsn", "rank")


@query(f"SELECT event_id, CAST(date_diff('microsecond', ts, TIMESTAMP '{NOW}') // 1000 AS BIGINT) AS lag_ms FROM events")
def fn_10_lag_ms(spark, sf):
    return table(spark, sf, "events").select("event_id", timing.lag_ms(F.lit(NOW).cast("timestamp_ntz"), F.col("ts")).alias("lag_ms"))


@query(f"{FEED} SELECT event_id, CASE WHEN op = 'delete' THEN 1 WHEN event_type = 'view' THEN 2 ELSE 3 END AS n_keys, op <> 'delete' AND event_type <> 'view' AS has_props, CASE WHEN op = 'delete' THEN 'user_id' ELSE 'user_id,value' END AS rest FROM feed")
def fn_15_map_functions(spark, sf):
    e = feed(spark, sf).select("event_id", F.size("data").alias("n_keys"), envelope.has("props").alias("has_props"), envelope.without("props").alias("data"))
    return e.select("event_id", "n_keys", "has_props", envelope.names().alias("rest"))


@query("SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS cents, p_size, p_name FROM part")
def fn_23_typed_values(spark, sf):
    """Values through their text form and back."""
    p = table(spark, sf, "part").select("p_partkey", F.round(F.col("p_retailprice") * 100).cast("decimal(20,0)").alias("cents"), "p_size", "p_name")
    return p.select("p_partkey", *[types.typed(types.wire_text(F.col(c), t), "bigint" if t.startswith("decimal") else t).alias(c) for c, t in p.dtypes[1:]])


@query("SELECT n_name FROM nation WHERE n_nationkey % 4 <> 0")
def fil_11_without_snapshot_helpers(spark, sf):
    n = F.col("n_nationkey") % 4 == 0
    named = table(spark, sf, "nation").withColumn("table_name", F.when(n, F.concat(F.lit("cdc_snapshot_"), "n_name")).otherwise(F.col("n_name")))
    return filters.without_snapshot_helpers(named).select(F.col("table_name").alias("n_name"))


@query(f"{FEED} SELECT lsn, count(*) AS n FROM (SELECT lsn FROM feed UNION ALL SELECT 0 FROM customer) GROUP BY 1")
def set_1_snapshot_and_stream(spark, sf):
    log = feed(spark, sf).select("table_schema", "table_name", "op", "lsn")
    snap = envelope.snapshot(table(spark, sf, "customer"), "public", "customer", ["c_custkey"]).select("table_schema", "table_name", "op", "lsn")
    return envelope.with_snapshot(log, snap).groupBy("lsn").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'c' || (event_id // 4) AS correlation_id FROM events GROUP BY 1 HAVING count(DISTINCT user_id % 3) >= 3")
def set_4_acknowledged_changes(spark, sf):
    e = table(spark, sf, "events")
    acks_ = e.select(F.concat(F.lit("c"), F.floor(F.col("event_id") / 4).cast("string")).alias("correlation_id"), F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")).alias("sink_id"))
    return schema.acknowledged(acks_, 3)


@query(f"{FEED} SELECT lsn, CAST(count(*) AS BIGINT) AS pending FROM feed WHERE event_id % 97 = 96 GROUP BY 1 ORDER BY 1 LIMIT 10")
def srt_7_first_pending(spark, sf):
    return watermark.unconfirmed(watermark.ack_counts(*acks(spark, sf), ["b"]), 10)


@query("""SELECT r_name AS table_schema, n_name AS table_name, CASE WHEN n_nationkey % 3 = 0 THEN 'k' || n_nationkey || ',turn' WHEN n_nationkey % 3 = 1 THEN lower(n_name) || '_id' WHEN n_regionkey <> 4 THEN 'id' END AS keys FROM nation JOIN region ON n_regionkey = r_regionkey""")
def snk_9_key_resolution(spark, sf):
    """Keys from the registry, from the DDL, by default, or unresolved where a schema has no default."""
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).withColumns({"table_schema": F.col("r_name"), "table_name": F.col("n_name"), "k": F.concat(F.lit("k"), F.col("n_nationkey").cast("string"))})
    reg = n.filter("n_nationkey % 3 = 0").select("table_schema", "table_name", F.lit(1).cast("bigint").alias("version"), F.create_map("k", F.lit("int8")).alias("columns"), F.array("k", F.lit("turn")).alias("pk_columns"))
    own = F.concat(F.lower("n_name"), F.lit("_id"))
    ddl = n.filter("n_nationkey % 3 = 1").select("table_schema", "table_name", F.concat(F.lit("CREATE TABLE t (`"), own, F.lit("` INT, PRIMARY KEY (`"), own, F.lit("`))")).alias("ddl"))
    strict = [r["r_name"] for r in table(spark, sf, "region").filter("r_regionkey = 4").collect()]  # one name
    found = schema.resolve_keys(n.select("table_schema", "table_name"), reg, ddl, strict)
    return found.select("table_schema", "table_name", F.when(F.col("pk_columns").isNotNull(), F.array_join("pk_columns", ",")).alias("keys"))


@query("SELECT c_custkey, regexp_replace('postgres://u:' || c_name || '@h/db', '(://[^:/@]*):[^@]*@', '\\1:***@') AS dsn FROM customer")
def prj_4_masked_dsn(spark, sf):
    from tidemark.sources.catalog import masked_dsn

    return table(spark, sf, "customer").select("c_custkey", masked_dsn(F.concat(F.lit("postgres://u:"), "c_name", F.lit("@h/db"))).alias("dsn"))


# --- catalog -------------------------------------------------------------------------------------------------

_OIDS = "SELECT event_id, coalesce(s, 'public') AS table_schema, t AS table_name FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'orders' ELSE n_name END AS t, CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'r' || n_regionkey END AS s FROM events LEFT JOIN nation ON n_nationkey = user_id % 30)"


@query(_OIDS)
def src_5_relation_cache(spark, sf):
    """Names by relation number where an event has none of its own."""
    own = F.col("event_id") % 2 == 0
    e = table(spark, sf, "events").select("event_id", F.lit(None).cast("string").alias("table_schema"), F.when(own, F.lit("orders")).alias("table_name"), F.when(~own, F.col("user_id") % 30).alias("oid"))
    relations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("oid"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("table_schema"), F.col("n_name").alias("table_name"))
    return catalog.resolve_relations(e, relations).select("event_id", "table_schema", "table_name")


def _keys_of_nations(spark, sf):
    """Tables are nations, their key columns are suppliers, in the order of supplier numbers from above."""
    n, sup = table(spark, sf, "nation"), table(spark, sf, "supplier")
    constraints = n.select(F.lit("public").alias("table_schema"), F.col("n_name").alias("table_name"), F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("constraint_name"), F.when(F.col("n_regionkey") < 3, "PRIMARY KEY").otherwise("UNIQUE").alias("constraint_type"))
    columns = sup.select(F.lit("public").alias("table_schema"), F.concat(F.lit("c"), F.col("s_nationkey").cast("string")).alias("constraint_name"), F.col("s_name").alias("column_name"), (-F.col("s_suppkey")).alias("ordinal_position"))
    return constraints, columns


@query("SELECT 'public' AS table_schema, n_name AS table_name, string_agg(s_name, ',' ORDER BY s_suppkey DESC) AS pk FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey < 3 GROUP BY n_name")
def src_10_declared_keys(spark, sf):
    return catalog.declared_keys(*_keys_of_nations(spark, sf)).select("table_schema", "table_name", F.array_join("pk_columns", ",").alias("pk"))


@query("SELECT n_name AS table_name, string_agg(s_name, ',' ORDER BY s_suppkey DESC) AS pk FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey < 3 GROUP BY n_name")
def jon_6_key_catalog_join(spark, sf):
    constraints, columns = _keys_of_nations(spark, sf)
    return catalog.declared_keys(constraints.filter("constraint_type <> 'UNIQUE'"), columns).select("table_name", F.array_join("pk_columns", ",").alias("pk"))


@query("SELECT l_orderkey AS relid, string_agg('c' || l_linenumber, ',' ORDER BY l_linenumber DESC) AS pk FROM lineitem WHERE l_linenumber IN (1, 3, 4) GROUP BY 1")
def jon_7_index_keys(spark, sf):
    """Tables are orders, their columns are lines; the index names columns 4, 3 and 1."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("relid"), F.col("l_linenumber").cast("int").alias("attnum"), F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("name"))
    indexes = table(spark, sf, "orders").select(F.col("o_orderkey").alias("relid"), F.lit(True).alias("is_primary"), F.array(F.lit(4), F.lit(3), F.lit(1)).alias("indkey"))
    return catalog.indexed_keys(lines, indexes).select("relid", F.array_join("pk_columns", ",").alias("pk"))


@query("""SELECT n_name AS table_name, string_agg(s_name || ':' || CASE WHEN s_acctbal < 0 THEN 'int4' ELSE 'text' END, ',' ORDER BY s_name) AS columns, CASE WHEN n_regionkey < 3 THEN string_agg(s_name, ',' ORDER BY s_suppkey DESC) END AS pk
 FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name, n_regionkey""")
def src_9_column_metadata(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"))
    columns = n.select(F.lit("public").alias("table_schema"), F.col("n_name").alias("table_name"), F.col("s_name").alias("column_name"), F.when(F.col("s_acctbal") < 0, "int4").otherwise("text").alias("data_type"))
    found = catalog.column_metadata(columns, catalog.declared_keys(*_keys_of_nations(spark, sf)))
    listed = F.transform(F.array_sort(F.map_entries("columns")), lambda e: F.concat_ws(":", e["key"], e["value"]))
    return found.select("table_name", F.array_join(listed, ",").alias("columns"), F.when(F.col("pk_columns").isNotNull(), F.array_join("pk_columns", ",")).alias("pk"))


@query("SELECT DISTINCT r_name AS table_schema FROM region WHERE r_regionkey <> 2")
def src_11_schemas(spark, sf):
    t = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return catalog.schemas_of(t.select(F.when(F.col("r_regionkey") == 2, "pg_catalog").otherwise(F.col("r_name")).alias("table_schema")))


@query("SELECT 'r' || n_regionkey AS table_schema, n_name AS table_name FROM nation WHERE n_regionkey < 2 AND n_nationkey % 2 = 0 UNION ALL SELECT 'r' || n_regionkey, n_name FROM nation WHERE n_regionkey >= 2")
def src_12_listed_tables(spark, sf):
    n = table(spark, sf, "nation").select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("table_schema"), F.col("n_name").alias("table_name"), "n_regionkey", "n_nationkey")
    return catalog.listed_tables(n.filter("n_regionkey < 2 AND n_nationkey % 2 = 0"), n)


@query(f"{FEED}{_ACKS}{_COUNTS} SELECT coalesce(max(lsn) FILTER (WHERE lsn < f), 0) AS position FROM counts, (SELECT min(lsn) FILTER (WHERE NOT confirmed) AS f FROM counts)")
def src_15_resume_position(spark, sf):
    """Where reading starts again: after what all sinks have acknowledged."""
    from tidemark.sources.log import resume_position

    observed, told = acks(spark, sf)
    mine = observed.filter("NOT self_acked").withColumn("op", F.lit("insert"))
    selfed = observed.filter("self_acked").select("lsn", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("sink_id"))
    position = resume_position(mine.select("lsn", "op").unionByName(observed.filter("self_acked").select("lsn", F.lit("insert").alias("op"))), told.unionByName(selfed).withColumn("op", F.lit("insert")), ["a", "b"])
    return spark.createDataFrame([(position,)], "position bigint")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'id:int8' ELSE 'extra:text' END AS columns FROM nation")
def prj_2_schema_of_change(spark, sf):
    own = F.when(F.col("n_nationkey") % 2 == 0, F.create_map(F.lit("id"), F.lit("int8")))
    changes = table(spark, sf, "nation").select("n_nationkey", own.alias("columns"), F.create_map(F.lit("extra"), F.lit("text")).alias("added"))
    return catalog.schema_of_change(changes).select("n_nationkey", F.array_join(F.transform(F.map_entries("columns"), lambda e: F.concat_ws(":", e["key"], e["value"])), ",").alias("columns"))


@query("SELECT n_nationkey, 'num:int8,' || lower(n_name) || ':text' AS columns, 'num' AS pk FROM nation")
def prj_3_renamed_schema(spark, sf):
    reg = table(spark, sf, "nation").select("n_nationkey", F.create_map(F.lit("id"), F.lit("int8"), F.lower("n_name"), F.lit("text")).alias("columns"), F.array(F.lit("id")).alias("pk_columns"))
    new = catalog.renamed(reg, {"id": "num"})
    return new.select("n_nationkey", F.array_join(F.transform(F.map_entries("columns"), lambda e: F.concat_ws(":", e["key"], e["value"])), ",").alias("columns"), F.array_join("pk_columns", ",").alias("pk"))


@query("SELECT n_name AS table_name, 'age INT64, deleted_at TIMESTAMP' AS columns FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT n_name, 'a' || n_nationkey || ' STRING, deleted_at TIMESTAMP' FROM nation WHERE n_nationkey % 2 = 1")
def srt_4_sorted_ddl(spark, sf):
    cols = F.when(F.col("n_nationkey") % 2 == 0, F.create_map(F.lit("deleted_at"), F.lit("timestamp"), F.lit("age"), F.lit("int4"))).otherwise(F.create_map(F.concat(F.lit("a"), F.col("n_nationkey").cast("string")), F.lit("text")))
    reg = table(spark, sf, "nation").select(F.lit("public").alias("table_schema"), F.col("n_name").alias("table_name"), cols.alias("columns"))
    return schema.table_ddl(reg).select("table_name", "columns")


@query("SELECT n_name AS table_name FROM nation WHERE n_regionkey >= 3")
def set_3_added_tables(spark, sf):
    """Tables that a new revision of a specification adds, and nothing else, so that the pipeline needn't start anew."""
    from tidemark.plans.spec import PipelineSpec, TableSpec, new_tables, reload_action

    rows = table(spark, sf, "nation").select("n_name", "n_regionkey").collect()  # the names of a specification's tables
    safe = lambda n: n.replace(" ", "_")
    spec = lambda names: PipelineSpec("p", "pg", ["main"], [TableSpec(safe(n), {"id": "bigint"}, {}) for n in names])
    old, new = spec(r.n_name for r in rows if r.n_regionkey < 3), spec(r.n_name for r in rows)
    added = {t.name for t in new_tables(old, new)} if reload_action(old, new) == "add_tables" else set()
    return spark.createDataFrame([(r.n_name,) for r in rows if safe(r.n_name) in added], "table_name string")


# --- functions -----------------------------------------------------------------------------------------------


@query(f"{FEED} SELECT event_id, 'p1.pg1.s' || (event_id % 3) || '.' || CASE WHEN table_schema = 'public' THEN table_name ELSE table_schema || '=' || table_name END AS k FROM feed")
def idn_stats_key(spark, sf):
    sink = F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string"))
    return feed(spark, sf).select("event_id", identity.stats_key(F.lit("p1"), F.col("source_id"), sink, F.col("table_schema"), F.col("table_name")).alias("k"))


@query("SELECT p_partkey, regexp_full_match(CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '_') WHEN 2 THEN 'public.t' || p_partkey ELSE 'a..b' END, '[A-Za-z0-9_]+([.][A-Za-z0-9_]+)*') AS ok FROM part")
def fn_5_identifiers(spark, sf):
    k = F.col("p_partkey") % 4
    name = F.when(k == 0, F.col("p_name")).when(k == 1, F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))).when(k == 2, F.concat(F.lit("public.t"), F.col("p_partkey").cast("string"))).otherwise("a..b")
    return table(spark, sf, "part").select("p_partkey", identity.is_identifier(name).alias("ok"))


@query("SELECT event_id, CAST(date_diff('microsecond', ts, ts + to_microseconds(event_id * 1700)) // 1000 AS BIGINT) AS processing_latency_ms FROM events")
def fn_11_processing_latency(spark, sf):
    later = table(spark, sf, "events").withColumn("end", F.timestamp_add("MICROSECOND", F.col("event_id") * 1700, F.col("ts")))
    return audit.latency_ms(later, "ts", "end").select("event_id", "processing_latency_ms")


@query("SELECT event_id, rtrim(rtrim(strftime(t, '%Y-%m-%dT%H:%M:%S.%f'), '0'), '.') || 'Z' AS at FROM (SELECT event_id, ts + to_microseconds(CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 250000 ELSE 123457 END) AS t FROM (SELECT event_id, date_trunc('minute', ts) + INTERVAL 7 SECOND AS ts FROM events))")
def fn_14_rfc3339(spark, sf):
    k = F.col("event_id") % 3
    t = F.timestamp_add("MICROSECOND", F.when(k == 0, 0).when(k == 1, 250_000).otherwise(123_457), F.date_trunc("minute", "ts").cast("timestamp_ntz") + F.expr("INTERVAL 7 SECOND"))
    return table(spark, sf, "events").select("event_id", timing.rfc3339(t).alias("at"))


@query("SELECT conv_id, turn, '[\"' || turn || '\",\"x\"]' AS list, role AS part FROM conversations")
def fn_16_nested_values(spark, sf):
    kind = "struct<a:array<string>,b:struct<c:string,d:date>>"
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.struct(F.array(F.col("turn").cast("string"), F.lit("x")).alias("a"), F.struct(F.col("role").alias("c"), F.lit("2024-02-29").cast("date").alias("d")).alias("b")).alias("v"))
    plain = types.normalised(F.col("v"), kind)
    return c.select("conv_id", "turn", F.to_json(plain["a"]).alias("list"), plain["b"]["c"].alias("part"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN replace(props, ' ', '') ELSE 'plain' END AS v FROM events WHERE props IS NOT NULL")
def fn_18_json_or_text(spark, sf):
    """Parsed where it is JSON, raw text where it isn't."""
    v = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise("plain")
    parsed = types.json_or_text(v)
    shown = F.when(F.schema_of_variant(parsed) == "STRING", F.variant_get(parsed, "$", "string")).otherwise(F.to_json(parsed))
    return table(spark, sf, "events").filter("props IS NOT NULL").select("event_id", shown.alias("v"))


@query("SELECT c_custkey, c_name AS opened, false AS same FROM customer")
def fn_21_sealed_secrets(spark, sf):
    key = bytes(range(32))
    sealed = catalog.sealed(F.col("c_name"), key)
    return table(spark, sf, "customer").select("c_custkey", sealed.alias("s"), "c_name").select("c_custkey", catalog.opened(F.col("s"), key).alias("opened"), (F.col("s") == F.col("c_name")).alias("same"))


@query("SELECT c_custkey AS k, sha256('public.customer:{\"c_custkey\":' || c_custkey || '}') AS uuid FROM customer")
def fn_25_snapshot_uuid(spark, sf):
    """Message ids that are the same on every run."""
    return envelope.snapshot(table(spark, sf, "customer"), "public", "customer", ["c_custkey"]).select(carried("c_custkey", "bigint").alias("k"), "uuid")


@query(f"WITH {_STATS} SELECT pipeline, sink_id, count(DISTINCT table_name) AS n_tables, CAST(sum(total_synced) AS BIGINT) AS total_synced, max(lag_ms) AS lag_ms, max({{'updated_at': updated_at, 'status': status}}).status AS status FROM stats GROUP BY 1, 2")
def agg_6_sink_breakdown(spark, sf):
    return stats.sink_breakdown(sink_stats(spark, sf))


@query(f"{FEED} SELECT table_schema, metric, value FROM (SELECT table_schema, unnest(['synced', 'errors', 'unchanged']) AS metric, unnest([count(*), count(*) FILTER (WHERE op = 'delete'), count(*) FILTER (WHERE event_type = 'view')]) AS value FROM feed GROUP BY 1) WHERE value > 0")
def agg_20_counters(spark, sf):
    return stats.counters(feed(spark, sf), {"synced": F.lit(True), "errors": F.col("op") == "delete", "unchanged": envelope.unchanged("props")}, ["table_schema"])


@query(f"{FEED} SELECT table_schema, arg_max(event_id, lsn) AS value FROM feed GROUP BY 1")
def agg_20_gauges(spark, sf):
    return stats.gauges(feed(spark, sf), ["table_schema"], "event_id", ["lsn", "seq"])


@query(f"{FEED} SELECT event_id FROM feed WHERE op <> 'delete'")
def fil_6_capture_stage(spark, sf):
    first, second = audited(spark, sf)
    rows = audit.mark_filtered(first, second).unionByName(second)
    return filters.at_stage(rows, filters.CaptureFilter(stages=["before"])).select(((F.col("lsn") - 100) / 8).cast("bigint").alias("event_id"))


# --- payloads, sinks and streams -----------------------------------------------------------------------------


def _wire(spark, sf):
    """The feed as envelopes alone."""
    log = feed(spark, sf)
    return log.select(*[c for c in log.columns if c not in ("event_id", "event_type")]).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def _place(spark, name):
    import uuid

    from tidemark.streaming.scratch import root, temporary

    base = f"{root(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return temporary(spark, base)


@query(f"{FEED} SELECT event_id, CASE event_id % 3 WHEN 2 THEN 'deserialization_failed' END AS reason, CASE WHEN event_id % 3 < 2 THEN user_id END AS user_id FROM feed")
def app_8_payloads(spark, sf):
    """Data as it is, else from JSON, else with the dead letters."""
    from tidemark.sources.payload import decode_payloads

    k = F.col("event_id") % 3
    body = F.when(k == 1, F.to_json(F.map_filter("data", lambda n, _: n == "user_id"))).when(k == 2, "not a payload")
    e = feed(spark, sf).select("event_id", F.when(k == 0, F.col("data")).alias("data"), F.encode(body, "UTF-8").alias("payload"))
    good, dead = decode_payloads(e)
    return good.select("event_id", F.lit(None).cast("string").alias("reason"), carried("user_id", "bigint").alias("user_id")).unionByName(dead.select("event_id", "reason", F.lit(None).cast("bigint").alias("user_id")))


@query(f"{FEED} SELECT event_id, user_id * 2 AS doubled FROM feed WHERE op <> 'insert' OR event_id % 5 <> 0")
def udf_7_remote_transformer(spark, sf):
    """A remote function over requests of bounded size: it changes the data of most events and rejects some inserts."""
    from tidemark.functions.remote import Answer, remote

    def ask(rows):
        out = []
        for r in rows:
            data = dict(r["data"])
            out.append(Answer(success=not (r["op"] == "insert" and r["event_id"] % 5 == 0), data={"user_id": str(2 * int(data["user_id"]))}))
        return out

    e = feed(spark, sf).select("event_id", "op", "data")
    return registry.run_batch(e, remote(ask, budget=4096)).select("event_id", carried("user_id", "bigint").alias("doubled"))


@query(f"{FEED} SELECT event_id, event_type = 'view' AS dropped FROM feed")
def udf_2_dropped_events(spark, sf):
    """What a batch transformer drops, told in the same pass."""
    if "queries/without_views" not in registry._FACTORIES:
        registry.register("queries/without_views", lambda **_: registry.BatchTransformer(lambda frames: (d[d["event_type"] != "view"] for d in frames)))
    out, gone = registry.apply_chain(feed(spark, sf), [Processor("queries/without_views", ["update"])])
    return out.select("event_id", F.lit(False).alias("dropped")).unionByName(gone.select("event_id", F.lit(True).alias("dropped")))


@query(f"{FEED} SELECT event_id FROM feed")
def snk_10_published_log(spark, sf):
    """Events published in three batches, one of them twice and with repeats inside; the landed log has each once."""
    from tidemark.sources.log import Publisher

    log, wire = f"{_place(spark, 'published')}/log", _wire(spark, sf)
    publisher = Publisher(spark, log, batch_size=5000)
    for part in (0, 1, 2, 1):
        some = wire.filter(F.col("batch_id") % 3 == part)
        publisher.publish(some.unionByName(some.filter(F.col("lsn") % 16 == 4)), part)
    return envelope.read_log(spark, log).select(((F.col("lsn") - 100) / 8).cast("bigint").alias("event_id"))


@query(f"{FEED} SELECT event_id FROM feed WHERE table_schema = 'sales'")
def src_1_landed_source(spark, sf):
    """The landed log as a named source, narrowed to one table and read as a stream."""
    from tidemark.sources.log import create_source

    base = _place(spark, "source")
    _wire(spark, sf).write.parquet(f"{base}/log")
    source = create_source("landed", spark, f"{base}/log", tables=[("sales", "users")])
    q = source.start().writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("lsn bigint").parquet(f"{base}/out").select(((F.col("lsn") - 100) / 8).cast("bigint").alias("event_id"))


_HALF = "(SELECT max(event_id) // 2 FROM events)"


@query(f"""{FEED}, mine AS (SELECT * FROM feed WHERE table_schema = 'public'), ups AS (SELECT * FROM mine WHERE op <> 'delete'),
 last AS (SELECT user_id, arg_max(value, lsn) AS value, max(event_id) FILTER (WHERE event_id > {_HALF}) AS late FROM ups GROUP BY 1)
 SELECT u.user_id, u.value, CASE WHEN late IS NOT NULL AND l.event_id = late THEN CAST(late AS BIGINT) END AS seen_at FROM last u LEFT JOIN (SELECT user_id, max(event_id) AS event_id FROM ups GROUP BY 1) l USING (user_id)""")
def str_11_columns_in_the_stream(spark, sf):
    """A log in whose second half a declared column appears; the streamed table gets it, with its declared type, and keeps the earlier rows."""
    from tidemark.plans.spec import PipelineSpec, TableSpec
    from tidemark.streaming.pipeline import Sink, run_all

    base, wire = _place(spark, "evolving"), _wire(spark, sf)
    half = table(spark, sf, "events").agg(F.floor(F.max("event_id") / 2)).first()[0] * 8 + 100
    mine = wire.filter("table_schema = 'public'")
    late = F.col("lsn") > half
    grown = mine.filter(late).withColumn("data", F.when(F.col("op") != "delete", F.map_concat("data", F.create_map(F.lit("seen_at"), ((F.col("lsn") - 100) / 8).cast("bigint").cast("string")))).otherwise(F.col("data")))
    change = mine.filter(late).orderBy("lsn").limit(1).withColumns({"op": F.lit("schema_change"), "data": F.create_map(F.lit("seen_at"), F.lit("int8")), "seq": F.lit(-1).cast("bigint")})
    spec = PipelineSpec("evolving", "pg1", ["main"], [TableSpec("users", KEYS, {"value": "double"})])
    for part in (mine.filter(~late), grown.unionByName(change)):
        part.coalesce(1).write.mode("append").parquet(f"{base}/log")
        run_all(spark, spec, f"{base}/log", base)
    return Sink(spark, spec, "main", base).table("users").read().select("user_id", "value", "seen_at")


@query(f"{FEED} SELECT event_id FROM feed WHERE event_id % 4 = 2")
def snk_7_dead_batches(spark, sf):
    """Published batches that a transformer can't take are told from the others and kept as dead letters."""
    from tidemark.plans.spec import PipelineSpec, TableSpec
    from tidemark.streaming.sinks import Sink
    from tidemark.streaming.tables import AppendLog

    def poison(frames):
        for d in frames:
            if (d["batch_id"] == 2).any():
                raise RuntimeError("poison")
            yield d

    if "queries/poison" not in registry._FACTORIES:
        registry.register("queries/poison", lambda **_: registry.BatchTransformer(poison))
    spec = PipelineSpec("poisoned", "pg1", ["main"], [TableSpec("users", KEYS, COLUMNS)], processors=[Processor("queries/poison", ["insert", "update", "delete"])], max_retries=0)
    sink = Sink(spark, spec, "main", _place(spark, "poisoned"))
    few = _wire(spark, sf).withColumn("batch_id", ((F.col("lsn") - 100) / 8).cast("bigint") % 4)  # four published batches
    sink.upload(few, 0)
    return AppendLog(spark, f"{sink.root}/dead_batches").read().select(((F.col("lsn") - 100) / 8).cast("bigint").alias("event_id"))


@query(f"{FEED} SELECT event_id, 'p1' AS pipeline_id, 'main' AS sink_id, 'mask' AS transformers, event_type = 'insert' AS filtered, true AS timed FROM feed WHERE op <> 'delete'")
def snk_5_audit_rows(spark, sf):
    """Audit rows of a sink's batch before transformation, with pipeline, transformers and latency."""
    from tidemark.plans.spec import PipelineSpec, TableSpec
    from tidemark.streaming.sinks import Sink
    from tidemark.streaming.tables import AppendLog

    spec = PipelineSpec("p1", "pg1", ["main"], [TableSpec("users", KEYS, COLUMNS)], processors=[Processor("mask", ["insert"], options={"column": "props", "salt": SALT})])
    sink = Sink(spark, spec, "main", _place(spark, "audited"), capture=filters.CaptureFilter(operations=["insert", "update"]))
    sink.upload(_wire(spark, sf), 0)
    rows = filters.at_stage(AppendLog(spark, f"{sink.root}/audit").read(), filters.CaptureFilter(stages=["before"]))
    return rows.select(((F.col("lsn") - 100) / 8).cast("bigint").alias("event_id"), "pipeline_id", "sink_id", F.array_join("transformer_names", ",").alias("transformers"), "filtered", (F.col("processing_latency_ms") >= 0).alias("timed"))


@query(f"{FEED} SELECT event_id FROM feed WHERE batch_id >= (SELECT max(batch_id) - 1 FROM feed)")
def dbg_5_retained_batches(spark, sf):
    """An audit log of published batches, held to the newest rows by whole batches."""
    from datetime import datetime

    from tidemark.streaming.tables import AppendLog

    log, wire = AppendLog(spark, f"{_place(spark, 'retained')}/log"), _wire(spark, sf)
    last = wire.agg(F.max("batch_id")).first()[0]
    for b in range(max(0, last - 3), last + 1):
        log.append(wire.filter(F.col("batch_id") == b).select("lsn", F.col("ts").alias("captured_at")), b)
    log.retain(datetime(2030, 1, 1), most=wire.filter(F.col("batch_id") == last).count() + 1)
    return log.read().select(((F.col("lsn") - 100) / 8).cast("bigint").alias("event_id"))


@query(f"{FEED} SELECT sink_id, event_id FROM feed, (SELECT unnest(['copy', 'main']) AS sink_id) WHERE lsn > 0")
def str_5_acknowledged(spark, sf):
    """Each of two sinks acknowledges every event of the log once, whatever became of it."""
    from tidemark.plans.spec import PipelineSpec, TableSpec
    from tidemark.streaming.pipeline import Sink, run_all

    base = _place(spark, "acknowledged")
    _wire(spark, sf).repartition(2).write.parquet(f"{base}/log")
    spec = PipelineSpec("acks", "pg1", ["main", "copy"], [TableSpec("users", KEYS, {"value": "double"})])
    run_all(spark, spec, f"{base}/log", base)
    found = [Sink(spark, spec, s, base).acks.read().select("sink_id", ((F.col("lsn") - 100) / 8).cast("bigint").alias("event_id")) for s in spec.sinks]
    return found[0].unionByName(found[1])
