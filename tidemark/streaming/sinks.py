"""Sinks: what a pipeline's micro-batches are handed to, and the kinds of them by name."""

from __future__ import annotations

import time
from abc import ABC, abstractmethod
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.identity import checked_identifier
from tidemark.functions.registry import apply_chain
from tidemark.functions.remote import TransportError, retryable
from tidemark.functions.timing import parse_duration
from tidemark.functions.types import sink_type, spark_type, typed
from tidemark.operators import audit, schema
from tidemark.operators.apply import TOMBSTONE, fold, rejected
from tidemark.operators.filters import CaptureFilter
from tidemark.plans.spec import EVOLUTION_STATES, PipelineSpec, TableSpec, moved
from tidemark.sources.catalog import Registry
from tidemark.sources.envelope import value
from tidemark.sources.payload import decode_payloads
from tidemark.streaming.tables import AppendLog, BucketedTable, ControlTable


class Hook(ABC):
    """Sees each batch before and after its transformation; what it returns first comes back second."""

    @abstractmethod
    def before(self, batch: DataFrame, batch_id: int): ...

    @abstractmethod
    def after(self, passed: DataFrame, first, batch_id: int) -> None: ...


class SinkBase(ABC):
    """upload takes a micro-batch and may get it again; apply_schema brings tables up to declared changes; stop ends it."""

    name: str

    @abstractmethod
    def upload(self, batch: DataFrame, batch_id: int) -> None: ...

    def apply_schema(self, changes: DataFrame, batch_id: int) -> None:
        return None

    def stop(self) -> None:
        return None


@dataclass
class SinkKind:
    make: Callable[..., SinkBase]
    debug: bool = False


_KINDS: dict[str, SinkKind] = {}


def register_sink(kind: str, make: Callable[..., SinkBase], debug: bool = False) -> None:
    """make(spark, spec, sink_id, root). A kind can be given once; statistics leave debug sinks out."""
    if kind in _KINDS:
        raise ValueError(f"sink kind {kind!r} exists")
    _KINDS[kind] = SinkKind(make, debug)


def create_sink(spark: SparkSession, spec: PipelineSpec, sink_id: str, root: str, **options) -> SinkBase:
    """The sink of a pipeline, of the kind that its specification names (none: tables)."""
    kind = spec.kinds.get(sink_id, "tables")
    if kind not in _KINDS:
        raise KeyError(f"no sink kind {kind!r}")
    return _KINDS[kind].make(spark, spec, sink_id, root, **options)


def is_debug(kind: str) -> bool:
    return _KINDS[kind].debug


def of_table(events: DataFrame, t: TableSpec) -> DataFrame:
    """Events of one table, by schema and name: tables of one name in two schemas are two."""
    return events.filter((F.coalesce("table_schema", F.lit("public")) == t.ref.schema) & (F.col("table_name") == t.ref.table))


class AuditHook(Hook):
    """Writes audit rows of the events that a filter takes, before and after transformation, and schema changes beside them."""

    def __init__(self, spark: SparkSession, spec: PipelineSpec, sink_id: str, root: str, capture: CaptureFilter, clock: Callable[[], Column] = lambda: F.current_timestamp().cast("timestamp_ntz")):
        self.spec, self.sink_id, self.capture, self.clock = spec, sink_id, capture, clock
        self.messages, self.changes = AppendLog(spark, f"{root}/audit"), AppendLog(spark, f"{root}/audit_schema")

    def before(self, batch: DataFrame, batch_id: int) -> DataFrame:
        lines = batch.filter(F.col("op") == "schema_change")
        self.changes.append(audit.schema_changes(lines, self.spec.id, self.sink_id, self.clock()), batch_id)
        return audit.before(batch, self.capture).withColumn("started_at", self.clock())

    def after(self, passed: DataFrame, first: DataFrame, batch_id: int) -> None:
        rows = first.drop("started_at")
        if self.capture.takes("after"):
            second = audit.after(passed, first)
            rows = audit.mark_filtered(rows, second).unionByName(second)
        starts = first.select("correlation_id", "started_at").distinct()
        names = F.array(*[F.lit(p.name) for p in self.spec.processors if p.operations]).cast("array<string>")
        timed = audit.latency_ms(rows.join(starts, "correlation_id", "left").withColumn("captured_at", self.clock()), "started_at", "captured_at").drop("started_at")
        self.messages.append(timed.withColumns({"pipeline_id": F.lit(self.spec.id), "sink_id": F.lit(self.sink_id), "transformer_names": names}), batch_id)

    def retain(self, now, hours: float | None = None, most: int | None = None) -> dict[str, list[int]]:
        """Drops what is past its age or number from both tables, by whole batches."""
        return {"messages": self.messages.retain(now, hours, most), "changes": self.changes.retain(now, hours, most)}


class Sink(SinkBase):
    """Keyed tables that follow the log.

    Rows written, filtered and put with the dead letters all end up acknowledged; the acknowledgements are written before the
    batch counts as done. Columns that appear in the data or in a schema change are added before the batch they come with is
    applied, so a batch needs no cut at its schema changes: what came before them has no value in the new columns.
    """

    def __init__(self, spark: SparkSession, spec: PipelineSpec, sink_id: str, root: str, sleep: Callable[[float], None] = time.sleep, capture: CaptureFilter | None = None, hooks: list[Hook] | None = None):
        """capture: audit the events of the filter before and after transformation; hooks: others that see each batch."""
        self.spark, self.spec, self.sink_id, self.sleep = spark, spec.resolved().check(), sink_id, sleep
        self.name = sink_id
        self.root = f"{root.rstrip('/')}/{spec.id}/{sink_id}"
        self.dead, self.acks = AppendLog(spark, f"{self.root}/dead_letters"), AppendLog(spark, f"{self.root}/acks")
        self.checkpoints = ControlTable(spark, f"{self.root}/control")
        self.registry = Registry(spark, f"{self.root}/registry")
        self.hooks = [*(hooks or []), *([AuditHook(spark, self.spec, sink_id, self.root, capture)] if capture is not None else [])]

    def table(self, name: str) -> BucketedTable:
        t = next((t for t in self.spec.tables if t.name == name), None)
        return BucketedTable(self.spark, f"{self.root}/tables/{name}", list(t.keys) if t else [], t.buckets if t else 1)

    # --- schema ------------------------------------------------------------------------------------------------

    def prime(self) -> None:
        """Enters the tables of the specification into the registry, with their declared columns."""
        rows = [(t.ref.schema, t.ref.table, 1, {**t.keys, **t.columns}, list(t.keys)) for t in self.spec.tables]
        known = {(r["table_schema"], r["table_name"]) for r in self.registry.read().select("table_schema", "table_name").collect()}  # a row for each table
        new = [r for r in rows if (r[0], r[1]) not in known]
        if new:
            self.registry.prime(self.spark.createDataFrame(new, schema.REGISTRY))

    def columns(self, t: TableSpec) -> dict[str, str]:
        """Payload columns of a table with their Spark types: those of the specification, then those added since, by name."""
        found = self.registry.read().filter((F.col("table_schema") == t.ref.schema) & (F.col("table_name") == t.ref.table))
        added = found.select(F.explode("columns").alias("column", "type")).select("column", sink_type(F.col("type")).alias("kind")).collect()  # a row for each column
        more = {r["column"]: spark_type(r["kind"]) for r in added if r["column"] not in t.columns and r["column"] not in t.keys and r["column"] != TOMBSTONE}
        return {**t.columns, **dict(sorted(more.items()))}

    def _state(self, key: str, to: str, **more) -> None:
        self.checkpoints.update(f"evolution-{key}", lambda v: {"state": to if (v or {}).get("state", "stable") == to else moved(EVOLUTION_STATES, (v or {}).get("state", "stable"), to), **more})

    def evolve(self, events: DataFrame, batch_id: int) -> list[str]:
        """Adds the columns that events declare or carry and the registry lacks. Returns the tables that change.

        A table is frozen while its columns are being added and drains until the batch is durable; the batch itself, in the log, is
        what is held back, so a crash in between is mended by the batch coming again.
        """
        self.prime()
        mine = F.lit(False)
        for t in self.spec.tables:
            mine = mine | ((F.col("table_schema") == t.ref.schema) & (F.col("table_name") == t.ref.table))
        by = ["table_schema", "table_name"]
        named = events.withColumn("table_schema", F.coalesce("table_schema", F.lit("public"))).filter(mine)
        declared = named.filter(F.col("op") == "schema_change").select(*by, "lsn", "seq", F.explode("data").alias("column", "type"))
        stated = declared.groupBy(*by, "column").agg(F.max_by("type", F.struct("lsn", "seq")).alias("type"), F.min("lsn").alias("first_lsn"))
        carried = schema.drift(named.filter(F.col("op").isin("insert", "update", "snapshot")), self.registry.read())
        known = self.registry.read().select(*by, F.explode("columns").alias("column", "_t")).drop("_t")
        new = stated.unionByName(carried.join(stated, [*by, "column"], "left_anti").withColumn("type", F.lit(schema.UNKNOWN))).join(known, [*by, "column"], "left_anti")
        found = new.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "type")))).alias("added"), F.min("first_lsn").alias("lsn")).collect()  # new columns of a few tables
        for r in found:
            for column in r["added"]:
                if "." in checked_identifier(column):
                    raise ValueError(f"not a column name: {column!r}")
        changed = sorted(f"{r['table_schema']}.{r['table_name']}" for r in found)
        for r in found:
            self._state(f"{r['table_schema']}.{r['table_name']}", "frozen", lsn=r["lsn"], batch_id=batch_id, columns=r["added"])
        if found:
            self.registry.add(self.spark.createDataFrame([(r["table_schema"], r["table_name"], r["added"]) for r in found], "table_schema string, table_name string, added map<string,string>"))
        return changed

    def apply_schema(self, changes: DataFrame, batch_id: int) -> None:
        self.evolve(changes, batch_id)

    def _drain(self) -> list[str]:
        """Tables whose columns have been added and whose batch isn't durable yet, also from before a crash."""
        waiting = []
        for t in self.spec.tables:
            key = str(t.ref)
            state = (self.checkpoints.get(f"evolution-{key}")[0] or {}).get("state", "stable")
            if state == "frozen":
                self._state(key, "draining")
            if state in ("frozen", "draining"):
                waiting.append(key)
        return waiting

    # --- batches -----------------------------------------------------------------------------------------------

    def apply(self, events: DataFrame, batch_id: int) -> None:
        """Folds the batch into the buckets of each table that its keys fall in; the batch counts as one batch of the log."""
        for t in self.spec.tables:
            target = self.table(t.name)
            if batch_id <= target.state()["batch_id"]:
                continue
            mine, columns = of_table(events, t), self.columns(t)
            keys = mine.select(*[typed(value(k), kind).alias(k) for k, kind in t.keys.items()])

            def change(old: DataFrame | None, mine=mine, t=t, columns=columns) -> DataFrame:
                if old is not None:
                    for c, kind in columns.items():
                        if c not in old.columns:
                            old = old.withColumn(c, F.lit(None).cast(kind))
                return fold(mine, t.keys, columns, base=old)

            target.merge(keys, change, batch_id)

    def upload(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            self._upload(batch, batch_id)
        finally:
            batch.unpersist()

    def _upload(self, batch: DataFrame, batch_id: int) -> None:
        try:
            self._retry(lambda: self._write(batch, batch_id))
        except TransportError:
            raise
        except Exception as error:
            if not self.spec.enable_dlq:
                raise
            self._isolate(batch, batch_id, error)
        acks = batch.filter((F.col("lsn") > 0) & (F.col("op") != "snapshot")).select("source_id", F.lit(self.sink_id).alias("sink_id"), "table_schema", "table_name", "op", "lsn", "seq", "correlation_id")
        self.acks.append(acks, batch_id)
        top = acks.agg(F.max("lsn").alias("m")).first()["m"]
        if top is not None:
            self.checkpoints.update("egress", lambda v: {"lsn": max(top, (v or {}).get("lsn", 0)), "batch_id": batch_id})

    def _transformed(self, batch: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Decoded and transformed events, and those whose payload says nothing."""
        undecoded = None
        if "payload" in batch.columns:
            batch, undecoded = decode_payloads(batch)
        given = {"pipeline_id": self.spec.id, "batch_size": self.spec.batch_size}
        return apply_chain(batch, self.spec.processors, given)[0], undecoded

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        first = [hook.before(batch, batch_id) for hook in self.hooks]
        passed, undecoded = self._transformed(batch)
        passed = passed.persist()  # schema, dead letters and each table read it; transformers run once
        try:
            for hook, seen in zip(self.hooks, first, strict=True):
                hook.after(passed, seen, batch_id)
            self.evolve(passed, batch_id)
            waiting = self._drain()
            dead = undecoded
            for t in self.spec.tables:
                bad = rejected(of_table(passed, t), list(t.keys))
                dead = bad if dead is None else dead.unionByName(bad)
            self.dead.append(dead, batch_id)
            self.apply(passed.withColumn("batch_id", F.lit(batch_id).cast("bigint")), batch_id)
            for key in waiting:
                self._state(key, "stable")
        finally:
            passed.unpersist()

    def _retry(self, run: Callable[[], None]) -> None:
        base, cap = parse_duration(self.spec.retry_base) / 1e9, parse_duration(self.spec.retry_cap) / 1e9
        attempt = 0
        while True:
            try:
                return run()
            except Exception as error:
                if retryable(error):
                    self.sleep(min(cap, base))
                    raise error if isinstance(error, TransportError) else TransportError(str(error)[:500]) from error
                attempt += 1
                if attempt > self.spec.max_retries:
                    raise
                self.sleep(min(cap, base * 2 ** (attempt - 1)))

    def _isolate(self, batch: DataFrame, batch_id: int, error: Exception) -> None:
        """Each published batch of the micro-batch is tried alone, and those that fail alone become dead letters."""
        names = [r["batch_id"] for r in batch.select("batch_id").distinct().orderBy("batch_id").collect()]  # published batches of one micro-batch
        good = []
        for name in names:
            part = batch.filter(F.col("batch_id").eqNullSafe(F.lit(name)))
            try:
                passed, _ = self._transformed(part)
                for t in self.spec.tables:
                    fold(of_table(passed, t), t.keys, self.columns(t)).write.format("noop").mode("overwrite").save()
                for row in passed.select(F.explode(F.map_keys("data")).alias("c")).distinct().collect():  # column names
                    checked_identifier(row["c"])
                good.append(name)
            except Exception as cause:
                if retryable(cause):
                    raise TransportError(str(cause)[:500]) from cause
        keep = F.lit(False)
        for name in good:
            keep = keep | F.col("batch_id").eqNullSafe(F.lit(name))
        if good:
            self._write(batch.filter(keep), batch_id)
        dead = batch.filter(~keep).withColumn("reason", F.lit(f"batch_failed: {type(error).__name__}"))
        AppendLog(self.spark, f"{self.root}/dead_batches").append(dead, batch_id)


class AuditSink(SinkBase):
    """A sink for debugging alone: it keeps audit rows and no tables."""

    def __init__(self, spark: SparkSession, spec: PipelineSpec, sink_id: str, root: str, capture: CaptureFilter | None = None, **_):
        self.name, self.spec = sink_id, spec.resolved()
        self.root = f"{root.rstrip('/')}/{spec.id}/{sink_id}"
        self.hook = AuditHook(spark, self.spec, sink_id, self.root, capture or CaptureFilter())

    def upload(self, batch: DataFrame, batch_id: int) -> None:
        seen = self.hook.before(batch, batch_id)
        passed, _ = apply_chain(batch, self.spec.processors, {"pipeline_id": self.spec.id, "batch_size": self.spec.batch_size})
        self.hook.after(passed, seen, batch_id)


register_sink("tables", Sink)
register_sink("audit", AuditSink, debug=True)

