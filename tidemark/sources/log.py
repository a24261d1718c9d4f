"""Sources of change events by name, and the landed log: published batches in files, read as a batch or a stream."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.filters import once
from tidemark.operators.watermark import ack_watermark
from tidemark.plans.resilience import CircuitBreaker
from tidemark.sources.envelope import ENVELOPE, stream_log
from tidemark.streaming.tables import ControlTable


class Source(ABC):
    """start gives the events after a position (0: all) as a stream; add_tables widens it; stop ends it."""

    @abstractmethod
    def start(self, position: int = 0) -> DataFrame: ...

    def add_tables(self, names: list[tuple[str, str]]) -> None:
        return None

    def stop(self) -> None:
        return None


_SOURCES: dict[str, Callable[..., Source]] = {}


def register_source(kind: str, make: Callable[..., Source]) -> None:
    """A kind can be given once."""
    if kind in _SOURCES:
        raise ValueError(f"source kind {kind!r} exists")
    _SOURCES[kind] = make


def create_source(kind: str, *args, **options) -> Source:
    if kind not in _SOURCES:
        raise KeyError(f"no source kind {kind!r}")
    return _SOURCES[kind](*args, **options)


class LandedLog(Source):
    """A change log in files. tables (schema, name): none for all. Adding a table is idempotent and counts from the next start."""

    def __init__(self, spark: SparkSession, path: str, files_per_trigger: int | None = None, tables: list[tuple[str, str]] | None = None):
        self.spark, self.path, self.files_per_trigger = spark, path, files_per_trigger
        self.tables = list(tables) if tables else []

    def add_tables(self, names: list[tuple[str, str]]) -> None:
        self.tables += [n for n in names if n not in self.tables]

    def start(self, position: int = 0) -> DataFrame:
        events = stream_log(self.spark, self.path, self.files_per_trigger)
        if self.tables:
            some = F.lit(False)
            for s, t in self.tables:
                some = some | ((F.coalesce("table_schema", F.lit("public")) == s) & (F.col("table_name") == t))
            events = events.filter(some)
        return events.filter(F.coalesce((F.col("lsn") > position) | (F.col("lsn") == 0), F.lit(True))) if position else events


register_source("landed", LandedLog)


class Publisher:
    """Lands events as published batches, each once, in files of at most batch_size rows, behind a circuit breaker.

    Of events with one message id (uuid) in a batch one is kept; a batch number that is published already changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, batch_size: int = 1000, breaker: CircuitBreaker | None = None):
        self.spark, self.path, self.batch_size = spark, path.rstrip("/"), batch_size
        self.breaker = breaker or CircuitBreaker()
        self.control = ControlTable(spark, f"{self.path}/_published")

    def publish(self, events: DataFrame, batch_id: int) -> bool:
        def land() -> bool:
            value, revision = self.control.get(f"batch-{batch_id}")
            if value and value["state"] == "done":
                return False
            plain = self.spark.createDataFrame([], ENVELOPE)
            rows = plain.unionByName(once(events).withColumn("batch_id", F.lit(batch_id).cast("bigint")), allowMissingColumns=True).select(*plain.columns)
            rows.repartition(1 if rows.count() <= self.batch_size else self.spark.sparkContext.defaultParallelism).sortWithinPartitions("lsn", "seq").write.option("maxRecordsPerFile", self.batch_size).mode("append").parquet(self.path)
            self.control.put(f"batch-{batch_id}", {"state": "done"}, revision)
            return True

        return self.breaker.call(land)


def resume_position(log: DataFrame, acks: DataFrame, sinks: list[str]) -> int:
    """The LSN up to which every sink has acknowledged every event of the log: where reading may start again."""
    real = (F.col("lsn") > 0) & (F.col("op") != "snapshot")
    mark = ack_watermark(log.filter(real).select("lsn", F.lit(False).alias("self_acked")), acks.filter(real).select("lsn", "sink_id"), sinks).first()
    return int(mark["watermark"]) if mark else 0


