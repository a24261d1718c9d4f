"""Running a pipeline: a landed change log, transformed and applied per sink, each with its own checkpoint."""

from __future__ import annotations

import hashlib
import threading
import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.remote import TransportError
from tidemark.functions.timing import parse_duration
from tidemark.operators.apply import fold
from tidemark.operators.watermark import AckTracker
from tidemark.plans.resilience import supervise
from tidemark.plans.spec import SNAPSHOT_STATES, PipelineSpec, TableSpec, moved, new_tables, reload_action
from tidemark.sources.envelope import read_log, snapshot
from tidemark.sources.log import LandedLog, resume_position
from tidemark.streaming.sinks import Sink, create_sink
from tidemark.streaming.tables import AppendLog

__all__ = ["Runner", "Sink", "TransportError", "add_table", "barrier_segments", "run_all", "start"]


def start(spark: SparkSession, spec: PipelineSpec, sink_id: str, log: str, root: str, available_now: bool = True, files_per_trigger: int | None = None, sink=None):
    """A streaming query that feeds one sink; sinks advance apart, each by its own checkpoint.

    A batch size that the specification itself gives bounds micro-batches: published files hold at most so many events, and
    one file is taken at a time. Without one, and without files_per_trigger, a micro-batch takes all that has landed. A sink whose
    checkpoint is lost starts after what all sinks have acknowledged, and numbers its batches on from those that are in.
    """
    sink = sink or create_sink(spark, spec, sink_id, root)
    at = f"{sink.root}/checkpoint"
    files = files_per_trigger or (1 if spec.batch_size is not None else None)
    position, shift = 0, 0
    if isinstance(sink, Sink):
        if not sink.dead.files.exists(at):
            if sink.checkpoints.get("egress")[0]:
                position = positions(spark, spec, log, root)
            shift = max([sink.table(t.name).state()["batch_id"] for t in sink.spec.tables], default=-1) + 1
            sink.checkpoints.update("batches", lambda _: {"shift": shift, "position": position})
        else:
            kept = sink.checkpoints.get("batches")[0] or {"shift": 0, "position": 0}
            position, shift = kept["position"], kept["shift"]
    name = f"{spec.id}-{sink_id}-{hashlib.sha256(root.encode()).hexdigest()[:8]}"
    writer = LandedLog(spark, log, files).start(position).writeStream.foreachBatch(lambda batch, batch_id: sink.upload(batch, shift + batch_id)).option("checkpointLocation", at).queryName(name)
    seconds = parse_duration(spec.resolved().batch_wait) / 1e9
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()


def positions(spark: SparkSession, spec: PipelineSpec, log: str, root: str) -> int:
    """The position that a source may start from: the acknowledgement watermark over all sinks that keep acknowledgements."""
    found = [(s, AppendLog(spark, f"{root.rstrip('/')}/{spec.id}/{s}/acks").read()) for s in spec.sinks if spec.kinds.get(s, "tables") == "tables"]
    if not found or any(rows is None for _, rows in found):
        return 0
    acks = found[0][1].select("lsn", "sink_id", "op")
    for _, rows in found[1:]:
        acks = acks.unionByName(rows.select("lsn", "sink_id", "op"))
    return resume_position(read_log(spark, log), acks, [s for s, _ in found])


def run_all(spark: SparkSession, spec: PipelineSpec, log: str, root: str, files_per_trigger: int | None = None) -> None:
    """Drains the log into every sink at once."""
    for q in [start(spark, spec, s, log, root, True, files_per_trigger) for s in spec.sinks]:
        q.awaitTermination()


def add_table(sink: Sink, source: DataFrame, table: TableSpec, from_batch: int) -> bool:
    """Brings a table that joins a running pipeline up to date: its snapshot first, then the stream goes on from a batch.

    The snapshot counts as the batch before from_batch, so events that the stream delivers again only repeat what it holds. The table's
    way from snapshot to stream is kept; one that has arrived isn't read again. Returns whether the snapshot was taken.
    """
    key = f"snapshot-{table.ref}"

    def state(to: str) -> None:
        sink.checkpoints.update(key, lambda v: {"state": to if (v or {}).get("state") == to else moved(SNAPSHOT_STATES, (v or {}).get("state"), to)})

    now = (sink.checkpoints.get(key)[0] or {}).get("state")
    if now == "cdc":
        return False
    if now != "draining":
        state("snapshotting")
        try:
            rows = snapshot(source, table.ref.schema, table.ref.table, list(table.keys))
            filled = rows.select("table_schema", "table_name", "op", "lsn", F.lit(0).cast("bigint").alias("seq"), "data", F.create_map().cast("map<string,string>").alias("column_kinds"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(from_batch - 1).cast("bigint").alias("batch_id"))
            if all(t.name != table.name for t in sink.spec.tables):
                sink.spec = replace(sink.spec, tables=[*sink.spec.tables, table])
            sink.prime()
            target = sink.table(table.name)
            whole = fold(filled, table.keys, table.columns)
            target.merge(whole.select(*table.keys), lambda old: whole if old is None else fold(filled, table.keys, table.columns, base=old), from_batch - 1)
        except Exception:
            state("failed")
            raise
        state("draining")
    state("cdc")
    return True


class Runner:
    """Pipelines that run, under supervision, and follow new revisions of their specifications."""

    def __init__(self, spark: SparkSession, log: str, root: str, sources: Callable[[TableSpec], DataFrame] | None = None, sleep: Callable[[float], None] = time.sleep):
        """sources: the rows of a table that joins, for its snapshot."""
        self.spark, self.log, self.root, self.sources, self.sleep = spark, log, root, sources, sleep
        self.running: dict[str, tuple[PipelineSpec, int]] = {}
        self.trackers: dict[str, AckTracker] = {}
        self.threads: dict[str, list[threading.Thread]] = {}
        self.stopping: dict[str, threading.Event] = {}
        self.queries: dict[tuple[str, str], object] = {}
        self.failures: dict[str, str] = {}

    def _keep(self, spec: PipelineSpec, sink_id: str, available_now: bool, stop: threading.Event) -> None:
        def run() -> None:
            q = start(self.spark, spec, sink_id, self.log, self.root, available_now)
            self.queries[spec.id, sink_id] = q
            if stop.is_set():
                q.stop()
            try:
                q.awaitTermination()
            except Exception as error:
                self.failures[spec.id] = str(error)[:500]
                raise

        supervise(run, stop.is_set, sleep=self.sleep)

    def _start(self, spec: PipelineSpec, available_now: bool) -> None:
        stop = self.stopping[spec.id] = threading.Event()
        tracker = self.trackers.setdefault(spec.id, AckTracker(spec.sinks))
        tracker.hydrate(self.position(spec))
        self.threads[spec.id] = [threading.Thread(target=self._keep, args=(spec, s, available_now, stop), daemon=True) for s in spec.sinks]
        for t in self.threads[spec.id]:
            t.start()

    def position(self, spec: PipelineSpec) -> int:
        """What all sinks have acknowledged, read from their logs."""
        return positions(self.spark, spec, self.log, self.root)

    def idle(self, pipeline: str, position: int) -> bool:
        """Moves the position of a pipeline to the source's own while nothing is pending."""
        return self.trackers[pipeline].idle(position)

    def stop(self, pipeline: str) -> None:
        """Ends a pipeline's queries after the batch they are at."""
        self.stopping[pipeline].set()
        for (p, _), q in list(self.queries.items()):
            if p == pipeline and q.isActive:
                q.stop()
        self.wait(pipeline)

    def wait(self, pipeline: str) -> None:
        """Until the pipeline's queries have ended; with available_now that is when the log is drained."""
        for t in self.threads.get(pipeline, []):
            t.join()

    def reload(self, spec: PipelineSpec, revision: int, available_now: bool = True) -> str:
        """Brings a pipeline to a revision of its specification, and says how: start, ignore, skip, add_tables or restart."""
        old, old_revision = self.running.get(spec.id, (None, 0))
        action = reload_action(old, spec, old_revision, revision)
        if action in ("ignore", "skip"):
            if action == "skip":
                self.running[spec.id] = (spec, revision)
            return action
        spec.resolved().check()
        if old is not None:
            self.stop(spec.id)
        if action == "add_tables" and self.sources is not None:
            for s in spec.sinks:
                sink = create_sink(self.spark, old, s, self.root)
                if isinstance(sink, Sink):
                    done = max([sink.table(t.name).state()["batch_id"] for t in old.tables], default=-1)
                    for t in new_tables(old, spec):
                        add_table(sink, self.sources(t), t, done + 1)
        self.running[spec.id] = (spec, revision)
        self._start(spec, available_now)
        return action


def barrier_segments(events: DataFrame) -> DataFrame:
    """Numbers the stretches between schema changes, so that what comes before one is applied before it.

    Schema changes are few; their positions are joined in by range over a broadcast list of bounded size.
    """
    marks = events.filter(F.col("op") == "schema_change").select("table_schema", "table_name", F.struct("lsn", "seq").alias("_at"))
    listed = marks.groupBy("table_schema", "table_name").agg(F.array_sort(F.collect_set("_at")).alias("_marks"))
    joined = events.join(listed, ["table_schema", "table_name"], "left")
    passed = F.filter(F.coalesce("_marks", F.array().cast("array<struct<lsn:bigint,seq:bigint>>")), lambda m: m <= F.struct("lsn", "seq"))
    return joined.withColumn("segment", F.size(passed)).drop("_marks")
