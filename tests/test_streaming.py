from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from test_apply import event, events
from tidemark.functions.registry import BatchTransformer, Processor, Transformer, apply_chain, register
from tidemark.functions.remote import Answer, RemoteError, TransportError, remote, retryable
from tidemark.operators.filters import CaptureFilter
from tidemark.plans.resilience import CircuitBreaker, Open
from tidemark.plans.spec import PipelineSpec, TableSpec
from tidemark.sources.log import LandedLog, Publisher, Source, create_source, register_source, resume_position
from tidemark.streaming.pipeline import Runner, add_table, run_all, start
from tidemark.streaming.sinks import Hook, Sink, SinkBase, create_sink, is_debug, register_sink
from tidemark.streaming.tables import AppendLog, BucketedTable, Conflict, ControlTable, Files, Pointer, VersionedTable


def spec(**more):
    return PipelineSpec("p1", "pg", more.pop("sinks", ["main"]), more.pop("tables", [TableSpec("widgets", {"id": "bigint"}, {"name": "string"})]), **more)


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


# --- tables --------------------------------------------------------------------------------------------------


class Crash(Exception):
    pass


def crashing(monkeypatch, after):
    """Files that stop at the n-th change of theirs."""
    left = [after]

    def guard(name):
        real = getattr(Files, name)

        def run(self, *args):
            if left[0] == 0:
                raise Crash
            left[0] -= 1
            return real(self, *args)

        monkeypatch.setattr(Files, name, run)

    guard("create")
    guard("delete")


def test_a_crash_at_any_step_leaves_the_old_or_the_new_version(spark, tmp_path, monkeypatch):
    for kind in ("versioned", "bucketed"):
        path = f"file://{tmp_path}/{kind}"
        rows = lambda n: spark.range(n).selectExpr("id", f"{n} AS v")

        def write(n, batch):
            if kind == "versioned":
                return VersionedTable(spark, path, keep=1).replace(rows(n), batch)
            return BucketedTable(spark, path, ["id"], 4).merge(rows(n).select("id"), lambda old: rows(n), batch)

        def read():
            return sorted((r.id, r.v) for r in (VersionedTable(spark, path) if kind == "versioned" else BucketedTable(spark, path, ["id"], 4)).read().collect())

        for n in range(1, 5):
            write(n, n)
        now, batch = 4, 4
        for after in range(12):
            with monkeypatch.context() as patch:
                crashing(patch, after)
                try:
                    write(now + 1, batch + 1)
                    done = True
                except Crash:
                    done = False
            found = read()
            assert found in ([(i, now) for i in range(now)], [(i, now + 1) for i in range(now + 1)])
            write(now + 1, batch + 1)  # the batch comes again
            assert read() == [(i, now + 1) for i in range(now + 1)]
            now, batch = now + 1, batch + 1
        assert done


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    t = BucketedTable(spark, f"file://{tmp_path}/t", ["id"], 200)
    base = spark.range(2000).selectExpr("id", "'x' AS v")
    t.merge(base.select("id"), lambda old: base, 0)
    before = t.state()["buckets"]
    few = spark.range(10).selectExpr("id", "'y' AS v")
    assert t.merge(few.select("id"), lambda old: old.join(few, "id", "left_anti").unionByName(few), 1) <= 10
    after = t.state()["buckets"]
    assert 0 < sum(before[b] != after[b] for b in before) <= 10
    assert t.read().count() == 2000 and t.read().filter("v = 'y'").count() == 10
    assert t.merge(few.select("id"), lambda old: few, 1) == 0
    spark.range(1).selectExpr("0 AS _bucket", "1 AS id").write.partitionBy("_bucket").parquet(f"file://{tmp_path}/t/data/b=9-lost")
    assert t.vacuum() == 1 and t.read().count() == 2000


def test_of_two_writers_of_one_revision_one_fails(spark, tmp_path, monkeypatch):
    c = ControlTable(spark, f"file://{tmp_path}/c")
    assert c.put("k", {"a": 1}, 0) == 1
    with pytest.raises(Conflict):
        c.put("k", {"a": 2}, 0)
    # both look before either writes
    p = Pointer(Files(spark), f"file://{tmp_path}/c/k")
    monkeypatch.setattr(p, "_numbers", lambda: [1])
    assert c.put("k", {"a": 3}, 1) == 2
    with pytest.raises(Conflict):
        p.put({"a": 4}, 1)
    assert c.get("k") == ({"a": 3}, 2)


def test_old_batches_of_a_log_go_by_age_and_number(spark, tmp_path):
    log = AppendLog(spark, f"file://{tmp_path}/log")
    now = datetime(2024, 1, 10)
    for b in range(6):
        log.append(spark.createDataFrame([(b * 10 + i, now - timedelta(hours=6 - b)) for i in range(10)], "id long, captured_at timestamp_ntz"), b)
    assert log.retain(now, hours=4.5) == [1, 0] and log.retain(now, most=20) == [3, 2] and log.read().count() == 20


# --- schema --------------------------------------------------------------------------------------------------


def test_columns_that_appear_in_the_stream_reach_the_table(spark, tmp_path):
    log, root = f"file://{tmp_path}/log", f"file://{tmp_path}/out"
    land(events(spark, event("insert", 1, {"id": 1, "name": "a"}), event("insert", 2, {"id": 2, "name": "b"})), log)
    run_all(spark, spec(), log, root)
    land(events(spark, event("insert", 3, {"id": 3, "name": "c", "extra": "e"}, batch=1), event("schema_change", 4, {"age": "int4", "at": "timestamp"}, batch=1), event("update", 5, {"id": 1, "name": "a", "age": 41}, batch=1)), log)
    run_all(spark, spec(), log, root)
    land(events(spark, event("update", 6, {"id": 2, "name": "b2", "age": 7, "extra": "x"}, batch=2)), log)
    run_all(spark, spec(), log, root)
    s = Sink(spark, spec(), "main", root)
    got = s.table("widgets").read()
    assert dict(got.dtypes)["age"] == "bigint" and dict(got.dtypes)["at"] == "timestamp" and dict(got.dtypes)["extra"] == "string"
    assert sorted((r.id, r.name, r.age, r.extra) for r in got.collect()) == [(1, "a", 41, None), (2, "b2", 7, "x"), (3, "c", None, "e")]
    state, _ = s.checkpoints.get("evolution-public.widgets")
    assert state["state"] == "stable"
    reg = s.registry.read().first()
    assert reg.version == 2 and reg.columns["age"] == "int4" and reg.columns["extra"] == "unknown"
    assert {r.op for r in s.acks.read().collect()} == {"insert", "update", "schema_change"}


def test_transformers_may_change_schema_changes(spark, tmp_path):
    register("test/retype", lambda **_: Transformer(data=lambda d: F.transform_values(d, lambda _, v: F.when(v == "int4", "text").otherwise(v))))
    s = Sink(spark, spec(processors=[Processor("test/retype", ["schema_change"])]), "main", f"file://{tmp_path}")
    s.upload(events(spark, event("schema_change", 1, {"age": "int4", "at": "date"}), event("insert", 2, {"id": 1, "name": "a", "age": "x7"})), 0)
    got = s.table("widgets").read()
    assert dict(got.dtypes)["age"] == "string" and dict(got.dtypes)["at"] == "date" and got.first().age == "x7"


def test_evolution_survives_a_crash_between_registry_and_data(spark, tmp_path, monkeypatch):
    s = Sink(spark, spec(max_retries=0, enable_dlq=False), "main", f"file://{tmp_path}")
    s.upload(events(spark, event("insert", 1, {"id": 1, "name": "a"})), 0)
    batch = events(spark, event("insert", 2, {"id": 2, "name": "b", "more": "m"}))
    with monkeypatch.context() as patch:
        patch.setattr(Sink, "apply", lambda *_: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            s.upload(batch, 1)
    assert s.checkpoints.get("evolution-public.widgets")[0]["state"] == "draining"
    s.upload(batch, 1)
    assert s.checkpoints.get("evolution-public.widgets")[0]["state"] == "stable"
    assert {(r.id, r.more) for r in s.table("widgets").read().collect()} == {(1, None), (2, "m")}


def test_bad_column_names_fail_their_batch(spark, tmp_path):
    s = Sink(spark, spec(max_retries=0), "main", f"file://{tmp_path}")
    s.upload(events(spark, event("insert", 1, {"id": 1, "name": "a"}, batch=1), event("insert", 2, {"id": 2, "na me; drop": "b"}, batch=2)), 0)
    assert [r.id for r in s.table("widgets").read().collect()] == [1]
    assert [r.lsn for r in AppendLog(spark, f"{s.root}/dead_batches").read().collect()] == [2]
    with pytest.raises(ValueError, match="identifier"):
        spec(tables=[TableSpec("t", {"id": "bigint"}, {"a b": "string"})]).resolved().check()


def test_tables_of_one_name_in_two_schemas_are_two(spark, tmp_path):
    register("test/bad-sales", lambda **_: BatchTransformer(fail_sales))

    def fail_sales(frames):
        for d in frames:
            if (d["table_schema"] == "sales").any() and (d["lsn"] == 2).any():
                raise RuntimeError("poison")
            yield d

    tables = [TableSpec("public.widgets", {"id": "bigint"}, {"name": "string"}), TableSpec("sales.widgets", {"id": "bigint"}, {"name": "string"})]
    s = Sink(spark, spec(tables=tables, processors=[Processor("test/bad-sales", ["insert"])], max_retries=0), "main", f"file://{tmp_path}")
    s.upload(events(spark, event("insert", 1, {"id": 1, "name": "p"}, batch=1), event("insert", 2, {"id": 1, "name": "s"}, batch=2, schema="sales"), event("insert", 3, {"id": 3, "name": "s3"}, batch=3, schema="sales")), 0)
    assert [r.name for r in s.table("public.widgets").read().collect()] == ["p"]
    assert [r.name for r in s.table("sales.widgets").read().collect()] == ["s3"]


# --- failures of the way -------------------------------------------------------------------------------------


def test_failures_in_workers_are_known_on_the_driver(spark, tmp_path):
    log, root = f"file://{tmp_path}/log", f"file://{tmp_path}/out"
    flag = tmp_path / "up"

    def ask(rows):
        if not flag.exists():
            raise ConnectionError("down")
        return [Answer() for _ in rows]

    register("test/remote", lambda **_: remote(ask))
    register("test/again", lambda **_: remote(lambda rows: [Answer(success=False, retryable=True) for _ in rows]))
    land(events(spark, event("insert", 1, {"id": 1, "name": "a"})), log)
    s = spec(processors=[Processor("test/remote", ["insert"])], max_retries=0, retry_base="1ms")
    q = start(spark, s, "main", log, root)
    with pytest.raises(Exception, match="tidemark-retryable"):
        q.awaitTermination()
    sink = Sink(spark, s, "main", root)
    assert AppendLog(spark, f"{sink.root}/dead_batches").read() is None and sink.acks.read() is None
    flag.write_text("x")
    run_all(spark, s, log, root)
    assert sink.table("widgets").read().count() == 1
    again = Sink(spark, spec(processors=[Processor("test/again", ["insert"])], max_retries=0), "other", root, sleep=lambda _: None)
    with pytest.raises(TransportError):
        again.upload(events(spark, event("insert", 2, {"id": 2})), 0)
    assert retryable(RemoteError("x")) and not retryable(RuntimeError("x"))


def test_an_open_breaker_fails_calls_of_the_remote_function_at_once(spark):
    calls = []

    def ask(rows):
        calls.append(1)
        raise TimeoutError

    t = remote(ask, breaker=lambda: guard)
    guard = CircuitBreaker(least=3)
    import pandas as pd

    for _ in range(5):
        with pytest.raises(TransportError):
            list(t.run(iter([pd.DataFrame({"op": ["insert"], "data": [{}]})])))
    assert len(calls) == 3


# --- transformers --------------------------------------------------------------------------------------------


def test_a_batch_transformer_is_one_pass_and_tells_what_it_drops(spark):
    def halve(frames):
        for d in frames:
            yield d[d["lsn"] % 2 == 0]

    def late(frames):  # answers only after it has seen everything
        import pandas as pd

        yield pd.concat(list(frames))

    register("test/halve", lambda **_: BatchTransformer(halve))
    register("test/late", lambda **_: BatchTransformer(late))
    e = events(spark, *[event("insert" if i % 3 else "delete", i, {"id": i}) for i in range(1, 13)])
    out, dropped = apply_chain(e, [Processor("test/halve", ["insert"]), Processor("test/late", ["insert"])])
    assert sorted(r.lsn for r in out.collect()) == sorted({3, 6, 9, 12} | {2, 4, 8, 10})
    assert sorted(r.lsn for r in dropped.collect()) == [1, 5, 7, 11]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Union") == 0 and plan.count("Scan") + plan.count("LocalTable") <= 1
    first = events(spark, event("insert", 1, {"id": 1}), event("insert", 2, {"id": 2}))
    out, dropped = apply_chain(first, [Processor("test/halve", ["insert"])])
    assert [r.lsn for r in out.collect()] == [2] and [r.lsn for r in dropped.collect()] == [1]


def test_factories_get_the_pipeline_options_they_take(spark):
    seen = {}

    def takes_all(**options):
        seen.update(options)
        return BatchTransformer(lambda frames: frames)

    def takes_one(pipeline_id):
        seen["one"] = pipeline_id
        return BatchTransformer(lambda frames: frames)

    register("test/all", takes_all)
    register("test/one", takes_one)
    apply_chain(events(spark, event("insert", 1, {"id": 1})), [Processor("test/all", ["insert"], options={"batch_size": 9}), Processor("test/one", ["insert"])], {"pipeline_id": "p1", "batch_size": 5})
    assert seen == {"pipeline_id": "p1", "batch_size": 9, "one": "p1"}


# --- sources and sinks ---------------------------------------------------------------------------------------


def test_published_batches_land_once_in_files_of_bounded_size(spark, tmp_path):
    log, root = f"file://{tmp_path}/log", f"file://{tmp_path}/out"
    p = Publisher(spark, log, batch_size=5)
    rows = events(spark, *[event("insert", i, {"id": i, "name": f"n{i}"}) for i in range(1, 13)]).withColumn("uuid", F.concat(F.lit("u"), F.col("lsn") % 11))
    assert p.publish(rows, 0) and not p.publish(rows, 0)
    landed = spark.read.parquet(log)
    assert landed.count() == 11 and landed.select(F.input_file_name().alias("f")).groupBy("f").count().agg(F.max("count")).first()[0] <= 5
    run_all(spark, spec(batch_size=5), log, root)
    s = Sink(spark, spec(), "main", root)
    assert s.table("widgets").read().count() == 11 and s.acks.read().select("batch").distinct().count() >= 3
    broken = Publisher(spark, log, breaker=CircuitBreaker(least=1))
    with pytest.raises(Exception):
        broken.publish(spark.range(1), 9)
    with pytest.raises(Open):
        broken.publish(rows, 10)


def test_kinds_of_sources_and_sinks(spark, tmp_path):
    seen = []

    class Count(SinkBase):
        def __init__(self, spark, spec, sink_id, root, **_):
            self.name, self.root = sink_id, f"{root}/{spec.id}/{sink_id}"

        def upload(self, batch, batch_id):
            seen.append(batch.count())

    register_sink("count", Count)
    with pytest.raises(ValueError):
        register_sink("count", Count)
    assert is_debug("audit") and not is_debug("tables")
    log, root = f"file://{tmp_path}/log", f"file://{tmp_path}/out"
    land(events(spark, event("insert", 1, {"id": 1}), event("insert", 2, {"id": 2}, table="other")), log)
    s = spec(sinks=["c", "a"], kinds={"c": "count", "a": "audit"})
    run_all(spark, s, log, root)
    assert seen == [2] and AppendLog(spark, f"{root}/p1/a/audit").read().count() == 4
    with pytest.raises(KeyError):
        create_sink(spark, spec(kinds={"main": "none"}), "main", root)
    source = create_source("landed", spark, log)
    assert isinstance(source, Source) and isinstance(source, LandedLog)
    source.add_tables([("public", "other")])
    source.add_tables([("public", "other")])
    assert source.tables == [("public", "other")]
    q = source.start().writeStream.format("memory").queryName("some_rows").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.lsn for r in spark.table("some_rows").collect()] == [2]
    with pytest.raises(ValueError):
        register_source("landed", LandedLog)
    with pytest.raises(KeyError):
        create_source("none")


def test_a_lost_checkpoint_resumes_after_what_all_sinks_have(spark, tmp_path):
    import shutil

    log, root = f"file://{tmp_path}/log", f"file://{tmp_path}/out"
    s = spec(sinks=["main", "copy"])
    land(events(spark, event("insert", 1, {"id": 1, "name": "a"}), event("insert", 5, {"id": 2, "name": "b"})), log)
    run_all(spark, s, log, root)
    shutil.rmtree(f"{tmp_path}/out/p1/main/checkpoint")
    for lsn in (7, 8):
        land(events(spark, event("update", lsn, {"id": 1, "name": f"a{lsn}"}, batch=lsn)), log)
        run_all(spark, s, log, root)
        for sink in s.sinks:
            assert {r.id: r.name for r in Sink(spark, s, sink, root).table("widgets").read().collect()} == {1: f"a{lsn}", 2: "b"}
    acks = spark.createDataFrame([(1, "m"), (2, "m"), (1, "c"), (3, "m"), (3, "c")], "lsn long, sink_id string").withColumn("op", F.lit("insert"))
    log_rows = spark.createDataFrame([(1,), (2,), (3,)], "lsn long").withColumn("op", F.lit("insert"))
    assert resume_position(log_rows, acks, ["m", "c"]) == 1


def test_payloads_are_decoded_on_their_way_into_the_tables(spark, tmp_path):
    e = events(spark, event("insert", 1, {"id": 1, "name": "a"}), event("insert", 2, {}), event("insert", 3, {}))
    packed = {2: b"\x82\xa2id\x02\xa4name\xa1b", 3: b"\xc1\xff"}
    rows = [r.asDict() | {"payload": packed.get(r.lsn), "data": None if r.lsn in packed else r["data"]} for r in e.collect()]
    df = spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in e.schema) + ", payload binary")
    s = Sink(spark, spec(), "main", f"file://{tmp_path}")
    s.upload(df, 0)
    assert sorted((r.id, r.name) for r in s.table("widgets").read().collect()) == [(1, "a"), (2, "b")]
    assert [(r.lsn, r.reason) for r in s.dead.read().collect()] == [(3, "deserialization_failed")]


def test_audit_rows_tell_of_pipeline_transformers_and_time(spark, tmp_path):
    s = Sink(spark, spec(processors=[Processor("uppercase", ["insert"], options={"column": "name"})]), "main", f"file://{tmp_path}", capture=CaptureFilter())
    s.upload(events(spark, event("insert", 1, {"id": 1, "name": "a"}), event("schema_change", 2, {"age": "int4"})), 0)
    rows = AppendLog(spark, f"{s.root}/audit").read().collect()
    assert {r.capture_stage for r in rows} == {"before", "after"}
    assert all(r.pipeline_id == "p1" and r.sink_id == "main" and r.transformer_names == ["uppercase"] and r.captured_at and r.processing_latency_ms >= 0 for r in rows)
    changes = AppendLog(spark, f"{s.root}/audit_schema").read().collect()
    assert [(r.lsn if "lsn" in r else r.op, r.payload) for r in changes] == [("schema_change", '{"age":"int4"}')]
    assert s.hooks[0].retain(datetime(2100, 1, 1), hours=1) == {"messages": [0], "changes": [0]}


def test_hooks_see_batches_before_and_after(spark, tmp_path):
    seen = []

    class Watch(Hook):
        def before(self, batch, batch_id):
            return batch.count()

        def after(self, passed, first, batch_id):
            seen.append((batch_id, first, passed.count()))

    s = Sink(spark, spec(), "main", f"file://{tmp_path}", hooks=[Watch()])
    s.upload(events(spark, event("insert", 1, {"id": 1})), 4)
    assert seen == [(4, 1, 1)]


# --- running -------------------------------------------------------------------------------------------------


def test_a_runner_follows_revisions(spark, tmp_path):
    log, root = f"file://{tmp_path}/log", f"file://{tmp_path}/out"
    joined = spark.createDataFrame([(1, "old"), (2, "two")], "id long, note string")
    runner = Runner(spark, log, root, sources=lambda t: joined, sleep=lambda _: None)
    land(events(spark, event("insert", 1, {"id": 1, "name": "a"}), event("insert", 2, {"id": 1, "note": "seen"}, table="notes")), log)
    one = spec()
    assert runner.reload(one, 1) == "start"
    runner.wait("p1")
    assert runner.trackers["p1"].mark == 0 and runner.position(one) == 2
    assert runner.reload(one, 2) == "skip" and runner.reload(one, 1) == "ignore"
    more = spec(tables=[*one.tables, TableSpec("notes", {"id": "bigint"}, {"note": "string"})])
    assert runner.reload(more, 3) == "add_tables"
    land(events(spark, event("update", 3, {"id": 2, "note": "new"}, batch=1, table="notes")), log)
    runner.wait("p1")
    assert runner.reload(spec(tables=more.tables, max_retries=1), 4) == "restart"
    runner.wait("p1")
    assert runner.trackers["p1"].mark >= 2
    s = Sink(spark, more, "main", root)
    assert {r.id: r.note for r in s.table("notes").read().collect()} == {1: "old", 2: "new"}
    assert s.checkpoints.get("snapshot-public.notes")[0]["state"] == "cdc"
    assert not add_table(s, joined, more.tables[1], 5)
    assert runner.idle("p1", 50) in (True, False)


def test_a_failed_snapshot_can_be_taken_again(spark, tmp_path):
    s = Sink(spark, spec(), "main", f"file://{tmp_path}")
    t = TableSpec("notes", {"id": "bigint"}, {"note": "string"})
    with pytest.raises(Exception):
        add_table(s, spark.range(1).selectExpr("id", "raise_error('lost') AS note"), t, 3)
    assert s.checkpoints.get("snapshot-public.notes")[0]["state"] == "failed"
    assert add_table(s, spark.createDataFrame([(1, "n")], "id long, note string"), t, 3)
    assert s.table("notes").read().count() == 1 and s.table("notes").state()["batch_id"] == 2
