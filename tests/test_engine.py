from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_apply import DAY, event, events

from tidemark.functions.registry import BatchTransformer, Processor, Transformer, apply_chain, create, register, rejoin, run_batch
from tidemark.operators import audit, chunking, filters, schema, stats
from tidemark.plans.resilience import CircuitBreaker, Open, supervise
from tidemark.plans.spec import EVOLUTION_STATES, SNAPSHOT_STATES, PipelineSpec, TableSpec, moved, new_tables, reload_action
from tidemark.sources.envelope import chunks, keyset_page, snapshot
from tidemark.streaming.pipeline import Sink, TransportError, barrier_segments, run_all
from tidemark.streaming.tables import ControlTable, VersionedTable


def feed(spark):
    return events(spark, event("insert", 1, {"id": 1, "name": "ann", "n": 5}), event("update", 2, {"id": 1, "name": None}), event("delete", 3, {"id": 1}), event("insert", 4, {"id": 2}, schema="sales"))


def test_processors_see_only_their_operations(spark):
    out, _ = apply_chain(feed(spark), [Processor("mask", ["insert"], options={"column": "name", "salt": "s"}), Processor("uppercase", [], options={"column": "name"})])
    got = {r.lsn: r.data for r in out.collect()}
    assert len(got[1]["name"]) == 64 and got[1]["n"] == "5" and got[2] == {"id": "1", "name": None} and got[3] == {"id": "1"} and got[4] == {"id": "2"}


def test_schemas_or_tables(spark):
    rows = feed(spark)
    assert rows.filter(filters.matches(["sales"])).count() == 1
    assert rows.filter(filters.matches(None, ["widgets"])).count() == 4
    assert rows.filter(filters.matches(["sales"], ["nothing"])).count() == 1
    assert rows.filter(filters.matches()).count() == 4


def test_dropping_and_batch_transformers(spark):
    register("only_first", lambda **_: Transformer(keep=lambda: F.col("lsn") == 1))
    register("test/double", lambda **_: BatchTransformer(lambda frames: (d[d["lsn"] != 4] for d in frames)))
    out, gone = apply_chain(feed(spark), [Processor("only_first", ["insert"])])
    assert sorted(r.lsn for r in out.collect()) == [1, 2, 3] and [r.lsn for r in gone.collect()] == [4]
    out, _ = apply_chain(feed(spark), [Processor("test/double", ["insert"])])
    assert sorted(r.lsn for r in out.collect()) == [1, 2, 3]
    marked = {r.lsn: r.filtered for r in rejoin(feed(spark), out, ["lsn", "seq"]).collect()}
    assert marked == {1: False, 2: False, 3: False, 4: True}
    with pytest.raises(ValueError):
        register("mask", lambda **_: None)
    with pytest.raises(KeyError):
        create("nothing")


def test_batch_errors_fail_closed_and_close(spark, tmp_path):
    def bad(frames):
        for _ in frames:
            raise RuntimeError("remote failed")
            yield

    with pytest.raises(Exception, match="remote failed"):
        run_batch(feed(spark).select("lsn"), BatchTransformer(bad)).collect()


def test_sampling(spark):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("uuid"), F.lit("t").alias("table_name"), "id", F.lit(1).alias("g"))
    n = rows.filter(filters.sample_share(25, F.col("uuid"))).count()
    assert 400 < n < 600
    assert rows.filter(filters.sample_share(0, F.col("uuid"))).count() == 0 and rows.filter(filters.sample_share(100, F.col("uuid"))).count() == 2000
    assert rows.filter(filters.sample_share(0, F.col("uuid"), {"t": 100})).count() == 2000
    assert [r.id for r in filters.every_nth(rows.filter("id < 10"), 3, ["id"], ["g"]).orderBy("id").collect()] == [2, 5, 8]


def test_conditions(spark):
    rows = feed(spark)
    find = lambda *c: sorted(r.lsn for r in rows.filter(filters.CaptureFilter(conditions=list(c)).column()).collect())
    assert find(filters.Condition("name", "eq", "ann")) == [1] and find(filters.Condition("name", "ne", "ann")) == [2, 3, 4]
    assert find(filters.Condition("id", "in", [2, 3])) == [4] and find(filters.Condition("name", "contains", "n")) == [1]
    with pytest.raises(ValueError):
        filters.Condition("x", "near", 1).column()


def test_pages(spark):
    rows = spark.range(250).select("id")
    assert [r.id for r in filters.page(rows, ["id"], 2, 1000).collect()][:2] == [100, 101]
    assert [r.id for r in filters.page(rows, ["id"], 0, 0).collect()] == [0]
    both = spark.createDataFrame([(a, b, str(a) + b) for a in range(5) for b in "abc"], "a int, b string, v string")
    got, last = [], None
    while page := keyset_page(both, ["a", "b"], last, 4).collect():
        got += [r.v for r in page]
        last = [page[-1].a, page[-1].b]
    assert got == sorted(r.v for r in both.collect())
    assert {r.v: r.chunk_id for r in chunks(both, ["a", "b"], 4).collect()} == {v: i // 4 for i, v in enumerate(got)}
    with pytest.raises(ValueError):
        keyset_page(both, [], None, 4)
    s = snapshot(both, "public", "t", ["a", "b"]).collect()
    assert {r.op for r in s} == {"snapshot"} and {r.lsn for r in s} == {0} and len({r.uuid for r in s}) == 15


def test_stats(spark):
    e = events(spark, event("insert", 8, {"id": 1}), event("insert", 9, {"id": 1}, ts=DAY + timedelta(seconds=2)), event("snapshot", 0, {"id": 2}))
    got = stats.table_stats(e, ["table_name"], F.lit(DAY + timedelta(seconds=5)).cast("timestamp_ntz")).first()
    assert (got.total_synced, got.lag_ms) == (3, 3000)
    twice = stats.merge_stats(stats.table_stats(e, ["table_name"], F.lit(DAY).cast("timestamp_ntz")), stats.table_stats(e, ["table_name"], F.lit(DAY).cast("timestamp_ntz")), ["table_name"]).first()
    assert twice.total_synced == 6
    assert stats.latest_checkpoints(e, ["table_name"]).first().checkpoint_lsn == 9
    points = spark.createDataFrame([("a", 10), ("a", 30), ("b", 0), ("b", 20)], "sink_id string, checkpoint_lsn long")
    assert stats.resume_floor(points).first().resume_lsn == 10 and stats.sink_frontier(points, ["a", "b"]).first().frontier_lsn == 20
    assert stats.sink_frontier(points, ["a", "b", "c"]).first().frontier_lsn is None
    empty = stats.dashboard(spark.createDataFrame([], "total_synced long, lag_ms long"), spark.createDataFrame([("Running",)], "status string")).first()
    assert (empty.total_synced, empty.avg_lag_ms, empty.running_pipelines) == (0, 0, 1)


def registry(spark, **columns):
    return spark.createDataFrame([("public", "widgets", 1, columns, ["id"])], schema.REGISTRY)


def test_schema_evolution(spark):
    e = events(spark, event("insert", 1, {"id": 1, "name": "x"}), event("insert", 5, {"id": 1, "extra": "y"}), event("insert", 7, {"id": 1, "extra": "y"}), event("insert", 2, {"id": 1}, table="fresh"), event("insert", 3, {"id": 1, "more": 1}, table="fresh"))
    reg = registry(spark, id="int8", name="text")
    found = schema.drift(e, reg)
    assert sorted((r.table_name, r.column, r.first_lsn) for r in found.collect()) == [("fresh", "more", 3), ("widgets", "extra", 5)]
    new = {r.table_name: r for r in schema.evolve(reg, schema.diffs(found)).collect()}
    assert new["widgets"].version == 2 and new["widgets"].columns == {"id": "int8", "name": "text", "extra": "unknown"} and new["fresh"].pk_columns == ["id"]
    same = schema.evolve(schema.evolve(reg, schema.diffs(found)), schema.diffs(found)).filter("table_name = 'widgets'").first()
    assert same.version == 2
    assert schema.table_ddl(reg).first().columns == "id INT64, name STRING, deleted_at TIMESTAMP"
    assert [r.column for r in schema.type_changes(registry(spark, id="text"), reg).collect()] == ["id"]


def test_key_resolution(spark):
    t = spark.createDataFrame([("public", "a"), ("public", "b"), ("public", "c"), ("custom", "d")], "table_schema string, table_name string")
    reg = spark.createDataFrame([("public", "a", 1, {"x": "int"}, ["x", "y"])], schema.REGISTRY)
    ddl = spark.createDataFrame([("public", "b", "create table b (k int, primary key (k))")], "table_schema string, table_name string, ddl string")
    got = {r.table_name: r.pk_columns for r in schema.resolve_keys(t, reg, ddl, ["custom"]).collect()}
    assert got == {"a": ["x", "y"], "b": ["k"], "c": ["id"], "d": None}


def test_change_rate(spark):
    times = [0, 10, 20, 30, 40, 50, 61, 125]
    df = spark.createDataFrame([("public", "t", i, DAY + timedelta(seconds=s)) for i, s in enumerate(times)], "table_schema string, table_name string, lsn long, ts timestamp_ntz")
    got = [(r.in_window, r.suspended) for r in schema.change_rate(df).orderBy("lsn").collect()]
    assert got == [(1, False), (2, False), (3, False), (4, False), (5, False), (6, True), (1, False), (1 if 125 - 61 > 60 else 2, False)]
    acks = spark.createDataFrame([("c1", "a"), ("c1", "b"), ("c1", "a"), ("c2", "a")], "correlation_id string, sink_id string")
    assert [r.correlation_id for r in schema.acknowledged(acks, 2).collect()] == ["c1"]


def test_audit(spark):
    e = feed(spark)
    captured = audit.before(e, filters.CaptureFilter(include_tables=["w*"]))
    out, _ = apply_chain(e.filter("lsn <> 4"), [Processor("mask", ["insert"], options={"column": "name", "salt": "s"})])
    passed = audit.after(out, captured)
    marked = {r.lsn: r.filtered for r in audit.mark_filtered(captured, passed).collect()}
    assert marked == {1: False, 2: False, 3: False, 4: True}
    assert [r.correlation_id for r in audit.changed_pairs(captured, passed).collect()] == ["public-widgets-1-0"]
    assert audit.before(e, filters.CaptureFilter(stages=["after"])).count() == 0
    rows = spark.createDataFrame([(i, DAY + timedelta(hours=i // 2)) for i in range(10)], "id long, captured_at timestamp_ntz")
    assert sorted(r.id for r in audit.expired(rows, 4, "captured_at", "id").collect()) == [0, 1, 2, 3, 4, 5]
    assert audit.by_age(rows, F.lit(DAY + timedelta(hours=4)).cast("timestamp_ntz"), 2).count() == 6


def test_chunks(spark):
    rows = spark.createDataFrame([("g", i, s) for i, s in enumerate([40, 40, 40, 200, 10, 10])], "g string, i int, size int")
    got = [r.request for r in chunking.byte_chunks(rows, ["g"], ["i"], "size", 100).orderBy("i").collect()]
    assert got == [0, 0, 1, 2, 3, 3]
    assert [r.statement for r in chunking.statements(rows, ["g"], ["i"], F.lit(5), 10).orderBy("i").collect()] == [0, 0, 1, 1, 2, 2]
    assert [r.n for r in spark.createDataFrame([(3,), (20_000,)], "c int").select(chunking.rows_per_statement(F.col("c")).alias("n")).collect()] == [3333, 1]


def test_barriers(spark):
    e = events(spark, event("insert", 1, {"id": 1}), event("schema_change", 5, {}), event("insert", 6, {"id": 1}), event("insert", 7, {"id": 1}, table="other"))
    assert {r.lsn: r.segment for r in barrier_segments(e).collect()} == {1: 0, 5: 1, 6: 1, 7: 0}


# --- streaming -----------------------------------------------------------------------------------------------


def spec(**more):
    return PipelineSpec("p1", "pg", ["main", "copy"], [TableSpec("widgets", {"id": "bigint"}, {"name": "string"})], **more)


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_streams_drain_the_log_into_each_sink_once(spark, tmp_path):
    root, log = f"file://{tmp_path}/out", f"file://{tmp_path}/log"
    land(events(spark, event("insert", 1, {"id": 1, "name": "a"}), event("insert", 2, {"other": "x"})), log)
    run_all(spark, spec(), log, root)
    land(events(spark, event("update", 3, {"id": 1, "name": "b"}, batch=1), event("delete", 4, {"id": 1}, batch=1)), log)
    run_all(spark, spec(), log, root)
    run_all(spark, spec(), log, root)
    for sink in ("main", "copy"):
        s = Sink(spark, spec(), sink, root)
        assert [(r["id"], r.name, r.deleted_at) for r in s.table("widgets").read().collect()] == [(1, "b", DAY)]
        assert [r.lsn for r in s.dead.read().collect()] == [2]
        assert sorted(r.lsn for r in s.acks.read().collect()) == [1, 2, 3, 4]
        assert s.checkpoints.get("egress")[0]["lsn"] == 4


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    s = Sink(spark, spec(), "main", f"file://{tmp_path}")
    batch = events(spark, event("insert", 1, {"id": 1, "name": "a"}))
    s.upload(batch, 0)
    s.upload(batch, 0)
    assert s.table("widgets").read().count() == 1 and s.acks.read().count() == 1


def test_poison_batches_are_isolated(spark, tmp_path):
    register("test/poison", lambda **_: BatchTransformer(poison))

    def poison(frames):
        for d in frames:
            if (d["lsn"] == 2).any():
                raise RuntimeError("poison")
            yield d

    s = Sink(spark, spec(processors=[Processor("test/poison", ["insert"])], max_retries=0), "main", f"file://{tmp_path}")
    s.upload(events(spark, event("insert", 1, {"id": 1, "name": "good1"}, batch=1), event("insert", 2, {"id": 2, "name": "poison"}, batch=2), event("insert", 3, {"id": 3, "name": "good2"}, batch=3)), 0)
    assert sorted(r.name for r in s.table("widgets").read().collect()) == ["good1", "good2"]
    assert [r.lsn for r in spark.read.parquet(f"file://{tmp_path}/p1/main/dead_batches").collect()] == [2]
    assert sorted(r.lsn for r in s.acks.read().collect()) == [1, 2, 3]
    strict = Sink(spark, spec(processors=[Processor("test/poison", ["insert"])], max_retries=0, enable_dlq=False), "copy", f"file://{tmp_path}")
    with pytest.raises(Exception, match="poison"):
        strict.upload(events(spark, event("insert", 2, {"id": 2})), 0)


def test_retries_wait_longer_and_transport_errors_do_not_count(spark, tmp_path):
    waits, calls = [], []
    s = Sink(spark, spec(max_retries=3), "main", f"file://{tmp_path}", sleep=waits.append)

    def flaky():
        calls.append(1)
        if len(calls) < 4:
            raise RuntimeError("again")

    s._retry(flaky)
    assert waits == [1, 2, 4]

    def broken():
        raise TransportError("down")

    with pytest.raises(TransportError):
        s._retry(broken)


def test_versions_and_control(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    assert t.read() is None
    assert t.replace(spark.range(3).toDF("x"), 0) and not t.replace(spark.range(9).toDF("x"), 0)
    for i in range(1, 5):
        assert t.replace(t.read().unionByName(spark.range(1).toDF("x")), i)
    assert t.read().count() == 7 and len(t.state()["history"]) == 2
    c = ControlTable(spark, f"file://{tmp_path}/c")
    assert c.get("k") == (None, 0) and c.put("k", {"a": 1}, 0) == 1
    with pytest.raises(RuntimeError):
        c.put("k", {"a": 2}, 0)
    assert c.update("k", lambda v: {"a": v["a"] + 1}) == 2 and c.get("k")[0] == {"a": 2}


# --- plans ---------------------------------------------------------------------------------------------------


def test_specs():
    assert spec().resolved().batch_size == 1000 and spec().resolved({"batch_size": 50}).batch_size == 50 and spec(batch_size=7).resolved({"batch_size": 50}).batch_size == 7
    spec().check()
    bad = PipelineSpec("a.b", "", [], [TableSpec("x.y.z", {}, {})], processors=[Processor("mask", []), Processor("mask", ["record_ack"])], batch_wait="5")
    with pytest.raises(ValueError) as e:
        bad.check()
    for part in ("id must", "source", "sinks", "operations must", "record_ack", "x.y.z", "keys", "batch_wait"):
        assert part in str(e.value)


def test_reloads():
    old = spec()
    more = spec()
    more.tables = [*old.tables, TableSpec("b", {"id": "bigint"}, {})]
    assert reload_action(None, old) == "start" and reload_action(old, spec(), 1, 2) == "skip" and reload_action(old, more, 1, 2) == "add_tables"
    assert reload_action(old, spec(batch_size=9), 1, 2) == "restart" and reload_action(old, more, 2, 2) == "ignore" and reload_action(more, old, 1, 2) == "restart"
    assert [t.name for t in new_tables(old, more)] == ["b"]
    assert moved(SNAPSHOT_STATES, None, "snapshotting") == "snapshotting" and moved(EVOLUTION_STATES, "frozen", "draining") == "draining"
    with pytest.raises(ValueError):
        moved(EVOLUTION_STATES, "stable", "draining")


def test_breaker_and_supervisor():
    now = [0.0]
    b = CircuitBreaker(clock=lambda: now[0])

    def fail():
        raise OSError

    for _ in range(3):
        with pytest.raises(OSError):
            b.call(fail)
    with pytest.raises(Open):
        b.call(lambda: 1)
    now[0] = 11
    assert b.call(lambda: 1) == 1 and b.state == "closed"
    waits, runs = [], []

    def run():
        runs.append(1)
        now[0] += 20 if len(runs) == 4 else 1
        if len(runs) < 6:
            raise RuntimeError

    assert supervise(run, lambda: False, sleep=waits.append, clock=lambda: now[0], draw=lambda: 0.5) == 5
    assert waits == [1, 2, 4, 1, 2]




def test_requests_of_large_groups_are_the_same_however_they_are_dealt(spark):
    """Against a plain pass over each group: zero sizes, sizes over the budget, one hot group, null groups."""
    import random

    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), i, rng.choice([0, 0, 5, 17, 30, 60, 96, 300])) for i in range(4000)]
    want, state = {}, {}
    for g, i, size in rows:
        n, used = state.get(g, (0, 0))
        if used and used + size > 95:
            n, used = n + 1, 0
        state[g] = (n, used + size)
        want[i] = n
    df = spark.createDataFrame(rows, "g string, i int, size int")
    got = {r.i: r.request for r in chunking.byte_chunks(df, ["g"], ["i"], "size", 100).collect()}
    assert got == want
    assert chunking.byte_chunks(df.limit(0), ["g"], ["i"], "size", 100).count() == 0
