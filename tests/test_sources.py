import struct

import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_apply import event, events
from test_engine import spec

from tidemark.functions.registry import run_batch
from tidemark.functions.remote import Answer, RemoteError, remote, requests
from tidemark.operators.filters import CaptureFilter
from tidemark.plans.spec import TableSpec
from tidemark.sources import catalog
from tidemark.sources.envelope import discover
from tidemark.sources.payload import decode_payloads, unpack
from tidemark.streaming.pipeline import Sink, add_table


def pack(v):
    """A small MessagePack writer for the tests."""
    if v is None or isinstance(v, bool):
        return {None: b"\xc0", False: b"\xc2", True: b"\xc3"}[v]
    if isinstance(v, int):
        return struct.pack("b", v) if -32 <= v < 128 else b"\xd3" + struct.pack(">q", v)
    if isinstance(v, float):
        return b"\xcb" + struct.pack(">d", v)
    if isinstance(v, str):
        b = v.encode()
        return (bytes([0xA0 + len(b)]) if len(b) < 32 else b"\xda" + struct.pack(">H", len(b))) + b
    if isinstance(v, bytes):
        return b"\xc4" + bytes([len(v)]) + v
    if isinstance(v, list):
        return b"\xdc" + struct.pack(">H", len(v)) + b"".join(map(pack, v))
    return bytes([0x80 + len(v)]) + b"".join(pack(k) + pack(x) for k, x in v.items())


def test_message_pack_round_trip():
    value = {"id": 2**53 + 1, "n": -7, "big": -(2**40), "f": 1.5, "s": "é" * 40, "none": None, "t": True, "raw": b"\x00\xff", "list": [1, "two", [3]]}
    assert unpack(pack(value)) == value
    for bad in (b"", b"\xc1", b"\xa5ab", pack(1) + b"x", b"\x81\xa1a"):
        with pytest.raises(ValueError):
            unpack(bad)


def test_payloads_fall_back_and_are_rejected(spark):
    rows = [(1, {"a": "own"}, None), (2, None, bytearray(pack({"a": "mp", "n": 5, "x": None}))), (3, None, bytearray(b'{"a": "js"}')), (4, None, bytearray(b"\xc1garbage")), (5, None, None)]
    good, dead = decode_payloads(spark.createDataFrame(rows, "lsn long, data map<string,string>, payload binary"))
    assert {r.lsn: r.data for r in good.collect()} == {1: {"a": "own"}, 2: {"a": "mp", "n": "5", "x": None}, 3: {"a": "js"}}
    assert sorted((r.lsn, r.reason) for r in dead.collect()) == [(4, "deserialization_failed"), (5, "deserialization_failed")]


def test_requests_fit_their_budget():
    assert requests([4, 4, 4, 20, 1, 1], 10) == [(0, 2), (2, 3), (3, 4), (4, 6)] and requests([], 10) == []


def test_remote_answers(spark):
    e = events(spark, event("insert", 1, {"id": 1}), event("insert", 2, {"id": 2}), event("insert", 3, {"id": 3}), event("insert", 4, {"id": 4}))

    def ask(rows):
        return [Answer(data={"id": "ten"}) if r["lsn"] == 1 else Answer(keep=False) if r["lsn"] == 2 else Answer(success=False) if r["lsn"] == 3 else Answer() for r in rows]

    assert sorted((r.lsn, r.data["id"]) for r in run_batch(e, remote(ask)).collect()) == [(1, "ten"), (4, "4")]
    frame = pd.DataFrame([{"op": "insert", "data": {"a": 1}}, {"op": "schema_change", "data": {}}])
    for bad in (lambda rows: [], lambda rows: [Answer(success=False, retryable=True)] * len(rows), lambda rows: [Answer(success=r["op"] != "schema_change") for r in rows]):
        with pytest.raises(RemoteError):
            list(remote(bad).run(iter([frame])))


def test_catalog(spark, tmp_path):
    e = spark.createDataFrame([(7, None, ""), (8, "s", "t")], "oid long, table_schema string, table_name string")
    rel = spark.createDataFrame([(7, "x", "named")], "oid long, table_schema string, table_name string")
    assert {(r.table_schema, r.table_name) for r in catalog.resolve_relations(e, rel).collect()} == {("x", "named"), ("s", "t")}
    assert catalog.provision(spark, ["tide_a", "tide_b"]) == ["tide_a", "tide_b"] and catalog.provision(spark, ["tide_a"]) == []
    with pytest.raises(ValueError, match="tide_z"):
        catalog.provision(spark, ["tide_z", "tide_a"], create=False)
    spark.range(3).write.saveAsTable("tide_a.users")
    spark.range(3).write.saveAsTable("tide_a.cdc_snapshot_users")
    assert [(r.table_schema, r.table_name) for r in discover(spark, ["tide_a", "nowhere"]).collect()] == [("tide_a", "users")]
    assert "tide_a" in catalog.schemas(spark)
    reg = catalog.Registry(spark, f"file://{tmp_path}/registry")
    rows = spark.createDataFrame([("public", "t", 1, {"id": "int8"}, ["id"])], "table_schema string, table_name string, version bigint, columns map<string,string>, pk_columns array<string>")
    reg.prime(rows)
    reg.prime(rows)
    reg.add(spark.createDataFrame([("public", "t", {"b": "text"})], "table_schema string, table_name string, added map<string,string>"))
    got = reg.read().collect()
    assert len(got) == 1 and got[0].version == 2 and got[0].columns == {"id": "int8", "b": "text"}
    assert {r.table_name for r in catalog.listed_tables(reg.read(), discover(spark, ["tide_a"])).collect()} == {"t", "users"}
    moved = catalog.renamed(reg.read(), {"id": "key"}).first()
    assert moved.columns == {"key": "int8", "b": "text"} and moved.pk_columns == ["key"]
    change = spark.createDataFrame([(None, {"a": "unknown"}), ({"b": "text"}, {"a": "unknown"})], "columns map<string,string>, added map<string,string>")
    assert [r.columns for r in catalog.schema_of_change(change).collect()] == [{"a": "unknown"}, {"b": "text"}]


def test_secrets(spark):
    df = spark.createDataFrame([("postgres://u:pw@h/db",), ("host=h password=pw x=1",)], "d string")
    assert [r.m for r in df.select(catalog.masked_dsn(F.col("d")).alias("m")).collect()] == ["postgres://u:***@h/db", "host=h password=*** x=1"]
    assert all(r.ok for r in df.select((catalog.unmasked_dsn(catalog.masked_dsn(F.col("d")), F.col("d")) == F.col("d")).alias("ok")).collect())
    key = b"0123456789abcdef"
    assert all(r.ok for r in df.select((catalog.opened(catalog.sealed(F.col("d"), key), key) == F.col("d")).alias("ok")).collect())


def test_new_tables_and_audit(spark, tmp_path):
    s = Sink(spark, spec(), "main", f"file://{tmp_path}", capture=CaptureFilter())
    add_table(s, spark.createDataFrame([(1, "old"), (2, "kept")], "id long, name string"), TableSpec("widgets", {"id": "bigint"}, {"name": "string"}), 5)
    s.upload(events(spark, event("update", 9, {"id": 1, "name": "new"}), event("schema_change", 10, {})), 5)
    assert sorted((r["id"], r.name) for r in s.table("widgets").read().collect()) == [(1, "new"), (2, "kept")]
    rows = spark.read.parquet(f"file://{tmp_path}/p1/main/audit").collect()
    assert sorted((r.capture_stage, r.lsn, r.filtered) for r in rows) == [("after", 9, False), ("before", 9, False)]
