import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import apply
from tidemark.sources.envelope import ENVELOPE, UNCHANGED, decode, known_tables, unknown_tables

KEYS, COLUMNS = {"id": "bigint"}, {"name": "string", "bio": "string"}
DAY = datetime(2026, 4, 1)


def event(op, lsn, data, unchanged=(), batch=0, ts=DAY, schema="public", seq=0, table="widgets"):
    return ("pg", None, schema, table, op, lsn, seq, None, f"{lsn}-{seq}", {k: None if v is None else str(v) for k, v in data.items()}, {c: UNCHANGED for c in unchanged}, ts, batch, None)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), ENVELOPE)


def state(df):
    return {r["id"]: (r["name"], r["bio"], r["deleted_at"]) for r in df.collect()}


def test_unchanged_columns_keep_their_value(spark):
    e = events(spark, event("insert", 1, {"id": 1, "name": "alice", "bio": "long"}), event("update", 2, {"id": 1, "name": "renamed"}, ["bio"], batch=1))
    assert state(apply.fold(e, KEYS, COLUMNS)) == {1: ("renamed", "long", None)}


def test_a_sent_null_is_written(spark):
    e = events(spark, event("insert", 1, {"id": 1, "name": "a", "bio": "long"}), event("update", 2, {"id": 1, "name": "a", "bio": None}), event("update", 3, {"id": 1, "name": "b"}, ["bio"]))
    assert state(apply.fold(e, KEYS, COLUMNS)) == {1: ("b", None, None)}


def test_earlier_value_of_the_batch_wins_over_the_target(spark):
    base = apply.fold(events(spark, event("insert", 1, {"id": 1, "name": "a", "bio": "stale"})), KEYS, COLUMNS)
    late = events(spark, event("update", 2, {"id": 1, "name": "b", "bio": "FRESH"}, batch=1), event("update", 3, {"id": 1, "name": "c"}, ["bio"], batch=1))
    assert state(apply.fold(late, KEYS, COLUMNS, base=base)) == {1: ("c", "FRESH", None)}


def test_unchanged_without_a_row_and_unlisted_columns_are_null(spark):
    e = events(spark, event("update", 1, {"id": 999, "name": "x"}, ["bio"]), event("insert", 2, {"id": 5, "name": "y", "bio": "z"}), event("update", 3, {"id": 5, "bio": "z2"}))
    assert state(apply.fold(e, KEYS, COLUMNS)) == {999: ("x", None, None), 5: (None, "z2", None)}


def test_tombstones_stay_and_deletes_win_in_their_batch(spark):
    later = DAY + timedelta(days=90)
    e = events(
        spark, event("insert", 1, {"id": 7, "name": "a"}), event("delete", 2, {"id": 7}, batch=1), event("update", 3, {"id": 7, "name": "content"}, batch=2), event("insert", 4, {"id": 8, "name": "new"}, batch=2),
        event("delete", 5, {"id": 99}, batch=3, ts=later), event("insert", 6, {"id": 99, "name": "again"}, batch=3), event("delete", 7, {"id": 12345}, batch=3),
    )
    assert state(apply.fold(e, KEYS, COLUMNS)) == {7: ("content", None, DAY), 8: ("new", None, None), 99: ("again", None, later)}


def test_deletes_before_the_row_exists_change_nothing(spark):
    e = events(spark, event("delete", 1, {"id": 1}), event("insert", 2, {"id": 1, "name": "a"}, batch=1))
    assert state(apply.fold(e, KEYS, COLUMNS)) == {1: ("a", None, None)}


def test_an_own_deleted_at_is_written_as_it_is(spark):
    e = events(spark, event("insert", 1, {"id": 1, "name": "a"}), event("delete", 2, {"id": 1}, batch=1), event("update", 3, {"id": 1, "name": "b", "deleted_at": None}, batch=2))
    assert state(apply.fold(e, KEYS, COLUMNS)) == {1: ("b", None, None)}


def test_missing_keys_are_rejected(spark):
    e = events(spark, event("delete", 1, {"other": 1}), event("delete", 2, {"id": 2}), event("insert", 3, {"id": None, "name": "x"}), event("schema_change", 4, {}))
    assert sorted(r.lsn for r in apply.rejected(e, ["id"]).collect()) == [1, 3]
    assert state(apply.fold(e, KEYS, COLUMNS)) == {}


def test_schemas_never_mix(spark):
    e = events(spark, event("insert", 1, {"id": 1, "name": "p"}), event("insert", 2, {"id": 1, "name": "s"}, schema="sales"), event("delete", 3, {"id": 1}, schema="sales", batch=1))
    got = {(r.table_schema, r["id"]): (r.name, r.deleted_at) for r in apply.fold(e, KEYS, COLUMNS, by=["table_schema", "table_name"]).collect()}
    assert got == {("public", 1): ("p", None), ("sales", 1): ("s", DAY)}


def model(rows):
    """What a loop over batches and dictionaries does."""
    table = {}
    for batch in sorted({r[12] for r in rows}):
        mine = sorted((r for r in rows if r[12] == batch), key=lambda r: (r[5], r[6]))
        for r in mine:
            if r[4] in ("insert", "update", "snapshot"):
                old = table.get(r[9]["id"], {})
                row = {c: old.get(c) if r[10].get(c) and c not in r[9] else r[9].get(c) for c in COLUMNS}
                row["deleted_at"] = old.get("deleted_at")
                table[r[9]["id"]] = row
        last = {}
        for r in mine:
            if r[4] == "delete":
                last[r[9]["id"]] = max(r[11], last.get(r[9]["id"], r[11]))
        for k, ts in last.items():
            if k in table:
                table[k]["deleted_at"] = ts
    return {int(k): (v["name"], v["bio"], v["deleted_at"]) for k, v in table.items()}


@pytest.mark.parametrize("seed", range(4))
def test_random_logs_against_the_model_in_one_and_in_many_batches(spark, seed):
    rng = random.Random(seed)
    rows = []
    for lsn in range(1, 160):
        k, op = rng.randint(1, 12), rng.choice(["insert", "update", "update", "update", "delete"])
        ts = DAY + timedelta(hours=rng.randint(0, 500))
        if op == "delete":
            rows.append(event(op, lsn, {"id": k}, batch=lsn // 20, ts=ts))
            continue
        data, skip = {"id": k}, []
        for c in COLUMNS:
            x = rng.random()
            if x < 0.6:
                data[c] = rng.choice(["v" + str(lsn), None])
            elif x < 0.85 and op == "update":
                skip.append(c)
        rows.append(event(op, lsn, data, skip, batch=lsn // 20, ts=ts))
    want = model(rows)
    df = events(spark, *rows)
    assert state(apply.fold(df, KEYS, COLUMNS)) == want
    table = None
    for batch in (range(3), range(3, 5), range(3, 5), range(5, 9)):  # the second part is applied twice
        table = spark.createDataFrame(apply.fold(df.filter(F.col("batch_id").isin(list(batch))), KEYS, COLUMNS, base=table).collect(), "id bigint, name string, bio string, deleted_at timestamp_ntz, _first bigint")
    assert state(table) == want


def test_latest_forward_fill_and_read_back(spark):
    e = events(spark, event("insert", 1, {"id": 1, "name": "a", "bio": "x"}), event("update", 2, {"id": 1, "name": "b"}, ["bio"]), event("update", 3, {"id": 1, "name": "c", "bio": None}), event("update", 4, {"id": 1, "name": "d"}, ["bio"]))
    assert [(r["id"], r.lsn) for r in apply.latest(e, KEYS).collect()] == [(1, 4)]
    assert [r.f for r in apply.forward_fill(e, KEYS, "bio", "f").orderBy("lsn").collect()] == ["x", "x", None, None]
    target = spark.createDataFrame([(1, "t"), (2, "u")], "id bigint, v string")
    asked = spark.createDataFrame([(1,), (1,), (9,)], "id bigint")
    assert sorted(map(tuple, apply.read_back(asked, target, ["id"], ["v"]).collect())) == [(1, "t"), (9, None)]


def test_decoding_and_known_tables(spark):
    raw = spark.createDataFrame(
        [("insert", "", "t", 5, 0, DAY, {"id": "1", "b": "x"}, None, None), ("update", "s", "t", 6, 0, DAY, {"id": "1", "b": "x"}, None, ["b"]), ("delete", "", "t", 7, 0, DAY, None, {"id": "1"}, None), ("snapshot", "", "t", 9, 0, DAY, {"id": "2"}, None, None), ("truncate", "", "t", 8, 0, DAY, None, None, None)],
        "kind string, table_schema string, table_name string, lsn long, seq long, ts timestamp_ntz, new_row map<string,string>, old_keys map<string,string>, unchanged array<string>",
    )
    got = {r.op: r for r in decode(raw).collect()}
    assert set(got) == {"insert", "update", "delete", "snapshot"} and got["snapshot"].lsn == 0 and got["insert"].table_schema == "public"
    assert got["update"].data == {"id": "1"} and got["update"].column_kinds == {"b": UNCHANGED} and got["delete"].data == {"id": "1"}
    known = spark.createDataFrame([("public", "t")], "table_schema string, table_name string")
    assert known_tables(decode(raw), known).count() == 3 and unknown_tables(decode(raw), known).count() == 1
