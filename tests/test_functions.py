import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.functions import identity, text, timing, types
from tidemark.functions.identity import TableRef


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("given", "ref"), [("users", TableRef("public", "users")), ("sales.users", TableRef("sales", "users"))])
def test_table_refs_parse_and_round_trip(given, ref):
    assert TableRef.parse(given) == ref and TableRef.from_token(ref.token) == ref and TableRef.parse(str(ref)) == ref


@pytest.mark.parametrize("bad", ["", ".", "a.", ".b", "a.b.c", "a=b"])
def test_bad_table_refs(bad):
    with pytest.raises(ValueError):
        TableRef.parse(bad)


def test_tokens_are_injective(spark):
    refs = [(s, t) for s in ("public", "a", "b") for t in ("a", "b", "a_b")]
    df = spark.createDataFrame(refs, "s string, t string")
    got = [r.k for r in df.select(identity.key_token(F.col("s"), F.col("t")).alias("k")).collect()]
    assert len(set(got)) == len(refs) and got == [TableRef(*r).token for r in refs]
    assert one(spark, identity.qualified(F.lit(""), F.lit("t"))) == "public.t"


def test_identifiers():
    assert identity.checked_identifier("a_1.B2") == "a_1.B2" and identity.quoted("a.b") == "`a`.`b`"
    for bad in ("a-b", "a;drop", "", "a..b", "a b"):
        with pytest.raises(ValueError):
            identity.checked_identifier(bad)


def test_mask_and_null(spark):
    assert one(spark, text.mask(F.lit("secret"), "s")) == hashlib.sha256(b"secrets").hexdigest()
    assert one(spark, text.mask(F.lit(None).cast("string"), "s")) is None


@pytest.mark.parametrize(("glob", "value", "fits"), [("*", "any", True), ("users", "users", True), ("users", "users2", False), ("u*s", "users", True), ("*.users", "a.users", True), ("a.c", "abc", False), ("a+*", "a+b", True), ("", "", True), ("cdc_*", "x_cdc_1", False)])
def test_globs(spark, glob, value, fits):
    assert one(spark, text.glob_any(F.lit(value), [glob])) is fits


@pytest.mark.parametrize(("ddl", "keys"), [("CREATE TABLE t (a INT, PRIMARY KEY (a))", ["a"]), ('... primary key ( "b" ASC, `c` desc ) ...', ["b", "c"]), ("no key here", [])])
def test_keys_of_ddl(spark, ddl, keys):
    assert one(spark, text.primary_key_columns(F.lit(ddl))) == keys


TYPE_CASES = {
    "numeric": "DECIMAL(38,9)", "decimal": "DECIMAL(38,9)", "numeric(10,2)": "DECIMAL(38,9)", "int[]": "VARIANT", "text[]": "VARIANT", "_int4": "VARIANT", "bool": "BOOLEAN", "int": "INT64", "bigint": "INT64", "23": "INT64",
    "double precision": "FLOAT64", "timestamp": "TIMESTAMP", "date": "DATE", "jsonb": "VARIANT", "varchar": "STRING", "1043": "STRING", "bytea": "BINARY", "interval": "STRING", "money": "STRING", "unknown": "STRING",
}


def test_type_map(spark):
    df = spark.createDataFrame([(k,) for k in TYPE_CASES], "t string")
    assert {r.t: r.k for r in df.select("t", types.sink_type(F.col("t")).alias("k")).collect()} == TYPE_CASES
    assert one(spark, types.sink_type(F.lit("interval"), by_substring=True)) == "INT64"
    assert types.decimal_type(20, 4) == "DECIMAL(20,4)" and types.decimal_type(10, 50) == "DECIMAL(10,10)" and types.decimal_type(15, 0) == "DECIMAL(15)"
    assert types.wire_kind("bigint") == "int" and types.wire_kind("decimal(9,2)") == "decimal" and types.wire_kind("array<int>") == "json"
    assert types.spark_type("DECIMAL(10,2)") == "decimal(10,2)" and types.spark_type("INT64") == "bigint"


def test_values_survive_their_text_form(spark):
    assert str(one(spark, types.typed(F.lit("9007199254740993.123456789"), "decimal(38,9)"))) == "9007199254740993.123456789"
    assert one(spark, types.typed(F.lit("nonsense"), "bigint")) is None
    assert one(spark, types.typed(types.wire_text(F.lit(2**53 + 1), "bigint"), "bigint")) == 2**53 + 1
    assert one(spark, types.typed(types.wire_text(F.lit(b"\x00\xff"), "binary"), "binary")) == b"\x00\xff"
    assert one(spark, F.to_json(types.json_or_text(F.lit('{"a": 1}')))) == '{"a":1}'
    assert one(spark, F.to_json(types.json_or_text(F.lit("not json")))) == '"not json"'
    assert one(spark, types.uuid_text(F.unhex(F.lit("00112233445566778899aabbccddeeff")))) == "00112233-4455-6677-8899-aabbccddeeff"


def test_key_text(spark):
    assert one(spark, identity.key_string([identity.key_text(F.lit(7.0), "double"), identity.key_text(F.lit(7.5), "double"), identity.key_text(F.lit("x"), "string")])) == "7|7.5|x"


@pytest.mark.parametrize(("given", "ns", "printed"), [("5s", 5_000_000_000, "5s"), ("1h30m", 5_400_000_000_000, "1h30m0s"), ("500ms", 500_000_000, "500ms"), ("-2m", -120_000_000_000, "-2m0s"), ("1.5s", 1_500_000_000, "1.5s"), ("0", 0, "0s")])
def test_durations(given, ns, printed):
    assert timing.parse_duration(given) == ns and timing.format_duration(ns) == printed and timing.parse_duration(printed) == ns


@pytest.mark.parametrize("bad", ["", "5", "s", "5 s", "1x", "--5s"])
def test_bad_durations(bad):
    with pytest.raises(ValueError):
        timing.parse_duration(bad)


def test_backoff_and_waits(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 10, 400)], "n int")
    assert [r.w for r in df.select(timing.backoff_ms(F.col("n"), 1000, 30_000).alias("w")).collect()] == [1000, 2000, 4000, 30_000, 30_000]
    assert one(spark, timing.ack_wait_ms(F.lit(1))) == 30_000 and one(spark, timing.ack_wait_ms(F.lit(1000))) == 600_000
    assert one(spark, timing.transform_timeout_ms(F.lit(4000))) == 20_000
    assert timing.jittered(100, 0.0) == 80 and timing.jittered(100, 1.0) == 120 and timing.jittered(0.5, 0.5) == 1.0
