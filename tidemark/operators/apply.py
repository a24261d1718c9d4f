"""Applying change events to keyed tables.

Upserts replace whole rows: the last event of a key by (lsn, seq) wins, columns it doesn't list become null, columns it left out as
unchanged keep their value. Deletes only set deleted_at, which later upserts keep unless they carry a deleted_at of their own. In
one batch deletes come after upserts. All this is associative, so a whole log is folded by one aggregation per key, and a
batch is merged into a table by the same aggregation over table and batch together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import typed
from tidemark.sources.envelope import DATA_OPERATIONS, has, unchanged, value

TOMBSTONE = "deleted_at"


def is_upsert() -> Column:
    return F.col("op").isin(*DATA_OPERATIONS)


def is_delete() -> Column:
    return F.col("op") == "delete"


def split_batch(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    return events.filter(is_upsert()), events.filter(is_delete())


def lacks_key(keys: list[str]) -> Column:
    """Whether an event misses a key column, by absence or null."""
    out = F.lit(False)
    for k in keys:
        out = out | ~has(k) | value(k).isNull()
    return out


def rejected(events: DataFrame, keys: list[str]) -> DataFrame:
    """Events that can't be applied, for the dead letters."""
    return events.filter((is_upsert() | is_delete()) & lacks_key(keys)).withColumn("reason", F.lit("missing_pk_columns"))


def _order() -> Column:
    return F.struct("batch_id", "lsn", "seq")


def fold(events: DataFrame, keys: dict[str, str], columns: dict[str, str], by: list[str] | None = None, base: DataFrame | None = None) -> DataFrame:
    """The table that the events make, from nothing or from `base` (a table that fold returned before).

    keys, columns: names and Spark types; by: further grouping columns of the events, such as schema and name. One shuffle on the
    key with partial aggregation before it, whatever the number of batches or events of a key. Rows carry _first (the batch
    in which the row appeared) beside deleted_at.
    """
    by = by or []
    order = _order()
    usable = events.filter((is_upsert() | is_delete()) & ~lacks_key(list(keys)))
    up = is_upsert()
    cells = [F.when(up & ~unchanged(c), F.struct(order.alias("o"), value(c).alias("v"))).alias(f"c_{i}") for i, c in enumerate(columns)]
    own = F.when(up & has(TOMBSTONE), F.struct(F.col("batch_id").alias("b"), F.lit(0).alias("p"), F.col("lsn").alias("l"), F.col("seq").alias("s"), F.lit(None).cast("timestamp_ntz").alias("t"), value(TOMBSTONE).try_cast("timestamp_ntz").alias("v")))
    gone = F.when(is_delete(), F.struct(F.col("batch_id").alias("b"), F.lit(1).alias("p"), F.lit(0).cast("bigint").alias("l"), F.lit(0).cast("bigint").alias("s"), F.col("ts").alias("t"), F.col("ts").alias("v")))
    shaped = usable.select(*by, *[typed(value(k), t).alias(k) for k, t in keys.items()], *cells, F.coalesce(own, gone).alias("dead"), F.when(up, F.col("batch_id")).alias("first"))
    if base is not None:
        floor = F.struct(F.lit(-1).cast("bigint").alias("batch_id"), F.lit(-1).cast("bigint").alias("lsn"), F.lit(-1).cast("bigint").alias("seq"))
        old_cells = [F.struct(floor.alias("o"), F.col(f"`{c}`").cast("string").alias("v")).alias(f"c_{i}") for i, c in enumerate(columns)]
        dead = F.when(F.col(TOMBSTONE).isNotNull(), F.struct(F.lit(-1).cast("bigint").alias("b"), F.lit(1).alias("p"), F.lit(0).cast("bigint").alias("l"), F.lit(0).cast("bigint").alias("s"), F.col(TOMBSTONE).alias("t"), F.col(TOMBSTONE).alias("v")))
        shaped = shaped.unionByName(base.select(*by, *keys, *old_cells, dead.alias("dead"), F.lit(-1).cast("bigint").alias("first")))
    groups = [*by, *keys]
    folded = shaped.groupBy(*groups).agg(*[F.max(f"c_{i}").alias(f"c_{i}") for i in range(len(columns))], F.max("dead").alias("dead"), F.min("first").alias("first")).filter("first IS NOT NULL")
    return folded.select(
        *groups, *[typed(F.col(f"c_{i}.v"), t).alias(c) for i, (c, t) in enumerate(columns.items())],
        F.when((F.col("dead.p") == 0) | (F.col("dead.b") >= F.col("first")), F.col("dead.v")).alias(TOMBSTONE), F.col("first").alias("_first"),
    )


def latest(events: DataFrame, keys: dict[str, str]) -> DataFrame:
    """The last upsert of each key, with its data as map entries. An aggregation, not a sort of each key's events."""
    usable = events.filter(is_upsert() & ~lacks_key(list(keys)))
    plain = [c for c in events.columns if c not in ("data", "column_kinds")]
    named = [typed(value(k), t).alias(f"_k_{k}") for k, t in keys.items()]
    rows = usable.select(*named, F.struct("lsn", "seq").alias("_o"), F.struct(*plain, F.map_entries("data").alias("data")).alias("_e"))
    last = rows.groupBy(*[f"_k_{k}" for k in keys]).agg(F.max_by("_e", "_o").alias("e"))
    return last.select(*[F.col(f"_k_{k}").alias(k) for k in keys], "e.*")


def forward_fill(events: DataFrame, keys: dict[str, str], column: str, out: str) -> DataFrame:
    """Each upsert with the column's value as of that event: its own, or for an unchanged one the key's last value before.

    Nulls that were sent count as values.
    """
    from pyspark.sql import Window

    rows = events.filter(is_upsert() & ~lacks_key(list(keys))).select("*", *[typed(value(k), t).alias(k) for k, t in keys.items()])
    known = F.when(~unchanged(column), F.struct(value(column).alias("v")))
    before = Window.partitionBy(*keys).orderBy("lsn", "seq").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.last(known, ignorenulls=True).over(before)["v"])


def read_back(batch_keys: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """What the target holds for the keys of a batch; keys it lacks get nulls.

    AQE broadcasts the batch's distinct keys when they are small enough, so history isn't moved.
    """
    wanted = batch_keys.select(*keys).distinct()
    return wanted.join(target.select(*keys, *columns), keys, "left")


def soft_delete(target: DataFrame, deletes: DataFrame, keys: list[str]) -> DataFrame:
    """Sets deleted_at from the latest of each key's deletes; keys without a row change nothing, rows stay in place."""
    last = deletes.groupBy(*keys).agg(F.max("ts").alias("_ts"))
    return target.join(last, keys, "left").withColumn(TOMBSTONE, F.coalesce("_ts", TOMBSTONE)).drop("_ts")


def upsert(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Replaces whole rows by key; columns that the new rows lack become null."""
    return target.join(rows.select(*keys), keys, "left_anti").unionByName(rows, allowMissingColumns=True)


def deletes_by_key(events: DataFrame, keys: dict[str, str]) -> DataFrame:
    """The deletes of each key: the time of the last one, and their number."""
    gone = events.filter(is_delete() & ~lacks_key(list(keys)))
    return gone.groupBy(*[typed(value(k), t).alias(k) for k, t in keys.items()]).agg(F.max("ts").alias("ts"), F.count(F.lit(1)).alias("n"))


def keys_to_read_back(events: DataFrame, keys: dict[str, str], columns: list[str]) -> DataFrame:
    """Keys of events that leave any of the columns out as unchanged."""
    lacking = F.lit(False)
    for c in columns:
        lacking = lacking | unchanged(c)
    return events.filter(is_upsert() & lacking & ~lacks_key(list(keys))).select(*[typed(value(k), t).alias(k) for k, t in keys.items()]).distinct()


def column_set() -> Column:
    """Sorted names of the columns an event lists."""
    return F.array_sort(F.map_keys("data"))
