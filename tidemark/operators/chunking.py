"""Cutting rows into statements and requests."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import row_numbers
from tidemark.streaming.scratch import root, temporary

#: Placeholders that a statement may hold.
PLACEHOLDERS = 10_000
#: Share of the largest message that a request fills.
FILL = 0.95


def rows_per_statement(columns: Column, placeholders: int = PLACEHOLDERS, reserved: int = 0) -> Column:
    """At least one row, else as many as the placeholders allow."""
    return F.greatest(F.floor((F.lit(placeholders) - reserved) / columns), F.lit(1)).cast("bigint")


def statements(rows: DataFrame, by: list[str], order: list[str], columns: Column, placeholders: int = PLACEHOLDERS) -> DataFrame:
    """Number of the statement that each row goes into, in each group."""
    numbered = row_numbers(rows, by, order, "_nth")
    return numbered.withColumn("statement", F.floor((F.col("_nth") - 1) / rows_per_statement(columns, placeholders)).cast("bigint")).drop("_nth")


def _scan(sizes: list[int], used: int, budget: int) -> tuple[list[int], int]:
    """Requests begun up to each row (0: the one that was open before), and what the last one holds. used: what is open, -1 for nothing."""
    n, out = 0, []
    for size in sizes:
        if used < 0 or (used and used + size > budget):
            n, used = n + 1, 0
        used += size
        out.append(n)
    return out, used


def _outcomes(sizes: list[int], budget: int) -> list[tuple[int, int, int]]:
    """What a stretch of rows makes of what is open before it: (least open size, requests begun, size open after it), for falling sizes.

    The open request takes rows as long as they fit; where it ends decides all that follows. Rows from which a request may begin first
    are those that the open one can reach, and from each the rest is known by the request after it, so one pass back
    over the rows tells all outcomes. A stretch of many requests has few different ones, since their ends soon fall together.
    """
    n = len(sizes)
    ends = [n] * (n + 1)  # the row at which a request that begins at i is followed by the next
    j, used = 0, 0
    for i in range(n):
        if j <= i:
            j, used = i + 1, sizes[i]
        while j < n and not (used and used + sizes[j] > budget):
            used += sizes[j]
            j += 1
        ends[i] = j
        used -= sizes[i]
    count, last, after = [0] * (n + 1), [0] * (n + 1), 0
    for i in reversed(range(n)):
        nxt, after = ends[i], after + sizes[i]
        count[i], last[i] = (1, after) if nxt == n else (1 + count[nxt], last[nxt])
    out, total, i = [], 0, 0
    # an open request of more than budget - total, and not empty, ends before row i
    while i < n:
        total += sizes[i]
        least = max(1, budget - total + 1)
        out.append((least, count[i], last[i]))
        if least == 1:
            break
        i += 1
    return out


#: In the place of an open size: an open request without bytes, and any that all rows fit into.
EMPTY, FITS = -2, -1


def byte_chunks(rows: DataFrame, by: list[str], order: list[str], size: str, most: int) -> DataFrame:
    """Greedy requests: rows in order until the next would pass the budget; a row above it goes alone.

    Where a request ends depends on all before it in its group. So rows are dealt by range of group and order; each stretch of a group tells
    what it makes of any size that may be open before it, these few outcomes are followed from stretch to stretch, and each
    stretch is numbered from where it stands. A group of any size is spread over all tasks.
    """
    spark = rows.sparkSession
    budget = int(most * FILL)
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = rows.columns
    path = f"{root(spark)}/tidemark/chunked-{uuid.uuid4().hex}"
    rows.repartitionByRange(spread, *by, *order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    saved = spark.read.parquet(temporary(spark, path))  # ranges come from a sample: a lost executor can't deal them anew
    ordered = saved.repartition(spread, "_part").sortWithinPartitions("_part", *by, *order)
    key = ["_part", *by]
    told = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in saved.select(*key).schema] + ["outcomes array<struct<least:bigint,begun:bigint,open:bigint>>"])

    def stretches(frames):
        """Whole stretches of a group in one range, a piece at a time."""
        held, now = [], None
        for d in frames:
            for k, part in d.groupby(key, sort=False, dropna=False):
                k = tuple(None if x != x else x for x in k)
                if now is not None and k != now:
                    yield now, pd.concat(held)
                    held = []
                now = k
                held.append(part)
        if held:
            yield now, pd.concat(held)

    def tell(frames):
        for k, d in stretches(frames):
            found = [{"least": a, "begun": b, "open": c} for a, b, c in _outcomes([int(x) for x in d[size]], budget)]
            begun, used = _scan([int(x) for x in d[size]], 0, budget)
            empty = {"least": EMPTY, "begun": begun[-1], "open": used}  # what is open holds nothing yet and takes any row
            whole = {"least": FITS, "begun": 0, "open": int(d[size].sum())}  # all rows fit into what is open
            yield pd.DataFrame([[*k, [*found, empty, whole]]], columns=[*key, "outcomes"])

    outcomes = ordered.select(*key, *[c for c in (*order, size) if c not in key]).mapInPandas(tell, told)

    def follow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_part")
        used, n, starts = -1, 0, []
        for found in group["outcomes"]:
            starts.append((used, n))
            first = found[0]
            if used < 0:  # nothing is open: the first row begins a request
                begun, used = first["begun"], first["open"]
            elif used == 0:
                begun, used = found[-2]["begun"], found[-2]["open"]
            else:
                hit = next((x for x in found[:-2] if x["least"] <= used), None)
                begun, used = (hit["begun"], hit["open"]) if hit else (0, used + found[-1]["open"])
            n += begun
        return group[key].assign(_used=[u for u, _ in starts], _before=[b for _, b in starts])

    start_schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in saved.select(*key).schema] + ["_used bigint", "_before bigint"])
    starts = outcomes.groupBy(*by).applyInPandas(follow, start_schema) if by else outcomes.groupBy(F.lit(1)).applyInPandas(follow, start_schema)
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(by):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_g{i}"))
    placed = saved.join(starts.select(F.col("_part").alias("_p"), "_used", "_before", *[F.col(f"`{c}`").alias(f"_g{i}") for i, c in enumerate(by)]), same).select(*saved.columns, "_used", "_before")
    out = rows.withColumn("request", F.lit(0).cast("bigint")).schema

    def number(frames):
        for _, d in stretches(frames):
            begun, _ = _scan([int(x) for x in d[size]], int(d["_used"].iloc[0]), budget)
            yield d[names].assign(request=[int(d["_before"].iloc[0]) + b - 1 for b in begun])

    return placed.repartition(spread, "_part").sortWithinPartitions("_part", *by, *order).mapInPandas(number, out)
