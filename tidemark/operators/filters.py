"""Filters and routing over change events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.identity import schema_or_default
from tidemark.functions.text import glob_any
from tidemark.operators.ranking import row_numbers
from tidemark.sources.envelope import CONTROL_OPERATIONS


def for_operations(operations: list[str], change: Callable[[Column], Column], column: str = "data") -> Column:
    """change(column) for events of the operations, the column itself for all others; no row is dropped."""
    if not operations:
        return F.col(column)
    return F.when(F.col("op").isin(*operations), change(F.col(column))).otherwise(F.col(column))


def matches(schemas: list[str] | None = None, tables: list[str] | None = None) -> Column:
    """Schema in schemas or table in tables; a list that isn't given doesn't count, and without either all match."""
    by_schema = schema_or_default(F.col("table_schema")).isin(*[s or "public" for s in schemas]) if schemas else None
    by_table = F.col("table_name").isin(*tables) if tables else None
    found = [c for c in (by_schema, by_table) if c is not None]
    return found[0] | found[1] if len(found) == 2 else found[0] if found else F.lit(True)


def split_rows(events: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Kept and dropped events; an unknown keep drops."""
    known = F.coalesce(keep, F.lit(False))
    return events.filter(known), events.filter(~known)


@dataclass
class Condition:
    """eq, ne, in, contains on a column of the event's data."""

    field: str
    operator: str
    value: object

    def column(self) -> Column:
        x = F.element_at("data", F.lit(self.field))
        if self.operator == "eq":
            return x == F.lit(str(self.value))
        if self.operator == "ne":
            return ~x.eqNullSafe(F.lit(str(self.value)))
        if self.operator == "in":
            return x.isin(*[str(v) for v in self.value])
        if self.operator == "contains":
            return x.contains(str(self.value))
        raise ValueError(f"unknown operator: {self.operator}")


@dataclass
class CaptureFilter:
    """Which events an audit takes: table globs, operations, stages, conditions; all must hold."""

    include_tables: list[str] = field(default_factory=list)
    exclude_tables: list[str] = field(default_factory=list)
    operations: list[str] = field(default_factory=list)
    stages: list[str] = field(default_factory=lambda: ["before", "after"])
    conditions: list[Condition] = field(default_factory=list)

    def column(self, name: Column | None = None) -> Column:
        name = F.col("table_name") if name is None else name
        out = F.lit(True)
        if self.include_tables:
            out = out & glob_any(name, self.include_tables)
        if self.exclude_tables:
            out = out & ~glob_any(name, self.exclude_tables)
        if self.operations:
            out = out & F.col("op").isin(*self.operations)
        for c in self.conditions:
            out = out & F.coalesce(c.column(), F.lit(False))
        return out

    def takes(self, stage: str) -> bool:
        return stage in self.stages


def without_control(events: DataFrame) -> DataFrame:
    return events.filter(~F.col("op").isin(*CONTROL_OPERATIONS))


def without_snapshot_helpers(tables: DataFrame) -> DataFrame:
    return tables.filter(~F.col("table_name").contains("cdc_snapshot"))


def sample_share(percent: float, key: Column, overrides: dict[str, float] | None = None) -> Column:
    """Keeps about percent of all keys, the same ones on every run and in every engine that has MD5; a table may have a share of its own."""
    share = F.lit(float(percent))
    for table, own in (overrides or {}).items():
        share = F.when(F.col("table_name") == table, F.lit(float(own))).otherwise(share)
    return (share >= 100) | ((share > 0) & (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 10_000 < share * 100))


def once(events: DataFrame) -> DataFrame:
    """One event of each message id; events without one all stay."""
    return events.filter("uuid IS NOT NULL").dropDuplicates(["uuid"]).unionByName(events.filter("uuid IS NULL"))


def at_stage(rows: DataFrame, chosen: CaptureFilter) -> DataFrame:
    """Audit rows of the stages that a capture takes."""
    return rows.filter(F.col("capture_stage").isin(*chosen.stages))


def every_nth(events: DataFrame, n: int, order: list[str], per: list[str]) -> DataFrame:
    """Every n-th event of each group in order."""
    return row_numbers(events, per, order, "_nth").filter(F.col("_nth") % n == 0).drop("_nth")


def page(rows: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """A page of an ordered listing; page from 1 to 10000, size from 1 to 100."""
    number, size = min(max(number, 1), 10_000), min(max(size, 1), 100)
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def search(rows: DataFrame, text: str = "", status: str = "") -> DataFrame:
    """Listings whose name or id contains the text and whose status is the given one, ignoring case."""
    if text:
        rows = rows.filter(F.lower("name").contains(text.lower()) | F.lower("id").contains(text.lower()))
    return rows.filter(F.lower("status") == status.lower()) if status else rows


def stale(beats: DataFrame, now: Column, seconds: int = 60) -> DataFrame:
    return beats.filter(F.col("updated_at") < now - F.make_dt_interval(secs=F.lit(seconds)))

