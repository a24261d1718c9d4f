"""Pipeline specifications, their checks, and what a new revision calls for."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from tidemark.functions.identity import TableRef, checked_identifier
from tidemark.functions.registry import Processor
from tidemark.functions.timing import parse_duration
from tidemark.sources.envelope import OPERATIONS

# Defaults of batching and retries.
DEFAULTS = {"batch_size": 1000, "batch_wait": "5s", "max_retries": 3, "enable_dlq": True, "retry_base": "1s", "retry_cap": "30s"}


@dataclass
class TableSpec:
    """A sink table: key columns and payload columns with their Spark types, and the buckets that it is kept in."""

    name: str
    keys: dict[str, str]
    columns: dict[str, str]
    buckets: int = 16

    @property
    def ref(self) -> TableRef:
        return TableRef.parse(self.name)


@dataclass
class PipelineSpec:
    id: str
    source: str
    sinks: list[str]
    tables: list[TableSpec]
    name: str = ""
    processors: list[Processor] = field(default_factory=list)
    debug_sinks: list[str] = field(default_factory=list)
    #: Kind of each sink that isn't one of tables.
    kinds: dict[str, str] = field(default_factory=dict)
    batch_size: int | None = None
    batch_wait: str | None = None
    max_retries: int | None = None
    enable_dlq: bool | None = None
    retry_base: str | None = None
    retry_cap: str | None = None

    def resolved(self, shared: dict | None = None) -> PipelineSpec:
        """Own settings before shared ones before defaults."""
        values = DEFAULTS | {k: v for k, v in (shared or {}).items() if v is not None}
        return replace(self, **{k: v for k, v in values.items() if getattr(self, k) is None})

    def check(self) -> PipelineSpec:
        """Raises a ValueError that names every fault."""
        faults = []
        if not self.id or any(c in self.id for c in ". >*/"):
            faults.append("id must be set, without dots, spaces, slashes and wildcards")
        for what, there in (("source", self.source), ("sinks", self.sinks), ("tables", self.tables)):
            if not there:
                faults.append(f"{what} must be set")
        if len(set(self.sinks)) < len(self.sinks):
            faults.append("sinks must differ")
        for p in self.processors:
            if not p.operations:
                faults.append(f"processor {p.name}: operations must be set")
            faults += [f"processor {p.name}: unknown operation {o}" for o in p.operations if o not in OPERATIONS[:6]]
        for t in self.tables:
            try:
                TableRef.parse(t.name)
            except ValueError as e:
                faults.append(str(e))
            if not t.keys:
                faults.append(f"table {t.name}: keys must be set")
            for c in [*t.keys, *t.columns]:
                try:
                    checked_identifier(c)
                except ValueError as e:
                    faults.append(f"table {t.name}: {e}")
        for name in ("batch_wait", "retry_base", "retry_cap"):
            try:
                parse_duration(getattr(self, name) or "0")
            except ValueError as e:
                faults.append(f"{name}: {e}")
        if faults:
            raise ValueError("; ".join(faults))
        return self


def reload_action(old: PipelineSpec | None, new: PipelineSpec, old_revision: int = 0, new_revision: int = 1) -> str:
    """start, ignore (an old revision), skip (no change), add_tables (nothing but new tables), restart."""
    if old is None:
        return "start"
    if new_revision <= old_revision:
        return "ignore"
    if old == new:
        return "skip"
    before, after = {t.name for t in old.tables}, {t.name for t in new.tables}
    same = all(t in new.tables for t in old.tables)
    return "add_tables" if before < after and same and replace(new, tables=old.tables) == old else "restart"


def new_tables(old: PipelineSpec, new: PipelineSpec) -> list[TableSpec]:
    known = {t.name for t in old.tables}
    return [t for t in new.tables if t.name not in known]


# States of a table's snapshot and of its schema, and where each may go.
SNAPSHOT_STATES = {None: {"snapshotting"}, "snapshotting": {"draining", "failed", "error"}, "draining": {"cdc", "failed", "error"}, "cdc": {"error"}, "failed": {"snapshotting"}, "error": {"snapshotting", "cdc"}}
EVOLUTION_STATES = {"stable": {"frozen", "suspended"}, "frozen": {"draining", "suspended"}, "draining": {"stable"}, "suspended": {"stable"}}


def moved(states: dict, now: str | None, to: str) -> str:
    if to not in states.get(now, set()):
        raise ValueError(f"no way from {now} to {to}")
    return to
