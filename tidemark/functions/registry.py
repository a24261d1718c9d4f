"""Transformers by name: column rewrites that stay in the engine, and batch functions over pandas frames."""

from __future__ import annotations

import importlib
import inspect
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import mask as mask_text

_FACTORIES: dict[str, Callable] = {}


@dataclass
class Transformer:
    """data: rewrites the data map. keep: events to keep; the rest is dropped and reported."""

    data: Callable[[Column], Column] | None = None
    keep: Callable[[], Column] | None = None


@dataclass
class BatchTransformer:
    """run: frames in, frames out, with the columns of the input; it may drop rows but keeps the order of the rest."""

    run: Callable[[Iterator], Iterator]
    close: Callable[[], None] | None = None


def register(name: str, factory: Callable) -> None:
    """Names may be paths such as ddl/add_column; a name can be given once."""
    if name in _FACTORIES:
        raise ValueError(f"transformer {name!r} exists")
    _FACTORIES[name] = factory


def factory_of(name: str) -> Callable:
    """A registered factory, or one that a dotted path module:factory names."""
    if name in _FACTORIES:
        return _FACTORIES[name]
    if ":" in name:
        module, _, attribute = name.partition(":")
        return getattr(importlib.import_module(module), attribute)
    raise KeyError(f"no transformer {name!r}")


def create(name: str, **options):
    return factory_of(name)(**options)


def replace(data: Column, column: str, change: Callable[[Column], Column]) -> Column:
    """data with one column's value changed where it is present and not null."""
    return F.transform_values(data, lambda k, v: F.when((k == column) & v.isNotNull(), change(v)).otherwise(v))


def mask(column: str, salt: str = "", text_columns: list[str] | None = None, **_) -> Transformer:
    """Hides a text column; columns known not to be text stay as they are."""
    if text_columns is not None and column not in text_columns:
        return Transformer()
    return Transformer(data=lambda d: replace(d, column, lambda v: mask_text(v, salt)))


def uppercase(column: str, **_) -> Transformer:
    return Transformer(data=lambda d: replace(d, column, F.upper))


register("mask", mask)
register("uppercase", uppercase)


@dataclass
class Processor:
    name: str
    operations: list[str]
    schemas: list[str] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)
    options: dict = field(default_factory=dict)


def run_batch(events: DataFrame, transformer: BatchTransformer) -> DataFrame:
    """Events that a batch function lets through."""
    return route(events, transformer, F.lit(True)).filter("NOT _gone").drop("_gone")


def route(events: DataFrame, transformer: BatchTransformer, mine: Column) -> DataFrame:
    """All events in one pass over Arrow batches, with `_gone`: whether the function has dropped an event.

    Events that aren't `mine` pass by it unchanged. The function gets a further column, _row, by which dropped events are known,
    and has to keep it. An error fails the batch, so nothing is lost.
    """
    schema = events.withColumn("_gone", F.lit(False)).schema

    def run(frames):
        held: list = []  # frames given to the function whose fate isn't known yet
        others: list = []
        n = 0

        def feed():
            nonlocal n
            for d in frames:
                chosen = d.pop("_mine").to_numpy(bool)
                if not chosen.all():
                    others.append(d[~chosen])
                if chosen.any():
                    x = d[chosen].assign(_row=range(n, n + int(chosen.sum())))
                    n += len(x)
                    held.append(x)
                    yield x

        def settle(upto: int, came: set):
            while held:
                x = held[0]
                known = x["_row"] <= upto
                lost = x[known & ~x["_row"].isin(came)]
                if len(lost):
                    yield lost.drop(columns="_row").assign(_gone=True)
                if not known.all():
                    held[0] = x[~known]
                    return
                held.pop(0)

        try:
            for out in transformer.run(feed()):
                if "_row" not in out.columns:
                    raise ValueError("a batch transformer must keep the column _row")
                if len(out):
                    yield from settle(int(out["_row"].max()), set(out["_row"]))
                yield out.drop(columns="_row").assign(_gone=False)
                while others:
                    yield others.pop(0).assign(_gone=False)
            yield from settle(n, set())
            while others:
                yield others.pop(0).assign(_gone=False)
        finally:
            if transformer.close:
                transformer.close()

    return events.withColumn("_mine", F.coalesce(mine, F.lit(False))).mapInPandas(run, schema)


def rejoin(originals: DataFrame, transformed: DataFrame, keys: list[str]) -> DataFrame:
    """Each original with `filtered`: whether the transformation dropped it. Joined by key, never by position."""
    mark = transformed.select(*keys).distinct().withColumn("_kept", F.lit(True))
    return originals.join(mark, keys, "left").withColumn("filtered", F.col("_kept").isNull()).drop("_kept")


def accepted(factory: Callable, options: dict) -> dict:
    """Those of the options that a factory takes."""
    found = inspect.signature(factory).parameters.values()
    if any(p.kind is p.VAR_KEYWORD for p in found):
        return options
    names = {p.name for p in found}
    return {k: v for k, v in options.items() if k in names}


def apply_chain(events: DataFrame, processors: list[Processor], given: dict | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Events after all processors, in which events of other operations or tables pass unchanged; and those dropped.

    given: options of the pipeline, such as its id and batch size, for factories that take them; a processor's own come first.
    Each processor is one pass over the events, batch transformers too.
    """
    from tidemark.operators.filters import matches

    dropped = None

    def drop(gone: DataFrame) -> None:
        nonlocal dropped
        dropped = gone if dropped is None else dropped.unionByName(gone)

    for p in processors:
        if not p.operations:
            continue
        t = create(p.name, **(accepted(factory_of(p.name), {k: v for k, v in (given or {}).items() if k not in p.options}) | p.options))
        mine = F.col("op").isin(*p.operations) & matches(p.schemas, p.tables)
        if isinstance(t, BatchTransformer):
            routed = route(events, t, mine)
            drop(routed.filter("_gone").drop("_gone"))
            events = routed.filter("NOT _gone").drop("_gone")
            continue
        if t.data is not None:
            events = events.withColumn("data", F.when(mine, t.data(F.col("data"))).otherwise(F.col("data")))
        if t.keep is not None:
            drop(events.filter(mine & ~F.coalesce(t.keep(), F.lit(False))))
            events = events.filter(~mine | F.coalesce(t.keep(), F.lit(False)))
    return events, dropped
