"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key -ln(u) / w from a hash of its id (so reruns agree) and its quality weight w.
A source's target is met by whole epochs first; the rest is a prefix of the source in key order. The prefix is found without sorting
a source: keys fall into fine buckets, bucket sums are added up, and only the one bucket in which the budget ends is
ordered row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import WORD, materialize

#: Plans of at most so many sources are broadcast; larger ones are joined by shuffle.
BROADCAST_SOURCES = 20_000
#: Equal rows that one task makes at a time.
PIECE = 65_536
#: A word of letters alone, with at most one closing mark.
CLEAN_WORD = r"(?<![^\x20\x09-\x0D])\p{L}++[.,;:!?]?+(?![^\x20\x09-\x0D])"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_of(text: Column, size: Column) -> Column:
    """Quality weight from 0.5 to 1: half plus half the share of clean words (no words: 0.5)."""
    clean = F.coalesce(F.regexp_count(text, F.lit(CLEAN_WORD)), F.lit(0))
    return F.lit(0.5) + F.when(size > 0, F.lit(0.5) * clean / size).otherwise(F.lit(0.0))


def keyed(docs: DataFrame, seed: int = 11, quality: Column | None = None) -> DataFrame:
    """The mixing columns of docs (source key, size, weight, exponential key, tie-breaker) and its row as a struct _tm_doc.

    Rows of one doc_id and text have one key; the key depends on the text as well, so rows without an id aren't drawn together.
    """
    text = F.col("text").cast("string")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_tm_doc"), F.col("doc_id").cast("long").alias("_tm_id"), text.alias("_tm_text"), size_of(text).alias("_tm_size"), F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_tm_source"), (quality if quality is not None else F.lit(None)).cast("double").alias("_tm_given"))
    row = row.withColumn("_tm_tie", F.struct(F.col("_tm_id").alias("a"), F.xxhash64("_tm_text").alias("b")))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed).cast("long"), F.col("_tm_tie.a"), F.col("_tm_tie.b")), 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    weight = F.col("_tm_given") if quality is not None else quality_of(F.col("_tm_text"), F.col("_tm_size"))
    return row.withColumn("_tm_weight", weight).withColumn("_tm_key", -F.log(u) / F.col("_tm_weight")).drop("_tm_text", "_tm_given")


def targets(sources: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0) -> DataFrame:
    """Adds _tm_target to a row for each source (_tm_source, _tm_n): weights repeat in code-point order, null last.

    The shares are of the sum of all sizes. A target stops at `most` times its source's size and the excess is
    shared again by weight: sources sorted by cap / weight are capped up to the first whose share stays below its cap.
    Only this table, one row a source, passes through one task.
    """
    order = Window.orderBy((F.col("_tm_source") == "").asc(), F.col("_tm_source"))
    everything = Window.partitionBy()
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("w", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))).withColumn("cap", F.col("_tm_n") * F.lit(most))
    before = Window.orderBy(F.col("cap") / F.col("w"), "_tm_source").rowsBetween(Window.unboundedPreceding, -1)
    share = (F.sum("_tm_n").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    capped = ranked.withColumn("full", share * F.col("w") >= F.col("cap"))
    left = F.sum("_tm_n").over(everything) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("full"), F.lit(0.0)).otherwise(F.col("w"))).over(everything)
    return capped.withColumn("_tm_target", F.when(F.col("full"), F.col("cap")).otherwise(left * F.col("w") / open_weight)).drop("w", "cap", "full")


def bucket_of(buckets: int) -> Column:
    """Buckets of about equal size: the key passed through the exponential distribution with the source's mean weight."""
    return F.least(F.floor((1 - F.exp(-F.col("_tm_key") * F.col("_tm_rate"))) * buckets), F.lit(buckets - 1)).cast("int")


def plan_mix(rows: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0) -> tuple[DataFrame, int]:
    """One row a source: its size, target, epochs, and the key up to which documents are taken once more.

    rows: the mixing columns of every document, narrow and materialised.
    """
    n = rows.count()
    buckets = min(65_536, max(64, n // 2048))
    sources = rows.groupBy("_tm_source").agg(F.sum("_tm_size").alias("_tm_n"), F.avg("_tm_weight").alias("_tm_rate"))
    aims, _ = materialize(
        targets(sources, weights, most)
        .withColumn("_tm_epochs", F.when(F.col("_tm_n") > 0, F.least(F.floor(F.col("_tm_target") / F.col("_tm_n")), F.lit(int(most)))).otherwise(0).cast("long"))
        .withColumn("_tm_rest", F.col("_tm_target") - F.col("_tm_epochs") * F.col("_tm_n")),
        "mix-targets",
        small=True,
    )
    placed = with_plan(rows, aims).withColumn("_tm_bucket", bucket_of(buckets))
    upto = Window.partitionBy("_tm_source").orderBy("_tm_bucket")
    sums = placed.groupBy("_tm_source", "_tm_bucket", "_tm_rest").agg(F.sum("_tm_size").alias("s")).withColumn("upto", F.sum("s").over(upto))
    crossing = sums.filter(F.col("upto") > F.col("_tm_rest")).groupBy("_tm_source").agg(F.min(F.struct("_tm_bucket", (F.col("upto") - F.col("s")).alias("_tm_before"))).alias("x")).select("_tm_source", F.col("x._tm_bucket").alias("_tm_cross"), F.col("x._tm_before").alias("_tm_before"))
    inside = placed.join(F.broadcast(crossing) if small(aims) else crossing, "_tm_source").filter(F.col("_tm_bucket") == F.col("_tm_cross"))
    # rows of one id and text are one group, counted before they meet, so repeated rows are never gathered
    groups = inside.groupBy("_tm_source", "_tm_key", "_tm_tie", "_tm_size", "_tm_before", "_tm_rest").agg(F.count(F.lit(1)).alias("c"))
    order = Window.partitionBy("_tm_source").orderBy("_tm_key", "_tm_tie", "_tm_size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("_tm_rest") - F.col("_tm_before") - F.coalesce(F.sum(F.col("_tm_size") * F.col("c")).over(order), F.lit(0))
    # the document in which the budget ends is taken if that brings the sum nearer to it
    many = F.when(F.col("_tm_size") == 0, F.when(room >= 0, F.col("c")).otherwise(0)).otherwise(F.least(F.col("c"), F.greatest(F.lit(0).cast("long"), F.floor(room / F.col("_tm_size") + F.lit(0.5)))))
    taken = groups.withColumn("_tm_take", many.cast("long")).filter("_tm_take > 0")
    last = F.max(F.struct("_tm_key", "_tm_tie", "_tm_size", "_tm_take", "c")).alias("x")
    cuts = taken.groupBy("_tm_source").agg(last).select("_tm_source", F.struct("x._tm_key", "x._tm_tie", "x._tm_size").alias("_tm_cut"), F.col("x._tm_take").alias("_tm_take"), (F.col("x._tm_take") < F.col("x.c")).alias("_tm_part"))
    plan, _ = materialize(aims.join(crossing, "_tm_source", "left").join(cuts, "_tm_source", "left"), "mix-plan", small=True)
    return plan, buckets


def small(plan: DataFrame) -> bool:
    return plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES


def with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Joins what is known of each source; broadcast only when it has few enough sources, else AQE splits hot ones."""
    return rows.join(F.broadcast(plan) if small(plan) else plan, "_tm_source")


def times(buckets: int) -> Column:
    """How often the mix takes a document: the epochs, and once more if its key comes up to the source's cut."""
    here, key = bucket_of(buckets), F.struct("_tm_key", "_tm_tie", "_tm_size")
    extra = F.col("_tm_cross").isNull() | (here < F.col("_tm_cross")) | ((here == F.col("_tm_cross")) & F.col("_tm_cut").isNotNull() & (key <= F.col("_tm_cut")))
    return F.col("_tm_epochs") + F.when(extra & (F.col("_tm_rest") > 0), 1).otherwise(0)


def split_rows(plan: DataFrame) -> Column | None:
    """Which rows are of a group of equal ones of which the mix takes some once more and others not; None: there are none."""
    if plan.filter("_tm_part").isEmpty():
        return None
    return F.coalesce(F.col("_tm_part") & (F.struct("_tm_key", "_tm_tie", "_tm_size") == F.col("_tm_cut")), F.lit(False))


def repeated(groups: DataFrame, count: Column) -> DataFrame:
    """Each row as often as count says, numbered by _tm_i from 0. Long repeats are cut into pieces that any task may make."""
    pieces = groups.withColumn("_tm_all", count.cast("long")).filter("_tm_all > 0").withColumn("_tm_from", F.explode(F.expr(f"sequence(0L, _tm_all - 1, {PIECE}L)")))
    return pieces.hint("rebalance").withColumn("_tm_i", F.explode(F.expr(f"sequence(_tm_from, least(_tm_from + {PIECE}L, _tm_all) - 1)")))


COLUMNS = ["_tm_source", "_tm_size", "_tm_weight", "_tm_key", "_tm_tie"]


def mix_report(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0, seed: int = 11, quality: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document.

    Null text has size 0; null sources form one source, last in order; null doc_ids keep their row. Equal (doc_id, text) rows
    are interchangeable: as many of them are taken as the target asks for. Texts of any length count whole. Sources without
    words have target 0. An empty table gives an empty result; further columns of any name play no part.
    """
    rows, _ = materialize(keyed(docs, seed, quality).select(F.col("_tm_id").alias("doc_id"), *COLUMNS), "mix-rows")
    plan, buckets = plan_mix(rows, weights, most)
    shown = ["doc_id", F.col("_tm_size").alias("size"), F.col("_tm_n").alias("source_size"), F.col("_tm_target").alias("target")]
    planned, split = with_plan(rows, plan), split_rows(plan)
    whole = planned if split is None else planned.filter(~split)
    out = whole.select(*shown, (F.col("_tm_size") * times(buckets)).cast("long").alias("taken"))
    if split is None:
        return out
    groups = planned.filter(split).groupBy("doc_id", "_tm_size", "_tm_n", "_tm_target", "_tm_epochs", "_tm_take").agg(F.count(F.lit(1)).alias("c"))
    parts = repeated(groups, F.col("c")).select(*shown, (F.col("_tm_size") * (F.col("_tm_epochs") + (F.col("_tm_i") < F.col("_tm_take")).cast("long"))).cast("long").alias("taken"))
    return out.unionByName(parts)


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0, seed: int = 11, quality: Column | None = None) -> DataFrame:
    """The mixture itself: each document as often as the mix takes it, with the columns of docs, whatever their names.

    Documents without words weigh nothing and stay as often as their source's epochs and cut say. Nulls, repeated rows and
    empty tables as in mix_report; of equal (doc_id, text) rows that differ elsewhere the least by their hash come first.
    """
    rows, _ = materialize(keyed(docs, seed, quality).select(*COLUMNS), "mix-rows")
    plan, buckets = plan_mix(rows, weights, most)
    planned, split = with_plan(keyed(docs, seed, quality), plan), split_rows(plan)
    whole = planned if split is None else planned.filter(~split)
    taken = whole.withColumn("_tm_times", times(buckets).cast("int")).filter(F.col("_tm_times") > 0)
    out = taken.select("_tm_doc", F.explode(F.expr("array_repeat(true, _tm_times)")).alias("_tm_copy")).select("_tm_doc.*")
    if split is None:
        return out
    groups = planned.filter(split).groupBy("_tm_source", "_tm_doc", "_tm_epochs", "_tm_take").agg(F.count(F.lit(1)).alias("c"))
    order = Window.partitionBy("_tm_source").orderBy(F.xxhash64("_tm_doc"), "c").rowsBetween(Window.unboundedPreceding, -1)  # a row for each different document of one id and text
    more = F.least(F.col("c"), F.greatest(F.lit(0).cast("long"), F.col("_tm_take") - F.coalesce(F.sum("c").over(order), F.lit(0))))
    return out.unionByName(repeated(groups.withColumn("more", more), F.col("_tm_epochs") * F.col("c") + F.col("more")).select("_tm_doc.*"))
