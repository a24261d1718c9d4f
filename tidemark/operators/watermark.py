"""Acknowledgement watermarks: the highest LSN up to which every event is confirmed by all sinks."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ack_counts(observed: DataFrame, confirms: DataFrame, sinks: list[str], by: list[str] | None = None) -> DataFrame:
    """For each LSN: observed, self_acked, and whether it is confirmed.

    observed: lsn and self_acked (filtered events confirm themselves); confirms: lsn, sink_id. An LSN is confirmed when each sink
    has confirmed as many events as were observed and not self-acked; confirms without an observed event hold it back.
    Counts of both sides are taken in one aggregation, so sinks aren't crossed with LSNs.
    """
    by = by or []
    seen = observed.select(*by, "lsn", F.lit(1).alias("o"), F.col("self_acked").cast("int").alias("s"), F.lit(None).cast("string").alias("sink_id"))
    told = confirms.select(*by, "lsn", F.lit(0).alias("o"), F.lit(0).alias("s"), "sink_id")
    counts = [F.sum((F.col("sink_id") == s).cast("int")).alias(f"_s{i}") for i, s in enumerate(sinks)]
    summed = seen.unionByName(told).groupBy(*by, "lsn").agg(F.sum("o").alias("observed"), F.sum("s").alias("self_acked"), *counts)
    full = F.col("observed") > 0
    for i in range(len(sinks)):
        full = full & (F.coalesce(f"_s{i}", F.lit(0)) >= F.col("observed") - F.col("self_acked"))
    return summed.select(*by, "lsn", "observed", "self_acked", full.alias("confirmed"))


def watermark(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """watermark and its first unconfirmed LSN (null: none), for each group; no confirmed prefix: 0.

    Two aggregations and no sort: the least unconfirmed LSN, then the greatest LSN below it.
    """
    by = by or []
    held = counts.groupBy(*by).agg(F.min(F.when(~F.col("confirmed"), F.col("lsn"))).alias("first_unconfirmed"))
    joined = counts.join(held, by) if by else counts.crossJoin(F.broadcast(held))  # without by, held is one row
    below = F.when(F.col("first_unconfirmed").isNull() | (F.col("lsn") < F.col("first_unconfirmed")), F.col("lsn"))
    return joined.groupBy(*by, "first_unconfirmed").agg(F.coalesce(F.max(below), F.lit(0)).alias("watermark")).select(*by, "watermark", "first_unconfirmed")


def ack_watermark(observed: DataFrame, confirms: DataFrame, sinks: list[str], by: list[str] | None = None) -> DataFrame:
    """watermark(ack_counts(...)) with one shuffle on the LSN: below the first unconfirmed LSN all are confirmed, so
    the greatest one there is found on the raw rows by a partial maximum."""
    by = by or []
    held = ack_counts(observed, confirms, sinks, by).groupBy(*by).agg(F.min(F.when(~F.col("confirmed"), F.col("lsn"))).alias("first_unconfirmed"))
    rows = observed.select(*by, "lsn").unionByName(confirms.select(*by, "lsn"))
    joined = rows.join(held, by) if by else rows.crossJoin(F.broadcast(held))  # without by, held is one row
    below = F.when(F.col("first_unconfirmed").isNull() | (F.col("lsn") < F.col("first_unconfirmed")), F.col("lsn"))
    return joined.groupBy(*by, "first_unconfirmed").agg(F.coalesce(F.max(below), F.lit(0)).alias("watermark")).select(*by, "watermark", "first_unconfirmed")


def requirements(observed: DataFrame, confirms: DataFrame, sinks: DataFrame) -> DataFrame:
    """Each observed LSN with each required sink and the confirms it has: lsn, sink_id, required, confirmed."""
    need = observed.groupBy("lsn").agg((F.count(F.lit(1)) - F.sum(F.col("self_acked").cast("int"))).alias("required"))
    have = confirms.groupBy("lsn", "sink_id").agg(F.count(F.lit(1)).alias("confirmed"))
    listed = sinks.agg(F.collect_set("sink_id").alias("_sinks"))  # one row
    return need.crossJoin(F.broadcast(listed)).withColumn("sink_id", F.explode("_sinks")).join(have, ["lsn", "sink_id"], "left").select("lsn", "sink_id", "required", F.coalesce("confirmed", F.lit(0)).alias("confirmed"))


def running_confirmed(counts: DataFrame) -> DataFrame:
    """For each LSN whether all up to it are confirmed, against the first unconfirmed one."""
    held = counts.agg(F.min(F.when(~F.col("confirmed"), F.col("lsn"))).alias("_held"))
    return counts.crossJoin(F.broadcast(held)).withColumn("prefix_confirmed", F.col("_held").isNull() | (F.col("lsn") < F.col("_held"))).drop("_held")


def late(events: DataFrame, marks: DataFrame) -> DataFrame:
    """Events at or below their source's watermark: delivered again, or lost to it."""
    return events.join(marks.select("source_id", "watermark"), "source_id").filter(F.col("lsn") <= F.col("watermark")).drop("watermark")


class AckTracker:
    """The watermark of one source as events and confirms come in, in any order.

    An LSN counts as a whole: events that were filtered don't carry the watermark past others of the same LSN that are still
    to come, because an LSN is only passed once a higher one has been observed or `settle` says that it is complete.
    """

    def __init__(self, sinks: list[str], start: int = 0, strict_groups: bool = False):
        self.sinks, self.mark, self.strict = list(sinks), start, strict_groups
        self.order: list[int] = []
        self.observed: dict[int, int] = defaultdict(int)
        self.self_acked: dict[int, int] = defaultdict(int)
        self.confirmed: dict[int, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        self.highest, self.refused, self.dropped, self._armed = start, None, 0, True

    def _known(self, lsn: int) -> None:
        i = bisect_left(self.order, lsn)
        if i == len(self.order) or self.order[i] != lsn:
            insort(self.order, lsn)

    def observe(self, lsn: int, self_acked: bool = False) -> int:
        if lsn <= self.mark:
            self.dropped += 1
            return self.mark
        self._known(lsn)
        self.observed[lsn] += 1
        self.self_acked[lsn] += self_acked
        self.highest, self._armed = max(self.highest, lsn), True
        return self._advance()

    def confirm(self, lsn: int, sink: str) -> int:
        if lsn > self.mark and sink in self.sinks:
            self._known(lsn)
            self.confirmed[lsn][sink] += 1
        return self._advance()

    def _full(self, lsn: int) -> bool:
        need = self.observed[lsn] - self.self_acked[lsn]
        return self.observed[lsn] > 0 and all(self.confirmed[lsn][s] >= need for s in self.sinks)

    def _advance(self) -> int:
        n = 0
        while n < len(self.order) and self._full(self.order[n]) and not (self.strict and self.order[n] == self.highest):
            self.mark = self.order[n]
            n += 1
        for lsn in self.order[:n]:
            for d in (self.observed, self.self_acked, self.confirmed):
                d.pop(lsn, None)
        del self.order[:n]
        return self.mark

    def settle(self) -> int:
        """No more events of the highest LSN will come."""
        strict, self.strict = self.strict, False
        self._advance()
        self.strict = strict
        return self.mark

    def idle(self, position: int) -> bool:
        """Jump to a position of the source while nothing is pending. The first jump past all that was seen is refused once."""
        if self.order or position <= self.mark:
            return False
        if position > self.highest and self._armed:
            self._armed = False
            return False
        self.mark = position
        self.highest = max(self.highest, position)
        return True

    def hydrate(self, floor: int) -> int:
        """Resume from a stored position; never moves back."""
        self.mark = max(self.mark, floor)
        self.highest = max(self.highest, self.mark)
        self.order = [x for x in self.order if x > self.mark]
        return self.mark


def lag_series(samples: DataFrame, by: list[str], order: str, total: str) -> DataFrame:
    """Non-negative growth of a total between samples; the first sample grows by nothing."""
    w = Window.partitionBy(*by).orderBy(order)
    return samples.withColumn("delta", F.greatest(F.lit(0), F.col(total) - F.coalesce(F.lag(total).over(w), F.col(total))))


def unconfirmed(counts: DataFrame, most: int) -> DataFrame:
    """The first unconfirmed LSNs in order, with the events observed at each: a top-k, without a global sort."""
    return counts.filter("NOT confirmed").select("lsn", F.col("observed").alias("pending")).orderBy("lsn").limit(most)
