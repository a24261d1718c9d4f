"""Best-fit packing into sequences of several permitted lengths.

Pieces of documents are dealt by hash into shards of bounded size; each shard packs its pieces longest first into the open bin with
the least room that still fits. A new bin opens at the length that costs least for each token it can
still receive, for each of several policies that limit how long it may be; the policy whose bins, cut down to
the shortest permitted length that holds them, cost least in total is kept.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import materialize

LENGTHS = (512, 1024, 2048, 4096)
#: Pieces that a shard holds on average.
SHARD_ROWS = 20_000
#: Copies or pieces that one row stands for before they are dealt.
SPAN = 4096


def sequence_cost(length: int, longest: int, per_sequence: float = 32.0, attention: float = 0.1) -> float:
    """Cost of a sequence: its length, a little for attention over long ones, and a fixed part."""
    return per_sequence + length * (1 + attention * length / longest)


def pack_lengths(sizes: list[int], lengths: tuple[int, ...] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Bin of each size, its offset there, and the final length of each bin. sizes: descending, each from 1 to max(lengths)."""
    lengths = tuple(sorted(lengths))
    cost = {c: sequence_cost(c, lengths[-1]) for c in lengths}
    best: tuple[float, list[int], list[int], list[int]] | None = None
    for limit in lengths:
        bins, offsets, used, room = [], [], [], []
        by_room: dict[int, list[int]] = {}
        mask, left = 0, sum(sizes)
        for size in sizes:
            fits = mask >> size
            if fits:
                free = size + (fits & -fits).bit_length() - 1
                stack = by_room[free]
                b = stack.pop()
                if not stack:
                    mask ^= 1 << free
            else:
                allowed = [c for c in lengths if c >= size and c <= limit] or [next(c for c in lengths if c >= size)]
                b, free = len(used), min(allowed, key=lambda c: (cost[c] / min(c, left), c))
                used.append(0)
                room.append(free)
            bins.append(b)
            offsets.append(used[b])
            used[b] += size
            left -= size
            free -= size
            if free:
                by_room.setdefault(free, []).append(b)
                mask |= 1 << free
        final = [next(c for c in lengths if c >= u) for u in used]
        total = sum(cost[c] for c in final)
        if best is None or total < best[0]:
            best = (total, bins, offsets, final)
    return best[1], best[2], best[3]


def pack(counted: DataFrame, lengths: tuple[int, ...] = LENGTHS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Places every piece of every document: doc_id, piece, piece_start, n_tokens, shard, bin, bin_offset, seq_len.

    counted: doc_id and n_tokens (null or below 1 counts as 1, the end token); further columns of any name are left out. Documents
    longer than the longest length are cut into pieces of it and a rest. (shard, bin) names a sequence. Equal rows
    are counted first, then each is packed on its own, dealt over all shards; null doc_ids are kept. An empty table gives an
    empty result. Which of several equal rows is in which place can't be told, so reruns agree.
    """
    longest = max(lengths)
    n = F.greatest(F.coalesce(F.col("n_tokens").cast("long"), F.lit(1)), F.lit(1)).alias("n")
    rows, _ = materialize(counted.select(F.col("doc_id").cast("long").alias("doc_id"), n).groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("copies")), "counted")
    total = rows.agg(F.sum(F.col("copies") * F.ceil(F.col("n") / longest)).alias("t")).first()["t"] or 0
    shards = max(1, math.ceil(total / shard_rows))
    # many copies, and the pieces of a very long document, are dealt on before they are written out
    spans = rows.select("doc_id", "n", "copies", F.explode(F.expr(f"sequence(0L, copies - 1, {SPAN}L)")).alias("c0"), F.floor((F.col("n") - 1) / longest).alias("last"))
    spans = spans.select("*", F.explode(F.expr(f"sequence(0L, last, {SPAN}L)")).alias("p0")).hint("rebalance")
    each = spans.withColumn("copy", F.explode(F.expr(f"sequence(c0, least(c0 + {SPAN}L, copies) - 1)"))).withColumn("piece", F.explode(F.expr(f"sequence(p0, least(p0 + {SPAN}L - 1, last))")))
    size = F.least(F.lit(longest).cast("long"), F.col("n") - F.col("piece") * longest)
    cut = each.select(F.pmod(F.xxhash64("doc_id", "n", "copy", "piece"), F.lit(shards)).cast("int").alias("shard"), "doc_id", "piece", size.alias("n_tokens"))

    def run(group):
        group = group.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets, final = pack_lengths(group["n_tokens"].tolist(), lengths)
        group["bin"], group["bin_offset"] = bins, offsets
        group["seq_len"] = [final[b] for b in bins]
        group["piece_start"] = group["piece"] * longest
        return group[["doc_id", "piece", "piece_start", "n_tokens", "shard", "bin", "bin_offset", "seq_len"]]

    return cut.groupBy("shard").applyInPandas(run, "doc_id long, piece long, piece_start long, n_tokens long, shard int, bin long, bin_offset long, seq_len int")
