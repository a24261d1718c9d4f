"""Substring dedup by collinear chaining.

Texts are sampled into k-mer seeds of five words by minimisers, so any shared run of WINDOW + 4 words shares a seed. Each
seed's first occurrence in the corpus stands for all of them, so a seed that half of the corpus holds costs one match an
occurrence and not one a pair. The matches of two documents are chained in order with gap costs through a Fenwick tree, and chains are
aligned word by word on the texts, which finds passages that differ in places. Passages go from every document
but the one that has them first.

A seed's first occurrence may lie in another document than the rest of the passage. So the long run of words that starts at each
seed, as long as the shortest passage allows for, is matched with its own first occurrence as well; equal runs of few
distinct words are matched like any others. What is still open then, runs that are repeated but lie in no passage, is looked at once
more: all stretches of LEAST words around every occurrence of such a run are matched as a whole. So every exact repeat of LEAST words
or more is found, whatever its parts' first occurrences.

Passages that differ in places have no such stretch. So the seeds that are still in no passage are matched with all their earlier
occurrences, and not with the first alone. Where a seed has more than CROWD of them, its pairs with other seeds near it are matched
instead, since a chain has two seeds or more; and where a pair has more than CROWD occurrences, all of them are held against each other,
block by block, by the words between and around them. What comes of that grows with the occurrences and not with their pairs: of all passages
over one place, those are kept that cover the words of the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import discard, lean, materialize, partitions, small_batches, sweep

WORDS = 5
WINDOW = 12
#: Shortest passage, in words, and the least share of its words that agree in order.
LEAST = 50
SIMILARITY = 0.8
#: Cost of each word of gap on either side, against WORDS for a seed.
GAP = 0.05
#: Words around a chain in which its ends may lie; what goes on further has seeds of its own there.
MARGIN = WINDOW + WORDS + 40
#: Occurrences up to which a seed, or a pair of seeds, is matched with all its partners by a join. More go another way; none is left out.
CROWD = 32
#: Words between two seeds that may follow each other in a chain: what a seed gains pays for so much gap on both sides, and a chain starts within LEAST.
REACH = int(WORDS / GAP) + WINDOW
#: Occurrences of a crowded pair that one task holds against all others.
BLOCK = 1024

_R, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = np.ones(size, np.uint64)
        done, step = 1, np.uint64(base)
        while done < size:
            out[done : 2 * done] = out[:done] * step
            done, step = 2 * done, step * step
        have = _powers[base] = out
    return have[:n]


def split(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, cut at ASCII white space."""
    return (text or "").encode("utf-8").lower().split()


class Hashes:
    """Hashes of runs of words from one running sum over the bytes."""

    def __init__(self, words: list[bytes]):
        flat = np.frombuffer(b" ".join(words), np.uint8)
        self.n = len(words)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(flat) + 1, np.uint64)
            np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * _power(_R, len(flat)), out=self.sums[1:])
        size = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(size + 1) - 1
        self.starts = self.ends - size

    def runs(self, k: int) -> np.ndarray:
        """Hash of every k words in a row."""
        if self.n < k:
            return np.zeros(0, np.uint64)
        s, e = self.starts[: self.n - k + 1], self.ends[k - 1 :]
        with np.errstate(over="ignore"):
            h = (self.sums[e] - self.sums[s]) * _power(_INVERSE, int(s[-1]) + 1)[s]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xA0761D6478BD642F)
            return h ^ h >> np.uint64(32)


def minimisers(h: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the least hash of every window (fewer hashes than a window: of all)."""
    if not len(h):
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(h, min(window, len(h)))
    at = view.argmin(axis=1) + np.arange(len(view))
    return at[np.concatenate([[True], at[1:] != at[:-1]])]


def run_words(least: int) -> int:
    """Words of the run at a seed: any `least` words in a row hold a whole run, at the seed of their first window."""
    return max(WORDS, least - WINDOW + 1)


def seeds(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """seed, run, doc_id, pos: the minimisers of every whole text, and the hash of the long run that starts there (null: too few words)."""
    long = run_words(least)

    def run(batches):
        for b in batches:
            ids, found, runs, at = b.column(0).to_pylist(), [], [], []
            for t in b.column(1).to_pylist():
                w = split(t)
                hashes = Hashes(w)
                m = minimisers(hashes.runs(WORDS)) if len(w) >= WORDS else np.zeros(0, np.int64)
                h, r = hashes.runs(WORDS), hashes.runs(long)
                found.append(h[m])
                runs.append(pa.array(r[np.minimum(m, max(0, len(r) - 1))].view(np.int64) if len(r) else np.zeros(len(m), np.int64), mask=m >= len(r)))
                at.append(m)
            if not found:
                continue
            sizes = [len(m) for m in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found).view(np.int64)), pa.concat_arrays(runs), pa.array(np.repeat(np.array(ids, dtype=np.int64), sizes)), pa.array(np.concatenate(at).astype(np.int32))], names=["seed", "run", "doc_id", "pos"]
            )

    return docs.mapInArrow(lean(run), "seed long, run long, doc_id long, pos int")


def chain(pos: list[int], spos: list[int]) -> list[list[int]]:
    """Indexes of the matches of each chain, best chains first; a match is in one chain. Matches come sorted by pos.

    f(i) = WORDS + max(0, f(j) - GAP * (both gaps)) over j before i on both sides. With linear gaps, f(j) + GAP * (pos + spos) can
    be kept in a Fenwick tree of prefix maxima over the ranks of spos.
    """
    n = len(pos)
    rank = {v: i + 1 for i, v in enumerate(sorted(set(spos)))}
    size = len(rank)
    tree: list[tuple[float, int]] = [(-1.0, -1)] * (size + 1)
    f, before = [0.0] * n, [-1] * n
    i = 0
    while i < n:
        j = i
        while j < n and pos[j] == pos[i]:  # equal positions can't follow each other
            r, best = rank[spos[j]] - 1, (-1.0, -1)
            while r > 0:
                if tree[r] > best:
                    best = tree[r]
                r &= r - 1
            gain = best[0] - GAP * (pos[j] + spos[j]) if best[1] >= 0 else 0.0
            f[j] = WORDS + max(gain, 0.0)
            before[j] = best[1] if gain > 0 else -1
            j += 1
        for x in range(i, j):
            r, v = rank[spos[x]], (f[x] + GAP * (pos[x] + spos[x]), x)
            while r <= size:
                if v > tree[r]:
                    tree[r] = v
                r += r & -r
        i = j
    used, chains = [False] * n, []
    for end in sorted(range(n), key=lambda x: (-f[x], x)):
        if used[end]:
            continue
        path, x = [], end
        while x >= 0 and not used[x]:
            used[x] = True
            path.append(x)
            x = before[x]
        chains.append(path[::-1])
    return chains


def path_of(pos: list[int], spos: list[int]) -> list[list[int]]:
    """chain() for matches on one diagonal, where the best match before is always the last one."""
    out, f = [[0]], float(WORDS)
    for i in range(1, len(pos)):
        gain = f - 2 * GAP * (pos[i] - pos[i - 1])
        if gain > 0:
            out[-1].append(i)
            f = WORDS + gain
        else:
            out.append([i])
            f = float(WORDS)
    return out


CHAIN = "doc_id long, source long, pos array<int>, spos array<int>, first int, last int, single boolean"
CHAIN_ARROW = pa.schema([("doc_id", pa.int64()), ("source", pa.int64()), ("pos", pa.list_(pa.int32())), ("spos", pa.list_(pa.int32())), ("first", pa.int32()), ("last", pa.int32()), ("single", pa.bool_())])


def with_first(found: DataFrame, key: str, *more: str) -> DataFrame:
    """doc_id, pos, source, spos (and more columns): every occurrence of a repeated key with the first one in the corpus, which is its own."""
    first = found.groupBy(key).agg(F.min(F.struct("doc_id", "pos")).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(key, "f")
    first, _ = materialize(first, f"repeated-{key}s")  # so that both sides of the join are shuffles, which hot keys can split
    return found.join(first.hint("merge"), key).select(*more, "doc_id", "pos", F.col("f.doc_id").alias("source"), F.col("f.pos").alias("spos"))


def later() -> Column:
    return (F.col("doc_id") != F.col("source")) | (F.col("pos") > F.col("spos"))


def whole_runs(docs: DataFrame, spots: DataFrame, least: int) -> DataFrame:
    """whole, doc_id, pos, row: hashes of all stretches of `least` words that hold one of the runs at spots (doc_id, pos)."""
    at = spots.groupBy("doc_id").agg(F.collect_set("pos").alias("at"))
    both = docs.join(at.hint("merge"), "doc_id").select("doc_id", "text", "at", F.xxhash64("text").alias("row"))
    back = least - run_words(least)

    def run(batches):
        for b in batches:
            ids, texts, seen = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)
            for i, t in enumerate(texts):
                h = Hashes(split(t)).runs(least)
                where = np.unique((seen[i].values.to_numpy()[:, None] - np.arange(back + 1)[None, :]).ravel())
                where = where[(where >= 0) & (where < len(h))]
                if len(where):
                    yield pa.RecordBatch.from_arrays([pa.array(h[where].view(np.int64)), pa.array(np.full(len(where), ids[i], np.int64)), pa.array(where.astype(np.int32)), pa.repeat(b.column(3)[i], len(where))], names=["whole", "doc_id", "pos", "row"])

    return both.mapInArrow(lean(run), "whole long, doc_id long, pos int, row long")


def stretches(matched: DataFrame, least: int) -> DataFrame:
    """Passages (doc_id, row, s, e, source, t, u, like) that stretches of `least` words make which go on in step with their first occurrence."""
    step = F.col("pos") - F.row_number().over(Window.partitionBy("doc_id", "row", "source", "off").orderBy("pos"))
    rows = matched.filter(later()).select("doc_id", "row", "pos", "source", "spos", (F.col("pos") - F.col("spos")).alias("off")).distinct()
    joined = rows.withColumn("g", step).groupBy("doc_id", "row", "source", "off", "g").agg(F.min("pos").alias("s"), (F.max("pos") + least).alias("e"))
    # a passage may not overlap its own source
    apart = F.when(F.col("doc_id") == F.col("source"), F.least(F.col("e"), F.col("s") + F.col("off"))).otherwise(F.col("e"))
    out = joined.withColumn("e", apart).filter(F.col("e") - F.col("s") >= least)
    return out.select("doc_id", "row", F.col("s").cast("int").alias("s"), F.col("e").cast("int").alias("e"), "source", (F.col("s") - F.col("off")).cast("int").alias("t"), (F.col("e") - F.col("off")).cast("int").alias("u"), F.lit(1.0).alias("like"))


def chains(matches: DataFrame, least: int = LEAST) -> DataFrame:
    """Chains that may hold a passage: their matches and the stretch of the source to look at. matches: doc_id, source, pos, spos, size."""
    ordered = matches.repartition(partitions(matches.sparkSession), "doc_id").sortWithinPartitions("doc_id", "source", "pos", "spos")
    names = ["doc_id", "source", "pos", "spos", "size"]

    def of_pair(doc, source, pos, spos, size):
        slopes = pos - spos
        p, s, long = pos.tolist(), spos.tolist(), size > WORDS
        found = path_of(p, s) if (slopes == slopes[0]).all() and len(set(p)) == len(p) else chain(p, s)
        for path in found:
            x, y = [p[i] for i in path], [s[i] for i in path]
            run = bool(long[path].any())
            if run or (len(path) > 1 and max(x[-1] - x[0], y[-1] - y[0]) + WORDS + 2 * (WINDOW + WORDS) >= least):
                yield doc, source, x, y, max(0, y[0] - MARGIN), y[-1] + int(size[path[-1]]) + MARGIN, len(path) == 1

    def finish(parts):
        cols = [np.concatenate([q[i] for q in parts]) for i in range(5)]
        return of_pair(int(cols[0][0]), int(cols[1][0]), *cols[2:])

    def run(batches):
        held: list[list[np.ndarray]] = []  # pieces of the pair that may go on
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(names.index(n)).to_numpy(zero_copy_only=False) for n in names]
            starts = np.flatnonzero(np.concatenate([[True], (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])]))
            ends = np.append(starts[1:], len(cols[0]))
            out, lo = [], 0
            if held and (held[0][0][0], held[0][1][0]) == (cols[0][0], cols[1][0]):
                held.append([c[: ends[0]] for c in cols])
                lo = 1
            if held and (len(starts) > lo):
                out.extend(finish(held))
                held = []
            if len(starts) > lo:
                longest = np.maximum.reduceat(cols[4], starts)
                for k in np.flatnonzero((ends - starts > 1) | (longest > WORDS)):
                    if lo <= k < len(starts) - 1:
                        i, j = starts[k], ends[k]
                        out.extend(of_pair(int(cols[0][i]), int(cols[1][i]), *(c[i:j] for c in cols[2:])))
                held = [[c[starts[-1] :] for c in cols]]
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(CHAIN_ARROW.names, r, strict=True)) for r in out], schema=CHAIN_ARROW)
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(CHAIN_ARROW.names, r, strict=True)) for r in finish(held)], schema=CHAIN_ARROW)

    return ordered.mapInArrow(lean(run), CHAIN)


def word_codes(words: list[bytes]) -> np.ndarray:
    return (Hashes(words).runs(1) >> np.uint64(32)).astype(np.uint32) if words else np.zeros(0, np.uint32)


def inner(a: np.ndarray, b: np.ndarray) -> int:
    """Words two stretches between anchors share in order (longest common subsequence), by rows of bits."""
    if not len(a) or not len(b):
        return 0
    if len(a) == len(b):
        same = int((a == b).sum())
        if same == len(a):
            return same
    at: dict[int, int] = {}
    for i, x in enumerate(b.tolist()):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for x in a.tolist():
        hit = row & at.get(x, 0)
        if hit:
            row = (row + hit | row - hit) & full
    return len(b) - row.bit_count()


def extend(a: np.ndarray, b: np.ndarray, drop: int = 6) -> tuple[int, int]:
    """How far two stretches agree from their start, past single differences: (length, words that agree)."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    score = np.cumsum(np.where(a[:n] == b[:n], 1, -3))
    fall = np.flatnonzero(np.maximum(np.maximum.accumulate(score), 0) - score > drop)
    stop = int(fall[0]) + 1 if len(fall) else n
    best = int(score[:stop].argmax())
    return (best + 1, int((a[: best + 1] == b[: best + 1]).sum())) if score[best] > 0 else (0, 0)


def align(a: np.ndarray, b: np.ndarray, pos: list[int], spos: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Passages (start, end, source start, source end, agreeing words) that a chain gives on two word sequences.

    Anchors that the texts don't bear out are left out. A passage ends where a gap between anchors agrees too little.
    """
    anchors = [(p, s) for p, s in zip(pos, spos, strict=True) if s >= 0 and p + WORDS <= len(a) and s + WORDS <= len(b) and (a[p : p + WORDS] == b[s : s + WORDS]).all()]
    out: list[list[int]] = []
    for p, s in anchors:
        if out:
            x = out[-1]
            da, db = p - x[1], s - x[3]
            if da <= 0 or db <= 0:
                if p - x[1] == s - x[3]:  # the anchors overlap on one diagonal
                    x[4] += WORDS + da
                    x[1], x[3] = p + WORDS, s + WORDS
                    continue
                shift = max(-da, -db, 0)
                if shift >= WORDS:
                    continue
                gap = inner(a[x[1] : p + shift], b[x[3] : s + shift])
                x[4] += gap + WORDS - shift
                x[1], x[3] = p + WORDS, s + WORDS
                continue
            gap = inner(a[x[1] : p], b[x[3] : s])
            if gap >= 0.5 * max(da, db) - 8:
                x[4] += gap + WORDS
                x[1], x[3] = p + WORDS, s + WORDS
                continue
        out.append([p, p + WORDS, s, s + WORDS, WORDS])
    for i, x in enumerate(out):
        low, slow = (out[i - 1][1], out[i - 1][3]) if i else (0, 0)
        n, same = extend(a[low : x[0]][::-1], b[slow : x[2]][::-1])
        x[0], x[2], x[4] = x[0] - n, x[2] - n, x[4] + same
        n, same = extend(a[x[1] :], b[x[3] :])
        x[1], x[3], x[4] = x[1] + n, x[3] + n, x[4] + same
    return [tuple(x) for x in out]


def passages_of(words: list[bytes], doc: int, found: list[dict], least: int = LEAST, similarity: float = SIMILARITY) -> list[tuple]:
    """(start, end, source, source start, source end, similarity) of a document's passages that come from elsewhere.

    Chains of a single long run come last, and not where a passage covers the run already.
    """
    codes, out = word_codes(words), []
    covered, long = np.zeros(len(codes), bool), run_words(least)
    for c in sorted(found, key=lambda c: (c["single"], c["source"], c["first"], c["pos"], c["spos"])):
        first = c["first"]
        if c["single"] and covered[c["pos"][0] : c["pos"][0] + long].all():
            continue
        source = np.frombuffer(c["codes"], np.uint32)
        for s, e, t, u, same in align(codes, source, c["pos"], [x - first for x in c["spos"]]):
            like = same / max(e - s, u - t)
            if e - s >= least and like >= similarity and not (c["source"] == doc and t + first + (u - t) > s):
                out.append((s, e, c["source"], t + first, u + first, like))
                covered[s:e] = True
    return sorted(set(out))


PASSAGE = "doc_id long, row long, s int, e int, source long, t int, u int, like double"
PASSAGE_ARROW = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]


def aligned(slim: DataFrame, linked: DataFrame, least: int, similarity: float) -> DataFrame:
    """The passages (PASSAGE) that chains (CHAIN) give on the texts of slim: doc_id, text."""
    wanted = linked.select("source", "first", "last").distinct().groupBy("source", F.pmod(F.xxhash64("first", "last"), F.lit(16)).alias("salt")).agg(F.collect_list(F.struct("first", "last")).alias("spots"))
    dealt = slim.repartition(partitions(slim.sparkSession), "doc_id")
    asked = dealt.join(wanted.hint("merge"), dealt["doc_id"] == wanted["source"]).select("source", "text", "spots")
    pieces = pa.schema([("source", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("codes", pa.binary())])

    def slices(batches):
        for b in batches:
            rows = []
            for source, text, spots in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                codes = word_codes(split(text))
                rows.extend({"source": source, "first": x["first"], "last": x["last"], "codes": codes[x["first"] : x["last"]].tobytes()} for x in spots)
            yield pa.RecordBatch.from_pylist(rows, schema=pieces)

    parts = asked.mapInArrow(lean(slices), "source long, first int, last int, codes binary")
    per_doc = linked.join(parts, ["source", "first", "last"]).groupBy("doc_id").agg(F.collect_list(F.struct("source", "first", "pos", "spos", "codes", "single")).alias("found"))
    both = dealt.join(per_doc.hint("merge"), "doc_id").select("doc_id", "text", "found", F.xxhash64("text").alias("row"))

    def passages(batches):
        for b in batches:
            rows = [(d, h, *p) for d, x, f, h in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True) for p in passages_of(split(x), d, f, least, similarity)]
            columns = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, PASSAGE_ARROW, strict=True)], names=[x.split()[0] for x in PASSAGE.split(", ")])

    return both.mapInArrow(lean(passages), PASSAGE)


def occurrences(matched: DataFrame, passages: DataFrame, least: int) -> DataFrame:
    """source, spos (naming a seed by its first occurrence), doc_id, pos, open: whether the place comes later and lies in no passage.

    A place whose seed comes first in the same document counts as open only where a passage and its source have room before it.
    Where a seed comes again within a window, over and over, as in text of few distinct words, or again and again at one distance, as in
    a line that is repeated, the ends of such a run stand for it.
    """
    spans = passages.groupBy("doc_id").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    inside = F.exists("spans", lambda x: (x["s"] <= F.col("pos")) & (F.col("pos") + WORDS <= x["e"]))
    flagged = matched.select("source", "spos", "doc_id", "pos").join(spans.hint("merge"), "doc_id", "left")
    flagged = flagged.select("source", "spos", "doc_id", "pos", (later() & room(least) & ~F.coalesce(inside, F.lit(False))).alias("open"))
    one = Window.partitionBy("doc_id", "source", "spos").orderBy("pos")
    back, ahead = F.col("pos") - F.lag("pos").over(one), F.lead("pos").over(one) - F.col("pos")
    amid = (F.greatest(back, ahead) <= WINDOW) | ((back == ahead) & (back <= least))
    return flagged.withColumn("amid", F.coalesce(back.isNotNull() & ahead.isNotNull() & amid, F.lit(False))).filter("NOT amid").drop("amid")


def room(least: int, pos: str = "pos", spos: str = "spos") -> Column:
    """Whether a match may be part of a passage: one from the same document lies behind its source, which has least / 2 words at the very least."""
    return (F.col("doc_id") != F.col("source")) | (F.col(pos) - F.col(spos) >= least // 2)


def crowds(rows: DataFrame, *key: str) -> DataFrame:
    """n, the number of rows, of each key that has several of which one is open at least."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max("open").alias("any")).filter("n > 1 AND any").drop("any")


def outward(same: np.ndarray, loss: int, drop: int | None) -> tuple[np.ndarray, np.ndarray]:
    """extend() for many stretches at once, each word that differs a loss; same: whether words agree, a row for each. No drop: past any differences."""
    score = np.cumsum(np.where(same, 1, -loss), axis=1, dtype=np.int32)
    if drop is not None:
        over = np.maximum.accumulate(np.maximum(score, 0), axis=1) - score > drop
        score[np.logical_or.accumulate(over, axis=1)] = 0
    rows, at = np.arange(len(same)), score.argmax(axis=1)
    good = score[rows, at] > 0
    return np.where(good, at + 1, 0), np.where(good, np.cumsum(same, axis=1, dtype=np.int32)[rows, at], 0)


class Windows:
    """Words around the pairs of seeds at pos and pos2, cut from MARGIN words before them to MARGIN words after; pad: the code of no word."""

    def __init__(self, rows: pa.Table, pad: int):
        self.doc, self.row, self.pos, self.pos2 = (rows.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "row", "pos", "pos2"))
        self.gap = self.pos2 - self.pos
        cut = [np.frombuffer(w, np.uint32) for w in rows.column("words").to_pylist()]
        self.seeds = np.array([np.concatenate([w[MARGIN : MARGIN + WORDS], w[-MARGIN - WORDS : -MARGIN]]) for w in cut], np.uint32).reshape(len(cut), 2 * WORDS)
        # outward from the two ends of the pair, and inward: after the first seed and, backwards, before the second
        sides = [w[:MARGIN][::-1] for w in cut], [w[-MARGIN:] for w in cut], [w[MARGIN + WORDS :][:MARGIN] for w in cut], [w[: -MARGIN - WORDS][-MARGIN:][::-1] for w in cut]
        self.before, self.after, self.right, self.left = (np.array(x, np.uint32).reshape(len(cut), MARGIN) for x in sides)
        for side in (self.before, self.after, self.right, self.left):
            side[side == 0] = pad
        self.mid = [w[MARGIN + WORDS : -MARGIN - WORDS].tobytes() for w in cut]


def furthest(found: list[tuple]) -> list[tuple]:
    """Of passages (s, e, ...) over one place, those that cover all that the others do: the first to begin and the last to end."""
    a, b = min(found, key=lambda x: (x[0], -x[1], *x[2:])), min(found, key=lambda x: (-x[1], x[0], *x[2:]))
    return [a] if a[:2] == b[:2] else [a, b]


def compare_windows(x: Windows, y: Windows, least: int, similarity: float, kept: dict[tuple[int, int], list[tuple]]) -> None:
    """Adds to kept the passages (s, e, source, spos, spos2, t, u, like) that pairs of x have with earlier ones of y, as far as they cover more.

    Two pairs are aligned by the words between the seeds and step by step outward, as align() does, or step by step from one of the seeds; and
    outward as far as SIMILARITY lets a passage gain, since chains get past differences by further seeds. kept: for the index
    of a pair in x and each of these ways, what furthest() leaves of all passages.
    """
    shared: dict[tuple[bytes, bytes], int] = {}

    def between(a: bytes, b: bytes) -> int:
        if (a, b) not in shared:
            shared[a, b] = inner(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32))
        return shared[a, b]

    for i in range(len(x.doc)):
        d, p, p2, g = int(x.doc[i]), int(x.pos[i]), int(x.pos2[i]), int(x.gap[i])
        before, after = y.before == x.before[i], y.after == x.after[i]
        # at most the shorter gap agrees
        most = np.count_nonzero(before, axis=1) + np.count_nonzero(after, axis=1) + np.minimum(y.gap, g) + WORDS
        k = np.flatnonzero((most >= similarity * least - 1e-6) & ((y.doc < d) | (y.doc == d) & (y.pos < p) & (y.pos2 < p2)))
        k = k[(y.seeds[k] == x.seeds[i]).all(axis=1)]
        if not len(k):
            continue
        doc, gap, spos, spos2 = y.doc[k], y.gap[k], y.pos[k], y.pos2[k]
        sides, ways = [before[k], after[k], y.right[k] == x.right[i], y.left[k] == x.left[i]], []
        for loss, drop in ((3, 6), (4, None)):
            (nb, sb), (na, sa), (nr, sr), (nl, sl) = (outward(side, loss, drop) for side in sides)
            ways += [
                (p - nb, p2 + WORDS + na, spos - nb, spos2 + WORDS + na, sb + sa + np.minimum(gap, g) + WORDS),
                (p - nb, p + WORDS + nr, spos - nb, spos + WORDS + nr, sb + sr + WORDS),
                (p2 - nl, p2 + WORDS + na, spos2 - nl, spos2 + WORDS + na, sl + sa + WORDS),
            ]
        for way, (s, e, t, u, same) in enumerate(ways):
            size = np.maximum(e - s, u - t)
            may = np.flatnonzero((e - s >= least) & (same / size >= similarity) & ((doc != d) | (u <= s)))
            found = kept.get((i, way), [])
            for order in ((spos[may], doc[may], -e[may], s[may]), (spos[may], doc[may], s[may], -e[may])):
                for m in may[np.lexsort(order)].tolist():
                    n = int(same[m])
                    if way % 3 == 0 and min(g, gap[m]) > WORDS:
                        n += between(x.mid[i], y.mid[k[m]]) + WORDS - min(g, int(gap[m]))
                    if n / size[m] >= similarity:
                        found = [*found, (int(s[m]), int(e[m]), int(doc[m]), int(spos[m]), int(spos2[m]), int(t[m]), int(u[m]), n / int(size[m]))]
                        break
            if found:
                kept[i, way] = furthest(found)


HELD = "doc_id long, source long, pos int, spos int, pos2 int, spos2 int, row long, s int, e int, t int, u int, like double"
HELD_ARROW = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64(), *[pa.int32()] * 4, pa.float64()]


def held_together(slim: DataFrame, pairs: DataFrame, least: int, similarity: float) -> DataFrame:
    """HELD: the places of crowded pairs (key, n, doc_id, pos, pos2, open) that lie in passages, each with the few passages that cover all of them.

    Every open row of a key is compared with all its rows, block by block, by the words between and around the seeds.
    There are as many rows as places in passages, and not as many as pairs of them.
    """
    at = pairs.groupBy("doc_id").agg(F.collect_list(F.struct("key", "n", "pos", "pos2", "open")).alias("at"))
    both = slim.join(at.hint("merge"), "doc_id").select("doc_id", "text", "at", F.xxhash64("text").alias("row"))

    def around(batches):
        for b in batches:
            rows = []
            for doc, text, found, row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                codes = word_codes(split(text))
                wide = np.concatenate([np.zeros(MARGIN, np.uint32), codes, np.zeros(MARGIN, np.uint32)])  # 0: no word
                for x in found:
                    i, j = x["pos"] + MARGIN, x["pos2"] + WORDS + MARGIN
                    if j <= len(wide) - MARGIN:
                        rows.append({"key": x["key"], "n": x["n"], "doc_id": doc, "row": row, "pos": x["pos"], "pos2": x["pos2"], "open": x["open"], "words": wide[i - MARGIN : j + MARGIN].tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=shape)

    shape = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("pos", pa.int32()), ("pos2", pa.int32()), ("open", pa.bool_()), ("words", pa.binary())])
    seen, seen_path = materialize(both.mapInArrow(lean(around), "key long, n long, doc_id long, row long, pos int, pos2 int, open boolean, words binary"), "crowded-words", small=True)
    blocks, names = F.ceil(F.col("n") / BLOCK).cast("int"), ["asks", "doc_id", "row", "pos", "pos2", "words"]
    asking = seen.filter("open").withColumn("asks", F.lit(True)).select("key", F.pmod(F.xxhash64("doc_id", "pos", "pos2"), blocks).cast("int").alias("block"), *names)
    asked = seen.withColumn("asks", F.lit(False)).select("key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), *names)
    dealt = asking.unionByName(asked).repartition(partitions(slim.sparkSession), "key", "block").sortWithinPartitions("key", "block", F.desc("asks"), "doc_id", "pos", "pos2")

    def finish(x, kept):
        rows = []
        for i in sorted({i for i, _ in kept}):
            chosen = sorted({f for way in range(6) for f in kept.get((i, way), [])})
            chosen = [a for a in chosen if not any(b[0] <= a[0] and a[1] <= b[1] and b[:2] != a[:2] for b in chosen)]
            rows.extend((int(x.doc[i]), f[2], int(x.pos[i]), f[3], int(x.pos2[i]), f[4], int(x.row[i]), *f[:2], *f[5:]) for f in chosen)
        columns = list(zip(*rows, strict=True)) or [()] * len(HELD_ARROW)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, HELD_ARROW, strict=True)], names=[c.split()[0] for c in HELD.split(", ")])

    def compare(batches):
        block, asks, x, kept = None, [], None, {}
        for b in batches:
            if not b.num_rows:
                continue
            rows = pa.Table.from_batches([b])
            of = [rows.column(c).to_numpy() for c in ("key", "block", "asks")]
            starts = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in of])]))
            for i, j in zip(starts, [*starts[1:], b.num_rows], strict=True):
                if block != (of[0][i], of[1][i]):
                    if kept:
                        yield finish(x, kept)
                    block, asks, x, kept = (of[0][i], of[1][i]), [], None, {}
                if of[2][i]:
                    asks.append(rows.slice(i, j - i))
                elif asks:
                    x = x or Windows(pa.concat_tables(asks), 0)
                    compare_windows(x, Windows(rows.slice(i, j - i), 1), least, similarity, kept)
        if kept:
            yield finish(x, kept)

    held, _ = materialize(dealt.mapInArrow(lean(compare), HELD), "held-together", small=True)
    discard(slim.sparkSession, seen_path)
    sweep(slim.sparkSession)
    return held


def all_partners(slim: DataFrame, places: DataFrame, least: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Matches (doc_id, source, pos, spos, size) of the open places (of occurrences()) with earlier occurrences of their seeds, and PASSAGE.

    Up to CROWD occurrences all are matched, as far as two make a chain. Of more, those that held_together() finds, whose passages are given too.
    """
    spark = slim.sparkSession
    counts, counts_path = materialize(crowds(places, "source", "spos"), "open-seeds", small=True)
    found, _ = materialize(places.join(counts.hint("merge"), ["source", "spos"]).select(F.xxhash64("source", "spos").alias("seed"), "n", "doc_id", "pos", "open"), "open-places", small=True)
    discard(spark, counts_path)
    sweep(spark)
    x, y = (found.filter(F.col("n") <= CROWD).select("seed", *[F.col(c).alias(f"{k}{c}") for c in ("doc_id", "pos", "open")]) for k in "xy")
    before = (F.col("ydoc_id") < F.col("xdoc_id")) | ((F.col("ydoc_id") == F.col("xdoc_id")) & (F.col("ypos") < F.col("xpos")))
    plain = x.filter("xopen").join(y.hint("merge"), "seed").filter(before).select(F.col("xdoc_id").alias("doc_id"), F.col("ydoc_id").alias("source"), F.col("xpos").alias("pos"), F.col("ypos").alias("spos"))

    # pairs of which one seed is crowded at least; seeds of two next stretches of REACH words may be near each other
    stretch = F.floor(F.col("pos") / REACH)
    a = found.select("doc_id", stretch.alias("stretch"), *[F.col(c).alias(f"a{c}") for c in ("seed", "n", "pos", "open")])
    b = found.select("doc_id", F.explode(F.array(stretch - 1, stretch)).alias("stretch"), *[F.col(c).alias(f"b{c}") for c in ("seed", "n", "pos", "open")])
    close = a.join(b.hint("merge"), ["doc_id", "stretch"]).filter((F.greatest("an", "bn") > CROWD) & (F.col("bpos") > F.col("apos")) & (F.col("bpos") <= F.col("apos") + REACH))
    keyed, keyed_path = materialize(close.select(F.xxhash64("aseed", "bseed").alias("key"), "doc_id", F.col("apos").alias("pos"), F.col("bpos").alias("pos2"), (F.col("aopen") | F.col("bopen")).alias("open")), "open-pairs", small=True)
    several, several_path = materialize(crowds(keyed, "key"), "open-keys", small=True)
    pairs, _ = materialize(keyed.join(several.hint("merge"), "key"), "counted-pairs", small=True)
    discard(spark, keyed_path, several_path)
    sweep(spark)
    x, y = (pairs.filter(F.col("n") <= CROWD).select("key", *[F.col(c).alias(f"{k}{c}") for c in ("doc_id", "pos", "pos2", "open")]) for k in "xy")
    before = (F.col("ydoc_id") < F.col("xdoc_id")) | ((F.col("ydoc_id") == F.col("xdoc_id")) & (F.col("ypos") < F.col("xpos")) & (F.col("ypos2") < F.col("xpos2")))
    few = x.filter("xopen").join(y.hint("merge"), "key").filter(before).select(*[F.col(f"{k}{c}").alias(n) for k, c, n in (("x", "doc_id", "doc_id"), ("y", "doc_id", "source"), ("x", "pos", "pos"), ("y", "pos", "spos"), ("x", "pos2", "pos2"), ("y", "pos2", "spos2"))])
    held = held_together(slim, pairs.filter(F.col("n") > CROWD), least, similarity)
    ends = few.select("doc_id", "source", F.explode(F.array(F.struct("pos", "spos"), F.struct(F.col("pos2").alias("pos"), F.col("spos2").alias("spos")))).alias("m")).select("doc_id", "source", "m.pos", "m.spos")
    # whatever else of the places around agrees with the partner that was chosen
    links = held.select(F.col("doc_id").alias("d"), "source", *[F.col(c).alias(f"h{c}") for c in ("pos", "pos2", "spos", "spos2")])
    links = links.withColumn("stretch", F.explode(F.sequence(F.floor(F.col("hpos") / REACH) - 1, F.floor(F.col("hpos2") / REACH) + 1)))
    asked = found.select("seed", F.col("doc_id").alias("d"), "pos", stretch.alias("stretch")).join(links.hint("merge"), ["d", "stretch"]).filter(F.col("pos").between(F.col("hpos") - REACH, F.col("hpos2") + REACH))
    met = asked.join(found.select("seed", F.col("doc_id").alias("source"), F.col("pos").alias("spos")).hint("merge"), ["seed", "source"]).filter(F.col("spos").between(F.col("hspos") - REACH, F.col("hspos2") + REACH))
    met = met.select(F.col("d").alias("doc_id"), "source", "pos", "spos").filter(later())
    return plain.unionByName(ends).unionByName(met).distinct().withColumn("size", F.lit(WORDS)), held.select(*[c.split()[0] for c in PASSAGE.split(", ")])


def find(docs: DataFrame, least: int = LEAST, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, row, s, e, source, t, u, like: each repeated passage, from word s to word e, and its place in its source. row: xxhash64 of the text."""
    spark = docs.sparkSession
    long = run_words(least)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id IS NOT NULL")
    small_batches(spark)
    found, seeds_path = materialize(seeds(slim, least), "seeds")
    matched, matched_path = materialize(with_first(found, "seed", "run"), "matched")
    discard(spark, seeds_path)
    sweep(spark)
    named = matched.filter("run IS NOT NULL").select("run", "doc_id", "pos", F.struct("source", "spos").alias("seeded"))
    runs, runs_path = materialize(with_first(named, "run", "run", "seeded"), "runs")
    sweep(spark)
    by_seed = matched.filter(later()).select("doc_id", "source", "pos", "spos", F.lit(WORDS).alias("size"))
    by_run = runs.filter(later() & (F.col("seeded") != F.struct("source", "spos"))).select("doc_id", "source", "pos", "spos", F.lit(long).alias("size"))
    linked, linked_path = materialize(chains(by_seed.unionByName(by_run), least), "chains")
    sweep(spark)

    chained, _ = materialize(aligned(slim, linked, least, similarity), "chained")
    discard(spark, linked_path)
    sweep(spark)

    spans = chained.groupBy("doc_id").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    inside = F.exists("spans", lambda x: (x["s"] <= F.col("pos")) & (F.col("pos") + long <= x["e"]))
    loose, _ = materialize(runs.filter(later()).join(spans, "doc_id", "left").filter(~F.coalesce(inside, F.lit(False))).select("run").distinct(), "open-runs")
    spots, _ = materialize(runs.join(loose, "run").select("doc_id", "pos"), "open-spots", small=True)
    rest = stretches(with_first(whole_runs(slim, spots, least), "whole", "row"), least).join(spans, "doc_id", "left")
    known = F.exists("spans", lambda x: (x["s"] <= F.col("s")) & (F.col("e") <= x["e"]))
    # of the stretches that begin within half their least length of each other, the first and the furthest cover all others
    whole, near = F.struct(*[F.col(c) for c in chained.columns]), F.floor(F.col("s") / max(1, least // 2))
    few = rest.filter(~F.coalesce(known, F.lit(False))).groupBy("doc_id", "row", near).agg(F.min_by(whole, F.struct("s", -F.col("e"), "source")).alias("a"), F.max_by(whole, F.struct("e", -F.col("s"), "source")).alias("b"))
    more, _ = materialize(few.select(F.inline(F.array_distinct(F.array("a", "b")))), "stretches", small=True)
    discard(spark, runs_path)
    sweep(spark)

    exact = chained.unionByName(more)
    places, places_path = materialize(occurrences(matched, exact, least), "places")  # it is read twice
    discard(spark, matched_path)
    sweep(spark)
    partners, held = all_partners(slim, places, least, similarity)
    met, _ = materialize(partners, "all-matches")
    discard(spark, places_path)
    sweep(spark)
    again, _ = materialize(chains(met, least), "more-chains", small=True)
    other, _ = materialize(aligned(slim, again, least, similarity), "more-chained", small=True)
    sweep(spark)
    # chains go further than two pairs of seeds, so most of what was held together is in them
    around = other.groupBy("doc_id", "row").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    alone = held.join(around.hint("merge"), ["doc_id", "row"], "left").filter(~F.coalesce(known, F.lit(False))).select(*other.columns)
    # rows that repeat a doc_id find the same passages again
    return exact.unionByName(other).unionByName(alone).distinct()


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; white space before a span stays, so the rest keeps its lines."""
    import re

    if not spans:
        return text
    data = text.encode("utf-8")
    at = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    out, done = [], 0
    for s, e in sorted(spans):
        a, b = at[s][0], at[e - 1][1]
        out.append(data[done : max(a, done)])
        done = max(done, b)
    return b"".join([*out, data[done:]]).decode("utf-8").strip()


def repeated_passages(docs: DataFrame, least: int = LEAST, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, start_word, n_words, source_doc_id, source_start, source_words, similarity: a row for each repeated passage.

    The source is the document (or the place in the same document) that has the passage's seeds first, by doc_id and position.
    Null and short texts have no passages, very long ones are read whole; documents with null ids take no part; rows of one doc_id count
    as one document, each with its own passages; an empty table gives an empty result; further columns of any
    name play no part. Overlapping passages from different sources are each returned; of exact stretches that only
    the second look finds, as many as cover all of them.
    """
    found = find(docs, least, similarity)
    return found.drop("row").distinct().select("doc_id", F.col("s").alias("start_word"), (F.col("e") - F.col("s")).alias("n_words"), F.col("source").alias("source_doc_id"), F.col("t").alias("source_start"), (F.col("u") - F.col("t")).alias("source_words"), F.col("like").alias("similarity"))


def remove_repeated(docs: DataFrame, least: int = LEAST, similarity: float = SIMILARITY) -> DataFrame:
    """docs with each repeated passage cut out of all documents but its source; documents left without words go.

    Documents with null ids, and null or empty texts that were so before, stay as they are; rows of one doc_id are
    cut each by its own text. n_chars, if there, is brought up to date. An empty table stays empty; further columns keep their names and values.
    """
    spark = docs.sparkSession
    spans, _ = materialize(find(docs, least, similarity).groupBy("doc_id", "row").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "spans")
    row, cut = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("hash")), spans.select(F.col("doc_id").alias("id"), F.col("row").alias("hash"), "spans")
    joined = row.join(cut.hint("merge"), ["id", "hash"], "left").select("doc.*", F.col("spans").alias("_tm_spans"))
    place, width = docs.columns.index("text"), len(docs.columns)

    def remove(batches):
        for b in batches:
            texts, found = b.column(place).to_pylist(), b.column(width)
            keep = np.ones(b.num_rows, bool)
            for i in np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False)).tolist():
                if texts[i] is None:
                    continue
                before = texts[i]
                texts[i] = without(before, [(x["s"], x["e"]) for x in found[i].as_py()])
                keep[i] = bool(texts[i]) or not before
            columns = [b.column(i) for i in range(width)]
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names[:width]).filter(pa.array(keep))

    small_batches(spark)
    cleaned = joined.mapInArrow(lean(remove), docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(kind))
    return cleaned
