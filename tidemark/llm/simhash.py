"""SimHash near-duplicate groups through BK-trees.

Distinct fingerprints are dealt into shards by the bits they would have to share with any partner within the
radius, so a shard's tree is all that its members must search. In a shard's BK-tree a child hangs at its integer Hamming
distance to its parent, and a search follows only the edges within the radius of the query's own distance. Trees travel with
their shard rather than by broadcast, since all of them together grow with the corpus. A shard emits a spanning
star of its links; stars are merged into components across shards.

Near duplicates by word shingles (near_classes) go further apart in bits than such shards allow for: sets of a Jaccard similarity of
0.8 differ in 9.7 of 64 bits on average. There bands of min-hashes deal the shards, trees are searched with a wide radius, and
the whole shingle sets decide each link. keep_one links by SimHashes within three bits first, through the shards and trees above, and
takes these further links besides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import lean, materialize, partitions, small_batches

SEED = 42
#: Shards above this many fingerprints are dealt again by the bits that remain.
SHARD_LIMIT = 200_000
FRONTIER = 1 << 18


def simhash(text: str | None, words: int = 3, seed: int = SEED) -> int:
    """64-bit SimHash of the text's word shingles, repeats included; A-Z lower-cased, words cut at ASCII white space.

    Fewer words than a shingle has: the whole sequence is one shingle. No words (or null): 0.
    """
    import xxhash

    digest = xxhash.xxh64_intdigest
    parts = (text or "").encode("utf-8").lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        return digest(b" ".join(parts), seed)
    flat = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    s, e = starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(s), 65_536):
        h = np.array([digest(flat[a:b], seed) for a, b in zip(s[at : at + 65_536], e[at : at + 65_536], strict=True)], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(s), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a bigint) of every document."""

    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = np.array([simhash(t, words) for t in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run), "doc_id long, fp long")


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


class BkForest:
    """The BK-trees of many shards at once, built and searched level by level on arrays. Members of a shard are distinct."""

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        """shard: sorted shard numbers; fp: unsigned 64-bit fingerprints."""
        self.fp = fp
        first = np.concatenate([[True], shard[1:] != shard[:-1]]) if len(shard) else np.zeros(0, bool)
        heads = np.flatnonzero(first)
        self.root = heads[np.cumsum(first) - 1] if len(shard) else np.zeros(0, np.int64)
        items = np.flatnonzero(~first)
        at = self.root[items]
        codes, children = [], []
        while len(items):
            code = at * 65 + np.bitwise_count(fp[items] ^ fp[at])
            order = np.argsort(code, kind="stable")
            items, code = items[order], code[order]
            lead = np.concatenate([[True], code[1:] != code[:-1]])
            nodes = items[lead]
            codes.append(code[lead])
            children.append(nodes)
            at = nodes[np.cumsum(lead) - 1][~lead]
            items = items[~lead]
        code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        order = np.argsort(code, kind="stable")
        self.code, self.child = code[order], (np.concatenate(children) if children else np.zeros(0, np.int64))[order]

    def hits(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (query, node) within the radius in the query's own tree, itself excluded."""
        stack = [(queries[i : i + FRONTIER // 8], self.root[queries[i : i + FRONTIER // 8]]) for i in range(0, len(queries), FRONTIER // 8)]
        while stack:
            q, node = stack.pop()
            d = np.bitwise_count(self.fp[q] ^ self.fp[node]).astype(np.int64)
            near = (d <= radius) & (q != node)
            if near.any():
                yield q[near], node[near]
            lo = np.searchsorted(self.code, node * 65 + np.maximum(d - radius, 0))
            n = np.searchsorted(self.code, node * 65 + np.minimum(d + radius, 64), side="right") - lo
            total = np.cumsum(n)
            cuts = [0, *(np.searchsorted(total, np.arange(FRONTIER, total[-1], FRONTIER)) + 1).tolist(), len(n)] if len(n) and total[-1] else [0]
            for a, b in zip(cuts, cuts[1:], strict=False):
                k = n[a:b]
                m = int(k.sum())
                if m:
                    offset = np.arange(m) - np.repeat(np.cumsum(k) - k, k)
                    stack.append((np.repeat(q[a:b], k), self.child[np.repeat(lo[a:b], k) + offset]))


def union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i]; the smaller index becomes the root, and parent stays fully compressed."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def busy_rows(shard: np.ndarray) -> np.ndarray:
    """Positions of rows that aren't alone in their shard."""
    same = shard[1:] == shard[:-1]
    return np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same])) if len(shard) else np.zeros(0, np.int64)


def shard_links(shard: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A star for each connected group in each shard: (member, root) positions."""
    where = busy_rows(shard)
    forest, parent = BkForest(shard[where], fp[where]), np.arange(len(where))
    for q, node in forest.hits(np.arange(len(where)), radius):
        union(parent, q, node)
    member = np.flatnonzero(parent != np.arange(len(where)))
    return where[member], where[parent[member]]


def _bits(blocks: int, start: int = 0, stop: int = 64) -> list[tuple[int, int]]:
    """(shift, width) of `blocks` even pieces of the bits from start to stop."""
    edges = [start + (stop - start) * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _keys(fp: Column, radius: int, blocks: int) -> Column:
    """Shard keys: each choice of blocks - radius blocks with the bits in them; partners share at least one key."""
    spots, choices = _bits(blocks), list(combinations(range(blocks), blocks - radius))
    keys = []
    for i, choice in enumerate(choices):
        mask = sum(((1 << spots[c][1]) - 1) << spots[c][0] for c in choice)
        mask = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(i).alias("choice"), fp.bitwiseAND(F.lit(mask)).alias("bits")))
    return F.explode(F.array(*keys))


def links(distinct: DataFrame, radius: int = 3, limit: int = SHARD_LIMIT) -> DataFrame:
    """(u, v) bigints: spanning edges of the groups of fingerprints that links of at most `radius` bits connect.

    distinct: a column fp without repeats. Shards that exceed the limit are dealt again with one block more (longer keys,
    so smaller shards); with radius + 4 blocks they're searched as they are. Every link is found in each case; no partner
    is dropped.
    """
    blocks, todo, found = radius + 1, distinct.select("fp"), None
    while True:
        keyed = todo.select("fp", _keys(F.col("fp"), radius, blocks).alias("key"))
        crowded = None
        if blocks < radius + 4:
            crowded, _ = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select("key"), "crowded")
        again = crowded is not None and not crowded.isEmpty()
        part = _search(keyed.join(crowded, "key", "left_anti") if again else keyed, radius)
        found = part if found is None else found.unionByName(part)
        if not again:
            return found
        todo, blocks = keyed.join(crowded, "key", "left_semi").select("fp").distinct(), blocks + 1


def by_shard(ordered: DataFrame, search: Callable[[np.ndarray, list[np.ndarray]], tuple[np.ndarray, np.ndarray]], keys: int, least: int = 50_000) -> DataFrame:
    """(u, v): what search finds in whole shards. Rows come sorted by their first `keys` columns, which name a shard; some shards are searched at once."""
    width = len(ordered.columns)

    def emit(held: list[list[np.ndarray]]):
        cols = [np.concatenate([h[i] for h in held]) for i in range(width)]
        new = np.zeros(len(cols[0]), bool)
        new[0] = True
        for c in cols[:keys]:
            new[1:] |= c[1:] != c[:-1]
        u, v = search(np.cumsum(new), cols[keys:])
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    def run(batches):
        held: list[list[np.ndarray]] = []  # whole shards, the last of which may go on
        size, head = 0, None  # head: rows of held that belong to shards before the last
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [np.array(batch.column(i).to_pylist(), object) if pa.types.is_binary(batch.column(i).type) else batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)]
            last = np.ones(len(cols[0]), bool)
            for c in cols[:keys]:
                last &= c == c[-1]
            cut = len(last) - int(last[::-1].argmin()) if not last.all() else 0  # rows of this batch before its last shard
            goes_on = held and all(held[-1][i][-1] == cols[i][0] for i in range(keys))
            if cut or not goes_on:
                head = (len(held), cut)
            held.append(cols)
            size += max(batch.num_rows, batch.nbytes // 1024)
            if size >= least and head and (head[0] or head[1]):
                k, at = head
                done = [*held[:k], [c[:at] for c in held[k]]]
                held = [[c[at:] for c in held[k]], *held[k + 1 :]]
                done = [h for h in done if len(h[0])]
                size, head = sum(len(h[0]) for h in held), None
                if done:
                    yield emit(done)
        held = [h for h in held if len(h[0])]
        if held:
            yield emit(held)

    return ordered.mapInArrow(lean(run), "u long, v long")


def _search(keyed: DataFrame, radius: int) -> DataFrame:
    """Spanning edges of each shard."""
    ordered = keyed.select("key.choice", "key.bits", "fp").repartition(partitions(keyed.sparkSession), "choice", "bits").sortWithinPartitions("choice", "bits", "fp")

    def search(shard, cols):
        a, b = shard_links(shard, cols[0].view(np.uint64), radius)
        return cols[0][a], cols[0][b]

    return by_shard(ordered, search, 2)


#: Bands of min-hashes, and hashes a band. Two sets of Jaccard similarity 0.8 share a band with a chance of 0.9993, at 0.85 of 0.99999.
BANDS, ROWS = 24, 6
#: Rows of a shard of bands that one task searches with their whole sets.
BLOCK_ROWS = 2048
#: Bits in which SimHashes of sets of a similarity of 0.8 may differ: about three standard deviations over the mean of 9.7.
WIDE_RADIUS = 18
_SEEDS = np.random.default_rng(77).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1)


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted hashes of the text's distinct word shingles; a text of fewer words is one shingle, one without words none."""
    from tidemark.llm.passages import Hashes, split

    parts = split(text)
    return np.unique(Hashes(parts).runs(min(words, len(parts)))) if parts else np.zeros(0, np.uint64)


def set_simhash(h: np.ndarray) -> int:
    """SimHash of a set of shingle hashes."""
    if not len(h):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 65_536):
        counts += np.unpackbits(h[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(h), bitorder="little").tobytes(), "little")


def min_hashes(h: np.ndarray) -> np.ndarray:
    """The least of each of BANDS * ROWS hashes of a set's members."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(h), 512):
        mixed = h[at : at + 512, None] ^ _SEEDS[None, :]
        for factor in (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)):  # two rounds, or the hashes of one set depend on each other
            mixed ^= mixed >> np.uint64(32)
            mixed *= factor
        np.minimum(least, mixed.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key for each band of min-hashes; empty sets have equal keys."""
    keys = np.zeros(BANDS, np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ row) * np.uint64(0xD6E8FEB86659FD93)
        keys ^= keys >> np.uint64(29)
    return keys + np.arange(BANDS, dtype=np.uint64)


def _likely(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) of cids whose sizes allow the similarity and whose min-hashes don't speak against it.

    Min-hashes estimate a similarity of 0.8 with a standard deviation of 0.033; pairs more than 0.15 below are left out.
    """
    x, y = (classes.select(F.col("cid").alias(k), F.col("n").alias(f"n_{k}"), F.col("sig").alias(f"sig_{k}")) for k in ("u", "v"))
    sized = pairs.join(x, "u").join(y, "v").filter(F.least("n_u", "n_v") >= F.greatest("n_u", "n_v") * similarity - 1e-6).select("u", "v", "sig_u", "sig_v")

    def run(batches):
        for b in batches:
            p, q = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(b.num_rows, BANDS * ROWS) for i in (2, 3))
            ok = (p == q).mean(axis=1) >= similarity - 0.15 if b.num_rows else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return sized.mapInArrow(lean(run), "u long, v long")


def jaccard_at_least(p: np.ndarray, q: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets have the similarity; two empty ones do."""
    common = len(np.intersect1d(p, q, assume_unique=True))
    return common >= similarity * (len(p) + len(q) - common) - 1e-9


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) of cids whose whole shingle sets have the similarity."""
    x, y = (sets.select(F.col("cid").alias(k), F.col("shingles").alias(f"shingles_{k}")) for k in ("u", "v"))
    both = pairs.join(x.hint("merge"), "u").join(y.hint("merge"), "v").select("u", "v", "shingles_u", "shingles_v")

    def run(batches):
        for b in batches:
            ok = []
            for p, q in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                ok.append(jaccard_at_least(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), similarity))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(lean(run), "u long, v long")


def _rest_of_shards(rows: DataFrame, sets: DataFrame, similarity: float, limit: int) -> DataFrame:
    """(u, v): links between the rows of a shard that aren't connected yet, as many as connect them.

    rows: key, cid, root of shards with several roots; sets: cid, fp, n, shingles. Rows of a shard's commonest root are connected already, so the others
    alone look for links: each searches the BK-tree of the shard's SimHashes, and whole sets decide, nearest first, until a root is
    reached. A shard above the limit is cut into blocks by hash, and the searching rows go to each, so the rows of a hot
    shard are spread and none is left out; a task emits no more links than it has rows.
    """
    spark = rows.sparkSession
    rooted = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    shards, _ = materialize(rooted.groupBy("key").agg(F.max(F.struct("c", "root"))["root"].alias("main"), F.ceil(F.sum("c") / limit).cast("int").alias("blocks")), "mark-shards", small=True)
    cut = rows.join(shards, "key").withColumn("own", F.pmod(F.xxhash64("cid", F.lit(3)), F.col("blocks")).cast("int")).withColumn("asks", F.col("root") != F.col("main"))
    blocks = F.when(F.col("asks"), F.expr("sequence(0, blocks - 1)")).otherwise(F.array("own"))
    placed, _ = materialize(cut.select("key", F.explode(blocks).alias("block"), "cid", "root", "asks"), "mark-placed", small=True)
    dealt = placed.join(sets, "cid").select("key", "block", "cid", "root", "fp", F.col("n").cast("long").alias("n"), "asks", "shingles")  # sets travel once
    ordered = dealt.repartition(partitions(spark), "key", "block").sortWithinPartitions("key", "block", "fp", "cid")

    def search(shard, cols):
        cid, root, fp, n, asks, shingles = cols
        # a tree holds distinct fingerprints; equal ones hang on the first of them
        f = fp.view(np.uint64)
        first = np.concatenate([[True], (shard[1:] != shard[:-1]) | (f[1:] != f[:-1])])
        heads = np.flatnonzero(first)
        ends = np.append(heads[1:], len(f))
        forest = BkForest(shard[heads], f[heads])
        names, group = np.unique(root, return_inverse=True)
        parent, us, vs = list(range(len(names))), [], []

        def top(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        asking = np.flatnonzero(np.logical_or.reduceat(asks, heads))
        found = [(np.concatenate([asking, *[q for q, _ in hits]]), np.concatenate([asking, *[m for _, m in hits]])) for hits in [list(forest.hits(asking, WIDE_RADIUS))]]
        q, node = found[0]
        order = np.lexsort((np.bitwise_count(f[heads[q]] ^ f[heads[node]]), q))
        for a, b in zip(q[order].tolist(), node[order].tolist(), strict=True):
            for i in range(heads[a], ends[a]):
                if not asks[i]:
                    continue
                mine = np.frombuffer(shingles[i], np.uint64)
                for j in range(heads[b], ends[b]):
                    if min(n[i], n[j]) < similarity * max(n[i], n[j]) - 1e-6 or top(group[i]) == top(group[j]):
                        continue
                    if jaccard_at_least(mine, np.frombuffer(shingles[j], np.uint64), similarity):
                        x, y = sorted((top(group[i]), top(group[j])))
                        parent[y] = x
                        us.append(cid[i])
                        vs.append(cid[j])
        return np.array(us, np.int64), np.array(vs, np.int64)

    return by_shard(ordered, search, 2, 4096).distinct()


def _simhash_links(prints: DataFrame, radius: int) -> DataFrame:
    """(u, v) of cids: a star for each group that SimHashes within the radius connect, found in BK-trees. prints: cid, print."""
    near = components(links(prints.select(F.col("print").alias("fp")).distinct(), radius))
    named = prints.join(near.hint("merge"), F.col("print") == F.col("node"), "left").select("cid", F.coalesce("root", "print").alias("group"))
    named, _ = materialize(named, "simhash-groups", small=True)
    heads, _ = materialize(named.groupBy("group").agg(F.min("cid").alias("v"), F.max("cid").alias("w")).filter("v <> w").select("group", "v"), "simhash-heads", small=True)
    return named.join(heads.hint("merge"), "group").filter("cid <> v").select(F.greatest("cid", "v").alias("u"), F.least("cid", "v").alias("v")).distinct()


def near_classes(docs: DataFrame, similarity: float = 0.8, words: int = 5, limit: int = BLOCK_ROWS, radius: int | None = None) -> DataFrame:
    """doc_id, row (xxhash64 of the text), component_id, root for every row of docs; root names a component without fail.

    With a radius, texts whose SimHashes (as in near_groups: three words, repeats included) differ in so many bits or fewer are linked first, all of them,
    through the BK-trees of links(). Every further link is decided by the Jaccard similarity of the whole shingle sets. Texts with equal sets are one class. Classes that share a
    band of min-hashes form a shard; each is first held against its shard's first and last, and what isn't connected by then
    is searched in the shard's BK-tree of SimHashes.
    """
    import xxhash

    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row", F.xxhash64("text"))

    def run(batches):
        for b in batches:
            found = [shingle_set(t, words) for t in b.column(1).to_pylist()]
            fp = np.array([set_simhash(h) for h in found], dtype=np.uint64).view(np.int64)
            bits = np.array([simhash(x) if radius is not None else 0 for x in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            cid = np.array([xxhash.xxh3_64_intdigest(h.tobytes()) for h in found], dtype=np.uint64).view(np.int64)
            least = [min_hashes(h) for h in found]
            keys = np.array([band_keys(m) for m in least], dtype=np.uint64).reshape(len(found), BANDS).view(np.int64)
            sig = pa.array([(m >> np.uint64(24)).astype(np.uint8).tobytes() for m in least], pa.binary())
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(found) * BANDS + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(cid), pa.array(fp), pa.array([len(h) for h in found], pa.int32()), bands, sig, pa.array(bits)], names=["doc_id", "row", "cid", "fp", "n", "bands", "sig", "print"])

    marks, _ = materialize(slim.mapInArrow(lean(run), "doc_id long, row long, cid long, fp long, n int, bands array<bigint>, sig binary, print long"), "marks")
    shown = [F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "row")).alias("shown"), F.min("fp").alias("fp"), F.min("n").alias("n"), F.min("bands").alias("bands"), F.min("sig").alias("sig")]
    classes, _ = materialize(marks.groupBy("cid").agg(*shown), "mark-classes")
    keyed = classes.select("cid", F.explode("bands").alias("key"))
    shards = keyed.groupBy("key").agg(F.min("cid").alias("low"), F.max("cid").alias("high"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    members, _ = materialize(keyed.join(shards, "key"), "shards")

    leads = members.select("cid", F.explode(F.array_distinct(F.array("low", "high"))).alias("lead")).filter("cid <> lead").select(F.least("cid", "lead").alias("u"), F.greatest("cid", "lead").alias("v")).distinct()
    first, _ = materialize(_likely(leads, classes, similarity), "mark-pairs", small=True)

    # the shingles of the classes that share a shard, made again from the text that shows the class
    some = members.select("cid").distinct().join(classes, "cid").select("cid", F.col("shown.doc_id").alias("i"), F.col("shown.row").alias("r"))
    wanted, _ = materialize(some, "mark-wanted", small=True)

    def shingled(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t, words).tobytes() for t in b.column(1).to_pylist()], pa.binary())], names=["cid", "shingles"])

    # what grows with the corpus is never broadcast, whatever its size happens to be
    texts = slim.join(wanted.hint("merge"), slim["doc_id"].eqNullSafe(F.col("i")) & slim["row"].eqNullSafe(F.col("r"))).select("cid", "text")
    sets, _ = materialize(texts.mapInArrow(lean(shingled), "cid long, shingles binary").dropDuplicates(["cid"]), "mark-sets")

    alike = _alike(first, sets, similarity)
    if radius is not None:
        prints, _ = materialize(marks.select("cid", "print").distinct(), "simhash", small=True)
        alike = alike.unionByName(_simhash_links(prints, radius))
    tried, _ = materialize(alike, "mark-links", small=True)
    reached, _ = materialize(components(tried), "mark-linked")
    rooted = members.join(reached.select(F.col("node").alias("cid"), "root"), "cid", "left").select("key", "cid", F.coalesce("root", "cid").alias("root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count(F.lit(1)).alias("c")).filter("a <> b AND c > 3").select("key")  # of three, two leads have met all
    open_rows, _ = materialize(rooted.join(mixed, "key"), "mark-open", small=True)
    edges, _ = materialize(tried.unionByName(_rest_of_shards(open_rows, classes.select("cid", "fp", "n").join(sets, "cid"), similarity, limit)), "mark-edges", small=True)

    stars = components(edges)
    stars = stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
    named = stars.join(classes.select("cid", "least"), F.col("node") == F.col("cid")).groupBy("root").agg(F.min("least").alias("component_id"))
    linked = stars.join(named, "root").select(F.col("node").alias("cid"), "component_id", "root")
    ids = classes.select("cid", "least").join(linked, "cid", "left").select("cid", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("root", "cid").alias("root"))
    ids, _ = materialize(ids, "near-ids", small=True)  # so that the last join has a shuffle on either side, which hot classes can split
    return marks.select("doc_id", "row", "cid").join(ids, "cid").select("doc_id", "row", "component_id", "root")


def near_duplicates(docs: DataFrame, similarity: float = 0.8, words: int = 5, limit: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, component_id: documents that links of a shingle similarity of `similarity` or more connect.

    Texts without words are alike; a text of fewer words than a shingle is one shingle; very long texts count whole. Null doc_ids
    keep their row and never name a component. Repeated rows stay; an empty table gives an empty one; further columns of any
    name play no part.
    """
    return near_classes(docs, similarity, words, limit).select("doc_id", "component_id")


def _named(marks: DataFrame, classes: DataFrame, edges: DataFrame) -> DataFrame:
    reached = components(edges)
    stars = reached.unionByName(reached.select(F.col("root").alias("node"), "root").distinct())
    named = stars.join(classes, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("least").alias("component"))
    linked = stars.join(named, "root").select(F.col("node").alias("fp"), "component")
    ids = classes.join(linked, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id"))
    ids, _ = materialize(ids, "near-ids", small=True)  # so that the last join has a shuffle on either side, which hot fingerprints can split
    return marks.join(ids, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, similarity: float = 0.8, words: int = 5, radius: int = 3) -> DataFrame:
    """The document of smallest doc_id of each near-duplicate group, with the columns of docs, whatever their names.

    Groups are what SimHashes within the radius connect, as in near_groups, and beyond that shingle sets of the similarity.
    Rows with a null doc_id all stay. Of several rows of that doc_id in one group one stays; rows of one doc_id in different groups
    each stand for theirs. Texts without words are one group. An empty table stays empty.
    """
    groups, _ = materialize(near_classes(docs, similarity, words, radius=radius), "near-groups", small=True)
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("row"))
    gone = groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("id"), "row").distinct()
    kept = marked.join(gone, ["id", "row"], "left_anti")
    stay = groups.filter("doc_id = component_id")
    several = stay.groupBy("root").count().filter("count > 1").select("root")
    if several.isEmpty():
        return kept.select("doc.*")
    several, _ = materialize(several, "near-several")
    which = stay.join(several, "root").select(F.col("doc_id").alias("id"), "row", "root").distinct()
    again = kept.join(which, ["id", "row"], "left")
    one = again.filter("root IS NOT NULL").groupBy("root").agg(F.min_by("doc", F.struct("row", F.xxhash64("doc"))).alias("doc"))
    return again.filter("root IS NULL").select("doc.*").unionByName(one.select("doc.*"))


def near_groups(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fp, component_id of every document; component_id is the smallest doc_id its links reach.

    Documents without words (null, empty, white space) have fingerprint zero and are linked like any other; very long texts
    count whole. Null doc_ids keep their row and never name a component (a component of nulls only has a null id).
    Repeated rows stay; an empty table gives an empty one; further columns of any name play no part.
    """
    marks, _ = materialize(fingerprints(docs, words), "simhash")
    classes, _ = materialize(marks.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "simhash-classes")
    return _named(marks, classes, links(classes))


def simhash_report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hexadecimal digits), component_id; nulls, ties, repeats and empty tables as in near_groups."""
    return near_groups(docs).select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")
