import itertools

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.queries import op7_simhash_near_dedup
from tidemark.llm.simhash import BkForest, links, shard_links, simhash_report


def brute_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 3:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, f"{fps[i]:016x}", least.get(find(i))) for i, (k, _) in enumerate(rows)]


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_whole_table_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert order(op7_simhash_near_dedup(spark, sf).collect()) == order(brute_groups(rows))


def test_odd_rows(spark, make_docs, odd_rows):
    assert order(simhash_report(make_docs(odd_rows)).collect()) == order(brute_groups([r[:2] for r in odd_rows]))
    assert simhash_report(make_docs(odd_rows).limit(0)).count() == 0


def near_codes(n=1500, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fp = base[rng.integers(0, 40, n)]
    for _ in range(6):
        fp = fp ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(fp)


def test_tree_search_finds_every_link():
    fp = near_codes()
    forest = BkForest(np.zeros(len(fp), np.int64), fp)
    found = {(int(q), int(n)) for a, b in forest.hits(np.arange(len(fp)), 3) for q, n in zip(a, b, strict=True)}
    d = np.bitwise_count(fp[:, None] ^ fp[None, :])
    assert found == {(int(a), int(b)) for a, b in zip(*np.nonzero(d <= 3), strict=True) if a != b}


def roots(n, edges):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return [find(i) for i in range(n)]


def test_links_connect_the_same_groups_with_and_without_splitting(spark):
    fp = near_codes()
    d = np.bitwise_count(fp[:, None] ^ fp[None, :])
    want = roots(len(fp), [(int(a), int(b)) for a, b in zip(*np.nonzero(d <= 3), strict=True) if a < b])
    at = {int(x): i for i, x in enumerate(fp.view(np.int64))}
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    for limit in (200_000, 8):
        edges = [(at[r.u], at[r.v]) for r in links(df, limit=limit).collect()]
        assert all(d[a, b] <= 64 for a, b in edges) and roots(len(fp), edges) == want
        assert len(edges) <= 40 * len(fp)


def test_shards_are_searched_apart():
    a, b = shard_links(np.array([0, 0, 1, 1, 2]), np.array([1, 3, 1, 2**40, 5], dtype=np.uint64), 3)
    assert list(zip(a.tolist(), b.tolist(), strict=True)) == [(1, 0), (3, 2)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 200)] + [(500, 500)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 200)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_fingerprint_of_spark_rows_matches(spark, make_docs):
    rows = [(1, "The quick brown fox"), (2, "the QUICK brown\tfox"), (3, "Äb the quick")]
    got = simhash_report(make_docs(rows)).select("doc_id", "fingerprint").orderBy(F.col("doc_id")).collect()
    assert [r.fingerprint for r in got] == [f"{brute_fingerprint(t):016x}" for _, t in rows]
    assert got[0].fingerprint == got[1].fingerprint


def test_component_checks_do_not_overflow(spark):
    from tidemark.llm.components import _mark

    n, *marks = _mark(spark.range(30_000_000).selectExpr("id AS u", "id + 1 AS v"))
    assert n == 30_000_000 and marks != [0, 0]


def test_keys_of_a_fingerprint_stay_bounded(spark):
    """Millions of fingerprints in shards over any limit: at most 35 keys each, whatever their number."""
    from tidemark.llm.simhash import _keys

    fps = spark.range(5_000_000).select(F.xxhash64("id").alias("fp"))
    for blocks, keys in ((4, 4), (5, 10), (6, 20), (7, 35)):
        assert fps.limit(1000).select(_keys(F.col("fp"), 3, blocks)).count() == 1000 * keys
    largest = fps.select(_keys(F.col("fp"), 3, 4).alias("k")).groupBy("k").count().agg(F.max("count")).first()[0]
    assert largest < 200_000
