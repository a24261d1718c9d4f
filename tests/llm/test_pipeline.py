import numpy as np

import corpus_pipeline
from tidemark.llm.mixing import mix_report
from tidemark.llm.quality import quality_report
from tidemark.llm.simhash import BANDS, band_keys, keep_one, min_hashes, near_duplicates, near_groups, set_simhash, shingle_set, simhash


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf).cache()
        assert out.columns == docs.columns, name
        before, after = {r.doc_id for r in docs.collect()}, {r.doc_id for r in out.collect()}
        assert after <= before and after
        if name == "quality classifier":
            assert after == {r.doc_id for r in quality_report(docs).collect() if r.keep}
        if name.startswith("mixing"):
            assert after == {r.doc_id for r in mix_report(docs).collect() if r.taken}
        docs = spark.createDataFrame(out.collect(), out.schema)
        out.unpersist()
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.n_tokens) for r in whole) == sorted((r.doc_id, r.piece, r.n_tokens) for r in rows)


def test_keep_one_of_each_group(spark, make_docs, odd_rows):
    base = [f"word{i}" for i in range(200)]
    near = [w if i != 100 else "changed" for i, w in enumerate(base)]
    other = [f"other{i}" for i in range(200)]
    rows = [(5, " ".join(base)), (2, " ".join(near)), (9, " ".join(base)), (7, " ".join(other)), (7, " ".join(other)), (None, " ".join(base))]
    got = sorted(map(str, (r.doc_id for r in keep_one(make_docs(rows)).collect())))
    assert got == ["2", "7", "None"]
    assert keep_one(make_docs(odd_rows).limit(0)).count() == 0
    assert near_duplicates(make_docs(odd_rows)).count() == len(odd_rows)


def test_links_are_exactly_the_pairs_of_the_similarity(spark):
    """Pairs from 0.72 to 0.9, half of them one text with a tail, hold together exactly where the whole sets have 0.8."""
    rng = np.random.default_rng(11)
    word = lambda: "w%d" % rng.integers(0, 50_000)
    rows = []
    for n in range(300):
        base = [word() for _ in range(int(rng.integers(60, 400)))]
        share = rng.uniform(0.72, 0.9)
        if n % 2:
            other = base + [word() for _ in range(int(len(base) * (1 / share - 1)))]
        else:
            other = list(base)
            for at in rng.choice(len(base), max(1, int(len(base) * (1 - share) / 10)), replace=False):
                other[at] = word()
        rows += [(2 * n, " ".join(base)), (2 * n + 1, " ".join(other))]
    # texts that one much-repeated line rules share a fingerprint, whatever else they hold
    rows += [(k, " ".join(["the same short line over and over again"] * 60 + [word() for _ in range(40)])) for k in (1000, 1001)]
    group = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {k: shingles(t) for k, t in rows}
    alike = {k: jaccard(sets[k], sets[k + 1]) >= 0.8 for k in range(0, 600, 2)}
    assert 60 < sum(alike.values()) < 260
    assert {k: group[k] == group[k + 1] for k in alike} == alike
    assert group[1000] != group[1001]


def test_all_pairs_of_the_table_are_decided_exactly(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    ids, parent = sorted(sets), {k: k for k in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) and jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    want = {k: find(k) for k in ids}
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == want
    # shards cut into blocks give the same groups
    assert {r.doc_id: r.component_id for r in near_duplicates(docs, limit=4).collect()} == want


def test_chance_of_a_shared_band_and_bits_that_differ():
    """At a similarity of 0.8, over 300 pairs: a band is shared, and SimHashes lie within the search's radius."""
    from tidemark.llm.simhash import WIDE_RADIUS

    rng = np.random.default_rng(5)
    shared, within, guesses = 0, 0, []
    for _ in range(300):
        n = int(rng.integers(100, 800))
        h = rng.integers(0, 2**63, int(n * 1.25), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        k = len(h) // 10
        a, b = np.unique(h[k:]), np.unique(h[:-k])
        shared += bool((band_keys(min_hashes(a)) == band_keys(min_hashes(b))).any())
        within += (set_simhash(a) ^ set_simhash(b)).bit_count() <= WIDE_RADIUS
        guesses.append((min_hashes(a) == min_hashes(b)).mean())
    assert shared >= 299 and within >= 297
    # min-hashes estimate the similarity as independent ones do
    assert abs(np.mean(guesses) - 0.8) < 0.01 and 0.025 < np.std(guesses) < 0.042 and min(guesses) > 0.65
    assert len(band_keys(min_hashes(h))) == BANDS and (min_hashes(shingle_set("")) == min_hashes(shingle_set(None))).all()


def test_hot_groups_of_near_copies(spark):
    """A third of all rows are variants of one text: one document of them stays, and no stage multiplies them."""
    rng = np.random.default_rng(17)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for n in range(900):
        other = list(base)
        other[int(rng.integers(0, 300))] = f"x{n}"
        rows.append((n, " ".join(other)))
    rows += [(1000 + n, " ".join(f"v{rng.integers(0, 10**6)}" for _ in range(60))) for n in range(1800)]
    kept = {r.doc_id for r in keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {0, *range(1000, 2800)}


def test_dense_groups_that_stars_do_not_connect(spark):
    """Variants of one text of which about half the pairs are links: groups equal all pairs', with few links to show for them."""
    from tidemark.llm.simhash import near_classes

    rng = np.random.default_rng(23)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for n in range(260):
        other = list(base)
        for at in rng.choice(150, int(rng.integers(1, 5)), replace=False):
            other[at] = f"x{rng.integers(0, 30)}"
        rows.append((n, " ".join(other)))
    sets, parent = {k: shingles(t) for k, t in rows}, list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in range(a):
            if find(a) != find(b) and jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    want = {k: find(k) for k in sets}
    for limit in (2048, 50):
        got = near_classes(spark.createDataFrame(rows, "doc_id long, text string"), limit=limit)
        assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_rows_of_one_id_with_different_texts_all_count(spark, make_docs):
    a, b, c = (" ".join(f"{x}{i}" for i in range(50)) for x in "abc")
    df = make_docs([(3, a), (5, a), (5, b), (5, b), (7, c), (7, a), (None, b), (None, None), (8, None), (9, "")])
    got = sorted(((r.doc_id, r.text) for r in keep_one(df.selectExpr("*", "1 AS root", "2 AS row", "3 AS id", "4 AS doc")).collect()), key=str)
    assert got == sorted([(3, a), (5, b), (7, c), (None, b), (None, None), (8, None)], key=str)


ODD = [(1, None, "a"), (2, "", "a"), (None, "no id here", "c"), (None, None, None), (7, "   \n ", "a"), (5, "same text here", "b"), (5, "same text here", "b")]


def test_run_on_odd_and_empty_tables(spark, make_docs, tmp_path):
    long = " ".join(f"word{i} of the long text." for i in range(3000))
    good = [(20 + i, " ".join(f"plain{(i * 37 + j) % 900} words" for j in range(60)) + ".", "b") for i in range(12)]
    for name, rows in {"odd": ODD + good + [(3, long, None)], "empty": [], "nulls": [(None, None, None)] * 3}.items():
        where = tmp_path / name
        (make_docs(rows) if rows else make_docs(ODD).limit(0)).write.parquet(f"file://{where}/documents.parquet")
        out = corpus_pipeline.run(spark, f"file://{where}").collect()
        assert bool(out) == (name == "odd")
        docs = spark.read.parquet(f"file://{where}/documents.parquet")
        for stage, f in corpus_pipeline.STAGES[:-1] if name == "odd" else ():
            assert f(spark, docs, str(where)).columns == docs.columns, stage


def test_one_of_each_simhash_group_is_kept(spark, make_docs):
    """Fingerprints within three bits make one group, also where the sets of five words agree in less than 0.8."""
    base = [f"w{i}" for i in range(20)]
    rows = [(1, " ".join(base * 30)), (2, " ".join(base * 30 + [f"x{i}" for i in range(8)])), (3, " ".join(f"y{i}" for i in range(100)))]
    a, b = (shingle_set(rows[i][1]) for i in (0, 1))
    assert len(set(a) & set(b)) < 0.8 * len(set(a) | set(b))
    assert (simhash(rows[0][1]) ^ simhash(rows[1][1])).bit_count() <= 3
    assert {r.doc_id: r.component_id for r in near_groups(make_docs(rows)).collect()} == {1: 1, 2: 1, 3: 3}
    assert sorted(r.doc_id for r in keep_one(make_docs(rows)).collect()) == [1, 3]
