import numpy as np
import pytest

from tidemark.llm.quality import BAD, GOOD, LABELLERS, features, fit, fit_labels, fit_scorer, judge, keep_good, pattern_of, quality_report, score, statistics, votes, votes_of


def test_em_recovers_accuracies():
    rng = np.random.default_rng(2)
    n, true = 40_000, [0.9, 0.8, 0.7, 0.85, 0.95, 0.75, 0.8, 0.9, 0.65, 0.7]
    y = rng.random(n) < 0.8
    votes = np.stack([np.where(rng.random(n) < 0.2, 1, np.where((rng.random(n) < a) == y, GOOD, BAD)) for a in true], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = fit_labels(patterns, counts.astype(float))
    assert model.prior == pytest.approx(0.8, abs=0.03)
    assert list(model.accuracies().values()) == pytest.approx(true, abs=0.04)
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95


def test_patterns_round_trip():
    for code in range(0, 3 ** len(LABELLERS), 137):
        assert pattern_of(votes_of(code)) == code


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality_report(docs).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.keep for r in good) >= 0.99 * len(good)
    assert sum(not r.keep for r in bad) >= 0.95 * len(bad)


def test_odd_rows(spark, sf, make_docs, odd_rows):
    model = fit(spark.read.parquet(f"{sf}/documents.parquet"))
    got = judge(make_docs(odd_rows), model).collect()
    assert len(got) == len(odd_rows)
    empty = [r for r in got if r.doc_id in (1, 2, 7)]
    assert len(empty) == 3 and not any(r.keep for r in empty) and {r.score for r in empty} == {0.0}
    kept = keep_good(make_docs(odd_rows), model)
    assert kept.columns == make_docs(odd_rows).columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, (r.doc_id for r in got if r.keep)))
    assert quality_report(make_docs(odd_rows).limit(0)).count() == 0
    assert quality_report(make_docs(odd_rows)).count() == len(odd_rows)


def test_scores_equal_the_feature_form():
    rng = np.random.default_rng(1)
    w = rng.normal(size=len(features("x")))
    for text in ("", "ab", "The quick brown fox.\n" * 9, "É" * 50):
        assert score(text, w, 0.3) == pytest.approx(float(features(text) @ w) + 0.3, rel=1e-4, abs=1e-4)


def labelled(spark):
    """Texts with their labels, and the kind of each bad one."""
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("text", "quality").collect()
    rows = [r for r in rows if r.text and not r.text.isspace()]

    def kind(t):
        w = t.split()
        if w.count("|") > 0.1 * len(w):
            return "bars"
        if sum(x.endswith(("%%%", "***", "&&&", "$$$", "###")) for x in w) > 0.3 * len(w):
            return "symbols"
        if t.count("!!") > 0.3 * len(w):
            return "shouts"
        return "repeats" if sum(a == b for a, b in zip(w, w[1:])) > 0.2 * len(w) else "other"

    return [r.text for r in rows], np.array([r.quality for r in rows]), np.array(["good" if r.quality else kind(r.text) for r in rows])


def model_of(v):
    patterns, counts = np.unique(v, axis=0, return_counts=True)
    return fit_labels(patterns, counts.astype(float))


def test_em_beats_majority_and_single_labellers(spark):
    texts, quality, _ = labelled(spark)
    v = np.array([votes(statistics(t)[1]) for t in texts])
    right = lambda good: (good == (quality == 1)).mean()
    em = right(model_of(v).posterior(v) >= 0.5)
    majority = right((v == GOOD).sum(axis=1) >= (v == BAD).sum(axis=1))
    single = max(right(v[:, j] != BAD) for j in range(v.shape[1]))
    assert em > 0.99 and em > majority + 0.05 and em > single + 0.02


def test_the_scorer_knows_kinds_of_junk_it_has_not_seen(spark):
    import base64
    import random

    texts, _, kinds = labelled(spark)
    v, x = np.array([votes(statistics(t)[1]) for t in texts]), np.array([features(t) for t in texts])
    for unseen in ("bars", "symbols", "shouts", "repeats"):
        rest = np.flatnonzero(kinds != unseen)
        w, b = fit_scorer(x[rest[:2000]], model_of(v[rest]).posterior(v[rest[:2000]]))
        s = x @ w + b
        assert (s[kinds == unseen] < 0).mean() >= 0.95 and (s[kinds == "good"] >= 0).mean() >= 0.99, unseen
    w, b = fit_scorer(x[:2000], model_of(v).posterior(v[:2000]))
    rng = random.Random(1)
    for junk in (
        base64.b64encode(rng.randbytes(900)).decode(),
        "\n".join(f"12:{rng.randint(10, 59)}:07 [WARN] id={rng.randint(0, 10**6)} code=0x{rng.randint(0, 2**32):x}" for _ in range(30)),
        "".join(f'<td class="c{rng.randint(0, 99)}"><a href="/p/{rng.randint(0, 9999)}">{rng.randint(0, 99)}</a></td>' for _ in range(40)),
        "\n".join(" ".join(f"{rng.random() * 1000:.2f}" for _ in range(12)) for _ in range(20)),
    ):
        assert score(junk, w, b) < 0, junk[:60]


def test_query_against_a_plain_version(spark, sf):
    """The query's rows, made again one document at a time."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = fit(docs)
    want = {}
    for r in docs.collect():
        if r.text and not r.text.isspace():
            z = float(features(r.text) @ model.weights) + model.bias
            want[r.doc_id] = (float(model.labels.posterior(np.array([votes(statistics(r.text)[1])]))[0]), 1 / (1 + np.exp(-z)))
        else:
            want[r.doc_id] = (0.0, 0.0)
    got = {r.doc_id: (r.posterior, r.score, r.keep) for r in quality_report(docs).collect()}
    assert set(got) == set(want)
    assert all(got[k][:2] == pytest.approx(want[k], abs=1e-3) and got[k][2] == (got[k][1] >= 0.5) for k in want)
