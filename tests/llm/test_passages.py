import random

import pytest

from tidemark.llm.passages import LEAST, chain, remove_repeated, repeated_passages, split, without
from tidemark.llm.queries import op5_substring_dedup


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(n)]


def brute_chain_score(pos, spos, gap=0.05, k=5):
    f = []
    for i in range(len(pos)):
        best = 0.0
        for j in range(i):
            if pos[j] < pos[i] and spos[j] < spos[i]:
                best = max(best, f[j] - gap * (pos[i] - pos[j] + spos[i] - spos[j]))
        f.append(k + best)
    return f


def score(pos, spos, path, gap=0.05, k=5):
    return k * len(path) - sum(gap * (pos[b] - pos[a] + spos[b] - spos[a]) for a, b in zip(path, path[1:]))


def test_chains_are_the_best_ones():
    rng = random.Random(4)
    for _ in range(100):
        matches = sorted((rng.randint(0, 120), rng.randint(0, 120)) for _ in range(rng.randint(1, 40)))
        pos, spos = [m[0] for m in matches], [m[1] for m in matches]
        found = chain(pos, spos)
        assert abs(score(pos, spos, found[0]) - max(brute_chain_score(pos, spos))) < 1e-9
        assert sorted(i for c in found for i in c) == list(range(len(pos)))
        assert all(pos[a] < pos[b] and spos[a] < spos[b] for c in found for a, b in zip(c, c[1:]))


def covered(rows):
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.n_words))
    return out


def test_planted_passages_are_found_and_clean_documents_left_alone(spark, make_docs):
    rng = random.Random(8)
    passage, fuzzy, short = words(rng, 80), words(rng, 120), words(rng, 30)
    changed = [w if i % 15 else "zzzz" for i, w in enumerate(fuzzy)]
    inserted = fuzzy[:60] + ["new", "words", "here"] + fuzzy[60:]
    texts = {i: words(rng, 200) for i in range(12)}
    plant = {2: passage, 5: passage, 9: passage, 3: fuzzy, 6: changed, 7: inserted, 1: short, 8: short}
    rows = [(i, " ".join(t[:90] + plant.get(i, []) + t[90:])) for i, t in texts.items()]
    got = covered(repeated_passages(make_docs(rows)).collect())
    assert set(got) == {5, 9, 6, 7}
    for i in (5, 9):
        assert set(range(90, 170)) <= got[i] and len(got[i]) <= 84
    assert len(got[6] & set(range(90, 210))) >= 110 and len(got[7] & set(range(90, 213))) >= 110
    kept = {r.doc_id: r.text for r in remove_repeated(make_docs(rows)).collect()}
    assert set(kept) == set(texts)
    assert all(kept[i] == t for i, t in rows if i not in got)
    assert kept[5].split() == texts[5] and kept[9].split() == texts[9]


def test_every_exact_repeat_of_the_whole_table_is_covered(spark, sf):
    docs = {r.doc_id: split(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = covered(op5_substring_dedup(spark, sf).collect())
    seen, missed, total = {}, 0, 0
    for i in sorted(docs):
        w = docs[i]
        repeated = set()
        for at in range(len(w) - LEAST):
            gram = tuple(w[at : at + LEAST + 1])
            first = seen.setdefault(gram, (i, at))
            if first[0] != i:
                repeated.update(range(at, at + LEAST + 1))
        total += len(repeated)
        missed += len(repeated - got.get(i, set()))
    assert total and missed <= 0.01 * total


def test_odd_rows(spark, make_docs, odd_rows):
    df = make_docs(odd_rows)
    assert repeated_passages(df.limit(0)).count() == 0
    assert repeated_passages(df).count() == 0
    assert remove_repeated(df).columns == df.columns
    assert remove_repeated(df).count() == len(odd_rows)
    long = next(t for i, t, *_ in odd_rows if i == 3)
    twice = make_docs([(1, long), (2, long), (2, long), (None, long)])
    got = sorted(((r.doc_id, r.text) for r in remove_repeated(twice).collect()), key=str)
    assert got == [(1, long), (None, long)]


def test_cutting_keeps_the_rest():
    assert without("a b\nc d  e f", [(1, 3)]) == "a \n d  e f".replace(" \n", " ", 1) or without("a b\nc d  e f", [(1, 3)]) == "a  d  e f"
    assert without("a b", [(0, 2)]) == "" and without("a b", []) == "a b"
    assert without("é b ü", [(1, 2)]).split() == ["é", "ü"]


def test_repeats_made_of_earlier_short_stretches_are_found(spark, make_docs):
    rng = random.Random(21)
    left, right, parts = words(rng, 49), words(rng, 49), [words(rng, 45) for _ in range(3)]
    own = {i: words(rng, 120) for i in range(14)}
    plant = {0: left, 1: right, 5: left + right, 6: left + right, 2: parts[0], 3: parts[1], 4: parts[2], 8: sum(parts, []), 9: parts[0], 10: parts[2], 12: sum(parts, []), 13: right + left[:1]}
    rows = [(i, " ".join(t[:60] + plant.get(i, []) + t[60:])) for i, t in own.items()]
    got = covered(repeated_passages(make_docs(rows)).collect())
    assert set(range(60, 158)) <= got.get(6, set()) and set(range(60, 195)) <= got.get(12, set())
    assert set(got) == {6, 12}


def test_pieces_in_earlier_documents_hide_no_passage(spark, make_docs):
    rng = random.Random(31)
    passage, own = words(rng, 120), {i: words(rng, 130) for i in [*range(10), 100, 101, *range(20, 29)]}
    # pieces of 24 words, and overlapping ones of 49 that lie both before the source and between it and the repeat
    plant = {i: passage[12 * i : 12 * i + 24] for i in range(10)} | {100: passage, 101: passage}
    rows = [(i, " ".join(t[:60] + plant.get(i, []) + t[60:])) for i, t in own.items()]
    got = covered(repeated_passages(make_docs(rows)).collect())
    assert set(range(60, 180)) <= got[101] and set(got) == {101}
    second = {20 + i: passage[9 * i : 9 * i + 49] for i in range(9)} | {100: passage, 101: passage}
    rows = [(i, " ".join(t[:60] + second.get(i, []) + t[60:])) for i, t in own.items()] + [(50 + i, " ".join(words(rng, 70) + second[20 + i])) for i in range(9)]
    got = covered(repeated_passages(make_docs([(i + 100 if 50 <= i < 60 else i, t) for i, t in rows])).collect())
    assert set(range(60, 180)) <= got[101]


@pytest.mark.parametrize("copies", [1, 12, 45])
def test_pieces_in_earlier_documents_hide_no_passage_with_differences(spark, make_docs, copies):
    """However many documents hold the pieces: beyond CROWD pairs of seeds are matched, and held against each other beyond CROWD of those."""
    rng = random.Random(41)
    passage = words(rng, 120)
    changed = [w if i % 13 != 7 else "zzzz" for i, w in enumerate(passage)]
    own = {i: words(rng, 130) for i in [*range(10 * copies), 1000, 1001]}
    plant = {i: passage[12 * (i % 10) : 12 * (i % 10) + 24] for i in range(10 * copies)} | {1000: passage, 1001: changed}
    rows = [(i, " ".join(t[:60] + plant[i] + t[60:])) for i, t in own.items()]
    got = covered(repeated_passages(make_docs(rows)).collect())
    assert len(set(range(60, 180)) & got.get(1001, set())) >= 110 and set(got) == {1001}


def test_crowded_places_give_as_many_rows_as_places_and_not_as_pairs(spark):
    """Each of 80 documents has the passage with differences of its own; what is kept of the partners covers all of it."""
    from tidemark.llm.passages import SIMILARITY, held_together

    rng = random.Random(43)
    passage, n = words(rng, 100), 80
    changed = {i: [w if (at - i) % 17 or 40 <= at < 65 else f"own{i}" for at, w in enumerate(passage)] for i in range(n)}
    slim = spark.createDataFrame([(i, " ".join(words(rng, 70) + t + words(rng, 70))) for i, t in changed.items()], "doc_id long, text string")
    pairs = spark.createDataFrame([(1, n, i, 110, 130, True) for i in range(n)], "key long, n long, doc_id long, pos int, pos2 int, open boolean")
    got = held_together(slim, pairs, LEAST, SIMILARITY).collect()
    assert len(got) <= 2 * n and {r.doc_id for r in got} == set(range(1, n)) and all(r.source < r.doc_id and r.like >= SIMILARITY for r in got)
    for i in range(1, n):
        span = set().union(*(range(r.s, r.e) for r in got if r.doc_id == i))
        assert len(span & set(range(70, 170))) >= 90 and len(span) <= 112


def test_a_crowded_seed_is_matched_beside_a_rare_one(spark):
    from tidemark.llm.passages import CROWD, SIMILARITY, all_partners

    crowd = [(1, 0, i, 0, False) for i in range(1, CROWD + 9)] + [(1, 0, 1000, 20, False), (1, 0, 1001, 20, True)]
    rare = [(2, 9, 2, 9, False), (2, 9, 1000, 60, False), (2, 9, 1001, 60, True)]
    places = spark.createDataFrame(crowd + rare, "source long, spos int, doc_id long, pos int, open boolean")
    slim = spark.createDataFrame([(1000, "a b"), (1001, "a b")], "doc_id long, text string")
    matches, held = all_partners(slim, places, LEAST, SIMILARITY)
    assert {(1001, 1000, 20, 20), (1001, 1000, 60, 60)} <= {tuple(r)[:4] for r in matches.collect()} and held.count() == 0


def test_passages_of_few_distinct_words_are_found(spark, make_docs):
    rng = random.Random(33)
    few = {"a": ["la"] * 100, "b": ["do", "re", "mi"] * 34, "c": rng.choices(["x", "y"], k=100)}
    for passage in few.values():
        rows = [(i, " ".join(words(rng, 80) + passage + words(rng, 80))) for i in (100, 101, 102)] + [(5, " ".join(words(rng, 100)))]
        got = covered(repeated_passages(make_docs(rows)).collect())
        assert all(len(got[i] & set(range(80, 80 + len(passage)))) >= len(passage) - 2 for i in (101, 102))
        assert 100 not in got or got[100] <= set(range(80, 80 + len(passage)))


def test_rows_of_one_id_are_cut_by_their_own_text(spark, make_docs):
    rng = random.Random(35)
    passage, a, b = words(rng, 70), words(rng, 90), words(rng, 30)
    rows = [(1, " ".join(passage)), (2, " ".join(a + passage)), (2, " ".join(b)), (2, " ".join(b))]
    out = sorted((r.doc_id, r.text) for r in remove_repeated(make_docs(rows)).collect())
    assert out == sorted([(1, " ".join(passage)), (2, " ".join(a)), (2, " ".join(b)), (2, " ".join(b))])


def test_common_words_in_order_by_bits():
    import numpy as np
    from tidemark.llm.passages import inner

    rng = random.Random(37)
    for _ in range(200):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 40))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(max(row[j + 1], new[j], row[j] + (x == y)))
            row = new
        assert inner(np.array(a, np.uint32), np.array(b, np.uint32)) == row[-1]


def best_local(a, b):
    """(start, end) in a of the stretch that agrees best with one of b: a word that agrees +1, one that doesn't -4, so it agrees in over 0.8."""
    import numpy as np

    def furthest(x, y):
        row, best, at = np.zeros(len(y) + 1), 0.0, (0, 0)
        step = 4.0 * np.arange(len(y) + 1)
        for i, w in enumerate(x):
            new = np.zeros(len(y) + 1)
            new[1:] = np.maximum(row[:-1] + np.where(y == w, 1.0, -4.0), row[1:] - 4.0)
            row = np.maximum(np.maximum.accumulate(np.maximum(new, 0.0) + step) - step, 0.0)
            j = int(row.argmax())
            if row[j] > best:
                best, at = row[j], (i + 1, j)
        return best, at

    best, (i, j) = furthest(a, b)
    if best < 10:
        return 0, 0
    _, (n, _) = furthest(a[:i][::-1], b[:j][::-1])
    return i - n, i


def test_fuzzy_passages_of_the_whole_table_against_all_pairs(spark):
    """Best local alignments of all pairs of documents that share words in order; at least 0.9 of the words they hold are found."""
    import numpy as np
    from tidemark.llm.passages import word_codes

    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: word_codes(split(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    docs = {k: w for k, w in docs.items() if 50 <= len(w) <= 700}
    got, grams = covered(op5_substring_dedup(spark, sf).collect()), {}
    for k, w in docs.items():
        for g in set(zip(w.tolist(), w[1:].tolist(), w[2:].tolist(), w[3:].tolist())):
            grams.setdefault(g, []).append(k)
    shared = {}
    for ids in grams.values():
        for n, x in enumerate(ids[:40]):
            for y in ids[n + 1 : 40]:
                shared[x, y] = shared.get((x, y), 0) + 1
    total = found = fuzzy = 0
    for (x, y), n in sorted(shared.items()):
        if n < 8:
            continue
        first, later = min(x, y), max(x, y)
        s, e = best_local(docs[later], docs[first])
        if e - s >= LEAST + 5:
            fuzzy += 1
            total += e - s
            found += len(set(range(s, e)) & got.get(later, set()))
    assert fuzzy > 20 and found >= 0.9 * total
