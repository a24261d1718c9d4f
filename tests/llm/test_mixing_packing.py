import pytest

from tidemark.llm.mixing import mix, mix_report
from tidemark.llm.packing import LENGTHS, pack, pack_lengths, sequence_cost
from tidemark.llm.queries import op8_source_mixing, op10_best_fit_packing


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free:
        left, wsum = total - sum(target.values()), sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / wsum >= most * sizes[s]}
        if not over:
            target.update({s: left * w[s] / wsum for s in free})
            break
        target.update({s: most * sizes[s] for s in over})
        free -= over
    return target


def check_mix(rows, got):
    sizes, words = {}, {}
    for _, t, s in rows:
        n = len((t or "").encode().split())
        sizes[s] = sizes.get(s, 0) + n
    target = brute_targets(sizes)
    assert len(got) == len(rows)
    by_source, largest = {}, {}
    for doc_id, size, source_size, aim, taken, source in got:
        assert source_size == sizes[source] and aim == pytest.approx(target[source])
        assert taken in {size * k for k in range(4)}
        by_source[source] = by_source.get(source, 0) + taken
        largest[source] = max(largest.get(source, 0), size)
    for s, n in by_source.items():
        assert abs(n - target[s]) <= largest[s] / 2 + 1e-6


def test_whole_table_meets_its_targets_and_reruns_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    source = {i: s for i, _, s in rows}
    got = [(*r, source[r.doc_id]) for r in op8_source_mixing(spark, sf).collect()]
    check_mix(rows, got)
    assert sorted(got) == sorted((*r, source[r.doc_id]) for r in op8_source_mixing(spark, sf).collect())
    assert {r.doc_id: r.taken for r in mix_report(docs.repartition(3)).collect()} == {r[0]: r[4] for r in got}


def test_mixture_holds_each_document_as_often_as_reported(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    taken = {r.doc_id: r.taken // r["size"] for r in mix_report(docs).collect() if r["size"]}
    counts = {r.doc_id: r["count"] for r in mix(docs).groupBy("doc_id").count().collect()}
    assert mix(docs).columns == docs.columns
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in counts.items() if k in taken}


def test_odd_rows(spark, make_docs, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None]
    source = {r[0]: r[2] for r in rows}
    got = [(*r, source[r.doc_id]) for r in mix_report(make_docs(rows)).collect()]
    check_mix(rows, got)
    assert mix_report(make_docs(odd_rows)).count() == len(odd_rows)
    assert mix_report(make_docs(odd_rows).limit(0)).count() == 0
    assert set(mix(make_docs(odd_rows)).columns) == set(make_docs(odd_rows).columns)
    blank = mix_report(make_docs([(1, "", "a"), (2, None, "b")])).collect()
    assert {r.taken for r in blank} == {0} and {r.target for r in blank} == {0.0}


def check_bins(rows):
    bins = {}
    for r in rows:
        bins.setdefault((r["shard"], r["bin"]), []).append(r)
    for held in bins.values():
        used = sum(r["n_tokens"] for r in held)
        assert {r["seq_len"] for r in held} == {min(c for c in LENGTHS if c >= used)}
        at = 0
        for r in sorted(held, key=lambda r: r["bin_offset"]):
            assert r["bin_offset"] == at
            at += r["n_tokens"]
    return bins


def test_packing_query_keeps_every_token(spark, sf):
    from tidemark.llm.queries import op4_token_counts

    rows = op10_best_fit_packing(spark, sf).collect()
    bins = check_bins(rows)
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    assert total == {r.doc_id: r.n_tokens + 1 for r in op4_token_counts(spark, sf).collect()}
    room = sum(held[0]["seq_len"] for held in bins.values())
    assert sum(total.values()) / room > 0.95


def test_packing_odd_rows(spark):
    rows = [(1, None), (2, 0), (3, 4097), (3, 4097), (None, 5000), (4, 10**5), (5, 512), (6, 513)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long").selectExpr("*", "1 AS shard", "2 AS bin", "3 AS piece")
    got = pack(df).collect()
    check_bins(got)
    assert sum(r.n_tokens for r in got) == sum(max(1, n or 1) for _, n in rows)
    assert pack(df.limit(0)).count() == 0


def test_variable_lengths_cost_no_more_than_any_single_length():
    import random

    sizes = sorted((random.Random(5).choices([30, 200, 400, 700, 1500, 3000, 4096], k=800)), reverse=True)
    bins, offsets, final = pack_lengths(sizes)
    cost = sum(sequence_cost(c, 4096) for c in final)
    single, _, only = pack_lengths(sizes, (4096,))
    assert cost <= sum(sequence_cost(c, 4096) for c in only)
    assert len(bins) == len(offsets) == len(sizes) and pack_lengths([]) == ([], [], [])


def test_repeated_rows_meet_the_target_within_half_a_document(spark, make_docs):
    same = [(1, " ".join(["w"] * 20), "a")] * 1000
    rows = same + [(2 + i, " ".join(["v"] * 50), "b") for i in range(60)]
    got = mix_report(make_docs(rows)).collect()
    source = {r[0]: r[2] for r in rows}
    check_mix(rows, [(*r, source[r.doc_id]) for r in got])
    taken = sum(r.taken for r in got if r.doc_id == 1)
    assert taken != 20_000 and abs(taken - next(r.target for r in got if r.doc_id == 1)) <= 10
    mixed = mix(make_docs(rows)).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mixed}[1] == taken // 20


def test_rows_without_ids_are_drawn_one_by_one(spark, make_docs):
    rows = [(None, " ".join(["w"] * (10 + i % 7)) + f" t{i}", "a") for i in range(400)] + [(i, "x " * 30, "b") for i in range(20)]
    got = mix_report(make_docs(rows)).collect()
    by = {}
    for r in got:
        key = (r.source_size, r.target)
        by[key] = by.get(key, 0) + r.taken
    assert all(abs(n - t) <= 15 for (_, t), n in by.items())


def test_columns_that_clash_with_internal_ones_stay(spark, make_docs):
    df = make_docs([(1, "a b c", "a"), (2, "d e", "b"), (2, "d e", "b")]).selectExpr("*", "9 AS _tm_size", "8 AS _tm_doc", "7 AS more", "6 AS c")
    out = mix(df)
    assert out.columns == df.columns and {(r._tm_size, r._tm_doc, r.more, r.c) for r in out.collect()} == {(9, 8, 7, 6)}
    assert mix(df.limit(0)).count() == 0


def test_equal_rows_are_packed_in_several_shards(spark):
    df = spark.range(300_000).selectExpr("1L AS doc_id", "7L AS n_tokens", "3 AS copies", "4 AS last")
    got = pack(df.unionByName(spark.createDataFrame([(None, 5 * 10**7, 1, 1)], "doc_id long, n_tokens long, copies int, last int")))
    assert got.select("shard").distinct().count() > 10
    n, total = got.selectExpr("count(*)", "sum(n_tokens)").first()
    assert n == 300_000 + -(-5 * 10**7 // 4096) and total == 2_100_000 + 5 * 10**7
    assert max(r["count"] for r in got.groupBy("shard").count().collect()) < 25_000


def test_each_bin_takes_the_piece_that_best_fits(spark):
    """Against a plain search: same bins as scanning all open bins for the least room that fits, for the policy kept."""
    import random

    rng = random.Random(3)
    for _ in range(20):
        sizes = sorted((rng.randint(1, 4096) for _ in range(rng.randint(1, 120))), reverse=True)
        cost = {c: sequence_cost(c, LENGTHS[-1]) for c in LENGTHS}
        plans = []
        for limit in LENGTHS:
            room, used, left = [], [], sum(sizes)
            for s in sizes:
                open_bins = [(r, b) for b, r in enumerate(room) if r >= s]
                if open_bins:
                    least = min(r for r, _ in open_bins)
                    b = next(b for r, b in open_bins if r == least)
                else:
                    allowed = [c for c in LENGTHS if s <= c <= limit] or [min(c for c in LENGTHS if c >= s)]
                    room.append(min(allowed, key=lambda c: (cost[c] / min(c, left), c)))
                    used.append(0)
                    b = len(room) - 1
                room[b] -= s
                used[b] += s
                left -= s
            plans.append(sum(cost[min(c for c in LENGTHS if c >= u)] for u in used))
        _, _, final = pack_lengths(sizes)
        assert sum(cost[c] for c in final) <= min(plans) * 1.02
