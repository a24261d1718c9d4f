import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm.fingerprints import SIZES, fingerprint_report, likeness, sketch, with_next
from tidemark.llm.queries import op2_document_fingerprints


def pieces(text):
    return [m for m in re.findall(r"[^ \t\n\x0b\f\r]+(?:[ \t\x0b\f\r]+[^ \t\n\x0b\f\r]+){0,19}", text)]


def keys(text):
    found = pieces(text)
    return {(p, found.count(p)) for p in set(found)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for n, (i, t) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + following[:q]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), jaccard(keys(t), keys(edited)), jaccard(keys(t), keys(following))))
    return out


def compare(df, rows):
    got = sorted(df.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256))
    want = sorted(expected(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in got] == [w[:3] for w in want]
    assert [(r.near_edited, r.near_next) for r in got] == [pytest.approx(w[3:]) for w in want]
    return got


def test_whole_table_equals_exact_likeness(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = compare(op2_document_fingerprints(spark, sf), rows)
    text = dict(rows)
    by_text = {}
    for r in got:
        by_text.setdefault(text[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values()) and len({min(v) for v in by_text.values()}) == len(by_text)


def test_odd_rows(spark, make_docs, odd_rows):
    compare(fingerprint_report(make_docs(odd_rows)), [r[:2] for r in odd_rows])
    compare(fingerprint_report(make_docs([(9, "one document alone\nwith lines")])), [(9, "one document alone\nwith lines")])
    assert fingerprint_report(make_docs(odd_rows).limit(0)).count() == 0


def test_next_documents_across_ranges(spark, make_docs):
    rows = [(i * 7 % 101, f"text {i}") for i in range(101)]
    got = {r.doc_id: r.next_text for r in with_next(make_docs(rows), rows_per_range=5).collect()}
    ordered = sorted(rows)
    assert got == {d: ordered[(n + 1) % len(ordered)][1] for n, (d, _) in enumerate(ordered)}


def test_failed_peelings_are_tried_with_larger_sketches(spark):
    cases = [(0, 0), (1, 0), (10, 10), (30, 10), (200, 150), (3000, 10)]
    df = spark.createDataFrame([(n, a, b) for n, (a, b) in enumerate(cases)], "n int, a int, b int")
    made = df.select("n", F.expr("transform(sequence(1, a + 20), x -> xxhash64(x, 0))").alias("x"), F.expr("transform(sequence(a + 11, a + b + 20), x -> xxhash64(x, 0))").alias("y"))
    size = F.lit(SIZES[0])
    near = made.select("n", likeness(F.col("x"), F.col("y"), sketch(F.col("x"), size), sketch(F.col("y"), size)).alias("s"), F.expr("size(array_intersect(x, y)) / size(array_union(x, y))").alias("want")).collect()
    assert all(r.s.near == pytest.approx(r.want) for r in near) and [r.s.cells for r in sorted(near, key=lambda r: r.n)][:2] == [3 * SIZES[0]] * 2


def test_main_path_has_no_python(spark, sf):
    plan = op2_document_fingerprints(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_one_id_with_many_documents_is_spread_over_ranges(spark):
    """A third of the rows without an id, a third equal: every row has a next one, in ascending order of doc_id, and no range is large."""
    from tidemark.llm.shared import dealt_by_id

    rows = [(None, f"no id {i}") for i in range(400)] + [(7, "the same")] * 400 + [(i, f"text {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS at", "2 AS o", "3 AS h")
    dealt, ranges = dealt_by_id(df, 10)
    sizes = [r["count"] for r in dealt.groupBy("at").count().collect()]
    assert sum(sizes) == 1200 and max(sizes) < 100 and len(sizes) <= ranges
    got = with_next(df, 10).collect()
    assert len(got) == 1200
    nexts = sorted(r.next_text for r in got)
    assert nexts == sorted(t for _, t in rows)  # each document follows one
    following = {}
    for r in got:
        following.setdefault((r.doc_id, r.text), []).append(r.next_text)
    assert following[(399, "text 399")][0].startswith("no id") and following[(8, "text 8")] == ["text 9"] and following[(6, "text 6")][0] in ("the same", "text 7")
    assert sum(t == "the same" for t in following[(7, "the same")]) == 399 or sum(t in ("the same", "text 7") for t in following[(7, "the same")]) == 399
