import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.queries import op4_token_counts, op9_token_output, vocabulary
from tidemark.llm.tokenfile import Dac, read_token_file, write_token_file
from tidemark.llm.tokens import Counter, Encoder, count_report, count_tokens, prove_whole_tokens

PATH = vocabulary()


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def whole():
    return prove_whole_tokens(PATH)


def ids(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


def test_proved_strings_are_single_tokens(tok, whole):
    assert len(whole) > 40_000
    assert all(len(ids(tok, s)) == 1 for s in whole[::97])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'sd .,\n\t\r \x1c é漢1²!?€<|>\U0001f600́"), max_size=30), max_size=4))
def test_units_equal_the_library(texts):
    tok, encode, count = Tokenizer.from_file(PATH), Encoder(PATH), COUNTER
    want = [ids(tok, t) for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == want
    assert count(texts) == [len(w) for w in want]


COUNTER = Counter(PATH, prove_whole_tokens(PATH))


def test_counts_of_odd_rows(spark, make_docs, odd_rows, tok):
    got = sorted(map(tuple, count_report(make_docs(odd_rows), PATH).collect()), key=str)
    want = sorted([(i, len((t or "").encode()), n := len(ids(tok, t)), n > 512) for i, t, *_ in odd_rows], key=str)
    assert got == want
    kept = count_tokens(make_docs(odd_rows), PATH)
    assert kept.count() == len(odd_rows) and dict(kept.dtypes)["n_tokens"] == "bigint"
    assert count_report(make_docs(odd_rows).limit(0), PATH).count() == 0


def test_query_equals_library_on_the_whole_table(spark, sf, tok):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op4_token_counts(spark, sf).collect()}
    assert got == {k: (len((t or "").encode()), n := len(ids(tok, t)), n > 512) for k, t in texts.items()}


def expected_file(rows, tok):
    start, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        x = [*ids(tok, t), 2]
        out.append((i, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    return out


def test_token_file_of_odd_rows(spark, make_docs, odd_rows, tok):
    file, _ = write_token_file(make_docs(odd_rows), PATH, rows_per_range=2)
    got = sorted(map(tuple, read_token_file(file).collect()), key=lambda r: r[1])
    assert got == expected_file([r[:2] for r in odd_rows], tok)
    file, _ = write_token_file(make_docs(odd_rows).limit(0), PATH)
    assert read_token_file(file).count() == 0


def test_token_query(spark, sf, tok):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, op9_token_output(spark, sf).collect()), key=lambda r: r[1]) == expected_file(rows, tok)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=3000))
def test_codes_round_trip_and_random_access(values):
    dac = Dac.from_bytes(Dac.encode(np.array(values, dtype=np.uint32)).to_bytes())
    assert dac.decode().tolist() == values and len(dac) == len(values)
    for i in range(0, len(values), 37):
        assert dac[i] == values[i]


def test_random_access_across_rank_blocks():
    values = np.random.default_rng(1).integers(0, 60_000, 200_000).astype(np.uint32)
    dac = Dac.from_bytes(Dac.encode(values).to_bytes())
    for i in (0, 511, 512, 4096, 131_071, 199_999):
        assert dac[i] == values[i]
    with pytest.raises(IndexError):
        dac[200_000]


def test_one_id_with_many_documents_is_written_whole(spark):
    import zlib

    from tidemark.llm.queries import vocabulary
    from tidemark.llm.tokenfile import read_token_file, write_token_file
    from tidemark.llm.tokens import library

    rows = [(None, f"no id {i}") for i in range(300)] + [(7, "the same words")] * 300 + [(i, f"text number {i}") for i in range(300)]
    file, _ = write_token_file(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS part", "2 AS lengths"), vocabulary(), rows_per_range=10)
    got = sorted(read_token_file(file).collect(), key=lambda r: r.start)
    assert len(got) == 900 and file.groupBy("part").count().count() > 60
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    tok = library(vocabulary())
    want = sorted(zlib.crc32(b"".join(i.to_bytes(4, "little") for i in [*tok.encode(t, add_special_tokens=False).ids, 2])) for _, t in rows)
    assert sorted(r.ids_crc32 for r in got) == want
    again = sorted(read_token_file(write_token_file(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary(), rows_per_range=10)[0]).collect(), key=lambda r: r.start)
    assert again == got


def test_units_without_spaces_do_not_fill_the_cache():
    from tidemark.llm.queries import vocabulary
    from tidemark.llm.tokens import LONGEST, Encoder

    e = Encoder(vocabulary())
    e([" ".join("x" * n + str(n) for n in range(1, 400))])
    assert e and all(len(u) <= LONGEST for u in e)
