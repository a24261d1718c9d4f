"""Every query against its SQL, and the entry module without the corpus subpackage."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tidemark.queries import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    blank = lambda x: x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x)
    return sorted(tuple("null" if blank(x) else str(float(x)) if isinstance(x, (int, float)) else repr(x) for x in r) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    got = QUERIES[name](spark, sf).toPandas()
    if name not in ORACLES:
        assert len(got)
        return
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_imports_without_the_corpus_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "tidemark"):
        (tmp_path / name).symlink_to(ROOT / name) if name.endswith(".py") else (tmp_path / name).mkdir()
    for p in (ROOT / "tidemark").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (tmp_path / "tidemark" / p.name).symlink_to(p)
    code = f"import sys; sys.path.insert(0, {str(tmp_path)!r}); import __spark_entry__ as e; assert 'app_4_tombstone_and_toast' in e.queries(); assert not [q for q in e.queries() if q.startswith('op')]; assert set(e.oracle_sql()) <= set(e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_outside_imports_the_corpus_subpackage():
    for p in (ROOT / "tidemark").rglob("*.py"):
        if "llm" not in p.parts:
            assert "tidemark.llm" not in p.read_text(), p
