"""The registered queries against their SQL, on the driver's smallest tables."""

import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from loomspar.plans import registry

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def _plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.skipif(not DATA.exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, tables, name):
    df = registry.QUERIES[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = Counter(tuple(_plain(r[c]) for c in cols) for r in df.collect())
    found = tables.execute(registry.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == Counter(tuple(_plain(r[i]) for i in at) for r in found.fetchall())


def test_entry_imports():
    import __spark_entry__ as e

    assert set(registry.QUERIES) <= set(e.queries()) and set(registry.SQL) <= set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("without", [("loomspar/llm", "tests/llm"), ("loomspar/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_stands_without_the_training_data_operators(tmp_path, without):
    root = Path(__file__).resolve().parent.parent
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *[Path(w).name for w in without]))
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q) and not [n for n in q if n[:2] == 'op' and n[2].isdigit()] and 'pipeline' not in q; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"}, timeout=120)
    assert done.returncode == 0 and int(done.stdout) == len(registry.QUERIES), done.stderr
