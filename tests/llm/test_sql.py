"""The registered queries of this folder against their SQL, on the driver's smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from loomspar.llm import registry

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = registry.QUERIES[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = Counter(tuple(r[c] for c in cols) for r in df.collect())
    found = con.execute(registry.SQL[name])
    names = [d[0] for d in found.description]
    want = Counter(tuple(r[names.index(c)] for c in cols) for r in found.fetchall())
    assert sorted(names) == cols and got == want
    if name == "op1_chat_format":
        assert {r["link"] for r in df.select("link").distinct().collect()} == {"", "linked", "extra", "orphan"}
        assert {x for r in df.select("call_links").distinct().collect() for x in r.call_links.split(",")} == {"", "linked", "unanswered", "duplicate"}
