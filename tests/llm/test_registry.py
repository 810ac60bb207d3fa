"""The corpus queries are registered, and those with SQL equal it on the smallest tables."""

import re
from collections import Counter
from pathlib import Path

import pytest

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")


def test_every_operator_has_its_query():
    import __spark_entry__ as contract
    names = contract.queries()
    numbers = sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in names and set(contract.oracle_sql()) <= set(names)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables absent")
@pytest.mark.parametrize("name", ["op4_line_dedup", "op5_url_filter"])
def test_query_equals_sql(spark, name):
    import __spark_entry__ as contract
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cur = con.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    want = Counter(cur.fetchall())
    df = contract.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == want
