"""Registered queries beside their SQL on the smallest tables; check_catalog.py runs all of them."""

from collections import Counter
from pathlib import Path

import pytest

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables absent")
QUICK = ("walk_minutes", "place_filter", "overlay_merge", "layer_merge", "coverage_rollup", "inspection_unify", "item_ids", "price_level",
         "token_df", "nutrient_fallback", "missing_records", "vote_route", "unread_items", "freshness", "layer_integrity", "document_shape",
         "pattern_lines", "snapshot_append", "csv_projection")


def test_every_query_is_callable_and_sql_has_its_query():
    import __spark_entry__ as contract
    queries = contract.queries()
    assert set(contract.oracle_sql()) <= set(queries) and len(queries) > 100


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    import __spark_entry__ as contract
    from check_catalog import TABLES, plain
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cur = con.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    want = Counter(tuple(plain(v) for v in row) for row in cur.fetchall())
    df = contract.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert Counter(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want
