"""Every registered query with an oracle equals its DuckDB SQL at sf0.001."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as E
from pricelens.fixture import BASE_TABLES
from pricelens.plans import registry

registry.load_all()
QUERIES = registry.QUERIES
ORACLE = registry.ORACLE


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(repr(_norm(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        p = Path(SF_SMALL) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = {"match_candidates", "price_prediction"}
    assert set(QUERIES) - set(ORACLE) == rows_only
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    d_cols, d_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _bag(s_cols, s_rows) == _bag(d_cols, d_rows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["product_name", "price", "sale_price", "on_sale", "source", "url", "category",
                          "brand", "sku", "scraped_at", "price_bucket"]
    assert df.count() > 0
