"""A subset of the registered queries against their DuckDB oracle at sf0.001."""
import math

import duckdb
import pytest

import __spark_entry__ as entry
from demandkit.sources.tables import TABLES

NAMES = ["demand_features", "product_brand_forecast", "inventory_optimization", "stock_health",
         "recommendations", "regression_metrics", "contiguous_folds", "pair_quantiles", "histogram",
         "label_encode", "drift_monitor", "box_stats", "stream_rolling_sales", "nightly_insights"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return None if v is None else str(v)


@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, small_dir, name):
    df = entry.queries()[name](spark, small_dir)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    a = sorted(tuple(_norm(r[i]) for i in order) for r in df.collect())
    b = sorted(tuple(_norm(r[i]) for i in oorder) for r in res.fetchall())
    assert a == b


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["date", "daily_total_demand"]


def test_every_query_has_callable_and_most_have_oracles():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 100
