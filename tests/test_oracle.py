"""Registered queries of the market library against their SQL, on the smallest driver tables."""

import math
import os
from glob import glob

import duckdb
import numpy as np
import pandas as pd
import pytest

from tapeworks.plans import catalog

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in glob(f"{DIR}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, np.generic):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else int(v) if v.is_integer() else v
    return str(pd.Timestamp(v)) if hasattr(v, "isoformat") else v


def rows(df):
    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, DIR).toPandas()
    want = duck.execute(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_without_sql_runs(spark):
    for name in sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)):
        assert catalog.QUERIES[name](spark, DIR).count() > 0


def test_panel_has_158_factors(spark):
    assert len(catalog.QUERIES["alpha158_full"](spark, DIR).columns) == 2 + 158


def test_features_share_one_exchange(spark):
    from tapeworks.operators.bars import daily_features
    from tapeworks.plans.views import bars_daily

    b = bars_daily(spark, DIR)
    plan = daily_features(b)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the bars' aggregate, and the symbol


def test_range_query_reaches_the_scan(spark, tmp_path):
    from tapeworks.operators.access import query_range
    from tapeworks.plans.views import bars_daily

    bars_daily(spark, DIR).write.parquet(str(tmp_path / "b"))
    q = query_range(spark.read.parquet(str(tmp_path / "b")), "stocks_daily", ["S1"], ["close"], "2024-01-05", "2024-01-09")
    plan = q._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(date" in pushed and "ReadSchema: struct<symbol:string,date:date,close:double>" in pushed
