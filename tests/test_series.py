"""Long series in chunks: numbers, overlaps, sliding statistics, recursive averages."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tapeworks.operators import actions, alpha158, joins, signals
from tapeworks.operators.bars import daily_features
from tapeworks.operators.chunks import days, in_chunks, numbered, overlapped
from tapeworks.operators.gram import series_correlations
from tapeworks.operators.sliding import Sliding, quantile

BARS = "symbol string, date date, open double, high double, low double, close double, volume bigint, transactions bigint"


def bars(spark, lengths, seed=1, gap=0.0):
    """Bars of symbols of some lengths; ``gap``: the share of rows without prices."""
    rng, rows = random.Random(seed), []
    for s, n in lengths.items():
        for i in range(n):
            c = round(rng.choice([50.0, 100.0, 100 + rng.random() * 5]), 1)
            row = [c - 1, c + rng.randrange(3), c - 2 - rng.randrange(3), c]
            rows.append((s, dt.date(1990, 1, 1) + dt.timedelta(days=i * 2), *(row if rng.random() >= gap else [None] * 4), rng.randrange(5), 1))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, BARS)


def test_numbers_and_overlaps(spark):
    b = bars(spark, {"A": 700, "B": 3, None: 40})
    n = numbered(b, days(64))
    assert n.columns == [*b.columns, "i_"]
    for (s,) in b.select("symbol").distinct().collect():
        got = [r["i_"] for r in n.filter(F.col("symbol").eqNullSafe(s)).orderBy("date").collect()]
        assert got == list(range(1, len(got) + 1))
    parts = overlapped(n, 100, 60)
    assert parts.filter("own_").count() == 743
    heads = parts.filter("not own_ and symbol = 'A'").groupBy("chunk_").agg(F.min("i_"), F.max("i_")).orderBy("chunk_").collect()
    assert [tuple(r) for r in heads] == [(k, 100 * k - 59, 100 * k) for k in range(1, 8)]
    with pytest.raises(ValueError):
        overlapped(n, 50, 60)
    assert overlapped(numbered(b.limit(0), days(9)), 100, 60).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 60])
def test_sliding_order_statistics_by_hand(n):
    rng, s = random.Random(n), Sliding(n)
    rows = [tuple(rng.choice([None, 1.0, 2.0, 3.5, rng.random()]) for _ in range(3)) for _ in range(400)]
    for i, (c, h, low) in enumerate(rows):
        window = rows[max(0, i - n + 1) : i + 1]
        closes = sorted(x[0] for x in window if x[0] is not None)
        at = range(max(0, i - n + 1), i + 1)
        highs, lows = [(x[1], k) for k, x in zip(at, window, strict=True) if x[1] is not None], [(-x[2], k) for k, x in zip(at, window, strict=True) if x[2] is not None]
        want = (quantile(closes, 0.8), quantile(closes, 0.2), None if c is None else sum(x <= c for x in closes) / len(closes), closes[0], closes[-1]) if closes else (None,) * 5
        (high, high_at), (low_, low_at) = max(highs, default=(None, None)), max(lows, default=(None, None))
        assert s.add(i, c, h, low) == (*want, high_at, low_at, high, None if low_ is None else -low_)
        if closes:
            assert math.isclose(want[0], np.quantile(closes, 0.8)) and math.isclose(want[1], np.quantile(closes, 0.2))


def near(a, b):
    return all((x is None and y is None) or x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("gap", [0.0, 0.1])
def test_chunked_panel_is_the_whole_one(spark, gap):
    b = bars(spark, {"A": 900, "B": 5, "C": 120}, gap=gap)
    whole = alpha158.alpha158(b, (5, 60)).orderBy("symbol", "date").collect()
    parts = alpha158.alpha158(b, (5, 60), chunk_rows=64, bucket=days(100)).orderBy("symbol", "date").collect()
    assert len(whole) == len(parts) == 1025
    for x, y in zip(whole, parts, strict=True):
        assert near(x, y)


def test_long_symbol_takes_many_tasks(spark):
    b = bars(spark, {"A": 4000})
    with_task = lambda df: df.groupBy(F.spark_partition_id()).count().count()
    assert with_task(alpha158.alpha158(b, (5,), set())) == 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert with_task(alpha158.alpha158(b, (5,), set(), chunk_rows=200)) == 4  # all of them
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_panel_shares_one_exchange_and_sort(spark):
    plan = alpha158.alpha158(bars(spark, {"A": 9}), (5, 10))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_panel_statistics_are_pandas(spark):
    b = bars(spark, {"A": 300, "B": 80})
    got = alpha158.alpha158(b, (5, 30)).toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    p = b.toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    for n in (5, 30):
        roll = p.groupby("symbol").close.rolling(n, min_periods=1)
        for name, want in (("MA", roll.mean()), ("STD", roll.std()), ("MAX", roll.max()), ("QTLU", roll.quantile(0.8)), ("QTLD", roll.quantile(0.2))):
            assert np.allclose(got[f"{name}{n}"], want.to_numpy() / p.close, equal_nan=True)
        assert np.allclose(got[f"RANK{n}"], roll.rank(method="max", pct=True).to_numpy())
        ret = p.groupby("symbol").close.pct_change().abs() * p.volume
        wv = ret.groupby(p.symbol).rolling(n, min_periods=1)
        want = (wv.std() / wv.mean()).to_numpy()
        want[~np.isfinite(want)] = np.nan
        assert np.allclose(got[f"WVMA{n}"].astype(float), want, equal_nan=True)


def ewm(values, span):
    out, y, a = [], None, 2 / (span + 1)
    for x in values:
        if x is not None:
            y = x if y is None else a * x + (1 - a) * y
        out.append(y)
    return out


@pytest.mark.parametrize(("chunk", "gap"), [(256, 0.0), (16, 0.0), (16, 0.4), (1, 0.1)])
def test_ema_by_scan_is_the_recursion(spark, chunk, gap):
    b = bars(spark, {"A": 500 if chunk > 1 else 40, "B": 3, "C": 17}, gap=gap)
    b = b.withColumn("close", F.when((F.col("symbol") != "C") | (F.col("date") > dt.date(1990, 1, 5)), F.col("close")))  # C starts without prices
    got = signals.exact_ema(b, [1, 2, 12, 26], chunk_rows=chunk, bucket=days(70)).orderBy("symbol", "date").toPandas()
    assert list(got.columns) == ["symbol", "date", "close", "ema_1", "ema_2", "ema_12", "ema_26", "macd", "macd_signal", "macd_histogram"]
    for s, part in b.toPandas().groupby("symbol"):
        closes = [None if pd.isna(x) else x for x in part.sort_values("date").close]
        mine = got[got.symbol == s]
        e = {n: ewm(closes, n) for n in (1, 2, 12, 26)}
        for n, want in e.items():
            assert np.allclose(mine[f"ema_{n}"].astype(float), np.array(want, float), equal_nan=True)
        macd = [None if x is None else x - y for x, y in zip(e[12], e[26], strict=True)]
        assert np.allclose(mine.macd_signal.astype(float), np.array(ewm(macd, 9), float), equal_nan=True, atol=1e-9)
    with pytest.raises(ValueError):
        signals.exact_ema(b, [12], chunk_rows=10_000)


def test_ema_holds_no_series_in_one_task(spark):
    plan = signals.exact_ema(bars(spark, {"A": 2000}), [12, 26], chunk_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "Python" not in plan
    assert signals.exact_ema(bars(spark, {"A": 2}).limit(0), [12]).count() == 0


@pytest.mark.parametrize(("block", "span"), [(2, 30), (64, 512), (1, 7)])
def test_blocked_correlations_are_numpy_s(spark, block, span):
    rng = random.Random(block)
    start = dt.date(1969, 12, 1)  # days before 1970 too
    rows = [(f"é{s}" if s == 3 else f"s{s}", start + dt.timedelta(days=d), None if rng.random() < 0.1 else 5.1 if s == 4 else 1000 + rng.gauss(0, 1) + (d % 7) * s) for s in range(7) for d in range(100) if rng.random() < 0.7]
    rows += [("alone", dt.date(2050, 1, 1), 1.0), ("alone", dt.date(2050, 1, 2), 2.0), ("few", start, 1.0), (None, start, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, date date, v double")
    got = {(r["a"], r["b"]): (r["corr"], r["days"]) for r in series_correlations(df, F.col("v"), block=block, span=span).collect()}
    by = {}
    for s, d, v in rows:
        if s:
            by.setdefault(s, {})[d] = v
    want = {}
    for a in by:
        for b in by:
            common = [d for d in by[a] if d in by[b]]
            if a < b and common:
                xy = np.array([(by[a][d], by[b][d]) for d in common if by[a][d] is not None and by[b][d] is not None])
                flat = len(xy) < 2 or (xy.max(0) == xy.min(0)).any()
                want[a, b] = (None if flat else np.corrcoef(xy.T)[0, 1], len(common))
    assert got.keys() == want.keys()
    for k, (c, n) in want.items():
        assert got[k][1] == n and (c is None) == (got[k][0] is None) and (c is None or math.isclose(c, got[k][0], abs_tol=1e-9))
    assert series_correlations(df.limit(0), F.col("v")).count() == 0


def tasks(df):
    return df.groupBy(F.spark_partition_id()).count().count()


@pytest.mark.parametrize("span", [1, 30, 5000])
def test_as_of_carries_from_bucket_to_bucket(spark, span):
    rng = random.Random(span)
    day = lambda k: dt.date(2020, 1, 1) + dt.timedelta(days=k)
    right = [(rng.choice(["hot", "hot", "b", None]), day(k), k) for k in rng.sample(range(400), 60)] + [("hot", None, -1)]
    left = [(rng.choice(["hot"] * 5 + ["b", "c", None]), rng.choice([None, *map(day, range(-20, 420))]), i) for i in range(500)]
    lhs, rhs = spark.createDataFrame(left, "symbol string, date date, v int"), spark.createDataFrame(right, "symbol string, filed date, n int")
    got = {r["v"]: r["n"] for r in joins.as_of(lhs, rhs, "symbol", "date", "filed", ["n"], bucket=lambda t: days(span, t)).collect()}
    for s, d, v in left:
        found = [(f, n) for k, f, n in right if s is not None and k == s and f is not None and d is not None and f <= d]
        assert got[v] == (max(found)[1] if found else None)
    assert joins.as_of(lhs.limit(0), rhs, "symbol", "date", "filed", ["n"]).count() == 0


def test_split_factors_over_buckets(spark):
    rng = random.Random(3)
    b = bars(spark, {"A": 300, "B": 4})
    splits = [("A", dt.date(1990, 1, 1) + dt.timedelta(days=rng.randrange(650)), rng.choice([2.0, 0.5, 3.0, 4.0])) for _ in range(12)] + [("C", dt.date(1990, 1, 1), 2.0)]
    events = spark.createDataFrame(splits, "ticker string, event_date date, split_ratio double")
    for span in (20, 5000):
        for r in actions.split_adjusted(b, events, span=span).collect():
            want = math.prod(x for t, d, x in splits if t == r["symbol"] and d > r["date"])
            assert math.isclose(r["split_factor"], want) and math.isclose(r["adjusted_close"], r["close"] / want)


def test_a_hot_key_takes_many_tasks(spark):
    b = bars(spark, {"A": 3000})
    filed = spark.createDataFrame([("A", dt.date(1990, 1, 1), 1)], "symbol string, filed date, n int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert tasks(joins.as_of(b, filed, "symbol", "date", "filed", ["n"], bucket=lambda t: days(100, t))) == 4
        assert tasks(actions.split_adjusted(b, filed.selectExpr("symbol AS ticker", "filed AS event_date", "2.0 AS split_ratio"), span=100)) == 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("size", [30, 64])
def test_features_in_chunks_are_the_whole_ones(spark, size):
    b = bars(spark, {"A": 400, "B": 7}).withColumn("own_", F.lit(1))  # a name that the chunks would take
    whole = daily_features(b).orderBy("symbol", "date")
    parts = in_chunks(b, daily_features, size, 22, days(90)).orderBy("symbol", "date")
    assert parts.columns == whole.columns
    for x, y in zip(whole.collect(), parts.collect(), strict=True):
        assert near(x, y)
