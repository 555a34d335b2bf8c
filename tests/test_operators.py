"""Hand-computed rows, nulls, zeros and ties, which the driver tables have few of."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tapeworks.functions import exprs as X
from tapeworks.operators import access, actions, alpha158, bars, fundamentals, joins, options, quality, signals, summaries

D = dt.date


def collect(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def series(spark, closes, symbol="A", volumes=None):
    v = volumes or [100] * len(closes)
    rows = [(symbol, D(2024, 1, 1) + dt.timedelta(i), c, c + 1.0, c - 1.0, c, n, 1) for i, (c, n) in enumerate(zip(closes, v, strict=True))]
    return spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, volume bigint, transactions bigint")


def test_sdiv_and_logs_of_nothing(spark):
    r = spark.range(1).select(X.sdiv(F.lit(1.0), F.lit(0.0)), X.sdiv(F.lit(None).cast("double"), F.lit(2.0)), X.positive_ln(F.lit(0.0)), X.positive_ln(F.lit(-1.0))).first()
    assert tuple(r) == (None,) * 4


def test_bars_take_first_and_last_by_time_then_id(spark):
    t = dt.datetime(2024, 1, 2, 10)
    ticks = spark.createDataFrame([(2, "A", t, 20.0, 1), (1, "A", t, 10.0, 2), (3, "A", t, 30.0, None), (9, None, t, 1.0, 1)], "event_id bigint, symbol string, ts timestamp, price double, volume bigint")
    assert collect(bars.daily_bars(ticks).filter("symbol = 'A'")) == [("A", D(2024, 1, 2), 10.0, 30.0, 10.0, 30.0, 3, 3)]
    assert bars.daily_bars(ticks.limit(0)).count() == 0


def test_daily_features_by_hand(spark):
    f = bars.daily_features(series(spark, [100.0, 110.0, 0.0, 121.0], volumes=[10, 0, 5, 5])).orderBy("date").collect()
    assert f[0]["returns_1d"] is None and math.isclose(f[1]["returns_1d"], -math.log(1.1))
    assert f[2]["returns_1d"] is None and f[3]["returns_1d"] is None  # a price of 0 on either side
    assert f[1]["vwap"] is None and f[1]["money_flow"] is None  # no volume
    assert f[1]["volume_ratio"] == 0.0 and f[2]["daily_return"] is None
    assert math.isclose(f[1]["simple_return"], 0.1)


def test_intraday_vwap_shares_a_timestamp(spark):
    t = dt.datetime(2024, 1, 2, 10)
    rows = [("A", t, 1.0, 1.0, 1.0, 1.0, 1, 1), ("A", t, 3.0, 3.0, 3.0, 3.0, 1, 1), ("A", t + dt.timedelta(days=1), 5.0, 5.0, 5.0, 5.0, 1, 1)]
    b = spark.createDataFrame(rows, "symbol string, timestamp timestamp, open double, high double, low double, close double, volume bigint, transactions bigint")
    assert sorted(r["vwap_intraday"] for r in bars.minute_features(b).collect()) == [2.0, 2.0, 5.0]


def test_registered_features(spark):
    bars.register_feature("twice", lambda key, order: F.col("close") * 2)
    assert [r["twice"] for r in bars.with_registered(series(spark, [1.0, 2.0]), ["twice"]).orderBy("date").collect()] == [2.0, 4.0]
    with pytest.raises(KeyError):
        bars.with_registered(series(spark, [1.0]), ["unknown"])
    with pytest.raises(TypeError):
        bars.register_feature("bad", 3)


def test_rsi_and_obv(spark):
    s = signals.price_signals(series(spark, [10.0, 11.0, 11.0, 10.0], volumes=[5, 7, 11, 13])).orderBy("date").collect()
    assert s[0]["rsi_14"] is None and s[1]["rsi_14"] == 100.0
    assert [r["obv"] for r in s] == [0, 7, -4, -17]  # an equal price subtracts


def test_exact_ema_and_macd_are_pandas(spark):
    closes = [10.0 + math.sin(i) * 3 + i / 7 for i in range(60)]
    got = signals.exact_ema(series(spark, closes), [12, 26]).orderBy("date").toPandas()
    want = pd.Series(closes)
    e12, e26 = want.ewm(span=12, adjust=False).mean(), want.ewm(span=26, adjust=False).mean()
    assert np.allclose(got.ema_12, e12) and np.allclose(got.macd_signal, (e12 - e26).ewm(span=9, adjust=False).mean())
    cut = series(spark, closes).select("date", signals.ema(12).alias("e")).orderBy("date").toPandas()
    assert np.allclose(cut.e, e12)  # 120 rows reach back to the start here


def test_panel_invariants(spark):
    b = series(spark, [5.0 + math.cos(i) for i in range(80)], volumes=[100 + i % 7 for i in range(80)]).unionByName(series(spark, [7.0] * 10, "FLAT"))
    p = alpha158.alpha158(b).toPandas()
    assert len(p.columns) == 160
    for c in p.columns:
        if c.startswith(("CORR", "CORD")):
            assert p[c].dropna().abs().max() <= 1 + 1e-9
    flat = p[p.symbol == "FLAT"]
    assert flat.CORR5.isna().all() and flat.RSQR5.isna().all() and (flat.MA5 == 1).all()
    few = alpha158.alpha158(b, (5, 10), {"MA"}, min_periods=5)
    assert few.columns[-2:] == ["MA5", "MA10"]
    assert few.filter("symbol = 'FLAT'").orderBy("date").first()["MA5"] is None


GOLDEN = [
    ("O:SPY230327P00390000", ("SPY", D(2023, 3, 27), "P", 390.0)), ("O:AAPL250117C00150000", ("AAPL", D(2025, 1, 17), "C", 150.0)), ("O:TSLA240315C00800000", ("TSLA", D(2024, 3, 15), "C", 800.0)),
    ("O:F250620C00012500", ("F", D(2025, 6, 20), "C", 12.5)), ("O:ORCL250117C00125750", ("ORCL", D(2025, 1, 17), "C", 125.75)),
    ("O:SPY", None), ("O:SPY230327", None), ("O:SPY230327X00390000", None), ("O:SPY231399P00390000", None), ("", None), (None, None),
]


@pytest.mark.parametrize("ticker,want", GOLDEN)
def test_option_tickers(spark, ticker, want):
    r = spark.createDataFrame([(ticker,)], "ticker string").select(options.parsed().alias("p"), options.is_valid().alias("v")).first()
    assert (tuple(r["p"]) if r["p"] else None) == want and r["v"] == (want is not None)


def test_option_tickers_end_where_the_text_ends(spark):
    t = spark.createDataFrame([("O:SPY230327P00390000\n",), ("O:SPY230327P00390000",)], "ticker string")
    assert [r["strike_price"] for r in options.with_parsed(t).collect()] == [None, 390.0]


def test_tickers_are_parsed_once(spark):
    made = spark.range(20).select(F.concat(F.lit("O:A24011"), F.col("id") % 10, F.lit("C00001000")).alias("ticker"), "id")
    for df in (options.contracts(made), options.with_parsed(made).filter("strike_price > 0 AND underlying = 'A'")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 1
        assert df.count() in (10, 20)


def test_ratios_with_nulls_and_zeros(spark):
    rows = [("A", 2020, "Q1", 200.0, 50.0, 0.0, None, 30.0, 10.0), ("B", 2020, "Q1", 0.0, None, 5.0, 4.0, None, -1.0)]
    df = spark.createDataFrame(rows, "ticker string, fiscal_year int, fiscal_period string, assets double, equity double, current_liabilities double, long_term_debt double, revenues double, net_income_loss double")
    a, b = fundamentals.ratios(df).orderBy("ticker").collect()
    assert a["roa"] == 5.0 and a["roe"] == 20.0 and a["roic"] == 20.0 and a["current_ratio"] is None and a["debt_to_equity"] is None
    assert b["roa"] is None and b["roe"] is None and b["gross_margin"] is None


def test_quality_score_counts_only_what_is_known(spark):
    rows = [("A", D(2020, 1, 1), 10.0, 100.0, 50.0, 20.0, 10.0, 5.0), ("A", D(2020, 4, 1), 20.0, 100.0, 40.0, 30.0, 10.0, None)]
    df = spark.createDataFrame(rows, "ticker string, filing_date date, is_net_income_loss double, bs_assets double, bs_liabilities double, bs_current_assets double, bs_current_liabilities double, cf_net_cash_flow_from_operating_activities double")
    first, second = fundamentals.wide_quality(df).orderBy("filing_date").collect()
    assert (first["piotroski_score"], second["piotroski_score"]) == (2, 4) and not second["has_complete_data"]


def test_flatten_and_union(spark, tmp_path):
    p = tmp_path / "f.json"
    p.write_text('{"tickers":["A","B"],"financials":{"balance_sheet":{"assets":{"value":5,"unit":"USD"}},"income_statement":{"revenues":{"value":"x"}}}}\n{"tickers":[],"financials":{}}\n')
    flat = fundamentals.first_ticker(fundamentals.flatten_statements(spark.read.json(str(p))))
    assert collect(flat.select("ticker", "bs_assets", "is_revenues"), F.col("ticker").asc_nulls_last()) == [("A", 5.0, None), (None, None, None)]
    u = fundamentals.aligned_union([fundamentals.integers_to_double(spark.createDataFrame([(1,)], "a int")), spark.createDataFrame([(2.0, "x")], "a double, b string")])
    assert sorted(collect(u), key=str) == [(1.0, None), (2.0, "x")]


def test_wide_join_coalesces_keys(spark):
    keys = "ticker string, filing_date date, fiscal_year int, fiscal_period string"
    row = lambda t, v: [(t, D(2020, 1, 1), 2020, "Q1", v)]
    mk = lambda t, c: spark.createDataFrame(row(t, 1.0), f"{keys}, {c} double")
    w = fundamentals.wide(mk("A", "assets"), mk("B", "revenues"), mk("A", "ocf"), stamp=True)
    assert collect(w.select("ticker", "bs_assets", "is_revenues", "cf_ocf"), "ticker") == [("A", 1.0, None, 1.0), ("B", None, 1.0, None)]


def test_as_of_takes_the_latest_not_later(spark):
    left = spark.createDataFrame([("A", D(2024, 1, d)) for d in (1, 5, 9)] + [("B", D(2024, 1, 5))], "symbol string, date date")
    right = spark.createDataFrame([("A", D(2024, 1, 5), 1.0), ("A", D(2024, 1, 7), None)], "symbol string, filed date, v double")
    assert collect(joins.as_of(left, right, "symbol", "date", "filed", ["v"]), "symbol", "date") == [("A", D(2024, 1, 1), None, None), ("A", D(2024, 1, 5), D(2024, 1, 5), 1.0), ("A", D(2024, 1, 9), D(2024, 1, 7), None), ("B", D(2024, 1, 5), None, None)]


def test_calendar_alignment_is_symbols_times_days(spark):
    b = series(spark, [1.0, 2.0]).unionByName(series(spark, [3.0], "B"))
    cal = b.select("date").distinct()
    p = quality.aligned_panel(b, cal, ["close"])
    assert p.count() == 4 and dict(p.dtypes)["close"] == "float"
    assert quality.panel_check(p, cal).count() == 0 and quality.panel_check(b, cal).count() == 1


def test_split_adjustment_uses_later_splits_only(spark):
    e = spark.createDataFrame([("A", D(2024, 1, 2), 2.0), ("A", D(2024, 1, 2), 5.0)], "ticker string, event_date date, split_ratio double")
    got = actions.split_adjusted(series(spark, [100.0, 10.0, 11.0]), e).orderBy("date").collect()
    assert [round(r["adjusted_close"], 9) for r in got] == [10.0, 10.0, 11.0]


def test_market_cap_classes(spark):
    df = spark.createDataFrame([(200e9,), (10e9,), (2e9,), (300e6,), (50e6,), (1.0,), (None,)], "market_cap double")
    assert [r[0] for r in df.select(actions.market_cap_class()).collect()] == ["mega", "large", "mid", "small", "micro", "nano", "nano"]


def test_news_rows_and_counts(spark):
    df = spark.createDataFrame([("1", "2024-01-02T03:04:05Z", ["A", None, "B"], "u"), ("1", "2024-01-02T03:04:05Z", ["A"], None), ("2", "bad", ["A"], None), ("3", None, ["A"], None), ("4", "2024-01-02T03:04:05Z", None, None)], "id string, published_utc string, tickers array<string>, amp_url string")
    assert collect(actions.news_counts(actions.news_rows(df)), "ticker") == [("A", "2024-01-02", 2, 1, 1), ("B", "2024-01-02", 1, 1, 1)]


def test_filters_reject_unknown_operators(spark):
    with pytest.raises(ValueError):
        access.where(spark.range(1), [("id", "like", 1)])
    assert access.where(spark.range(5), []).count() == 5


def test_load_warns_of_unknown_columns(spark):
    df = spark.createDataFrame([("A", "2024-01-02"), ("A", "bad"), ("B", "2024-01-02")], "ticker string, date string")
    with pytest.warns(UserWarning):
        got = access.load(df, ["a"], "2024-01-01", "2024-01-31", ["ticker", "nope"])
    assert collect(got) == [("A",)]


def test_gaps_and_ranges(spark):
    days = spark.createDataFrame([(D(2024, 1, d),) for d in (5, 8, 9, 9, 15)], "date date")  # Friday, Monday, ...
    gaps = quality.date_gaps(days.withColumn("k", F.lit(1)), "k").drop("k")
    assert collect(gaps, "gap_start") == [(D(2024, 1, 6), D(2024, 1, 7)), (D(2024, 1, 10), D(2024, 1, 14))]
    assert collect(quality.trading_gaps(gaps)) == [(D(2024, 1, 10), D(2024, 1, 14))]
    assert collect(quality.date_ranges(days), "range_start") == [(D(2024, 1, 5), D(2024, 1, 5), 1), (D(2024, 1, 8), D(2024, 1, 9), 2), (D(2024, 1, 15), D(2024, 1, 15), 1)]


def test_layers_of_the_same_dates_miss_none(spark):
    b = spark.createDataFrame([("A", dt.date(2024, 1, 2)), ("B", dt.date(2024, 1, 3))], "symbol string, date date")
    got = quality.integrity(b, b, "stocks_daily").first()
    assert (got["rows"], got["gaps"], got["missing_after"], got["missing_before"]) == (2, 0, 0, 0)
    assert quality.null_counts(b.limit(0), ["symbol"]).first()["null_symbol"] == 0


def test_enriching_a_range_equals_the_whole_trimmed(spark):
    b = series(spark, [100.0 + i % 5 for i in range(90)])
    part = quality.enrich_range(b, bars.daily_features, "2024-03-10", "2024-03-20")
    whole = bars.daily_features(b).filter("date BETWEEN '2024-03-10' AND '2024-03-20'")
    assert collect(part, "date") == collect(whole, "date") and part.count() == 11
    done = quality.dates(spark, "2024-03-11", "2024-03-19")
    filled = quality.backfill(b, bars.daily_features, quality.dates(spark, "2024-03-10", "2024-03-20"), done)
    assert [r["date"] for r in filled.orderBy("date").collect()] == [D(2024, 3, 10), D(2024, 3, 20)]


def test_epoch_units(spark):
    df = spark.createDataFrame([(1704067200,), (1704067200000,), (1704067200000000,), (1704067200000000000,), (17040672000000000,), (None,)], "w bigint")
    assert [r[0] for r in df.select(quality.epoch_unit("w")).collect()] == ["s", "ms", "us", "ns", None, None]


def test_constant_sides_have_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 4.0)], "a double, b double")
    got = {(r["a"], r["b"]): r["corr"] for r in summaries.correlations(df, ["a", "b"]).collect()}
    assert got[("a", "a")] is None and got[("a", "b")] is None and math.isclose(got[("b", "b")], 1.0)


def test_empty_tables(spark):
    e = series(spark, [1.0]).limit(0)
    for df in (bars.daily_features(e), signals.price_signals(e), alpha158.alpha158(e, (5,)), quality.instruments(e), quality.date_gaps(e, "symbol"), signals.top_k(e, 3, "close", "date")):
        assert df.count() == 0
    assert summaries.candle_counts(e).count() == 1


@pytest.mark.parametrize("accuracy", [100_000, 40])
def test_exact_quantiles_are_numpy_s(spark, monkeypatch, accuracy):
    """With all values in order, and with bounds from an approximate pass; ties, keys, nulls, one value and none."""
    monkeypatch.setattr(summaries, "ACCURACY", accuracy)
    rng = np.random.default_rng(5)
    groups = {"a": rng.normal(size=997).round(2), "b": np.repeat([1.0, 2.0, 7.0], 300), "c": np.array([4.0]), "d": np.exp(rng.normal(size=500) * 9)}
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [("a", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(7)
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = {r["k"]: r[1:] for r in summaries.exact_quantiles(df, "x", shares, "k").collect()}
    assert got.keys() == groups.keys()
    for k, v in groups.items():
        assert np.allclose(got[k], np.quantile(v, shares), rtol=1e-12), k
    assert summaries.exact_quantiles(df.limit(0), "x", [0.5]).count() == 0
    one = summaries.exact_quantiles(df.filter("k = 'a'"), F.abs("x"), [0.5]).first()["q0"]
    assert math.isclose(one, np.quantile(np.abs(groups["a"]), 0.5))


def test_nothing_is_over_the_quantile_of_nothing(spark):
    b = series(spark, [1.0, 2.0, 3.0]).withColumn("x", F.lit(None).cast("double"))
    assert access.above_quantile(b, "x", 0.5).count() == 0
    assert summaries.outliers(b, "x").collect() == [(0, 0)]
    assert signals.robust_zscore(b, "x", "close").select("x_z").distinct().collect() == [(0.0,)]


def test_range_of_a_thinly_traded_symbol_is_that_of_the_full_run(spark):
    """Frames count rows, so the history is counted in rows too."""
    closes = [100.0 + i * i % 17 for i in range(60)]
    b = series(spark, closes).withColumn("date", F.date_add(F.lit("2019-01-01").cast("date"), F.datediff("date", F.lit("2024-01-01").cast("date")) * 30)).withColumn("nth", F.lit(7))
    full = bars.daily_features(b)
    part = quality.enrich_range(b, bars.daily_features, "2023-06-01", "2023-10-01")
    want = collect(full.filter("date BETWEEN '2023-06-01' AND '2023-10-01'").select("date", "returns_20d", "volatility_20d", "nth"), "date")
    assert len(want) == 4 and collect(part.select("date", "returns_20d", "volatility_20d", "nth"), "date") == want


def test_schema_differences_name_column_and_types(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(3).selectExpr("id", "1.5D AS x").write.parquet(a)
    spark.range(3).selectExpr("id", "'t' AS x", "1 AS more").write.parquet(b)
    assert sorted(r[1:] for r in map(tuple, quality.schema_differences(spark, [a, b]).collect())) == [("more", "int", None), ("x", "string", "double")]
    assert quality.schema_differences(spark, [a, a]).count() == 0
