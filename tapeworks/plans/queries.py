"""The library's operators over the views, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeworks.functions import exprs as X
from tapeworks.operators import access as Q
from tapeworks.operators import actions as C
from tapeworks.operators import alpha158 as K
from tapeworks.operators import bars as B
from tapeworks.operators import fundamentals as FU
from tapeworks.operators import joins as J
from tapeworks.operators import options as O
from tapeworks.operators import quality as DQ
from tapeworks.operators import signals as T
from tapeworks.operators import summaries as A
from tapeworks.plans import views as V
from tapeworks.plans.catalog import query
from tapeworks.sources import layouts, sinks
from tapeworks.sources.scratch import folder

W = "(PARTITION BY symbol ORDER BY date)"


def frame(n: int, key: str = "symbol", order: str = "date") -> str:
    return f"(PARTITION BY {key} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def nlr(k: int, key: str = "symbol", order: str = "date") -> str:
    """Negated log return, NULL for ratios that aren't positive."""
    lag = f"lag(close, {k}) OVER (PARTITION BY {key} ORDER BY {order})"
    return f"CASE WHEN close / nullif({lag}, 0) > 0 THEN -ln(close / nullif({lag}, 0)) END"


OHLC = ["open", "high", "low", "close"]

# ---------------------------------------------------------------- bars and features

DAILY = ["returns_1d", "returns_5d", "returns_20d", "alpha_daily", "alpha_5d", "alpha_20d", "price_range", "daily_return", "volume_ratio", "relative_volume", "vwap", "volatility_20d", "money_flow", "simple_return"]


def daily_sql(view: str) -> str:
    return f"""
WITH r AS (SELECT *, {nlr(1)} AS r1 FROM {view})
SELECT symbol, date, open, high, low, close, volume, transactions, r1 AS returns_1d, {nlr(5)} AS returns_5d, {nlr(20)} AS returns_20d, r1 AS alpha_daily, {nlr(5)} AS alpha_5d, {nlr(20)} AS alpha_20d,
  high - low AS price_range, (close - open) / nullif(open, 0) AS daily_return, volume / nullif(avg(volume) OVER {frame(21)}, 0) AS volume_ratio, volume / nullif(avg(volume) OVER {frame(20)}, 0) AS relative_volume,
  volume * ((high + low + close) / 3) / nullif(volume, 0) AS vwap, stddev_samp(r1) OVER {frame(21)} AS volatility_20d, volume * (volume * ((high + low + close) / 3) / nullif(volume, 0)) AS money_flow,
  close / nullif(lag(close) OVER {W}, 0) - 1 AS simple_return FROM r"""


@query("bars_daily_features", "A-1 W-1 W-2 W-3 W-4 W-5 W-6 W-7 W-8 W-9 W-10 W-22 SRC-4 L-1", daily_sql("bars_daily"), [*OHLC, *DAILY], ["symbol", "date", "volume", "transactions"])
def _(s, d):
    return B.daily_features(V.bars_daily(s, d)).orderBy("symbol", "date")


@query("bars_long_features", "W-1 W-6 W-9", daily_sql("bars_long"), dict.fromkeys([*OHLC, *DAILY], 6) | {"money_flow": 2}, ["symbol", "date", "volume", "transactions"])
def _(s, d):
    return B.daily_features(V.bars_long(s, d))


@query("a1_tick_bars_daily", "A-1", "SELECT symbol, date, open, high, low, close, volume, transactions FROM bars_daily", OHLC, ["symbol", "date", "volume", "transactions"])
def _(s, d):
    return V.bars_daily(s, d)


@query("a2_tick_bars_5min", "A-2", """SELECT symbol, time_bucket(INTERVAL 5 MINUTE, ts) AS timestamp, arg_min(price, row(ts, event_id)) AS open, max(price) AS high, min(price) AS low, arg_max(price,
  row(ts, event_id)) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS transactions
  FROM ticks GROUP BY 1, 2""", OHLC, ["symbol", "timestamp", "volume", "transactions"])
def _(s, d):
    return B.window_bars(V.ticks(s, d), 5, "minutes")


@query("a1_minutes_to_daily", "A-1 W-16", """
WITH m AS (SELECT *, (close - open) / nullif(open, 0) AS minute_return, (high - low) / nullif(close, 0) AS spread, (high + low + close) / 3 AS typical_price, volume / nullif(transactions, 0) AS avg_trade_size, volume * ((high + low + close) / 3) / nullif(volume, 0) AS vwap_approx FROM bars_minute)
SELECT symbol, CAST(timestamp AS DATE) AS date, min_by(open, timestamp) AS open, max(high) AS high, min(low) AS low, max_by(close, timestamp) AS close, CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(transactions) AS BIGINT) AS transactions,
  avg(minute_return) AS minute_return, avg(spread) AS spread, avg(typical_price) AS typical_price, avg(avg_trade_size) AS avg_trade_size, avg(vwap_approx) AS vwap_approx FROM m GROUP BY symbol, CAST(timestamp AS DATE)""",
    [*OHLC, "minute_return", "spread", "typical_price", "avg_trade_size", "vwap_approx"], ["symbol", "date", "volume", "transactions"])
def _(s, d):
    return B.minutes_to_daily(V.bars_minute(s, d))


TW = "(PARTITION BY symbol ORDER BY timestamp)"
DW = "(PARTITION BY symbol, CAST(timestamp AS DATE) ORDER BY timestamp)"


@query("minute_features", "W-11 W-12 W-13 W-14 W-15 W-17 W-18 W-19", f"""
WITH r AS (SELECT *, {nlr(1, order='timestamp')} AS r1, sum(volume * ((high + low + close) / 3)) OVER {DW} / nullif(sum(volume) OVER {DW}, 0) AS vw FROM bars_minute)
SELECT symbol, timestamp, open, high, low, close, volume, transactions, r1 AS returns_1min, {nlr(5, order='timestamp')} AS returns_5min, vw AS vwap_intraday, (close - vw) / nullif(vw, 0) AS vwap_distance,
  volume / nullif(avg(volume) OVER {frame(21, order='timestamp')}, 0) AS minute_volume_ratio, (high - low) / nullif(close, 0) AS spread, close / nullif(first_value(open) OVER {DW}, 0) AS intraday_momentum,
  stddev_samp(r1) OVER {frame(5, order='timestamp')} AS volatility_5min, close - lag(close) OVER {TW} AS price_velocity, r1 AS alpha_minute FROM r""",
    [*OHLC, "returns_1min", "returns_5min", "vwap_intraday", "vwap_distance", "minute_volume_ratio", "spread", "intraday_momentum", "volatility_5min", "price_velocity", "alpha_minute"], ["symbol", "timestamp", "volume", "transactions"])
def _(s, d):
    return B.minute_features(V.bars_minute(s, d))


@query("minute_simple_features", "W-15 W-16", """SELECT symbol, timestamp, (close - open) / nullif(open, 0) AS minute_return, (high - low) / nullif(close, 0) AS spread, (high + low + close) / 3 AS typical_price,
  volume / nullif(transactions, 0) AS avg_trade_size, volume * ((high + low + close) / 3) / nullif(volume, 0) AS vwap_approx
  FROM bars_minute""",
    ["minute_return", "spread", "typical_price", "avg_trade_size", "vwap_approx"], ["symbol", "timestamp"])
def _(s, d):
    return B.minute_simple_features(V.bars_minute(s, d)).select("symbol", "timestamp", "minute_return", "spread", "typical_price", "avg_trade_size", "vwap_approx")


@query("option_features", "W-20 W-21", f"""SELECT ticker, date, volume, volume / nullif(avg(volume) OVER {frame(21, 'ticker')}, 0) AS volume_ratio, {nlr(1, 'ticker')} AS returns_1d, (close - open) / nullif(open,
  0) AS daily_return, (high - low) / nullif(close, 0) AS spread, (high + low + close) / 3 AS typical_price, volume / nullif(transactions, 0) AS avg_trade_size
  FROM option_daily""",
    ["volume_ratio", "returns_1d", "daily_return", "spread", "typical_price", "avg_trade_size"], ["ticker", "date", "volume"])
def _(s, d):
    return B.option_simple_features(B.option_features(V.option_daily(s, d))).select("ticker", "date", "volume", "volume_ratio", "returns_1d", "daily_return", "spread", "typical_price", "avg_trade_size")


# ---------------------------------------------------------------- signals

SIGNALS = ["roc_20", "rsi_14", "sma_5", "sma_20", "std_20", "ma_signal", "ma_cross", "bb_upper", "bb_lower", "bb_position", "volume_ratio_20", "atr_14", "momentum_5", "risk_adjusted_momentum", "zscore_20", "reversion_10", "cv_20", "volume_trend"]


def signals_sql(view: str) -> str:
    m20, s20 = f"avg(close) OVER {frame(20)}", f"stddev_samp(close) OVER {frame(20)}"
    mom = f"(lag(close, 1) OVER {W} / nullif(lag(close, 5) OVER {W}, 0) - 1)"
    return f"""
WITH p AS (SELECT *, lag(close) OVER {W} AS pc FROM {view}), q AS (SELECT *, close - pc AS dc, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr,
  CASE WHEN pc IS NULL THEN 0 WHEN close > pc THEN volume ELSE -volume END AS sv FROM p)
SELECT symbol, date, close / nullif(lag(close, 20) OVER {W}, 0) - 1 AS roc_20,
  CASE WHEN pc IS NULL THEN NULL WHEN avg(greatest(-coalesce(dc, 0), 0)) OVER {frame(14)} = 0 THEN 100.0 ELSE 100 - 100 / (1 + avg(greatest(coalesce(dc, 0), 0)) OVER {frame(14)} / nullif(avg(greatest(-coalesce(dc, 0), 0)) OVER {frame(14)}, 0)) END AS rsi_14,
  avg(close) OVER {frame(5)} AS sma_5, {m20} AS sma_20, {s20} AS std_20, (close - {m20}) / nullif({m20}, 0) AS ma_signal, avg(close) OVER {frame(5)} - {m20} AS ma_cross,
  {m20} + 2 * {s20} AS bb_upper, {m20} - 2 * {s20} AS bb_lower, (close - {m20}) / nullif(4 * {s20}, 0) AS bb_position, volume / nullif(avg(volume) OVER {frame(20)}, 0) AS volume_ratio_20,
  CAST(sum(sv) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS obv, avg(tr) OVER {frame(14)} AS atr_14, {mom} AS momentum_5, {mom} / nullif({s20}, 0) AS risk_adjusted_momentum,
  (close - {m20}) / nullif({s20}, 0) AS zscore_20, -((close - avg(close) OVER {frame(10)}) / nullif(stddev_samp(close) OVER {frame(10)}, 0)) AS reversion_10, {s20} / nullif({m20}, 0) AS cv_20,
  volume / nullif(avg(volume) OVER {frame(20)}, 0) * (close / nullif({m20}, 0) - 1) AS volume_trend FROM q"""


@query("price_signals", "T-1 T-2 T-3 T-6 T-7 T-8 T-9 T-10 T-11 T-12 T-13 T-14", signals_sql("bars_daily"), SIGNALS, ["symbol", "date", "obv"])
def _(s, d):
    return T.price_signals(V.bars_daily(s, d)).select("symbol", "date", "obv", *SIGNALS)


@query("price_signals_long", "T-1 T-2 T-3 T-7 T-12", signals_sql("bars_long"), SIGNALS, ["symbol", "date", "obv"])
def _(s, d):
    return T.price_signals(V.bars_long(s, d)).select("symbol", "date", "obv", *SIGNALS)


@query("ema_truncated", "T-4", f"SELECT symbol, date, list_reduce(list(CAST(close AS DOUBLE)) OVER {frame(120)}, lambda acc, x: x * (2.0 / 13) + acc * (1 - 2.0 / 13)) AS ema_12 FROM bars_daily", ["ema_12"], ["symbol", "date"])
def _(s, d):
    return V.bars_daily(s, d).select("symbol", "date", T.ema(12).alias("ema_12"))


def _ema(x: str, n: int) -> str:
    return f"list_reduce(list({x}) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING), lambda acc, x: x * (2.0 / {n + 1}) + acc * (1 - 2.0 / {n + 1}))"


@query("ema_macd_exact", "T-4 T-5", f"""
WITH e AS (SELECT symbol, date, close, {_ema('CAST(close AS DOUBLE)', 12)} AS ema_12, {_ema('CAST(close AS DOUBLE)', 26)} AS ema_26 FROM bars_daily),
m AS (SELECT *, ema_12 - ema_26 AS macd FROM e), g AS (SELECT *, {_ema('macd', 9)} AS macd_signal FROM m)
SELECT symbol, date, close, ema_12, ema_26, macd, macd_signal, macd - macd_signal AS macd_histogram FROM g""", ["close", "ema_12", "ema_26", "macd", "macd_signal", "macd_histogram"], ["symbol", "date"])
def _(s, d):
    return T.exact_ema(V.bars_daily(s, d), [12, 26])


@query("registered_feature", "UD-1", f"SELECT symbol, date, close / nullif(avg(close) OVER {frame(3)}, 0) AS nearness, close - lag(close) OVER {W} AS step FROM bars_daily", ["nearness", "step"], ["symbol", "date"])
def _(s, d):
    """Two features of a user's own, registered by name."""
    B.register_feature("nearness", lambda key, order: X.sdiv("close", F.avg("close").over(X.last_n(3, key, order))))
    B.register_feature("step", lambda key, order: F.col("close") - F.lag("close").over(X.series(key, order)))
    return B.with_registered(V.bars_daily(s, d), ["nearness", "step"]).select("symbol", "date", "nearness", "step")


@query("rank_spread", "T-15", f"""
WITH r AS (SELECT symbol, date, close / nullif(lag(close, 5) OVER {W}, 0) AS p, volume / nullif(lag(volume, 5) OVER {W}, 0) AS v FROM bars_daily)
SELECT symbol, date, percent_rank() OVER (PARTITION BY date ORDER BY p) - percent_rank() OVER (PARTITION BY date ORDER BY v) AS rank_spread FROM r WHERE p IS NOT NULL AND v IS NOT NULL""", ["rank_spread"], ["symbol", "date"])
def _(s, d):
    return T.rank_spread(V.bars_daily(s, d))


FEATURES = f"(SELECT *, (close - open) / nullif(open, 0) AS daily_return, high - low AS price_range, close / nullif(lag(close) OVER {W}, 0) - 1 AS simple_return, {nlr(1)} AS alpha FROM bars_daily)"


def _features(s, d):
    w = X.series()
    return V.bars_daily(s, d).select("*", X.sdiv(F.col("close") - F.col("open"), "open").alias("daily_return"), (F.col("high") - F.col("low")).alias("price_range"), X.simple_return("close", 1, w).alias("simple_return"), X.neg_log_return("close", 1, w).alias("alpha"))


@query("combined_signal", "T-16 T-18 T-24", f"""SELECT symbol, date, (daily_return * 1.0 + price_range * 1.0) / 2.0 AS equal_signal, (daily_return * 0.7 + price_range * 0.3) / 1.0 AS weighted_signal,
  daily_return - price_range * 0.001 AS net_return, 2.0 * 5 / 50 AS expected_turnover
  FROM {FEATURES} f""", ["equal_signal", "weighted_signal", "net_return", "expected_turnover"], ["symbol", "date"])
def _(s, d):
    return _features(s, d).select("symbol", "date", T.combined({"daily_return": 1.0, "price_range": 1.0}).alias("equal_signal"), T.combined({"daily_return": 0.7, "price_range": 0.3}).alias("weighted_signal"), T.after_cost("daily_return", "price_range", 0.001).alias("net_return"), T.turnover(5, 50).alias("expected_turnover"))


@query("industry_neutral", "T-17", f"""SELECT symbol, date, (daily_return - avg(daily_return) OVER g) / nullif(stddev_samp(daily_return) OVER g, 0) AS neutral
  FROM (SELECT *, CAST(substr(symbol, 2) AS BIGINT) % 7 AS industry
  FROM {FEATURES} f) WINDOW g AS (PARTITION BY date, industry)""", ["neutral"], ["symbol", "date"])
def _(s, d):
    f = _features(s, d).withColumn("industry", F.substring("symbol", 2, 20).cast("long") % 7)
    return f.select("symbol", "date", T.group_zscore("daily_return", "date", "industry").alias("neutral"))


@query("forward_labels", "T-19", f"SELECT symbol, date, lead(close) OVER {W} / nullif(close, 0) - 1 AS label_next, lead(close, 2) OVER {W} / nullif(lead(close) OVER {W}, 0) - 1 AS label_skip FROM bars_daily", ["label_next", "label_skip"], ["symbol", "date"])
def _(s, d):
    return V.bars_daily(s, d).select("symbol", "date", *(c.alias(n) for n, c in T.forward_labels().items()))


@query("robust_zscore", "T-20", f"""
WITH f AS (SELECT * FROM {FEATURES} f WHERE simple_return IS NOT NULL), m AS (SELECT quantile_cont(daily_return, 0.5) AS m FROM f), a AS (SELECT quantile_cont(abs(daily_return - m), 0.5) AS a FROM f, m)
SELECT symbol, date, CASE WHEN (daily_return - m) / nullif(a * 1.4826, 0) IS NULL THEN 0.0 ELSE greatest(least((daily_return - m) / nullif(a * 1.4826, 0), 3.0), -3.0) END AS daily_return_z FROM f, m, a""", ["daily_return_z"], ["symbol", "date"])
def _(s, d):
    return T.robust_zscore(_features(s, d), "daily_return", "simple_return").select("symbol", "date", "daily_return_z")


@query("top_k_per_date", "T-21 L-2", f"SELECT symbol, date, daily_return, rank FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY daily_return DESC NULLS LAST, symbol) AS rank FROM {FEATURES} f) WHERE rank <= 10", ["daily_return"], ["symbol", "date", "rank"])
def _(s, d):
    return T.top_k(_features(s, d), 10, "daily_return", "date").select("symbol", "date", "daily_return", "rank")


@query("bottom_k_per_date", "T-21", f"SELECT symbol, date, daily_return, rank FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY daily_return ASC NULLS LAST, symbol) AS rank FROM {FEATURES} f) WHERE rank <= 10", ["daily_return"], ["symbol", "date", "rank"])
def _(s, d):
    return T.top_k(_features(s, d), 10, "daily_return", "date", ascending=True).select("symbol", "date", "daily_return", "rank")


@query("score_weights", "T-22", f"""
WITH t AS (SELECT symbol, date, price_range, row_number() OVER (PARTITION BY date ORDER BY price_range DESC, symbol) AS rank FROM {FEATURES} f WHERE price_range > 0)
SELECT symbol, date, rank, price_range / nullif(sum(price_range) OVER (PARTITION BY date), 0) AS weight FROM t WHERE rank <= 50""", ["weight"], ["symbol", "date", "rank"])
def _(s, d):
    return T.score_weights(_features(s, d), 50, "price_range", "date").select("symbol", "date", "rank", "weight")


@query("cumulative_return", "T-23", f"SELECT symbol, date, exp(sum(ln(1 + CASE WHEN daily_return > -1 THEN daily_return END)) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)) - 1 AS cumulative FROM {FEATURES} f", {"cumulative": 4}, ["symbol", "date"])
def _(s, d):
    return _features(s, d).select("symbol", "date", T.cumulative_return("daily_return").alias("cumulative"))


@query("movers", "T-25", f"""
WITH m AS (SELECT symbol, date, close, lag(close) OVER {W} AS prev_close FROM bars_daily), c AS (SELECT *, (close - prev_close) / nullif(prev_close, 0) * 100 AS change_pct FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY change_pct DESC, symbol) AS gain_rank, row_number() OVER (PARTITION BY date ORDER BY change_pct, symbol) AS loss_rank FROM c WHERE change_pct IS NOT NULL)
SELECT symbol, date, close, prev_close, change_pct, gain_rank, loss_rank FROM r WHERE gain_rank <= 5 OR loss_rank <= 5""", ["close", "prev_close", "change_pct"], ["symbol", "date", "gain_rank", "loss_rank"])
def _(s, d):
    return T.movers(V.bars_daily(s, d))


@query("signal_strategy", "T-26", f"""
WITH h AS (SELECT symbol, date, lag(CASE WHEN alpha > 0 THEN 1 ELSE 0 END) OVER {W} * daily_return AS strategy_return FROM {FEATURES} f)
SELECT symbol, date, strategy_return, exp(sum(ln(1 + CASE WHEN strategy_return > -1 THEN strategy_return END)) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)) - 1 AS strategy_cumulative FROM h""", {"strategy_return": 6, "strategy_cumulative": 4}, ["symbol", "date"])
def _(s, d):
    return T.signal_strategy(_features(s, d), "alpha", "daily_return").select("symbol", "date", "strategy_return", "strategy_cumulative")


# ---------------------------------------------------------------- factor panel


def alpha_sql(view: str, windows: tuple[int, ...]) -> tuple[str, list[str]]:
    """SQL of the factor panel, written family by family as the definitions are."""
    span = f"(high - low + {K.TINY!r})"
    shape = {
        "KMID": "(close - open) / nullif(open, 0)", "KLEN": "(high - low) / nullif(open, 0)", "KMID2": f"(close - open) / {span}", "KUP": "(high - greatest(open, close)) / nullif(open, 0)",
        "KUP2": f"(high - greatest(open, close)) / {span}", "KLOW": "(least(open, close) - low) / nullif(open, 0)", "KLOW2": f"(least(open, close) - low) / {span}",
        "KSFT": "(2 * close - high - low) / nullif(open, 0)", "KSFT2": f"(2 * close - high - low) / {span}",
        "OPEN0": "open / nullif(close, 0)", "HIGH0": "high / nullif(close, 0)", "LOW0": "low / nullif(close, 0)", "VWAP0": "((high + low + close) / 3) / nullif(close, 0)",
    }

    def corr(x: str, y: str, w: str) -> str:
        x, y = f"CASE WHEN {y} IS NOT NULL THEN {x} END", f"CASE WHEN {x} IS NOT NULL THEN {y} END"
        return f"(CASE WHEN max({x}) OVER {w} > min({x}) OVER {w} AND max({y}) OVER {w} > min({y}) OVER {w} THEN covar_pop({x}, {y}) OVER {w} / nullif(stddev_pop({x}) OVER {w} * stddev_pop({y}) OVER {w}, 0) END)"

    for n in windows:
        w = frame(n)
        slope = f"(CASE WHEN count(*) OVER {w} > 1 THEN covar_pop(i, close) OVER {w} / nullif(var_pop(i) OVER {w}, 0) END)"
        high_at, low_at = f"arg_max(i, row(high, i)) OVER {w}", f"arg_max(i, row(-low, i)) OVER {w}"
        ratio = lambda a, b: f"(sum({a}) OVER {w} / nullif(sum({b}) OVER {w}, 0))"  # noqa: B023, E731
        up, down = f"avg(CAST(dc > 0 AS DOUBLE)) OVER {w}", f"avg(CAST(dc < 0 AS DOUBLE)) OVER {w}"
        gain, loss, vgain, vloss = ratio("u", "ad"), ratio("n", "ad"), ratio("vu", "adv"), ratio("vn", "adv")
        shape |= {
            f"ROC{n}": f"lag(close, {n}) OVER {W} / nullif(close, 0)", f"MA{n}": f"avg(close) OVER {w} / nullif(close, 0)", f"STD{n}": f"stddev_samp(close) OVER {w} / nullif(close, 0)",
            f"MAX{n}": f"max(close) OVER {w} / nullif(close, 0)", f"MIN{n}": f"min(close) OVER {w} / nullif(close, 0)", f"BETA{n}": f"{slope} / nullif(close, 0)", f"RSQR{n}": f"pow({corr('close', 'i', w)}, 2)",
            f"RESI{n}": f"(close - (avg(close) OVER {w} + {slope} * (i - avg(i) OVER {w}))) / nullif(close, 0)", f"QTLU{n}": f"quantile_cont(close, 0.8) OVER {w} / nullif(close, 0)", f"QTLD{n}": f"quantile_cont(close, 0.2) OVER {w} / nullif(close, 0)",
            f"RANK{n}": f"CAST(len([x for x in list(close) OVER {w} if x <= close]) AS DOUBLE) / count(*) OVER {w}", f"RSV{n}": f"(close - min(low) OVER {w}) / nullif(max(high) OVER {w} - min(low) OVER {w}, 0)",
            f"IMAX{n}": f"(i - {high_at}) / {n}", f"IMIN{n}": f"(i - {low_at}) / {n}", f"IMXD{n}": f"({low_at} - {high_at}) / {n}", f"CORR{n}": corr("close", "lv", w), f"CORD{n}": corr("rc", "rv", w),
            f"CNTP{n}": up, f"CNTN{n}": down, f"CNTD{n}": f"{up} - {down}", f"SUMP{n}": gain, f"SUMN{n}": loss, f"SUMD{n}": f"{gain} - {loss}", f"VMA{n}": f"avg(v) OVER {w} / nullif(v, 0)", f"VSTD{n}": f"stddev_samp(v) OVER {w} / nullif(v, 0)",
            f"WVMA{n}": f"stddev_samp(wv) OVER {w} / nullif(avg(wv) OVER {w}, 0)", f"VSUMP{n}": vgain, f"VSUMN{n}": vloss, f"VSUMD{n}": f"{vgain} - {vloss}",
        }
    return f"""
WITH a AS (SELECT *, CAST(row_number() OVER {W} AS DOUBLE) AS i, CAST(volume AS DOUBLE) AS v, lag(close) OVER {W} AS pc, CAST(lag(volume) OVER {W} AS DOUBLE) AS pv FROM {view}),
b AS (SELECT *, CASE WHEN v + 1 > 0 THEN ln(v + 1) END AS lv, close - pc AS dc, abs(close - pc) AS ad, CASE WHEN pc IS NULL THEN 0 ELSE greatest(close - pc, 0) END AS u, CASE WHEN pc IS NULL THEN 0 ELSE greatest(pc - close, 0) END AS n,
  abs(v - pv) AS adv, CASE WHEN pv IS NULL THEN 0 ELSE greatest(v - pv, 0) END AS vu, CASE WHEN pv IS NULL THEN 0 ELSE greatest(pv - v, 0) END AS vn,
  close / nullif(pc, 0) AS rc, CASE WHEN v / nullif(pv, 0) + 1 > 0 THEN ln(v / nullif(pv, 0) + 1) END AS rv, abs(close / nullif(pc, 0) - 1) * v AS wv FROM a)
SELECT symbol, date, {', '.join(f'{x} AS {k}' for k, x in shape.items())} FROM b""", list(shape)


def panel_digits(columns: list[str]) -> dict[str, int]:
    """Shares of small whole numbers end in a 5 now and then: more digits keep both sides from rounding it differently."""
    digits = {"SUM": 11, "VSUM": 11, "VMA": 11, "CNT": 11, "RANK": 11, "CORR": 5, "CORD": 5, "RSQR": 5, "RESI": 5, "BETA": 10}
    return {c: next((n for start, n in digits.items() if c.startswith(start)), 8) for c in columns}


_sql, _cols = alpha_sql("bars_daily", (5, 10))


@query("alpha158_short", "K-1 K-2 K-3 K-4 K-5 R-1 R-2 R-3 R-4 R-5 R-6 R-7 R-8 R-9 R-10 R-11 R-12 R-13 R-14 R-15 R-16 R-17 R-18 R-20", _sql, panel_digits(_cols), ["symbol", "date"])
def _(s, d):
    return K.alpha158(V.bars_daily(s, d), (5, 10))


_sql, _cols = alpha_sql("bars_long", K.WINDOWS)


@query("alpha158_full", "K-1 K-2 K-3 K-4 K-5 R-1 R-2 R-3 R-4 R-5 R-6 R-7 R-8 R-9 R-10 R-11 R-12 R-13 R-14 R-15 R-16 R-17 R-18", _sql, panel_digits(_cols), ["symbol", "date"])
def _(s, d):
    """The full panel of 158 factors."""
    return K.alpha158(V.bars_long(s, d))


@query("rolling_helpers", "R-19", f"""SELECT symbol, date, sum(close) OVER {frame(10)} AS sum_10, CASE WHEN close > 0 THEN ln(close) END AS log_close, abs(close - open) AS abs_move, CAST(sign(close - open) AS DOUBLE) AS side
  FROM bars_daily""", ["sum_10", "log_close", "abs_move", "side"], ["symbol", "date"])
def _(s, d):
    return V.bars_daily(s, d).select("symbol", "date", K.rolling_sum("close", 10).alias("sum_10"), X.positive_ln("close").alias("log_close"), F.abs(F.col("close") - F.col("open")).alias("abs_move"), F.signum(F.col("close") - F.col("open")).alias("side"))


# ---------------------------------------------------------------- access

RANGE = "date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"


@query("query_range", "Q-1 L-1", f"SELECT symbol, date, close, volume FROM bars_daily WHERE symbol IN ('S1', 'S2', 'S3') AND {RANGE} ORDER BY symbol, date", ["close"], ["symbol", "date", "volume"])
def _(s, d):
    return Q.query_range(V.bars_daily(s, d), "stocks_daily", ["S1", "S2", "S3"], ["close", "volume"], "2024-01-05", "2024-01-20")


@query("query_range_minute", "Q-2", "SELECT symbol, timestamp, close FROM bars_minute WHERE symbol IN ('S1', 'S2') AND CAST(timestamp AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'", ["close"], ["symbol", "timestamp"])
def _(s, d):
    return Q.query_range(V.bars_minute(s, d), "stocks_minute", ["S1", "S2"], ["close"], "2024-01-05", "2024-01-20")


@query("filters", "Q-3 Q-10", "SELECT symbol, date, volume FROM bars_daily WHERE volume > 20 AND transactions <= 5 AND symbol <> 'S1' AND symbol IN ('S1', 'S2', 'S7', 'S9')")
def _(s, d):
    return Q.where(V.bars_daily(s, d), [("volume", ">", 20), ("transactions", "<=", 5), ("symbol", "!=", "S1"), ("symbol", "in", ["S1", "S2", "S7", "S9"])]).select("symbol", "date", "volume")


@query("subset_limit", "Q-4 L-3", "SELECT symbol, date, close FROM bars_daily ORDER BY symbol, date LIMIT 100", ["close"], ["symbol", "date"])
def _(s, d):
    return Q.subset(V.bars_daily(s, d), ["symbol", "date", "close"], 100, ["symbol", "date"])


@query("read_date_range", "Q-5", f"SELECT symbol, date, volume FROM bars_daily WHERE {RANGE} AND symbol IN ('S4', 'S5')")
def _(s, d):
    return Q.read_date_range(V.bars_daily(s, d), "2024-01-05", "2024-01-20", ["S4", "S5"], ["symbol", "date", "volume"])


@query("load_table", "Q-6", "SELECT ticker, filing_date, assets FROM balance_sheets WHERE ticker IN ('C1', 'C2') AND filing_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND assets > 0", ["assets"], ["ticker", "filing_date"])
def _(s, d):
    return Q.load(V.balance_sheets(s, d), ["c1", "c2"], "1996-01-01", "1998-12-31", ["ticker", "filing_date", "assets"], F.col("assets") > 0)


@query("actions_of_types", "Q-8", "SELECT ticker, event_type, event_date, id FROM (SELECT ticker, event_type, event_date, id FROM div_events UNION ALL SELECT ticker, event_type, event_date, id FROM split_events) WHERE event_type IN ('split')")
def _(s, d):
    return Q.of_types(C.all_actions(C.dividends(V.dividends(s, d)), C.splits(V.splits(s, d))), "event_type", ["split"]).select(*["ticker", "event_type", "event_date", "id"])


@query("common_stocks", "Q-11", "SELECT ticker, sector FROM tickers WHERE active AND locale = 'us' AND type = 'CS'")
def _(s, d):
    return C.common_stocks(V.tickers(s, d)).select("ticker", "sector")


@query("screening", "Q-12", "SELECT ticker, type FROM tickers WHERE active AND locale = 'us' AND type IN ('CS', 'ETF', 'ADRC', 'ADRP', 'ADRR')")
def _(s, d):
    return C.screening(V.tickers(s, d)).select("ticker", "type")


@query("delisted", "Q-13", "SELECT ticker, delisted_date FROM (SELECT ticker, CAST(DATE '2024-01-01' + CAST(CAST(substr(ticker, 2) AS BIGINT) % 100 AS INT) AS DATE) AS delisted_date FROM tickers) WHERE delisted_date BETWEEN DATE '2024-01-10' AND DATE '2024-02-10'")
def _(s, d):
    at = F.concat(F.date_add(F.lit("2024-01-01").cast("date"), (F.substring("ticker", 2, 20).cast("long") % 100).cast("int")).cast("string"), F.lit("T05:00:00Z"))
    return C.delisted(V.tickers(s, d).withColumn("delisted_utc", at), "2024-01-10", "2024-02-10").select("ticker", "delisted_date")


RATIOS = ["gross_margin", "operating_margin", "net_margin", "roa", "roe", "roic", "current_ratio", "quick_ratio", "working_capital", "debt_to_equity", "debt_to_assets", "equity_multiplier", "interest_coverage", "asset_turnover", "inventory_turnover", "receivables_turnover", "days_sales_outstanding", "ocf_ratio", "free_cash_flow", "ocf_to_debt"]


def _statements(s, d):
    """Statements with the metrics that the driver tables lack made up from those they have, the same way in SQL."""
    b = V.balance_sheets(s, d).withColumns({"inventory": F.col("current_assets") / 10, "accounts_receivable": F.col("current_assets") / 5, "long_term_debt": F.col("assets") / 4, "short_term_debt": F.when(F.col("fiscal_period") != "Q1", F.col("assets") / 8), "liabilities": F.col("assets") - F.col("equity")})
    i = V.income_statements(s, d).withColumns({"gross_profit": F.col("revenues") - F.col("cost_of_revenue"), "operating_income_loss": F.col("net_income_loss") / 2, "interest_expense": F.col("revenues") / 50}).drop("filing_date")
    c = V.cash_flow(s, d).withColumn("net_cash_flow_from_investing_activities", F.when(F.col("fiscal_period") != "Q2", -F.col("net_cash_flow_from_operating_activities") / 3)).drop("filing_date")
    return b, i, c


STATEMENTS = """(SELECT * FROM (SELECT *, current_assets / 10 AS inventory, current_assets / 5 AS accounts_receivable, assets / 4 AS long_term_debt, CASE WHEN fiscal_period <> 'Q1' THEN assets / 8 END AS short_term_debt, assets - equity AS liabilities FROM balance_sheets) b
JOIN (SELECT * EXCLUDE (filing_date), revenues - cost_of_revenue AS gross_profit, net_income_loss / 2 AS operating_income_loss, revenues / 50 AS interest_expense FROM income_statements) i USING (ticker, fiscal_year, fiscal_period, timeframe)
LEFT JOIN (SELECT * EXCLUDE (filing_date), CASE WHEN fiscal_period <> 'Q2' THEN -net_cash_flow_from_operating_activities / 3 END AS net_cash_flow_from_investing_activities FROM cash_flow) c USING (ticker, fiscal_year, fiscal_period, timeframe)) st"""

RATIO_SQL = {
    "gross_margin": "gross_profit / nullif(revenues, 0) * 100", "operating_margin": "operating_income_loss / nullif(revenues, 0) * 100", "net_margin": "net_income_loss / nullif(revenues, 0) * 100", "roa": "net_income_loss / nullif(assets, 0) * 100",
    "roe": "net_income_loss / nullif(equity, 0) * 100", "roic": "net_income_loss / nullif(equity + coalesce(long_term_debt, 0), 0) * 100", "current_ratio": "current_assets / nullif(current_liabilities, 0)", "quick_ratio": "(current_assets - coalesce(inventory, 0)) / nullif(current_liabilities, 0)",
    "working_capital": "current_assets - current_liabilities", "debt_to_equity": "(long_term_debt + coalesce(short_term_debt, 0)) / nullif(equity, 0)", "debt_to_assets": "(long_term_debt + coalesce(short_term_debt, 0)) / nullif(assets, 0)", "equity_multiplier": "assets / nullif(equity, 0)",
    "interest_coverage": "operating_income_loss / nullif(interest_expense, 0)", "asset_turnover": "revenues / nullif(assets, 0)", "inventory_turnover": "cost_of_revenue / nullif(inventory, 0)", "receivables_turnover": "revenues / nullif(accounts_receivable, 0)",
    "days_sales_outstanding": "365 / nullif(revenues / nullif(accounts_receivable, 0), 0)", "ocf_ratio": "net_cash_flow_from_operating_activities / nullif(current_liabilities, 0)", "free_cash_flow": "net_cash_flow_from_operating_activities + coalesce(net_cash_flow_from_investing_activities, 0)",
    "ocf_to_debt": "net_cash_flow_from_operating_activities / nullif(long_term_debt + coalesce(short_term_debt, 0), 0)",
}
_ratio_sql = f"SELECT ticker, fiscal_year, fiscal_period, {', '.join(f'{x} AS {n}' for n, x in RATIO_SQL.items())} FROM {STATEMENTS}"


def _ratios(s, d):
    return FU.ratios(FU.statements(*_statements(s, d)))


@query("financial_ratios", "F-6 F-7 F-8 F-9 F-10 F-12 J-1 J-2", _ratio_sql, dict.fromkeys(RATIOS, 4), ["ticker", "fiscal_year", "fiscal_period"])
def _(s, d):
    return _ratios(s, d).select("ticker", "fiscal_year", "fiscal_period", *RATIOS)


@query("ratio_screen", "Q-9 Q-14", f"SELECT ticker, fiscal_year, fiscal_period, roe FROM ({_ratio_sql}) r WHERE roe > 40 ORDER BY roe DESC, ticker, fiscal_year, fiscal_period LIMIT 10", ["roe"], ["ticker", "fiscal_year", "fiscal_period"])
def _(s, d):
    r = _ratios(s, d).select("ticker", "fiscal_year", "fiscal_period", "roe")
    return Q.screen(r, [("roe", ">", 40)], [F.desc("roe"), "ticker", "fiscal_year", "fiscal_period"], 10)


@query("multi_ratio_screen", "Q-22", f"SELECT DISTINCT ticker FROM ({_ratio_sql}) r WHERE roe > 20 AND current_ratio > 1.5 AND debt_to_equity < 1")
def _(s, d):
    return Q.screen(_ratios(s, d), [("roe", ">", 20), ("current_ratio", ">", 1.5), ("debt_to_equity", "<", 1)]).select("ticker").distinct()


@query("dividend_screen", "Q-15", "SELECT ticker, event_date, id, div_cash_amount FROM div_events WHERE event_date >= DATE '1997-01-01' AND div_cash_amount > 1 ORDER BY event_date DESC, div_cash_amount DESC, id LIMIT 20", {"div_cash_amount": 8}, ["ticker", "event_date", "id"])
def _(s, d):
    return C.dividend_screen(C.dividends(V.dividends(s, d)), "1997-01-01", 1.0).select("ticker", "event_date", "id", "div_cash_amount")


@query("short_data_filter", "Q-16 Q-17", f"SELECT symbol AS ticker, date, volume FROM bars_daily WHERE symbol IN ('S10', 'S11') AND {RANGE}")
def _(s, d):
    return Q.load(V.bars_daily(s, d).withColumnRenamed("symbol", "ticker"), ["s10", "s11"], "2024-01-05", "2024-01-20", ["ticker", "date", "volume"])


@query("option_chain", "Q-18", "SELECT DISTINCT ticker, underlying, expiration_date, contract_type, strike_price FROM option_parsed WHERE underlying = 'STAN'", ["strike_price"], ["ticker", "underlying", "expiration_date", "contract_type"])
def _(s, d):
    return O.chain(V.option_bars(s, d), "stan")


@query("option_chain_stored", "Q-18", "SELECT DISTINCT ticker, underlying, expiration_date, contract_type, strike_price FROM option_parsed WHERE underlying = 'STAN'", ["strike_price"], ["ticker", "underlying", "expiration_date", "contract_type"])
def _(s, d):
    """From a table clustered by underlying, of which only the chain's row groups are read."""
    path = folder(s, "options")
    layouts.write_clustered(O.with_parsed(V.option_bars(s, d).select("ticker", "date", "close", "volume")), path, ["underlying", "ticker", "date"], {"ticker": 20_000})
    return O.stored_chain(s.read.parquet(path), "stan")


@query("table_info", "Q-19", "SELECT count(*) AS rows, count(DISTINCT o_custkey) AS tickers, CAST(year(o_orderdate) AS INT) AS first_year, CAST(year(o_orderdate) AS INT) AS last_year FROM orders GROUP BY year(o_orderdate)")
def _(s, d):
    """Orders written as a file for each year; rows, tickers and years of each file."""
    path = folder(s, "orders")
    t = V.table(s, d, "orders").select(F.col("o_custkey").cast("string").alias("ticker"), F.year("o_orderdate").alias("year"))
    t.withColumn("part", F.col("year")).repartition("part").write.partitionBy("part").parquet(path)
    return Q.table_info(s.read.parquet(path)).drop("file")


@query("partition_listing", "Q-20", "SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, count(*) AS rows, count(DISTINCT symbol) AS symbols, min(date) AS first_date, max(date) AS last_date FROM bars_long GROUP BY ALL")
def _(s, d):
    return Q.partitions(V.bars_long(s, d))


@query("above_quantile", "Q-21", "SELECT symbol, date, volume FROM bars_daily WHERE volume > (SELECT quantile_cont(volume, 0.9) FROM bars_daily)")
def _(s, d):
    return Q.above_quantile(V.bars_daily(s, d), "volume", 0.9).select("symbol", "date", "volume")


@query("active_tickers", "Q-23", "SELECT ticker, type FROM tickers WHERE active AND type IN ('CS', 'ETF') ORDER BY ticker LIMIT 50")
def _(s, d):
    return C.active_tickers(V.tickers(s, d), ["CS", "ETF"], 50).select("ticker", "type")


@query("treasury_curve", "SRC-12", "SELECT symbol AS ticker, date, close FROM bars_daily WHERE symbol IN ('S1', 'S2', 'S3', 'S4') AND date = DATE '2024-01-10'", ["close"], ["ticker", "date"])
def _(s, d):
    return Q.treasury_curve(V.bars_daily(s, d).withColumnRenamed("symbol", "ticker"), ["S1", "S2", "S3", "S4"], "2024-01-10").select("ticker", "date", "close")
