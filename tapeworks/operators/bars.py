"""Bars from ticks, and features of daily and minute bars.

All features of one bar table share a partitioning by key and one sort: lags and
frames are columns over the same window, so a plan has one exchange for all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.exprs import col, last_n, neg_log_return, sdiv, series, simple_return

#: "20-day" averages hold the current row and the 20 before it.
TRAILING = 21


def tick_bars(ticks: DataFrame, *keys: str | Column, price: str = "price", volume: str = "volume", time: str = "ts", tie: str = "event_id") -> DataFrame:
    """Open, high, low, close, volume and transactions per group; first and last by time, ties by ``tie``."""
    at = F.struct(time, tie)
    return ticks.groupBy(*keys).agg(
        F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"),
        F.sum(volume).cast("long").alias("volume"), F.count("*").alias("transactions"),
    )


def daily_bars(ticks: DataFrame) -> DataFrame:
    """One bar per symbol and UTC date."""
    return tick_bars(ticks, "symbol", F.to_date("ts").alias("date"))


def window_bars(ticks: DataFrame, multiplier: int, timespan: str) -> DataFrame:
    """Bars of any span, e.g. ``(ticks, 5, "minutes")``; ``timestamp`` is the bar's start."""
    bars = tick_bars(ticks, "symbol", F.window("ts", f"{multiplier} {timespan}").alias("w"))
    return bars.select("symbol", F.col("w.start").alias("timestamp"), "open", "high", "low", "close", "volume", "transactions")


def minutes_to_daily(minutes: DataFrame) -> DataFrame:
    """Daily bars from minute bars with the averages of the minute features; ordered by timestamp."""
    m = minute_simple_features(minutes)
    extra = [F.avg(c).alias(c) for c in ("minute_return", "spread", "typical_price", "avg_trade_size", "vwap_approx")]
    return m.groupBy("symbol", F.to_date("timestamp").alias("date")).agg(
        F.min_by("open", "timestamp").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "timestamp").alias("close"),
        F.sum("volume").cast("long").alias("volume"), F.sum("transactions").cast("long").alias("transactions"), *extra,
    )


def typical_price() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / 3


def volume_ratio(n: int, key: str, order: str) -> Column:
    return sdiv("volume", F.avg("volume").over(last_n(n, key, order)))


def return_volatility(n: int, key: str, order: str) -> Column:
    """Sample deviation of one-row negated log returns over ``n`` rows."""
    return F.stddev_samp(neg_log_return("close", 1, series(key, order))).over(last_n(n, key, order))


def daily_features(bars: DataFrame, key: str | list[str] = "symbol", order: str = "date") -> DataFrame:
    """The declared daily features: returns and alphas, range, returns, volume ratios, VWAP, volatility, money flow."""
    w = series(key, order)
    vwap = sdiv(F.col("volume") * typical_price(), "volume")
    return bars.select(
        "*",
        *(neg_log_return("close", k, w).alias(f"returns_{k}d") for k in (1, 5, 20)),
        neg_log_return("close", 1, w).alias("alpha_daily"),
        *(neg_log_return("close", k, w).alias(f"alpha_{k}d") for k in (5, 20)),
        (F.col("high") - F.col("low")).alias("price_range"),
        sdiv(F.col("close") - F.col("open"), "open").alias("daily_return"),
        volume_ratio(TRAILING, key, order).alias("volume_ratio"),
        volume_ratio(TRAILING - 1, key, order).alias("relative_volume"),
        vwap.alias("vwap"),
        return_volatility(TRAILING, key, order).alias("volatility_20d"),
        (F.col("volume") * vwap).alias("money_flow"),
        simple_return("close", 1, w).alias("simple_return"),
    )


def minute_features(bars: DataFrame, key: str = "symbol", order: str = "timestamp") -> DataFrame:
    """The declared minute features; the running VWAP restarts each day and rows of one timestamp share it."""
    w = series(key, order)
    day = [F.col(key), F.to_date(order)]
    within_day = Window.partitionBy(*day).orderBy(order)
    running = sdiv(F.sum(F.col("volume") * typical_price()).over(within_day), F.sum("volume").over(within_day))
    return bars.select(
        "*",
        neg_log_return("close", 1, w).alias("returns_1min"),
        neg_log_return("close", 5, w).alias("returns_5min"),
        running.alias("vwap_intraday"),
        sdiv(F.col("close") - running, running).alias("vwap_distance"),
        volume_ratio(TRAILING, key, order).alias("minute_volume_ratio"),
        sdiv(F.col("high") - F.col("low"), "close").alias("spread"),
        sdiv("close", F.first("open").over(within_day)).alias("intraday_momentum"),
        return_volatility(5, key, order).alias("volatility_5min"),
        (F.col("close") - F.lag("close").over(w)).alias("price_velocity"),
        neg_log_return("close", 1, w).alias("alpha_minute"),
    )


def minute_simple_features(bars: DataFrame) -> DataFrame:
    """Row-wise minute features."""
    return bars.select(
        "*",
        sdiv(F.col("close") - F.col("open"), "open").alias("minute_return"),
        sdiv(F.col("high") - F.col("low"), "close").alias("spread"),
        typical_price().alias("typical_price"),
        sdiv("volume", "transactions").alias("avg_trade_size"),
        sdiv(F.col("volume") * typical_price(), "volume").alias("vwap_approx"),
    )


def option_features(bars: DataFrame, kind: str = "daily", key: str = "ticker") -> DataFrame:
    """Declared option features, keyed by contract: ``daily`` or ``minute``."""
    order, ratio, ret = ("date", "volume_ratio", "returns_1d") if kind == "daily" else ("timestamp", "minute_volume_ratio", "returns_1min")
    return bars.select("*", volume_ratio(TRAILING, key, order).alias(ratio), neg_log_return("close", 1, series(key, order)).alias(ret))


def option_simple_features(bars: DataFrame, kind: str = "daily") -> DataFrame:
    """Row-wise option features; the return is named after the bars' kind."""
    return minute_simple_features(bars).drop("vwap_approx").withColumnRenamed("minute_return", f"{'daily' if kind == 'daily' else 'minute'}_return")


_registry: dict = {}


def register_feature(name: str, build) -> None:
    """Add a feature of one's own: ``build(key, order) -> Column``."""
    if not callable(build):
        raise TypeError("a feature is a function of key and order that gives a column")
    _registry[name] = build


def with_registered(bars: DataFrame, names: list[str], key: str = "symbol", order: str = "date") -> DataFrame:
    """Registered features as columns; an unknown name raises KeyError."""
    return bars.select("*", *(col(_registry[n](key, order)).alias(n) for n in names))
