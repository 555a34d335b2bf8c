"""Technical signals and portfolio columns over a price series."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.exprs import last_n, sdiv, series, simple_return, so_far
from tapeworks.operators.chunks import days, numbered
from tapeworks.operators.summaries import exact_quantiles

#: Rows, in multiples of the span, after which the truncated moving average ignores the past.
EMA_REACH = 10
#: Rows of a chunk of an exact moving average.
EMA_CHUNK = 256


def roc(n: int = 20, price: str = "close") -> Column:
    return simple_return(price, n, series())


def change(price: str = "close") -> Column:
    return F.col(price) - F.lag(price).over(series())


def rsi(n: int = 14, price: str = "close") -> Column:
    """100 where there is no loss in the window, NULL before the first change."""
    up = F.avg(F.greatest(change(price), F.lit(0.0))).over(last_n(n))
    down = F.avg(F.greatest(-change(price), F.lit(0.0))).over(last_n(n))
    return F.when(F.lag(price).over(series()).isNull(), None).when(down == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + up / F.nullif(down, F.lit(0.0))))


def sma(n: int, price: str = "close") -> Column:
    return F.avg(price).over(last_n(n))


def std(n: int, price: str = "close") -> Column:
    return F.stddev_samp(price).over(last_n(n))


def ema(n: int, price: str = "close", reach: int = EMA_REACH) -> Column:
    """Recursive average with weight 2/(n+1), started at the first of the last ``reach * n`` rows."""
    a = 2.0 / (n + 1)
    window = F.collect_list(price).over(last_n(reach * n))
    rest = F.slice(window, F.lit(2), F.greatest(F.size(window) - 1, F.lit(0)))
    return F.aggregate(rest, window[0].cast("double"), lambda acc, x: x * a + acc * (1 - a))


def exact_ema(
    bars: DataFrame, spans: list[int], price: str = "close", key: str = "symbol", order: str = "date", chunk_rows: int = EMA_CHUNK, bucket: Column | None = None
) -> DataFrame:
    """EMAs from each key's first row on, and MACD (12, 26, 9) when 12 and 26 are among the spans.

    A step of the average is an affine map of the value before it, and such maps compose. Series are cut into chunks of
    ``chunk_rows``: each chunk's map is found within it, the maps of a key's chunks are combined by doubling distances, and the value
    before a chunk is then put into its rows. So a long series takes many tasks; one task holds a chunk, or a key's chunks as one
    row each. A missing price leaves the average as it was; before the first price it is NULL. ``bucket`` is what
    ``chunks.numbered`` asks for (512 days if none).
    """
    if chunk_rows > EMA_CHUNK:
        raise ValueError(f"powers of the weights are in range for chunks of {EMA_CHUNK} rows at most")
    most = bars.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    rounds = max(0, math.ceil(math.log2(max(1, math.ceil(most / chunk_rows)))))
    rows = numbered(bars.select(key, order, price), days(512, order) if bucket is None else bucket, key, order)
    rows = rows.withColumn("chunk_", F.floor((F.col("i_") - 1) / chunk_rows))
    rows = _recursive(rows, {f"ema_{n}": (price, n) for n in spans}, key, rounds)
    names = [f"ema_{n}" for n in spans]
    if {12, 26} <= set(spans):
        rows = _recursive(rows.withColumn("macd", F.col("ema_12") - F.col("ema_26")), {"macd_signal": ("macd", 9)}, key, rounds)
        rows = rows.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
        names += ["macd", "macd_signal", "macd_histogram"]
    return rows.select(key, order, price, *names)


def _recursive(rows: DataFrame, wanted: dict[str, tuple[str, int]], key: str, rounds: int) -> DataFrame:
    """Numbered rows in chunks with recursive averages: name -> (column, span). ``rounds``: the logarithm of the most chunks a key has."""
    so_far_ = Window.partitionBy(key, "chunk_").orderBy("i_").rowsBetween(Window.unboundedPreceding, 0)
    kept, weight = rows.columns, {name: 2.0 / (n + 1) for name, (_, n) in wanted.items()}
    value = {name: F.col(c).cast("double") for name, (c, _) in wanted.items()}
    rows = rows.select("*", *(F.count(c).over(so_far_).alias(f"{name}_k") for name, (c, _) in wanted.items()))
    grown = {name: value[name] * F.pow(F.lit(1 - a), -F.col(f"{name}_k")) if a < 1 else None for name, a in weight.items()}
    rows = rows.select(
        "*", *(F.pow(F.lit(1 - a), F.col(f"{name}_k")).alias(f"{name}_a") for name, a in weight.items()),
        *((F.coalesce(F.sum(grown[name]).over(so_far_), F.lit(0.0)) * a if a < 1 else F.coalesce(F.last(value[name], ignorenulls=True).over(so_far_), F.lit(0.0))).alias(f"{name}_s") for name, a in weight.items()),
    )
    rows = rows.select("*", *((F.col(f"{name}_s") * (F.col(f"{name}_a") if a < 1 else 1)).alias(f"{name}_b") for name, a in weight.items()))
    # A chunk's map is that of its last row; its first value stands in where nothing came before.
    last = [F.max_by(F.struct(*(F.col(f"{name}_{x}").alias(x) for x in "ab")), "i_").alias(name) for name in wanted]
    first = [F.min_by(value[name], F.when(value[name].isNotNull(), F.col("i_"))).alias(f"{name}_first") for name in wanted]
    maps = rows.groupBy(key, "chunk_").agg(*last, *first)
    series_ = Window.partitionBy(key).orderBy("chunk_")
    for d in range(rounds):
        before = {name: F.lag(name, 1 << d).over(series_) for name in wanted}
        maps = maps.select(key, "chunk_", *wanted, *(f"{n}_first" for n in wanted), *(b.alias(f"{n}_before") for n, b in before.items()))
        joined = [
            F.when(F.col(f"{n}_before").isNull(), F.col(n)).otherwise(F.struct(
                (F.col(f"{n}.a") * F.col(f"{n}_before.a")).alias("a"), (F.col(f"{n}.a") * F.col(f"{n}_before.b") + F.col(f"{n}.b")).alias("b"),
            )).alias(n) for n in wanted
        ]
        maps = maps.select(key, "chunk_", *joined, *(f"{n}_first" for n in wanted))
    prior = {n: F.first(f"{n}_first", ignorenulls=True).over(series_.rowsBetween(Window.unboundedPreceding, -1)) for n in wanted}
    maps = maps.select(
        F.col(key).alias("key_"), F.col("chunk_").alias("c_"), *(F.lag(n).over(series_).alias(n) for n in wanted),
        *(x.alias(f"{n}_prior") for n, x in prior.items()), *(f"{n}_first" for n in wanted),
    )
    value_in = {n: F.when(F.col(f"{n}_prior").isNotNull(), F.col(f"{n}.a") * F.col(f"{n}_prior") + F.col(f"{n}.b")).otherwise(F.col(f"{n}_first")) for n in wanted}
    maps = maps.select("key_", "c_", *(f"{n}_prior" for n in wanted), *(x.alias(f"{n}_in") for n, x in value_in.items()))
    found = rows.join(maps, F.col(key).eqNullSafe(F.col("key_")) & (F.col("chunk_") == F.col("c_")))
    made = {n: F.when((F.col(f"{n}_k") > 0) | F.col(f"{n}_prior").isNotNull(), F.col(f"{n}_a") * F.col(f"{n}_in") + F.col(f"{n}_b")).alias(n) for n in wanted}
    return found.select(*kept, *made.values())


def bollinger(n: int = 20, k: float = 2.0) -> dict[str, Column]:
    mid, dev = sma(n), std(n)
    return {"bb_upper": mid + k * dev, "bb_lower": mid - k * dev, "bb_position": sdiv(F.col("close") - mid, 2 * k * dev)}


def obv() -> Column:
    """Running signed volume: plus on a rise, minus otherwise; the first row counts 0."""
    d = F.lag("close").over(series())
    signed = F.when(d.isNull(), 0).when(F.col("close") > d, F.col("volume")).otherwise(-F.col("volume"))
    return F.sum(signed).over(so_far()).cast("long")


def atr(n: int = 14) -> Column:
    before = F.lag("close").over(series())
    true_range = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))
    return F.avg(true_range).over(last_n(n))


def momentum() -> Column:
    w = series()
    return sdiv(F.lag("close", 1).over(w), F.lag("close", 5).over(w)) - 1


def price_signals(bars: DataFrame) -> DataFrame:
    """Rate of change, RSI, averages, bands, volume and momentum signals of a daily series."""
    z20 = sdiv(F.col("close") - sma(20), std(20))
    return bars.select(
        "*", roc().alias("roc_20"), rsi().alias("rsi_14"), sma(5).alias("sma_5"), sma(20).alias("sma_20"), std(20).alias("std_20"),
        sdiv(F.col("close") - sma(20), sma(20)).alias("ma_signal"), (sma(5) - sma(20)).alias("ma_cross"),
        *(c.alias(n) for n, c in bollinger().items()),
        sdiv("volume", F.avg("volume").over(last_n(20))).alias("volume_ratio_20"), obv().alias("obv"), atr().alias("atr_14"),
        momentum().alias("momentum_5"), sdiv(momentum(), std(20)).alias("risk_adjusted_momentum"),
        z20.alias("zscore_20"), (-sdiv(F.col("close") - sma(10), std(10))).alias("reversion_10"), sdiv(std(20), sma(20)).alias("cv_20"),
        (sdiv("volume", F.avg("volume").over(last_n(20))) * (sdiv("close", sma(20)) - 1)).alias("volume_trend"),
    )


def rank_spread(bars: DataFrame, n: int = 5) -> DataFrame:
    """Per date: percent rank of the price's n-row ratio less that of the volume's; rows without a ratio are left out."""
    w = series()
    ratios = bars.select("symbol", "date", sdiv("close", F.lag("close", n).over(w)).alias("price_ratio"), sdiv("volume", F.lag("volume", n).over(w)).alias("volume_ratio"))
    day = Window.partitionBy("date")
    spread = F.percent_rank().over(day.orderBy("price_ratio")) - F.percent_rank().over(day.orderBy("volume_ratio"))
    return ratios.filter("price_ratio IS NOT NULL AND volume_ratio IS NOT NULL").select("symbol", "date", spread.alias("rank_spread"))


def combined(columns: dict[str, float]) -> Column:
    """Weighted average of signals; equal weights make it the mean."""
    return sum((F.col(c) * w for c, w in columns.items()), F.lit(0.0)) / sum(columns.values())


def group_zscore(value: str, *group: str) -> Column:
    """Within its group (e.g. date and industry): the value less the mean over the sample deviation."""
    g = Window.partitionBy(*group)
    return sdiv(F.col(value) - F.avg(value).over(g), F.stddev_samp(value).over(g))


def after_cost(gross: str, turnover: str, cost: float) -> Column:
    return F.col(gross) - F.col(turnover) * cost


def forward_labels() -> dict[str, Column]:
    w = series()
    return {"label_next": sdiv(F.lead("close", 1).over(w), "close") - 1, "label_skip": sdiv(F.lead("close", 2).over(w), F.lead("close", 1).over(w)) - 1}


def robust_zscore(df: DataFrame, value: str, label: str, clip: float = 3.0) -> DataFrame:
    """Value less its median over 1.4826 median deviations, clipped; missing values become 0 and rows without a label go.

    The two medians (exact, see ``summaries.exact_quantiles``) are one row each that joins every row.
    """
    labelled = df.filter(F.col(label).isNotNull())
    middle = exact_quantiles(labelled, value, [0.5]).toDF("median_")
    off = exact_quantiles(labelled.join(F.broadcast(middle), how="left"), F.abs(F.col(value) - F.col("median_")), [0.5]).toDF("mad_")
    z = sdiv(F.col(value) - F.col("median_"), F.col("mad_") * 1.4826)
    z = F.when(z.isNotNull(), F.greatest(F.least(z, F.lit(clip)), F.lit(-clip)))
    return labelled.join(F.broadcast(middle), how="left").join(F.broadcast(off), how="left").withColumn(f"{value}_z", F.coalesce(z, F.lit(0.0))).drop("median_", "mad_")


def top_k(df: DataFrame, k: int, score: str, *group: str, tie: str = "symbol", ascending: bool = False) -> DataFrame:
    """The k best (or worst) rows of each group, ties by ``tie``; adds ``rank``."""
    s = F.col(score).asc_nulls_last() if ascending else F.col(score).desc_nulls_last()
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(s, tie)).cast("long"))
    return ranked.filter(F.col("rank") <= k)


def score_weights(df: DataFrame, k: int, score: str, group: str) -> DataFrame:
    """Weights in proportion to positive scores among each group's top k."""
    best = top_k(df.filter(F.col(score) > 0), k, score, group)
    return best.withColumn("weight", sdiv(score, F.sum(score).over(Window.partitionBy(group))))


def cumulative_return(r: str | Column, key: str = "symbol", order: str = "date") -> Column:
    """Compounded return so far; rows without a return change nothing; NULL from a loss of all or more on."""
    r = F.col(r) if isinstance(r, str) else r
    return F.exp(F.sum(F.log1p(F.when(r > -1, r))).over(so_far(key, order))) - 1


def turnover(n_drop: int, k: int) -> Column:
    """Expected turnover of a top-k portfolio that replaces ``n_drop`` names each period."""
    return F.lit(2.0 * n_drop / k)


def movers(bars: DataFrame, k: int = 5) -> DataFrame:
    """Per date the k largest gains and losses in percent against the close before."""
    w = series()
    moved = bars.select("symbol", "date", "close", F.lag("close").over(w).alias("prev_close")).withColumn("change_pct", sdiv(F.col("close") - F.col("prev_close"), "prev_close") * 100)
    moved = moved.filter("change_pct IS NOT NULL")
    day = Window.partitionBy("date")
    both = moved.select("*", F.row_number().over(day.orderBy(F.desc("change_pct"), "symbol")).cast("long").alias("gain_rank"), F.row_number().over(day.orderBy("change_pct", "symbol")).cast("long").alias("loss_rank"))
    return both.filter((F.col("gain_rank") <= k) | (F.col("loss_rank") <= k))


def signal_strategy(df: DataFrame, alpha: str, ret: str) -> DataFrame:
    """Hold for a row after a positive alpha; the row's and the cumulated return."""
    held = F.lag(F.when(F.col(alpha) > 0, 1).otherwise(0), 1).over(series())
    made = df.withColumn("strategy_return", held * F.col(ret))
    return made.withColumn("strategy_cumulative", cumulative_return("strategy_return"))

