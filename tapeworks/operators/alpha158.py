"""A panel of 158 factors: 9 candle shapes, 4 prices against the close, 29 rolling families over 5 windows.

Every factor is over the same (symbol, date) partitioning: lag-derived columns come first, then each window length's
statistics (:mod:`tapeworks.operators.sliding`), on one exchange and one sort. Windows at a series' start are partial.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.exprs import last_n, positive_ln, sdiv, series
from tapeworks.operators.chunks import days, numbered, overlapped
from tapeworks.operators.sliding import with_statistics

WINDOWS = (5, 10, 20, 30, 60)
#: Keeps shapes defined where high equals low.
TINY = 1e-12


def candle() -> dict[str, Column]:
    """Nine shape factors of one bar."""
    o, h, low, c = (F.col(x) for x in ("open", "high", "low", "close"))
    span = h - low + TINY
    top, bottom = h - F.greatest(o, c), F.least(o, c) - low
    return {
        "KMID": sdiv(c - o, o), "KLEN": sdiv(h - low, o), "KMID2": sdiv(c - o, span),
        "KUP": sdiv(top, o), "KUP2": sdiv(top, span), "KLOW": sdiv(bottom, o), "KLOW2": sdiv(bottom, span),
        "KSFT": sdiv(2 * c - h - low, o), "KSFT2": sdiv(2 * c - h - low, span),
    }


def prices() -> dict[str, Column]:
    vwap = (F.col("high") + F.col("low") + F.col("close")) / 3
    return {f"{n}0": sdiv(x, "close") for n, x in (("OPEN", F.col("open")), ("HIGH", F.col("high")), ("LOW", F.col("low")), ("VWAP", vwap))}


def prepared(bars: DataFrame, key: list[str]) -> DataFrame:
    """Changes and ratios that the rolling families use, all over one window, and pairs for correlations (both or neither null)."""
    w = series(key)
    c, v = F.col("close"), F.col("volume").cast("double")
    d, dv = c - F.lag("close").over(w), v - F.lag(v).over(w)
    found = bars.select(
        "*", v.alias("v_"), positive_ln(v + 1).alias("lv_"), d.alias("d_"), dv.alias("dv_"),
        sdiv(c, F.lag("close").over(w)).alias("rc_"), positive_ln(sdiv(v, F.lag(v).over(w)) + 1).alias("rv_"),
    )
    pairs = {"i_": ("i_", "close"), "lv_": ("close", "lv_"), "rv_": ("rc_", "rv_")}
    return found.select(
        "*", F.abs("d_").alias("ad_"), F.greatest("d_", F.lit(0.0)).alias("up_"), F.greatest(-F.col("d_"), F.lit(0.0)).alias("dn_"),
        F.abs("dv_").alias("adv_"), F.greatest("dv_", F.lit(0.0)).alias("vup_"), F.greatest(-F.col("dv_"), F.lit(0.0)).alias("vdn_"),
        (F.col("d_") > 0).cast("double").alias("rose_"), (F.col("d_") < 0).cast("double").alias("fell_"), (F.abs(F.col("rc_") - 1) * v).alias("wv_"),
        *(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.col(z).cast("double")).alias(f"{side}{k}") for k, (x, y) in pairs.items() for side, z in (("x", x), ("y", y))),
    )


#: What of the prepared columns the families need over each window.
MEANS, SUMS = ["close", "rose_", "fell_", "v_", "wv_"], ["ad_", "up_", "dn_", "adv_", "vup_", "vdn_"]
DEVIATIONS, PAIRS = ["close", "v_", "wv_"], [("xi_", "yi_"), ("xlv_", "ylv_"), ("xrv_", "yrv_")]


def rolling(n: int) -> dict[str, Column]:
    """The 29 families for one window length, from its statistics and ``ref_<n>``, the close ``n`` rows before."""
    at = lambda name: F.col(f"{name}_{n}")
    c, i, v = F.col("close"), F.col("i_"), F.col("v_")
    rows = F.least(i, F.lit(n)).cast("double")  # in the window; their numbers are consecutive
    slope = sdiv(at("covar_xi__yi_"), at("spread_xi__yi_"))
    corr = lambda x, y: sdiv(at(f"covar_{x}_{y}"), at(f"var_{x}_{y}"))
    fit = F.when(at("first") < at("last"), corr("xi_", "yi_"))
    moved, moved_v = at("sum_ad_"), at("sum_adv_")
    gain, gain_v = sdiv(at("sum_up_"), moved), sdiv(at("sum_vup_"), moved_v)
    loss, loss_v = sdiv(at("sum_dn_"), moved), sdiv(at("sum_vdn_"), moved_v)
    found = {
        "ROC": sdiv(at("ref"), c), "MA": sdiv(at("mean_close"), c), "STD": sdiv(at("std_close"), c), "MAX": sdiv(at("last"), c), "MIN": sdiv(at("first"), c),
        "BETA": sdiv(slope, c), "RSQR": fit * fit, "RESI": sdiv(c - (at("mean_close") + slope * (rows - 1) / 2), c),
        "QTLU": sdiv(at("top"), c), "QTLD": sdiv(at("bottom"), c), "RANK": at("share"), "RSV": sdiv(c - at("lowest"), at("highest") - at("lowest")),
        "IMAX": (i - at("high_at")) / n, "IMIN": (i - at("low_at")) / n, "IMXD": (at("low_at") - at("high_at")) / n,
        "CORR": corr("xlv_", "ylv_"), "CORD": corr("xrv_", "yrv_"),
        "CNTP": at("mean_rose_"), "CNTN": at("mean_fell_"), "CNTD": at("mean_rose_") - at("mean_fell_"), "SUMP": gain, "SUMN": loss, "SUMD": gain - loss,
        "VMA": sdiv(at("mean_v_"), v), "VSTD": sdiv(at("std_v_"), v), "WVMA": sdiv(at("std_wv_"), at("mean_wv_")),
        "VSUMP": gain_v, "VSUMN": loss_v, "VSUMD": gain_v - loss_v,
    }
    return {f"{k}{n}": x for k, x in found.items()}


def alpha158(bars: DataFrame, windows: tuple[int, ...] = WINDOWS, families: set[str] | None = None, min_periods: int = 1, chunk_rows: int | None = None, bucket: Column | None = None) -> DataFrame:
    """symbol, date and the factors; ``families`` picks rolling families, and rows with fewer than ``min_periods`` rows so far get NULL.

    A symbol's bars are one partition unless ``chunk_rows`` is given: then series are cut into chunks of so many rows, with an overlap
    as long as the longest window, and a long symbol takes many tasks; ``bucket`` is what ``chunks.numbered`` asks for (512 days if none).
    """
    key = ["symbol"]
    if chunk_rows:
        bars = overlapped(numbered(bars, days(512) if bucket is None else bucket), chunk_rows, max(windows))
        key = ["symbol", "chunk_"]
    else:
        bars = bars.withColumn("i_", F.row_number().over(series()))
    chosen = {k: x for n in windows for k, x in rolling(n).items() if families is None or k[: -len(str(n))] in families}
    enough = (lambda x: F.when(F.col("i_") >= min_periods, x)) if min_periods > 1 else (lambda x: x)
    ready = prepared(bars, key).select("*", *(F.lag("close", n).over(series(key)).alias(f"ref_{n}") for n in windows))
    ready = with_statistics(ready, windows, key, MEANS, SUMS, DEVIATIONS, PAIRS)
    if chunk_rows:
        ready = ready.filter("own_")
    return ready.select("symbol", "date", *(x.alias(k) for k, x in {**candle(), **prices()}.items()), *(enough(x).alias(k) for k, x in chosen.items()))


def rolling_sum(x: str, n: int) -> Column:
    return F.sum(x).over(last_n(n))
