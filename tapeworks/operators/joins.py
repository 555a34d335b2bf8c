"""Joins over time, calendars and layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.exprs import count_true, sdiv
from tapeworks.operators.chunks import days, with_before


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, columns: list[str], bucket: Callable[[Column], Column] | None = None) -> DataFrame:
    """Each left row with the latest right row of its key at or before its time.

    Both sides are laid in one series per key and the right side's values carried forward: within a ``bucket`` of time (512 days if none;
    it must not fall when time rises), and from bucket to bucket, so a key with very many rows takes many tasks. No range join. Null
    keys and times have no match; of right rows of one key and time any counts.
    """
    found = F.struct(F.col(right_time).alias(right_time), *columns)
    known = right.filter(F.col(key).isNotNull() & F.col(right_time).isNotNull())
    r = known.select(F.col(key).alias("key_of_"), F.col(right_time).alias("t_"), F.lit(0).alias("side_"), found.alias("found_"))
    rows = F.struct(*left.columns)
    lhs = left.select(F.col(key).alias("key_of_"), F.col(left_time).alias("t_"), F.lit(1).alias("side_"), F.lit(None).cast(r.schema["found_"].dataType).alias("found_"), rows.alias("row_"))
    at = days(512, F.col("t_")) if bucket is None else bucket(F.col("t_"))
    latest = F.max_by("found_", F.when(F.col("side_") == 0, F.col("t_")))
    laid = with_before(lhs.unionByName(r, allowMissingColumns=True), {"before_": latest}, {"before_": "last"}, "key_of_", at)
    w = Window.partitionBy("key_of_", "bucket_").orderBy("t_", "side_").rowsBetween(Window.unboundedPreceding, 0)
    laid = laid.withColumn("found_", F.when(F.col("t_").isNotNull(), F.coalesce(F.last("found_", ignorenulls=True).over(w), "before_")))
    return laid.filter("side_ = 1").select("row_.*", *(F.col(f"found_.{c}").alias(c) for c in (right_time, *columns)))


def on_calendar(bars: DataFrame, calendar: DataFrame, columns: list[str]) -> DataFrame:
    """Every symbol on every trading day; days without a bar are NULL. A symbol's days come from one array of the calendar."""
    days = calendar.agg(F.array_sort(F.collect_set("date")).alias("days_"))
    grid = bars.filter("symbol IS NOT NULL").select("symbol").distinct().join(F.broadcast(days)).select("symbol", F.explode("days_").alias("date"))
    return grid.join(bars.select("symbol", "date", *columns), ["symbol", "date"], "left")


def missing(expected: DataFrame, present: DataFrame, on: str | list[str] = "date") -> DataFrame:
    """Expected keys that aren't present."""
    return expected.join(present, on, "left_anti")


def layer_difference(a: DataFrame, b: DataFrame, on: str = "date") -> DataFrame:
    """Keys in one layer only: the key and the side that has it."""
    only = lambda x, y, name: x.select(on).distinct().join(y, on, "left_anti").withColumn("only_in", F.lit(name))
    return only(a, b, "a").unionByName(only(b, a, "b"))


def trading_only(df: DataFrame, calendar: DataFrame) -> DataFrame:
    return df.join(calendar, "date", "left_semi")


def layer_coverage(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows of both layers per symbol, year and month, and silver's share."""
    count = lambda d, n: d.groupBy("symbol", F.year("date").alias("year"), F.month("date").alias("month")).agg(F.count("*").alias(n))
    both = count(bronze, "bronze_rows").join(count(silver, "silver_rows"), ["symbol", "year", "month"], "full")
    both = both.select("symbol", "year", "month", F.coalesce("bronze_rows", F.lit(0)).alias("bronze_rows"), F.coalesce("silver_rows", F.lit(0)).alias("silver_rows"))
    return both.withColumn("coverage", sdiv("silver_rows", "bronze_rows"))


def universe_coverage(tickers: DataFrame, fundamentals: DataFrame, ratios: DataFrame) -> DataFrame:
    """Tickers with everything, without fundamentals, without ratios; one row with the complete share in percent."""
    have = lambda d, n: d.select("ticker").distinct().withColumn(n, F.lit(True))
    each = tickers.select("ticker").distinct().join(have(fundamentals, "f_"), "ticker", "left").join(have(ratios, "r_"), "ticker", "left")
    has_f, has_r = F.col("f_").isNotNull(), F.col("r_").isNotNull()
    out = each.agg(F.count("*").alias("tickers"), count_true(has_f & has_r).alias("complete"), count_true(~has_f).alias("no_fundamentals"), count_true(~has_r).alias("no_ratios"))
    return out.withColumn("complete_pct", sdiv("complete", "tickers") * 100)
