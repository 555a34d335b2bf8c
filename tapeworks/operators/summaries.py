"""Reports, statistics and cross-sections."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.exprs import col, count_true, guarded_corr, sdiv, series, simple_return
from tapeworks.operators.gram import series_correlations


def monthly_market(bars: DataFrame) -> DataFrame:
    """Per month, newest first: symbols, average and total volume."""
    out = bars.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(F.count_distinct("symbol").alias("symbols"), F.avg("volume").alias("avg_volume"), F.sum("volume").cast("long").alias("total_volume"))
    return out.orderBy(F.desc("year"), F.desc("month"))


def table_report(df: DataFrame, key: str | Column, date: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, most first."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), *keys)


def log_summary(log: DataFrame, *keys: str) -> DataFrame:
    """Per key: entries of each status, success rate (skipped counts as success), records and MB."""
    is_ = lambda s: F.col("status") == s
    out = log.groupBy(*keys).agg(
        F.count("*").alias("total"), *(count_true(is_(s)).alias(s) for s in ("success", "failed", "skipped")),
        F.sum("records").cast("long").alias("records"), F.sum("file_size_mb").alias("size_mb"),
    )
    return out.withColumn("success_rate", sdiv(F.col("success") + F.col("skipped"), "total"))


def watermarks(log: DataFrame, *keys: str) -> DataFrame:
    """Last successful date per key."""
    return log.filter("status = 'success'").groupBy(*keys).agg(F.max("date").alias("watermark"))


#: The share of a rank by which an approximate quantile may be off is one in ACCURACY.
ACCURACY = 100_000


def exact_quantiles(df: DataFrame, value: str | Column, shares: list[float], key: str | None = None) -> DataFrame:
    """One row, or one for each ``key`` (few, such as column names): q0, q1.. at ``shares``, interpolated between neighbours; NULL values don't count.

    A first pass gives approximate bounds around each rank (of at most ACCURACY values: all of them); in a second one what lies
    below and above is counted before the shuffle, and only the few values between the bounds are put in order.
    """
    slack = 3 / ACCURACY
    x = df.select((F.col(key) if key else F.lit("")).alias("key"), col(value).cast("double").alias("x")).filter("x IS NOT NULL")
    ends = [min(max(s + d, 0.0), 1.0) for s in shares for d in (-slack, slack)]
    bounds = x.groupBy("key").agg(F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("most"), F.percentile_approx("x", ends, ACCURACY).alias("at"))
    few = F.col("n") <= ACCURACY
    each = F.array(*(F.struct(F.lit(i).alias("i"), (F.lit(s) * (F.col("n") - 1)).alias("rank"), F.when(few, F.col("least")).otherwise(F.col("at")[2 * i]).alias("low"), F.when(few, F.col("most")).otherwise(F.col("at")[2 * i + 1]).alias("high")) for i, s in enumerate(shares)))
    wanted = bounds.select("key", F.explode(each).alias("w")).select("key", "w.*")
    v = F.when(F.col("x") < F.col("low"), F.lit(float("-inf"))).when(F.col("x") > F.col("high"), F.lit(float("inf"))).otherwise(F.col("x"))
    counted = x.join(F.broadcast(wanted), "key").groupBy("key", "i", "rank", v.alias("v")).agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("key", "i").orderBy("v"))
    ranked = counted.withColumn("until", so_far)
    near = lambda r: F.min(F.when(F.col("until") > r, F.col("v")))
    two = ranked.groupBy("key", "i", "rank").agg(near(F.floor("rank")).alias("a"), near(F.ceil("rank")).alias("b"))
    rank = F.col("rank")
    one = two.select("key", "i", F.when(F.floor(rank) == rank, F.col("a")).otherwise(F.col("a") * (F.ceil(rank) - rank) + F.col("b") * (rank - F.floor(rank))).alias("q"))
    out = one.groupBy("key").agg(*(F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q{i}") for i in range(len(shares))))
    return out.withColumnRenamed("key", key) if key else out.drop("key")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per column: count, mean, std, min, quartiles, max (exact)."""
    long = df.unpivot([], columns, "feature", "value")
    rest = long.groupBy("feature").agg(F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    quartiles = exact_quantiles(long, "value", [0.25, 0.5, 0.75], "feature")
    return rest.join(quartiles, "feature", "left").select("feature", "count", "mean", "std", "min", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"), "max")


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlation of each pair of columns, all in one pass: a, b, corr."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.agg(*(guarded_corr(F.col(a), F.col(b)).alias(f"p{i}") for i, (a, b) in enumerate(pairs)))
    rows = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("corr")) for i, (a, b) in enumerate(pairs)))
    return one.select(F.explode(rows).alias("r")).select("r.*")


def candle_counts(bars: DataFrame) -> DataFrame:
    return bars.agg(count_true(F.col("close") > F.col("open")).alias("bullish"), count_true(F.col("close") < F.col("open")).alias("bearish"), count_true(F.col("close") == F.col("open")).alias("flat"))


def coverage(df: DataFrame, columns: list[str], key: str = "symbol") -> DataFrame:
    """Share of values per key and column."""
    return df.groupBy(key).agg(*(F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns))


def outliers(df: DataFrame, column: str, reach: float = 3.0) -> DataFrame:
    """Rows beyond the quartiles by ``reach`` ranges between them."""
    q = exact_quantiles(df, column, [0.25, 0.75]).toDF("q1", "q3")
    c, span = F.col(column), F.col("q3") - F.col("q1")
    beyond = (c < F.col("q1") - reach * span) | (c > F.col("q3") + reach * span)
    return df.join(F.broadcast(q), how="left").agg(F.count(column).alias("n"), count_true(beyond).alias("outliers"))


def distinct_periods(df: DataFrame) -> DataFrame:
    return df.select("fiscal_year", "fiscal_period").distinct()


def benchmark_return(bars: DataFrame) -> DataFrame:
    """Equal-weight mean of simple returns per date."""
    r = bars.select("date", simple_return("close", 1, series()).alias("r"))
    return r.groupBy("date").agg(F.avg("r").alias("benchmark_return"), F.count("r").alias("n"))


def information_coefficient(df: DataFrame, signal: str) -> DataFrame:
    """Per date: correlation of the signal with the next row's return."""
    nxt = df.select("date", signal, (sdiv(F.lead("close").over(series()), "close") - 1).alias("next_"))
    return nxt.groupBy("date").agg(guarded_corr(F.col(signal), F.col("next_")).alias("ic"))


def information_ratio(ic: DataFrame) -> DataFrame:
    return ic.agg(F.avg("ic").alias("mean_ic"), F.stddev_samp("ic").alias("std_ic")).withColumn("ir", sdiv("mean_ic", "std_ic"))


def return_summary(df: DataFrame, r: str, *keys: str, periods: int = 252) -> DataFrame:
    """Mean, deviation and annualized Sharpe ratio."""
    out = df.groupBy(*keys).agg(F.avg(r).alias("mean"), F.stddev_samp(r).alias("std"))
    return out.withColumn("sharpe", sdiv("mean", "std") * periods**0.5)


def column_presence(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows with a value, their share, and whether that is over half."""
    one = df.agg(F.count("*").alias("all_"), *(F.count(c).alias(c) for c in columns))
    out = one.unpivot("all_", columns, "column", "present").select("column", "present", sdiv("present", "all_").alias("share"))
    return out.withColumn("common", F.col("share") > 0.5)


def return_pivot(bars: DataFrame, symbols: list[str]) -> DataFrame:
    """Date by symbol of simple returns, for a short list of symbols."""
    r = bars.filter(F.col("symbol").isin(symbols)).select("symbol", "date", simple_return("close", 1, series()).alias("r"))
    return r.groupBy("date").pivot("symbol", symbols).agg(F.max("r"))


def symbol_correlations(bars: DataFrame, symbols: list[str] | None = None) -> DataFrame:
    """Correlation of returns between all symbols, or some, by products of symbol blocks. The result has a row for each pair of symbols."""
    some = bars if symbols is None else bars.filter(F.col("symbol").isin(symbols))
    return series_correlations(some.withColumn("r", simple_return("close", 1, series())), F.col("r"))


def averages(df: DataFrame, columns: list[str], *keys: str, deviation: str | None = None) -> DataFrame:
    extra = [F.stddev_samp(deviation).alias(f"std_{deviation}")] if deviation else []
    return df.groupBy(*keys).agg(*(F.avg(c).alias(f"avg_{c}") for c in columns), *extra)


