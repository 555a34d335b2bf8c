"""Calendars, incremental runs, data quality and aligned panels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.functions.exprs import count_true, fresh, sdiv
from tapeworks.operators.joins import layer_difference, missing, on_calendar


def dates(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every date from start to end."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))


def trading_days(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Weekdays that aren't holidays."""
    week = days.filter(F.weekday("date") < 5)
    return week if holidays is None else week.join(holidays, "date", "left_anti")


def unprocessed(expected: DataFrame, log: DataFrame, data_type: str) -> DataFrame:
    """Expected dates without a successful log entry of the type."""
    return missing(expected, log.filter((F.col("data_type") == data_type) & (F.col("status") == "success")))


def enrich_range(bars: DataFrame, features, start: str, end: str, lookback: int = 60, key: str = "symbol") -> DataFrame:
    """Features over history, trimmed to the range: the same values as a run over everything if no frame reaches further back than ``lookback`` rows of a key, however far apart these are."""
    inside = F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    nth = fresh("nth", bars.columns)
    before = bars.filter(F.col("date") < F.lit(start).cast("date")).withColumn(nth, F.row_number().over(Window.partitionBy(key).orderBy(F.desc("date"))))
    return features(bars.filter(inside).unionByName(before.filter(F.col(nth) <= lookback).drop(nth))).filter(inside)


def backfill(bars: DataFrame, features, expected: DataFrame, done: DataFrame, lookback: int = 60) -> DataFrame:
    """Features of the expected dates that aren't done yet."""
    gaps = missing(expected, done)
    span = gaps.agg(F.min("date").alias("a"), F.max("date").alias("b")).first()
    if span["a"] is None:
        return features(bars.limit(0))
    return enrich_range(bars, features, str(span["a"]), str(span["b"]), lookback).join(gaps, "date", "left_semi")


def log_entries(log: DataFrame, data_type: str | None = None, start: str | None = None, end: str | None = None, status: str | None = None, layer: str | None = None) -> DataFrame:
    tests: list[Column] = [F.col(c) == v for c, v in (("data_type", data_type), ("status", status), ("layer", layer)) if v is not None]
    tests += [F.col("date") >= F.lit(start).cast("date")] if start else []
    tests += [F.col("date") <= F.lit(end).cast("date")] if end else []
    return reduce(lambda d, t: d.filter(t), tests, log).orderBy("date", *(c for c in ("symbol", "seq") if c in log.columns))


def freshness(bars: DataFrame, as_of: str, stale_hours: int = 48) -> DataFrame:
    """Per symbol: hours from the last date to ``as_of``, and whether that is too long."""
    last = bars.groupBy("symbol").agg(F.max("date").alias("last_date"))
    hours = ((F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.col("last_date").cast("timestamp"))) / 3600).cast("double")
    return last.withColumn("hours", hours).withColumn("stale", F.col("hours") >= stale_hours)


def unconverted(symbols: DataFrame, log: DataFrame, data_type: str) -> DataFrame:
    return symbols.select("symbol").distinct().join(log.filter(F.col("data_type") == data_type), "symbol", "left_anti")


def cleared(log: DataFrame, data_type: str) -> DataFrame:
    """The log without a type's entries."""
    return log.filter((F.col("data_type") != data_type) | F.col("data_type").isNull())


def date_gaps(df: DataFrame, *keys: str) -> DataFrame:
    """Consecutive distinct dates more than a day apart: the missing span's first and last day."""
    w = Window.partitionBy(*keys).orderBy("date")
    nxt = df.select(*keys, "date").distinct().withColumn("next_", F.lead("date").over(w))
    return nxt.filter(F.datediff("next_", "date") > 1).select(*keys, F.date_add("date", 1).alias("gap_start"), F.date_sub("next_", 1).alias("gap_end"))


def trading_gaps(gaps: DataFrame) -> DataFrame:
    """Gaps that hold a weekday: three days or more always do."""
    a = F.weekday("gap_start")
    days = F.datediff("gap_end", "gap_start")
    return gaps.filter((days >= 2) | (a < 5) | ((a == 6) & (days >= 1)))


def date_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """Runs of consecutive dates: first, last, days."""
    w = Window.partitionBy(*keys).orderBy("date")
    island = F.date_sub("date", F.row_number().over(w))
    d = df.select(*keys, "date").distinct().withColumn("island_", island)
    return d.groupBy(*keys, "island_").agg(F.min("date").alias("range_start"), F.max("date").alias("range_end"), F.count("*").alias("days")).drop("island_")


def integrity(df: DataFrame, other: DataFrame, kind: str) -> DataFrame:
    """One row for a type: rows, range, gaps that hold trading days, dates in either layer only."""
    base = df.agg(F.count("*").alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    gaps = trading_gaps(date_gaps(df.withColumn("k_", F.lit(0)), "k_")).agg(F.count("*").alias("gaps"))
    sides = layer_difference(df, other).agg(count_true(F.col("only_in") == "a").alias("missing_after"), count_true(F.col("only_in") == "b").alias("missing_before"))
    return base.join(F.broadcast(gaps)).join(F.broadcast(sides)).select(F.lit(kind).alias("data_type"), "*")


def validate(df: DataFrame, universe: int, as_of: str, key: str = "ticker", date: str = "date") -> DataFrame:
    """One row: rows, keys, coverage of the universe in percent, age in days, rows a key, and which of them warn."""
    out = df.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys"), F.max(date).alias("last_date"))
    out = out.select("rows", "keys", (F.col("keys") * 100.0 / universe).alias("coverage_pct"), F.datediff(F.lit(as_of).cast("date"), "last_date").cast("long").alias("age_days"), sdiv("rows", "keys").alias("rows_per_key"))
    return out.select("*", (F.col("coverage_pct") < 95).alias("warn_coverage"), (F.col("age_days") > 90).alias("warn_age"), (F.col("rows_per_key") < 40).alias("warn_rows"))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*(count_true(F.col(c).isNull()).alias(f"null_{c}") for c in columns))


def duplicate_groups(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def price_anomalies(bars: DataFrame, limit: float = 0.5) -> DataFrame:
    move = sdiv("close", "open") - 1
    return bars.withColumn("move", move).filter(F.abs("move") > limit)


def epoch_unit(c: str) -> Column:
    """The unit that an epoch number's magnitude says: s, ms, us, ns; NULL if it fits none from 2001 to 2100."""
    x = F.abs(F.col(c))
    return F.when(x.between(10**9, 4 * 10**9), "s").when(x.between(10**12, 4 * 10**12), "ms").when(x.between(10**15, 4 * 10**15), "us").when(x.between(10**18, 4 * 10**18), "ns")


def epoch_check(df: DataFrame, c: str, unit: str = "ns") -> DataFrame:
    return df.agg(F.count(c).alias("n"), count_true(F.col(c).isNotNull() & ~epoch_unit(c).eqNullSafe(F.lit(unit))).alias("wrong_unit"))


def completeness(bars: DataFrame) -> DataFrame:
    return bars.agg(F.count_distinct("symbol").alias("symbols"), F.count_distinct("date").alias("dates"), F.count("*").alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def schema_differences(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, column, type, expected: where a path's column has another type than in the first path, or only one of the two has it (NULL on the other side). Reads footers only."""
    found = {p: {f.name: f.dataType.simpleString() for f in spark.read.parquet(p).schema.fields} for p in paths}
    first = found[paths[0]]
    rows = [(p, c, s.get(c), first.get(c)) for p, s in found.items() for c in sorted(s.keys() | first.keys()) if s.get(c) != first.get(c)]
    return spark.createDataFrame(rows, "path string, column string, type string, expected string")


def panel_check(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Symbols whose series hasn't the calendar's length."""
    n = calendar.select("date").distinct().agg(F.count("*").alias("expected"))
    return panel.groupBy("symbol").agg(F.count("*").alias("rows")).join(F.broadcast(n)).filter("rows <> expected")


def panel_difference(panel: DataFrame, source: DataFrame, column: str, tolerance: float = 1e-6) -> DataFrame:
    """Panel against source: rows compared, largest difference, differences over the tolerance, values on one side only."""
    both = panel.select("symbol", "date", F.col(column).alias("p_")).join(source.select("symbol", "date", F.col(column).alias("s_")), ["symbol", "date"])
    gap = F.abs(F.col("p_") - F.col("s_"))
    return both.agg(F.count("*").alias("rows"), F.max(gap).alias("max_diff"), count_true(gap > tolerance).alias("differences"), count_true(F.col("p_").isNull() != F.col("s_").isNull()).alias("one_sided"))


def instrument_check(instruments: DataFrame) -> DataFrame:
    """Rows, empty names, dates not written yyyy-mm-dd, ends before starts."""
    fine = lambda c: F.col(c).cast("string").rlike(r"^\d{4}-\d{2}-\d{2}$")
    return instruments.agg(F.count("*").alias("rows"), count_true(F.trim("symbol") == "").alias("empty_symbols"), count_true(~fine("start_date") | ~fine("end_date")).alias("bad_dates"), count_true(F.col("end_date") < F.col("start_date")).alias("reversed"))


def instruments(bars: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Symbols with their observed first and last date, merged with earlier ones."""
    seen = bars.filter("symbol IS NOT NULL").select("symbol", F.col("date").alias("start_date"), F.col("date").alias("end_date"))
    both = seen if existing is None else seen.unionByName(existing.select("symbol", "start_date", "end_date"))
    return both.groupBy("symbol").agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))


def calendar_of(bars: DataFrame, start: str, end: str, existing: DataFrame | None = None) -> DataFrame:
    days = bars.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select("date")
    return (days if existing is None else days.union(existing.select("date"))).distinct().orderBy("date")


def feature_columns(df: DataFrame, also: tuple[str, ...] = ("timestamp",)) -> list[str]:
    """Columns that aren't keys or partitions."""
    return [c for c in df.columns if c not in ("symbol", "date", "year", "month", "ticker", *also)]


def aligned_panel(bars: DataFrame, calendar: DataFrame, features: list[str], narrow: bool = True) -> DataFrame:
    """Every symbol on every calendar day with the features, as 32-bit floats if ``narrow``."""
    wide = on_calendar(bars, calendar, features)
    return wide.select("symbol", "date", *(F.col(f).cast("float" if narrow else "double").alias(f) for f in features))


def long_panel(df: DataFrame, features: list[str]) -> DataFrame:
    """symbol, date, feature, value."""
    return df.select("symbol", "date", *(F.col(f).cast("double").alias(f) for f in features)).unpivot(["symbol", "date"], features, "feature", "value")
