"""Table access: ranges, predicates, subsets, listings."""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.exprs import every
from tapeworks.operators.summaries import exact_quantiles

OPTION_TYPES = ("options_daily", "options_minute")
DATE_COLUMNS = ("filing_date", "date", "timestamp", "start_date")
_OPS = {"=": "__eq__", "==": "__eq__", "!=": "__ne__", ">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__"}


def key_column(data_type: str) -> str:
    return "ticker" if data_type in OPTION_TYPES else "symbol"


def between_dates(column: str, start: str, end: str, kind: str = "date") -> Column:
    """Inclusive dates. Timestamps are compared as a half-open range, so the predicate reaches the scan."""
    c = F.col(column)
    if kind.startswith("timestamp"):
        return (c >= F.lit(start).cast("timestamp")) & (c < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    return c.between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def months_between(start: str, end: str) -> Column:
    """The same range on partition columns year and month."""
    number = lambda d: int(d[:4]) * 100 + int(d[5:7])
    return (F.col("year") * 100 + F.col("month")).between(number(start), number(end))


def query_range(df: DataFrame, data_type: str, symbols: list[str], fields: list[str], start: str, end: str) -> DataFrame:
    """Fields of some symbols over inclusive dates, ordered by key and time. Minute data is filtered by its timestamps' dates."""
    key = key_column(data_type)
    time = "timestamp" if data_type.endswith("minute") else "date"
    kept = df.filter(F.col(key).isin(symbols) & between_dates(time, start, end, dict(df.dtypes)[time]))
    if {"year", "month"} <= set(df.columns):
        kept = kept.filter(months_between(start, end))
    return kept.select(*dict.fromkeys([key, time, *fields])).orderBy(key, time)


def where(df: DataFrame, filters: Iterable[tuple[str, str, object]]) -> DataFrame:
    """Rows that meet all of ``(column, operator, value)``: = != > >= < <= in."""
    conditions = []
    for name, op, value in filters:
        if op == "in":
            conditions.append(F.col(name).isin(list(value)))
        elif op in _OPS:
            conditions.append(getattr(F.col(name), _OPS[op])(value))
        else:
            raise ValueError(f"unknown operator {op!r}")
    return df.filter(every(*conditions)) if conditions else df


def subset(df: DataFrame, columns: list[str] | None = None, n: int | None = None, order: list[str] | None = None) -> DataFrame:
    out = df.select(*columns) if columns else df
    out = out.orderBy(*order) if order else out
    return out if n is None else out.limit(n)


def read_date_range(df: DataFrame, start: str, end: str, symbols: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    out = df.filter(between_dates("date", start, end))
    if symbols:
        out = out.filter(F.col("symbol").isin(symbols))
    return out.select(*columns) if columns else out


def load(df: DataFrame, tickers: list[str] | None = None, start: str | None = None, end: str | None = None, columns: list[str] | None = None, predicate: Column | None = None) -> DataFrame:
    """Tickers (upper-cased), a range of the first date column that the table has, a further predicate, and those of ``columns`` that exist (others warn)."""
    kinds = dict(df.dtypes)
    if tickers:
        df = df.filter(F.col("ticker").isin([t.upper() for t in tickers]))
    time = next((c for c in DATE_COLUMNS if c in kinds), None)
    if time and (start or end):
        c = F.try_to_date(F.col(time)) if kinds[time] == "string" else F.to_date(time) if kinds[time].startswith("timestamp") else F.col(time)
        df = df.filter(every(*([c >= F.lit(start).cast("date")] if start else []), *([c <= F.lit(end).cast("date")] if end else [])))
    if predicate is not None:
        df = df.filter(predicate)
    if columns:
        unknown = [c for c in columns if c not in kinds]
        if unknown:
            warnings.warn(f"columns not in the table: {unknown}", stacklevel=2)
        df = df.select(*(c for c in columns if c in kinds))
    return df


def load_fundamentals(spark: SparkSession, root: str, **how) -> dict[str, DataFrame]:
    """The three statement tables under ``root``, loaded alike."""
    names = ("balance_sheets", "income_statements", "cash_flow")
    return {n: load(spark.read.option("mergeSchema", True).parquet(f"{root}/{n}"), **how) for n in names}


def of_types(df: DataFrame, column: str, kinds: list[str]) -> DataFrame:
    return df.filter(F.col(column).isin(kinds))


def above_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """Rows over the exact quantile of the whole table, which joins as one row."""
    limit = exact_quantiles(df, column, [q]).toDF("limit_")
    return df.join(F.broadcast(limit)).filter(F.col(column) > F.col("limit_")).drop("limit_")


def screen(df: DataFrame, filters: list[tuple[str, str, object]], order: list[Column | str] | None = None, n: int | None = None) -> DataFrame:
    out = where(df, filters)
    out = out.orderBy(*order) if order else out
    return out if n is None else out.limit(n)


def table_info(df: DataFrame) -> DataFrame:
    """Per file: rows, tickers, years."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"), F.count_distinct("ticker").alias("tickers"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def partitions(df: DataFrame) -> DataFrame:
    """Per year and month: rows, symbols, first and last date."""
    return df.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(
        F.count("*").alias("rows"), F.count_distinct("symbol").alias("symbols"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


def treasury_curve(df: DataFrame, maturities: list[str], date: str) -> DataFrame:
    """The maturities' yields of one date."""
    return df.filter(F.col("ticker").isin(maturities) & (F.col("date") == F.lit(date).cast("date")))


def union_all(*frames: DataFrame) -> DataFrame:
    """By name; numeric types are widened."""
    return reduce(lambda a, b: a.unionByName(b), frames)
