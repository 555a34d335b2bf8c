"""Reports from stored day sketches: counts, ranges and mergeable distinct counts.

Each day's rows leave one row: how many there were, sums, and a HyperLogLog sketch of their keys. Reports merge these rows, so
after a new day only that day is read. Distinct counts then have a known error; ``summaries`` has the exact forms.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A sketch has two to this power registers (4 kB).
PRECISION = 12
#: Two standard errors of a sketch's count, as a share of it.
ERROR = 2 * 1.04 / 2 ** (PRECISION / 2)


def day_sketches(df: DataFrame, key: str, date: str, sums: tuple[str, ...] = ()) -> DataFrame:
    """One row a day: day, rows, sketch of the keys, sums and counts of some columns. Null days are left out, null keys don't count."""
    totals = [x for c in sums for x in (F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"count_{c}"))]
    days = df.filter(F.col(date).isNotNull()).groupBy(F.to_date(date).alias("day"))
    return days.agg(F.count("*").alias("rows"), F.hll_sketch_agg(F.col(key).cast("string"), PRECISION).alias("keys"), *totals)


def stored_days(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def missing_days(df: DataFrame, path: str, date: str) -> DataFrame:
    """The rows of days after the last stored one: a comparison with a literal, so partitions and row groups of other days aren't read."""
    old = stored_days(df.sparkSession, path)
    last = old.agg(F.max("day")).first()[0] if old is not None else None
    return df if last is None else df.filter(F.col(date) >= F.date_add(F.lit(last), 1))


def add_days(df: DataFrame, path: str, key: str, date: str, sums: tuple[str, ...] = ()) -> None:
    """Store the sketches of days that are later than those stored. Days once stored are complete; ``redo_days`` replaces some."""
    day_sketches(missing_days(df, path, date), key, date, sums).withColumn("of", F.col("day")).write.mode("append").partitionBy("of").parquet(path)


def redo_days(df: DataFrame, path: str, key: str, date: str, days: list[str], sums: tuple[str, ...] = ()) -> None:
    """Replace the sketches of some days, for rows that came late. A day without rows keeps its old row."""
    some = df.filter(F.to_date(date).isin([F.lit(x).cast("date") for x in days]))
    made = day_sketches(some, key, date, sums).withColumn("of", F.col("day"))
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("of").parquet(path)


def report(sketches: DataFrame, *by: Column, sums: tuple[str, ...] = ()) -> DataFrame:
    """Per group (of days; all if none): rows, keys (estimated), keys_error (two standard errors), first and last date, sums and means."""
    totals = [x for c in sums for x in (F.sum(f"sum_{c}").alias(f"total_{c}"), (F.sum(f"sum_{c}") / F.nullif(F.sum(f"count_{c}"), F.lit(0))).alias(f"avg_{c}"))]
    merged = sketches.groupBy(*by).agg(
        F.sum("rows").cast("long").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("keys"),
        F.min("day").alias("first_date"), F.max("day").alias("last_date"), *totals,
    )
    return merged.withColumn("keys_error", F.coalesce(F.ceil(F.col("keys") * ERROR), F.lit(0)))
