"""What the corpus operators share: tables, cut lineage, joins with hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.sources.scratch import folder

#: A key counts as hot when it holds more than one in HOT_SHARE of the rows; so fewer than HOT_SHARE keys are hot.
HOT_SHARE = 1000

#: Characters that separate words and lines where a contract says ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return folder(spark, "tapeworks")


def cut(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps and retries start from the files."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until no column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone."""
    return F.translate(text, UPPER, LOWER)


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row per group, safe against hot groups.

    ``size`` is the column of ``groups`` with the number of ``rows`` in each.
    Groups over ``total / HOT_SHARE`` rows number fewer than HOT_SHARE, so these are
    broadcast; no key of the shuffled join holds more than that share.
    """
    hot = F.broadcast(groups.filter(F.col(size) > total // HOT_SHARE + 1))
    cold = groups.filter(F.col(size) <= total // HOT_SHARE + 1)
    out = [*rows.columns, *(c for c in groups.columns if c not in on)]
    by_hot = rows.join(hot, on).select(*out)
    by_key = rows.join(hot.select(*on), on, "left_anti").join(cold, on).select(*out)
    return by_hot.unionByName(by_key)


def places(rows: DataFrame, group: list[str], order: list[Column], place: str, size: str) -> DataFrame:
    """``rows`` with their place (from 0) in ``order`` among those of equal ``group`` columns (never null), and how many these are.

    ``rows`` should be a written table: it is read twice. Ranges of the whole order are dealt to tasks, so a large
    group, or one row that repeats very often, takes many tasks; places are counted from how many of a group
    the ranges before hold. Rows equal in ``order`` come in any order.
    """
    spark = rows.sparkSession
    tie, at, part, ahead = (fresh(c, [*rows.columns, place, size]) for c in ("tie_", "at_", "part_", "ahead_"))
    keys = [*map(F.col, group), *order, F.col(tie)]
    dealt = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(shuffle_width(spark), *keys)
    stored = cut(dealt.sortWithinPartitions(*keys).withColumn(at, F.monotonically_increasing_id()).drop(tie))
    stored = stored.withColumn(part, F.shiftright(at, 33))
    runs = stored.groupBy(part, *group).agg(F.count("*").alias(size), F.min(at).alias("first_"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum(size).over(whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(part, *group, (before - F.col("first_")).alias(ahead), F.sum(size).over(whole).alias("whole_"))
    return stored.join(runs, [part, *group]).select(*rows.columns, (F.col(at) + F.col(ahead)).alias(place), F.col("whole_").alias(size))
