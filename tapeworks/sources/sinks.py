"""Sinks: partitioned tables, upserts, compaction, retention, exports."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tapeworks.sources.layouts import write_clustered

MONTHS = ("year", "month")
#: Files below this many bytes are worth joining, into files of about TARGET_BYTES.
SMALL_BYTES, TARGET_BYTES = 100 << 20, 256 << 20


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_bars(df: DataFrame, path: str) -> None:
    """Append dates that the table doesn't have yet, partitioned by year and month, sorted inside files."""
    old = _existing(df.sparkSession, path)
    if old is not None:
        df = df.join(old.select("date").distinct(), "date", "left_anti").select(*df.columns)
    key = "ticker" if "ticker" in df.columns else "symbol"
    df.repartition(*MONTHS).sortWithinPartitions(*MONTHS, key, "date").write.mode("append").partitionBy(*MONTHS).parquet(path)


def write_enriched(df: DataFrame, path: str, by: tuple[str, ...] = MONTHS) -> None:
    """Replace the partitions that ``df`` has, zstd level 3; others stay."""
    w = df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", 3).option("partitionOverwriteMode", "dynamic")
    w.mode("overwrite").partitionBy(*by).parquet(path)


def write_fundamentals(df: DataFrame, path: str) -> None:
    write_enriched(df, path, ("fiscal_year", "fiscal_period"))


def write_actions(df: DataFrame, path: str, by_ticker: bool = False) -> None:
    """By year and month, or by event type with tickers clustered, which a lookup of one ticker prunes by statistics."""
    if by_ticker:
        write_clustered(df, path, ["ticker", "event_date"], partition_by=("event_type",))
    else:
        df.repartition(*MONTHS).sortWithinPartitions(*MONTHS, "ticker", F.desc("event_date")).write.mode("overwrite").partitionBy(*MONTHS).parquet(path)


def upserted(old: DataFrame, new: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """Union, the last row of each key by ``order``; the new side wins ties."""
    both = old.withColumn("new_", F.lit(0)).unionByName(new.withColumn("new_", F.lit(1)), allowMissingColumns=True)
    by = (F.col(order) if isinstance(order, str) else order).desc_nulls_last()
    w = Window.partitionBy(*keys).orderBy(by, F.desc("new_"))
    return both.withColumn("rn_", F.row_number().over(w)).filter("rn_ = 1").drop("rn_", "new_")


def append(df: DataFrame, path: str) -> None:
    """Append without looking at what is there; readers unite columns by name."""
    df.write.mode("append").parquet(path)


def write_reference(df: DataFrame, path: str) -> None:
    """By locale and type; rows without either are left out."""
    df.filter("locale IS NOT NULL AND type IS NOT NULL").write.mode("overwrite").partitionBy("locale", "type").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def small_partitions(spark: SparkSession, path: str, by: tuple[str, ...] = MONTHS) -> DataFrame:
    """Partitions with more than one file below SMALL_BYTES: their values, files, bytes."""
    files = spark.read.parquet(path).select(*by, F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).distinct()
    return files.groupBy(*by).agg(F.count("*").alias("files"), F.sum("b").alias("bytes"), F.sum((F.col("b") < SMALL_BYTES).cast("int")).alias("small")).filter("small > 1")


def compact(spark: SparkSession, path: str, to: str, by: tuple[str, ...] = MONTHS) -> None:
    """Rewrite partitions of small files to ``to`` in files of about TARGET_BYTES; a table can't replace what it is read from."""
    todo = small_partitions(spark, path, by)
    bytes_ = todo.agg(F.sum("bytes")).first()[0] or 0
    rows = spark.read.parquet(path).join(F.broadcast(todo.select(*by)), list(by), "left_semi")
    rows.repartition(max(1, math.ceil(bytes_ / TARGET_BYTES)), *by).write.mode("overwrite").partitionBy(*by).parquet(to)


def is_expired(as_of: str, keep_days: int) -> Column:
    """Whether a contract expired more than ``keep_days`` ago; false without an expiration."""
    return F.coalesce(F.col("expiration_date") < F.date_sub(F.lit(as_of).cast("date"), keep_days), F.lit(False))


def expired(options: DataFrame, as_of: str, keep_days: int) -> tuple[DataFrame, DataFrame]:
    """Contracts to archive (expired more than ``keep_days`` ago) and those to keep (also without an expiration). Each side runs ``options`` anew; :func:`is_expired` marks both in one pass."""
    old = is_expired(as_of, keep_days)
    return options.filter(old), options.filter(~old)
