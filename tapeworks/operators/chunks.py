"""Long series in pieces: row numbers without one task for a key, and chunks of rows that overlap.

A key's rows fall into time buckets; how many rows earlier buckets hold is known from their counts, so a row's number is
found within its bucket. Equal chunks of numbered rows, each with the last rows of the one before, let windows
of bounded length run on many tasks for one key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.exprs import fresh


def days(span: int, order: str | Column = "date") -> Column:
    """Buckets of so many days."""
    return F.floor(F.unix_date(F.to_date(order)) / span)


def numbered(rows: DataFrame, bucket: Column, key: str = "symbol", order: str = "date", number: str = "i_") -> DataFrame:
    """``rows`` with their number (from 1) among their key's rows in ``order``.

    ``bucket`` must not fall when ``order`` rises, as ``days`` does; a task holds a bucket of one key. Rows of equal order get any of their
    numbers. Keys or orders that are null are a key and a first bucket like others.
    """
    rows = rows.withColumn("bucket_", bucket)
    counts = rows.groupBy(F.col(key).alias("key_"), F.col("bucket_").alias("b_")).agg(F.count("*").alias("n_"))
    before = Window.partitionBy("key_").orderBy("b_").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("key_", "b_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("ahead_"))
    within = F.row_number().over(Window.partitionBy(key, "bucket_").orderBy(order))
    found = rows.withColumn(number, within).join(counts, F.col(key).eqNullSafe(F.col("key_")) & F.col("bucket_").eqNullSafe(F.col("b_")))
    return found.withColumn(number, F.col(number) + F.col("ahead_")).drop("bucket_", "key_", "b_", "ahead_")


def overlapped(rows: DataFrame, size: int, overlap: int, number: str = "i_", chunk: str = "chunk_", own: str = "own_") -> DataFrame:
    """Numbered rows by chunks of ``size``; the last ``overlap`` of each (at most ``size``) are repeated at the head of the next, with ``own`` false."""
    if overlap > size:
        raise ValueError("a chunk must hold the overlap")
    at = F.col(number) - 1
    first = F.floor(at / size)
    both = F.when(at % size >= size - overlap, F.array(first, first + 1)).otherwise(F.array(first))
    return rows.select("*", F.explode(both).alias(chunk)).withColumn(own, F.col(chunk) == first)


def in_chunks(rows: DataFrame, features: Callable[[DataFrame, list[str]], DataFrame], size: int, overlap: int, bucket: Column, key: str = "symbol", order: str = "date") -> DataFrame:
    """``features(rows, key)`` with chunks of ``size`` rows as keys, so a long series takes many tasks.

    The values are those of whole series if no frame reaches further back than ``overlap`` rows; ``features`` must keep the columns it is
    given. ``bucket``: see ``numbered``.
    """
    number, chunk, own = (fresh(c, rows.columns) for c in ("i_", "chunk_", "own_"))
    parts = overlapped(numbered(rows, bucket, key, order, number), size, overlap, number, chunk, own)
    return features(parts, [key, chunk]).filter(own).drop(number, chunk, own)


def with_before(rows: DataFrame, found: dict[str, Column], combine: dict[str, str], key: str, bucket: Column, forward: bool = True) -> DataFrame:
    """``rows`` with what the earlier buckets of their key (later ones if not ``forward``) add up to: the second level of a carry.

    ``found``: name -> aggregate of a bucket; ``combine``: name -> ``last`` (the nearest bucket's that isn't null) or ``sum``. Adds the
    names and ``bucket_``; a window over (key, bucket_) does the rest. A task holds a bucket's rows, or a key's buckets as one row each.
    """
    rows = rows.withColumn("bucket_", bucket)
    ends = rows.groupBy(F.col(key).alias("key_"), F.col("bucket_").alias("b_")).agg(*(x.alias(n) for n, x in found.items()))
    order = F.col("b_").asc_nulls_first() if forward else F.col("b_").desc_nulls_last()
    before = Window.partitionBy("key_").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carried = {n: F.last(n, ignorenulls=True) if combine[n] == "last" else F.sum(n) for n in found}
    ends = ends.select("key_", "b_", *(x.over(before).alias(n) for n, x in carried.items()))
    return rows.join(ends, F.col(key).eqNullSafe(F.col("key_")) & F.col("bucket_").eqNullSafe(F.col("b_"))).drop("key_", "b_")
