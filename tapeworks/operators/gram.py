"""Correlations between all series by products of blocks.

Series are dealt into blocks of some tens, dates into blocks of some hundreds; a block pair's sums over common dates are
matrix products of values and of masks for what is missing. A value travels once for each block of series, not once for each series.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, SPAN = 64, 512
#: A variance below this share of the mean square is that of a series that doesn't vary.
FLAT = 1e-13

_SUMS = ("days", "n", "x", "y", "xx", "yy", "xy")


def _matrices(names: pa.Scalar, of: pa.Scalar, at: pa.Scalar, values: pa.Scalar, span: int) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """The series of a block, and date-by-series arrays: which rows there are, which have values, and these with zeros for none."""
    of, at = of.values.to_numpy(), at.values.to_numpy()
    value = values.values.to_numpy(zero_copy_only=False)
    names = names.as_py()
    first, column = np.unique(of, return_index=True)[1], np.unique(of, return_inverse=True)[1]
    there, valued, filled = (np.zeros((span, len(first))) for _ in range(3))
    there[at, column] = 1
    known = ~np.isnan(value)
    valued[at[known], column[known]] = 1
    filled[at[known], column[known]] = value[known]
    return [names[i] for i in first], there, valued, filled


def _products(span: int, kind: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums over the common dates of each two series of a block pair, the first series before the second."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                same = batch.column(0)[i].as_py()
                a, here_a, has_a, x = _matrices(*(batch.column(k)[i] for k in range(1, 5)), span)
                b, here_b, has_b, y = _matrices(*(batch.column(k)[i] for k in range(5, 9)), span)
                sums = [here_a.T @ here_b, has_a.T @ has_b, x.T @ has_b, has_a.T @ y, (x * x).T @ has_b, has_a.T @ (y * y), x.T @ y]
                rows, columns = np.nonzero(sums[0])
                if same:
                    rows, columns = rows[rows < columns], columns[rows < columns]  # series are in order
                out = [pa.array([a[r] for r in rows], kind), pa.array([b[c] for c in columns], kind), *(pa.array(s[rows, columns]) for s in sums)]
                yield pa.RecordBatch.from_arrays(out, ["a", "b", *_SUMS])

    return multiply


def series_correlations(rows: DataFrame, value: Column, key: str = "symbol", date: str = "date", block: int = BLOCK, span: int = SPAN) -> DataFrame:
    """a, b, corr, days for each two series (a < b) that have rows of a common date; the result grows with the square of their number.

    ``rows`` have one row for a key and date; null keys and dates are left out. ``days`` counts common dates, ``corr`` those where both have a
    value: NULL where there are fewer than two or a side doesn't vary. A task holds a block pair's rows of ``span`` days.
    """
    rows = rows.select(F.col(key).alias("s"), F.to_date(date).alias("d"), value.cast("double").alias("v")).filter("s IS NOT NULL AND d IS NOT NULL")
    # Means taken off beforehand keep sums of squares exact enough; correlations stay the same.
    rows = rows.withColumn("v", F.col("v") - F.avg("v").over(Window.partitionBy("s")))
    series = rows.select("s").distinct().withColumn("nth", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("s")) - 1)
    many = series.count()
    placed = rows.join(series, "s").withColumn("block", F.floor(F.col("nth") / block)).withColumn("days", F.floor(F.unix_date("d") / span))
    column = lambda c, name: F.collect_list(c).alias(name)
    entry = F.struct("s", "nth", F.pmod(F.unix_date("d"), F.lit(span)).alias("at"), F.coalesce("v", F.lit(float("nan"))).alias("v"))
    blocks = placed.groupBy("block", "days").agg(column(entry, "e")).select("block", "days", *(F.col(f"e.{c}").alias(c) for c in ("s", "nth", "at", "v")))
    blocks_ = max(1, -(-many // block))
    left = blocks.select(F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.lit(blocks_ - 1).cast("long"))).alias("j"), "days", *(F.col(c).alias(f"a_{c}") for c in ("s", "nth", "at", "v")))
    right = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("block"))).alias("i"), F.col("block").alias("j"), "days", *(F.col(c).alias(f"b_{c}") for c in ("s", "nth", "at", "v")))
    pairs = left.join(right, ["i", "j", "days"]).select((F.col("i") == F.col("j")).alias("same"), *(f"{side}_{c}" for side in "ab" for c in ("s", "nth", "at", "v")))
    of = rows.schema["s"].dataType.simpleString()
    kind = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[of]
    sums = pairs.mapInArrow(_products(span, kind), f"a {of}, b {of}, " + ", ".join(f"{c} double" for c in _SUMS)).groupBy("a", "b").agg(*(F.sum(c).alias(c) for c in _SUMS))
    n = F.nullif(F.col("n"), F.lit(0.0))
    var = {c: F.col(c * 2) / n - F.pow(F.col(c) / n, 2) for c in "xy"}
    varies = [(F.col("n") > 1) & (var[c] > FLAT * F.col(c * 2) / n) for c in "xy"]
    corr = F.when(varies[0] & varies[1], (F.col("xy") / n - F.col("x") / n * F.col("y") / n) / F.nullif(F.sqrt(var["x"]) * F.sqrt(var["y"]), F.lit(0.0)))
    return sums.select("a", "b", corr.alias("corr"), F.col("days").cast("long").alias("days"))
