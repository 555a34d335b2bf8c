"""Features of new days without reading history: the last rows of each key are kept from run to run.

Frames reach back a bounded number of rows. A run reads the new rows and the kept tails, computes features over both, gives those of
the new rows and stores the tails anew, by key in buckets, so that a run over few keys touches few of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.exprs import fresh
from tapeworks.sources.scratch import folder
from tapeworks.sources.upserts import BUCKETS, read_upserted, stored, upsert

#: Rows of a key that are kept.
LOOKBACK = 60


def enrich_new(new: DataFrame, features: Callable[[DataFrame], DataFrame], path: str, key: str = "symbol", order: str = "date", lookback: int = LOOKBACK, buckets: int = BUCKETS, name: str | None = None) -> DataFrame:
    """Features of the rows of ``new`` that are later than all their key's rows so far; the tails at ``path`` then end with these.

    The values are those of a run over everything if no frame reaches further back than ``lookback`` rows of a key. Rows at or
    before the last one kept of their key were done in an earlier run and are left out. The result is written before the tails are: a run
    that breaks off between them gives the same rows when it is repeated; one that is repeated after its tails were stored (its
    ``name`` tells, or the rows themselves, which are not later any more) gives none. Null keys and orders are left out.
    """
    spark = new.sparkSession
    new = new.filter(F.col(key).isNotNull() & F.col(order).isNotNull())
    columns, mark, nth, last = new.columns, fresh("new_", new.columns), fresh("nth_", new.columns), fresh("last_", new.columns)
    if stored(spark, path):
        kept = read_upserted(spark, path).join(new.select(key).distinct(), key, "left_semi")
        ends = kept.select(key, F.col("order_").alias(last))
        later = new.join(ends, key, "left").filter(F.col(last).isNull() | (F.col(order) > F.col(last))).select(*columns)
        past = kept.select(F.explode("tail").alias("r")).select(*(F.col(f"r.{c}").alias(c) for c in columns))
        both = past.withColumn(mark, F.lit(False)).unionByName(later.withColumn(mark, F.lit(True)))
    else:
        both = new.withColumn(mark, F.lit(True))
    where = folder(spark, "enriched")
    features(both).write.parquet(where)
    made = spark.read.parquet(where)
    by = Window.partitionBy(key).orderBy(F.desc(order))
    recent = made.select(*columns).withColumn(nth, F.row_number().over(by)).filter(F.col(nth) <= lookback)
    tail = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at_"), *columns)))
    upsert(recent.groupBy(key).agg(F.max(order).alias("order_"), tail.alias("tail")), path, [key], "order_", buckets, name)
    return made.filter(mark).drop(mark)
