"""A table that takes upserts by key and writes only the buckets that a batch touches.

Rows are dealt to a fixed number of buckets by a hash of their keys. A batch writes new versions of the buckets it has keys
of, then one row that says which version of each bucket counts. That row is one file, put in place by one rename: readers
see all of a batch or nothing, and a writer that was broken off leaves files that nobody reads. One writer at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64

_STATE = "n bigint, batch string, buckets map<int, bigint>"


def latest(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The last row of each key by ``order``, null first. Partial maxima are taken before the exchange, so a key may have any number of rows."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order.alias("o"))).alias("row_"))
    return best.select(*(c if c in keys else F.col(f"row_.{c}").alias(c) for c in rows.columns))


def _states(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_STATE).parquet(f"{path}/versions")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _STATE)


def _state(spark: SparkSession, path: str) -> tuple[int, dict[int, int]]:
    """The last version's number, 0 for none, and each bucket's version: as many entries as buckets."""
    row = _states(spark, path).agg(F.max(F.struct("n", F.map_entries("buckets").alias("e"))).alias("s")).first()["s"]
    return (row["n"], {e["key"]: e["value"] for e in row["e"]}) if row else (0, {})


def _paths(path: str, versions: dict[int, int]) -> list[str]:
    return [f"{path}/data/v={v}/bucket_={b}" for b, v in sorted(versions.items())]


def _read(spark: SparkSession, path: str, versions: dict[int, int]) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(*_paths(path, versions))


def upsert(batch: DataFrame, path: str, keys: list[str], order: str, buckets: int = BUCKETS, name: str | None = None) -> list[int]:
    """Put ``batch`` into the table at ``path``: of each key the row with the greatest ``order`` stays, on a tie the batch's.

    Gives the buckets that were written. A batch with a ``name`` that the table has taken before changes nothing, so a repeated
    micro-batch is taken once. Null keys are keys; new columns are added, NULL in old rows. ``buckets`` must stay the same for a table.
    """
    spark = batch.sparkSession
    if name is not None and _states(spark, path).filter(F.col("batch") == name).limit(1).count():
        return []
    n, versions = _state(spark, path)
    new = latest(batch, keys, F.col(order)).withColumn("bucket_", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    touched = sorted(r[0] for r in new.select("bucket_").distinct().collect())  # as many as buckets at most
    old = {b: v for b, v in versions.items() if b in touched}
    if old:
        both = _read(spark, path, old).withColumn("new_", F.lit(0)).unionByName(new.drop("bucket_").withColumn("new_", F.lit(1)), allowMissingColumns=True)
        new = latest(both, keys, F.struct(order, "new_")).drop("new_").withColumn("bucket_", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    if touched:
        new.repartition(len(touched), "bucket_").sortWithinPartitions("bucket_", *keys).write.mode("overwrite").partitionBy("bucket_").parquet(f"{path}/data/v={n + 1}")
    made = {**versions, **dict.fromkeys(touched, n + 1)}
    pairs = F.map_from_arrays(F.lit(list(made)).cast("array<int>"), F.lit(list(made.values())).cast("array<bigint>"))
    state = spark.range(1).select(F.lit(n + 1).cast("long").alias("n"), F.lit(name).cast("string").alias("batch"), pairs.alias("buckets"))
    state.coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return touched


def stored(spark: SparkSession, path: str) -> bool:
    """Whether any batch was put into the table at ``path``."""
    return bool(_state(spark, path)[1])


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The table as its last complete batch left it."""
    _, versions = _state(spark, path)
    if not versions:
        raise ValueError(f"no upserts at {path}")
    return _read(spark, path, versions)


def lookup(spark: SparkSession, path: str, buckets: int, **key: object) -> DataFrame:
    """The row of one key: reads its bucket only."""
    at = spark.range(1).select(F.pmod(F.xxhash64(*(F.lit(v) for v in key.values())), F.lit(buckets)).alias("b")).first()["b"]
    _, versions = _state(spark, path)
    rows = read_upserted(spark, path).limit(0) if at not in versions else _read(spark, path, {at: versions[at]})
    for c, v in key.items():
        rows = rows.filter(F.col(c).eqNullSafe(F.lit(v)))
    return rows
