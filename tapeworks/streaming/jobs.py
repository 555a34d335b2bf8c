"""Structured Streaming jobs over the natural feeds: files, ticks, news, reference rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeworks.sources.readers import normalize, with_dates
from tapeworks.sources.sinks import MONTHS
from tapeworks.sources.upserts import BUCKETS, upsert


def landing_to_bronze(spark: SparkSession, landing: str, bronze: str, checkpoint: str, data_type: str) -> StreamingQuery:
    """Parse CSV files that are new since the checkpoint into the bronze table, then end."""
    schema = "ticker string, volume double, open double, close double, high double, low double, window_start bigint, transactions bigint"
    raw = spark.readStream.schema(schema).option("header", True).csv(landing)
    bars = with_dates(normalize(raw, data_type))
    return bars.writeStream.format("parquet").option("path", bronze).option("checkpointLocation", checkpoint).partitionBy(*MONTHS).trigger(availableNow=True).start()


def minute_bars(ticks: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Tumbling minute bars of a tick stream; ticks later than ``late`` are left out. First and last by time, ties by event_id."""
    at = F.struct("ts", "event_id")
    bars = ticks.withWatermark("ts", late).groupBy("symbol", F.window("ts", "1 minute").alias("w")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"),
        F.sum("volume").cast("long").alias("volume"), F.count("*").alias("transactions"),
    )
    return bars.select("symbol", F.col("w.start").alias("timestamp"), "open", "high", "low", "close", "volume", "transactions")


def unique_news(news: DataFrame, within: str = "7 days") -> DataFrame:
    """The first article of each id among those whose times are ``within`` of each other."""
    return news.withWatermark("published", within).dropDuplicatesWithinWatermark(["id"])


def upsert_reference(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the latest row of each key in a table for ``upserts.read_upserted``; a micro-batch writes the buckets it touches, once."""

    def merge(batch: DataFrame, epoch: int) -> None:
        upsert(batch, path, keys, order, buckets, name=str(epoch))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def with_dimension(stream: DataFrame, tickers: DataFrame, key: str = "ticker") -> DataFrame:
    """Left join of a stream with a static dimension."""
    return stream.join(tickers, key, "left")
