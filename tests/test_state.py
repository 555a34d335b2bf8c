"""Streams with keyed state against batches, over restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tapeworks.streaming import state

SCHEMA = "id string, at timestamp, v bigint"


@pytest.fixture
def rocks(spark):
    with state.rocksdb(spark):
        yield


def rows_of(seed, n, start):
    rng = random.Random(seed)
    return [(rng.choice([None, *"abcdefgh"]) if rng.random() < 0.5 else f"k{rng.randrange(40)}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=start + i), rng.choice([None, *range(99)])) for i in range(n)]


def runs(spark, tmp_path, make, parts, mode):
    """One availableNow run for each part of the input; between runs the query is started anew from its checkpoint."""
    out = str(tmp_path / "out")
    for rows in parts:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = make(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")))
        q = stream.writeStream.outputMode(mode).option("checkpointLocation", str(tmp_path / "c"))
        q.foreachBatch(lambda b, _: b.write.mode("append").parquet(out)).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def test_first_rows_over_restarts(spark, rocks, tmp_path):
    parts = [rows_of(k, 60, 60 * k) for k in range(3)]
    got = runs(spark, tmp_path, lambda s: state.first_rows(s, "id"), parts, "append")
    assert sorted(map(repr, (r["id"] for r in got.collect()))) == sorted(map(repr, {r[0] for p in parts for r in p}))
    known = set()
    for p in parts:
        new = {r[0] for r in p} - known
        assert {r["id"] for r in got.collect() if r["at"] in {x[1] for x in p}} == new
        known |= new


def test_quiet_keys_are_forgotten(spark, rocks, tmp_path):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    parts = [[("a", t(0), 1), ("b", t(1), 1), ("a", t(2), 2)], [("b", t(9), 2)], [("c", t(40), 1)], [("a", t(41), 3), ("c", t(41), 2)]]
    got = runs(spark, tmp_path, lambda s: state.first_rows(s.withWatermark("at", "1 hour"), "id", "at", 10 * 3600_000), parts, "append")
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [("a", 1), ("a", 3), ("b", 1), ("c", 1)]
    with pytest.raises(ValueError):
        state.first_rows(got, "id", forget_ms=5)


def test_latest_rows_over_restarts(spark, rocks, tmp_path):
    parts = [rows_of(k + 9, 60, 60 * k) for k in range(3)]
    got = runs(spark, tmp_path, lambda s: state.latest_rows(s, "id", "at"), parts, "update")
    want = {}
    for r in sorted((r for p in parts for r in p), key=lambda r: r[1]):
        want[r[0]] = r
    assert sorted(map(repr, map(tuple, state.latest_of_updates(got, "id", "at").collect()))) == sorted(map(repr, want.values()))
    assert got.groupBy("id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] <= len(parts)
