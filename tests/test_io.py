"""Sources, sinks and streams on small files."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from tapeworks.operators import bars
from tapeworks.plans import catalog
from tapeworks.sources import readers, schemas, sinks, upserts
from tapeworks.streaming import jobs

HEAD = "ticker,volume,open,close,high,low,window_start,transactions\n"
NS = 1704189600_000000000  # 2024-01-02 10:00 UTC


def csv(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write(HEAD + "".join(f"{x}\n" for x in lines))


def test_bar_files(spark, tmp_path):
    csv(tmp_path / "2024-01-02.csv.gz", [f"A,10,1.0,2.0,3.0,0.5,{NS},4", f"NA,NaN,NULL,,1,1,{NS},x", "B,5,1,1,1,1,NULL,1"])
    raw = readers.read_bars_csv(spark, str(tmp_path))
    got = readers.with_dates(readers.normalize(raw, "stocks_daily")).orderBy(F.col("symbol").asc_nulls_last()).collect()
    assert got[0].asDict() == {"year": 2024, "month": 1, "date": dt.date(2024, 1, 2), "symbol": "A", "volume": 10, "open": 1.0, "close": 2.0, "high": 3.0, "low": 0.5, "transactions": 4, "timestamp": dt.datetime(2024, 1, 2, 10)}
    assert got[1]["symbol"] == "B" and got[1]["date"] == dt.date(2024, 1, 2)  # the file's date
    assert got[2]["symbol"] is None and got[2]["volume"] is None and got[2]["transactions"] is None


def test_schemas(spark):
    assert "alpha_daily" in schemas.schema("stocks_daily").names and "alpha_daily" not in schemas.schema("stocks_daily", raw=True).names
    with pytest.raises(ValueError):
        schemas.schema("bonds")
    got = schemas.conform(spark.createDataFrame([("A", "x", 1)], "symbol string, open string, extra int"), "stocks_daily")
    assert got.schema.names == schemas.schema("stocks_daily", raw=True).names and got.first()["open"] is None


def test_payloads(spark, tmp_path):
    p = tmp_path / "b.json"
    p.write_text(json.dumps({"results": [{"t": 1704189600000, "o": 1, "h": 2, "l": 0.5, "c": 1.5, "v": 10}]}) + "\n")
    assert tuple(readers.read_api_bars(spark, str(p)).first()) == (dt.datetime(2024, 1, 2, 10), 1.0, 2.0, 0.5, 1.5, 10, 0.0, 0)
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"results": [{"ticker": "O:A", "strike_price": 5}, {"ticker": "O:B", "shares_per_contract": 10, "exercise_style": "european", "expiration_date": "2024-02-30"}]}) + "\n")
    got = readers.read_option_contracts(spark, str(p)).orderBy("ticker").collect()
    assert (got[0]["shares_per_contract"], got[0]["exercise_style"]) == (100, "american")
    assert (got[1]["shares_per_contract"], got[1]["exercise_style"], got[1]["expiration_date"]) == (10, "european", None)
    p = tmp_path / "s.json"
    p.write_text(json.dumps({"results": [{"ticker": "A", "day": {"c": 11.0}, "prevDay": {"c": 10.0}}, {"ticker": "B", "day": {"c": 1.0}}]}) + "\n")
    flat = readers.flat_snapshots(readers.read_payload(spark, str(p), "snapshots")).orderBy("ticker").collect()
    assert round(flat[0]["change_pct"], 6) == 10.0 and flat[1]["change_pct"] is None
    for name in readers.PAYLOADS:
        assert readers.read_payload(spark, str(p), name).columns


def test_pages_name_their_symbol(spark, tmp_path, monkeypatch):
    p = tmp_path / "b.json"
    p.write_text(json.dumps({"symbol": "A", "results": [{"t": 1704189600000, "c": 1.5}]}) + "\n" + json.dumps({"results": [{"t": 1704189600000, "c": 2.5}]}) + "\n")
    got = readers.read_api_bars(spark, str(p), page="symbol string").select("symbol", "close").collect()
    assert [tuple(r) for r in got] == [("A", 1.5), (None, 2.5)]
    spark.range(300).selectExpr("id AS event_id", "id AS user_id", "TIMESTAMP_NTZ '2024-01-02 10:00:00' AS ts", "1.5D AS value", "'{\"k\": 1}' AS props", "'view' AS event_type").write.parquet(str(tmp_path / "in/events.parquet"))
    monkeypatch.setattr("tapeworks.plans.queries_io.folder", lambda s, name: str(tmp_path / name))
    assert catalog.QUERIES["api_bars"](spark, str(tmp_path / "in")).select("symbol").distinct().count() == 300
    assert len(list((tmp_path / "payload").rglob("*.json"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))  # not one for each symbol


def bar_rows(spark, days, close=1.0):
    rows = [(2024, 1, s, dt.date(2024, 1, d), close) for d in days for s in ("A", "B")]
    return spark.createDataFrame(rows, "year int, month int, symbol string, date date, close double")


def test_bar_sink_skips_dates_it_has(spark, tmp_path):
    path = str(tmp_path / "bars")
    sinks.write_bars(bar_rows(spark, [2, 3]), path)
    sinks.write_bars(bar_rows(spark, [3, 4], 9.0), path)
    got = {r["date"].day: r["close"] for r in spark.read.parquet(path).collect()}
    assert got == {2: 1.0, 3: 1.0, 4: 9.0}


def test_enriched_sink_replaces_partitions(spark, tmp_path):
    path = str(tmp_path / "e")
    sinks.write_enriched(bar_rows(spark, [2]), path)
    sinks.write_enriched(bar_rows(spark, [2], 7.0).withColumn("month", F.lit(2)), path)
    assert sorted({(r["month"], r["close"]) for r in spark.read.parquet(path).collect()}) == [(1, 1.0), (2, 7.0)]


def test_upsert_keeps_the_last(spark):
    old = spark.createDataFrame([("A", 1, "x"), ("B", 5, "x")], "k string, t int, v string")
    new = spark.createDataFrame([("A", 1, "y"), ("B", 4, "y"), ("C", None, "y")], "k string, t int, v string")
    assert sorted(tuple(r) for r in sinks.upserted(old, new, ["k"], "t").select("k", "v").collect()) == [("A", "y"), ("B", "x"), ("C", "y")]


def test_other_sinks(spark, tmp_path):
    a = spark.createDataFrame([("A", "dividend", dt.date(2024, 1, 2), "1", 2024, 1)], "ticker string, event_type string, event_date date, id string, year int, month int")
    sinks.write_actions(a, str(tmp_path / "a"))
    sinks.write_actions(a, str(tmp_path / "t"), by_ticker=True)
    r = spark.createDataFrame([("A", "us", "CS"), ("B", None, "CS")], "ticker string, locale string, type string")
    sinks.write_reference(r, str(tmp_path / "r"))
    sinks.export_csv(r, str(tmp_path / "csv"))
    sinks.append(a, str(tmp_path / "p"))
    sinks.append(a.withColumn("more", F.lit(1)), str(tmp_path / "p"))
    assert readers.read_table(spark, str(tmp_path / "p")).filter("more IS NULL").count() == 1
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1 and spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    for n in ("a", "t"):
        assert spark.read.parquet(str(tmp_path / n)).count() == 1
    f = spark.createDataFrame([("A", 2020, "Q1")], "ticker string, fiscal_year int, fiscal_period string")
    sinks.write_fundamentals(f, str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f")).count() == 1


def test_compaction(spark, tmp_path):
    path, to = str(tmp_path / "many"), str(tmp_path / "few")
    bar_rows(spark, range(2, 8)).repartition(5).write.partitionBy("year", "month").parquet(path)
    sinks.compact(spark, path, to)
    assert spark.read.parquet(to).count() == 12 and len(spark.read.parquet(to).inputFiles()) == 1


def test_stream_of_files_equals_batch(spark, tmp_path):
    land, bronze, mark = (str(tmp_path / x) for x in ("land", "bronze", "mark"))
    csv(tmp_path / "land" / "2024-01-02.csv.gz", [f"A,10,1.0,2.0,3.0,0.5,{NS},4"])
    jobs.landing_to_bronze(spark, land, bronze, mark, "stocks_daily").awaitTermination()
    csv(tmp_path / "land" / "2024-01-03.csv.gz", [f"A,11,1.0,2.0,3.0,0.5,{NS + 86400 * 10**9},4"])
    jobs.landing_to_bronze(spark, land, bronze, mark, "stocks_daily").awaitTermination()
    jobs.landing_to_bronze(spark, land, bronze, mark, "stocks_daily").awaitTermination()
    assert sorted(r["volume"] for r in spark.read.parquet(bronze).collect()) == [10, 11]


def stream_of(spark, df, path):
    df.coalesce(1).write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def run(stream, name, mode):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return stream.sparkSession.table(name)


def test_streamed_minute_bars_equal_batch(spark, tmp_path):
    t = dt.datetime(2024, 1, 2, 10)
    rows = [(i, "AB"[i % 2], t + dt.timedelta(seconds=17 * i), float(i * 7 % 11), i) for i in range(40)]
    ticks = spark.createDataFrame(rows, "event_id bigint, symbol string, ts timestamp, price double, volume bigint")
    got = run(jobs.minute_bars(stream_of(spark, ticks, str(tmp_path / "t"))), "minute_bars", "complete")
    want = bars.window_bars(ticks, 1, "minutes")
    key = lambda d: sorted(map(tuple, d.collect()))
    assert key(got) == key(want)


def test_streamed_news_are_unique(spark, tmp_path):
    t = dt.datetime(2024, 1, 2)
    news = spark.createDataFrame([("1", t), ("1", t + dt.timedelta(hours=1)), ("2", t)], "id string, published timestamp")
    assert sorted(r["id"] for r in run(jobs.unique_news(stream_of(spark, news, str(tmp_path / "n"))), "news_once", "append").collect()) == ["1", "2"]


def test_streamed_upsert_and_dimension(spark, tmp_path):
    rows = spark.createDataFrame([("A", 1, "old"), ("A", 2, "new"), ("B", 1, "b")], "ticker string, t int, name string")
    s = stream_of(spark, rows, str(tmp_path / "s"))
    jobs.upsert_reference(s, str(tmp_path / "ref"), str(tmp_path / "c"), ["ticker"], "t").awaitTermination()
    assert sorted(r["name"] for r in upserts.read_upserted(spark, str(tmp_path / "ref")).collect()) == ["b", "new"]
    dim = spark.createDataFrame([("A", "Tech")], "ticker string, sector string")
    got = run(jobs.with_dimension(s, dim), "with_dim", "append").collect()
    assert sorted((r["ticker"], r["sector"] or "") for r in got) == [("A", "Tech"), ("A", "Tech"), ("B", "")]


def test_a_file_with_another_type_is_a_difference(spark, tmp_path):
    rows = spark.range(3).select("id", F.col("id").cast("int").alias("value"))
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    assert catalog.QUERIES["schema_consistency"](spark, str(tmp_path)).collect() == [(0,)]
    rows.withColumn("value", F.col("value").cast("string")).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    assert catalog.QUERIES["schema_consistency"](spark, str(tmp_path)).collect() == [(2,)]
