"""Tables laid out for their readers: bucketed upserts, clustered lookups, joins by bucket."""

import datetime as dt
import os
import random
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

from tapeworks.operators import bars, incremental, options, sketches
from tapeworks.plans import catalog
from tapeworks.sources import layouts, sinks, upserts

ROWS = "k string, g int, t int, v string"


def data_bytes(path, version):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{path}/data/v={version}") for f in names if f.endswith(".parquet"))


def test_upserts_by_hand(spark, tmp_path):
    rng, path, want = random.Random(1), str(tmp_path / "t"), {}
    for b in range(4):
        rows = [(rng.choice([None, "é", *"abcdefgh"]), rng.randrange(3), rng.choice([None, 1, 2, 3]), f"{b}-{i}") for i in range(30)]
        rows = list({(r[0], r[1], r[2]): r for r in rows}.values())  # no ties within a batch
        upserts.upsert(spark.createDataFrame(rows, ROWS), path, ["k", "g"], "t", buckets=8)
        for k, g, t, v in rows:
            old = want.get((k, g))
            if old is None or (t is not None, t or 0) > (old[0] is not None, old[0] or 0) or (t == old[0] and not old[1].startswith(f"{b}-")):
                want[k, g] = (t, v)
        got = upserts.read_upserted(spark, path)
        assert got.columns == ["k", "g", "t", "v"]
        assert {(r["k"], r["g"]): (r["t"], r["v"]) for r in got.collect()} == want and got.count() == len(want)
    one = upserts.lookup(spark, path, 8, k="é", g=1)
    assert [(r["t"], r["v"]) for r in one.collect()] == [want["é", 1]] and len(one.inputFiles()) == 1
    assert upserts.lookup(spark, path, 8, k="none", g=1).count() == 0


def test_a_small_batch_writes_little(spark, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("t"), F.md5(F.col("id").cast("string")).alias("v"))
    assert upserts.upsert(many, path, ["k"], "t", buckets=32) == list(range(32))
    touched = upserts.upsert(spark.createDataFrame([("7", 1, "new")], "k string, t int, v string"), path, ["k"], "t", buckets=32)
    assert len(touched) == 1 and data_bytes(path, 2) < data_bytes(path, 1) / 20
    got = upserts.read_upserted(spark, path)
    assert got.count() == 20_000 and got.filter("k = '7'").first()["v"] == "new"
    assert sum("/v=2/" in f for f in got.inputFiles()) == 1


def test_a_batch_that_breaks_off_or_comes_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        upserts.read_upserted(spark, path)
    first = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, t int, v string")
    upserts.upsert(first, path, ["k"], "t", buckets=4, name="0")
    # Files of a version that no state names are not read, and the next batch replaces them.
    spark.createDataFrame([("c", 9, "lost", 0)], "k string, t int, v string, bucket_ int").write.partitionBy("bucket_").parquet(f"{path}/data/v=2")
    assert upserts.read_upserted(spark, path).count() == 2
    second = spark.createDataFrame([("a", 2, "z", 5)], "k string, t int, v string, extra int")
    assert upserts.upsert(second, path, ["k"], "t", buckets=4, name="1")
    assert upserts.upsert(second.withColumn("v", F.lit("again")), path, ["k"], "t", buckets=4, name="1") == []
    assert sorted(map(tuple, upserts.read_upserted(spark, path).select("k", "v", "extra").collect())) == [("a", "z", 5), ("b", "y", None)]
    assert upserts.upsert(first.limit(0), path, ["k"], "t", buckets=4) == [] and upserts.read_upserted(spark, path).count() == 2


def test_many_rows_of_one_key_meet_before_the_exchange(spark, tmp_path):
    hot = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    assert [tuple(r) for r in upserts.latest(hot, ["k"], F.col("t")).collect()] == [("hot", 4999)]
    plan = upserts.latest(hot, ["k"], F.col("t"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def scanned(df):
    """Rows that the scan gave out, after row groups and pages were skipped."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        if node.nodeName().startswith("Scan"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
    return total


def groups(path):
    import pyarrow.parquet as pq

    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    return sum(pq.ParquetFile(f).num_row_groups for f in files)


@pytest.fixture
def contracts(spark):
    ticker = F.concat(F.lit("O:"), F.element_at(F.array(*map(F.lit, ("SPY", "STAN", "AAPL", "F", "TSLA"))), (F.col("id") % 5 + 1).cast("int")), F.lit("240315C"), F.lpad(F.xxhash64("id").cast("string").substr(2, 5), 8, "0"))
    return options.with_parsed(spark.range(60_000).select(ticker.alias("ticker"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("date"), F.col("id").alias("volume")))


def test_retention_reads_its_lines_once(spark, tmp_path):
    lines = "id AS l_orderkey, id % 9 AS l_partkey, 1 AS l_linenumber, 'R' AS l_returnflag, TIMESTAMP_NTZ '1997-01-01 00:00:00' + make_dt_interval(INT(id * 20)) AS l_shipdate, 2000D AS l_extendedprice, 3D AS l_quantity"
    spark.sql(f"SELECT {lines} FROM range(40)").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("SELECT id AS p_partkey, 'SMALL' AS p_type, 900D AS p_retailprice FROM range(9)").write.parquet(str(tmp_path / "part.parquet"))
    spark.sql("SELECT id AS o_orderkey, TIMESTAMP_NTZ '1996-05-01 00:00:00' AS o_orderdate FROM range(40)").write.parquet(str(tmp_path / "orders.parquet"))
    got = catalog.QUERIES["option_retention"](spark, str(tmp_path))
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 3  # one a table
    assert [tuple(r) for r in got.groupBy("archived").count().collect()] == [(False, 40)]  # a ticker's years are 20yy
    o = spark.createDataFrame([("a", dt.date(1997, 10, 2)), ("b", dt.date(1997, 10, 3)), ("c", None)], "ticker string, expiration_date date")
    assert [r[0] for r in o.filter(sinks.is_expired("1998-01-01", 90)).collect()] == ["a"]
    old, kept = sinks.expired(o, "1998-01-01", 90)
    assert (old.count(), kept.count()) == (1, 2)


def test_lines_of_one_number_count_in_the_table_s_order(spark, tmp_path):
    line = "0 AS l_partkey, 1 AS l_linenumber, 'R' AS l_returnflag, TIMESTAMP_NTZ '1997-01-01 00:00:00' AS l_shipdate, 3D AS l_quantity"
    lines = f"SELECT /*+ COALESCE(1) */ id % 20 AS l_orderkey, {line}, 1000D * (1 + id * 7 % 40) AS l_extendedprice FROM range(40)"
    spark.sql(lines).write.parquet(str(tmp_path / "d"))
    spark.sql("SELECT 0 AS p_partkey, 'SMALL' AS p_type, 900D AS p_retailprice").write.parquet(str(tmp_path / "part.parquet"))
    spark.sql("SELECT id AS o_orderkey, TIMESTAMP_NTZ '1996-05-01 00:00:00' + make_dt_interval(INT(id)) AS o_orderdate FROM range(20)").write.parquet(str(tmp_path / "orders.parquet"))
    shutil.copy(next((tmp_path / "d").glob("part-*.parquet")), tmp_path / "lineitem.parquet")
    got = {tuple(r) for r in catalog.QUERIES["option_features"](spark, str(tmp_path)).select("date", "daily_return", "spread", "returns_1d").collect()}
    c = duckdb.connect()
    c.execute("SET threads = 1")
    for t, at in (("lineitem", "lineitem.parquet"), ("part", "part.parquet/*.parquet"), ("orders", "orders.parquet/*.parquet")):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{at}'")
    assert len(got) == 20 and got == set(c.execute(f"SELECT date, daily_return, spread, returns_1d FROM ({catalog.ORACLE_SQL['option_features']})").fetchall())


def test_a_chain_reads_its_row_groups_only(spark, contracts, tmp_path):
    layouts.write_clustered(contracts, str(tmp_path / "t"), ["underlying", "ticker", "date"], {"ticker": 5000}, group_bytes=16 << 10, files=3)
    stored = spark.read.parquet(str(tmp_path / "t"))
    many = groups(tmp_path / "t")
    assert many >= 20 and stored.count() == 60_000
    chain = options.stored_chain(stored, "stan")
    assert sorted(map(tuple, chain.collect())) == sorted(map(tuple, options.chain(contracts, "stan").collect()))
    assert 12_000 <= scanned(chain) < 60_000 / 3
    one = contracts.first()["ticker"]
    assert scanned(options.contract_bars(stored, one)) < 60_000 / 10
    assert options.contract_bars(stored, one.lower()).count() == contracts.filter(F.col("ticker") == one).count()


def test_bloom_filters_skip_what_the_order_can_t(spark, contracts, tmp_path):
    """By date each row group spans all tickers: statistics skip nothing, filters do."""
    some = contracts.withColumn("ticker", F.concat("ticker", F.lit("-"), F.col("volume").cast("string")))
    missing = some.filter("volume = 30000").first()["ticker"] + "x"
    read = {}
    for name, bloom in (("plain", None), ("bloom", {"ticker": 5000})):
        layouts.write_clustered(some, str(tmp_path / name), ["date"], bloom, group_bytes=16 << 10, files=2)
        stored = spark.read.option("parquet.filter.dictionary.enabled", "false").option("parquet.filter.columnindex.enabled", "false").parquet(str(tmp_path / name))
        assert options.contract_bars(stored, missing[:-1]).count() == 1
        read[name] = scanned(stored.filter(F.col("ticker") == missing))
    assert groups(tmp_path / "plain") >= 10
    assert read["plain"] > 10_000 and read["bloom"] < read["plain"] / 4, read


def test_actions_of_one_ticker_skip_the_others(spark, tmp_path):
    rows = spark.range(40_000).select(F.concat(F.lit("T"), F.col("id") % 400).alias("ticker"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("event_date"), F.element_at(F.array(F.lit("dividend"), F.lit("split")), (F.col("id") % 2 + 1).cast("int")).alias("event_type"))
    sinks.write_actions(rows, str(tmp_path / "a"), by_ticker=True)
    one = spark.read.parquet(str(tmp_path / "a")).filter("ticker = 'T7' AND event_type = 'split'")
    assert one.count() == 100 and scanned(one) <= 40_000 / 4  # not the other type's folder nor, in files, other tickers' pages


def test_bucketed_tables_join_without_exchange_or_sort(spark, contracts):
    prices = contracts.select(F.col("underlying"), "date").distinct().withColumn("close", F.length("underlying") * 10.0)
    at = ["underlying", "date"]
    a, b = layouts.bucketed(contracts, at, 4), layouts.bucketed(prices, at, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = options.with_underlying(a, b.withColumnRenamed("underlying", "symbol"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = options.with_underlying(contracts, prices.withColumnRenamed("underlying", "symbol"))
        assert sorted(map(tuple, joined.select("ticker", "date", "volume", "underlying_price").collect())) == sorted(map(tuple, want.select("ticker", "date", "volume", "underlying_price").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_new_days_read_themselves_and_the_tails(spark, tmp_path):
    """Runs day by day give what one run over everything gives; a repeated run gives nothing; keys that pause keep their tails."""
    rng = random.Random(8)
    rows = [(s, dt.date(2024, 1, 1) + dt.timedelta(days=k), *(10 + rng.random() for _ in range(4)), rng.randrange(9), 1) for s in ("A", "B", "C") for k in range(70) if s != "B" or k % 7 == 0 or k > 60]
    schema = "symbol string, date date, open double, high double, low double, close double, volume bigint, transactions bigint"
    days = spark.createDataFrame([*rows, (None, dt.date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1, 1)], schema)
    days.repartition(2).write.partitionBy("date").parquet(str(tmp_path / "bars"))
    stored, tails = spark.read.parquet(str(tmp_path / "bars")), str(tmp_path / "tails")
    runs = []
    for a, b in ((0, 50), (50, 68), (68, 70)):
        part = stored.filter(F.col("date").between(dt.date(2024, 1, 1) + dt.timedelta(days=a), dt.date(2024, 1, 1) + dt.timedelta(days=b - 1)))
        runs.append(incremental.enrich_new(part, bars.daily_features, tails, buckets=4))
    assert scanned(part.select("close")) == sum(r[1] >= dt.date(2024, 3, 9) for r in rows)
    got = runs[0].unionByName(runs[1]).unionByName(runs[2])
    want = bars.daily_features(days.filter("symbol IS NOT NULL")).select(*got.columns)
    key = lambda r: (r["symbol"], r["date"])
    for x, y in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert key(x) == key(y) and all((a is None and b is None) or a == b or abs(a - b) < 1e-12 for a, b in zip(x[2:], y[2:], strict=True) if not isinstance(a, str))
    assert incremental.enrich_new(part, bars.daily_features, tails, buckets=4).count() == 0
    tail = upserts.read_upserted(spark, tails)
    assert {r["symbol"]: len(r["tail"]) for r in tail.collect()} == {"A": 60, "B": sum(r[0] == "B" for r in rows), "C": 60}


def test_day_sketches_merge_and_read_new_days_only(spark, tmp_path):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int"))
    rows = spark.range(40_000).select(day.alias("date"), F.when(F.col("id") % 11 > 0, (F.col("id") * 7) % 9000).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("v"))
    rows.write.partitionBy("date").parquet(str(tmp_path / "t"))
    table, path = spark.read.parquet(str(tmp_path / "t")), str(tmp_path / "s")
    assert sketches.stored_days(spark, path) is None
    sketches.add_days(table.filter("date < '2024-02-09'"), path, "k", "date", ("v",))
    assert sketches.stored_days(spark, path).count() == 39
    new = sketches.missing_days(table, path, "date")
    assert scanned(new.select("k")) == 1000
    sketches.add_days(table, path, "k", "date", ("v",))
    sketches.add_days(table, path, "k", "date", ("v",))  # nothing is new
    got = sketches.report(sketches.stored_days(spark, path), sums=("v",)).first()
    want = table.agg(F.count("*"), F.count_distinct("k"), F.min("date"), F.max("date"), F.sum("v"), F.avg("v")).first()
    assert (got["rows"], got["first_date"], got["last_date"], got["total_v"]) == (want[0], want[2], want[3], want[4]) and abs(got["avg_v"] - want[5]) < 1e-12
    assert abs(got["keys"] - want[1]) <= got["keys_error"] <= want[1] * 0.05
    late = table.unionByName(spark.createDataFrame([(dt.date(2024, 1, 3), -5, 100)], "date date, k bigint, v bigint"))
    sketches.redo_days(late, path, "k", "date", ["2024-01-03"], ("v",))
    again = sketches.report(sketches.stored_days(spark, path), sums=("v",)).first()
    assert (again["rows"], again["total_v"]) == (40_001, want[4] + 100)
    empty = sketches.report(sketches.stored_days(spark, path).limit(0), sums=("v",)).first()
    assert (empty["rows"], empty["keys_error"], empty["avg_v"]) == (None, 0, None)
