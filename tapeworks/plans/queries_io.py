"""Registered queries that write what they derive from the tables, and read it back; and streams over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.exprs import series
from tapeworks.operators import access as Q
from tapeworks.operators import actions as C
from tapeworks.operators import bars as B
from tapeworks.operators import fundamentals as FU
from tapeworks.operators import options as O
from tapeworks.operators import quality as DQ
from tapeworks.operators import summaries as A
from tapeworks.plans import views as V
from tapeworks.plans.catalog import query
from tapeworks.plans.queries import OHLC
from tapeworks.sources import readers, schemas, sinks, upserts
from tapeworks.sources.scratch import folder
from tapeworks.streaming import jobs, state

PERIOD = ["ticker", "fiscal_year", "fiscal_period"]
NOON = "CAST(date AS TIMESTAMP) + INTERVAL 12 HOUR"


def _raw(s, d) -> DataFrame:
    """Daily bars in the raw file format: epoch nanoseconds at noon, and NA tokens for some values."""
    b = V.bars_daily(s, d)
    ns = (F.unix_date("date").cast("bigint") * 86400 + 43200) * 1_000_000_000
    some = lambda c, k, token: F.when(F.col("transactions") % 7 == k, token).otherwise(F.col(c).cast("string"))
    return b.select(F.col("symbol").alias("ticker"), some("volume", 3, "NaN").alias("volume"), some("open", 4, "NA").alias("open"), "close", some("high", 5, "NULL").alias("high"), some("low", 6, "").alias("low"), ns.alias("window_start"), "transactions")


@query("csv_landing_to_bars", "SRC-1 SRC-2 SRC-3 SRC-4 SRC-5 SNK-8", f"""SELECT CAST(year(date) AS SMALLINT) AS year, CAST(month(date) AS TINYINT) AS month, symbol, date, {NOON} AS timestamp, CASE WHEN transactions % 7 <> 4 THEN open END AS open,
  CASE WHEN transactions % 7 <> 5 THEN high END AS high, CASE WHEN transactions % 7 <> 6 THEN low END AS low, close, CASE WHEN transactions % 7 <> 3 THEN volume END AS volume,
  transactions FROM bars_daily""",
    OHLC, ["year", "month", "symbol", "date", "timestamp", "volume", "transactions"])
def _(s, d):
    """Write raw bar files, read, clean, rename, date and conform them."""
    path = folder(s, "landing")
    sinks.export_csv(_raw(s, d), path)
    out = schemas.conform(readers.with_dates(readers.normalize(readers.read_bars_csv(s, path), "stocks_daily")), "stocks_daily")
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("api_bars", "SRC-6", f"SELECT symbol, {NOON} AS timestamp, open, high, low, close, volume, 0.0 AS vwap, CASE WHEN transactions % 2 = 0 THEN transactions ELSE 0 END AS transactions FROM bars_daily", [*OHLC, "vwap"], ["symbol", "timestamp", "volume", "transactions"])
def _(s, d):
    """Payload rows with short names and missing fields, a page for each symbol and month that names its symbol, written and read as JSON: as many files as tasks, however many symbols."""
    path = folder(s, "payload")
    ms = (F.unix_date("date").cast("bigint") * 86400 + 43200) * 1000
    row = F.struct(ms.alias("t"), F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"), F.col("close").alias("c"), F.col("volume").alias("v"), F.when(F.col("transactions") % 2 == 0, F.col("transactions")).alias("n"))
    V.bars_daily(s, d).groupBy("symbol", F.trunc("date", "month").alias("month")).agg(F.collect_list(row).alias("results")).drop("month").write.json(path)
    return readers.read_api_bars(s, path, page="symbol string").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _through_json(s, df: DataFrame, name: str) -> DataFrame:
    """Rows written as payload objects, and read back by the payload's schema."""
    path = folder(s, name)
    df.write.json(path)
    return readers.read_payload(s, path, name, wrapped=None)


def _facts(df: DataFrame, kind: str, name, detail, number) -> DataFrame:
    """kind, name, detail, number: what the payload tables have in common."""
    return df.select(F.lit(kind).alias("kind"), name.cast("string").alias("name"), detail.cast("string").alias("detail"), number.cast("double").alias("number"))


@query("reference_payloads", "SRC-10", """
SELECT 'holidays' AS kind, CAST(date AS VARCHAR) AS name, symbol || ' closed' AS detail, NULL AS number FROM bars_long
UNION ALL SELECT 'exchanges', n_name, 'XNAT', n_nationkey FROM nation
UNION ALL SELECT 'conditions', r_name, 'trade,bbo', r_regionkey FROM region
UNION ALL SELECT DISTINCT 'ticker_types', type, locale, NULL FROM tickers
UNION ALL SELECT 'market_status', c_mktsegment, CASE WHEN max(c_acctbal) > 9000 THEN 'open' ELSE 'closed' END, NULL FROM customer GROUP BY c_mktsegment""", ["number"], ["kind", "name", "detail"])
def _(s, d):
    """Holidays, exchanges, conditions, ticker types and market status as the service sends them."""
    bars, nation, region = V.bars_long(s, d), V.table(s, d, "nation"), V.table(s, d, "region")
    holidays = _through_json(s, bars.select(F.col("date").cast("string").alias("date"), F.col("symbol").alias("exchange"), F.lit("closed").alias("status")), "holidays")
    exchanges = _through_json(s, nation.select(F.col("n_nationkey").alias("id"), F.lit("exchange").alias("type"), F.col("n_name").alias("name"), F.lit("XNAT").alias("mic")), "exchanges")
    conditions = _through_json(s, region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"), F.array(F.lit("trade"), F.lit("bbo")).alias("data_types")), "conditions")
    types = _through_json(s, V.tickers(s, d).select(F.col("type").alias("code"), "locale").distinct(), "ticker_types")
    state = V.table(s, d, "customer").groupBy(F.col("c_mktsegment").alias("market")).agg(F.max("c_acctbal").alias("most"))
    status = _through_json(s, state.select("market", F.create_map(F.lit("main"), F.when(F.col("most") > 9000, "open").otherwise("closed")).alias("exchanges")), "market_status")
    none = F.lit(None)
    return Q.union_all(
        _facts(holidays, "holidays", F.col("date"), F.concat_ws(" ", "exchange", "status"), none), _facts(exchanges, "exchanges", F.col("name"), F.col("mic"), F.col("id")),
        _facts(conditions, "conditions", F.col("name"), F.concat_ws(",", "data_types"), F.col("id")), _facts(types, "ticker_types", F.col("code"), F.col("locale"), none),
        _facts(status, "market_status", F.col("market"), F.col("exchanges")["main"], none),
    )


@query("market_payloads", "SRC-11", """
SELECT 'trades' AS kind, CAST(event_id AS VARCHAR) AS name, CAST(epoch_ns(ts) AS VARCHAR) AS detail, price AS number FROM ticks
UNION ALL SELECT 'quotes', CAST(event_id AS VARCHAR), CAST(volume AS VARCHAR), price - 0.5 FROM ticks
UNION ALL SELECT 'forex_quotes', symbol, CAST(epoch_us(ts) // 1000 AS VARCHAR), price + 0.5 FROM ticks
UNION ALL SELECT 'crypto_trades', CAST(event_id AS VARCHAR), '1,2', price FROM ticks
UNION ALL SELECT 'index_values', symbol, 'value', avg(price) FROM ticks GROUP BY symbol""", ["number"], ["kind", "name", "detail"])
def _(s, d):
    """Trades, quotes, currency quotes, coin trades and index values as the service sends them. A currency quote has no id: its exchange stands for the symbol."""
    t = V.ticks(s, d).withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    key, user = F.col("event_id").cast("string").alias("id"), F.substring("symbol", 2, 20).cast("bigint")
    trades = _through_json(s, t.select(key, (F.col("us") * 1000).alias("sip_timestamp"), "price", F.col("volume").cast("double").alias("size")), "trades")
    quotes = _through_json(s, t.select(F.col("event_id").alias("sequence_number"), (F.col("price") - 0.5).alias("bid_price"), F.col("volume").cast("double").alias("bid_size")), "quotes")
    forex = _through_json(s, t.select((F.col("price") + 0.5).alias("ask"), user.alias("exchange"), F.expr("us div 1000").alias("timestamp")), "forex_quotes")
    crypto = _through_json(s, t.select(key, "price", F.array(F.lit(1), F.lit(2)).alias("conditions")), "crypto_trades")
    index = _through_json(s, t.groupBy(F.col("symbol").alias("ticker")).agg(F.avg("price").alias("value")).withColumn("type", F.lit("value")), "index_values")
    return Q.union_all(
        _facts(trades, "trades", F.col("id"), F.col("sip_timestamp"), F.col("price")), _facts(quotes, "quotes", F.col("sequence_number"), F.col("bid_size").cast("bigint"), F.col("bid_price")),
        _facts(forex, "forex_quotes", F.concat(F.lit("S"), F.col("exchange").cast("string")), F.col("timestamp"), F.col("ask")),
        _facts(crypto, "crypto_trades", F.col("id"), F.concat_ws(",", F.col("conditions").cast("array<string>")), F.col("price")), _facts(index, "index_values", F.col("ticker"), F.col("type"), F.col("value")),
    )


@query("option_contract_payload", "SRC-7", "SELECT DISTINCT ticker, underlying, 100 AS shares_per_contract, 'american' AS exercise_style FROM option_parsed WHERE underlying IS NOT NULL", None)
def _(s, d):


    path = folder(s, "contracts")
    c = O.contracts(V.option_bars(s, d)).select("ticker", F.col("underlying").alias("underlying_ticker"), F.col("strike_price"))
    c.write.json(path)
    return readers.read_option_contracts(s, path, wrapped=None).select("ticker", F.col("underlying_ticker").alias("underlying"), F.col("shares_per_contract").cast("int").alias("shares_per_contract"), "exercise_style")


@query("snapshot_flatten", "SRC-9 X-7 X-8", "SELECT symbol AS ticker, date, close AS day_c, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev_c FROM bars_daily", ["day_c", "prev_c"], ["ticker", "date"])
def _(s, d):


    b = V.bars_daily(s, d)
    both = b.select(F.col("symbol").alias("ticker"), F.struct("date", F.col("close").alias("c")).alias("day"), F.struct(F.lag("date").over(series()).alias("date"), F.lag("close").over(series()).alias("c")).alias("prevDay"))
    return readers.flat_snapshots(both).select("ticker", F.col("day_date").alias("date"), "day_c", "prev_c")


@query("bars_sink", "SNK-1 SRC-8", "SELECT symbol, date, close, volume FROM bars_daily", ["close"], ["symbol", "date", "volume"])
def _(s, d):
    """Half the dates, then all: dates that are there are skipped."""
    path = folder(s, "bronze")
    b = V.bars_daily(s, d).withColumns({"year": F.year("date"), "month": F.month("date")})
    sinks.write_bars(b.filter(F.dayofmonth("date") % 2 == 0), path)
    sinks.write_bars(b, path)
    return readers.read_table(s, path).select("symbol", "date", "close", "volume")


@query("enriched_sink", "SNK-2 SNK-6 IN-6", "SELECT symbol, date, close FROM bars_long WHERE year(date) <> 1996 UNION ALL SELECT symbol, date, close + 1 FROM bars_long WHERE year(date) = 1996", ["close"], ["symbol", "date"])
def _(s, d):
    """All years, then one again: only its partitions are replaced."""
    path = folder(s, "silver")
    b = V.bars_long(s, d).select("symbol", "date", "close", F.year("date").alias("year"))
    sinks.write_enriched(b, path, ("year",))
    sinks.write_enriched(b.filter("year = 1996").withColumn("close", F.col("close") + 1), path, ("year",))
    return readers.read_table(s, path).select("symbol", "date", "close")


@query("fundamentals_sink", "SNK-3 Q-7 U-2", """SELECT ticker, fiscal_year, fiscal_period, 'b' AS kind FROM balance_sheets
  WHERE ticker = 'C1' UNION ALL SELECT ticker, fiscal_year, fiscal_period, 'i'
  FROM income_statements WHERE ticker = 'C1' UNION ALL SELECT ticker, fiscal_year, fiscal_period, 'c'
  FROM cash_flow WHERE ticker = 'C1'""")
def _(s, d):
    root = folder(s, "fundamentals")
    for name, df in (("balance_sheets", V.balance_sheets(s, d)), ("income_statements", V.income_statements(s, d)), ("cash_flow", V.cash_flow(s, d))):
        sinks.write_fundamentals(df, f"{root}/{name}")
    found = Q.load_fundamentals(s, root, tickers=["c1"])
    parts = [found[n].select(*PERIOD, F.lit(n[0]).alias("kind")) for n in ("balance_sheets", "income_statements", "cash_flow")]
    return Q.union_all(*parts)


@query("actions_sink", "SNK-4", "SELECT ticker, event_type, event_date, id FROM split_events")
def _(s, d):
    path = folder(s, "actions")
    sinks.write_actions(C.all_actions(C.splits(V.splits(s, d))), path, by_ticker=True)
    return readers.read_table(s, path).select("ticker", "event_type", "event_date", "id")


@query("action_lookup", "SNK-4 Q-8", "SELECT ticker, event_type, event_date, id FROM split_events WHERE ticker = 'S7'")
def _(s, d):
    """All splits stored by ticker, and those of one looked up: statistics skip the other tickers' pages."""
    path = folder(s, "actions")
    sinks.write_actions(C.all_actions(C.splits(V.splits(s, d))), path, by_ticker=True)
    return s.read.parquet(path).filter("ticker = 'S7'").select("ticker", "event_type", "event_date", "id")


@query("reference_sink", "SNK-7", "SELECT ticker, locale, type FROM tickers WHERE type <> 'WARRANT'")
def _(s, d):
    path = folder(s, "reference")
    sinks.write_reference(V.tickers(s, d).withColumn("type", F.when(F.col("type") != "WARRANT", F.col("type"))), path)
    return readers.read_table(s, path).select("ticker", "locale", "type")


@query("compaction", "SNK-9", "SELECT symbol, date, close FROM bars_daily", ["close"], ["symbol", "date"])
def _(s, d):
    many, few = folder(s, "many"), folder(s, "few")
    b = V.bars_daily(s, d).withColumns({"year": F.year("date"), "month": F.month("date")})
    b.repartition(4).write.partitionBy("year", "month").parquet(many)
    sinks.compact(s, many, few)
    return readers.read_table(s, few).select("symbol", "date", "close")


@query("flatten_statements", "F-2 F-3", "SELECT ticker, fiscal_year, fiscal_period, assets AS bs_assets, equity AS bs_equity, CAST(length(ticker) AS DOUBLE) AS bs_size, NULL AS is_revenues FROM balance_sheets", ["bs_assets", "bs_equity", "bs_size", "is_revenues"], PERIOD)
def _(s, d):
    """Statements nested as the service nests them, unnested again; a value that is no number is NULL."""
    value = lambda c: F.struct(c.alias("value"), F.lit("USD").alias("unit"))
    sheet = F.struct(value(F.col("assets")).alias("assets"), value(F.col("equity")).alias("equity"), value(F.length("ticker")).alias("size"))
    nested = V.balance_sheets(s, d).select(*PERIOD, F.struct(sheet.alias("balance_sheet"), F.struct(value(F.lit("n/a")).alias("revenues")).alias("income_statement")).alias("financials"))
    return FU.flatten_statements(nested).select(*PERIOD, "bs_assets", "bs_equity", "bs_size", "is_revenues")


@query("backfill", "IN-5", "SELECT symbol, date, price_range FROM (SELECT symbol, date, high - low AS price_range FROM bars_daily) WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-12' AND date <> DATE '2024-01-10'", ["price_range"], ["symbol", "date"])
def _(s, d):
    done = DQ.dates(s, "2024-01-10", "2024-01-10")
    return DQ.backfill(V.bars_daily(s, d), B.daily_features, DQ.dates(s, "2024-01-08", "2024-01-12"), done).select("symbol", "date", "price_range")


@query("schema_consistency", "DQ-11", "SELECT 0 AS differences")
def _(s, d):
    """Columns by which any file of a table differs in type from the table's first file, counted on both sides; every file's footer is read.
    The driver's table is consistent; ``schema_drift`` has differences to find."""
    found = DQ.schema_differences(s, sorted(s.read.parquet(f"{d}/events.parquet").inputFiles()))
    return found.agg(F.coalesce(F.sum(F.col("type").isNotNull().cast("int") + F.col("expected").isNotNull().cast("int")), F.lit(0)).cast("int").alias("differences"))


@query("schema_drift", "DQ-11", """
SELECT part, "column", type, expected, n AS rows FROM (SELECT user_id % 3 AS k, count(*) AS n FROM events GROUP BY 1)
JOIN (VALUES (1, 'part=1', 'user_id', 'string', 'bigint'), (2, 'part=2', 'props', NULL, 'string')) v (k, part, "column", type, expected) USING (k)""")
def _(s, d):
    """Events in three parts by user, one with the user as text and one without props: each difference, and the rows that have it."""
    root, events = folder(s, "parts"), V.table(s, d, "events")
    mine = lambda k: events.filter(F.col("user_id") % 3 == k)
    for k, part in enumerate((mine(0), mine(1).withColumn("user_id", F.col("user_id").cast("string")), mine(2).drop("props"))):
        part.write.parquet(f"{root}/part={k}")
    found = DQ.schema_differences(s, [f"{root}/part={k}" for k in range(3)]).withColumn("part", F.regexp_extract("path", "(part=[0-9]+)$", 1))
    sizes = [s.read.parquet(f"{root}/part={k}").agg(F.count("*").alias("rows")).withColumn("part", F.lit(f"part={k}")) for k in range(3)]
    return found.join(Q.union_all(*sizes), "part").select("part", "column", "type", "expected", "rows")


@query("scalar_functions", "X-1 X-2 X-3 X-4 X-5 X-6", """SELECT ticker, upper(sector) AS up, lower(sic_code) AS low, replace(sector, ' ', '_') AS under, substr(sector, 1, 3) AS head, round(sqrt(coalesce(market_cap,
  0)), 3) AS root, greatest(length(sector), 10) AS most, try_cast(substr(ticker, 2) AS BIGINT) AS number, len(string_split(sector, ' ')) AS words
  FROM tickers""", {"root": 3}, ["ticker", "up", "low", "under", "head", "most", "number", "words"])
def _(s, d):
    return V.tickers(s, d).select(
        "ticker", F.upper("sector").alias("up"), F.lower("sic_code").alias("low"), F.replace("sector", F.lit(" "), F.lit("_")).alias("under"), F.substring("sector", 1, 3).alias("head"), F.sqrt(F.coalesce("market_cap", F.lit(0.0))).alias("root"),
        F.greatest(F.length("sector"), F.lit(10)).cast("long").alias("most"), F.substring("ticker", 2, 20).try_cast("bigint").alias("number"), F.size(F.split("sector", " ")).cast("long").alias("words"),
    )


# ---------------------------------------------------------------- streams: each runs to the end of what is there


def _stream(s, d, name: str) -> DataFrame:
    """A driver table as a stream of its files."""
    return s.readStream.schema(s.read.parquet(f"{d}/{name}.parquet").schema).parquet(f"{d}/{name}.parquet*")


def _drain(stream: DataFrame, mode: str, every: bool = False) -> DataFrame:
    """Run to the end; the last batch's rows (mode complete) or all rows (append, or ``every`` batch's), read back from files."""
    s = stream.sparkSession
    out, mark = folder(s, "stream"), folder(s, "marks")

    def save(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/v={epoch:06d}")

    stream.writeStream.foreachBatch(save).outputMode(mode).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    rows = s.read.parquet(out)
    return rows.drop("v") if mode == "append" or every else rows.filter(F.col("v") == rows.agg(F.max("v")).first()[0]).drop("v")


def _tick_stream(s, d) -> DataFrame:
    return _stream(s, d, "events").select("event_id", F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("volume"))


@query("stream_minute_bars", "ST-2", "SELECT symbol, timestamp, open, high, low, close, volume, transactions FROM bars_minute", OHLC, ["symbol", "timestamp", "volume", "transactions"])
def _(s, d):
    bars = _drain(jobs.minute_bars(_tick_stream(s, d)), "complete")
    return bars.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("stream_unique_news", "ST-3", "SELECT DISTINCT CAST(event_id % 500 AS VARCHAR) AS id FROM events")
def _(s, d):
    """Ids that repeat, all within the time that duplicates are looked for."""
    n = _stream(s, d, "events").select((F.col("event_id") % 500).cast("string").alias("id"), F.col("ts").cast("timestamp").alias("published"))
    return _drain(jobs.unique_news(n, "60 days").select("id"), "append")


@query("stream_first_rows", "ST-3", "SELECT DISTINCT symbol AS id, true AS earliest FROM ticks")
def _(s, d):
    """The first tick of each symbol over any time, from keyed state; whether it is one of the symbol's first time."""
    ticks = _tick_stream(s, d).select(F.col("symbol").alias("id"), F.col("ts").cast("timestamp").alias("ts"))
    with state.rocksdb(s):
        found = _drain(state.first_rows(ticks, "id", "ts"), "append")
    first = V.ticks(s, d).groupBy(F.col("symbol").alias("id")).agg(F.min("ts").cast("timestamp").alias("first"))
    return found.join(first, "id").select("id", (F.col("ts") == F.col("first")).alias("earliest"))


@query("stream_dimension_join", "ST-5", "SELECT event_id, symbol AS ticker, sector FROM ticks LEFT JOIN tickers t ON symbol = t.ticker")
def _(s, d):
    e = _tick_stream(s, d).select("event_id", F.col("symbol").alias("ticker"))
    return _drain(jobs.with_dimension(e, V.tickers(s, d).select("ticker", "sector")), "append")


@query("stream_upsert", "ST-4", "SELECT symbol AS ticker, arg_max(price, row(ts, event_id)) AS price FROM ticks GROUP BY 1", ["price"], ["ticker"])
def _(s, d):
    """The latest price of each symbol, merged batch by batch."""
    path = folder(s, "latest")
    e = _tick_stream(s, d).select(F.col("symbol").alias("ticker"), "price", F.struct("ts", "event_id").alias("at"))
    jobs.upsert_reference(e, path, folder(s, "marks"), ["ticker"], "at").awaitTermination()
    return upserts.read_upserted(s, path).select("ticker", "price")


@query("stream_latest_state", "ST-4", "SELECT symbol AS ticker, max(ts) AS ts FROM ticks GROUP BY 1")
def _(s, d):
    """The latest tick of each symbol from keyed state, which gives out a row whenever it changes."""
    ticks = _tick_stream(s, d).select(F.col("symbol").alias("ticker"), "ts")
    with state.rocksdb(s):
        updates = _drain(state.latest_rows(ticks, "ticker", "ts"), "update", every=True)
    return state.latest_of_updates(updates, "ticker", "ts").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_landing", "ST-1", "SELECT symbol, date, open, high, low, close, volume, transactions FROM bars_daily", OHLC, ["symbol", "date", "volume", "transactions"])
def _(s, d):
    """Raw files through the landing stream into a bronze table, in two runs; the second takes the new files only."""
    land, bronze, mark = folder(s, "land"), folder(s, "bronze"), folder(s, "marks")
    ns = (F.unix_date("date").cast("bigint") * 86400 + 43200) * 1_000_000_000
    raw = V.bars_daily(s, d).select(F.col("symbol").alias("ticker"), F.col("volume").cast("double").alias("volume"), "open", "close", "high", "low", ns.alias("window_start"), "transactions")
    for part in (F.col("ticker") < "S5", F.col("ticker") >= "S5"):
        raw.filter(part).write.mode("append").option("header", True).csv(land)
        jobs.landing_to_bronze(s, land, bronze, mark, "stocks_daily").awaitTermination()
    return s.read.parquet(bronze).select("symbol", "date", *OHLC, "volume", "transactions")


@query("log_append", "IN-6", "SELECT layer, count(*) AS rows FROM ingestion_log GROUP BY 1")
def _(s, d):
    path = folder(s, "log")
    log = V.ingestion_log(s, d)
    for layer in ("landing", "bronze", "silver", "gold"):
        sinks.append(log.filter(F.col("layer") == layer), path)
    return A.counts_by(readers.read_table(s, path), "layer")
