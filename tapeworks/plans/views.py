"""The driver tables seen as market data: a DataFrame builder and portable SQL for each view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.operators import bars as B
from tapeworks.sources.scratch import folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id", F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("symbol"), "ts", F.to_date("ts").alias("date"),
        F.col("value").alias("price"), F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("volume"), "event_type",
    )


def bars_daily(spark: SparkSession, d: str) -> DataFrame:
    return B.daily_bars(ticks(spark, d))


def bars_long(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    t = o.select(F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("symbol"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("price"), (F.col("o_orderkey") % 1000).alias("volume"), F.col("o_orderkey").alias("ts"))
    return B.tick_bars(t, "symbol", "date", tie="ts")


def bars_minute(spark: SparkSession, d: str) -> DataFrame:
    return B.window_bars(ticks(spark, d), 1, "minutes")


def option_lines(spark: SparkSession, d: str) -> DataFrame:
    """The lines that stand for option trades, stored for several readers."""
    path = folder(spark, "lines")
    columns = ["p_type", "p_retailprice", "l_shipdate", "l_returnflag", "l_orderkey", "l_linenumber", "l_row", "l_extendedprice", "l_quantity", "o_orderdate"]
    _option_lines(spark, d).select(*columns).write.parquet(path)
    return spark.read.parquet(path)


def _option_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("*", F.col("_metadata.row_index").alias("l_row"))
    lines = lines.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.join(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))


def option_bars(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    ship = F.col("l_shipdate")
    ticker = F.concat(
        F.lit("O:"), F.upper(F.substring("p_type", 1, 4)), two(F.year(ship) % 100), two(F.month(ship)), two(F.dayofmonth(ship)),
        F.when(F.col("l_returnflag") == "R", "P").otherwise("C"), F.lpad(F.round(F.col("p_retailprice") * 1000).cast("long").cast("string"), 8, "0"),
    )
    return (_option_lines(spark, d) if lines is None else lines).select(ticker.alias("ticker"), F.to_date("o_orderdate").alias("date"), "l_orderkey", "l_linenumber", "l_row", (F.col("l_extendedprice") / 1000).alias("close"), F.col("l_quantity").cast("long").alias("volume"))


def underlying_bars(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    return (_option_lines(spark, d) if lines is None else lines).groupBy(F.upper(F.substring("p_type", 1, 4)).alias("symbol"), F.to_date("o_orderdate").alias("date")).agg(F.max("p_retailprice").alias("close"))


def option_daily(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    """One bar per contract and date. An order may have a line number twice: of such lines the one that stands first in its file counts, for open and close."""
    close = F.col("close")
    return option_bars(spark, d, lines).groupBy("ticker", "date").agg(
        F.min_by(close, F.struct("l_orderkey", "l_linenumber", "l_row")).alias("open"), F.max(close).alias("high"), F.min(close).alias("low"),
        F.max_by(close, F.struct("l_orderkey", "l_linenumber", -F.col("l_row"))).alias("close"), F.sum("volume").cast("long").alias("volume"), F.count("*").alias("transactions"),
    )


def _money(c: str, when=None):
    v = F.col(c).cast("decimal(18,2)")
    return F.sum(v if when is None else F.when(when, v)).cast("double")


def _period(nation: str, date: str) -> list:
    return [F.concat(F.lit("C"), F.col(nation).cast("string")).alias("ticker"), F.year(date).alias("fiscal_year"), F.concat(F.lit("Q"), F.quarter(date).cast("string")).alias("fiscal_period")]


def _named(df: DataFrame) -> DataFrame:
    """With the timeframe, and the quarter's first day as filing date."""
    day = F.make_date("fiscal_year", (F.substring("fiscal_period", 2, 1).cast("int") - 1) * 3 + 1, F.lit(1))
    return df.withColumns({"timeframe": F.lit("quarterly"), "filing_date": day})


def balance_sheets(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    status = F.col("o_orderstatus")
    return _named(o.groupBy(*_period("c_nationkey", "o_orderdate")).agg(
        _money("o_totalprice").alias("assets"), _money("o_totalprice", status == "O").alias("current_assets"), _money("o_totalprice", status == "P").alias("current_liabilities"), _money("o_totalprice", status == "F").alias("equity"),
    ))


def income_statements(spark: SparkSession, d: str) -> DataFrame:
    """All nations but one, which files none, so that joins meet a gap."""
    o = table(spark, d, "orders").join(table(spark, d, "customer").filter("c_nationkey <> 3").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    rows = table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    flag = F.col("l_returnflag")
    return _named(rows.groupBy(*_period("c_nationkey", "l_shipdate")).agg(
        _money("l_extendedprice").alias("revenues"), _money("l_extendedprice", flag == "R").alias("cost_of_revenue"), _money("l_extendedprice", flag == "N").alias("net_income_loss"),
    ))


def cash_flow(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return _named(rows.groupBy(*_period("s_nationkey", "l_shipdate")).agg(_money("l_extendedprice").alias("net_cash_flow_from_operating_activities")))


def _mod_ticker(c: str):
    return F.concat(F.lit("S"), (F.col(c) % 150).cast("string")).alias("ticker")


def dividends(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") % 6
    often = F.when(k == 0, 12).when(k == 1, 4).when(k == 2, 2).when(k == 3, 1).when(k == 4, 0)
    o = table(spark, d, "orders").filter("o_orderstatus = 'F'")
    return o.select(_mod_ticker("o_custkey"), F.col("o_orderkey").cast("string").alias("id"), F.to_date("o_orderdate").alias("ex_dividend_date"), (F.col("o_totalprice") / 100000).alias("cash_amount"), often.alias("frequency"))


def splits(spark: SparkSession, d: str) -> DataFrame:
    """Returned lines as splits."""
    return table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(
        _mod_ticker("l_partkey"), F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey").alias("id"), F.to_date("l_shipdate").alias("execution_date"),
        (1 + F.col("l_partkey") % 4).cast("double").alias("split_from"), (1 + F.col("l_suppkey") % 4).cast("double").alias("split_to"),
    )


def actions_2024(spark: SparkSession, d: str) -> DataFrame:
    """Orders in progress as actions of one month."""
    return table(spark, d, "orders").filter("o_orderstatus = 'P'").select(
        _mod_ticker("o_custkey"), F.col("o_orderkey").cast("string").alias("id"), F.make_date(F.lit(2024), F.lit(1), (1 + F.col("o_orderkey") % 30).cast("int")).alias("event_date"),
        (20 + F.col("o_orderkey") % 4).cast("double").alias("split_from"), (20 + F.col("o_custkey") % 4).cast("double").alias("split_to"), (F.col("o_totalprice") / 100000).alias("cash_amount"),
    )


def tickers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        F.concat(F.lit("S"), k.cast("string")).alias("ticker"), F.col("p_type").alias("sector"), F.col("p_brand").alias("sic_code"), (k % 10 != 0).alias("active"),
        F.when(k % 7 == 0, "ca").otherwise("us").alias("locale"), F.when(k % 4 == 0, "ETF").when(k % 4 == 1, "WARRANT").otherwise("CS").alias("type"),
        F.when(k % 11 != 0, F.pow(F.lit(10.0), 6 + k % 6) * F.col("p_size")).alias("market_cap"),
    )


def relationships(spark: SparkSession, d: str) -> DataFrame:
    s = lambda c: F.concat(F.lit("S"), F.col(c).cast("string"))
    return table(spark, d, "lineitem").select(s("l_partkey").alias("source_ticker"), s("l_suppkey").alias("ticker"))


def ingestion_log(spark: SparkSession, d: str) -> DataFrame:
    st, layer = F.col("o_orderstatus"), F.col("o_custkey") % 4
    return table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("data_type"), F.to_date("o_orderdate").alias("date"), F.when(st == "F", "failed").when(st == "O", "success").otherwise("skipped").alias("status"),
        F.when(layer == 0, "landing").when(layer == 1, "bronze").when(layer == 2, "silver").otherwise("gold").alias("layer"),
        (F.col("o_orderkey") % 1000).alias("records"), (F.col("o_totalprice") / 10000).alias("file_size_mb"), F.col("o_orderkey").alias("seq"),
    )


def ipos(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("ticker"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).alias("listing_date"),
        F.col("c_acctbal").alias("issue_price"), F.col("c_mktsegment").alias("ipo_status"),
    )


def ticker_changes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        F.concat(F.lit("S"), k.cast("string")).alias("ticker"), F.date_add(F.lit("2021-01-01").cast("date"), (k % 1000).cast("int")).alias("date"),
        k.cast("string").alias("id"), F.when(k % 2 == 0, F.concat(F.lit("N"), k.cast("string"))).alias("new_ticker"),
    )


def news(spark: SparkSession, d: str) -> DataFrame:
    """Events as articles about two symbols; some lack a link or a symbol."""
    e = F.col("event_id")
    sym = lambda x: F.concat(F.lit("S"), x.cast("string"))
    return table(spark, d, "events").select(
        e.cast("string").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_utc"),
        F.array(sym(F.col("user_id")), F.when(e % 5 != 0, sym((F.col("user_id") + 1) % 150))).alias("tickers"), F.when(e % 3 != 0, F.concat(F.lit("amp/"), e.cast("string"))).alias("amp_url"),
    )


#: The same views in SQL. A view may use those before it.
SQL = {
    "ticks": """SELECT event_id, CONCAT('S', CAST(user_id AS VARCHAR)) AS symbol, ts, CAST(ts AS DATE) AS date, value AS price,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS volume, event_type FROM events""",
    "bars_daily": """SELECT symbol, date, arg_min(price, row(ts, event_id)) AS open, MAX(price) AS high, MIN(price) AS low, arg_max(price, row(ts, event_id)) AS close,
       CAST(SUM(volume) AS BIGINT) AS volume, COUNT(*) AS transactions FROM ticks GROUP BY symbol, date""",
    "bars_long": """SELECT CONCAT('C', CAST(c_nationkey AS VARCHAR)) AS symbol, CAST(o_orderdate AS DATE) AS date, MIN_BY(o_totalprice, o_orderkey) AS open, MAX(o_totalprice) AS high,
       MIN(o_totalprice) AS low, MAX_BY(o_totalprice, o_orderkey) AS close, CAST(SUM(o_orderkey % 1000) AS BIGINT) AS volume, COUNT(*) AS transactions
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, CAST(o_orderdate AS DATE)""",
    "bars_minute": """SELECT symbol, time_bucket(INTERVAL 1 MINUTE, ts) AS timestamp, arg_min(price, row(ts, event_id)) AS open, MAX(price) AS high, MIN(price) AS low, arg_max(price, row(ts, event_id)) AS close,
       CAST(SUM(volume) AS BIGINT) AS volume, COUNT(*) AS transactions FROM ticks GROUP BY symbol, time_bucket(INTERVAL 1 MINUTE, ts)""",
    "option_bars": """SELECT CONCAT('O:', upper(substr(p_type, 1, 4)), lpad(CAST(year(l_shipdate) % 100 AS VARCHAR), 2, '0'), lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0'), lpad(CAST(day(l_shipdate) AS VARCHAR), 2, '0'),
       CASE WHEN l_returnflag = 'R' THEN 'P' ELSE 'C' END, lpad(CAST(CAST(ROUND(p_retailprice * 1000) AS BIGINT) AS VARCHAR), 8, '0')) AS ticker,
       CAST(o_orderdate AS DATE) AS date, l_orderkey, l_linenumber, l_extendedprice / 1000 AS close, CAST(l_quantity AS BIGINT) AS volume
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "underlying_bars": """SELECT upper(substr(p_type, 1, 4)) AS symbol, CAST(o_orderdate AS DATE) AS date, MAX(p_retailprice) AS close
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "option_daily": """SELECT ticker, date, arg_min(close, row(l_orderkey, l_linenumber)) AS open, max(close) AS high, min(close) AS low, arg_max(close, row(l_orderkey, l_linenumber)) AS close,
       CAST(sum(volume) AS BIGINT) AS volume, count(*) AS transactions FROM option_bars GROUP BY ticker, date""",
    "option_parsed": r"""SELECT *, CASE WHEN ok THEN regexp_extract(ticker, '^O:([A-Z]+)', 1) END AS underlying, CASE WHEN ok THEN e END AS expiration_date,
       CASE WHEN ok THEN regexp_extract(ticker, '([CP])[0-9]{8}$', 1) END AS contract_type, CASE WHEN ok THEN CAST(right(ticker, 8) AS DOUBLE) / 1000 END AS strike_price
FROM (SELECT *, CAST(try_strptime('20' || regexp_extract(ticker, '([0-9]{6})[CP][0-9]{8}$', 1), '%Y%m%d') AS DATE) AS e,
             regexp_full_match(ticker, 'O:[A-Z]+[0-9]{6}[CP][0-9]{8}') AND try_strptime('20' || regexp_extract(ticker, '([0-9]{6})[CP][0-9]{8}$', 1), '%Y%m%d') IS NOT NULL AS ok FROM option_daily)""",
    "balance_sheets": """SELECT *, 'quarterly' AS timeframe, make_date(fiscal_year, CAST(substr(fiscal_period, 2, 1) AS INT) * 3 - 2, 1) AS filing_date FROM (
SELECT CONCAT('C', CAST(c_nationkey AS VARCHAR)) AS ticker, CAST(year(o_orderdate) AS INT) AS fiscal_year, CONCAT('Q', CAST(quarter(o_orderdate) AS VARCHAR)) AS fiscal_period,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS assets, CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS current_assets,
       CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS current_liabilities, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS equity
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)""",
    "income_statements": """SELECT *, 'quarterly' AS timeframe, make_date(fiscal_year, CAST(substr(fiscal_period, 2, 1) AS INT) * 3 - 2, 1) AS filing_date FROM (
SELECT CONCAT('C', CAST(c_nationkey AS VARCHAR)) AS ticker, CAST(year(l_shipdate) AS INT) AS fiscal_year, CONCAT('Q', CAST(quarter(l_shipdate) AS VARCHAR)) AS fiscal_period,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenues, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS cost_of_revenue,
       CAST(SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS net_income_loss
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE c_nationkey <> 3 GROUP BY 1, 2, 3)""",
    "cash_flow": """SELECT *, 'quarterly' AS timeframe, make_date(fiscal_year, CAST(substr(fiscal_period, 2, 1) AS INT) * 3 - 2, 1) AS filing_date FROM (
SELECT CONCAT('C', CAST(s_nationkey AS VARCHAR)) AS ticker, CAST(year(l_shipdate) AS INT) AS fiscal_year, CONCAT('Q', CAST(quarter(l_shipdate) AS VARCHAR)) AS fiscal_period,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS net_cash_flow_from_operating_activities FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3)""",
    "dividends": """SELECT CONCAT('S', CAST(o_custkey % 150 AS VARCHAR)) AS ticker, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS ex_dividend_date, o_totalprice / 100000 AS cash_amount,
       CASE o_orderkey % 6 WHEN 0 THEN 12 WHEN 1 THEN 4 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 0 END AS frequency FROM orders WHERE o_orderstatus = 'F'""",
    "div_events": """SELECT ticker, 'dividend' AS event_type, ex_dividend_date AS event_date, id, cash_amount AS div_cash_amount, frequency AS div_frequency,
       CASE WHEN frequency IN (12, 4, 2, 1) THEN cash_amount * frequency END AS div_annualized_amount, frequency = 0 AS div_is_special, CAST(quarter(ex_dividend_date) AS INT) AS div_quarter FROM dividends""",
    "splits": """SELECT CONCAT('S', CAST(l_partkey % 150 AS VARCHAR)) AS ticker, CONCAT(CAST(l_orderkey AS VARCHAR), '_', CAST(l_linenumber AS VARCHAR), '_', CAST(l_partkey AS VARCHAR)) AS id, CAST(l_shipdate AS DATE) AS execution_date,
       CAST(1 + l_partkey % 4 AS DOUBLE) AS split_from, CAST(1 + l_suppkey % 4 AS DOUBLE) AS split_to FROM lineitem WHERE l_returnflag = 'R'""",
    "split_events": """SELECT ticker, 'split' AS event_type, execution_date AS event_date, id, split_from, split_to, split_to / split_from AS split_ratio, split_to / split_from < 1 AS split_is_reverse FROM splits""",
    "actions_2024": """SELECT CONCAT('S', CAST(o_custkey % 150 AS VARCHAR)) AS ticker, CAST(o_orderkey AS VARCHAR) AS id, make_date(2024, 1, CAST(1 + o_orderkey % 30 AS INT)) AS event_date,
       CAST(20 + o_orderkey % 4 AS DOUBLE) AS split_from, CAST(20 + o_custkey % 4 AS DOUBLE) AS split_to, o_totalprice / 100000 AS cash_amount FROM orders WHERE o_orderstatus = 'P'""",
    "tickers": """SELECT CONCAT('S', CAST(p_partkey AS VARCHAR)) AS ticker, p_type AS sector, p_brand AS sic_code, p_partkey % 10 <> 0 AS active, CASE WHEN p_partkey % 7 = 0 THEN 'ca' ELSE 'us' END AS locale,
       CASE p_partkey % 4 WHEN 0 THEN 'ETF' WHEN 1 THEN 'WARRANT' ELSE 'CS' END AS type, CASE WHEN p_partkey % 11 <> 0 THEN power(10, 6 + p_partkey % 6) * p_size END AS market_cap FROM part""",
    "relationships": "SELECT CONCAT('S', CAST(l_partkey AS VARCHAR)) AS source_ticker, CONCAT('S', CAST(l_suppkey AS VARCHAR)) AS ticker FROM lineitem",
    "ingestion_log": """SELECT o_orderpriority AS data_type, CAST(o_orderdate AS DATE) AS date, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'success' ELSE 'skipped' END AS status,
       CASE o_custkey % 4 WHEN 0 THEN 'landing' WHEN 1 THEN 'bronze' WHEN 2 THEN 'silver' ELSE 'gold' END AS layer, o_orderkey % 1000 AS records, o_totalprice / 10000 AS file_size_mb, o_orderkey AS seq FROM orders""",
    "ipos": """SELECT CONCAT('S', CAST(c_custkey AS VARCHAR)) AS ticker, DATE '2020-01-01' + CAST(c_custkey % 1000 AS INT) AS listing_date, c_acctbal AS issue_price, c_mktsegment AS ipo_status FROM customer""",
    "ticker_changes": """SELECT CONCAT('S', CAST(s_suppkey AS VARCHAR)) AS ticker, DATE '2021-01-01' + CAST(s_suppkey % 1000 AS INT) AS date, CAST(s_suppkey AS VARCHAR) AS id,
       CASE WHEN s_suppkey % 2 = 0 THEN CONCAT('N', CAST(s_suppkey AS VARCHAR)) END AS new_ticker FROM supplier""",
    "news": """SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_utc, amp AS amp_url, unnest([a, b]) AS ticker, ts FROM (
SELECT event_id, ts, CONCAT('S', CAST(user_id AS VARCHAR)) AS a, CASE WHEN event_id % 5 <> 0 THEN CONCAT('S', CAST((user_id + 1) % 150 AS VARCHAR)) END AS b, CASE WHEN event_id % 3 <> 0 THEN CONCAT('amp/', CAST(event_id AS VARCHAR)) END AS amp FROM events)""",
}
