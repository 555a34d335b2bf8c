"""More registered queries: joins, summaries, options, statements, actions, calendars, quality and panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeworks.operators import actions as C
from tapeworks.operators import bars as B
from tapeworks.operators import fundamentals as FU
from tapeworks.operators import incremental
from tapeworks.operators import joins as J
from tapeworks.operators import options as O
from tapeworks.operators import quality as DQ
from tapeworks.operators import sketches
from tapeworks.operators import summaries as A
from tapeworks.plans import views as V
from tapeworks.plans.catalog import query
from tapeworks.plans.queries import DAILY, FEATURES, OHLC, RANGE, STATEMENTS, W, _features, _ratio_sql, _ratios, _statements, daily_sql
from tapeworks.sources import layouts, sinks, upserts
from tapeworks.sources.scratch import folder

PERIOD = ["ticker", "fiscal_year", "fiscal_period"]

# ---------------------------------------------------------------- joins


@query("statements_join", "J-1 J-2", """SELECT ticker, fiscal_year, fiscal_period, timeframe, assets, equity, revenues, net_income_loss, net_cash_flow_from_operating_activities AS ocf, b.filing_date,
  i.filing_date AS filing_date_is, c.filing_date AS filing_date_cf
  FROM balance_sheets b JOIN income_statements i USING (ticker, fiscal_year, fiscal_period, timeframe)
  LEFT JOIN cash_flow c USING (ticker, fiscal_year, fiscal_period, timeframe)""",
    ["assets", "equity", "revenues", "net_income_loss", "ocf"], [*PERIOD, "timeframe", "filing_date", "filing_date_is", "filing_date_cf"])
def _(s, d):
    out = FU.statements(V.balance_sheets(s, d), V.income_statements(s, d), V.cash_flow(s, d))
    return out.select(*PERIOD, "timeframe", "assets", "equity", "revenues", "net_income_loss", F.col("net_cash_flow_from_operating_activities").alias("ocf"), "filing_date", "filing_date_is", "filing_date_cf")


MARKET = "(SELECT ticker, fiscal_year, fiscal_period, assets / 1000 AS price, equity / 100 AS shares FROM balance_sheets WHERE fiscal_period <> 'Q3') m"


@query("valuation", "J-3 F-11", f"""SELECT ticker, fiscal_year, fiscal_period, price, shares, price * shares AS market_cap, price * shares / nullif(net_income_loss, 0) AS pe_ratio, price * shares / nullif(equity,
  0) AS pb_ratio, price * shares / nullif(revenues, 0) AS ps_ratio, price * shares / nullif(operating_income_loss, 0) AS ev_ebitda_simple
  FROM {STATEMENTS} LEFT JOIN {MARKET} USING (ticker, fiscal_year, fiscal_period)""",
    {"price": 6, "shares": 6, "market_cap": 1, "pe_ratio": 3, "pb_ratio": 3, "ps_ratio": 3, "ev_ebitda_simple": 3}, PERIOD)
def _(s, d):
    m = V.balance_sheets(s, d).filter("fiscal_period <> 'Q3'").select(*PERIOD, (F.col("assets") / 1000).alias("price"), (F.col("equity") / 100).alias("shares"))
    return FU.valuation(FU.statements(*_statements(s, d)), m).select(*PERIOD, "price", "shares", "market_cap", "pe_ratio", "pb_ratio", "ps_ratio", "ev_ebitda_simple")


WIDE_KEYS = "ticker, filing_date, fiscal_year, fiscal_period"
WIDE = f"""(SELECT {WIDE_KEYS}, assets AS bs_assets, equity AS bs_equity, current_assets AS bs_current_assets, current_liabilities AS bs_current_liabilities, assets - equity AS bs_liabilities,
  revenues AS is_revenues, net_income_loss AS is_net_income_loss, net_income_loss / 2 AS is_operating_income_loss, net_cash_flow_from_operating_activities AS cf_net_cash_flow_from_operating_activities
FROM (SELECT * EXCLUDE (timeframe) FROM balance_sheets) b FULL JOIN (SELECT * EXCLUDE (timeframe) FROM income_statements) i USING ({WIDE_KEYS}) FULL JOIN (SELECT * EXCLUDE (timeframe) FROM cash_flow) c USING ({WIDE_KEYS})) w"""
WIDE_COLS = ["bs_assets", "bs_equity", "bs_current_assets", "bs_current_liabilities", "bs_liabilities", "is_revenues", "is_net_income_loss", "is_operating_income_loss", "cf_net_cash_flow_from_operating_activities"]


def _wide(s, d):
    b = V.balance_sheets(s, d).drop("timeframe").withColumn("liabilities", F.col("assets") - F.col("equity"))
    i = V.income_statements(s, d).drop("timeframe").withColumn("operating_income_loss", F.col("net_income_loss") / 2)
    return FU.wide(b, i, V.cash_flow(s, d).drop("timeframe"))


@query("fundamentals_wide", "J-4 F-4 F-5 F-18 F-19", f"SELECT {WIDE_KEYS}, fiscal_period AS fiscal_quarter, CAST(year(filing_date) AS INT) AS year, CAST(month(filing_date) AS INT) AS month, {', '.join(WIDE_COLS)} FROM {WIDE}", WIDE_COLS, ["ticker", "filing_date", "fiscal_year", "fiscal_period", "fiscal_quarter", "year", "month"])
def _(s, d):
    return FU.filing_partition(FU.with_quarter(_wide(s, d))).select("ticker", "filing_date", "fiscal_year", "fiscal_period", "fiscal_quarter", "year", "month", *WIDE_COLS)


TW = "(PARTITION BY ticker ORDER BY filing_date)"


def _lag(x: str, k: int) -> str:
    return f"lag({x}, {k}) OVER {TW}"


def _grown(x: str, k: int) -> str:
    return f"({x} - {_lag(x, k)}) / nullif({_lag(x, k)}, 0)"


WIDE_RATIOS = {
    "ratio_roe": "is_net_income_loss / nullif(bs_equity, 0)", "ratio_roa": "is_net_income_loss / nullif(bs_assets, 0)", "ratio_profit_margin": "is_net_income_loss / nullif(is_revenues, 0)", "ratio_operating_margin": "is_operating_income_loss / nullif(is_revenues, 0)",
    "ratio_current": "bs_current_assets / nullif(bs_current_liabilities, 0)", "ratio_quick": "bs_current_assets / nullif(bs_current_liabilities, 0)", "ratio_liabilities_to_equity": "bs_liabilities / nullif(bs_equity, 0)", "ratio_liabilities_to_assets": "bs_liabilities / nullif(bs_assets, 0)",
}
GROWTHS = {"growth_revenue_yoy": _grown("is_revenues", 4), "growth_revenue_qoq": _grown("is_revenues", 1), "growth_net_income_yoy": _grown("is_net_income_loss", 4), "growth_assets_yoy": _grown("bs_assets", 4)}


@query("fundamentals_quality", "F-14 F-15 F-16 F-17", f"""
WITH r AS (SELECT *, {', '.join(f'{x} AS {n}' for n, x in WIDE_RATIOS.items())} FROM {WIDE})
SELECT ticker, filing_date, {', '.join(WIDE_RATIOS)}, {', '.join(f'{x} AS {n}' for n, x in GROWTHS.items())},
  coalesce(CAST(is_net_income_loss > 0 AS INT), 0) + coalesce(CAST(cf_net_cash_flow_from_operating_activities > 0 AS INT), 0) + coalesce(CAST(ratio_roa > {_lag('ratio_roa', 1)} AS INT), 0) + coalesce(CAST(ratio_liabilities_to_assets < {_lag('ratio_liabilities_to_assets', 1)} AS INT), 0) + coalesce(CAST(ratio_current > {_lag('ratio_current', 1)} AS INT), 0) AS piotroski_score,
  is_revenues IS NOT NULL AND is_net_income_loss IS NOT NULL AND bs_assets IS NOT NULL AND bs_equity IS NOT NULL AND cf_net_cash_flow_from_operating_activities IS NOT NULL AS has_complete_data FROM r""",
    [*WIDE_RATIOS, *GROWTHS], ["ticker", "filing_date", "piotroski_score", "has_complete_data"])
def _(s, d):
    return FU.wide_quality(_wide(s, d)).select("ticker", "filing_date", *WIDE_RATIOS, *GROWTHS, "piotroski_score", "has_complete_data")


PW = "(PARTITION BY ticker ORDER BY fiscal_year, fiscal_period)"


@query("growth", "F-13", f"""SELECT ticker, fiscal_year, fiscal_period, (revenues - lag(revenues) OVER {PW}) / nullif(lag(revenues) OVER {PW}, 0) * 100 AS revenue_growth, (net_income_loss - lag(net_income_loss) OVER {PW}) / nullif(abs(lag(net_income_loss) OVER {PW}),
  0) * 100 AS net_income_growth, (assets - lag(assets) OVER {PW}) / nullif(lag(assets) OVER {PW}, 0) * 100 AS assets_growth, (equity - lag(equity) OVER {PW}) / nullif(lag(equity) OVER {PW},
  0) * 100 AS equity_growth FROM {STATEMENTS}""",
    dict.fromkeys(["revenue_growth", "net_income_growth", "assets_growth", "equity_growth"], 4), PERIOD)
def _(s, d):
    return FU.growth(FU.statements(*_statements(s, d))).select(*PERIOD, "revenue_growth", "net_income_growth", "assets_growth", "equity_growth")


@query("reference_enrichment", "J-5", """SELECT ticker, id, sector, type, coalesce(n_related, NULL) AS n_related
  FROM dividends LEFT JOIN tickers USING (ticker) LEFT JOIN (SELECT source_ticker AS ticker, count(*) AS n_related
  FROM (SELECT DISTINCT source_ticker, ticker FROM relationships)
  GROUP BY 1) r USING (ticker)""")
def _(s, d):
    return C.enriched(V.dividends(s, d), V.tickers(s, d), V.relationships(s, d)).select("ticker", "id", "sector", "type", "n_related")


@query("calendar_alignment", "J-6", "SELECT symbol, date, close, volume FROM (SELECT DISTINCT symbol FROM bars_daily) s CROSS JOIN (SELECT DISTINCT date FROM bars_daily) c LEFT JOIN bars_daily USING (symbol, date)", ["close"], ["symbol", "date", "volume"])
def _(s, d):
    b = V.bars_daily(s, d)
    return J.on_calendar(b, b.select("date").distinct(), ["close", "volume"])


DAYS = "(SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '1995-12-31', INTERVAL 1 DAY)) AS DATE) AS date) e"


@query("missing_dates", "J-7 IN-1", f"""
SELECT symbol, date FROM (SELECT DISTINCT symbol FROM bars_long) s CROSS JOIN {DAYS} WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM bars_long)""")
def _(s, d):
    """Days of a year without a bar, for every symbol."""
    b = V.bars_long(s, d)
    year = F.explode(F.sequence(F.lit("1995-01-01").cast("date"), F.lit("1995-12-31").cast("date"))).alias("date")
    return J.missing(b.select("symbol").distinct().select("symbol", year), b, ["symbol", "date"])


#: Two layers of the same bars: those that didn't fall, and those of more than one trade.
LAYER_A, LAYER_B = "close >= open", "transactions > 1"


@query("layer_difference", "J-8 U-4", f"""
WITH a AS (SELECT DISTINCT date FROM bars_long WHERE {LAYER_A}), b AS (SELECT DISTINCT date FROM bars_long WHERE {LAYER_B})
SELECT date, 'a' AS only_in FROM a WHERE date NOT IN (SELECT date FROM b) UNION ALL SELECT date, 'b' FROM b WHERE date NOT IN (SELECT date FROM a)""")
def _(s, d):
    b = V.bars_long(s, d)
    return J.layer_difference(b.filter(LAYER_A), b.filter(LAYER_B))


@query("trading_days_only", "J-9 IN-2", "SELECT symbol, date, volume FROM bars_daily WHERE isodow(date) <= 5 AND date <> DATE '2024-01-15'")
def _(s, d):
    holidays = s.range(1).select(F.lit("2024-01-15").cast("date").alias("date"))
    return J.trading_only(V.bars_daily(s, d), DQ.trading_days(DQ.dates(s, "2023-12-01", "2024-03-01"), holidays)).select("symbol", "date", "volume")


COUNT = "(SELECT symbol, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, count(*) AS {n} FROM bars_long WHERE {w} GROUP BY ALL)"


@query("layer_coverage", "J-10", f"""SELECT symbol, year, month, coalesce(bronze_rows, 0) AS bronze_rows, coalesce(silver_rows, 0) AS silver_rows, coalesce(silver_rows, 0) / nullif(coalesce(bronze_rows,
  0), 0) AS coverage FROM {COUNT.format(n='bronze_rows', w='true')} b
  FULL JOIN {COUNT.format(n='silver_rows', w='transactions > 1')} s USING (symbol, year, month)""", ["coverage"], ["symbol", "year", "month", "bronze_rows", "silver_rows"])
def _(s, d):
    b = V.bars_long(s, d)
    return J.layer_coverage(b, b.filter("transactions > 1"))


@query("as_of_fundamentals", "J-12", "SELECT b.symbol, b.date, b.close, f.filing_date, f.assets FROM bars_long b ASOF LEFT JOIN balance_sheets f ON b.symbol = f.ticker AND b.date >= f.filing_date", ["close", "assets"], ["symbol", "date", "filing_date"])
def _(s, d):
    b = V.balance_sheets(s, d).withColumnRenamed("ticker", "symbol")
    return J.as_of(V.bars_long(s, d).select("symbol", "date", "close"), b, "symbol", "date", "filing_date", ["assets"])


#: Lifts values a hair, so that the engines' sums of logarithms, which differ in their last bits, don't round ties apart.
HAIR = 1 + 1e-12


@query("split_adjusted", "J-13", f"""
WITH f AS (SELECT symbol, date, close, exp(coalesce((SELECT sum(ln(split_to / split_from)) FROM actions_2024 a WHERE a.ticker = b.symbol AND a.event_date > b.date), 0)) AS split_factor FROM bars_daily b)
SELECT symbol, date, close, split_factor * {HAIR} AS split_factor, close / split_factor * {HAIR} AS adjusted_close FROM f""",
    {"close": 6, "split_factor": 5, "adjusted_close": 5}, ["symbol", "date"])
def _(s, d):
    e = V.actions_2024(s, d).withColumn("split_ratio", F.col("split_to") / F.col("split_from"))
    out = C.split_adjusted(V.bars_daily(s, d), e)
    return out.select("symbol", "date", "close", *((F.col(c) * HAIR).alias(c) for c in ("split_factor", "adjusted_close")))


@query("dividend_yield", "J-14", """
WITH l AS (SELECT ticker, div_annualized_amount, row_number() OVER (PARTITION BY ticker ORDER BY event_date DESC, id DESC) AS k FROM div_events WHERE div_annualized_amount IS NOT NULL), p AS (SELECT symbol AS ticker, max_by(close, date) AS close FROM bars_daily GROUP BY symbol)
SELECT ticker, div_annualized_amount, close, div_annualized_amount / nullif(close, 0) AS dividend_yield FROM l JOIN p USING (ticker) WHERE k = 1""", {"div_annualized_amount": 8, "close": 6, "dividend_yield": 6}, ["ticker"])
def _(s, d):
    return C.dividend_yield(C.dividends(V.dividends(s, d)), V.bars_daily(s, d))


@query("universe_coverage", "J-15", """SELECT count(*) AS tickers, count(*) FILTER (f AND r) AS complete, count(*) FILTER (NOT f) AS no_fundamentals, count(*) FILTER (NOT r) AS no_ratios, count(*) FILTER (f AND r) / nullif(count(*),
  0) * 100 AS complete_pct FROM (SELECT ticker, ticker IN (SELECT ticker
  FROM income_statements) AS f, ticker IN (SELECT ticker FROM cash_flow) AS r
  FROM (SELECT DISTINCT ticker FROM balance_sheets))""", ["complete_pct"], ["tickers", "complete", "no_fundamentals", "no_ratios"])
def _(s, d):
    return J.universe_coverage(V.balance_sheets(s, d), V.income_statements(s, d), V.cash_flow(s, d))


# ---------------------------------------------------------------- summaries


@query("monthly_market", "A-3", """SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, count(DISTINCT symbol) AS symbols, avg(volume) AS avg_volume, CAST(sum(volume) AS BIGINT) AS total_volume
  FROM bars_long GROUP BY ALL""", ["avg_volume"], ["year", "month", "symbols", "total_volume"])
def _(s, d):
    return A.monthly_market(V.bars_long(s, d))


@query("monthly_market_sketched", "A-3 A-4 Q-19 DQ-10", """SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, count(*) AS rows, count(DISTINCT symbol) AS symbols, true AS within_error,
  min(date) AS first_date, max(date) AS last_date, avg(volume) AS avg_volume, CAST(sum(volume) AS BIGINT) AS total_volume FROM bars_daily GROUP BY ALL""",
    ["avg_volume"], ["year", "month", "rows", "symbols", "within_error", "first_date", "last_date", "total_volume"])
def _(s, d):
    """Months merged from stored day sketches, which were made in two runs; beside the exact counts of symbols, whether the estimates keep their error."""
    path, at, month = folder(s, "bars"), folder(s, "sketches"), [F.year("day").alias("year"), F.month("day").alias("month")]
    V.bars_daily(s, d).write.parquet(path)
    b = s.read.parquet(path)
    for rows in (b.filter("date < DATE '2024-01-16'"), b):
        sketches.add_days(rows, at, "symbol", "date", ("volume",))
    found = sketches.report(sketches.stored_days(s, at), *month, sums=("volume",))
    exact = b.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(F.count_distinct("symbol").alias("symbols"))
    near = F.abs(F.col("keys") - F.col("symbols")) <= F.col("keys_error")
    return found.join(exact, ["year", "month"]).select("year", "month", "rows", "symbols", near.alias("within_error"), "first_date", "last_date", "avg_volume", F.col("total_volume").cast("long"))


@query("table_report", "A-4 F-1", "SELECT count(*) AS rows, count(DISTINCT a) AS keys, min(day) AS first_date, max(day) AS last_date FROM (SELECT CONCAT('S', CAST(user_id AS VARCHAR)) AS a, strftime(ts, '%Y-%m-%d') AS day FROM events)")
def _(s, d):
    return A.table_report(FU.first_ticker(V.news(s, d)).withColumn("day", F.substring("published_utc", 1, 10)), "ticker", "day")


@query("reference_coverage", "A-5", "SELECT count(DISTINCT ticker) AS tickers, count(DISTINCT type) AS types, (SELECT count(*) FROM (SELECT DISTINCT source_ticker, ticker FROM relationships)) AS relationships FROM tickers")
def _(s, d):
    return C.reference_coverage(V.tickers(s, d), V.relationships(s, d))


EVENTS = """(SELECT ticker, event_type, event_date, id FROM div_events UNION ALL SELECT ticker, event_type, event_date, id
  FROM split_events UNION ALL SELECT ticker, 'ipo', listing_date, ticker || '_' || CAST(listing_date AS VARCHAR)
  FROM ipos UNION ALL SELECT ticker, 'ticker_change', date, id FROM ticker_changes) ev"""


def _actions(s, d):
    return C.all_actions(C.dividends(V.dividends(s, d)), C.splits(V.splits(s, d)), C.ipos(V.ipos(s, d)), C.ticker_changes(V.ticker_changes(s, d)))


@query("action_counts", "A-6", f"SELECT event_type, count(*) AS rows FROM {EVENTS} GROUP BY 1")
def _(s, d):
    return A.counts_by(_actions(s, d), "event_type")


@query("action_timeline", "A-7", f"SELECT event_type, count(*) AS events, min(event_date) AS first_date, max(event_date) AS last_date FROM {EVENTS} GROUP BY 1")
def _(s, d):
    return C.timeline(_actions(s, d))


@query("trailing_dividends", "A-8", "SELECT ticker, sum(div_cash_amount) AS trailing_amount, count(*) AS payments FROM div_events WHERE event_date > DATE '1998-06-01' - 365 AND event_date <= DATE '1998-06-01' GROUP BY 1", {"trailing_amount": 8}, ["ticker", "payments"])
def _(s, d):
    return C.trailing_dividends(C.dividends(V.dividends(s, d)), "1998-06-01")


@query("split_kinds", "A-9", "SELECT count(DISTINCT ticker) FILTER (split_is_reverse) AS reverse_tickers, count(DISTINCT ticker) FILTER (NOT split_is_reverse) AS forward_tickers FROM split_events")
def _(s, d):
    return C.split_kinds(C.splits(V.splits(s, d)))


@query("relation_stats", "A-10 C-15", "SELECT source_ticker, count(*) AS n_related, string_agg(ticker, ',' ORDER BY ticker) AS related FROM (SELECT DISTINCT source_ticker, ticker FROM relationships) GROUP BY 1")
def _(s, d):
    return C.relation_stats(V.relationships(s, d))


@query("news_counts", "A-11", "SELECT ticker, substr(published_utc, 1, 10) AS day, count(*) AS articles, count(DISTINCT id) AS ids, count(amp_url) AS amp_links FROM news WHERE ticker IS NOT NULL GROUP BY 1, 2")
def _(s, d):
    return C.news_counts(C.news_rows(V.news(s, d)))


@query("log_summary", "A-12", """SELECT data_type, layer, count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped,
  CAST(sum(records) AS BIGINT) AS records, sum(file_size_mb) AS size_mb, count(*) FILTER (status IN ('success', 'skipped')) / count(*) AS success_rate
  FROM ingestion_log GROUP BY 1, 2""", {"size_mb": 3, "success_rate": 6}, ["data_type", "layer", "total", "success", "failed", "skipped", "records"])
def _(s, d):
    return A.log_summary(V.ingestion_log(s, d), "data_type", "layer")


@query("watermarks", "A-13", "SELECT data_type, layer, max(date) AS watermark FROM ingestion_log WHERE status = 'success' GROUP BY 1, 2")
def _(s, d):
    return A.watermarks(V.ingestion_log(s, d), "data_type", "layer")


STATS = ["open", "close", "daily_return", "price_range"]


@query("factor_statistics", "A-14", " UNION ALL ".join(f"""SELECT '{c}' AS feature, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c},
  0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max
  FROM {FEATURES} f""" for c in STATS), {c: 4 for c in ("mean", "std", "min", "q25", "q50", "q75", "max")}, ["feature", "count"])
def _(s, d):
    return A.describe(_features(s, d), STATS)


@query("feature_correlations", "A-15", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM {FEATURES} f" for i, a in enumerate(STATS) for b in STATS[i:]), ["corr"], ["a", "b"])
def _(s, d):
    return A.correlations(_features(s, d), STATS)


@query("rows_by_ticker", "A-16", "SELECT symbol, count(*) AS rows FROM bars_daily GROUP BY 1")
def _(s, d):
    return A.counts_by(V.bars_daily(s, d), "symbol")


@query("candle_counts", "A-17", "SELECT count(*) FILTER (close > open) AS bullish, count(*) FILTER (close < open) AS bearish, count(*) FILTER (close = open) AS flat FROM bars_daily")
def _(s, d):
    return A.candle_counts(V.bars_daily(s, d))


@query("feature_coverage", "A-18", f"SELECT symbol, avg(CAST(simple_return IS NOT NULL AS DOUBLE)) AS simple_return, avg(CAST(alpha IS NOT NULL AS DOUBLE)) AS alpha FROM {FEATURES} f GROUP BY 1", ["simple_return", "alpha"], ["symbol"])
def _(s, d):
    return A.coverage(_features(s, d), ["simple_return", "alpha"])


@query("iqr_outliers", "A-19", f"SELECT count(daily_return) AS n, count(*) FILTER (daily_return < q1 - 3 * (q3 - q1) OR daily_return > q3 + 3 * (q3 - q1)) AS outliers FROM {FEATURES} f, (SELECT quantile_cont(daily_return, 0.25) AS q1, quantile_cont(daily_return, 0.75) AS q3 FROM {FEATURES} f) q")
def _(s, d):
    return A.outliers(_features(s, d), "daily_return")


@query("fiscal_periods", "A-20", "SELECT DISTINCT fiscal_year, fiscal_period FROM balance_sheets")
def _(s, d):
    return A.distinct_periods(V.balance_sheets(s, d))


@query("put_call_ratio", "A-21", """SELECT underlying, date, CAST(sum(volume) FILTER (contract_type = 'P') AS BIGINT) AS put_volume, CAST(sum(volume) FILTER (contract_type = 'C') AS BIGINT) AS call_volume,
  sum(volume) FILTER (contract_type = 'P') / nullif(sum(volume) FILTER (contract_type = 'C'), 0) AS put_call_ratio
  FROM option_parsed WHERE underlying IS NOT NULL GROUP BY 1, 2""", ["put_call_ratio"], ["underlying", "date", "put_volume", "call_volume"])
def _(s, d):
    return O.put_call_ratio(O.with_parsed(V.option_daily(s, d)))


@query("benchmark_return", "A-22", f"SELECT date, avg(simple_return) AS benchmark_return, count(simple_return) AS n FROM {FEATURES} f GROUP BY 1", ["benchmark_return"], ["date", "n"])
def _(s, d):
    return A.benchmark_return(V.bars_daily(s, d))


IC = f"""(SELECT date, CASE WHEN max(a) > min(a) AND max(b) > min(b) THEN corr(a, b) END AS ic
  FROM (SELECT date, CASE WHEN nxt IS NOT NULL THEN price_range END AS a, CASE WHEN price_range IS NOT NULL THEN nxt END AS b
  FROM (SELECT *, lead(close) OVER {W} / nullif(close, 0) - 1 AS nxt
  FROM {FEATURES} f)) GROUP BY 1) ics"""


@query("information_coefficient", "A-23", f"SELECT date, ic FROM {IC}", ["ic"], ["date"])
def _(s, d):
    return A.information_coefficient(_features(s, d), "price_range")


@query("information_ratio", "A-23", f"SELECT avg(ic) AS mean_ic, stddev_samp(ic) AS std_ic, avg(ic) / nullif(stddev_samp(ic), 0) AS ir FROM {IC}", ["mean_ic", "std_ic", "ir"], [])
def _(s, d):
    return A.information_ratio(A.information_coefficient(_features(s, d), "price_range"))


@query("return_summary", "A-24", f"SELECT symbol, avg(simple_return) AS mean, stddev_samp(simple_return) AS std, avg(simple_return) / nullif(stddev_samp(simple_return), 0) * sqrt(252) AS sharpe FROM {FEATURES} f GROUP BY 1", ["mean", "std", "sharpe"], ["symbol"])
def _(s, d):
    return A.return_summary(_features(s, d), "simple_return", "symbol")


@query("column_presence", "A-25", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS present, count({c}) / count(*) AS share, count({c}) / count(*) > 0.5 AS common FROM balance_sheets" for c in ("assets", "current_assets", "current_liabilities", "equity")), ["share"], ['"column"', "present", "common"])
def _(s, d):
    return A.column_presence(V.balance_sheets(s, d), ["assets", "current_assets", "current_liabilities", "equity"])


@query("return_pivot", "A-26", f"""SELECT date, max(simple_return) FILTER (symbol = 'S1') AS \"S1\", max(simple_return) FILTER (symbol = 'S2') AS \"S2\", max(simple_return) FILTER (symbol = 'S3') AS \"S3\"
  FROM {FEATURES} f WHERE symbol IN ('S1', 'S2', 'S3') GROUP BY 1""", ['"S1"', '"S2"', '"S3"'], ["date"])
def _(s, d):
    return A.return_pivot(V.bars_daily(s, d), ["S1", "S2", "S3"])


@query("symbol_correlations", "A-26", f"""
WITH r AS (SELECT symbol, date, close / nullif(lag(close) OVER {W}, 0) - 1 AS r FROM bars_long)
SELECT x.symbol AS a, y.symbol AS b, corr(x.r, y.r) AS corr, count(*) AS days FROM r x JOIN r y USING (date) WHERE x.symbol < y.symbol GROUP BY 1, 2""", ["corr"], ["a", "b", "days"])
def _(s, d):
    return A.symbol_correlations(V.bars_long(s, d))


@query("averages", "A-27", "SELECT symbol, avg(close) AS avg_close, avg(volume) AS avg_volume, stddev_samp(close) AS std_close FROM bars_daily GROUP BY 1", ["avg_close", "avg_volume", "std_close"], ["symbol"])
def _(s, d):
    return A.averages(V.bars_daily(s, d), ["close", "volume"], "symbol", deviation="close")


# ---------------------------------------------------------------- options


@query("option_parse", "O-1 O-2 O-3 O-6 O-8 O-10", """SELECT ticker, date, underlying, expiration_date, contract_type, strike_price, ok AS valid, strike_price / nullif(close, 0) AS moneyness, CAST(expiration_date - date AS INT) AS days_to_expiry,
  CASE contract_type WHEN 'C' THEN 'call' WHEN 'P' THEN 'put' END AS contract_word
  FROM option_parsed""", ["strike_price", "moneyness"], ["ticker", "date", "underlying", "expiration_date", "contract_type", "valid", "days_to_expiry", "contract_word"])
def _(s, d):
    o = O.with_parsed(V.option_daily(s, d))
    return o.select("ticker", "date", *O.FIELDS, O.is_valid().alias("valid"), O.moneyness().alias("moneyness"), O.days_to_expiry().alias("days_to_expiry"), O.contract_word().alias("contract_word"))


@query("option_contracts", "O-4", "SELECT DISTINCT ticker, underlying, expiration_date, contract_type, strike_price FROM option_parsed WHERE underlying IS NOT NULL", ["strike_price"], ["ticker", "underlying", "expiration_date", "contract_type"])
def _(s, d):
    return O.contracts(V.option_bars(s, d))


@query("option_underlying", "O-7 J-11", """SELECT o.ticker, o.date, o.strike_price, u.close AS underlying_price, o.strike_price / nullif(u.close, 0) AS moneyness_underlying
  FROM option_parsed o LEFT JOIN underlying_bars u ON o.underlying = u.symbol AND o.date = u.date""", ["strike_price", "underlying_price", "moneyness_underlying"], ["ticker", "date"])
def _(s, d):
    return O.with_underlying(O.with_parsed(V.option_daily(s, d)), V.underlying_bars(s, d)).select("ticker", "date", "strike_price", "underlying_price", "moneyness_underlying")


@query("option_underlying_bucketed", "O-7 J-11", """SELECT o.ticker, o.date, o.strike_price, u.close AS underlying_price, o.strike_price / nullif(u.close, 0) AS moneyness_underlying
  FROM option_parsed o LEFT JOIN underlying_bars u ON o.underlying = u.symbol AND o.date = u.date""", ["strike_price", "underlying_price", "moneyness_underlying"], ["ticker", "date"])
def _(s, d):
    """Both sides are stored in buckets of underlying and date, and joined bucket by bucket."""
    lines, at, buckets = V.option_lines(s, d), ["underlying", "date"], int(s.conf.get("spark.sql.shuffle.partitions"))
    options = layouts.bucketed(O.with_parsed(V.option_daily(s, d, lines)).select("ticker", "strike_price", *at), at, buckets)
    prices = layouts.bucketed(V.underlying_bars(s, d, lines).withColumnRenamed("symbol", "underlying"), at, buckets)
    return O.with_underlying(options, prices.withColumnRenamed("underlying", "symbol")).select("ticker", "date", "strike_price", "underlying_price", "moneyness_underlying")


@query("option_volume_oi", "O-9", "SELECT ticker, date, volume / nullif(transactions % 3, 0) AS volume_oi_ratio FROM option_daily", ["volume_oi_ratio"], ["ticker", "date"])
def _(s, d):
    """No table has open interest: transactions modulo 3, zeros among them, stand for it."""
    return V.option_daily(s, d).withColumn("open_interest", F.col("transactions") % 3).select("ticker", "date", O.volume_oi_ratio().alias("volume_oi_ratio"))


@query("option_retention", "SNK-10", "SELECT ticker, date, expiration_date < DATE '1998-01-01' - 90 AS archived FROM option_parsed WHERE expiration_date IS NOT NULL")
def _(s, d):
    options = O.with_parsed(V.option_daily(s, d)).filter("expiration_date IS NOT NULL")
    return options.select("ticker", "date", sinks.is_expired("1998-01-01", 90).alias("archived"))


# ---------------------------------------------------------------- actions and reference


@query("dividends", "C-1 C-2 C-7", "SELECT ticker, event_type, event_date, id, div_cash_amount, CAST(div_frequency AS INT) AS div_frequency, div_annualized_amount, div_is_special, div_quarter FROM div_events", {"div_cash_amount": 8, "div_annualized_amount": 8}, ["ticker", "event_type", "event_date", "id", "div_frequency", "div_is_special", "div_quarter"])
def _(s, d):
    return C.dividends(V.dividends(s, d))


@query("splits", "C-3", "SELECT ticker, event_type, event_date, id, split_from, split_to, split_ratio, split_is_reverse FROM split_events", ["split_from", "split_to", "split_ratio"], ["ticker", "event_type", "event_date", "id", "split_is_reverse"])
def _(s, d):
    return C.splits(V.splits(s, d))


@query("ipos", "C-4", "SELECT ticker, 'ipo' AS event_type, listing_date AS event_date, ticker || '_' || CAST(listing_date AS VARCHAR) AS id, issue_price AS ipo_issue_price, ipo_status FROM ipos", ["ipo_issue_price"], ["ticker", "event_type", "event_date", "id", "ipo_status"])
def _(s, d):
    return C.ipos(V.ipos(s, d))


@query("ticker_changes", "C-5 C-11", "SELECT ticker, 'ticker_change' AS event_type, date AS event_date, id, new_ticker FROM ticker_changes")
def _(s, d):
    return C.ticker_changes(V.ticker_changes(s, d)).orderBy(F.desc("event_date"), "ticker")


@query("all_actions", "C-6 U-1 U-2", f"SELECT ticker, event_type, event_date, id, CAST(year(event_date) AS INT) AS year, CAST(month(event_date) AS INT) AS month FROM {EVENTS}")
def _(s, d):
    return _actions(s, d).select("ticker", "event_type", "event_date", "id", "year", "month")


@query("latest_dividends", "C-8", "SELECT ticker, event_date, id, div_cash_amount FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY event_date DESC, id DESC) AS k FROM div_events) WHERE k = 1", {"div_cash_amount": 8}, ["ticker", "event_date", "id"])
def _(s, d):
    return C.latest_dividends(C.dividends(V.dividends(s, d))).select("ticker", "event_date", "id", "div_cash_amount")


@query("recent_per_type", "C-9 L-2", f"SELECT ticker, event_type, event_date, id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_date DESC NULLS LAST, ticker, id) AS k FROM {EVENTS}) WHERE k <= 2")
def _(s, d):
    return C.recent_per_type(_actions(s, d)).select("ticker", "event_type", "event_date", "id")


@query("recent_splits", "C-10", "SELECT ticker, event_date, id, split_ratio FROM split_events WHERE event_date BETWEEN DATE '1993-06-01' AND DATE '1998-06-01'", ["split_ratio"], ["ticker", "event_date", "id"])
def _(s, d):
    return C.since(C.splits(V.splits(s, d)), "split", "1998-06-01", 5).select("ticker", "event_date", "id", "split_ratio")


@query("ticker_universe", "C-12 U-3 SNK-5", "SELECT ticker, type, src FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY src DESC) AS k FROM (SELECT ticker, type, 1 AS src FROM tickers UNION ALL SELECT ticker, NULL, 2 FROM ipos)) WHERE k = 1")
def _(s, d):
    a = V.tickers(s, d).select("ticker", "type", F.lit(1).alias("src"))
    return C.universe(a, V.ipos(s, d).select("ticker", F.lit(2).alias("src")), order="src").select("ticker", "type", "src")


@query("upsert", "SNK-5 U-3", "SELECT ticker, src, v FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY v DESC, src DESC) AS k FROM (SELECT ticker, 0 AS src, length(sector) AS v FROM tickers UNION ALL SELECT ticker, 1, 20 FROM ipos)) WHERE k = 1")
def _(s, d):
    a = V.tickers(s, d).select("ticker", F.lit(0).alias("src"), F.length("sector").cast("long").alias("v"))
    path = folder(s, "upserts")
    for batch in (a, V.ipos(s, d).select("ticker", F.lit(1).alias("src"), F.lit(20).cast("long").alias("v"))):
        upserts.upsert(batch, path, ["ticker"], "v", buckets=8)
    return upserts.read_upserted(s, path).select("ticker", "src", "v")


@query("market_cap_class", "C-13 C-14", "SELECT ticker, CASE WHEN market_cap >= 200e9 THEN 'mega' WHEN market_cap >= 10e9 THEN 'large' WHEN market_cap >= 2e9 THEN 'mid' WHEN market_cap >= 300e6 THEN 'small' WHEN market_cap >= 50e6 THEN 'micro' ELSE 'nano' END AS cap_class FROM tickers")
def _(s, d):
    return C.by_size(V.tickers(s, d), "sector").select("ticker", "cap_class")


@query("news_rows", "C-16", "SELECT id, ticker, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day FROM news WHERE ticker IS NOT NULL")
def _(s, d):
    return C.news_rows(V.news(s, d)).select("id", "ticker", "year", "month", "day")


# ---------------------------------------------------------------- incremental runs, quality, panels


@query("expected_dates", "IN-1 IN-2", """
SELECT date FROM (SELECT CAST(unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM bars_long) WHERE isodow(date) <= 5""")
def _(s, d):
    """Trading days of the span that the bars cover."""
    span = V.bars_long(s, d).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return DQ.trading_days(span.select(F.explode(F.sequence("a", "b")).alias("date")))


@query("unprocessed_dates", "IN-3", f"SELECT date FROM {DAYS} WHERE date NOT IN (SELECT date FROM ingestion_log WHERE data_type = '1-URGENT' AND status = 'success')")
def _(s, d):
    return DQ.unprocessed(DQ.dates(s, "1995-01-01", "1995-12-31"), V.ingestion_log(s, d), "1-URGENT")


@query("enrich_range", "IN-4", f"SELECT * FROM ({daily_sql('bars_daily')}) x WHERE {RANGE}".replace("SELECT * FROM (\n", "SELECT symbol, date, returns_1d, volume_ratio FROM (\n"), ["returns_1d", "volume_ratio"], ["symbol", "date"])
def _(s, d):
    return DQ.enrich_range(V.bars_daily(s, d), B.daily_features, "2024-01-05", "2024-01-20").select("symbol", "date", "returns_1d", "volume_ratio")


@query("enrich_new_days", "IN-4 IN-5", daily_sql("bars_daily").replace("SELECT symbol, date, open, high, low, close, volume, transactions, r1", "SELECT symbol, date, r1"), DAILY, ["symbol", "date"])
def _(s, d):
    """All bars in three runs, of which each reads its own days and the kept tails."""
    path, tails = folder(s, "bars"), folder(s, "tails")
    V.bars_daily(s, d).withColumn("run", F.when(F.col("date") < "2024-01-11", 1).when(F.col("date") < "2024-01-21", 2).otherwise(3)).write.partitionBy("run").parquet(path)
    runs = [incremental.enrich_new(s.read.parquet(path).filter(F.col("run") == k).drop("run"), B.daily_features, tails, buckets=8) for k in (1, 2, 3)]
    return runs[0].unionByName(runs[1]).unionByName(runs[2]).drop(*OHLC, "volume", "transactions")


@query("log_entries", "IN-7", "SELECT data_type, date, status, layer, seq FROM ingestion_log WHERE data_type = '1-URGENT' AND status = 'failed' AND layer = 'silver' AND date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'")
def _(s, d):
    return DQ.log_entries(V.ingestion_log(s, d), "1-URGENT", "1996-01-01", "1998-12-31", "failed", "silver").select("data_type", "date", "status", "layer", "seq")


@query("bar_freshness", "IN-8", """SELECT symbol, max(date) AS last_date, CAST(date_diff('hour', CAST(max(date) AS TIMESTAMP), TIMESTAMP '2024-01-31 12:00:00') AS DOUBLE) AS hours, date_diff('hour',
  CAST(max(date) AS TIMESTAMP), TIMESTAMP '2024-01-31 12:00:00') >= 48 AS stale
  FROM bars_daily GROUP BY 1""", ["hours"], ["symbol", "last_date", "stale"])
def _(s, d):
    return DQ.freshness(V.bars_daily(s, d), "2024-01-31 12:00:00")


@query("unconverted_symbols", "IN-9", "SELECT DISTINCT symbol FROM bars_daily WHERE symbol NOT IN (SELECT symbol FROM bars_daily WHERE transactions > 5)")
def _(s, d):
    """The log has an entry for each symbol with a day of more than five ticks; the others are still to be converted."""
    bars = V.bars_daily(s, d)
    log = bars.filter("transactions > 5").select("symbol", F.lit("stocks_daily").alias("data_type"))
    return DQ.unconverted(bars, log, "stocks_daily")


@query("cleared_log", "IN-9", "SELECT data_type, count(*) AS rows FROM ingestion_log WHERE data_type <> '1-URGENT' GROUP BY 1")
def _(s, d):
    return A.counts_by(DQ.cleared(V.ingestion_log(s, d), "1-URGENT"), "data_type")


GAPS = "(SELECT symbol, date + 1 AS gap_start, nxt - 1 AS gap_end FROM (SELECT symbol, date, lead(date) OVER (PARTITION BY symbol ORDER BY date) AS nxt FROM bars_long) WHERE nxt - date > 1) g"


@query("date_gaps", "DQ-1", f"SELECT symbol, gap_start, gap_end FROM {GAPS}")
def _(s, d):
    return DQ.date_gaps(V.bars_long(s, d), "symbol")


@query("trading_gaps", "DQ-2", f"SELECT symbol, gap_start, gap_end FROM {GAPS} WHERE len([x for x in generate_series(CAST(gap_start AS TIMESTAMP), CAST(gap_end AS TIMESTAMP), INTERVAL 1 DAY) if isodow(x) <= 5]) > 0")
def _(s, d):
    return DQ.trading_gaps(DQ.date_gaps(V.bars_long(s, d), "symbol"))


@query("date_ranges", "DQ-3", "SELECT symbol, min(date) AS range_start, max(date) AS range_end, count(*) AS days FROM (SELECT symbol, date, date - CAST(row_number() OVER (PARTITION BY symbol ORDER BY date) AS INT) AS island FROM bars_long) GROUP BY symbol, island")
def _(s, d):
    return DQ.date_ranges(V.bars_long(s, d), "symbol")


@query("integrity_report", "DQ-4", f"""
WITH a AS (SELECT DISTINCT date FROM bars_long WHERE {LAYER_A}), b AS (SELECT DISTINCT date FROM bars_long WHERE {LAYER_B}), g AS (SELECT date + 1 AS s, lead(date) OVER (ORDER BY date) - 1 AS e FROM a)
SELECT 'stocks_daily' AS data_type, (SELECT count(*) FROM bars_long WHERE {LAYER_A}) AS rows, (SELECT min(date) FROM a) AS first_date, (SELECT max(date) FROM a) AS last_date,
  (SELECT count(*) FROM g WHERE e >= s AND len([x for x in generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY) if isodow(x) <= 5]) > 0) AS gaps,
  (SELECT count(*) FROM a WHERE date NOT IN (SELECT date FROM b)) AS missing_after, (SELECT count(*) FROM b WHERE date NOT IN (SELECT date FROM a)) AS missing_before""")
def _(s, d):
    b = V.bars_long(s, d)
    return DQ.integrity(b.filter(LAYER_A), b.filter(LAYER_B), "stocks_daily")


@query("table_validation", "DQ-5", """SELECT count(*) AS rows, count(DISTINCT symbol) AS keys, count(DISTINCT symbol) * 100.0 / 150 AS coverage_pct, CAST(DATE '2024-06-30' - max(date) AS BIGINT) AS age_days,
  count(*) / count(DISTINCT symbol) AS rows_per_key, count(DISTINCT symbol) * 100.0 / 150 < 95 AS warn_coverage, DATE '2024-06-30' - max(date) > 90 AS warn_age,
  count(*) / count(DISTINCT symbol) < 40 AS warn_rows FROM bars_daily""", ["coverage_pct", "rows_per_key"], ["rows", "keys", "age_days", "warn_coverage", "warn_age", "warn_rows"])
def _(s, d):
    return DQ.validate(V.bars_daily(s, d), 150, "2024-06-30", key="symbol")


@query("null_counts", "DQ-6", "SELECT count(*) FILTER (market_cap IS NULL) AS null_market_cap, count(*) FILTER (sector IS NULL) AS null_sector, count(*) FILTER (ticker IS NULL) AS null_ticker FROM tickers")
def _(s, d):
    return DQ.null_counts(V.tickers(s, d), ["market_cap", "sector", "ticker"])


@query("duplicate_groups", "DQ-7", "SELECT source_ticker, ticker, count(*) AS copies FROM relationships GROUP BY 1, 2 HAVING count(*) > 1")
def _(s, d):
    return DQ.duplicate_groups(V.relationships(s, d), "source_ticker", "ticker")


@query("price_anomalies", "DQ-8", "SELECT symbol, date, close / nullif(open, 0) - 1 AS move FROM bars_daily WHERE abs(close / nullif(open, 0) - 1) > 0.5", ["move"], ["symbol", "date"])
def _(s, d):
    return DQ.price_anomalies(V.bars_daily(s, d)).select("symbol", "date", "move")


@query("epoch_check", "DQ-9", "SELECT count(*) AS n, count(*) FILTER (event_id % 3 = 0) AS wrong_unit FROM events")
def _(s, d):
    ns = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return DQ.epoch_check(V.ticks(s, d).select(F.when(F.col("event_id") % 3 == 0, (ns / 100).cast("long")).otherwise(ns).alias("window_start")), "window_start")


@query("completeness", "DQ-10", "SELECT count(DISTINCT symbol) AS symbols, count(DISTINCT date) AS dates, count(*) AS rows, min(date) AS first_date, max(date) AS last_date FROM bars_daily")
def _(s, d):
    return DQ.completeness(V.bars_daily(s, d))


@query("panel_check", "DQ-12", "SELECT symbol, count(*) AS rows, (SELECT count(DISTINCT date) FROM bars_daily) AS expected FROM bars_daily GROUP BY 1 HAVING count(*) <> (SELECT count(DISTINCT date) FROM bars_daily)")
def _(s, d):
    b = V.bars_daily(s, d)
    return DQ.panel_check(b, b)


@query("panel_difference", "DQ-13", "SELECT count(*) AS rows, max(abs(close - CAST(close AS FLOAT))) AS max_diff, count(*) FILTER (abs(CAST(close AS FLOAT) - close) > 1e-6) AS differences, CAST(0 AS BIGINT) AS one_sided FROM bars_daily", ["max_diff"], ["rows", "differences", "one_sided"])
def _(s, d):
    b = V.bars_daily(s, d)
    return DQ.panel_difference(DQ.aligned_panel(b, b.select("date").distinct(), ["close"]), b, "close")


@query("instrument_check", "DQ-14", "SELECT count(*) AS rows, count(*) FILTER (trim(symbol) = '') AS empty_symbols, CAST(0 AS BIGINT) AS bad_dates, count(*) FILTER (e < s) AS reversed FROM (SELECT symbol, min(date) AS s, max(date) AS e FROM bars_daily GROUP BY 1)")
def _(s, d):
    return DQ.instrument_check(DQ.instruments(V.bars_daily(s, d)))


@query("instruments", "P-1", "SELECT symbol, min(date) AS start_date, max(date) AS end_date FROM (SELECT symbol, date FROM bars_daily UNION ALL SELECT ticker, execution_date FROM splits) GROUP BY 1")
def _(s, d):
    old = V.splits(s, d).groupBy(F.col("ticker").alias("symbol")).agg(F.min("execution_date").alias("start_date"), F.max("execution_date").alias("end_date"))
    return DQ.instruments(V.bars_daily(s, d), old)


@query("panel_calendar", "P-2", f"SELECT DISTINCT date FROM (SELECT date FROM bars_daily WHERE {RANGE} UNION ALL SELECT execution_date FROM splits)")
def _(s, d):
    return DQ.calendar_of(V.bars_daily(s, d), "2024-01-05", "2024-01-20", V.splits(s, d).select(F.col("execution_date").alias("date")))


@query("aligned_panel", "P-3 P-4", f"""SELECT symbol, date, {', '.join(OHLC)}, CAST(volume AS DOUBLE) AS volume, CAST(transactions AS DOUBLE) AS transactions
  FROM (SELECT DISTINCT symbol FROM bars_daily) s CROSS JOIN (SELECT DISTINCT date
  FROM bars_daily) c LEFT JOIN bars_daily USING (symbol, date)""", [*OHLC, "volume", "transactions"], ["symbol", "date"])
def _(s, d):
    b = V.bars_daily(s, d)
    return DQ.aligned_panel(b, b.select("date").distinct(), DQ.feature_columns(b), narrow=False)


@query("long_panel", "P-5", " UNION ALL ".join(f"SELECT symbol, date, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM bars_daily WHERE true" for c in [*OHLC, "volume", "transactions"]), ["value"], ["symbol", "date", "feature"])
def _(s, d):
    b = V.bars_daily(s, d)
    return DQ.long_panel(b, DQ.feature_columns(b))


@query("ratios_aligned_union", "F-20", f"""SELECT ticker, fiscal_year, fiscal_period, assets, revenues FROM (SELECT ticker, fiscal_year, fiscal_period, assets, NULL AS revenues
  FROM balance_sheets UNION ALL SELECT ticker, fiscal_year, fiscal_period, NULL, revenues
  FROM income_statements)""", ["assets", "revenues"], PERIOD)
def _(s, d):
    a = V.balance_sheets(s, d).select(*PERIOD, "assets")
    return FU.aligned_union([a, V.income_statements(s, d).select(*PERIOD, "revenues")])


@query("ratio_averages", "A-27", f"SELECT ticker, avg(roe) AS avg_roe, avg(current_ratio) AS avg_current_ratio, avg(debt_to_equity) AS avg_debt_to_equity FROM ({_ratio_sql}) r GROUP BY 1", {"avg_roe": 4, "avg_current_ratio": 4, "avg_debt_to_equity": 4}, ["ticker"])
def _(s, d):
    """Average ratios per ticker."""
    return A.averages(_ratios(s, d), ["roe", "current_ratio", "debt_to_equity"], "ticker")
