"""Corporate actions, reference data and news."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.exprs import col, sdiv
from tapeworks.operators.chunks import days, with_before

BASE = ["ticker", "event_type", "event_date", "id"]
#: Payments a year of each dividend frequency.
PAYMENTS = {12: 12, 4: 4, 2: 2, 1: 1}


def lenient_date(c: str | Column) -> Column:
    """A date, or NULL for what isn't one."""
    return col(c).try_cast("date")


def dividends(df: DataFrame) -> DataFrame:
    """Sparse-schema rows of dividends: amount, frequency, annualized amount (NULL for other frequencies), special flag, quarter."""
    f = F.col("frequency")
    annual = reduce(lambda acc, p: F.when(f == p[0], F.col("cash_amount") * p[1]).otherwise(acc), PAYMENTS.items(), F.lit(None).cast("double"))
    when = lenient_date("ex_dividend_date")
    return df.select(
        "ticker", F.lit("dividend").alias("event_type"), when.alias("event_date"), "id", F.col("cash_amount").cast("double").alias("div_cash_amount"),
        f.cast("int").alias("div_frequency"), annual.alias("div_annualized_amount"), (f == 0).alias("div_is_special"), F.quarter(when).alias("div_quarter"),
    )


def splits(df: DataFrame) -> DataFrame:
    """Ratio is to over from; below 1 the split is a reverse one."""
    ratio = sdiv("split_to", "split_from")
    return df.select(
        "ticker", F.lit("split").alias("event_type"), lenient_date("execution_date").alias("event_date"), "id",
        F.col("split_from").cast("double").alias("split_from"), F.col("split_to").cast("double").alias("split_to"), ratio.alias("split_ratio"), (ratio < 1).alias("split_is_reverse"),
    )


def ipos(df: DataFrame) -> DataFrame:
    """The id is ticker_listingdate where a source has none."""
    made = F.concat_ws("_", "ticker", F.col("listing_date").cast("string"))
    given = F.coalesce(F.col("id").cast("string"), made) if "id" in df.columns else made
    return df.select("ticker", F.lit("ipo").alias("event_type"), lenient_date("listing_date").alias("event_date"), given.alias("id"), F.col("issue_price").cast("double").alias("ipo_issue_price"), "ipo_status")


def ticker_changes(df: DataFrame) -> DataFrame:
    new = F.col("new_ticker") if "new_ticker" in df.columns else F.lit(None).cast("string")
    return df.select("ticker", F.lit("ticker_change").alias("event_type"), lenient_date("date").alias("event_date"), F.col("id").cast("string").alias("id"), new.alias("new_ticker"))


def all_actions(*frames: DataFrame, stamp: bool = False) -> DataFrame:
    """One sparse table of events with year and month."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    out = out.select("*", F.year("event_date").alias("year"), F.month("event_date").alias("month"))
    return out.withColumn("processed_at", F.current_timestamp()) if stamp else out


def latest(df: DataFrame, *keys: str, by: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in the order ``by``."""
    return df.withColumn("rn_", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).filter(F.col("rn_") <= n).drop("rn_")


def latest_dividends(divs: DataFrame) -> DataFrame:
    return latest(divs, "ticker", by=[F.desc_nulls_last("event_date"), F.desc("id")])


def recent_per_type(events: DataFrame, n: int = 2) -> DataFrame:
    return latest(events, "event_type", by=[F.desc_nulls_last("event_date"), F.col("ticker"), F.col("id")], n=n)


def since(events: DataFrame, event_type: str, as_of: str, years: int) -> DataFrame:
    """Events of a type in the years up to ``as_of``, newest first."""
    from_ = F.add_months(F.lit(as_of).cast("date"), -12 * years)
    kept = events.filter((F.col("event_type") == event_type) & (F.col("event_date") >= from_) & (F.col("event_date") <= F.lit(as_of).cast("date")))
    return kept.orderBy(F.desc("event_date"), "ticker", "id")


def trailing_dividends(divs: DataFrame, as_of: str, days: int = 365) -> DataFrame:
    """Sum and number of each ticker's dividends in the days up to ``as_of``."""
    end = F.lit(as_of).cast("date")
    kept = divs.filter((F.col("event_date") > F.date_sub(end, days)) & (F.col("event_date") <= end))
    return kept.groupBy("ticker").agg(F.sum("div_cash_amount").alias("trailing_amount"), F.count("*").alias("payments"))


def split_kinds(events: DataFrame) -> DataFrame:
    """Distinct tickers with reverse and with forward splits."""
    reverse = F.col("split_is_reverse")
    return events.agg(F.count_distinct(F.when(reverse, F.col("ticker"))).alias("reverse_tickers"), F.count_distinct(F.when(~reverse, F.col("ticker"))).alias("forward_tickers"))


def timeline(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("events"), F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"))


def dividend_screen(divs: DataFrame, start: str, above: float, n: int = 20) -> DataFrame:
    kept = divs.filter((F.col("event_date") >= F.lit(start).cast("date")) & (F.col("div_cash_amount") > above))
    return kept.orderBy(F.desc("event_date"), F.desc("div_cash_amount"), "id").limit(n)


def market_cap_class(cap: str | Column = "market_cap") -> Column:
    """mega, large, mid, small, micro or nano; an unknown cap is nano."""
    c = col(cap)
    return F.when(c >= 200e9, "mega").when(c >= 10e9, "large").when(c >= 2e9, "mid").when(c >= 300e6, "small").when(c >= 50e6, "micro").otherwise("nano")


def universe(*frames: DataFrame, order: str) -> DataFrame:
    """Union of ticker lists, the last row of each ticker by ``order``."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return latest(out, "ticker", by=[F.desc_nulls_last(order)])


def screening(tickers: DataFrame, types: tuple[str, ...] = ("CS", "ETF", "ADRC", "ADRP", "ADRR")) -> DataFrame:
    return tickers.filter(F.col("active") & (F.col("locale") == "us") & F.col("type").isin(*types))


def common_stocks(tickers: DataFrame) -> DataFrame:
    return screening(tickers, ("CS",))


def by_size(tickers: DataFrame, *first: str) -> DataFrame:
    """Tickers ordered by ``first``, then market cap from the largest."""
    return tickers.withColumn("cap_class", market_cap_class()).orderBy(*first, F.desc_nulls_last("market_cap"), "ticker")


def relations(edges: DataFrame) -> DataFrame:
    return edges.dropDuplicates(["source_ticker", "ticker"])


def relation_stats(edges: DataFrame) -> DataFrame:
    """Number and sorted list of distinct related tickers per source."""
    return relations(edges).groupBy("source_ticker").agg(F.count("*").alias("n_related"), F.array_join(F.array_sort(F.collect_list("ticker")), ",").alias("related"))


def news_rows(news: DataFrame) -> DataFrame:
    """One row per article and ticker; rows without ticker or time go; year, month, day of the time."""
    rows = news.select("*", F.explode("tickers").alias("ticker")).drop("tickers")
    rows = rows.withColumn("published", F.try_to_timestamp("published_utc")).filter("ticker IS NOT NULL AND published IS NOT NULL")
    return rows.select("*", F.year("published").alias("year"), F.month("published").alias("month"), F.dayofmonth("published").alias("day"))


def news_counts(rows: DataFrame) -> DataFrame:
    """Per ticker and day: articles, distinct ids, links."""
    return rows.groupBy("ticker", F.substring("published_utc", 1, 10).alias("day")).agg(F.count("*").alias("articles"), F.count_distinct("id").alias("ids"), F.count("amp_url").alias("amp_links"))


def split_adjusted(bars: DataFrame, events: DataFrame, column: str = "close", span: int = 512) -> DataFrame:
    """Prices divided by the product of the ratios of all later splits.

    Bars and splits are laid in one series per symbol and the ratios' logs summed from the end, within buckets of ``span`` days
    and from bucket to bucket: no range join, and a long series takes many tasks.
    """
    one = events.filter("split_ratio > 0").groupBy(F.col("ticker").alias("symbol"), F.col("event_date").alias("date")).agg(F.sum(F.ln("split_ratio")).alias("ln_"))
    laid = bars.withColumn("ln_", F.lit(None).cast("double")).unionByName(one, allowMissingColumns=True)
    laid = with_before(laid, {"beyond_": F.sum("ln_")}, {"beyond_": "sum"}, "symbol", days(span), forward=False)
    after = Window.partitionBy("symbol", "bucket_").orderBy(F.desc("date")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    today = Window.partitionBy("symbol", "bucket_", "date")
    later = F.coalesce(F.sum("ln_").over(after), F.lit(0.0)) - F.coalesce(F.sum("ln_").over(today), F.lit(0.0)) + F.coalesce("beyond_", F.lit(0.0))
    made = laid.withColumn("split_factor", F.exp(later)).filter(F.col(column).isNotNull()).drop("ln_", "beyond_", "bucket_")
    return made.withColumn(f"adjusted_{column}", F.col(column) / F.col("split_factor"))


def dividend_yield(divs: DataFrame, bars: DataFrame) -> DataFrame:
    """Latest annualized dividend over the latest close of each ticker with both."""
    last_div = latest(divs.filter("div_annualized_amount IS NOT NULL"), "ticker", by=[F.desc_nulls_last("event_date"), F.desc("id")]).select("ticker", "div_annualized_amount")
    last_bar = bars.groupBy(F.col("symbol").alias("ticker")).agg(F.max_by("close", "date").alias("close"))
    return last_div.join(last_bar, "ticker").withColumn("dividend_yield", sdiv("div_annualized_amount", "close"))


def delisted(tickers: DataFrame, start: str, end: str) -> DataFrame:
    """Tickers delisted in a period, the time read as UTC."""
    at = F.try_to_timestamp(F.col("delisted_utc"))
    return tickers.withColumn("delisted_date", F.to_date(at)).filter(F.col("delisted_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def active_tickers(tickers: DataFrame, types: list[str], n: int | None = None) -> DataFrame:
    out = tickers.filter(F.col("active") & F.col("type").isin(types)).orderBy("ticker")
    return out if n is None else out.limit(n)


def reference_coverage(tickers: DataFrame, edges: DataFrame) -> DataFrame:
    """Tickers, distinct types and relationships in one row."""
    t = tickers.agg(F.count_distinct("ticker").alias("tickers"), F.count_distinct("type").alias("types"))
    e = relations(edges).agg(F.count("*").alias("relationships"))
    return t.join(F.broadcast(e))


def enriched(facts: DataFrame, tickers: DataFrame, edges: DataFrame) -> DataFrame:
    """Left join of a ticker's details and its number of related tickers; Spark picks how from the sizes."""
    stats = relation_stats(edges).select(F.col("source_ticker").alias("ticker"), "n_related")
    return facts.join(tickers, "ticker", "left").join(stats, "ticker", "left")

