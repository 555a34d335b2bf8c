"""Option contracts: ticker parsing and measures against the underlying."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.exprs import col, sdiv

#: ``O:`` underlying, yymmdd, C or P, strike in thousandths.
PATTERN = r"^O:[A-Z]+[0-9]{6}[CP][0-9]{8}\z"
FIELDS = ("underlying", "expiration_date", "contract_type", "strike_price")


def parsed(ticker: str | Column = "ticker") -> Column:
    """Struct of underlying, expiration_date, contract_type, strike_price; NULL if malformed or the date doesn't exist.

    The pattern is matched once; as it fixes 15 characters at the end, the parts are cut by place.
    """
    t = col(ticker)
    part = lambda back, n: F.substring(t, -back, n)
    expires = F.concat(F.lit("20"), part(15, 2), F.lit("-"), part(13, 2), F.lit("-"), part(11, 2)).try_cast("date")
    value = F.struct(t.substr(F.lit(3), F.length(t) - 17).alias(FIELDS[0]), expires.alias(FIELDS[1]), part(9, 1).alias(FIELDS[2]), (part(8, 8).try_cast("double") / 1000).alias(FIELDS[3]))
    return F.when(t.rlike(PATTERN), F.when(expires.isNotNull(), value))


def is_valid(ticker: str | Column = "ticker") -> Column:
    return F.coalesce(parsed(ticker).isNotNull(), F.lit(False))


def with_parsed(bars: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Contract fields as columns; NULL for tickers that don't parse.

    A row's ticker is parsed once, by a generator: as plain columns the parse would be repeated for each field, and filters on the fields
    would take it below joins and aggregates, together with whatever makes the ticker.
    """
    return bars.select("*", F.inline_outer(F.array(parsed(ticker))).alias(*FIELDS))


def contracts(bars: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Distinct tickers that parse, with their fields."""
    return with_parsed(bars.select(ticker).distinct(), ticker).filter(F.col(FIELDS[0]).isNotNull())


def contract_word(contract_type: str | Column = "contract_type") -> Column:
    c = col(contract_type)
    return F.when(c == "C", "call").when(c == "P", "put")


def days_to_expiry(date: str = "date") -> Column:
    return F.datediff("expiration_date", date)


def moneyness(close: str = "close") -> Column:
    return sdiv("strike_price", close)


def volume_oi_ratio() -> Column:
    return sdiv("volume", "open_interest")


def with_underlying(options: DataFrame, underlying: DataFrame) -> DataFrame:
    """Add ``underlying_price`` of the same date and ``moneyness_underlying``; options of unknown underlyings keep NULLs."""
    prices = underlying.select(F.col("symbol").alias("underlying"), "date", F.col("close").alias("underlying_price"))
    return options.join(prices, ["underlying", "date"], "left").withColumn("moneyness_underlying", sdiv("strike_price", "underlying_price"))


def chain(bars: DataFrame, underlying: str) -> DataFrame:
    """Distinct contracts of one underlying."""
    return contracts(bars).filter(F.col("underlying") == underlying.upper())


def stored_chain(table: DataFrame, underlying: str) -> DataFrame:
    """Distinct contracts of one underlying, from a table that keeps contract fields as columns: the filter reaches the scan."""
    return table.filter(F.col("underlying") == underlying.upper()).select("ticker", *FIELDS).distinct()


def contract_bars(table: DataFrame, ticker: str) -> DataFrame:
    """All bars of one contract."""
    return table.filter(F.col("ticker") == ticker.upper())


def put_call_ratio(options: DataFrame) -> DataFrame:
    """Volume of puts over that of calls per underlying and date (parsed rows)."""
    volume = lambda t: F.sum(F.when(F.col("contract_type") == t, F.col("volume")))
    sums = options.filter("underlying IS NOT NULL").groupBy("underlying", "date").agg(volume("P").cast("long").alias("put_volume"), volume("C").cast("long").alias("call_volume"))
    return sums.withColumn("put_call_ratio", sdiv("put_volume", "call_volume"))
