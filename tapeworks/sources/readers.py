"""Sources: bar files, API payloads, Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tokens that stand for no value.
NA_TOKENS = ("", "NA", "NULL", "NaN")

_BAR_COLUMNS = {"ticker": "string", "volume": "double", "open": "double", "close": "double", "high": "double", "low": "double", "window_start": "bigint", "transactions": "bigint"}

_BAR = "struct<t:bigint,o:double,h:double,l:double,c:double,v:double,vw:double,n:bigint>"
#: Payload rows of the data service, by name: the fields that tables keep.
PAYLOADS = {
    "bars": "t bigint, o double, h double, l double, c double, v double, vw double, n bigint",
    "option_contracts": "ticker string, underlying_ticker string, contract_type string, strike_price double, expiration_date string, shares_per_contract bigint, exercise_style string",
    "snapshots": f"ticker string, updated bigint, day {_BAR}, prevDay {_BAR}",
    "market_status": "market string, serverTime string, earlyHours boolean, afterHours boolean, exchanges map<string,string>, currencies map<string,string>",
    "holidays": "date string, exchange string, name string, status string, open string, close string",
    "exchanges": "id bigint, type string, asset_class string, locale string, name string, mic string, participant_id string",
    "conditions": "id bigint, type string, name string, asset_class string, data_types array<string>",
    "ticker_types": "code string, description string, asset_class string, locale string",
    "trades": "sip_timestamp bigint, participant_timestamp bigint, price double, size double, exchange bigint, conditions array<bigint>, id string, sequence_number bigint",
    "quotes": "sip_timestamp bigint, bid_price double, bid_size double, ask_price double, ask_size double, bid_exchange bigint, ask_exchange bigint, sequence_number bigint",
    "forex_quotes": "ask double, bid double, exchange bigint, timestamp bigint",
    "crypto_trades": "id string, price double, size double, exchange bigint, conditions array<bigint>, timestamp bigint",
    "index_values": "ticker string, name string, value double, type string, timeframe string, market_status string",
}


def _known(c: str) -> Column:
    return F.when(~F.trim(c).isin(*NA_TOKENS), F.trim(c))


def read_bars_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Bar CSV files, gzipped or not, with a header; NA tokens and what doesn't cast are NULL. Columns are matched by the header's order in the format."""
    raw = spark.read.schema(", ".join(f"{c} string" for c in _BAR_COLUMNS)).option("header", True).option("enforceSchema", False).csv(path)
    return raw.select(*(_known(c).try_cast(k).alias(c) for c, k in _BAR_COLUMNS.items()), F.input_file_name().alias("source_file"))


def normalize(bars: DataFrame, data_type: str) -> DataFrame:
    """Names by data type: ticker becomes symbol for stocks, window_start (epoch ns) becomes timestamp."""
    out = bars.withColumnRenamed("ticker", "symbol") if data_type.startswith("stocks") else bars
    return out.withColumn("timestamp", F.timestamp_micros(F.expr("window_start div 1000"))).drop("window_start").withColumn("volume", F.col("volume").cast("bigint"))


def with_dates(bars: DataFrame) -> DataFrame:
    """UTC date of the timestamp, else the date in the file's name; year and month first."""
    named = F.try_to_date(F.regexp_extract("source_file", r"(\d{4}-\d{2}-\d{2})", 1)) if "source_file" in bars.columns else F.lit(None).cast("date")
    date = F.coalesce(F.to_date("timestamp"), named)
    rest = [c for c in bars.columns if c not in ("date", "source_file", "year", "month")]
    dated = bars.withColumn("date", date)
    return dated.select(F.year("date").cast("smallint").alias("year"), F.month("date").cast("tinyint").alias("month"), "date", *rest)


def read_payload(spark: SparkSession, path: str, name: str, wrapped: str | None = "results", page: str = "") -> DataFrame:
    """JSON payloads, one object a line: rows of the array ``wrapped``, or the objects themselves; after those of partition folders.

    ``page``: the page's own fields beside the array, such as ``ticker string``; they come first.
    """
    row = PAYLOADS[name]
    if wrapped is None:
        return spark.read.schema(row).json(path)
    fields = [page] if page else []
    pages = spark.read.schema(", ".join([*fields, f"{wrapped} array<struct<{', '.join(f.replace(' ', ':', 1) for f in _split(row))}>>"])).json(path)
    return pages.select(*(c for c in pages.columns if c != wrapped), F.inline(wrapped))


def _split(ddl: str) -> list[str]:
    """Fields of a DDL text, commas inside brackets apart."""
    out, depth = [""], 0
    for ch in ddl:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append("")
        else:
            out[-1] += ch
    return [f.strip() for f in out]


def read_api_bars(spark: SparkSession, path: str, wrapped: str | None = "results", page: str = "") -> DataFrame:
    """API bars with full names; epoch ms becomes timestamp, VWAP and transactions default to 0. The page's own fields and columns of partition folders, such as symbol, come first."""
    b = read_payload(spark, path, "bars", wrapped, page)
    known = {f.split()[0] for f in _split(PAYLOADS["bars"])}
    return b.select(
        *(c for c in b.columns if c not in known), F.timestamp_millis("t").alias("timestamp"), F.col("o").alias("open"), F.col("h").alias("high"), F.col("l").alias("low"), F.col("c").alias("close"),
        F.col("v").cast("bigint").alias("volume"), F.coalesce("vw", F.lit(0.0)).alias("vwap"), F.coalesce("n", F.lit(0)).cast("bigint").alias("transactions"),
    )


def read_option_contracts(spark: SparkSession, path: str, wrapped: str | None = "results") -> DataFrame:
    c = read_payload(spark, path, "option_contracts", wrapped)
    return c.withColumns({"expiration_date": F.try_to_date("expiration_date"), "shares_per_contract": F.coalesce("shares_per_contract", F.lit(100)).cast("bigint"), "exercise_style": F.coalesce("exercise_style", F.lit("american"))})


def flat_snapshots(df: DataFrame) -> DataFrame:
    """``day`` and ``prevDay`` as day_* and prev_* columns, and the change in percent."""
    parts = {"day": "day", "prevDay": "prev"}
    fields = [F.col(f"{s}.{f}").alias(f"{p}_{f}") for s, p in parts.items() for f in df.schema[s].dataType.names]
    return df.select("ticker", *fields).withColumn("change_pct", (F.col("day_c") - F.col("prev_c")) / F.nullif(F.col("prev_c"), F.lit(0.0)) * 100)


def read_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet files of one table, united by column name."""
    paths = [path] if isinstance(path, str) else path
    return spark.read.option("mergeSchema", True).parquet(*paths)
