"""Table schemas by data type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PRICES = [(c, "double") for c in ("open", "high", "low", "close")]
_OPTION = [("underlying", "string"), ("expiration_date", "date"), ("contract_type", "string"), ("strike_price", "double")]
_COUNTS = [("volume", "bigint"), ("transactions", "bigint")]
_MONTH = [("year", "smallint"), ("month", "tinyint")]

RAW = {
    "stocks_daily": [*_MONTH, ("symbol", "string"), ("date", "date"), ("timestamp", "timestamp"), *_PRICES, *_COUNTS],
    "stocks_minute": [*_MONTH, ("symbol", "string"), ("date", "date"), ("timestamp", "timestamp"), *_PRICES, *_COUNTS],
    "options_daily": [*_MONTH, ("ticker", "string"), ("date", "date"), ("timestamp", "timestamp"), *_OPTION, *_PRICES, *_COUNTS],
    "options_minute": [*_MONTH, ("ticker", "string"), ("date", "date"), ("timestamp", "timestamp"), *_OPTION, *_PRICES, *_COUNTS],
}
FEATURES = {
    "stocks_daily": [(c, "double") for c in ("alpha_daily", "price_range", "daily_return", "vwap", "volume_ratio")],
    "stocks_minute": [(c, "double") for c in ("alpha_minute", "price_velocity", "minute_return")],
    "options_daily": [("moneyness", "double"), ("days_to_expiry", "smallint"), ("relative_volume", "double")],
    "options_minute": [],
}


def schema(data_type: str, raw: bool = False) -> T.StructType:
    """The schema of a data type, without the feature columns if ``raw``; ValueError for an unknown type."""
    if data_type not in RAW:
        raise ValueError(f"unknown data type {data_type!r}; known: {sorted(RAW)}")
    fields = RAW[data_type] + ([] if raw else FEATURES[data_type])
    return T._parse_datatype_string(", ".join(f"{n} {k}" for n, k in fields))


def conform(df: DataFrame, data_type: str, raw: bool = True) -> DataFrame:
    """Columns of the schema in its order; missing ones as NULL, values that don't cast as NULL."""
    have = set(df.columns)
    return df.select(*((F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema(data_type, raw).fields))
