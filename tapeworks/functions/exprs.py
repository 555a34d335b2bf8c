"""Column builders that the operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sdiv(a: str | Column, b: str | Column) -> Column:
    """``a / b``; NULL where ``b`` is 0 or NULL."""
    return col(a) / F.nullif(col(b), F.lit(0))


def positive_ln(x: str | Column) -> Column:
    """Natural logarithm; NULL for 0, negative numbers and NULL."""
    x = col(x)
    return F.when(x > 0, F.ln(x))


def series(key: str | list[str] = "symbol", order: str = "date") -> WindowSpec:
    """All of a key's rows in time order; a key may be several columns."""
    return Window.partitionBy(key).orderBy(order)


def last_n(n: int, key: str | list[str] = "symbol", order: str = "date") -> WindowSpec:
    """The current row and up to n - 1 before it."""
    return series(key, order).rowsBetween(-(n - 1), 0)


def so_far(key: str = "symbol", order: str = "date") -> WindowSpec:
    return series(key, order).rowsBetween(Window.unboundedPreceding, 0)


def neg_log_return(close: str | Column, k: int, w: WindowSpec) -> Column:
    """``-ln(close / lag(close, k))``: the sign convention of the declared features."""
    close = col(close)
    return -positive_ln(sdiv(close, F.lag(close, k).over(w)))


def simple_return(close: str | Column, k: int, w: WindowSpec) -> Column:
    close = col(close)
    return sdiv(close, F.lag(close, k).over(w)) - 1


def guarded_corr(x: Column, y: Column, over: WindowSpec | None = None) -> Column:
    """Correlation; NULL where either side doesn't vary (Spark raises there under ANSI)."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    at = (lambda c: c.over(over)) if over is not None else (lambda c: c)
    varies = (at(F.max(x)) > at(F.min(x))) & (at(F.max(y)) > at(F.min(y)))
    # The covariance formula is total; only the guarded division can fail.
    return F.when(varies, at(F.covar_pop(x, y)) / F.nullif(at(F.stddev_pop(x)) * at(F.stddev_pop(y)), F.lit(0.0)))


def every(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def count_true(condition: Column) -> Column:
    """Rows where the condition holds: 0, not NULL, if there are no rows."""
    return F.count_if(condition)


def rounded(df: DataFrame, digits: int = 6, **other: int) -> DataFrame:
    """Doubles rounded (``other``: digits of single columns), minus zero as zero, NaN and infinities as NULL."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = c.cast("double")
            c = F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(F.round(c, other.get(name, digits)) + 0.0)
        out.append(c.alias(name))
    return df.select(*out)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until no column has it."""
    while name in taken:
        name += "_"
    return name
