"""Company statements: unnesting, joining, ratios, growth and quality scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.functions.exprs import sdiv

PERIOD = ["ticker", "fiscal_year", "fiscal_period"]
FILING = ["ticker", "filing_date", "fiscal_year", "fiscal_period"]
PREFIX = {"balance_sheet": "bs", "income_statement": "is", "cash_flow_statement": "cf"}


def first_ticker(df: DataFrame) -> DataFrame:
    """``ticker`` from the first of ``tickers``; NULL for an empty or null list."""
    return df.withColumn("ticker", F.get("tickers", F.lit(0)))


def flatten_statements(df: DataFrame, struct: str = "financials") -> DataFrame:
    """Columns bs_*, is_*, cf_* from ``financials.<statement>.<metric>.value`` by a walk of the schema; what a file lacks is simply absent."""
    keep = [c for c in df.columns if c != struct]
    out: list[Column] = []
    for statement in df.schema[struct].dataType.fields:
        if statement.name in PREFIX and isinstance(statement.dataType, T.StructType):
            for metric in statement.dataType.fields:
                if isinstance(metric.dataType, T.StructType) and "value" in metric.dataType.names:
                    value = F.col(f"{struct}.`{statement.name}`.`{metric.name}`.value")
                    out.append(value.try_cast("double").alias(f"{PREFIX[statement.name]}_{metric.name}"))
    return df.select(*keep, *out)


def integers_to_double(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(c).cast("double").alias(c) if k in ("tinyint", "smallint", "int", "bigint") else F.col(c) for c, k in df.dtypes))


def prefixed(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in df.columns if c not in keys})


def wide(balance: DataFrame, income: DataFrame, cash: DataFrame, keys: list[str] = FILING, stamp: bool = False) -> DataFrame:
    """Full outer join of the three statements with coalesced keys and bs_, is_, cf_ columns."""
    sides = [prefixed(d, p, keys) for d, p in ((balance, "bs"), (income, "is"), (cash, "cf"))]
    out = reduce(lambda a, b: a.join(b, keys, "full"), sides)
    return out.withColumn("processed_at", F.current_timestamp()) if stamp else out


def statements(balance: DataFrame, income: DataFrame, cash: DataFrame | None = None, on: list[str] | None = None) -> DataFrame:
    """Inner join of balance sheet and income statement, left join of the cash flow; clashing columns get _is and _cf."""
    on = on or [*PERIOD, "timeframe"]

    def beside(left: DataFrame, right: DataFrame, suffix: str) -> DataFrame:
        return right.withColumnsRenamed({c: f"{c}_{suffix}" for c in right.columns if c in left.columns and c not in on})

    out = balance.join(beside(balance, income, "is"), on)
    return out if cash is None else out.join(beside(out, cash, "cf"), on, "left")


def with_required(df: DataFrame, names: list[str], kind: str = "double") -> DataFrame:
    """Missing columns as NULL."""
    return df.withColumns({n: F.lit(None).cast(kind) for n in names if n not in df.columns})


REQUIRED = [
    "revenues", "gross_profit", "operating_income_loss", "net_income_loss", "cost_of_revenue", "assets", "equity", "liabilities", "current_assets", "current_liabilities",
    "inventory", "accounts_receivable", "long_term_debt", "short_term_debt", "interest_expense", "net_cash_flow_from_operating_activities", "net_cash_flow_from_investing_activities",
]


def zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def debt() -> Column:
    """Long and short debt, either one missing as 0; NULL where both are."""
    return F.when(F.col("long_term_debt").isNotNull() | F.col("short_term_debt").isNotNull(), zero("long_term_debt") + zero("short_term_debt"))


def profitability() -> dict[str, Column]:
    """In percent."""
    return {
        "gross_margin": sdiv("gross_profit", "revenues") * 100, "operating_margin": sdiv("operating_income_loss", "revenues") * 100, "net_margin": sdiv("net_income_loss", "revenues") * 100,
        "roa": sdiv("net_income_loss", "assets") * 100, "roe": sdiv("net_income_loss", "equity") * 100, "roic": sdiv("net_income_loss", F.col("equity") + zero("long_term_debt")) * 100,
    }


def liquidity() -> dict[str, Column]:
    return {
        "current_ratio": sdiv("current_assets", "current_liabilities"),
        "quick_ratio": sdiv(F.col("current_assets") - zero("inventory"), "current_liabilities"),
        "working_capital": F.col("current_assets") - F.col("current_liabilities"),
    }


def leverage() -> dict[str, Column]:
    return {"debt_to_equity": sdiv(debt(), "equity"), "debt_to_assets": sdiv(debt(), "assets"), "equity_multiplier": sdiv("assets", "equity"), "interest_coverage": sdiv("operating_income_loss", "interest_expense")}


def efficiency() -> dict[str, Column]:
    return {
        "asset_turnover": sdiv("revenues", "assets"), "inventory_turnover": sdiv("cost_of_revenue", "inventory"),
        "receivables_turnover": sdiv("revenues", "accounts_receivable"), "days_sales_outstanding": sdiv(F.lit(365.0), sdiv("revenues", "accounts_receivable")),
    }


def cash_flow() -> dict[str, Column]:
    ocf = F.col("net_cash_flow_from_operating_activities")
    return {"ocf_ratio": sdiv(ocf, "current_liabilities"), "free_cash_flow": ocf + zero("net_cash_flow_from_investing_activities"), "ocf_to_debt": sdiv(ocf, debt())}


def ratios(df: DataFrame) -> DataFrame:
    """All statement ratios beside the statements; metrics that a source lacks count as NULL."""
    made = {**profitability(), **liquidity(), **leverage(), **efficiency(), **cash_flow()}
    return with_required(df, REQUIRED).select(*df.columns, *(x.alias(n) for n, x in made.items()))


def valuation(df: DataFrame, market: DataFrame) -> DataFrame:
    """Left join of ``market`` (ticker, fiscal_year, fiscal_period, price, shares): cap, PE, PB, PS, simple EV/EBITDA."""
    cap = F.col("price") * F.col("shares")
    joined = with_required(df, REQUIRED).select(*df.columns, *(c for c in REQUIRED if c not in df.columns)).join(market, PERIOD, "left").withColumn("market_cap", cap)
    made = {n: sdiv("market_cap", d) for n, d in (("pe_ratio", "net_income_loss"), ("pb_ratio", "equity"), ("ps_ratio", "revenues"), ("ev_ebitda_simple", "operating_income_loss"))}
    return joined.select(*df.columns, "price", "shares", "market_cap", *(x.alias(n) for n, x in made.items()))


def growth(df: DataFrame, k: int = 1) -> DataFrame:
    """Percent over k periods, in order of fiscal year and period; income against the absolute value before."""
    w = Window.partitionBy("ticker").orderBy("fiscal_year", "fiscal_period")
    past = lambda c: F.lag(c, k).over(w)
    made = {f"{n}_growth": sdiv(F.col(c) - past(c), F.abs(past(c)) if c == "net_income_loss" else past(c)) * 100 for n, c in (("revenue", "revenues"), ("net_income", "net_income_loss"), ("assets", "assets"), ("equity", "equity"))}
    return df.select("*", *(x.alias(n) for n, x in made.items()))


def wide_ratios() -> dict[str, Column]:
    """Unscaled ratios of the wide table."""
    return {
        "ratio_roe": sdiv("is_net_income_loss", "bs_equity"), "ratio_roa": sdiv("is_net_income_loss", "bs_assets"),
        "ratio_profit_margin": sdiv("is_net_income_loss", "is_revenues"), "ratio_operating_margin": sdiv("is_operating_income_loss", "is_revenues"),
        "ratio_current": sdiv("bs_current_assets", "bs_current_liabilities"), "ratio_quick": sdiv(F.col("bs_current_assets") - zero("bs_inventory"), "bs_current_liabilities"),
        "ratio_liabilities_to_equity": sdiv("bs_liabilities", "bs_equity"), "ratio_liabilities_to_assets": sdiv("bs_liabilities", "bs_assets"),
    }


WIDE_REQUIRED = [
    "bs_assets", "bs_equity", "bs_liabilities", "bs_current_assets", "bs_current_liabilities", "bs_inventory",
    "is_revenues", "is_net_income_loss", "is_operating_income_loss", "cf_net_cash_flow_from_operating_activities",
]


def wide_quality(df: DataFrame, order: str = "filing_date") -> DataFrame:
    """Wide ratios, growth (four and one filings back), a score from 0 to 5 and a completeness flag.

    Score: income and operating cash above 0, return on assets up, liabilities to assets down, current ratio up,
    each against the filing before; what can't be told adds 0.
    """
    w = Window.partitionBy("ticker").orderBy(order)
    base = with_required(df, WIDE_REQUIRED)
    base = base.select("*", *(x.alias(n) for n, x in wide_ratios().items()))
    back = lambda c, k: F.lag(c, k).over(w)
    grown = lambda c, k: sdiv(F.col(c) - back(c, k), back(c, k))
    point = lambda cond: F.coalesce(cond.cast("int"), F.lit(0))
    score = (
        point(F.col("is_net_income_loss") > 0) + point(F.col("cf_net_cash_flow_from_operating_activities") > 0) + point(F.col("ratio_roa") > back("ratio_roa", 1))
        + point(F.col("ratio_liabilities_to_assets") < back("ratio_liabilities_to_assets", 1)) + point(F.col("ratio_current") > back("ratio_current", 1))
    )
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("is_revenues", "is_net_income_loss", "bs_assets", "bs_equity", "cf_net_cash_flow_from_operating_activities")])
    return base.select(
        "*", grown("is_revenues", 4).alias("growth_revenue_yoy"), grown("is_revenues", 1).alias("growth_revenue_qoq"), grown("is_net_income_loss", 4).alias("growth_net_income_yoy"),
        grown("bs_assets", 4).alias("growth_assets_yoy"), score.alias("piotroski_score"), complete.alias("has_complete_data"),
    )


def with_quarter(df: DataFrame) -> DataFrame:
    """``fiscal_quarter`` from ``fiscal_period`` where a table lacks it."""
    return df if "fiscal_quarter" in df.columns else df.withColumn("fiscal_quarter", F.col("fiscal_period"))


def filing_partition(df: DataFrame) -> DataFrame:
    """year and month of a filing date that is a date or an ISO string."""
    d = F.to_date("filing_date") if dict(df.dtypes)["filing_date"] != "string" else F.try_to_date("filing_date")
    return df.select("*", F.year(d).alias("year"), F.month(d).alias("month"))


def aligned_union(frames: list[DataFrame], stamp: bool = False) -> DataFrame:
    """Union by name; columns that a frame lacks are NULL."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.withColumn("processed_at", F.current_timestamp()) if stamp else out
