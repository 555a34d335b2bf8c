"""Registered queries over the driver tables and their SQL counterparts.

A query is registered with the ids of the inventory rows it covers. Doubles are rounded
alike on both sides; SQL texts name views of :mod:`tapeworks.plans.views`, which are put before them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapeworks.functions.exprs import rounded
from tapeworks.plans import views

Build = Callable[[SparkSession, str], DataFrame]

FLAGSHIP = "bars_daily_features"
QUERIES: dict[str, Build] = {}
ORACLE_SQL: dict[str, str] = {}
#: Inventory ids covered by each query.
COVERS: dict[str, tuple[str, ...]] = {}


def with_views(sql: str) -> str:
    """Put the views that ``sql`` names, and those that they name, before it."""
    used: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b\w+\b", text):
            if name in views.SQL and name not in used and re.search(rf"\b(FROM|JOIN|,)\s*\(?\s*{name}\b", text, re.I):
                visit(views.SQL[name])
                if name not in used:
                    used.append(name)

    visit(sql)
    parts = [f"{n} AS ({views.SQL[n]})" for n in used]
    if not parts:
        return sql
    body = sql.strip()
    return "WITH " + ",\n".join(parts) + (",\n" + body[5:] if body[:5].upper() == "WITH " else "\n" + body)


def tidy(sql: str, doubles: dict[str, int] | list[str], others: list[str]) -> str:
    """The same rounding as :func:`rounded`: NaN and infinities as NULL, minus zero as zero."""
    doubles = doubles if isinstance(doubles, dict) else dict.fromkeys(doubles, 6)
    out = [*others, *(f"CASE WHEN isnan({c}) OR isinf({c}) THEN NULL ELSE round(CAST({c} AS DOUBLE), {d}) + 0.0 END AS {c}" for c, d in doubles.items())]
    return f"SELECT {', '.join(out)} FROM ({sql}) tidy_"


def query(name: str, covers: str, sql: str | None, doubles: dict[str, int] | list[str] | None = None, others: list[str] | None = None, digits: dict[str, int] | None = None):
    """Register the decorated builder. ``doubles`` and ``others`` list the result's columns when SQL needs rounding."""

    def register(build: Build) -> Build:
        more = {c: d for c, d in (doubles.items() if isinstance(doubles, dict) else ()) if d != 6}

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(build(spark, sf_dir), **(digits or more))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name], COVERS[name] = run, tuple(covers.split())
        if sql is not None:
            body = sql
            if doubles is not None:
                head = re.match(r"\s*WITH\s", body, re.I)
                body = tidy(body, doubles, others or []) if not head else body
                if head:
                    cut = body.rindex("\nSELECT")
                    body = body[:cut] + "\n" + tidy(body[cut:].strip(), doubles, others or [])
            ORACLE_SQL[name] = with_views(body)
        return build

    return register


from tapeworks.plans import queries as _queries  # noqa: E402, F401  (registers on import)
from tapeworks.plans import queries_tables as _tables  # noqa: E402, F401
from tapeworks.plans import queries_io as _io  # noqa: E402, F401
