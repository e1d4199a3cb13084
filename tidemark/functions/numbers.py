"""Number casts, clean-up and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which indicators show which unit.
PERCENT_INDICATORS = ("GDP Growth Rate", "FFTR", "Unemployment Rate", "CPI", "Core CPI", "Core PCE")
BILLION_INDICATORS = ("GDP", "PCE", "Personal Income", "Retail Sales")
THOUSAND_INDICATORS = ("Nonfarm Payrolls", "ISM Manufacturing", "Building Permits", "JOLTS Hires")


def number_or_null(column, kind: str = "double") -> Column:
    """Coercing cast: text that is no number gives null, as does NaN."""
    value = F.col(column) if isinstance(column, str) else column
    cast = value.try_cast(kind)
    return F.when(~F.isnan(cast), cast) if kind in ("double", "float") else cast


def clean_money(column) -> Column:
    """``$1,234.50`` to 1234.5; null when nothing numeric is left."""
    return F.regexp_replace(column, r"[$,]", "").try_cast("double")


def percent_fraction(column) -> Column:
    """``50%`` to 0.5."""
    return F.regexp_replace(column, r"[%,]", "").try_cast("double") / F.lit(100.0)


def millions_text(column) -> Column:
    """Value in millions with one decimal and the suffix ``M``."""
    return F.concat(F.round(column / F.lit(1e6), 1).cast("string"), F.lit("M"))


def indicator_text(name, value, percent=PERCENT_INDICATORS, billions=BILLION_INDICATORS,
                   thousands=THOUSAND_INDICATORS) -> Column:
    """Two decimals with the unit the indicator is shown in; null gives ``N/A``.

    ``format_number`` with a pattern rounds the exact binary value; ``format_string`` would round
    its shortest decimal text and differ on ties.
    """
    name = F.col(name) if isinstance(name, str) else name
    value = F.col(value) if isinstance(value, str) else value
    text = F.call_function("format_number", value, F.lit("0.00"))
    return (
        F.when(value.isNull(), "N/A")
        .when(name.isin(*percent), F.concat(text, F.lit("%")))
        .when(name.isin(*billions), F.concat(F.lit("$"), text, F.lit("B")))
        .when(name.isin(*thousands), F.concat(text, F.lit("K")))
        .otherwise(text)
    )


def weighted_score(count, trend) -> Column:
    """``count * (1 + trend / 100)``; a missing trend counts as zero."""
    return count * (F.lit(1.0) + F.coalesce(trend, F.lit(0.0)) / F.lit(100.0))


def row_mean(columns) -> Column:
    """Mean across columns of one row, nulls skipped; null when all are null."""
    columns = [F.col(c) if isinstance(c, str) else c for c in columns]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in columns), F.lit(0.0))
    known = sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
    return F.when(known > 0, total / known)
