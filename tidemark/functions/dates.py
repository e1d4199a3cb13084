"""Date and time parsing. Strict parsers raise on bad input, the others give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_strict(column, pattern: str = "yyyyMMdd") -> Column:
    return F.to_date(column, pattern)


def date_coerced(column, pattern: str | None = None) -> Column:
    """``yyyy-MM-dd`` text, or null for blank and unparsable input."""
    parsed = F.try_to_timestamp(column, F.lit(pattern)) if pattern else F.try_to_timestamp(column)
    return F.date_format(parsed, "yyyy-MM-dd")


def month_start(column) -> Column:
    """``yyyyMM`` text to the first day of the month."""
    return F.to_date(F.concat(column, F.lit("01")), "yyyyMMdd")


def ampm_stamp(column) -> Column:
    """``2024.01.05. 오후 3:07`` to ``2024-01-05 15:07:00``; blank or unparsable gives null."""
    marked = F.regexp_replace(F.regexp_replace(column, "오전", "AM"), "오후", "PM")
    parsed = F.try_to_timestamp(marked, F.lit("yyyy.MM.dd. a h:mm"))
    return F.date_format(parsed, "yyyy-MM-dd HH:mm:ss")


def rfc822_stamp(column) -> Column:
    """``Fri, 05 Jan 2024 15:07:09 +0900`` to local text; the offset is dropped, not applied."""
    inner = F.regexp_extract(column, r"^\w{3}, (\d{2} \w{3} \d{4} \d{2}:\d{2}:\d{2}) \+0900$", 1)
    parsed = F.try_to_timestamp(F.nullif(inner, F.lit("")), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.date_format(parsed, "yyyy-MM-dd HH:mm:ss")


def time_of_day(column) -> Column:
    """``HH:mm`` text to ``HH:mm:ss``, null when it is not a time."""
    return F.date_format(F.try_to_timestamp(column, F.lit("HH:mm")), "HH:mm:ss")


def quarter_label(column) -> Column:
    return F.concat(F.year(column).cast("string"), F.lit("Q"), F.quarter(column).cast("string"))


def text_date(column) -> Column:
    """The first ``YYYY년 M월 D일`` in a text as ISO text, else null."""
    pattern = r"(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일"
    parts = [F.regexp_extract(column, pattern, i) for i in (1, 2, 3)]
    iso = F.concat_ws("-", parts[0], F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0"))
    return F.when(parts[0] != "", iso)
