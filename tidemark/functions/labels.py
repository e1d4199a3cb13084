"""Code-to-label maps, ranks and flag columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Travel-advice words by level, flag column for each word, level names.
ADVICE_LEVELS = {"여행금지": 4, "출국권고": 3, "여행자제": 2, "여행유의": 1}
ADVICE_FLAGS = {
    "여행자제": "Travel_Caution",
    "여행유의": "Travel_Restriction",
    "출국권고": "Departure_Advisory",
    "여행금지": "Travel_Ban",
    "특별여행권고": "Special_Travel_Advisory",
}
SURVEY_ANSWERS = ("많이 적어졌다", "약간 적어졌다", "예전과 비슷하다", "약간 커졌다", "많이 커졌다")


def _column(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def priority_by_substring(column, levels: Mapping[str, int] = ADVICE_LEVELS, default: int = 0) -> Column:
    """The highest level whose word occurs in the text."""
    column = _column(column)
    result = F.lit(default)
    for word, level in sorted(levels.items(), key=lambda item: item[1]):
        result = F.when(column.contains(word), F.lit(level)).otherwise(result)
    return result


def priority_by_flag(flags: Iterable[tuple[object, str]], default: str) -> Column:
    """The outcome of the first true flag; a null flag counts as false."""
    result = F.lit(default)
    for flag, outcome in reversed(list(flags)):
        result = F.when(F.coalesce(_column(flag), F.lit(False)), F.lit(outcome)).otherwise(result)
    return result


def flag_columns(df: DataFrame, tokens: str, flags: Mapping[str, str] = ADVICE_FLAGS) -> DataFrame:
    """One boolean column per known token; unknown tokens set none."""
    return df.withColumns({
        name: F.coalesce(F.array_contains(tokens, word), F.lit(False)) for word, name in flags.items()
    })


def code_label(column, labels: Mapping, keep_unknown: bool = False) -> Column:
    """Label of a code; an unknown code gives null, or itself with ``keep_unknown``."""
    column = _column(column)
    pairs = [F.lit(item) for pair in labels.items() for item in pair]
    label = F.try_element_at(F.create_map(*pairs), column)
    return F.coalesce(label, column) if keep_unknown else label


def ordinal(column, order: Iterable[str] = SURVEY_ANSWERS) -> Column:
    """Position in a fixed list from 1; a value outside it gives null."""
    column = _column(column)
    values = F.array(*[F.lit(v) for v in order])
    return F.nullif(F.array_position(values, column), F.lit(0).cast("bigint"))


def optional_match(filters: Mapping[str, object]) -> Column:
    """Equality on each column that has a value; ``None`` puts no condition on its column."""
    condition = F.lit(True)
    for name, value in filters.items():
        if value is not None:
            condition = condition & (F.col(name) == F.lit(value))
    return condition
