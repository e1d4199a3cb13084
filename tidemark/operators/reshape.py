"""Unpivot, pivot and table splitting."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import pin


def unpivot(df: DataFrame, ids: list[str], values: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    """One row per id and column; null values are kept."""
    return df.unpivot(ids, values, name, value)


def outer_merge(series: Iterable[tuple[str, DataFrame]], period: str = "period", value: str = "value") -> DataFrame:
    """Series side by side on their period, one shuffle for any number of them.

    An empty series before the first one with rows has no column, a later one a column of nulls.
    The long rows are written once; which series have rows is read from there.
    """
    series = list(series)
    names = [name for name, _ in series]
    parts = [df.select(period, F.lit(name).alias("__series"), value) for name, df in series]
    long = pin(reduce(DataFrame.unionByName, parts).filter(F.col(period).isNotNull()))
    filled = {row[0] for row in long.select("__series").distinct().collect()}
    lead = next((i for i, name in enumerate(names) if name in filled), len(names))
    if lead == len(names):
        return long.select(period)
    return pivot(long, [period], "__series", names[lead:], value, "first")


def pivot(df: DataFrame, keys: list[str], names: str, values: list[str], value: str, statistic: str = "avg") -> DataFrame:
    """Long to wide over a stated list of names, by conditional aggregation in one pass."""
    folds = {"avg": F.avg, "max": F.max, "sum": F.sum, "first": lambda c: F.first(c, ignorenulls=True)}
    fold = folds[statistic]
    return df.groupBy(*keys).pivot(names, values).agg(fold(F.col(value)))


def transpose(df: DataFrame, label: str, labels: list[str], columns: list[str]) -> DataFrame:
    """Rows become columns; ``labels`` are the row names to turn into columns."""
    long = df.unpivot([label], columns, "column", "value")
    return pivot(long, ["column"], label, labels, "value", "first")


def split_tables(df: DataFrame, dimension: list[str], fact: list[str]) -> tuple[DataFrame, DataFrame]:
    """Distinct dimension rows and all fact rows of one frame."""
    return df.select(*dimension).distinct(), df.select(*fact)


def explode_ratios(df: DataFrame, keys: list[str], ratios: str = "ratios") -> DataFrame:
    """A period-to-ratio map to rows, the parent columns repeated."""
    return df.select(*keys, F.explode(ratios).alias("period", "ratio"))


def ratio_map(df: DataFrame, keys: list[str], period: str, ratio: str, order: str) -> DataFrame:
    """Ratios per key as a map; of a repeated period the entry with the largest ``order`` stays.

    Periods are calendar stamps, so a map has at most one entry per calendar period.
    """
    last = df.groupBy(*keys, period).agg(F.max_by(ratio, order).alias(ratio))
    entries = F.sort_array(F.collect_list(F.struct(period, ratio)))
    return last.groupBy(*keys).agg(F.map_from_entries(entries).alias("ratios"))
