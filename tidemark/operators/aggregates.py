"""Grouped measures; every one aggregates partially before its shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_or_zero(value) -> Column:
    return F.coalesce(F.sum(value), F.lit(0.0))


def mean_or_zero(value, condition: Column | None = None) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.avg(F.when(condition, value) if condition is not None else value), F.lit(0.0))


def group_sum_positive(df: DataFrame, keys: Iterable[str], value: str) -> DataFrame:
    """Sum per complete key, positive sums only."""
    keys = list(keys)
    complete = df.dropna(subset=keys)
    return complete.groupBy(*keys).agg(F.sum(value).alias("total")).filter(F.col("total") > 0)


def condition_matrix(df: DataFrame, rows: Mapping[str, Column], columns: Iterable[str], unit: float = 1e6) -> DataFrame:
    """One row per condition, one column per measure, from a single pass over the table.

    Row: sum of the measure where the condition holds, in ``unit``; 0 where nothing matches.
    """
    columns = list(columns)
    sums = df.agg(*[
        F.struct(*[(sum_or_zero(F.when(condition, F.col(c))) / F.lit(unit)).alias(c) for c in columns]).alias(name)
        for name, condition in rows.items()
    ])
    entries = F.array(*[F.struct(F.lit(n).alias("category"), F.col(f"`{n}`").alias("m")) for n in rows])
    return sums.select(F.inline(entries)).select("category", *[F.col(f"m.{c}") for c in columns])


def column_totals(df: DataFrame, columns: Iterable[str], unit: float = 1e6, margin: float = 1.1) -> DataFrame:
    """Total of each column in ``unit`` and an axis bound a little over the largest."""
    columns = list(columns)
    totals = df.agg(*[(sum_or_zero(c) / F.lit(unit)).alias(c) for c in columns])
    bound = F.greatest(*columns) if len(columns) > 1 else F.col(columns[0])
    return totals.withColumn("axis_bound", bound * F.lit(margin))


def max_or_default(df: DataFrame, value, default) -> DataFrame:
    return df.agg(F.coalesce(F.max(value), F.lit(default)).alias("mark"))


def latest_period(df: DataFrame, period: str) -> DataFrame:
    """Rows of the largest period; the maximum is a scalar subquery."""
    return df.filter(F.col(period) == df.agg(F.max(period)).scalar())


def distinct_per_group(df: DataFrame, key: str, value: str) -> DataFrame:
    """The distinct values of each group as rows."""
    return df.filter(F.col(key).isNotNull()).select(key, value).distinct()


def path_totals(df: DataFrame, path: list[str], value: str) -> DataFrame:
    """Totals at every level of a path; ``level`` counts the leading columns that are set.

    Leaf sums come first, so that the rollup expands the leaves and not the rows.
    """
    leaves = df.dropna(subset=path).groupBy(*path).agg(F.sum(value).alias("total"))
    level = F.lit(len(path)) - F.bit_count(F.grouping_id())
    return leaves.rollup(*path).agg(F.sum("total").alias("total"), level.cast("bigint").alias("level"))


def facet_counts(df: DataFrame, facets: list[str], by: list[str], all_marker: str = "ALL") -> DataFrame:
    """Counts for each combination of facet values or all of them, per ``by`` columns.

    ``grouping`` tells a null facet value from the ALL rows.
    """
    counted = df.groupBy(*by, *facets).agg(F.count(F.lit(1)).alias("n"))
    chosen = [[*by, *subset] for n in range(len(facets) + 1) for subset in combinations(facets, n)]
    sets = counted.groupingSets(chosen, *by, *facets)
    totals = sets.agg(F.sum("n").alias("n"), *[F.grouping(c).alias(f"__g_{c}") for c in facets])
    named = [F.when(F.col(f"__g_{c}") == 1, F.lit(all_marker)).otherwise(F.col(c)).alias(c) for c in facets]
    return totals.select(*by, *named, "n")


def regression_metrics(df: DataFrame, keys: Iterable[str], actual: str, predicted: str) -> DataFrame:
    """Mean squared error and R² per series; R² is null when the actual values do not vary."""
    known = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    error = F.col(actual) - F.col(predicted)
    sums = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(error * error).alias("mse"), F.var_pop(actual).alias("__var"))
    r2 = F.when(F.col("__var") > 0, F.lit(1.0) - F.col("mse") / F.col("__var"))
    return sums.withColumn("r2", r2).drop("__var")


def consolidate(df: DataFrame, keys: Iterable[str], values: Iterable[str]) -> DataFrame:
    """Sparse rows folded to one per key, the mean of what is known in each column."""
    return df.groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values])


def segment_profile(df: DataFrame, segment: str, measures: list[str], statistic: str = "avg") -> DataFrame:
    """``segment, category, amount``: a statistic of every measure column per segment."""
    fold = F.avg if statistic == "avg" else F.sum
    wide = df.filter(F.col(segment).isNotNull()).groupBy(segment).agg(*[fold(m).alias(m) for m in measures])
    return wide.unpivot([segment], measures, "category", "amount")
