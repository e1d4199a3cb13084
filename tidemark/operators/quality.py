"""Checked, incremental and de-duplicated loads."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import max_or_default
from tidemark.operators.joins import new_rows_only
from tidemark.operators.ranking import latest_per_key
from tidemark.sources import sinks


class CheckFailed(ValueError):
    """A row-count check did not hold."""


def check_counts(checks: Iterable[tuple[DataFrame, str, int]]) -> None:
    """Each check is a frame, ``>=`` or ``eq``, and a row count."""
    for df, relation, expected in checks:
        actual = df.count()
        if relation not in (">=", "eq"):
            raise ValueError(f"unknown relation {relation}")
        if actual < expected if relation == ">=" else actual != expected:
            raise CheckFailed(f"{actual} rows, wanted {relation} {expected}")


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _swap(spark: SparkSession, staged: str, target: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    new, old = path(staged), path(target)
    files = new.getFileSystem(spark._jsc.hadoopConfiguration())
    retired = path(target + ".old")
    if files.exists(old):
        files.delete(retired, True)
        if not files.rename(old, retired):
            raise OSError(f"cannot move {target} aside")
    if not files.rename(new, old):
        files.rename(retired, old)
        raise OSError(f"cannot move {staged} to {target}")
    files.delete(retired, True)


def checked_build(spark: SparkSession, target: str, build: Callable[[], DataFrame],
                  input_checks: Iterable[tuple[DataFrame, str, int]] = (),
                  output_checks: Iterable[tuple[Callable[[DataFrame], DataFrame], str, int]] = ()) -> None:
    """Check inputs, build beside the target, check the result, then swap it in.

    The old table stays whole when a check fails or a job dies before the swap.
    """
    check_counts(input_checks)
    staged = target + ".staged"
    build().write.mode("overwrite").parquet(staged)
    written = spark.read.parquet(staged)
    check_counts([(view(written), relation, count) for view, relation, count in output_checks])
    _swap(spark, staged, target)


def rows_past_mark(source: DataFrame, stored: DataFrame, mark: str, default, upto=None) -> DataFrame:
    """Source rows after the largest stored mark (or the default), up to an optional last one."""
    largest = max_or_default(stored, mark, default).scalar()
    rows = source.filter(F.col(mark) > largest)
    return rows.filter(F.col(mark) <= F.lit(upto)) if upto is not None else rows


def append_past_mark(spark: SparkSession, source: DataFrame, target: str, mark: str, default, upto=None,
                     partition_by: Iterable[str] = ()) -> None:
    """Append the rows past the target's high-water mark; a target not there yet counts as empty."""
    stored = spark.read.parquet(target) if path_exists(spark, target) else source.limit(0)
    sinks.append(rows_past_mark(source, stored, mark, default, upto), target, partition_by)


def append_new_rows(spark: SparkSession, incoming: DataFrame, target: str, keys: Iterable[str]) -> None:
    """Append the rows whose composite key the target lacks; a second run adds nothing."""
    rows = new_rows_only(incoming, spark.read.parquet(target), keys) if path_exists(spark, target) else incoming
    sinks.append(rows, target)


def apply_feedback(messages: DataFrame, feedback: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Messages with the last feedback given on each, null when there is none."""
    last = latest_per_key(feedback.select(*keys, *order, value), keys, order).select(*keys, value)
    return messages.join(last, keys, "left")
