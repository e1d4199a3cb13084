"""Operators on dated series.

Input contract: long rows ``series, period, value`` with one row per series and calendar period.
:func:`daily_series` makes them from raw rows by partial aggregation; what a per-series window
then sorts is bounded by the number of calendar periods, however many raw rows a series has.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import pin


def daily_series(df: DataFrame, series: str, stamp: str, value, statistic=F.avg) -> DataFrame:
    """One row per series and day."""
    period = F.to_date(stamp).alias("period")
    known = df.filter(F.col(series).isNotNull() & F.col(stamp).isNotNull())
    return known.groupBy(F.col(series).alias("series"), period).agg(statistic(value).alias("value"))


def _ordered(keys: Iterable[str] = ("series",), order: str = "period"):
    return Window.partitionBy(*keys).orderBy(order)


def _so_far():
    return _ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _from_here():
    return _ordered().rowsBetween(Window.currentRow, Window.unboundedFollowing)


def _known_around(df: DataFrame, chunk: Column | None, spread: bool = False) -> DataFrame:
    """Adds ``__back`` and ``__ahead``: the last known value up to the row, the next known from it on."""
    if spread:
        return _scanned(df)
    if chunk is None:
        return df.withColumns({
            "__back": F.last("value", ignorenulls=True).over(_so_far()),
            "__ahead": F.first("value", ignorenulls=True).over(_from_here()),
        })
    rows = df.withColumn("__chunk", chunk)
    joined = rows.join(_carried(rows, "__chunk"), F.col("series").eqNullSafe(F.col("__s")) & F.col("__chunk").eqNullSafe(F.col("__c")))
    inside = _ordered(("series", "__chunk"))
    back = F.last("value", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.first("value", ignorenulls=True).over(inside.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return joined.withColumns({"__back": F.coalesce(back, "__in"), "__ahead": F.coalesce(ahead, "__out")}).select(
        *df.columns, "__back", "__ahead")


def _carried(rows: DataFrame, chunk: str) -> DataFrame:
    """Per series and chunk, as ``__s, __c``: the last known value before the chunk and the next known after it."""
    stamp = F.when(F.col("value").isNotNull(), F.col("period"))
    ends = rows.groupBy("series", chunk).agg(F.max_by("value", stamp).alias("newest"), F.min_by("value", stamp).alias("oldest"))
    chunks = Window.partitionBy("series").orderBy(chunk)
    return ends.select(
        F.col("series").alias("__s"), F.col(chunk).alias("__c"),
        F.last("newest", ignorenulls=True).over(chunks.rowsBetween(Window.unboundedPreceding, -1)).alias("__in"),
        F.first("oldest", ignorenulls=True).over(chunks.rowsBetween(1, Window.unboundedFollowing)).alias("__out"))


def _scanner():
    """A function for the tasks: the last known value so far in each series, row by row, of sorted rows."""

    def _scan(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        series = carry = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = batch.column("series"), batch.column("value")
            carry = pa.nulls(1, values.type) if carry is None else carry
            # Place 0 is what the batch before hands over; a new series starts with nothing.
            before = pa.concat_arrays([keys.slice(0, 1) if series is None else series, keys.slice(0, len(keys) - 1)])
            same = pc.or_(pc.fill_null(pc.equal(keys, before), False), pc.and_(pc.is_null(keys), pc.is_null(before))).to_numpy(zero_copy_only=False)
            place = np.arange(len(keys)) + 1
            known = values.is_valid().to_numpy(zero_copy_only=False)
            first = np.maximum.accumulate(np.where(same, 0, place))
            last = np.maximum.accumulate(np.where(known, place, 0))
            held = pa.concat_arrays([carry, values])
            take = pa.array(last, mask=(last < first) & (first > 0))
            filled = held.take(take)
            series, carry = keys.slice(len(keys) - 1), filled.slice(len(keys) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, filled], names=[*batch.schema.names, "\0filled"])

    return _scan


def _scanned(df: DataFrame) -> DataFrame:
    """The same by a segmented scan: rows are ranged over partitions by (series, period), so a series or a stamp of any number of rows is
    many segments; each segment is scanned once in both directions where it lies, and what a segment ends with is carried to the next ones
    by a table of one row per series and partition. One shuffle; the second pass is a join with that small table."""
    kind = df.schema["value"].dataType
    there = F.struct("series", "period", "value", *(F.col(c).alias(f"\0{c}") for c in df.columns if c not in ("series", "period", "value")))
    rows = df.select(there.alias("r")).select("r.*")

    def scan(frame, out):
        made = frame.mapInArrow(_scanner(), T.StructType([*frame.schema.fields, T.StructField("\0filled", kind)]))
        return made.withColumnRenamed("\0filled", out)

    ranged = rows.repartitionByRange("series", "period").sortWithinPartitions("series", "period").withColumn("__segment", F.spark_partition_id())
    back = scan(ranged, "__back").sortWithinPartitions(F.desc("series"), F.desc("period"))
    placed = pin(scan(back, "__ahead"))
    carried = pin(_carried(placed, "__segment"))
    joined = placed.join(carried, F.col("series").eqNullSafe(F.col("__s")) & (F.col("__segment") == F.col("__c")))
    own = [F.col(c) if c in ("series", "period", "value") else F.col(f"\0{c}").alias(c) for c in df.columns]
    return joined.select(*own, F.coalesce("__back", "__in").alias("__back"), F.coalesce("__ahead", "__out").alias("__ahead"))


def forward_fill(df: DataFrame, out: str = "filled", chunk: Column | None = None, spread: bool = False) -> DataFrame:
    """Last known value; leading nulls stay.

    All fills take ``chunk`` for series too long for one task, such as raw rows instead of one per
    period: an expression that never decreases with ``period``, like its month. Then only a chunk
    is sorted together, and what is known before and after it comes from a small table of chunk ends.
    With ``spread`` nothing bounds the rows of a series or stamp: see :func:`_scanned`. ``period`` must tell a series' rows apart.
    """
    return _known_around(df, chunk, spread).withColumn(out, F.col("__back")).drop("__back", "__ahead")


def fill_both(df: DataFrame, out: str = "filled", chunk: Column | None = None, spread: bool = False) -> DataFrame:
    """Last known value, before the first one the next known."""
    return _known_around(df, chunk, spread).withColumn(out, F.coalesce("__back", "__ahead")).drop("__back", "__ahead")


def fill_mean(df: DataFrame, out: str = "filled", chunk: Column | None = None, spread: bool = False) -> DataFrame:
    """Mean of the previous and next known values; null when either side has none."""
    around = _known_around(df, chunk, spread)
    return around.withColumn(out, (F.col("__back") + F.col("__ahead")) / F.lit(2.0)).drop("__back", "__ahead")


def direction(df: DataFrame, out: str = "direction") -> DataFrame:
    """Sign of the change from the previous row, 0 on the first."""
    change = F.signum(F.col("value") - F.lag("value").over(_ordered()))
    return df.withColumn(out, F.coalesce(change, F.lit(0.0)).cast("int"))


def previous_run(df: DataFrame, out: str = "previous_run") -> DataFrame:
    """Run number of equal consecutive values, and the value of the run before."""
    started = F.when(F.col("value").eqNullSafe(F.lag("value").over(_ordered())) & (F.row_number().over(_ordered()) > 1), 0)
    flagged = df.withColumn("__start", F.coalesce(started, F.lit(1)))
    before = F.lag("value").over(_ordered())
    flagged = flagged.withColumn("__before", F.when(F.col("__start") == 1, F.struct(before.alias("v"))))
    return (
        flagged.withColumn("run", F.sum("__start").over(_so_far()))
        .withColumn(out, F.last("__before", ignorenulls=True).over(_so_far())["v"])
        .drop("__start", "__before")
    )


def latest_and_previous(df: DataFrame) -> DataFrame:
    """Latest known value per series and the most recent value different from it.

    Two rounds of ``max_by`` with partial aggregation; no window, so raw rows of any number will do.
    Of several values at one period the largest counts.
    """
    known = df.filter(F.col("value").isNotNull())
    newest = known.groupBy("series").agg(F.max(F.struct("period", "value")).alias("l"))
    latest = newest.select(F.col("series").alias("__s"), F.col("l.value").alias("__latest"))
    others = known.join(latest, (F.col("series") == F.col("__s")) & (F.col("value") != F.col("__latest")))
    previous = others.groupBy("series").agg(F.max(F.struct("period", "value")).alias("p"))
    return newest.join(previous, "series", "left").select(
        "series", F.col("l.period").alias("latest_period"), F.col("l.value").alias("latest"),
        F.col("p.period").alias("previous_period"), F.col("p.value").alias("previous"))


def newest_delta(df: DataFrame, skip_nulls: bool = True) -> DataFrame:
    """Newest value, the one before, and their difference; a series of one row has no previous."""
    rows = df.filter(F.col("value").isNotNull()) if skip_nulls else df
    rank = F.row_number().over(Window.partitionBy("series").orderBy(F.col("period").desc()))
    ranked = rows.withColumn("__rank", rank).filter(F.col("__rank") <= 2)
    return ranked.groupBy("series").agg(
        F.max(F.when(F.col("__rank") == 1, F.col("value"))).alias("current"),
        F.max(F.when(F.col("__rank") == 2, F.col("value"))).alias("previous"),
    ).withColumn("delta", F.col("current") - F.col("previous"))


def trend_steps(df: DataFrame) -> DataFrame:
    """Per row the previous known value, growth in percent (0 after a zero) and ratio (1 after a zero).

    Null where the row or everything before it is null.
    """
    before = _ordered().rowsBetween(Window.unboundedPreceding, -1)
    steps = df.withColumn("previous", F.last("value", ignorenulls=True).over(before))
    valid = F.col("value").isNotNull() & F.col("previous").isNotNull()
    ratio = F.col("value") / F.nullif(F.col("previous"), F.lit(0.0))
    growth = (F.col("value") - F.col("previous")) / F.nullif(F.col("previous"), F.lit(0.0)) * 100.0
    return steps.withColumn("growth", F.when(valid, F.coalesce(growth, F.lit(0.0)))).withColumn(
        "ratio", F.when(valid, F.coalesce(ratio, F.lit(1.0))))


def trend_statistics(df: DataFrame) -> DataFrame:
    """Mean growth, ratio variance and ratio coefficient of variation per series, 0 under two points."""
    stats = trend_steps(df).groupBy("series").agg(
        F.avg("growth").alias("g"), F.var_pop("ratio").alias("v"),
        F.stddev_pop("ratio").alias("s"), F.avg("ratio").alias("m"))
    cv = F.col("s") / F.nullif(F.col("m"), F.lit(0.0))
    return stats.select(
        "series", F.coalesce("g", F.lit(0.0)).alias("trend_growth"),
        F.coalesce("v", F.lit(0.0)).alias("trend_var"), F.coalesce(cv, F.lit(0.0)).alias("trend_cv"))


def category_pairs(left: DataFrame, right: DataFrame, mapping: dict[str, str], names=("left", "right")) -> DataFrame:
    """Two families of series joined per category and period through a category map.

    ``mapping`` takes a left category to its right one; the join is one equi-join on both columns.
    """
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    mapped = left.select("series", "period", F.col("value").alias(names[0]),
                         F.try_element_at(F.create_map(*pairs), F.col("series")).alias("__other"))
    other = right.select(F.col("series").alias("__other"), "period", F.col("value").alias(names[1]))
    return mapped.filter(F.col("__other").isNotNull()).join(other, ["__other", "period"]).drop("__other")


def sliding_windows(df: DataFrame, length: int, boundary: str = "features") -> DataFrame:
    """Arrays of ``length`` consecutive values and the value after them.

    ``boundary``: ``features`` and ``training`` keep every window that has a next value;
    ``evaluation`` leaves out the last of them.
    """
    inputs = F.collect_list("value").over(_ordered().rowsBetween(-length, -1))
    following = F.lead(F.lit(1)).over(_ordered())
    rows = df.filter(F.col("value").isNotNull()).withColumn("inputs", inputs).withColumn("__more", following)
    rows = rows.filter(F.size("inputs") == length)
    if boundary == "evaluation":
        rows = rows.filter(F.col("__more").isNotNull())
    return rows.drop("__more").withColumnRenamed("value", "target")


def future_spine(df: DataFrame, steps: int, unit: str = "day") -> DataFrame:
    """``steps`` periods after the last one of each series: next days, or next month starts."""
    last = df.groupBy("series").agg(F.max("period").alias("last"))
    step = F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")
    spine = last.select("series", "last", step)
    if unit == "day":
        ahead = F.date_add("last", F.col("step"))
    elif unit == "month_end":
        ahead = F.last_day(F.add_months(F.col("last"), F.col("step")))
    else:
        ahead = F.add_months(F.trunc("last", "MM"), F.col("step"))
    return spine.select("series", F.col("step").cast("bigint").alias("step"), ahead.alias("period"))


def trailing_months(df: DataFrame, stamp: str, months: int) -> DataFrame:
    """Rows within ``months`` of the newest stamp in the data; the bound is a scalar subquery."""
    span = F.make_ym_interval(F.lit(0), F.lit(months))
    return df.filter(F.col(stamp) >= df.agg(F.max(stamp) - span).scalar())


def trailing_days(df: DataFrame, stamp: str, as_of, days: int) -> DataFrame:
    """Rows later than ``days`` before a given instant; the instant is always an argument."""
    return df.filter(F.col(stamp) > as_of - F.expr(f"INTERVAL {int(days)} DAYS"))


def active_at(df: DataFrame, start: str, end: str, instant: Column) -> DataFrame:
    return df.filter((F.col(start) <= instant) & (F.col(end) >= instant))


def contained_in(df: DataFrame, start: str, end: str, lower: Column, upper: Column) -> DataFrame:
    return df.filter((F.col(start) >= lower) & (F.col(end) <= upper))
