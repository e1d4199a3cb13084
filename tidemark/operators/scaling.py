"""Fitted scales and their inverses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import pin


def _by_bounds(df: DataFrame, low, high) -> DataFrame:
    bounds = df.groupBy(F.col("series").alias("__s")).agg(low.alias("low"), high.alias("high"))
    return df.join(bounds, F.col("series") == F.col("__s")).drop("__s")


def min_max(df: DataFrame) -> DataFrame:
    """``scaled`` in 0..1 per series with its ``low`` and ``high``; a constant series gives 0."""
    span = F.col("high") - F.col("low")
    scaled = F.when(span != 0, (F.col("value") - F.col("low")) / F.nullif(span, F.lit(0.0))).otherwise(F.when(span == 0, 0.0))
    return _by_bounds(df, F.min("value"), F.max("value")).withColumn("scaled", scaled)


def inverse_min_max(scaled="scaled", low="low", high="high"):
    return F.col(scaled) * (F.col(high) - F.col(low)) + F.col(low)


def robust(df: DataFrame, quantile: float = 0.6, accuracy: int | None = None) -> DataFrame:
    """``scaled`` by minimum and an upper percentile per series; unchanged when they are equal.

    The exact percentile interpolates and keeps a count per distinct value, which suits series of
    one row per period; give ``accuracy`` for the approximate one over raw rows.
    """
    high = F.percentile("value", quantile) if accuracy is None else F.percentile_approx("value", quantile, accuracy).cast("double")
    span = F.col("high") - F.col("low")
    scaled = F.when(span != 0, (F.col("value") - F.col("low")) / F.nullif(span, F.lit(0.0))).otherwise(F.col("value"))
    return _by_bounds(df, F.min("value"), high).withColumn("scaled", scaled)


#: Ranges that a value range is cut into in each pass.
BINS = 1024


def quantiles(df: DataFrame, fractions: list[float]) -> DataFrame:
    """``series, fraction, quantile``: exact percentiles, interpolated as ``percentile`` does, over series of any number of rows.

    Values are counted, not sorted or gathered. A pass cuts the range that holds a wanted rank into 1024, counts the rows of each and
    goes on with the one that has the rank, between its own least and greatest value, until these are equal. Counts are added up in the
    tasks, so a series sends at most 1024 rows a rank and task, however hot it is. Null and NaN values are left out; null is a series.
    """
    rows = df.select("series", F.col("value").cast("double").alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
    whole = pin(rows.groupBy("series").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")))
    wanted = whole.select("series", "n", "low", "high", F.explode(F.array(*map(F.lit, fractions))).alias("fraction"))
    at = (F.col("n") - 1) * F.col("fraction")
    wanted = wanted.withColumn("at", at)
    # The ranks on both sides of the place, each found once; `rank` counts from 0 inside the range.
    ranks = wanted.select("series", "low", "high", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank")).distinct()
    ranks = pin(ranks.select("series", "rank", F.col("rank").alias("inside"), "low", "high"))
    while not ranks.where("low < high").isEmpty():
        ranks = pin(_narrowed(rows, ranks))
    found = ranks.select(F.col("series").alias("__s"), "rank", F.col("low").alias("v"))
    lower, upper = found.withColumnsRenamed({"v": "below"}), found.withColumnsRenamed({"v": "above", "__s": "__u", "rank": "next"})
    both = wanted.join(lower, F.col("series").eqNullSafe(F.col("__s")) & (F.floor("at") == F.col("rank")))
    both = both.join(upper, F.col("series").eqNullSafe(F.col("__u")) & (F.ceil("at") == F.col("next")))
    share = F.col("at") - F.floor("at")
    return both.select("series", "fraction", F.when(share == 0, F.col("below")).otherwise(
        F.col("below") * (1 - share) + F.col("above") * share).alias("quantile"))


def _narrowed(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """Each rank with the bin it falls into; ranks that are found stay. Equal ranges of a series are counted once."""
    open_ = ranks.where("low < high")
    spans = pin(open_.select(F.col("series").alias("__s"), F.struct("low", "high").alias("span")).distinct().groupBy("__s").agg(F.collect_list("span").alias("spans")))
    hit = rows.join(spans, F.col("series").eqNullSafe(F.col("__s")))
    inside = hit.select("series", "value", F.explode(F.filter("spans", lambda s: F.col("value").between(s["low"], s["high"]))).alias("span"))
    # Half the range is taken first, so that the widest ranges of doubles do not overflow.
    place = (F.col("value") / 2 - F.col("span.low") / 2) / (F.col("span.high") / 2 - F.col("span.low") / 2)
    ends = F.when(F.col("value") == F.col("span.low"), 0).when(F.col("value") == F.col("span.high"), BINS - 1)
    each = inside.withColumn("bin", ends.otherwise(F.least(F.floor(place * BINS), F.lit(BINS - 1))).cast("int"))
    counted = each.groupBy("series", "span", "bin").agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("least"), F.max("value").alias("greatest"))
    before = Window.partitionBy("series", "span").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = counted.select(F.col("series").alias("__s"), "span", "rows", "least", "greatest", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    same = F.col("series").eqNullSafe(F.col("__s")) & (F.col("low") == F.col("span.low")) & (F.col("high") == F.col("span.high"))
    falls = (F.col("inside") >= F.col("before")) & (F.col("inside") < F.col("before") + F.col("rows"))
    moved = open_.join(bins, same & falls).select("series", "rank", (F.col("inside") - F.col("before")).alias("inside"),
                                                  F.col("least").alias("low"), F.col("greatest").alias("high"))
    return ranks.where("low = high").unionByName(moved)


def robust_raw(df: DataFrame, quantile: float = 0.6) -> DataFrame:
    """:func:`robust` for series of raw rows: the exact percentile comes from :func:`quantiles`, and no series meets in one task."""
    ends = quantiles(df, [0.0, quantile])
    bounds = pin(ends.groupBy(F.col("series").alias("__s")).agg(
        F.max(F.when(F.col("fraction") == 0.0, F.col("quantile"))).alias("low"), F.max(F.when(F.col("fraction") == quantile, F.col("quantile"))).alias("high")))
    span = F.col("high") - F.col("low")
    scaled = F.when(span != 0, (F.col("value") - F.col("low")) / F.nullif(span, F.lit(0.0))).otherwise(F.col("value"))
    return df.join(bounds, F.col("series").eqNullSafe(F.col("__s")), "left").drop("__s").withColumn("scaled", scaled)


def inverse_robust(scaled="scaled", low="low", high="high"):
    span = F.col(high) - F.col(low)
    return F.when(span != 0, F.col(scaled) * span + F.col(low)).otherwise(F.col(scaled))
