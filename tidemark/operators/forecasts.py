"""Per-series forecasts. Input rows are ``series, period, value``, one per calendar period."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import sliding_windows
from tidemark.session import pin

# 80 % band of a normal distribution.
BAND = 1.2815515655446004


def monthly_series(df: DataFrame, series: str, stamp: str, value: str) -> DataFrame:
    """Monthly sums per series, by partial aggregation."""
    month = F.trunc(stamp, "MM").alias("period")
    known = df.filter(F.col(series).isNotNull() & F.col(stamp).isNotNull())
    return known.groupBy(F.col(series).alias("series"), month).agg(F.sum(value).alias("value"))


def _month_number(period):
    return (F.year(period) * 12 + F.month(period)).cast("double")


def forecast_bounds(df: DataFrame, periods: int = 3, band: float = BAND) -> DataFrame:
    """Fitted history and ``periods`` future months with ``lower`` and ``upper``.

    Linear trend per series plus the mean residual of the calendar month; the band comes from the
    spread of what is left. One scan and one shuffle after the monthly sums: all steps are windows
    over a series, which has at most one row per calendar month.
    """
    whole = Window.partitionBy("series")
    known = df.filter(F.col("value").isNotNull()).withColumn("x", _month_number("period")).withColumn("moy", F.month("period"))
    fitted = known.withColumns({
        "slope": F.coalesce(F.regr_slope("value", "x").over(whole), F.lit(0.0)),
        "intercept": F.coalesce(F.regr_intercept("value", "x").over(whole), F.avg("value").over(whole)),
        "last": F.max("period").over(whole),
    })
    fitted = fitted.withColumn("line", F.col("intercept") + F.col("slope") * F.col("x"))
    fitted = fitted.withColumn("season", F.avg(F.col("value") - F.col("line")).over(Window.partitionBy("series", "moy")))
    fitted = fitted.withColumn("pred", F.col("line") + F.col("season")).withColumns({
        "sd": F.stddev_pop(F.col("value") - F.col("line") - F.col("season")).over(whole),
        "seasons": F.collect_set(F.struct("moy", "season")).over(whole),
    })

    def ahead(step):
        period = F.add_months("last", step)
        season = F.get(F.filter("seasons", lambda s: s["moy"] == F.month(period)), F.lit(0))["season"]
        pred = F.col("intercept") + F.col("slope") * _month_number(period) + F.coalesce(season, F.lit(0.0))
        return F.struct(period.alias("period"), F.lit(None).cast("double").alias("value"), pred.alias("pred"))

    own = F.array(F.struct("period", "value", "pred"))
    future = F.transform(F.sequence(F.lit(1), F.lit(periods)), ahead)
    rows = fitted.select("series", "sd", F.inline(F.when(F.col("period") == F.col("last"), F.concat(own, future)).otherwise(own)))
    width = F.lit(band) * F.col("sd")
    return rows.select("series", "period", "value", "pred", (F.col("pred") - width).alias("lower"), (F.col("pred") + width).alias("upper"))


def lag_sums(df: DataFrame, length: int) -> DataFrame:
    """``series, mean, sums``: the sums of products of (1, inputs, target) over a series' training windows, row by row in one array.

    Values count from the series' mean, which keeps the products well scaled. Sums add up, in the tasks first and then over them, so a
    series sends (length + 2)^2 numbers a task however many windows it has. A series without windows has null sums.
    """
    means = pin(df.groupBy(F.col("series").alias("__s")).agg(F.avg("value").alias("mean")))
    windows = sliding_windows(df, length, "training").select("series", "inputs", "target")
    windows = windows.join(means, F.col("series").eqNullSafe(F.col("__s")))
    # The value one step back comes first.
    row = F.concat(F.array(F.lit(1.0)), F.transform(F.reverse("inputs"), lambda x: x - F.col("mean")), F.array(F.col("target") - F.col("mean")))
    products = windows.select("series", row.alias("v")).select(
        "series", array_to_vector(F.flatten(F.transform("v", lambda a: F.transform("v", lambda b: a * b)))).alias("p"))
    sums = products.groupBy(F.col("series").alias("__w")).agg(vector_to_array(Summarizer.sum(F.col("p"))).alias("sums"))
    return means.join(sums, F.col("__s").eqNullSafe(F.col("__w")), "left").select(F.col("__s").alias("series"), "mean", "sums")


def lag_model(df: DataFrame, length: int) -> DataFrame:
    """Least squares of the next value on the ``length`` values before it, one model per series.

    ``series, term, weight``; term 0 is the intercept, term ``j`` weighs the value ``j`` steps back. A series with fewer windows than
    terms has null weights; of equally good weights, as in a constant series, the smallest are taken. Only :func:`lag_sums` reads rows;
    what is solved per series is one small system.
    """
    sums = lag_sums(df, length)
    kind = df.schema["series"].dataType.simpleString()

    def solve(groups):
        import numpy as np
        import pandas as pd

        for group in groups:
            rows = []
            for series, mean, flat in zip(group["series"], group["mean"], group["sums"]):
                weights = [None] * (length + 1)
                if flat is not None and flat[0] >= length + 1:
                    table = np.asarray(flat, dtype="float64").reshape(length + 2, -1)
                    found = np.linalg.lstsq(table[:-1, :-1], table[:-1, -1], rcond=None)[0]
                    weights = [float(found[0] + mean - mean * found[1:].sum()), *map(float, found[1:])]
                rows += [(series, term, weight) for term, weight in enumerate(weights)]
            yield pd.DataFrame(rows, columns=["series", "term", "weight"]).astype({"weight": "float64"})

    fitted = sums.mapInPandas(solve, f"series {kind}, term int, weight double")
    return fitted.withColumn("weight", F.when(~F.isnan("weight"), F.col("weight")))


def _weights(df: DataFrame, length: int) -> DataFrame:
    listed = F.transform(F.sort_array(F.collect_list(F.struct("term", "weight"))), lambda r: r["weight"])
    known = lag_model(df, length).filter(F.col("weight").isNotNull())
    return known.groupBy(F.col("series").alias("__s")).agg(listed.alias("weights"))


def predict_windows(df: DataFrame, length: int, weights: DataFrame | None = None) -> DataFrame:
    """One-step predictions for every evaluation window: ``series, period, target, predicted``."""
    windows = sliding_windows(df, length, "evaluation")
    joined = windows.join(weights or _weights(df, length), F.col("series") == F.col("__s"))
    terms = F.zip_with(F.reverse("inputs"), F.slice("weights", F.lit(2), F.lit(length)), lambda a, b: a * b)
    predicted = F.aggregate(terms, F.get("weights", F.lit(0)), lambda acc, x: acc + x)
    return joined.select("series", "period", "target", predicted.alias("predicted"))


def recursive_forecast(df: DataFrame, length: int, steps: int = 30, weights: DataFrame | None = None) -> DataFrame:
    """``steps`` daily predictions past the end; each one joins the window of the next.

    Sequential within a series by nature and parallel across series. The state is an array of
    ``length`` values, rolled inside one row.
    """
    rank = F.row_number().over(Window.partitionBy("series").orderBy(F.col("period").desc()))
    tail = df.filter(F.col("value").isNotNull()).withColumn("k", rank).filter(F.col("k") <= length)
    recent = F.transform(F.sort_array(F.collect_list(F.struct("k", "value"))), lambda r: r["value"])
    state = tail.groupBy("series").agg(F.max("period").alias("last"), recent.alias("recent"))
    joined = state.filter(F.size("recent") == length).join(weights or _weights(df, length), F.col("series") == F.col("__s"))

    def roll(acc, _):
        terms = F.zip_with(F.slice(acc, F.lit(1), F.lit(length)), F.slice("weights", F.lit(2), F.lit(length)), lambda a, b: a * b)
        value = F.aggregate(terms, F.get("weights", F.lit(0)), lambda s, x: s + x)
        return F.concat(F.array(value), acc)

    run = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("recent"), roll)
    predictions = F.reverse(F.slice(run, F.lit(1), F.lit(steps)))
    rows = joined.select("series", "last", F.posexplode(predictions).alias("step", "predicted"))
    return rows.select("series", F.date_add("last", F.col("step") + 1).alias("period"), (F.col("step") + 1).alias("step"), "predicted")


def tagged_forecast(df: DataFrame, length: int, steps: int, names: list[str]) -> DataFrame:
    """``period, source`` and one column per series, with source PREDICTION, REAL or FUTURE."""
    df = pin(df)
    weights = pin(_weights(df, length))
    tested = predict_windows(df, length, weights)
    both = F.array(F.struct(F.lit("PREDICTION").alias("source"), F.col("predicted").alias("value")),
                   F.struct(F.lit("REAL").alias("source"), F.col("target").alias("value")))
    future = recursive_forecast(df, length, steps, weights)
    long = tested.select("period", "series", F.inline(both)).unionByName(
        future.select("period", "series", F.lit("FUTURE").alias("source"), F.col("predicted").alias("value")))
    return long.groupBy("period", "source").pivot("series", names).agg(F.avg("value")).orderBy("period", "source")
