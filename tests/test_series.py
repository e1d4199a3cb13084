"""Series operators: edge cases, brute force and properties."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates, forecasts, reshape, scaling, series

DAY = datetime.date(2024, 1, 1)


def long(spark, **named):
    rows = [(name, DAY + datetime.timedelta(days=i), v) for name, items in named.items() for i, v in enumerate(items)]
    return spark.createDataFrame(rows, "series string, period date, value double")


def column(df, name):
    return [r[name] for r in df.orderBy("series", "period").collect()]


def test_fills(spark):
    df = long(spark, a=[None, 1.0, None, 3.0, None], b=[None, None], c=[5.0])
    assert column(series.forward_fill(df), "filled") == [None, 1.0, 1.0, 3.0, 3.0, None, None, 5.0]
    assert column(series.fill_both(df), "filled") == [1.0, 1.0, 1.0, 3.0, 3.0, None, None, 5.0]
    assert column(series.fill_mean(df), "filled") == [None, 1.0, 2.0, 3.0, None, None, None, 5.0]


def test_chunked_fills_agree(spark):
    draw = random.Random(9)
    df = long(spark, **{f"s{k}": [draw.choice([None, None, None, float(i)]) for i in range(150)] for k in range(4)}, none=[None] * 70, one=[1.0])
    for fill in (series.forward_fill, series.fill_both, series.fill_mean):
        for chunk in (F.trunc("period", "MM"), F.lit(1), F.col("period")):
            assert column(fill(df, chunk=chunk), "filled") == column(fill(df), "filled")


def test_direction_and_runs(spark):
    df = long(spark, a=[1.0, 1.0, 2.0, 1.0], k=[4.0, 4.0])
    assert column(series.direction(df), "direction") == [0, 0, 1, -1, 0, 0]
    assert column(series.previous_run(df), "previous_run") == [None, None, 1.0, 2.0, None, None]
    assert column(series.previous_run(df), "run") == [1, 1, 2, 3, 1, 1]


def test_runs_over_nulls(spark):
    df = long(spark, a=[None, None, 2.0, None, 3.0])
    assert column(series.previous_run(df), "run") == [1, 1, 2, 3, 4]
    assert column(series.previous_run(df), "previous_run") == [None, None, None, 2.0, None]


def test_latest_and_previous(spark):
    df = long(spark, same=[2.0, 2.0], back=[1.0, 2.0, 1.0], gap=[7.0, 8.0, None], none=[None])
    rows = {r.series: (r.latest, r.previous) for r in series.latest_and_previous(df).collect()}
    assert rows == {"same": (2.0, None), "back": (1.0, 2.0), "gap": (8.0, 7.0)}


def test_newest_delta(spark):
    df = long(spark, one=[3.0], gap=[1.0, 4.0, None], two=[1.0, 4.0])
    kept = {r.series: (r.current, r.previous, r.delta) for r in series.newest_delta(df).collect()}
    assert kept == {"one": (3.0, None, None), "gap": (4.0, 1.0, 3.0), "two": (4.0, 1.0, 3.0)}
    raw = {r.series: (r.current, r.previous) for r in series.newest_delta(df, skip_nulls=False).collect()}
    assert raw["gap"] == (None, 4.0)


def test_trend_statistics(spark):
    df = long(spark, one=[3.0], zero=[0.0, 5.0, 10.0], none=[None, None], gap=[1.0, None, 2.0])
    rows = {r.series: (r.trend_growth, r.trend_var, round(r.trend_cv, 6)) for r in series.trend_statistics(df).collect()}
    assert rows["one"] == (0.0, 0.0, 0.0) and rows["none"] == (0.0, 0.0, 0.0)
    assert rows["zero"] == (50.0, 0.25, round(0.5 / 1.5, 6))
    assert rows["gap"] == (100.0, 0.0, 0.0)


def test_trend_against_brute_force(spark):
    draw = random.Random(5)
    data = {f"s{k}": [draw.choice([0.0, 1.0, 2.5, 4.0]) for _ in range(draw.randint(2, 20))] for k in range(20)}
    rows = {r.series: r for r in series.trend_statistics(long(spark, **data)).collect()}
    for name, items in data.items():
        growth = [(b - a) / a * 100 if a else 0.0 for a, b in zip(items, items[1:])]
        ratio = [b / a if a else 1.0 for a, b in zip(items, items[1:])]
        assert rows[name].trend_growth == pytest.approx(np.mean(growth))
        assert rows[name].trend_var == pytest.approx(np.var(ratio))
        assert rows[name].trend_cv == pytest.approx(np.std(ratio) / np.mean(ratio) if np.mean(ratio) else 0.0)


@pytest.mark.parametrize("n", [3, 4, 5])
def test_window_boundaries(spark, n):
    df, length = long(spark, a=[float(i) for i in range(n)]), 3
    assert series.sliding_windows(df, length, "training").count() == max(n - length, 0)
    assert series.sliding_windows(df, length, "features").count() == max(n - length, 0)
    assert series.sliding_windows(df, length, "evaluation").count() == max(n - length - 1, 0)
    for row in series.sliding_windows(df, length, "training").collect():
        assert row.inputs == [row.target - 3, row.target - 2, row.target - 1]


def test_scales(spark):
    df = long(spark, flat=[4.0, 4.0], one=[2.0], up=[0.0, 1.0, 2.0, 3.0, 4.0, 5.0])
    assert column(scaling.min_max(df), "scaled")[:3] == [0.0, 0.0, 0.0]
    robust = scaling.robust(df)
    assert column(robust, "scaled")[:3] == [4.0, 4.0, 2.0]
    assert column(robust, "scaled")[3:] == pytest.approx([i / 3.0 for i in range(6)])
    restored = robust.withColumn("back", scaling.inverse_robust())
    assert column(restored, "back") == pytest.approx(column(df, "value"))
    again = scaling.robust(robust.select("series", "period", F.col("scaled").alias("value")).filter("series = 'up'"))
    assert column(again, "scaled") == pytest.approx([i / 3.0 for i in range(6)])


def test_outer_merge_empty_series(spark):
    def one(items):
        return spark.createDataFrame([(DAY + datetime.timedelta(days=i), v) for i, v in items], "period date, value double")

    merged = reshape.outer_merge([("lead", one([])), ("a", one([(0, 1.0)])), ("late", one([])), ("b", one([(1, 2.0)]))])
    assert merged.columns == ["period", "a", "late", "b"]
    assert [tuple(r)[1:] for r in merged.orderBy("period").collect()] == [(1.0, None, None), (None, None, 2.0)]
    assert reshape.outer_merge([("x", one([]))]).columns == ["period"]


def test_pivot_round_trip(spark):
    df = spark.createDataFrame([("r", 1.0, 2.0), ("s", 3.0, 4.0)], "k string, a double, b double")
    back = reshape.pivot(reshape.unpivot(df, ["k"], ["a", "b"]), ["k"], "variable", ["a", "b"], "value")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_last_duplicate_period_wins(spark):
    df = spark.createDataFrame([("w", "2024-01", 1.0, 1), ("w", "2024-01", 9.0, 2), ("w", "2024-02", 3.0, 3)], "k string, p string, r double, o int")
    assert reshape.ratio_map(df, ["k"], "p", "r", "o").first().ratios == {"2024-01": 9.0, "2024-02": 3.0}


def test_category_pairs_share_a_partner(spark):
    left, right = long(spark, a=[1.0], b=[2.0], c=[3.0]), long(spark, x=[9.0])
    rows = series.category_pairs(left, right, {"a": "x", "b": "x", "c": "missing"}).collect()
    assert sorted((r.series, r.left, r.right) for r in rows) == [("a", 1.0, 9.0), ("b", 2.0, 9.0)]


def test_rollup_and_cube_totals(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", None, 2.0), ("b", "x", 4.0)], "p string, q string, v double")
    totals = {(r.p, r.q, r.level): r.total for r in aggregates.path_totals(df, ["p", "q"], "v").collect()}
    assert totals == {(None, None, 0): 5.0, ("a", None, 1): 1.0, ("b", None, 1): 4.0, ("a", "x", 2): 1.0, ("b", "x", 2): 4.0}
    facets = {(r.q, r.p): r.n for r in aggregates.facet_counts(df.withColumn("one", F.lit(1)), ["q", "p"], ["one"]).collect()}
    assert facets[("ALL", "ALL")] == 3 and facets[(None, "a")] == 1 and facets[("ALL", "a")] == 2


def test_condition_matrix_without_match(spark):
    df = spark.createDataFrame([("a", 2e6)], "k string, v double")
    rows = {r.category: r.v for r in aggregates.condition_matrix(df, {"a": F.col("k") == "a", "z": F.col("k") == "z"}, ["v"]).collect()}
    assert rows == {"a": 2.0, "z": 0.0}


def test_lag_model_against_numpy(spark):
    draw = random.Random(3)
    items = [draw.random() * 10 for _ in range(40)]
    df, length = long(spark, a=items), 7
    weights = [r.weight for r in forecasts.lag_model(df, length).orderBy("term").collect()]
    design = np.array([[1.0, *items[i:i + length][::-1]] for i in range(len(items) - length)])
    expected = np.linalg.lstsq(design, np.array(items[length:]), rcond=None)[0]
    assert weights == pytest.approx(list(expected))
    state, future = items[-length:], []
    for _ in range(5):
        future.append(float(expected[0] + np.dot(expected[1:], state[::-1])))
        state = [*state[1:], future[-1]]
    rows = forecasts.recursive_forecast(df, length, 5).orderBy("step").collect()
    assert [r.predicted for r in rows] == pytest.approx(future)
    assert rows[0].period == DAY + datetime.timedelta(days=40)


def test_forecast_of_a_straight_line(spark):
    rows = [("a", datetime.date(2020 + i // 12, i % 12 + 1, 1), 10.0 + 2 * i) for i in range(24)]
    df = spark.createDataFrame(rows, "series string, period date, value double")
    got = forecasts.forecast_bounds(df, 3).orderBy("period").collect()
    assert [round(r.pred, 6) for r in got[-3:]] == [58.0, 60.0, 62.0]
    assert all(r.lower <= r.pred <= r.upper for r in got) and len(got) == 27
    single = forecasts.forecast_bounds(df.limit(1), 2).collect()
    assert [r.pred for r in single] == [10.0, 10.0, 10.0]


def test_regression_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, 2.0), ("k", 2.0, 2.0), ("k", 2.0, 3.0)], "s string, y double, p double")
    rows = {r.s: (r.mse, r.r2) for r in aggregates.regression_metrics(df, ["s"], "y", "p").collect()}
    assert rows == {"a": (0.5, 0.5), "k": (0.5, None)}


def test_lag_model_of_short_and_constant_series(spark):
    df = long(spark, a=[5.0] * 20, b=[1.0, 2.0, 3.0], c=[2.0, 4.0, 6.0, 8.0, 10.0, 12.0])
    got = {}
    for r in forecasts.lag_model(df, 2).collect():
        got.setdefault(r.series, {})[r.term] = r.weight
    assert got["b"] == {0: None, 1: None, 2: None}
    assert got["a"][0] + 5 * (got["a"][1] + got["a"][2]) == pytest.approx(5.0)
    assert got["c"][0] + 12 * got["c"][1] + 10 * got["c"][2] == pytest.approx(14.0)
    assert {r.series for r in forecasts.recursive_forecast(df, 2, 3).collect()} == {"a", "c"}


def test_lag_sums_add_up_before_the_shuffle(spark):
    plan = forecasts.lag_sums(long(spark, a=[float(i) for i in range(30)]), 2)._jdf.queryExecution().executedPlan().toString()
    assert "partial_aggregate_metrics" in plan


@pytest.mark.parametrize("rows", [
    [("a", 5, n, float(n) if n % 7 == 0 else None) for n in range(4000)] + [("b", n, n, None) for n in range(50)] + [(None, n, n, float(n % 3) or None) for n in range(20)],
    [("a", n // 3, n, None if n < 40 or n % 2 else float(n)) for n in range(300)], []])
def test_fills_spread_a_hot_stamp(spark, rows, monkeypatch):
    """One stamp has all rows of a series: the scan cuts it into segments and fills as one pass over the whole series does."""
    pinned, keep = [], series.pin
    monkeypatch.setattr(series, "pin", lambda df: pinned.append(keep(df)) or pinned[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.createDataFrame([(s, (t, n), v, n) for s, t, n, v in rows], "series string, period struct<t: int, n: int>, value double, __segment int").repartition(6)
    for fill in (series.forward_fill, series.fill_both, series.fill_mean):
        spread = fill(df, spread=True)
        assert spread.columns == [*df.columns, "filled"]
        want = sorted(map(repr, map(tuple, fill(df).collect())))
        assert sorted(map(repr, map(tuple, spread.collect()))) == want
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    if len(rows) > 4000:  # the segments of the series that has one stamp
        assert pinned[1].where("__s = 'a'").count() >= 4


@pytest.mark.parametrize("values", [
    [0.0, 1.0, 2.0, 3.0], [7.0] * 50, [float(i * i) for i in range(3000)], [2.0 ** -i for i in range(200)], [0.0, 5e-324, 1e-323, 1.7e308, -1.7e308],
    [1.0, 1.0, None, 5.0, float("nan")], [3.0] * 4000 + [4.0]])
def test_quantiles_are_exact(spark, values):
    fractions = [0.0, 0.1, 0.5, 0.6, 0.99, 1.0]
    df = spark.createDataFrame([(s, v) for s in ("x", None) for v in values], "series string, value double").repartition(4)
    got = {(r.series, r.fraction): r.quantile for r in scaling.quantiles(df, fractions).collect()}
    known = sorted(v for v in values if v is not None and v == v)
    for s in ("x", None):
        for p in fractions:
            at = (len(known) - 1) * p
            low, high = known[int(at)], known[min(int(at) + (at > int(at)), len(known) - 1)]
            assert got[s, p] == pytest.approx(low * (1 - (at - int(at))) + high * (at - int(at)), rel=1e-12, abs=0)
    scaled = scaling.robust_raw(df, 0.5).collect()
    assert len(scaled) == 2 * len(values) and scaling.quantiles(df.limit(0), fractions).collect() == []
