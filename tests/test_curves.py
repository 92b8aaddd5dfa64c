import functools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adyield.operators import intervals, smoothing as sm
from adyield.plans import schedules


def series(spark, values, key="a"):
    return spark.createDataFrame([(key, i, float(v)) for i, v in enumerate(values)], "k string, ix int, y double")


def values_of(df, column):
    return np.array([r[column] for r in df.orderBy("k", "ix").collect()])


def dense_lowess(y, frac, first, passes=3):
    """Full matrices: every anchor against every point."""
    x = np.arange(len(y), dtype=float)
    d = np.abs(x[:, None] - x[None, :])
    h = np.sort(d, axis=1)[:, int(np.floor(len(x) * frac))]
    w = (1 - np.clip(d / h[:, None], 0, 1) ** 3) ** 3
    w = w / w.sum(axis=0)
    keep = np.ones(len(x))
    for i in range(passes):
        lines = []
        for row in w * keep:
            a = np.array([[row.sum(), (row * x).sum()], [(row * x).sum(), (row * x * x).sum()]])
            b = np.array([(row * y).sum(), (row * x * y).sum()])
            lines.append(np.linalg.lstsq(a, b, rcond=None)[0])
        lines = np.array(lines)
        fit = (w * (lines[:, :1] + lines[:, 1:] * x[None, :])).sum(axis=0)
        res = np.abs(y - fit)
        keep = (res < np.quantile(res, 0.682) * (first if i == 0 else 6)).astype(float)
    return fit


def test_lowess_equals_dense_form(spark):
    rnd = np.random.default_rng(1)
    y = np.sin(np.arange(168) / 20) * 5 + rnd.normal(size=168)
    y[[20, 90]] += 60  # outliers that the robust passes drop
    fitted = sm.lowess(series(spark, y), ["k"], "ix", {"fit": "y"}, 0.05, 5.0)
    np.testing.assert_allclose(values_of(fitted, "fit"), dense_lowess(y, 0.05, 5.0), rtol=1e-7, atol=1e-7)


def test_series_do_not_mix(spark):
    rnd = np.random.default_rng(2)
    a, b = rnd.random(60) * 9, rnd.random(70) * 5
    both = sm.lowess(series(spark, a, "a").unionByName(series(spark, b, "b")), ["k"], "ix", {"fit": "y"}, 0.1)
    alone = sm.lowess(series(spark, b, "b"), ["k"], "ix", {"fit": "y"}, 0.1)
    np.testing.assert_allclose(values_of(both.filter("k = 'b'"), "fit"), values_of(alone, "fit"))


@pytest.mark.parametrize("window, geometric", [(4, False), (16, False), (5, True), (16, True)])
def test_circular_means_equal_wrapped_convolution(spark, window, geometric):
    y = np.random.default_rng(3).random(48)
    if geometric:
        r = (window - 1) / window
        kernel = (1 - r) / (1 - r**window) * r ** np.arange(window)
    else:
        kernel = np.full(window, 1 / window)
    assert kernel.sum() == pytest.approx(1, abs=1e-12)
    expected = np.convolve(np.tile(y, 3), kernel, mode="same")[48:-48]
    got = sm.circular_mean(series(spark, y), ["k"], "ix", "y", "s", window, geometric)
    np.testing.assert_allclose(values_of(got, "s"), expected)


def test_spreading_outliers_keeps_the_sum(spark):
    y = [1.0] * 90 + [50.0, 80.0] + [2.0] * 8
    got = values_of(sm.spread_outliers(series(spark, y), ["k"], {"s": "y"}), "s")
    assert got.sum() == pytest.approx(sum(y), abs=1e-9)
    assert got.max() < 80


def test_modifiers_are_floored_to_steps(spark):
    rows = spark.createDataFrame([("a", i, 1.0 + i % 7, 10 + i % 3) for i in range(168)], "k string, ix int, rps double, sessions int")
    out = sm.add_modifiers(rows, ["k"], "ix", "rps", "sessions", sm.cema_transform(4), "cema").collect()
    for r in out:
        assert r["rps_cema_modifier"] == pytest.approx(np.floor(r["rps_cema"] / r["rps_cema_mean"] * 20) / 20)


def test_spline_error_stays_within_bound(spark):
    y = np.sin(np.arange(96) / 9) * 3 + np.random.default_rng(4).normal(size=96)
    got = values_of(sm.smoothing_spline(series(spark, y), ["k"], "ix", "y", "s", 60.0), "s")
    error = ((got - y) ** 2).sum()
    assert error <= 60.0 and error > 40.0
    assert (np.diff(got, 2) ** 2).sum() < (np.diff(y, 2) ** 2).sum() / 10


def best_split(x, w, k):
    """Smallest (error, bounds) over all splits into at most k intervals."""
    n = len(x)
    total = float((np.array(w) * np.array(x) ** 2).sum())

    def cost(a, b):
        xs, ws = np.array(x[a:b]), np.array(w[a:b])
        mean = (xs * ws).sum() / ws.sum()
        return round(1e9 * float((ws * (xs - mean) ** 2).sum()) / total)

    @functools.cache
    def solve(a, left):
        if a == n:
            return 0, ()
        if left == 0:
            return math.inf, ()
        best = None
        for b in range(a + 1, n + 1):
            e, bounds = solve(b, left - 1)
            candidate = (cost(a, b) + e, (b, *bounds))
            best = candidate if best is None or candidate < best else best
        return best

    steps, bounds = solve(0, k)
    return steps / 1e9 * total, bounds


def test_interval_fit_is_optimal(spark):
    rnd = random.Random(6)
    days = {day: [(i, rnd.choice([0.5, 0.75, 1.0, 1.5]), rnd.randrange(1, 9)) for i in range(14)] for day in range(3)}
    df = spark.createDataFrame([(day, i / 4, x, float(w)) for day, rows in days.items() for i, x, w in rows],
                               "dayofweek int, hourofday double, x double, w double")
    got = {r["dayofweek"]: (r["error"], tuple(r["bounds"])) for r in intervals.interval_fit(df, ["dayofweek"], "hourofday", "x", "w", 4).collect()}
    for day, rows in days.items():
        error, bounds = best_split([r[1] for r in rows], [r[2] for r in rows], 4)
        assert got[day][0] == pytest.approx(error, rel=1e-6, abs=1e-8)
        assert got[day][1] == bounds


@pytest.mark.parametrize("estimator", ["wavg", "left", "mid"])
def test_interval_bounds_do_not_depend_on_scale(spark, estimator):
    rnd = random.Random(8)
    slots = [(i / 4, 1 + 0.5 * math.sin(i / 9) + rnd.random() / 10, rnd.randrange(1, 9)) for i in range(96)]
    scales = [(1.0, 1.0), (1e9, 1.0), (1e12, 1.0), (1e-9, 1.0), (1.0, 1e8)]
    df = spark.createDataFrame([(day, h, x * by, w * much) for day, (much, by) in enumerate(scales) for h, x, w in slots],
                               "dayofweek int, hourofday double, x double, w double")
    bounds = [tuple(r["bounds"]) for r in intervals.interval_fit(df, ["dayofweek"], "hourofday", "x", "w", 7, estimator).collect()]
    assert len(bounds) == len(scales) and len(set(bounds)) == 1 and bounds[0][-1] == 96


def test_interval_table_covers_each_day(spark):
    rows = [(day, h / 4, 1.0 + (h // 10) % 3, 5.0) for day in range(7) for h in range(96)]
    df = spark.createDataFrame(rows, "dayofweek int, hourofday double, x double, w double")
    table = intervals.interval_table(df, [], "hourofday", "x", "w").collect()
    for day in range(7):
        mine = sorted((r for r in table if r["weekday_index"] == day), key=lambda r: r["interval_no"])
        assert mine[0]["hr_start_inclusive"] == 0 and mine[-1]["hr_end_exclusive"] == 24
        assert len(mine) == 7
        assert all(a["hr_end_exclusive"] == b["hr_start_inclusive"] for a, b in zip(mine, mine[1:]))


def test_weekly_schedule_starts_on_monday(spark):
    rows = [(d, h, q / 4, float(d * 1000 + h * 10 + q)) for d in range(7) for h in range(24) for q in range(4)]
    df = spark.createDataFrame(rows, "weekday int, hourofday int, hourfraction double, modifier double")
    week = schedules.weekly_schedule(df, [], "weekday", "hourofday", "hourfraction", "modifier").first()["schedule"]
    assert (len(week), len(week[0]), len(week[0][0])) == (7, 24, 4)
    assert week[0][0][0] == 1000.0 and week[6][5] == [50.0, 51.0, 52.0, 53.0]


def even_basis(x, low, high, segments, degree):
    """B-splines on even knots by their recursion, as a dense matrix."""
    at = np.clip((x - low) / (high - low) * segments, 0, None) if high > low else np.zeros_like(x)
    number = np.minimum(np.floor(at), segments - 1)
    knots = np.arange(-degree, segments + degree + 1)
    basis = np.array([[float(n == k) for k in knots[:-1]] for n in number])
    for d in range(1, degree + 1):
        basis = np.stack([(at - knots[j]) / d * basis[:, j] + (knots[j + d + 1] - at) / d * basis[:, j + 1] for j in range(basis.shape[1] - 1)], axis=1)
    return basis


@pytest.mark.parametrize("degree", [0, 1, 2, 3, 5])
def test_regression_spline_equals_least_squares(spark, degree):
    """Two series, one with several rows a place and gaps, against dense least squares on the same knots."""
    draw = np.random.default_rng(degree)
    rows, bound = [], 6.0
    for key, x in (("a", np.arange(90.0)), (None, np.sort(draw.choice(200, 150)).astype(float))):
        rows += [(key, float(i), float(np.sin(i / 15) * 3 + draw.normal(scale=0.2))) for i in x]
    df = spark.createDataFrame(rows + [("a", None, 1.0), ("a", 3.0, None), ("c", None, None)], "k string, ix double, y double")
    out = sm.regression_spline(df, ["k"], "ix", "y", "s", degree, bound)
    assert out.columns == ["k", "ix", "y", "s"] and out.count() == len(rows) + 3
    got = [tuple(r) for r in out.collect()]
    assert all(s is None for k, x, _, s in got if x is None or k == "c")
    for key in ("a", None):
        x, y, s = (np.array(v) for v in zip(*[(x, y, s) for k, x, y, s in got if k == key and x is not None and y is not None]))
        places = len(set(x))
        for rung in range(11):
            if rung and 2 ** rung + degree > places:
                break
            basis = even_basis(x, x.min(), x.max(), 2 ** rung, degree)
            want = basis @ np.linalg.lstsq(basis, y, rcond=None)[0]
            if ((want - y) ** 2).sum() <= bound:
                break
        assert s == pytest.approx(want, abs=1e-5)


def test_closest_spline_where_none_is_close_enough(spark):
    y = np.random.default_rng(2).normal(size=40)
    got = values_of(sm.regression_spline(series(spark, y), ["k"], "ix", "y", "s", 1, 1e-3, rungs=2), "s")
    basis = even_basis(np.arange(40.0), 0, 39, 4, 1)
    assert got == pytest.approx(basis @ np.linalg.lstsq(basis, y, rcond=None)[0], abs=1e-8)
    alone = spark.createDataFrame([("k", 7, 2.5)], "k string, ix int, y double")
    assert sm.regression_spline(alone, ["k"], "ix", "y", "s").first()["s"] == pytest.approx(2.5)
    assert sm.regression_spline(alone.limit(0), ["k"], "ix", "y", "s").count() == 0
    assert sm.regression_spline(alone, [], "ix", "y", "s", 2).first()["s"] == pytest.approx(2.5)
    with pytest.raises(ValueError):
        sm.regression_spline(alone, ["k"], "ix", "y", "s", 6)


def test_splines_work_their_series_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.createDataFrame([("a", i // 8, i % 8 / 4, i, float(i % 5), 3) for i in range(56)],
                                 "product string, dayofweek int, hourofday double, int_ix int, rps double, sessions long")
    for degree in (None, 3):
        before = seen.value
        schedules.spline_schedule(rows.mapInPandas(count, rows.schema), ["product"], 1.0, 1.0, degree=degree).collect()
        assert seen.value - before == 56
