"""Best split of a day's slots into a few intervals with one modifier each."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Weekday names of the modifier table, Sunday first.
WEEKDAYS = ["SUN", "MON", "TUE", "WED", "THR", "FRI", "SAT"]
# Costs are shares of the day's weighted sum of squares, so neither large weights nor large values move a bound.
COST_STEPS = 1e9


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to an expression that reads it many times."""
    return F.transform(F.array(value), body)[0]


def _between(points: Column, field: str, left: Column, right: Column) -> Column:
    return points[right][field] - points[left][field]


def _interval_value(points: Column, left: Column, right: Column, estimator: str) -> Column:
    if estimator == "left":
        return points[left + 1]["value"]
    if estimator == "mid":
        return points[F.floor((left + right) / 2).cast("int") + 1]["value"]
    return F.try_divide(_between(points, "wx", left, right), _between(points, "w", left, right))


def _day_total(points: Column) -> Column:
    return points[F.size(points) - 1]["wxx"]


def _interval_cost(points: Column, left: Column, right: Column, estimator: str) -> Column:
    """Weighted squared error of one interval in whole 1e-9 shares of the day's total, so that equal splits tie exactly."""
    value = _interval_value(points, left, right, estimator)
    error = (_between(points, "wxx", left, right) - F.lit(2.0) * value * _between(points, "wx", left, right)
             + value * value * _between(points, "w", left, right))
    return F.coalesce(F.rint(F.try_divide(error, _day_total(points)) * F.lit(COST_STEPS)), F.lit(0.0))


def interval_fit(days: DataFrame, keys: Sequence[str], order: str, value: str, weight: str, intervals: int = 7,
                 estimator: str = "wavg") -> DataFrame:
    """Bounds of at most ``intervals`` contiguous intervals with the least weighted squared error.

    ``keys`` identify one day (at most 96 slots, gathered as an array of running sums). The rounds of
    the dynamic program are folds over that array; among equal errors the smallest bound list wins.
    """
    running = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    w, x = F.col(weight).cast("double"), F.col(value).cast("double")
    sums = days.select(*keys, F.struct(
        F.col(order).cast("double").alias("start"), F.sum(w).over(running).alias("w"),
        F.sum(w * x).over(running).alias("wx"), F.sum(w * x * x).over(running).alias("wxx"),
        x.alias("value")).alias("point"))
    zero = F.lit(0.0)
    origin = F.struct(F.lit(-1.0).alias("start"), zero.alias("w"), zero.alias("wx"), zero.alias("wxx"), zero.alias("value"))
    gathered = sums.groupBy(*keys).agg(F.collect_list("point").alias("points"))
    empty = F.array().cast("array<int>")

    def solve(points: Column) -> Column:
        last = F.size(points) - 1
        done = F.struct(F.lit(False).alias("short"), F.lit(0.0).alias("error"), empty.alias("bounds"))
        # a split that does not reach the day's end is short, which counts before any error
        start = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
            (i < last).alias("short"), F.lit(0.0).alias("error"), empty.alias("bounds")))

        def rounds(costs: Column) -> Column:
            def one_round(best: Column, _round: Column) -> Column:
                def from_left(row: Column, left: Column) -> Column:
                    # right bounds differ between candidates, so they settle every tie
                    choice = F.array_min(F.transform(row, lambda cost, i: F.struct(
                        best[left + i + 1]["short"].alias("short"), (cost + best[left + i + 1]["error"]).alias("error"), (left + i + 1).alias("right"))))
                    return _bind(choice, lambda c: F.struct(
                        c["short"].alias("short"), c["error"].alias("error"), F.concat(F.array(c["right"]), best[c["right"]]["bounds"]).alias("bounds")))

                return F.concat(F.transform(costs, from_left), F.array(done))

            return F.aggregate(F.sequence(F.lit(1), F.lit(intervals)), start, one_round)[0]

        costs = F.transform(F.sequence(F.lit(0), last - 1), lambda left: F.transform(
            F.sequence(left + 1, last), lambda right: _interval_cost(points, left, right, estimator)))
        return F.struct(points.alias("points"), _bind(costs, rounds).alias("best"))

    fitted = gathered.withColumn("fit", _bind(F.concat(F.array(origin), F.array_sort("points")), solve))
    return fitted.select(*keys, F.col("fit.points").alias("points"), F.col("fit.best.bounds").alias("bounds"),
                         (F.col("fit.best.error") / F.lit(COST_STEPS) * _day_total(F.col("fit.points"))).alias("error"))


def interval_table(days: DataFrame, keys: Sequence[str], order: str, value: str, weight: str, intervals: int = 7,
                   estimator: str = "wavg", day: str = "dayofweek") -> DataFrame:
    """One row per interval: weekday, start hour, end hour, modifier."""
    fitted = interval_fit(days, [*keys, day], order, value, weight, intervals, estimator)
    rows = fitted.select("*", F.posexplode("bounds").alias("interval_no", "right"))
    left = F.when(F.col("interval_no") == 0, F.lit(0)).otherwise(F.try_element_at("bounds", F.col("interval_no")))
    rows = rows.withColumn("left", left)
    points = F.col("points")
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    # the slot after bound i sits at array position i + 1 because of the leading origin
    return rows.select(
        *keys, F.col(day).alias("weekday_index"), F.element_at(names, F.col(day) + 1).alias("weekday"), "interval_no",
        points[F.col("left") + 1]["start"].alias("hr_start_inclusive"),
        F.coalesce(F.get(points, F.col("right") + 1)["start"], F.lit(24.0)).alias("hr_end_exclusive"),
        _interval_value(points, F.col("left"), F.col("right"), estimator).alias("modifier"))


def interval_curve(days: DataFrame, table: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Slots with their interval's modifier next to the original value."""
    bounds = table.select(*keys, F.col("weekday_index").alias("dayofweek"), "hr_start_inclusive", "hr_end_exclusive",
                          F.col("modifier").alias(f"{value}_interval"))
    joined = days.join(bounds, [*keys, "dayofweek"])
    inside = (F.col(order) >= F.col("hr_start_inclusive")) & (F.col(order) < F.col("hr_end_exclusive"))
    return joined.filter(inside).drop("hr_start_inclusive", "hr_end_exclusive")
