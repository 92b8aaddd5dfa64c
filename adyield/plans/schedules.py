"""Time-of-day modifier tables and schedules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adyield.functions.numeric import round_to_twentieth, scaled_modifier
from adyield.functions.timeparts import SLOTS_PER_DAY, monday_first
from adyield.operators import intervals, ordered, smoothing as sm, slots
from adyield.session import checkpointed

ALL = "ALL"


def with_overall(facts: DataFrame, column: str) -> DataFrame:
    """Every row once under its own value and once under ALL."""
    return facts.withColumn(column, F.explode(F.array(F.col(column), F.lit(ALL))))


def interval_modifiers(facts: DataFrame, traffic_source: str, calculation_ts, daily_intervals: int = 7) -> DataFrame:
    """Interval bid modifiers per product and for all products together."""
    series = slots.quarter_hour_user_tz(with_overall(facts, "product"), ["product"])
    curves = sm.add_modifiers(series, ["product"], "int_ix", "rps", "sessions", sm.lowess_transform(), "lowess")
    table = intervals.interval_table(curves, ["product"], "hourofday", "rps_lowess_modifier", "sessions_lowess",
                                     daily_intervals)
    return table.withColumns({"traffic_source": F.lit(traffic_source),
                              "calculation_date": F.lit(str(calculation_ts)).cast("timestamp_ntz")})


def hourly_curves(facts: DataFrame) -> DataFrame:
    """Hourly slots with both smoothers' modifiers."""
    hours = slots.hourly_rollup(slots.quarter_hour_user_tz(facts))
    with_cema = sm.add_modifiers(hours, [], "int_ix", "rps", "sessions", sm.cema_transform(4), "cema")
    return sm.add_modifiers(with_cema, [], "int_ix", "rps", "sessions", sm.lowess_transform(), "lowess")


def hourly_schedule(curves: DataFrame, date, modifier: str = "rps_cema_modifier") -> DataFrame:
    """One JSON object of parallel day, hour and modifier lists (168 entries)."""
    entry = F.struct(F.col("dayofweek").alias("day"), F.col("hourofday").alias("hour"),
                     F.col(modifier).alias("bid_modifier"))
    gathered = curves.agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    schedule = F.to_json(F.struct(*[F.col(f"entries.{c}").alias(c) for c in ("day", "hour", "bid_modifier")]))
    return gathered.select(F.lit(str(date)).cast("date").alias("date"), schedule.alias("schedule"))


def bag_curves(facts: DataFrame, keys: Sequence[str] = (), ts: str = "user_ts", revenue: str = "revenue") -> DataFrame:
    """Bag revenue rate per slot, capped at its 99th percentile and smoothed, with the overall mean.

    The mean is weighted by the smoothed number of sessions.
    """
    split = ordered.split_to_intervals(ordered.bag_positions(facts, ts, revenue, keys=keys), keys)
    split = split.na.fill(0.0, subset=["bag_rps"])
    capped = sm.clip_quantiles(split, keys, "bag_rps", 0.0, 0.99)
    fitted = sm.lowess(capped, keys, "ix", {"rps_fit": "bag_rps", "sessions_fit": "sessions"}, 0.03,
                       {"rps_fit": 5.0, "sessions_fit": 6.0})
    series = Window.partitionBy(*keys)
    mean = F.try_divide(F.sum(F.col("rps_fit") * F.col("sessions_fit")).over(series), F.sum("sessions_fit").over(series))
    return fitted.withColumn("mean_rps", mean).withColumn("modifier", F.try_divide("rps_fit", "mean_rps"))


def weekly_schedule(curves: DataFrame, keys: Sequence[str], day: str, hour: str, fraction: str,
                    modifier: str) -> DataFrame:
    """Monday-first 7 x 24 x 4 lists of modifiers; a quarter hour without sessions holds NULL."""
    slot = monday_first(F.col(day)) * SLOTS_PER_DAY + F.col(hour) * 4 + F.col(fraction) * 4
    known = curves.groupBy(*keys).agg(F.map_from_entries(F.collect_list(
        F.struct(slot.cast("int").alias("slot"), F.col(modifier).alias("modifier")))).alias("known"))

    def quarters(day_no: Column, hour_no: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: F.try_element_at(
            "known", day_no * SLOTS_PER_DAY + hour_no * 4 + q))

    week = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda d: F.transform(
        F.sequence(F.lit(0), F.lit(23)), lambda h: quarters(d, h)))
    return known.select(*keys, week.alias("schedule"))


def spline_schedule(series: DataFrame, keys: Sequence[str], rps_error: float, sessions_error: float,
                    scales: Sequence[float] = (0.75, 0.5, 0.25), degree: int | None = None) -> DataFrame:
    """Clipped, spline-smoothed slot modifiers in 0.05 steps with damped variants, Monday first.

    With ``degree`` the curves are splines of that degree with the fewest segments, else the smoothest curves within the bounds.
    """
    curve = checkpointed(sm.clip_quantiles(series, keys, "rps", 0.001, 0.999))
    for column, error in (("rps", rps_error), ("sessions", sessions_error)):
        if degree is None:
            curve = sm.smoothing_spline(curve, keys, "int_ix", column, f"{column}_spline", error)
        else:
            curve = sm.regression_spline(curve, keys, "int_ix", column, f"{column}_spline", degree, error)
    week = Window.partitionBy(*keys)
    mean = F.sum(F.col("sessions_spline") * F.col("rps_spline")).over(week) / F.sum("sessions_spline").over(week)
    curve = curve.withColumn("rps_mean", mean).withColumn("modifier", F.col("rps_spline") / F.col("rps_mean"))
    names = {s: f"modifier_{str(s).replace('.', '').lstrip('0')}" for s in scales}
    curve = curve.withColumns({name: scaled_modifier(F.col("modifier"), s) for s, name in names.items()})
    return curve.withColumns({
        "modifier": round_to_twentieth(F.col("modifier")), "dayofweek": monday_first(F.col("dayofweek")),
        "baseline": F.lit(1)})
