"""Quarter-hour aggregates of located sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adyield.functions.numeric import money_ratio
from adyield.functions.timeparts import day_of_week, hour_fraction, quarter_hour, to_local, utc_offset
from adyield.operators.joins import locate_sessions, revenue_per_session


def session_conversions(sessions: DataFrame, revenue: DataFrame, blocks: DataFrame,
                        locations: DataFrame) -> DataFrame:
    """Located sessions with revenue and the visitor's own wall clock."""
    places = locations.select("maxmind_id", "country_iso_code", "time_zone", "subdivision_1_iso_code")
    narrow = blocks.select("ip_index", "start_int", "end_int", "maxmind_id")
    placed = locate_sessions(sessions, narrow, places)
    local = to_local(F.col("creation_date"), F.col("time_zone"))
    joined = placed.join(revenue_per_session(revenue), "session_id")
    return joined.withColumn("user_ts", local).select(
        "session_id", "product", "traffic_source", F.col("creation_date").alias("utc_ts"),
        utc_offset(F.col("creation_date"), F.col("user_ts")).alias("utc_offset"), "time_zone", "user_ts",
        F.col("subdivision_1_iso_code").alias("state"), "revenue", "revenue_units",
        day_of_week(F.col("user_ts")).alias("weekday"), F.hour("user_ts").alias("hourofday"),
        hour_fraction(F.col("user_ts")).alias("hourfraction"))


def with_row_index(df: DataFrame, order: list[str], name: str = "int_ix", keys: list[str] | None = None) -> DataFrame:
    """0-based position in sort order; for slot tables (at most a week of slots per series)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*(keys or [])).orderBy(*order)) - 1)


def _slot_totals(facts: DataFrame, ts: str, keys: list[str]) -> DataFrame:
    """Sums per slot with distinct days and distinct sessions, in three map-combined steps.

    Rows are first folded per session and slot (no row is expanded for the two distinct counts),
    then per slot and day, then per slot, so that a busy slot arrives as one row per day and task.
    """
    slot = [*keys, "dayofweek", "hourofday"]
    per_session = facts.select(
        *keys, "session_id", day_of_week(F.col(ts)).alias("dayofweek"), quarter_hour(F.col(ts)).alias("hourofday"),
        F.to_date(ts).alias("day"), "revenue_units",
    ).groupBy("session_id", *slot).agg(
        F.collect_set("day").alias("days"), F.count("session_id").alias("n"),
        F.sum(F.coalesce((F.col("revenue_units") > 0).cast("long"), F.lit(0).cast("long"))).alias("positive"),
        F.count("revenue_units").alias("valued"), F.sum("revenue_units").alias("units"))
    first = F.when(F.col("pos") == 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    per_day = per_session.select("*", F.posexplode("days").alias("pos", "day")).groupBy(*slot, "day").agg(
        F.sum(first).alias("distinct_sessions"), *[F.sum(F.col(c) * first).alias(c)
                                                   for c in ("n", "positive", "valued", "units")])
    return per_day.groupBy(*slot).agg(
        F.count("day").alias("days_samplesize"),
        *[F.sum(c).alias(c) for c in ("distinct_sessions", "n", "positive", "valued", "units")])


def quarter_hour_user_tz(facts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Slots in the visitor's zone: days, sessions, sessions that earned, revenue per distinct session."""
    keys = keys or []
    totals = _slot_totals(facts, "user_ts", keys).select(
        *keys, "dayofweek", "hourofday", "days_samplesize", F.col("n").alias("sessions"),
        F.col("positive").cast("double").alias("conversions"),
        money_ratio(F.col("units"), F.col("distinct_sessions")).alias("rps"))
    return with_row_index(totals, ["dayofweek", "hourofday"], keys=keys)


def _rate_columns(totals: DataFrame, sessions, keys: list[str]) -> DataFrame:
    return totals.select(
        *keys, "dayofweek", "hourofday", "days_samplesize", sessions.alias("sessions"),
        F.col("valued").alias("conversions"),
        money_ratio(F.col("valued") * F.lit(10000).cast("long"), F.col("n")).alias("conv_rate"),
        money_ratio(F.col("units"), F.col("valued")).alias("avg_conv_value"),
        money_ratio(F.col("units"), F.col("distinct_sessions")).alias("rps"))


def quarter_hour_tz_adjusted(facts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Slots in the visitor's zone with sessions per observed day (whole number) and conversion rate."""
    keys = keys or []
    totals = _slot_totals(facts, "user_ts", keys)
    per_day = F.call_function("div", F.col("n"), F.col("days_samplesize"))
    return with_row_index(_rate_columns(totals, per_day, keys), ["dayofweek", "hourofday"], keys=keys)


def quarter_hour_unadjusted(facts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Slots in UTC with plain session counts."""
    keys = keys or []
    totals = _slot_totals(facts, "utc_ts", keys)
    return with_row_index(_rate_columns(totals, F.col("n"), keys), ["dayofweek", "hourofday"], keys=keys)


def compare_zone_adjustment(adjusted: DataFrame, unadjusted: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Both revenue-per-session curves side by side on the slot."""
    slot = [*(keys or []), "dayofweek", "hourofday"]
    return adjusted.select(*slot, F.col("rps").alias("rps_adj")).join(
        unadjusted.select(*slot, F.col("rps").alias("rps_unadj")), slot)


def hourly_rollup(slots: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Quarter-hour slots summed to hours; revenue rebuilt from rps * sessions."""
    keys = keys or []
    hours = slots.withColumn("hourofday", F.floor("hourofday").cast("double")).groupBy(
        *keys, "dayofweek", "hourofday").agg(
        *[F.sum(c).alias(c) for c in ("days_samplesize", "sessions", "conversions")],
        F.sum(F.col("rps") * F.col("sessions")).alias("revenue"))
    hours = hours.withColumn("rps", F.try_divide("revenue", "sessions"))
    return with_row_index(hours, ["dayofweek", "hourofday"], keys=keys)
