"""Session-level facts and their aggregates by arbitrary attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adyield.functions.numeric import money_ratio, wavg
from adyield.functions.text import DEVICE_NAMES, OPERATING_SYSTEM_NAMES, blank_to_null, recode
from adyield.functions.timeparts import day_of_week, quarter_hour, to_local, utc_offset
from adyield.operators.joins import locate_sessions, revenue_per_session
from adyield.session import worked_out
from adyield.sources.schemas import LEAD_SCORE_BODY

RANDOM_SPLITS = (4, 8, 16, 32, 64, 128)
AVERAGES = ("lps_avg", "rpl_avg", "rps_avg", "score_null_avg", "score_adv_avg", "score_supp_avg")
NETWORK_NAMES = {"device": DEVICE_NAMES, "operating_system": OPERATING_SYSTEM_NAMES}


# --- lead scores -------------------------------------------------------------------------

def extract_scores(landing: DataFrame) -> DataFrame:
    """Landing JSON to one row per scoring event, the score under the model that made it."""
    body = F.from_json("body", LEAD_SCORE_BODY)
    model = F.col("b.response.meta.model")
    return landing.select(worked_out(body).alias("b")).select(
        F.col("b.sessionid").alias("session_id"), F.to_date("b.on").alias("computed_dt"),
        F.col("b.score").alias("score"), model.alias("model"),
        F.when(model.isNull(), F.col("b.score")).alias("score_null"),
        F.when(model == "med-adv", F.col("b.score")).alias("score_adv"),
        F.when(model == "med-supp", F.col("b.score")).alias("score_supp"))


def pivot_scores(scores: DataFrame, start, end) -> DataFrame:
    """Best score per model for each session and day of a half-open date range."""
    days = scores.filter((F.col("computed_dt") >= F.lit(str(start)).cast("date"))
                         & (F.col("computed_dt") < F.lit(str(end)).cast("date")))
    return days.groupBy("session_id", "computed_dt").agg(
        *[F.max(c).alias(c) for c in ("score_null", "score_adv", "score_supp")])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key as one map-combined aggregate (no sort of a hot key in one task)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*df.columns)


def latest_scores(scores: DataFrame, start, end) -> DataFrame:
    return latest_per_key(pivot_scores(scores, start, end), ["session_id"], ["computed_dt"])


# --- unified sessions --------------------------------------------------------------------

def uniform_draw(key: Column, stream: int) -> Column:
    """Number in [0, 1) of 52 bits, the md5 of key and stream: a retried task, or another engine, draws the same value again."""
    digits = F.substring(F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(stream)))), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def random_splits(key: Column) -> dict[str, Column]:
    """Uniform and bell-shaped (sum of 16 draws) whole-number splits 0..n-1."""
    bell = uniform_draw(key, 100)
    for stream in range(101, 116):
        bell = bell + uniform_draw(key, stream)
    uniform = {f"random_split_{n}": F.floor(uniform_draw(key, n) * F.lit(n)).cast("int") for n in RANDOM_SPLITS}
    normal = {f"random_normal_split_{n}": F.floor(bell * F.lit(n / 16.0)).cast("int") for n in RANDOM_SPLITS}
    return {**uniform, **normal}


def unified_sessions(sessions: DataFrame, revenue: DataFrame, blocks: DataFrame, locations: DataFrame,
                     scores: DataFrame, with_splits: bool = True) -> DataFrame:
    """One wide row per located session: attributes, local time, place, revenue, scores, splits."""
    places = locations.select("maxmind_id", "country_iso_code", "time_zone", "subdivision_1_iso_code",
                              "metro_code").filter(blank_to_null(F.col("metro_code")).isNotNull())
    placed = locate_sessions(sessions, blocks.select("ip_index", "start_int", "end_int", "maxmind_id"), places)
    joined = placed.join(revenue_per_session(revenue), "session_id").join(
        scores.withColumnRenamed("computed_dt", "score_compute_dt"), "session_id", "left")
    wide = joined.withColumn("user_ts", to_local(F.col("creation_date"), F.col("time_zone"))).select(
        F.upper("traffic_source").alias("traffic_source"), "browser", "operating_system", "device", "channel",
        "domain", "product", "keyword", "campaign_id", "landing_page", "session_id",
        F.to_date("creation_date").alias("utc_dt"), F.col("creation_date").alias("utc_ts"),
        utc_offset(F.col("creation_date"), F.col("user_ts")).alias("utc_offset"), "time_zone", "user_ts",
        day_of_week(F.col("user_ts")).alias("dayofweek"), quarter_hour(F.col("user_ts")).alias("hourofday"),
        F.col("subdivision_1_iso_code").alias("state"), F.col("metro_code").alias("dma"),
        "revenue", "revenue_units", "score_compute_dt", "score_null", "score_adv", "score_supp",
        F.lit(1).alias("sessions"), (F.col("revenue") > 0).alias("num_leads"))
    return wide.withColumns(random_splits(F.col("session_id"))) if with_splits else wide


def agg_rps(unified: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sixteen measures of the unified sessions by any attribute columns."""
    lead = (F.col("revenue_units") > 0).cast("double")
    leads = F.sum(lead)
    scored = [(F.col(c) > 0) for c in ("score_null", "score_adv", "score_supp")]
    rows = unified.groupBy(*columns).agg(
        F.count("session_id").alias("sessions"),
        F.countDistinct("session_id").alias("distinct_sessions"),
        F.sum("revenue_units").alias("units"),
        leads.alias("num_leads"), F.avg(lead).alias("lps_avg"),
        F.avg("revenue").alias("rps_avg"), F.stddev("revenue").alias("rps_std"),
        F.variance("revenue").alias("rps_var"),
        *[m for c, flag in zip(("score_null", "score_adv", "score_supp"), scored)
          for m in (F.sum(flag.cast("int")).alias(f"{c}_cnt"), F.avg(c).alias(f"{c}_avg"))],
        F.sum((scored[0] | scored[1] | scored[2]).cast("int")).alias("score_cnt"))
    revenue = F.col("units") / F.lit(10000.0)
    return rows.select(
        *columns, "sessions", revenue.alias("revenue"), "num_leads", "lps_avg",
        (revenue / F.when(F.col("num_leads") == 0, F.lit(1.0)).otherwise(F.col("num_leads"))).alias("rpl_avg"),
        money_ratio(F.col("units"), F.col("distinct_sessions")).alias("rps_"), "rps_avg", "rps_std", "rps_var",
        "score_null_cnt", "score_null_avg", "score_adv_cnt", "score_adv_avg", "score_supp_cnt", "score_supp_avg",
        "score_cnt")


def translate_values(rps: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Recode device and operating-system names, then re-aggregate.

    Counts are summed; averages become session-weighted means in which a missing average counts as 0.
    """
    named = rps.withColumns({c: recode(F.col(c), NETWORK_NAMES[c]) for c in columns if c in NETWORK_NAMES})
    weight = F.sum("sessions")
    return named.na.drop(subset=list(columns)).groupBy(*columns).agg(
        F.sum("revenue").alias("revenue"), weight.alias("sessions"), F.sum("num_leads").alias("num_leads"),
        *[(F.coalesce(F.sum(F.col(c) * F.col("sessions")), F.lit(0.0)) / weight).alias(c) for c in AVERAGES])


def finish_rps(rps: DataFrame) -> DataFrame:
    """Leads per session, revenue per lead, combined score and revenue per session."""
    score = sum((F.coalesce(c, F.lit(0.0)) for c in ("score_null_avg", "score_adv_avg", "score_supp_avg")), F.lit(0.0))
    return rps.withColumns({
        "leads": F.coalesce("num_leads", F.lit(0.0)),
        "score": score,
        "rps": F.col("rps_avg"),
    }).withColumns({
        "lps": F.try_divide("leads", "sessions"),
        "rpl": F.try_divide("revenue", "leads"),
        "rps_": F.try_divide("revenue", "sessions"),
    })


def session_uniqueness(rows: DataFrame) -> DataFrame:
    """Rows against distinct sessions, the check that a session appears once."""
    return rows.agg(F.count("*").alias("rows"), F.countDistinct("session_id").alias("sessions"))


def deduplicate_sessions(rows: DataFrame) -> DataFrame:
    """Three roll-ups that leave one row per session, zip and date.

    A zip code may belong to several cities, then to several metros: the first keeps the sums per
    place, the second folds cities, the third takes the smallest state and metro.
    """
    place = ["session_id", "product", "zipcode", "state_code", "dma_state"]
    by_place = rows.groupBy(*place).agg(
        F.count("*").alias("sessions"), F.min("date").alias("date"), F.sum("revenue").alias("revenue"),
        F.max("has_conversion").alias("has_conversion"))
    by_day = by_place.groupBy(*place, "date").agg(
        *[F.max(c).alias(c) for c in ("has_conversion", "revenue", "sessions")])
    return by_day.groupBy("session_id", "product", "zipcode", "date").agg(
        F.min("state_code").alias("state_code"), F.min("dma_state").alias("dma_state"),
        F.max("has_conversion").alias("has_conversion"), F.sum("revenue").alias("revenue"),
        F.max("sessions").alias("events"))


def rare_to_null(rps: DataFrame, columns: Sequence[str], min_sessions: float) -> DataFrame:
    """Categories with fewer sessions in total than ``min_sessions`` become NULL.

    Totals come from a map-combined aggregate; the join back is left to the optimizer's size check.
    """
    out = rps
    for c in columns:
        kept = rps.groupBy(c).agg(F.sum("sessions").alias("total")).filter(
            (F.col("total") >= min_sessions) & F.col(c).isNotNull()).select(F.col(c).alias("kept_value"))
        out = out.join(kept, F.col(c) == F.col("kept_value"), "left").withColumn(c, F.col("kept_value")).drop(
            "kept_value").select(*rps.columns)
    return out


def trailing_daily_mean(rps: DataFrame, keys: Sequence[str], measures: Sequence[str], days: int = 7) -> DataFrame:
    """Trailing mean over days by copying each row to its next days and summing.

    A day without rows counts as zero, and the copies run past the last day, as the daily model input does.
    """
    copies = rps.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("shift"), "utc_dt", *measures)
    return copies.withColumn("utc_dt", F.date_add("utc_dt", F.col("shift"))).groupBy(*keys, "utc_dt").agg(
        *[F.sum(F.col(m) / F.lit(float(days))).alias(m) for m in measures])


def rolling_mean(daily: DataFrame, measures: Sequence[str], spans: Sequence[int], order: str,
                 keys: Sequence[str] = (), relative: bool = False) -> DataFrame:
    """Mean of the last n rows, NULL until n rows are there, for a daily table; ``relative`` divides it by its own mean."""
    out = {}
    for n in spans:
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), 0)
        for m in measures:
            out[f"{m}_{n}d_avg"] = F.when(F.count(m).over(window) == n, F.avg(m).over(window))
    rolled = daily.withColumns(out)
    if not relative:
        return rolled
    whole = Window.partitionBy(*keys)
    return rolled.withColumns({c: F.try_divide(F.col(c), F.avg(c).over(whole)) for c in out})


def attach_weighted_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str, name: str) -> DataFrame:
    """Each row with its group's weighted mean. Groups are aggregated and joined back, so none is gathered in one task.

    Rows with a null key get NULL.
    """
    means = df.groupBy(*keys).agg(wavg(F.col(value), F.col(weight)).alias(name))
    return df.join(means, list(keys), "left").select(*df.columns, name)
