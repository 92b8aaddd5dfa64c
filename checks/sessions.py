"""Unified sessions, lead scores and attribute aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from adyield.operators import joins, sessions
from adyield.functions import text
from adyield.sources import scans
from checks.registry import register
from checks.slots import END, GEO, LOCATED, REV, START, inputs, slot_of
from checks.views import drawn, view, with_views

WINDOW_END = "2024-02-01"
RPS_DIGITS = ("revenue:4 lps_avg:9 rpl_avg:9 rps_:4 rps_avg:9 rps_std:9 rps_var:5 "
              "score_null_avg:9 score_adv_avg:9 score_supp_avg:9")


def scores(spark, sf):
    landing = scans.scan_lead_scores(view(spark, sf, "lead_scores_raw"), START, END)
    return sessions.extract_scores(landing)


def unified(spark, sf, traffic_source=None, splits=False):
    detail, revenue, blocks, locations = inputs(spark, sf, traffic_source=traffic_source)
    latest = sessions.latest_scores(scores(spark, sf), START, WINDOW_END)
    return sessions.unified_sessions(detail, revenue, blocks, locations, latest.drop("score"), splits)


SCORES = """scores AS (
  SELECT CAST(json_extract_string(body, '$.sessionid') AS BIGINT) AS session_id,
    CAST(json_extract_string(body, '$.on') AS DATE) AS computed_dt,
    CAST(json_extract_string(body, '$.score') AS DOUBLE) AS score,
    json_extract_string(body, '$.response.meta.model') AS model
  FROM lead_scores_raw WHERE year = 2024 AND month = 1),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY computed_dt DESC) AS rn FROM (
      SELECT session_id, computed_dt, max(CASE WHEN model IS NULL THEN score END) AS score_null,
        max(CASE WHEN model = 'med-adv' THEN score END) AS score_adv,
        max(CASE WHEN model = 'med-supp' THEN score END) AS score_supp
      FROM scores GROUP BY 1, 2)) WHERE rn = 1)"""
UNIFIED = f"""{LOCATED},
{REV},
{SCORES},
unified AS (
  SELECT s.session_id, upper(traffic_source) AS traffic_source, browser, operating_system, device, product, keyword,
    campaign_id, domain, CAST(creation_date AS DATE) AS utc_dt, creation_date AS utc_ts,
    timezone(time_zone, timezone('UTC', creation_date)) AS user_ts, subdivision_1_iso_code AS state,
    metro_code AS dma, r.units, r.units / 10000.0 AS revenue, c.computed_dt AS score_compute_dt,
    score_null, score_adv, score_supp
  FROM located s JOIN rev r ON s.session_id = r.session_id LEFT JOIN latest c ON s.session_id = c.session_id
  WHERE metro_code <> '')"""
ALL = GEO + " lead_scores_raw"


def agg_sql(cols: str, source: str = "unified") -> str:
    return f"""
SELECT {cols}, count(session_id) AS sessions, CAST(sum(units) AS BIGINT) / 10000.0 AS revenue,
  CAST(sum(CASE WHEN units > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS num_leads,
  avg(CASE WHEN units > 0 THEN 1.0 ELSE 0.0 END) AS lps_avg,
  CAST(sum(units) AS BIGINT) / 10000.0 / CASE WHEN sum(CASE WHEN units > 0 THEN 1 ELSE 0 END) = 0 THEN 1
    ELSE sum(CASE WHEN units > 0 THEN 1 ELSE 0 END) END AS rpl_avg,
  (CAST(sum(units) AS BIGINT) * 2 + count(DISTINCT session_id)) // (2 * count(DISTINCT session_id)) / 10000.0 AS rps_,
  avg(revenue) AS rps_avg, stddev_samp(revenue) AS rps_std, var_samp(revenue) AS rps_var,
  CAST(sum(CAST(score_null > 0 AS INT)) AS BIGINT) AS score_null_cnt, avg(score_null) AS score_null_avg,
  CAST(sum(CAST(score_adv > 0 AS INT)) AS BIGINT) AS score_adv_cnt, avg(score_adv) AS score_adv_avg,
  CAST(sum(CAST(score_supp > 0 AS INT)) AS BIGINT) AS score_supp_cnt, avg(score_supp) AS score_supp_avg,
  CAST(sum(CAST((score_null > 0 OR score_adv > 0 OR score_supp > 0) AS INT)) AS BIGINT) AS score_cnt
FROM {source} GROUP BY {cols}"""


register("lead_scores_extract", scores, with_views("lead_scores_raw", """
SELECT *, CASE WHEN model IS NULL THEN score END AS score_null, CASE WHEN model = 'med-adv' THEN score END AS score_adv,
  CASE WHEN model = 'med-supp' THEN score END AS score_supp FROM scores""", SCORES))

register("lead_scores_latest", lambda spark, sf: sessions.latest_scores(scores(spark, sf), START, WINDOW_END),
         with_views("lead_scores_raw", """
SELECT session_id, computed_dt, score_null, score_adv, score_supp FROM latest""", SCORES))

register("unified_sessions", lambda spark, sf: unified(spark, sf).select(
    "session_id", "traffic_source", "browser", "operating_system", "device", "product", "keyword", "campaign_id",
    "domain", "utc_dt", "state", "dma", "dayofweek", "hourofday", "revenue", "score_compute_dt", "score_null",
    "score_adv", "score_supp", "sessions", "num_leads"), with_views(ALL, f"""
SELECT session_id, traffic_source, browser, operating_system, device, product, keyword, campaign_id, domain, utc_dt,
  state, dma, CAST(dayofweek(user_ts) AS INT) AS dayofweek, {slot_of('user_ts')} AS hourofday, revenue,
  score_compute_dt, score_null, score_adv, score_supp, CAST(1 AS INT) AS sessions, units > 0 AS num_leads
FROM unified""", UNIFIED), "revenue:4")

register("unified_random_splits", lambda spark, sf: unified(spark, sf, splits=True).select(
    "session_id", *[c for n in sessions.RANDOM_SPLITS for c in (f"random_split_{n}", f"random_normal_split_{n}")]),
    with_views(ALL, "SELECT session_id, " + ", ".join(
        f"CAST(floor({drawn('session_id', n)} * {n}) AS INT) AS random_split_{n}, "
        f"CAST(floor(bell * ({n} / 16.0::DOUBLE)) AS INT) AS random_normal_split_{n}" for n in sessions.RANDOM_SPLITS) + f"""
FROM (SELECT session_id, {" + ".join(drawn("session_id", stream) for stream in range(100, 116))} AS bell FROM unified)""", UNIFIED))

for _name, _cols in (("agg_rps_by_campaign", ["campaign_id", "state", "device", "keyword", "utc_dt"]),
                     ("agg_rps_by_device_os", ["device", "operating_system"]),
                     ("agg_rps_by_location", ["state", "dma"])):
    register(_name, lambda spark, sf, c=_cols: sessions.agg_rps(unified(spark, sf), c),
             with_views(ALL, agg_sql(", ".join(_cols)), UNIFIED), RPS_DIGITS)


def rps_daily(spark, sf, cols=("campaign_id", "state", "device", "keyword", "utc_dt")):
    return sessions.finish_rps(sessions.translate_values(sessions.agg_rps(unified(spark, sf), list(cols)), list(cols)))


DEVICE = ("CASE device WHEN 'DESKTOP' THEN 'DESK' WHEN 'MOBILE' THEN 'PHON' WHEN 'TABLET' THEN 'TBLT' WHEN 'D' THEN 'DESK' "
          "WHEN 'P' THEN 'PHON' WHEN 'T' THEN 'TBLT' ELSE device END")
OS = ("CASE operating_system WHEN 'MacIntel' THEN 'Mac OS X' WHEN 'Win32' THEN 'Windows' WHEN 'iPhone' THEN 'iOS' "
      "WHEN 'Linux x86_64' THEN 'Linux' ELSE operating_system END")


def daily_sql(cols: str, recoded: str) -> str:
    mean = "coalesce(sum({c} * sessions), 0.0) / sum(sessions) AS {c}"
    averages = ", ".join(mean.format(c=c) for c in sessions.AVERAGES)
    return f"""
SELECT *, num_leads AS leads, score_null_avg + score_adv_avg + score_supp_avg AS score, rps_avg AS rps,
  num_leads / sessions AS lps, CASE WHEN num_leads <> 0 THEN revenue / num_leads END AS rpl, revenue / sessions AS rps_
FROM (SELECT {cols}, sum(revenue) AS revenue, CAST(sum(sessions) AS BIGINT) AS sessions, sum(num_leads) AS num_leads,
    {averages}
  FROM (SELECT * REPLACE ({recoded}) FROM ({agg_sql(cols)})) GROUP BY {cols})"""


DAILY_DIGITS = ("revenue:4 lps_avg:9 rpl_avg:9 rps_avg:9 score_null_avg:9 score_adv_avg:9 score_supp_avg:9 score:9 "
                "rps:9 lps:9 rpl:9 rps_:9")
register("rps_daily_translated", rps_daily, with_views(
    ALL, daily_sql("campaign_id, state, device, keyword, utc_dt", f"{DEVICE} AS device"), UNIFIED), DAILY_DIGITS)
register("rps_device_os_translated", lambda spark, sf: rps_daily(spark, sf, ("device", "operating_system")), with_views(
    ALL, daily_sql("device, operating_system", f"{DEVICE} AS device, {OS} AS operating_system"), UNIFIED), DAILY_DIGITS)

register("rps_rare_to_null", lambda spark, sf: sessions.rare_to_null(
    rps_daily(spark, sf), ["state", "keyword"], 150).select("campaign_id", "state", "keyword", "device", "utc_dt", "sessions"),
    with_views(ALL, f"""
SELECT campaign_id, CASE WHEN sum(sessions) OVER (PARTITION BY state) >= 150 THEN state END AS state,
  CASE WHEN sum(sessions) OVER (PARTITION BY keyword) >= 150 THEN keyword END AS keyword, device, utc_dt, sessions
FROM ({daily_sql("campaign_id, state, device, keyword, utc_dt", f"{DEVICE} AS device")})""", UNIFIED))

register("rps_trailing_daily_mean", lambda spark, sf: sessions.trailing_daily_mean(
    rps_daily(spark, sf), ["state", "device"], ["sessions", "revenue"]).withColumn(
        "rps", F.try_divide("revenue", "sessions")),
    with_views(ALL, f"""
SELECT *, revenue / sessions AS rps FROM (
  SELECT state, device, CAST(utc_dt + CAST(shift AS INT) AS DATE) AS utc_dt, sum(sessions / 7.0) AS sessions,
    sum(revenue / 7.0) AS revenue
  FROM ({daily_sql("campaign_id, state, device, keyword, utc_dt", f"{DEVICE} AS device")})
  CROSS JOIN (SELECT unnest(range(7)) AS shift) GROUP BY 1, 2, 3)""", UNIFIED), "sessions:9 revenue:7 rps:7")


def zip_rows(spark, sf):
    return joins.zip_located_revenue(
        scans.scan_revenue(view(spark, sf, "session_revenue"), START, END, traffic_source="mediaalpha").filter(
            "domain = 'SITE.COM' AND product IN ('HEALTH', 'MEDICARE')"),
        view(spark, sf, "geo_blocks"), view(spark, sf, "geo_locations"),
        text.url_parameter(F.col("landing_page"), "zipcode"))


ZIP_ROWS = """zip_rows AS (
  SELECT session_id, session_creation_date AS date, product, zipcode, subdivision_1_iso_code AS state_code,
    concat(metro_code, subdivision_1_iso_code) AS dma_state, CASE WHEN revenue > 0 THEN 1 ELSE 0 END AS has_conversion,
    coalesce(revenue, 0.0) AS revenue
  FROM (SELECT *, split_part(split_part(landing_page, 'zipcode=', 2), '&', 1) AS zipcode FROM session_revenue
    WHERE lower(traffic_source) = 'mediaalpha' AND domain = 'SITE.COM') r
  JOIN (SELECT DISTINCT maxmind_id, postal_code FROM geo_blocks) b ON b.postal_code = r.zipcode
  JOIN geo_locations l ON b.maxmind_id = l.maxmind_id
  WHERE zipcode <> '' AND country_iso_code = 'US' AND subdivision_1_iso_code <> '' AND metro_code <> ''),
deduped AS (
  SELECT session_id, product, zipcode, date, min(state_code) AS state_code, min(dma_state) AS dma_state,
    max(has_conversion) AS has_conversion, sum(revenue) AS revenue, max(sessions) AS events
  FROM (SELECT session_id, product, zipcode, state_code, dma_state, date, max(has_conversion) AS has_conversion,
      max(revenue) AS revenue, max(sessions) AS sessions
    FROM (SELECT session_id, product, zipcode, state_code, dma_state, count(*) AS sessions, min(date) AS date,
        sum(revenue) AS revenue, max(has_conversion) AS has_conversion FROM zip_rows GROUP BY 1, 2, 3, 4, 5)
    GROUP BY 1, 2, 3, 4, 5, 6) GROUP BY 1, 2, 3, 4)"""

register("sessions_deduplicated", lambda spark, sf: sessions.deduplicate_sessions(zip_rows(spark, sf)).withColumn(
    "date", F.date_format("date", "yyyy-MM-dd HH:mm:ss")), with_views("session_revenue geo_blocks geo_locations", """
SELECT * REPLACE (strftime(date, '%Y-%m-%d %H:%M:%S') AS date) FROM deduped""", ZIP_ROWS), "revenue:4")

register("session_uniqueness", lambda spark, sf: sessions.session_uniqueness(zip_rows(spark, sf)),
         with_views("session_revenue geo_blocks geo_locations",
                    "SELECT count(*) AS rows, count(DISTINCT session_id) AS sessions FROM zip_rows", ZIP_ROWS))
