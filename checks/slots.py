"""Located sessions and quarter-hour slots."""

from __future__ import annotations

from pyspark.sql import functions as F

from adyield.functions import network, text, timeparts
from adyield.operators import joins, slots
from adyield.sources import scans
from checks.registry import register
from checks.views import view, with_views

START, END = "2024-01-01", "2024-01-31"
GEO = "session_detail session_revenue geo_blocks geo_locations"


def inputs(spark, sf, product=None, traffic_source=None, revenue_source=None):
    return (
        scans.scan_sessions(view(spark, sf, "session_detail"), START, END, product, traffic_source),
        scans.scan_revenue(view(spark, sf, "session_revenue"), START, END, None, revenue_source),
        view(spark, sf, "geo_blocks"), view(spark, sf, "geo_locations"))


def facts(spark, sf, **kw):
    return slots.session_conversions(*inputs(spark, sf, **kw))


def aton(c: str) -> str:
    return (f"(CAST(split_part({c}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({c}, '.', 2) AS BIGINT) * 65536"
            f" + CAST(split_part({c}, '.', 3) AS BIGINT) * 256 + CAST(split_part({c}, '.', 4) AS BIGINT))")


LOCATED = f"""located AS (
  SELECT s.*, b.postal_code, l.* EXCLUDE (maxmind_id)
  FROM (SELECT * FROM session_detail WHERE ip_address <> '') s
  JOIN geo_blocks b ON regexp_extract(s.ip_address, '[0-9]+[.][0-9]+') = b.ip_index
    AND {aton('s.ip_address')} BETWEEN b.start_int AND b.end_int
  JOIN geo_locations l ON b.maxmind_id = l.maxmind_id AND l.country_iso_code = 'US')"""
REV = """rev AS (
  SELECT session_id, CAST(sum(CAST(round(revenue * 10000) AS BIGINT)) AS BIGINT) AS units
  FROM session_revenue GROUP BY session_id)"""


def rev_where(condition: str) -> str:
    return REV.replace("FROM session_revenue", f"FROM session_revenue WHERE {condition}")


FACTS = """facts AS (
  SELECT s.session_id, product, traffic_source, creation_date AS utc_ts, time_zone,
    timezone(time_zone, timezone('UTC', creation_date)) AS user_ts, subdivision_1_iso_code AS state,
    units / 10000.0 AS revenue, units
  FROM located s JOIN rev r ON s.session_id = r.session_id)"""
GEO_FACTS = f"{LOCATED},\n{REV},\n{FACTS}"


def slot_of(ts: str) -> str:
    return f"CAST(extract(hour FROM {ts}) + floor(extract(minute FROM {ts}) / 15.0) * 0.25 AS DOUBLE)"


def ratio(units: str, n: str) -> str:
    return f"(({units}) * 2 + ({n})) // (2 * ({n})) / 10000.0"


register("slots_user_tz", lambda spark, sf: slots.quarter_hour_user_tz(facts(spark, sf)), with_views(GEO, f"""
SELECT CAST(dow AS INT) AS dayofweek, hourofday, days_samplesize, sessions, conversions, {ratio('u', 'n')} AS rps,
  CAST(row_number() OVER (ORDER BY dow, hourofday) - 1 AS INT) AS int_ix
FROM (SELECT dayofweek(user_ts) AS dow, {slot_of('user_ts')} AS hourofday,
    count(DISTINCT CAST(user_ts AS DATE)) AS days_samplesize, count(session_id) AS sessions,
    CAST(sum(CASE WHEN units > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS conversions,
    CAST(sum(units) AS BIGINT) AS u, count(DISTINCT session_id) AS n
  FROM facts GROUP BY 1, 2)""", GEO_FACTS), "rps:4")

register("slots_user_tz_by_source", lambda spark, sf: slots.quarter_hour_user_tz(
    facts(spark, sf), ["product", "traffic_source"]), with_views(GEO, f"""
SELECT product, traffic_source, CAST(dow AS INT) AS dayofweek, hourofday, days_samplesize, sessions, conversions,
  {ratio('u', 'n')} AS rps,
  CAST(row_number() OVER (PARTITION BY product, traffic_source ORDER BY dow, hourofday) - 1 AS INT) AS int_ix
FROM (SELECT product, traffic_source, dayofweek(user_ts) AS dow, {slot_of('user_ts')} AS hourofday,
    count(DISTINCT CAST(user_ts AS DATE)) AS days_samplesize, count(session_id) AS sessions,
    CAST(sum(CASE WHEN units > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS conversions,
    CAST(sum(units) AS BIGINT) AS u, count(DISTINCT session_id) AS n
  FROM facts GROUP BY 1, 2, 3, 4)""", GEO_FACTS), "rps:4")


def rate_sql(ts: str, sessions: str) -> str:
    return f"""
SELECT product, CAST(dow AS INT) AS dayofweek, hourofday, days_samplesize, {sessions} AS sessions, conversions,
  {ratio('conversions * 10000', 'n')} AS conv_rate, {ratio('u', 'conversions')} AS avg_conv_value,
  {ratio('u', 'ns')} AS rps, CAST(row_number() OVER (PARTITION BY product ORDER BY dow, hourofday) - 1 AS INT) AS int_ix
FROM (SELECT product, dayofweek({ts}) AS dow, {slot_of(ts)} AS hourofday,
    count(DISTINCT CAST({ts} AS DATE)) AS days_samplesize, count(session_id) AS n,
    count(units) AS conversions, CAST(sum(units) AS BIGINT) AS u, count(DISTINCT session_id) AS ns
  FROM facts GROUP BY 1, 2, 3)"""


register("slots_tz_adjusted", lambda spark, sf: slots.quarter_hour_tz_adjusted(facts(spark, sf), ["product"]),
         with_views(GEO, rate_sql("user_ts", "n // days_samplesize"), GEO_FACTS),
         "conv_rate:4 avg_conv_value:4 rps:4")
register("slots_unadjusted", lambda spark, sf: slots.quarter_hour_unadjusted(facts(spark, sf), ["product"]),
         with_views(GEO, rate_sql("utc_ts", "n"), GEO_FACTS), "conv_rate:4 avg_conv_value:4 rps:4")


def _compare(spark, sf):
    rows, keys = facts(spark, sf), ["product"]
    return slots.compare_zone_adjustment(slots.quarter_hour_tz_adjusted(rows, keys), slots.quarter_hour_unadjusted(rows, keys), keys)


register("slots_zone_comparison", _compare, with_views(GEO, f"""
SELECT product, a.dayofweek, a.hourofday, a.rps AS rps_adj, u.rps AS rps_unadj
FROM ({rate_sql('user_ts', 'n')}) a JOIN ({rate_sql('utc_ts', 'n')}) u USING (product, dayofweek, hourofday)""", GEO_FACTS),
         "rps_adj:4 rps_unadj:4")

register("slots_hourly_rollup", lambda spark, sf: slots.hourly_rollup(slots.quarter_hour_user_tz(facts(spark, sf))),
         with_views(GEO, f"""
SELECT CAST(dow AS INT) AS dayofweek, CAST(floor(hour4) AS DOUBLE) AS hourofday,
  CAST(sum(days) AS BIGINT) AS days_samplesize,
  CAST(sum(sessions) AS BIGINT) AS sessions, sum(conversions) AS conversions, sum(rps * sessions) AS revenue,
  sum(rps * sessions) / sum(sessions) AS rps, CAST(row_number() OVER (ORDER BY dow, floor(hour4)) - 1 AS INT) AS int_ix
FROM (SELECT dow, hour4, days, sessions, conversions, {ratio('u', 'n')} AS rps
  FROM (SELECT dayofweek(user_ts) AS dow, {slot_of('user_ts')} AS hour4,
      count(DISTINCT CAST(user_ts AS DATE)) AS days, count(session_id) AS sessions,
      CAST(sum(CASE WHEN units > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS conversions,
      CAST(sum(units) AS BIGINT) AS u, count(DISTINCT session_id) AS n
    FROM facts GROUP BY 1, 2)) GROUP BY dow, floor(hour4)""", GEO_FACTS), "revenue:4 rps:9")

register("session_conversions", lambda spark, sf: facts(spark, sf).select(
    "session_id", "utc_offset", F.date_format("user_ts", "yyyy-MM-dd HH:mm:ss").alias("user_ts"), "state", "revenue",
    "hourfraction", "hourofday", "weekday"), with_views(GEO, """
SELECT session_id, CAST(date_diff('minute', utc_ts, user_ts) / 60.0 AS INT) AS utc_offset,
  strftime(user_ts, '%Y-%m-%d %H:%M:%S') AS user_ts, state, revenue,
  floor(extract(minute FROM user_ts) / 15.0) * 0.25 AS hourfraction, CAST(extract(hour FROM user_ts) AS INT) AS hourofday,
  CAST(dayofweek(user_ts) AS INT) AS weekday
FROM facts""", GEO_FACTS), "revenue:4")

register("session_revenue_sum", lambda spark, sf: joins.revenue_per_session(
    view(spark, sf, "session_revenue")).select("session_id", "revenue"),
    with_views("session_revenue", "SELECT session_id, units / 10000.0 AS revenue FROM rev", REV), "revenue:4")

register("ip_range_join_left", lambda spark, sf: joins.locate_sessions(
    scans.scan_sessions(view(spark, sf, "session_detail"), START, END), view(spark, sf, "geo_blocks"),
    view(spark, sf, "geo_locations"), how="left", country=None).select(
    "session_id", "ip_address", "postal_code", F.col("country_iso_code").alias("country_code"),
    F.col("subdivision_1_iso_code").alias("state"), "time_zone", F.col("metro_code").alias("dma"), "city_name"),
    with_views(GEO, f"""
SELECT s.session_id, s.ip_address, b.postal_code, l.country_iso_code AS country_code,
  l.subdivision_1_iso_code AS state, l.time_zone, l.metro_code AS dma, l.city_name
FROM (SELECT * FROM session_detail WHERE ip_address <> '') s
LEFT JOIN geo_blocks b ON regexp_extract(s.ip_address, '[0-9]+[.][0-9]+') = b.ip_index
  AND {aton('s.ip_address')} BETWEEN b.start_int AND b.end_int
LEFT JOIN geo_locations l ON b.maxmind_id = l.maxmind_id"""))

register("ip_range_join_salted", lambda spark, sf: joins.ip_range_join(
    scans.scan_sessions(view(spark, sf, "session_detail"), START, END),
    view(spark, sf, "geo_blocks"), salts=4).select("session_id", "traffic_source", "maxmind_id"),
    with_views(GEO, f"""
SELECT s.session_id, s.traffic_source, b.maxmind_id
FROM (SELECT * FROM session_detail WHERE ip_address <> '') s
JOIN geo_blocks b ON regexp_extract(s.ip_address, '[0-9]+[.][0-9]+') = b.ip_index
  AND {aton('s.ip_address')} BETWEEN b.start_int AND b.end_int"""))

register("conversion_facts", lambda spark, sf: joins.conversion_facts(*inputs(spark, sf)).drop(
    "revenue_units"), with_views(GEO, """
SELECT s.session_id, product, subdivision_1_iso_code AS state_code, concat(metro_code, subdivision_1_iso_code) AS dma_state,
  city_name AS city, CASE WHEN r.units > 0 THEN 1 ELSE 0 END AS has_conversion,
  CASE WHEN r.units > 0 THEN r.units / 10000.0 ELSE 0.0 END AS revenue
FROM located s LEFT JOIN rev r ON s.session_id = r.session_id
WHERE subdivision_1_iso_code <> '' AND metro_code <> ''""", f"{LOCATED},\n{REV}"),
         "revenue:4")

register("ip_range_join_salted_all", lambda spark, sf: joins.ip_ordered_join(
    scans.scan_sessions(view(spark, sf, "session_detail"), START, END), view(spark, sf, "geo_blocks"), part_rows=5_000).select(
        "session_id", "traffic_source", "maxmind_id"),
    with_views(GEO, f"""
SELECT s.session_id, s.traffic_source, b.maxmind_id
FROM (SELECT * FROM session_detail WHERE ip_address <> '') s
JOIN geo_blocks b ON regexp_extract(s.ip_address, '[0-9]+[.][0-9]+') = b.ip_index
  AND {aton('s.ip_address')} BETWEEN b.start_int AND b.end_int"""))

register("conversion_facts_all", lambda spark, sf: joins.conversion_facts(*inputs(spark, sf)).drop("revenue_units"), with_views(GEO, """
SELECT s.session_id, product, subdivision_1_iso_code AS state_code, concat(metro_code, subdivision_1_iso_code) AS dma_state,
  city_name AS city, CASE WHEN r.units > 0 THEN 1 ELSE 0 END AS has_conversion,
  CASE WHEN r.units > 0 THEN r.units / 10000.0 ELSE 0.0 END AS revenue
FROM located s LEFT JOIN rev r ON s.session_id = r.session_id
WHERE subdivision_1_iso_code <> '' AND metro_code <> ''""", f"{LOCATED},\n{REV}"),
         "revenue:4")

register("zip_located_revenue", lambda spark, sf: joins.zip_located_revenue(
    scans.scan_revenue(view(spark, sf, "session_revenue"), START, END, traffic_source="mediaalpha").filter(
        "domain = 'SITE.COM' AND product IN ('HEALTH', 'MEDICARE')"),
    view(spark, sf, "geo_blocks"), view(spark, sf, "geo_locations"),
    text.url_parameter(F.col("landing_page"), "zipcode")).withColumn(
        "date", F.date_format("date", "yyyy-MM-dd HH:mm:ss")),
    with_views(GEO, """
SELECT session_id, strftime(session_creation_date, '%Y-%m-%d %H:%M:%S') AS date, product, zipcode,
  subdivision_1_iso_code AS state_code, concat(metro_code, subdivision_1_iso_code) AS dma_state,
  CASE WHEN revenue > 0 THEN 1 ELSE 0 END AS has_conversion, coalesce(revenue, 0.0) AS revenue
FROM (SELECT *, split_part(split_part(landing_page, 'zipcode=', 2), '&', 1) AS zipcode FROM session_revenue
  WHERE lower(traffic_source) = 'mediaalpha' AND domain = 'SITE.COM' AND product IN ('HEALTH', 'MEDICARE')) r
LEFT JOIN (SELECT maxmind_id, postal_code FROM geo_blocks GROUP BY 1, 2) b ON b.postal_code = r.zipcode
LEFT JOIN geo_locations l ON b.maxmind_id = l.maxmind_id
WHERE zipcode <> '' AND country_iso_code = 'US' AND subdivision_1_iso_code <> '' AND metro_code <> ''"""), "revenue:4")

register("scalar_network", lambda spark, sf: view(spark, sf, "session_detail").select(
    "session_id", network.inet_aton(F.col("ip_address")).alias("ip_int"),
    network.ip_index(F.col("ip_address")).alias("bucket"),
    network.extract_octets(F.col("ip_address"), (2, 4), join=True).alias("octets"),
    text.blank_to_null(F.col("ip_address")).isNull().alias("blank")),
    with_views("session_detail", f"""
SELECT session_id, CASE WHEN ip_address <> '' THEN {aton("nullif(ip_address, '')")} END AS ip_int,
  regexp_extract(ip_address, '[0-9]+[.][0-9]+') AS bucket,
  concat(split_part(ip_address, '.', 2), '.', split_part(ip_address, '.', 4)) AS octets, ip_address = '' AS blank
FROM session_detail"""))

register("scalar_calendar", lambda spark, sf: view(spark, sf, "session_detail").select(
    "session_id", timeparts.quarter_hour(F.col("creation_date")).alias("slot"),
    timeparts.day_of_week(F.col("creation_date")).alias("dow"),
    timeparts.monday_first(timeparts.day_of_week(F.col("creation_date"))).alias("dow_monday"),
    timeparts.eastern_standard_date(F.col("creation_date")).alias("est_date"),
    F.date_format(timeparts.to_local(F.col("creation_date"), F.lit("America/Denver")), "yyyy-MM-dd HH:mm:ss").alias("local"),
    timeparts.utc_offset(F.col("creation_date"), timeparts.to_local(
        F.col("creation_date"), F.lit("America/Denver"))).alias("offset_hours"),
    text.url_parameter(F.col("landing_page"), "zipcode").alias("zipcode")),
    with_views("session_detail", f"""
SELECT session_id, {slot_of('creation_date')} AS slot, CAST(dayofweek(creation_date) AS INT) AS dow,
  CAST((dayofweek(creation_date) + 6) % 7 AS INT) AS dow_monday,
  CAST(creation_date - INTERVAL 5 HOUR AS DATE) AS est_date,
  strftime(timezone('America/Denver', timezone('UTC', creation_date)), '%Y-%m-%d %H:%M:%S') AS local,
  CAST(-7 AS INT) AS offset_hours, split_part(split_part(landing_page, 'zipcode=', 2), '&', 1) AS zipcode
FROM session_detail"""))

register("scan_sessions_filtered", lambda spark, sf: scans.scan_sessions(
    view(spark, sf, "session_detail"), "2024-01-05", "2024-01-09", "health", ("BING", "TABOOLA")).select(
    "session_id", "traffic_source", "product", "device"), with_views("session_detail", """
SELECT session_id, traffic_source, product, device FROM session_detail
WHERE ip_address <> '' AND CAST(creation_date AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'
  AND product = 'HEALTH' AND traffic_source IN ('BING', 'TABOOLA')"""))
