"""Bags, keyword bids and channel bids."""

from __future__ import annotations

from pyspark.sql import functions as F

from adyield.functions import numeric, text
from adyield.operators import joins, keywords as kw, ordered, slots
from adyield.plans import channel_bids, keyword_bids
from adyield.sources import scans
from checks.registry import register
from checks.slots import END, GEO, GEO_FACTS, REV, START, facts, slot_of
from checks.views import drawn, view, with_views

# --- bags --------------------------------------------------------------------------------


def revenue_sessions(spark, sf):
    detail = view(spark, sf, "session_detail").filter(scans.between_dates(F.col("creation_date"), START, END))
    revenue = scans.scan_revenue(view(spark, sf, "session_revenue"), START, END)
    return detail.join(joins.revenue_per_session(revenue), "session_id")


BAGS = f"""{REV},
bags AS (
  SELECT s.session_id, s.creation_date, r.units, sum(CASE WHEN r.units > 0 THEN 1 ELSE 0 END) OVER (
    ORDER BY s.creation_date, s.session_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bag_id
  FROM session_detail s JOIN rev r ON s.session_id = r.session_id)"""
VIEWS = "session_detail session_revenue"

register("bag_id_running_count", lambda spark, sf: ordered.bag_sessions(revenue_sessions(spark, sf)).select(
    "session_id", "bag_id"), with_views(VIEWS, "SELECT session_id, CAST(bag_id AS BIGINT) AS bag_id FROM bags", BAGS))

register("bag_kpis", lambda spark, sf: ordered.bag_kpis(revenue_sessions(spark, sf)), with_views(VIEWS, f"""
SELECT CAST(creation_date AS DATE) AS date, {slot_of('creation_date')} AS hour, count(*) AS clicks_num,
  sum(bag_lpc) AS leads_num, sum(bag_rpc) AS rev_sum, avg(bag_rpc) AS rev_avg,
  CAST(row_number() OVER (ORDER BY CAST(creation_date AS DATE), {slot_of('creation_date')}) - 1 AS INT) AS int_ix
FROM (SELECT *, avg(CASE WHEN units > 0 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY bag_id) AS bag_lpc,
    avg(units / 10000.0) OVER (PARTITION BY bag_id) AS bag_rpc FROM bags) GROUP BY 1, 2""", BAGS),
         "leads_num:9 rev_sum:8 rev_avg:8")

POSITIONS = f"""{GEO_FACTS},
positioned AS (
  SELECT *, units > 0 AS has_conversion, row_number() OVER (PARTITION BY product, bag ORDER BY user_ts, session_id) AS session_no
  FROM (SELECT *, coalesce(sum(CASE WHEN units > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY product
      ORDER BY user_ts, session_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bag FROM facts)
  WHERE bag >= 1)"""


def positions(spark, sf):
    return ordered.bag_positions(facts(spark, sf), "user_ts", "revenue", keys=["product"])


register("bag_positions", lambda spark, sf: positions(spark, sf).select(
    "session_id", "product", "session_no", "has_conversion", "bag_rps", "bag_conversion_rate"), with_views(GEO, """
SELECT session_id, product, session_no, has_conversion, CASE WHEN has_conversion THEN revenue / session_no END AS bag_rps,
  CASE WHEN has_conversion THEN 1.0 / session_no END AS bag_conversion_rate FROM positioned""", POSITIONS),
         "bag_rps:9 bag_conversion_rate:9")

SPLIT = f"""{POSITIONS},
split AS (
  SELECT product, dow AS weekday, hour AS hourofday, fraction AS hourfraction, rate AS bag_conversion_rate, sessions,
    row_number() OVER o - 1 AS ix, last_value(rps IGNORE NULLS) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bag_rps
  FROM (SELECT product, CAST(dayofweek(user_ts) AS INT) AS dow, CAST(extract(hour FROM user_ts) AS INT) AS hour,
      floor(extract(minute FROM user_ts) / 15.0) * 0.25 AS fraction,
      avg(CASE WHEN has_conversion THEN revenue / session_no END) AS rps,
      avg(CASE WHEN has_conversion THEN 1.0 / session_no END) AS rate, count(session_id) AS sessions
    FROM positioned GROUP BY 1, 2, 3, 4) WINDOW o AS (PARTITION BY product ORDER BY dow, hour, fraction))"""

register("split_to_intervals", lambda spark, sf: ordered.split_to_intervals(positions(spark, sf), ["product"]),
         with_views(GEO, "SELECT * REPLACE (CAST(ix AS INT) AS ix) FROM split", SPLIT),
         "bag_rps:9 bag_conversion_rate:9 hourfraction:2")

# --- keyword rows ------------------------------------------------------------------------
AS_OF = "2001-11-05"


def perf_rows(spark, sf, days=84):
    return kw.clean_perf(scans.scan_keyword_perf(view(spark, sf, "keyword_perf"), AS_OF, days))


def states_sql(c: str) -> str:
    pattern = "|".join("[ -][+]?".join(s.split()) for s in text.STATES)
    return f"CASE WHEN geo THEN regexp_replace({c}, '({pattern})', '<STATE>', 'gi') ELSE {c} END"


def rows_sql(days: int = 84) -> str:
    return f"""scanned AS (
  SELECT CAST(date - 1 AS DATE) AS date, transaction_date_time, data_source_type, account_num, campaign_id, adgroup_id,
    keyword_id, campaign, adgroup, keyword, clicks, cost, match_type AS match,
    CASE WHEN data_source_type <> 'COST' THEN rev END AS rev,
    CASE WHEN data_source_type <> 'REVENUE' THEN max_cpc END AS max_cpc,
    coalesce(contains(campaign, 'Geo-Granular'), FALSE) AS geo
  FROM keyword_perf
  WHERE date >= DATE '{AS_OF}' - {days} AND channel = 'SEM' AND traffic_source = 'BING'),
kw_rows AS (SELECT *, {states_sql('adgroup')} AS adgroup_norm, {states_sql('keyword')} AS keyword_norm FROM scanned)"""


ROWS = rows_sql()
register("keyword_perf_clean", lambda spark, sf: perf_rows(spark, sf).select(
    "date", "data_source_type", "keyword_id", "campaign", "geo", "adgroup_norm", "keyword_norm", "clicks", "cost",
    "rev", "max_cpc", "match"), with_views("keyword_perf", """
SELECT date, data_source_type, keyword_id, campaign, geo, adgroup_norm, keyword_norm, clicks, cost, rev, max_cpc, match
FROM kw_rows""", ROWS), "cost:6 rev:6 max_cpc:4")

register("keyword_perf_entity", lambda spark, sf: kw.attach_entity(
    perf_rows(spark, sf), view(spark, sf, "keyword_entity")).select(
        "keyword_id", "date", "account_id", "latest_max_cpc", "clicks"), with_views("keyword_perf keyword_entity", """
SELECT r.keyword_id, date, e.account_id, CAST(e.latest_max_cpc AS DOUBLE) AS latest_max_cpc, clicks
FROM kw_rows r LEFT JOIN keyword_entity e ON r.keyword_id = e.keyword_id""", ROWS), "latest_max_cpc:4")

SPANS_SQL = ", ".join(
    f"coalesce(sum(CASE WHEN date >= DATE '{AS_OF}' - {n} THEN {c} END), 0.0) AS {c}_sum_{n}day"
    for n in kw.SPANS for c in kw.PERFORMANCE)
SPAN_DIGITS = " ".join(f"{c}_sum_{n}day:8" for n in kw.SPANS for c in kw.PERFORMANCE)
register("keyword_span_performance", lambda spark, sf: kw.span_performance(perf_rows(spark, sf), AS_OF),
         with_views("keyword_perf", f"""
SELECT keyword_id, {SPANS_SQL} FROM kw_rows WHERE date >= DATE '{AS_OF}' - 30 GROUP BY 1""", ROWS), SPAN_DIGITS)

register("keyword_geo_counts", lambda spark, sf: kw.geo_keyword_counts(
    kw.attach_entity(perf_rows(spark, sf, 360), view(spark, sf, "keyword_entity"))),
    with_views("keyword_perf keyword_entity", """
SELECT account_id, geo, campaign_id, adgroup_norm, keyword_norm, count(*) AS cnt, count(*) > 60 AS oversized,
  CAST((length(keyword_norm) - length(replace(keyword_norm, '<STATE>', ''))) / 7 AS INT) AS tags
FROM (SELECT DISTINCT e.account_id, geo, campaign_id, adgroup_norm, keyword_norm, adgroup_id, r.keyword_id
  FROM kw_rows r JOIN keyword_entity e ON r.keyword_id = e.keyword_id) GROUP BY 1, 2, 3, 4, 5""", rows_sql(360)))

register("keyword_daily_kpis", lambda spark, sf: kw.daily_kpis(kw.attach_account_names(kw.attach_entity(
    perf_rows(spark, sf), view(spark, sf, "keyword_entity")), view(spark, sf, "accounts")), ["account_name"]),
    with_views("keyword_perf keyword_entity accounts", """
SELECT account_name, date, coalesce(sum(rev), 0.0) AS rev, coalesce(sum(cost), 0.0) AS cost,
  coalesce(sum(clicks), 0.0) AS clicks, avg(max_cpc) AS max_cpc,
  CASE WHEN sum(cost) <> 0 THEN coalesce(sum(rev), 0.0) / sum(cost) END AS roas
FROM kw_rows r JOIN keyword_entity e ON r.keyword_id = e.keyword_id JOIN accounts a ON a.account_id = e.account_id
GROUP BY 1, 2""", ROWS), "rev:8 cost:8 max_cpc:6 roas:6")

KPI_NAMES = ["AFRICA", "AMERICA", "ASIA"]


def _pivot(spark, sf):
    rows = kw.attach_account_names(kw.attach_entity(
        perf_rows(spark, sf), view(spark, sf, "keyword_entity")), view(spark, sf, "accounts"))
    return kw.pivot_daily_kpi(kw.daily_kpis(rows, ["account_name"]), "account_name", KPI_NAMES, "cost")


register("keyword_daily_kpi_pivot", _pivot, with_views("keyword_perf keyword_entity accounts", "SELECT date, " + ", ".join(
    f"CASE WHEN count(CASE WHEN account_name = '{n}' THEN 1 END) > 0 THEN coalesce(sum(CASE WHEN account_name = '{n}' "
    f"THEN cost END), 0.0) END AS \"{n}\"" for n in KPI_NAMES) + """
FROM kw_rows r JOIN keyword_entity e ON r.keyword_id = e.keyword_id JOIN accounts a ON a.account_id = e.account_id
GROUP BY 1""", ROWS), " ".join(f"{n}:8" for n in KPI_NAMES))


def _rolling(spark, sf):
    from adyield.operators.sessions import rolling_mean
    daily = kw.daily_kpis(perf_rows(spark, sf))
    return rolling_mean(daily, ["rev", "cost", "clicks"], [3, 7, 14, 30], "date").drop("max_cpc", "roas")


register("keyword_rolling_kpis", _rolling, with_views("keyword_perf", "SELECT date, rev, cost, clicks, " + ", ".join(
    f"CASE WHEN count({c}) OVER w{n} = {n} THEN avg({c}) OVER w{n} END AS {c}_{n}d_avg"
    for n in (3, 7, 14, 30) for c in ("rev", "cost", "clicks")) + """
FROM (SELECT date, coalesce(sum(rev), 0.0) AS rev, coalesce(sum(cost), 0.0) AS cost, coalesce(sum(clicks), 0.0) AS clicks
  FROM kw_rows GROUP BY 1) WINDOW """ + ", ".join(
    f"w{n} AS (ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (3, 7, 14, 30)), ROWS),
         "rev:8 cost:8 " + " ".join(f"{c}_{n}d_avg:8" for n in (3, 7, 14, 30) for c in ("rev", "cost", "clicks")))

FIGURES = ("rev", "cost", "clicks", "max_cpc", "roas")
MEANS = [f"{c}_{n}d_avg" for n in (3, 7, 14, 30) for c in FIGURES]


def _rolling_relative(spark, sf):
    from adyield.operators.sessions import rolling_mean
    daily = kw.daily_kpis(perf_rows(spark, sf))
    return rolling_mean(daily, FIGURES, [3, 7, 14, 30], "date", relative=True).select("date", *MEANS)


register("keyword_rolling_relative", _rolling_relative, with_views("keyword_perf", "SELECT date, " + ", ".join(
    f"{m} / avg({m}) OVER () AS {m}" for m in MEANS) + " FROM (SELECT date, " + ", ".join(
    f"CASE WHEN count({c}) OVER w{n} = {n} THEN avg({c}) OVER w{n} END AS {c}_{n}d_avg" for n in (3, 7, 14, 30) for c in FIGURES) + """
FROM (SELECT date, coalesce(sum(rev), 0.0) AS rev, coalesce(sum(cost), 0.0) AS cost, coalesce(sum(clicks), 0.0) AS clicks,
    avg(max_cpc) AS max_cpc, coalesce(sum(rev), 0.0) / nullif(sum(cost), 0) AS roas
  FROM kw_rows GROUP BY 1) WINDOW """ + ", ".join(
    f"w{n} AS (ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (3, 7, 14, 30)) + ")", ROWS),
         " ".join(f"{m}:8" for m in MEANS))


# --- keyword bids ------------------------------------------------------------------------
def bids(spark, sf, days=84):
    return keyword_bids.keyword_bids(
        perf_rows(spark, sf, days), view(spark, sf, "keyword_entity"), view(spark, sf, "accounts"), AS_OF)


GROUP = "account_id, geo, campaign_id, adgroup_norm, keyword_norm"
SHARED = ", ".join(f"CASE WHEN geo THEN sum({c}) OVER (PARTITION BY {GROUP}) ELSE {c} END AS {c}"
                   for c in keyword_bids.PERF_COLUMNS)
RATES = f"""{ROWS},
daily AS (
  SELECT date, match, {GROUP}, coalesce(sum(clicks), 0.0) AS clicks, coalesce(sum(rev), 0.0) AS rev
  FROM kw_rows r JOIN keyword_entity e ON r.keyword_id = e.keyword_id GROUP BY ALL),
leveled AS (
  SELECT *, sum(clicks) OVER a AS c1, sum(rev) OVER a AS r1, sum(clicks) OVER c AS c2, sum(rev) OVER c AS r2,
    sum(clicks) OVER t AS c3, sum(rev) OVER t AS r3, exp(-0.03 * date_diff('day', date, DATE '{AS_OF}')) AS decay
  FROM daily WINDOW a AS (PARTITION BY date, match, account_id, geo, campaign_id, adgroup_norm),
    c AS (PARTITION BY date, match, account_id, geo, campaign_id), t AS (PARTITION BY date, match, account_id)),
stacked AS (
  SELECT {GROUP}, date, match, 0 AS level, clicks * decay AS clicks, rev * decay AS rev FROM leveled UNION ALL
  SELECT {GROUP}, date, match, 1, (c1 - clicks) * decay, (r1 - rev) * decay FROM leveled UNION ALL
  SELECT {GROUP}, date, match, 2, (c2 - c1) * decay, (r2 - r1) * decay FROM leveled UNION ALL
  SELECT {GROUP}, date, match, 3, (c3 - c2) * decay, (r3 - r2) * decay FROM leveled),
reached AS (
  SELECT *, sum(clicks) OVER (PARTITION BY {GROUP} ORDER BY level, date DESC, match DESC
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM stacked),
rates AS (
  SELECT {GROUP}, CASE WHEN sum(clicks * share) <> 0 THEN sum(rev * share) / sum(clicks * share) END AS rpc_est
  FROM (SELECT *, CASE WHEN cum < 120 THEN 1.0 WHEN cum - clicks < 120 THEN least(1.0, (120 - (cum - clicks)) / clicks)
    ELSE 0.0 END AS share FROM reached) GROUP BY ALL)"""
BIDS = f"""{RATES},
newest AS (
  SELECT * FROM (SELECT keyword_id, account_num, match, campaign_id, adgroup_id, campaign, adgroup, keyword,
      adgroup_norm, keyword_norm, geo, row_number() OVER (PARTITION BY keyword_id
        ORDER BY transaction_date_time DESC, account_num DESC, match DESC) AS rn FROM kw_rows) WHERE rn = 1),
spans AS (SELECT keyword_id, {SPANS_SQL} FROM kw_rows WHERE date >= DATE '{AS_OF}' - 30 GROUP BY 1),
candidates AS (
  SELECT n.*, e.account_id, CAST(e.latest_max_cpc AS DOUBLE) AS latest_max_cpc,
    {", ".join(f"coalesce({c}, 0.0) AS {c}" for c in keyword_bids.PERF_COLUMNS)},
    {", ".join(f"coalesce({c}, 0.0) AS {c}_raw" for c in keyword_bids.PERF_COLUMNS)}
  FROM newest n JOIN keyword_entity e ON n.keyword_id = e.keyword_id
  JOIN accounts a ON a.account_id = e.account_id AND a.keyword_bidder_enabled = 'Y'
  LEFT JOIN spans s ON s.keyword_id = n.keyword_id),
shared AS (SELECT * REPLACE ({SHARED}), avg(latest_max_cpc) OVER () AS mean_bid FROM candidates),
priced AS (
  SELECT s.* EXCLUDE (latest_max_cpc, mean_bid, rn), coalesce(latest_max_cpc, mean_bid) AS max_cpc_old, rpc_est,
    clicks_sum_7day AS clicks, rev_sum_7day AS rev, cost_sum_7day AS cost, cost_sum_7day / clicks_sum_7day AS cpc_observed,
    rpc_est / 1.02 AS cpc_target
  FROM shared s LEFT JOIN rates r USING (account_id, geo, campaign_id, adgroup_norm, keyword_norm)
  WHERE clicks_sum_7day > 0),
bids AS (
  SELECT *, CASE WHEN cpc_target IS NOT NULL THEN round_even(greatest(least(greatest(cpc_target, max_cpc_old * 0.7),
    max_cpc_old * 1.2), 0.05), 2) END AS max_cpc_new FROM priced)"""
BID_VIEWS = "keyword_perf keyword_entity accounts"

register("keyword_rates", lambda spark, sf: keyword_bids.keyword_rates(kw.group_sums(kw.attach_entity(
    perf_rows(spark, sf), view(spark, sf, "keyword_entity")).na.drop(subset=["match", *kw.GROUP]).na.fill(
        0.0, subset=["clicks", "rev", "cost"]), ["date", "match", *kw.GROUP], kw.PERFORMANCE), AS_OF),
    with_views(BID_VIEWS, f"SELECT {GROUP}, rpc_est FROM rates", RATES), "rpc_est:8")

BID_COLUMNS = ["keyword_id", "account_id", "geo", "campaign_id", "adgroup_norm", "keyword_norm", "match", "clicks", "rev",
               "cost", "cost_sum_7day_raw", "rpc_est", "cpc_observed", "cpc_target", "max_cpc_old", "max_cpc_new",
               "bid_change"]
register("keyword_bids", lambda spark, sf: bids(spark, sf).select(*BID_COLUMNS), with_views(BID_VIEWS, """
SELECT keyword_id, account_id, geo, campaign_id, adgroup_norm, keyword_norm, match, clicks, rev, cost, cost_sum_7day_raw,
  rpc_est, cpc_observed, cpc_target, max_cpc_old, max_cpc_new, max_cpc_new - max_cpc_old AS bid_change FROM bids""", BIDS),
         "rev:8 cost:8 cost_sum_7day_raw:8 rpc_est:7 cpc_observed:7 cpc_target:7 max_cpc_old:4 bid_change:4")

ROAS = ", ".join(f"CASE WHEN abs(cost_sum_{n}day_raw) >= 0.01 THEN abs(rev_sum_{n}day_raw) / "
                 f"(abs(cost_sum_{n}day_raw) + 1e-10) END AS roas_{n}day" for n in kw.SPANS)
register("keyword_bid_top", lambda spark, sf: keyword_bids.top_bids(bids(spark, sf)), with_views(BID_VIEWS, f"""
SELECT keyword_id, round_even(clicks_sum_7day_raw, 2) AS clicks, round_even(rev_sum_7day_raw, 2) AS rev,
  round_even(cost_sum_7day_raw, 2) AS cost, round_even(roas_7day, 2) AS roas, round_even(rpc_est, 2) AS rpc,
  round_even(cpc_target, 2) AS cpc_goal, round_even(cpc_observed, 2) AS cpc_obs, round_even(max_cpc_old, 2) AS cpc_old,
  round_even(max_cpc_new, 2) AS cpc_new
FROM (SELECT *, {ROAS} FROM bids) ORDER BY cost_sum_7day_raw DESC, keyword_id LIMIT 20""", BIDS))

register("keyword_bid_summary", lambda spark, sf: keyword_bids.window_summary(bids(spark, sf)), with_views(
    BID_VIEWS, "\nUNION ALL\n".join(f"""SELECT CAST({n} AS INT) AS days, """ + ", ".join(
        f"sum({m}) AS {name}_sum, avg({m}) AS {name}_mean" for name, m in (
            ("clicks", f"clicks_sum_{n}day_raw"), ("rev", f"rev_sum_{n}day_raw"), ("cost", f"cost_sum_{n}day_raw"),
            ("roas", f"roas_{n}day"))) + f" FROM (SELECT *, {ROAS} FROM bids)" for n in kw.SPANS), BIDS),
    "clicks_mean:6 rev_sum:8 rev_mean:6 cost_sum:8 cost_mean:6 roas_sum:6 roas_mean:6")

register("keyword_bid_check", lambda spark, sf: keyword_bids.bid_check(bids(spark, sf)), with_views(BID_VIEWS, """
SELECT *, CASE WHEN total_roas < 1 OR rel_roas_miss_delta >= 0.25 THEN 'WARN' ELSE 'PASS' END AS status
FROM (SELECT *, abs(roas_miss_delta) / nullif(least(abs(roas_miss), abs(total_roas_delta_est)), 0) AS rel_roas_miss_delta
  FROM (SELECT *, roas_miss - total_roas_delta_est AS roas_miss_delta
    FROM (SELECT *, 1.02 - total_roas AS roas_miss, (rev + total_rev_delta_est) / (cost + total_cost_delta_est) - total_roas
        AS total_roas_delta_est
      FROM (SELECT sum(cost_sum_7day_raw) AS cost, sum(rev_sum_7day_raw) AS rev,
          sum(cost_sum_7day_raw * change) AS total_cost_delta_est, sum(rev_sum_7day_raw * change) AS total_rev_delta_est,
          sum(rev_sum_7day_raw) / sum(cost_sum_7day_raw) AS total_roas
        FROM (SELECT *, max_cpc_new / greatest(max_cpc_old, 0.05) - 1 AS change FROM bids)))))""", BIDS),
         "cost:8 rev:8 total_cost_delta_est:8 total_rev_delta_est:8 total_roas:7 total_roas_delta_est:7 roas_miss:7 "
         "roas_miss_delta:7 rel_roas_miss_delta:5")

register("keyword_bid_projection_identity", lambda spark, sf: keyword_bids.projection_identity(bids(spark, sf)).select(
    (F.col("cost_gap") < 1e-9).alias("cost_ok"), (F.col("rev_gap") < 1e-9).alias("rev_ok")),
    "SELECT TRUE AS cost_ok, TRUE AS rev_ok")

register("keyword_geo_shares", lambda spark, sf: kw.geo_shares(perf_rows(spark, sf), bids(spark, sf)), with_views(BID_VIEWS, """
SELECT (SELECT avg(CAST(geo AS INT)) FROM kw_rows) AS row_share,
  (SELECT avg(CAST(geo AS INT)) FROM (SELECT DISTINCT keyword_id, geo FROM kw_rows)) AS keyword_share,
  (SELECT avg(CAST(g AS INT)) FROM (SELECT campaign, max(geo) AS g FROM kw_rows GROUP BY 1)) AS campaign_share,
  (SELECT avg(CAST(geo AS INT)) FROM bids) AS bid_share""", BIDS),
         "row_share:9 keyword_share:9 campaign_share:9 bid_share:9")

register("keyword_upsample_check", lambda spark, sf: kw.upsample_check(bids(spark, sf), perf_rows(spark, sf), AS_OF),
         with_views(BID_VIEWS, f"""
SELECT b.geo, abs(b.clicks - r.clicks) / r.clicks AS clicks_gap, abs(b.rev - r.rev) / r.rev AS rev_gap,
  abs(b.cost - r.cost) / r.cost AS cost_gap
FROM (SELECT geo, sum(clicks) AS clicks, sum(rev) AS rev, sum(cost) AS cost FROM bids GROUP BY 1) b
JOIN (SELECT geo, sum(clicks) AS clicks, sum(rev) AS rev, sum(cost) AS cost FROM kw_rows
  WHERE date >= DATE '{AS_OF}' - 7 GROUP BY 1) r ON b.geo = r.geo""", BIDS), "clicks_gap:8 rev_gap:8 cost_gap:8")

register("keyword_bid_jitter", lambda spark, sf: keyword_bids.jittered_bids(bids(spark, sf)).select(
    "keyword_id", "max_cpc_old", "max_cpc_test"), with_views(BID_VIEWS, f"""
SELECT keyword_id, max_cpc_old, round_even(max_cpc_old + {drawn('keyword_id', 1)} * 0.02::DOUBLE - 0.01::DOUBLE, 2) AS max_cpc_test
FROM bids""", BIDS), "max_cpc_old:6 max_cpc_test:4")

register("keyword_rate_error", lambda spark, sf: keyword_bids.roas_error(bids(spark, sf)), with_views(BID_VIEWS, """
SELECT keyword_id, rpc_est, rev / clicks AS rpc_observed,
  CASE WHEN rev <> 0 THEN abs((rpc_est - rev / clicks) / (rev / clicks)) END AS rel_error FROM bids""", BIDS),
         "rpc_est:7 rpc_observed:7 rel_error:6")


def outputs(spark, sf):
    written = view(spark, sf, "keyword_entity").select("keyword_id", "account_id", "latest_max_cpc")
    return written.unionByName(written)


register("bid_publish_set", lambda spark, sf: keyword_bids.publish_set(outputs(spark, sf)), with_views("keyword_entity", """
SELECT DISTINCT keyword_id, account_id, CAST(latest_max_cpc AS DOUBLE) AS latest_max_cpc FROM (
  SELECT * FROM keyword_entity UNION ALL SELECT * FROM keyword_entity)"""), "latest_max_cpc:4")
register("bid_publish_check", lambda spark, sf: keyword_bids.publish_check(outputs(spark, sf)), with_views("keyword_entity", """
SELECT 2 * count(*) AS written, count(*) AS distinct_bids, TRUE AS halves FROM (SELECT DISTINCT * FROM keyword_entity)"""))


def resets(spark, sf):
    return view(spark, sf, "accounts").select("account_id", F.date_sub(
        F.lit("2001-10-25").cast("date"), F.col("account_id") * 7).alias("reset_date"))


register("keyword_bid_reset", lambda spark, sf: kw.reset_bids(kw.attach_entity(
    perf_rows(spark, sf, 360), view(spark, sf, "keyword_entity")), resets(spark, sf)), with_views(BID_VIEWS, """
SELECT keyword_id, account_id, campaign_id, adgroup_id, clicks, round_even(coalesce(max_cpc,
  CASE WHEN sum(clicks) OVER g <> 0 THEN coalesce(sum(max_cpc * clicks) OVER g, 0.0) / sum(clicks) OVER g END,
  CASE WHEN sum(clicks) OVER c <> 0 THEN coalesce(sum(max_cpc * clicks) OVER c, 0.0) / sum(clicks) OVER c END,
  CASE WHEN sum(clicks) OVER a <> 0 THEN coalesce(sum(max_cpc * clicks) OVER a, 0.0) / sum(clicks) OVER a END), 2) AS max_cpc
FROM attrs LEFT JOIN week USING (keyword_id)
WINDOW g AS (PARTITION BY adgroup_id), c AS (PARTITION BY campaign_id), a AS (PARTITION BY account_id)""",
    rows_sql(360) + """,
scoped AS (
  SELECT r.*, e.account_id, CAST(DATE '2001-10-25' - CAST(a.account_id * 7 AS INT) AS DATE) AS reset_date
  FROM kw_rows r JOIN keyword_entity e ON r.keyword_id = e.keyword_id JOIN accounts a ON a.account_id = e.account_id),
attrs AS (SELECT DISTINCT keyword_id, account_id, campaign_id, adgroup_id FROM scoped),
week AS (SELECT keyword_id, avg(max_cpc) AS max_cpc, sum(clicks) AS clicks FROM scoped
  WHERE date > reset_date - 7 AND date <= reset_date GROUP BY 1)"""))

# --- channel bids ------------------------------------------------------------------------
CHANNEL_AS_OF = "2024-01-31"


def channel_sql(campaign: str, condition: str) -> str:
    return f"""base AS (SELECT *, max(date) OVER () AS yesterday FROM channel_cost),
chosen AS (SELECT * FROM base WHERE contains(campaign, '{campaign}')),
clicked AS (SELECT DISTINCT campaign, pub, channel FROM chosen WHERE clicks > 0 AND date = yesterday),
daily AS (SELECT date_diff('day', date, yesterday) AS days_back, campaign, pub, channel, sum(clicks) AS clicks,
    sum(rev) AS rev, sum(cost) AS cost FROM chosen WHERE {condition} GROUP BY 1, 2, 3, 4),
leveled AS (
  SELECT *, sum(clicks) OVER p AS c1, sum(rev) OVER p AS r1, sum(clicks) OVER m AS c2, sum(rev) OVER m AS r2,
    exp(-0.03 * (days_back - 1)) AS decay
  FROM daily WINDOW p AS (PARTITION BY days_back, campaign, pub), m AS (PARTITION BY days_back, campaign)),
stacked AS (
  SELECT campaign, pub, channel, days_back, 0 AS level, clicks * decay AS clicks, rev * decay AS rev FROM leveled UNION ALL
  SELECT campaign, pub, channel, days_back, 1, (c1 - clicks) * decay, (r1 - rev) * decay FROM leveled UNION ALL
  SELECT campaign, pub, channel, days_back, 2, (c2 - c1) * decay, (r2 - r1) * decay FROM leveled UNION ALL
  SELECT DISTINCT campaign, pub, channel, 0, 3, (SELECT sum(clicks) FROM daily), (SELECT sum(rev) / 2 FROM daily) FROM leveled),
rates AS (
  SELECT campaign, pub, channel, sum(rev * share) / sum(clicks * share) AS rpc_est FROM (
    SELECT *, CASE WHEN cum < 60 THEN 1.0 WHEN cum - clicks < 60 THEN least(1.0, (60 - (cum - clicks)) / clicks) ELSE 0.0 END AS share
    FROM (SELECT *, sum(clicks) OVER (PARTITION BY campaign, pub, channel ORDER BY level, days_back
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM stacked)) GROUP BY 1, 2, 3)"""


for _campaign in ("U65", "O65"):
    register(f"channel_bids_{_campaign.lower()}", lambda spark, sf, c=_campaign: channel_bids.channel_bids(
        view(spark, sf, "channel_cost"), CHANNEL_AS_OF, c), with_views("channel_cost", """
SELECT d.campaign, d.pub, d.channel, d.clicks, d.rev, d.cost, rpc_est, cost / clicks AS cpc_y, rpc_est / 1.2 AS cpc_target,
  rpc_est / 1.2 / (cost / clicks) - 1 AS bid_change
FROM daily d JOIN clicked USING (campaign, pub, channel) JOIN rates USING (campaign, pub, channel)
WHERE days_back = 0""", channel_sql(_campaign, "isodow(date) < 6")),
             "rev:4 cost:8 rpc_est:7 cpc_y:7 cpc_target:7 bid_change:6")

register("channel_same_day_type", lambda spark, sf: channel_bids.same_day_type(
    view(spark, sf, "channel_cost"), "2024-01-28").select("date", "channel", "clicks"), with_views("channel_cost", """
SELECT date, channel, clicks FROM channel_cost WHERE isodow(date) >= 6"""))

register("scalar_rounding", lambda spark, sf: view(spark, sf, "lead_score_sample").select(
    "row_id", numeric.floor_to_twentieth(F.col("lead_score")).alias("floored"),
    numeric.round_to_twentieth(F.col("lead_score") + 0.0101).alias("rounded"),
    numeric.scaled_modifier(F.col("lead_score"), 0.75).alias("scaled"),
    numeric.bid_clip(F.col("lead_score"), F.lit(0.5), F.lit(-0.3), F.lit(0.2), F.lit(0.05)).alias("clipped")),
    with_views("lead_score_sample", """
SELECT row_id, floor(lead_score * 20) / 20.0 AS floored,
  round_even(round_even((lead_score + 0.0101) / 0.05, 0) * 0.05, 2) AS rounded, (lead_score - 1) * 0.75 + 1 AS scaled,
  round_even(greatest(least(greatest(lead_score, 0.35), 0.6), 0.05), 2) AS clipped FROM lead_score_sample"""), "scaled:9")
