"""Campaign objects, clusters, publisher bids, targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from adyield.operators import campaigns as cp, clusters as cl, geo, structure as st, tree
from adyield.plans import campaign_plan, publisher_bids as pb
from adyield.session import checkpointed
from checks.registry import register
from checks.sessions import ALL, DEVICE, OS, UNIFIED, daily_sql, rps_daily
from checks.views import view, with_views

AS_OF = "2024-01-30"
SPLIT = ["state", "device", "keyword"]

# --- campaign objects --------------------------------------------------------------------
DAY_LIST = "['MONDAY', 'TUESDAY', 'WEDNESDAY', 'THURSDAY', 'FRIDAY', 'SATURDAY', 'SUNDAY']"
PARSED = """parsed AS (
  SELECT *, json_extract_string(body, '$.id') AS id, json_extract_string(body, '$.activity_schedule.mode') AS mode,
    from_json(json_extract(body, '$.activity_schedule.rules'), '[{"type":"VARCHAR","day":"VARCHAR","from_hour":"INTEGER","until_hour":"INTEGER"}]') AS rules
  FROM campaign_bodies)"""
HOURS = f"""{PARSED},
slots AS (SELECT id, version, mode, unnest(range(168)) AS slot FROM parsed),
ruled AS (SELECT id, version, (list_position({DAY_LIST}, upper(rule.day)) - 1) * 24 + unnest(range(rule.from_hour, rule.until_hour)) AS slot,
    arg_max(rule.type, no) AS type
  FROM (SELECT id, version, unnest(rules) AS rule, unnest(range(len(rules))) AS no FROM parsed) GROUP BY 1, 2, 3),
hours AS (SELECT id, version, {DAY_LIST}[slot // 24 + 1] AS day, CAST(slot % 24 AS INT) AS hour,
    CAST(CASE WHEN mode = 'ALWAYS' OR type = 'INCLUDE' THEN 1 ELSE 0 END AS INT) AS value
  FROM slots LEFT JOIN ruled USING (id, version, slot))"""

register("campaign_activity_hours", lambda spark, sf: cp.activity_hours(view(spark, sf, "campaign_bodies"), ["id", "version"]),
         with_views("campaign_bodies", "SELECT id, version, day, hour, value FROM hours", HOURS))

VERSION = ["id", "version"]
register("campaign_flatten", lambda spark, sf: cp.flatten_campaigns(view(spark, sf, "campaign_bodies"), VERSION),
         with_views("campaign_bodies", f"""
SELECT id, version, 'attrs' AS section, key, json_extract_string(body, '$.' || key) AS value FROM parsed
  CROSS JOIN (SELECT unnest({cp.ATTRIBUTES!r}) AS key)
UNION ALL SELECT id, version, 'platform_targeting', json_extract_string(body, '$.platform_targeting.type') || ':' ||
  unnest(from_json(json_extract(body, '$.platform_targeting.value'), '["VARCHAR"]')), '1' FROM parsed
UNION ALL SELECT id, version, 'activity_schedule', day || ':' || hour, CAST(value AS VARCHAR) FROM hours
UNION ALL SELECT id, version, 'publisher_bid_modifier', json_extract_string(body, '$.publisher_bid_modifier.values[0].target'),
  json_extract_string(body, '$.publisher_bid_modifier.values[0].bid_modification') FROM parsed""", HOURS))

register("campaign_sparsity", lambda spark, sf: cp.sparsity(cp.flatten_campaigns(view(spark, sf, "campaign_bodies"), VERSION).filter(
    "section <> 'attrs'"), VERSION).select("campaigns", "columns", "sparsity"), with_views("campaign_bodies", """
SELECT campaigns, columns, 1 - filled / (campaigns * columns) AS sparsity
FROM (SELECT count(DISTINCT (id, version)) AS campaigns, count(DISTINCT (section, key)) AS columns, count(*) FILTER (value <> '0') AS filled FROM flat)""", HOURS + """,
flat AS (SELECT id, version, 'platform_targeting' AS section, unnest(from_json(json_extract(body, '$.platform_targeting.value'), '["VARCHAR"]')) AS key,
    '1' AS value FROM parsed
  UNION ALL SELECT id, version, 'activity_schedule', day || ':' || hour, CAST(value AS VARCHAR) FROM hours
  UNION ALL SELECT id, version, 'publisher_bid_modifier', json_extract_string(body, '$.publisher_bid_modifier.values[0].target'), '1.5' FROM parsed)"""),
    "sparsity:9")

register("campaign_latest_updates", lambda spark, sf: cp.latest_updates(view(spark, sf, "campaign_updates"), order="version"),
         with_views("campaign_updates", """
SELECT account_id, campaign_id, date, version, update_json, schedule_json FROM (SELECT *, row_number() OVER (
  PARTITION BY account_id, campaign_id ORDER BY version DESC) AS rn FROM campaign_updates) WHERE rn = 1"""))
register("campaign_latest_updates_by_schedule", lambda spark, sf: cp.latest_updates(
    view(spark, sf, "campaign_updates"), True, "version"), with_views("campaign_updates", """
SELECT account_id, campaign_id, date, version, update_json, schedule_json FROM (SELECT *, row_number() OVER (
  PARTITION BY account_id, campaign_id, schedule_json ORDER BY version DESC) AS rn FROM campaign_updates) WHERE rn = 1"""))
register("campaign_latest_bodies", lambda spark, sf: cp.latest_campaigns(view(spark, sf, "campaign_bodies"), AS_OF, "version").select(
    "campaign_id", "date", "version"), with_views("campaign_bodies", f"""
SELECT id AS campaign_id, date, version FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM parsed)
WHERE rn = 1 AND json_extract_string(body, '$.is_active') = 'true' AND date >= DATE '{AS_OF}'""", PARSED))
register("campaign_updates_parsed", lambda spark, sf: cp.parse_updates(view(spark, sf, "campaign_updates")).select(
    "campaign_id", "version", F.col("update.cpc").alias("cpc"), F.array_join(F.col("schedule.day").cast("array<string>"), ",").alias("days"),
    F.aggregate("schedule.bid_modifier", F.lit(0.0), lambda a, b: a + b).alias("total")), with_views("campaign_updates", """
SELECT campaign_id, version, CAST(json_extract_string(update_json, '$.cpc') AS DOUBLE) AS cpc,
  array_to_string(from_json(json_extract(schedule_json, '$.day'), '["INTEGER"]'), ',') AS days,
  list_sum(from_json(json_extract(schedule_json, '$.bid_modifier'), '["DOUBLE"]')) AS total FROM campaign_updates"""), "cpc:4 total:6")
register("campaign_schedule_hours", lambda spark, sf: cp.schedule_hours(
    view(spark, sf, "campaign_updates").withColumnRenamed("version", "datetime")), with_views("campaign_updates", """
SELECT account_id, campaign_id, CAST(unnest(from_json(json_extract(schedule_json, '$.hour'), '["INTEGER"]')) AS DOUBLE) AS hour
FROM (SELECT *, row_number() OVER (PARTITION BY account_id, campaign_id ORDER BY version DESC) AS rn FROM campaign_updates) WHERE rn = 1"""), "hour:2")
register("campaign_management_table", lambda spark, sf: cp.management_table(view(spark, sf, "campaign_config").select(
    "id", F.col("automatically_managed").alias("created")), AS_OF).drop("created_datetime"), with_views("campaign_config", f"""
SELECT automatically_managed AS created, id, DATE '{AS_OF}' AS created_date, CAST(1.0 AS DOUBLE) AS baseline_cpc, FALSE AS active,
  TRUE AS automatically_managed FROM campaign_config"""), "baseline_cpc:2")

# --- publisher bids ----------------------------------------------------------------------
DAILY = daily_sql("campaign_id, state, device, keyword, utc_dt", f"{DEVICE} AS device")


def observed(spark, sf):
    """Daily rows with the observed figure standing in for the model's estimate."""
    return rps_daily(spark, sf).withColumn("rps_est", F.col("rps"))


RECENT = f"""{UNIFIED},
daily AS MATERIALIZED ({DAILY}),
recent AS (SELECT * REPLACE (CAST(campaign_id AS VARCHAR) AS campaign_id) FROM daily WHERE utc_dt > DATE '{AS_OF}' - 7),
by_campaign AS (SELECT campaign_id, sum(rps * sessions) / sum(sessions) AS rps_est FROM recent GROUP BY 1),
by_publisher AS (SELECT campaign_id, keyword AS publisher, sum(rps * sessions) / sum(sessions) AS rps_est FROM recent GROUP BY 1, 2)"""
register("campaign_estimates", lambda spark, sf: pb.recent_estimates(observed(spark, sf), AS_OF)[0],
         with_views(ALL, "SELECT * FROM by_campaign", RECENT), "rps_est:9")
register("publisher_estimates", lambda spark, sf: pb.recent_estimates(observed(spark, sf), AS_OF)[1],
         with_views(ALL, "SELECT * FROM by_publisher", RECENT), "rps_est:9")


def cpc(spark, sf, clip=False):
    by_campaign, by_publisher = pb.recent_estimates(observed(spark, sf), AS_OF)
    table = pb.campaign_cpc(view(spark, sf, "campaign_bodies"), by_campaign, view(spark, sf, "campaign_config"), AS_OF, clip=clip, order="version")
    return table, by_publisher


def bid_sql(clip: bool) -> str:
    def clipped(target: str, old: str) -> str:
        return f"CASE WHEN {target} IS NOT NULL THEN least(greatest({target}, {old} * 0.7), {old} * 1.2) END" if clip else target

    return f"""{RECENT},
{PARSED},
active AS (SELECT id AS campaign_id, json_extract_string(body, '$.advertiser_id') AS account_id, CAST(json_extract_string(body, '$.cpc') AS DOUBLE) AS cpc,
    json_extract_string(body, '$.publisher_bid_modifier.values[0].target') AS target
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM parsed)
  WHERE rn = 1 AND json_extract_string(body, '$.is_active') = 'true' AND date >= DATE '{AS_OF}'),
priced AS (SELECT a.*, c.baseline_cpc, coalesce({clipped('b.rps_est / 0.8', 'a.cpc')}, a.cpc) AS cpc_new FROM active a
  LEFT JOIN by_campaign b ON a.campaign_id = b.campaign_id LEFT JOIN campaign_config c ON c.id = a.campaign_id AND c.automatically_managed),
cells AS (
  SELECT a.campaign_id, p.publisher, CASE WHEN a.target = p.publisher THEN 1.5 END AS old, {clipped('b.rps_est / 0.8', "coalesce(CASE WHEN a.target = p.publisher THEN 1.5 END, 1.0) * a.cpc")} / a.cpc_new AS new
  FROM priced a CROSS JOIN publishers p LEFT JOIN by_publisher b ON b.campaign_id = a.campaign_id AND b.publisher = p.publisher
  WHERE a.target = p.publisher OR b.rps_est IS NOT NULL),
modifiers AS (SELECT campaign_id, publisher, coalesce(CASE WHEN max(abs(new - 1)) OVER (PARTITION BY publisher) >= 0.01 THEN new END, old) AS modifier FROM cells)"""


BID_VIEWS = ALL + " campaign_bodies campaign_config publishers"
for _clip in (False, True):
    _suffix = "_clipped" if _clip else ""
    register(f"campaign_cpc{_suffix}", lambda spark, sf, c=_clip: cpc(spark, sf, c)[0].select(
        "campaign_id", "account_id", "cpc", "cpc_new", "baseline_cpc").withColumn("baseline_cpc", F.col("baseline_cpc").cast("double")),
        with_views(BID_VIEWS, "SELECT campaign_id, account_id, cpc, cpc_new, CAST(baseline_cpc AS DOUBLE) AS baseline_cpc FROM priced",
                   bid_sql(_clip)), "cpc_new:9 baseline_cpc:2")

    def _modifiers(spark, sf, clip=_clip):
        table, by_publisher = cpc(spark, sf, clip)
        return pb.publisher_modifiers(table, by_publisher, view(spark, sf, "publishers"), clip=clip)

    register(f"publisher_modifiers{_suffix}", _modifiers, with_views(BID_VIEWS, "SELECT * FROM modifiers", bid_sql(_clip)), "modifier:9")


def _payloads(spark, sf):
    """The update JSON read back: bid, number of modifiers and excluded publishers, first modifier."""
    table, by_publisher = cpc(spark, sf)
    updates = cp.update_payloads(table, pb.publisher_modifiers(table, by_publisher, view(spark, sf, "publishers")), 3, 2)
    parsed = updates.withColumn("u", F.from_json("update", cp.UPDATE))
    return parsed.select(
        "account_id", "campaign_id", F.col("u.cpc").alias("cpc"), F.array_join(F.transform(
            "u.publisher_bid_modifier.values", lambda v: v["target"]), ",").alias("targets"),
        F.array_join("u.publisher_targeting.values", ",").alias("excluded"))


register("campaign_update_payloads", _payloads, with_views(BID_VIEWS, """
SELECT account_id, p.campaign_id, round_even(cpc_new, 2) AS cpc, coalesce(string_agg(publisher, ',' ORDER BY r) FILTER (r < 3), '') AS targets,
  coalesce(string_agg(publisher, ',' ORDER BY r) FILTER (r >= 3 AND up >= 2), '') AS excluded
FROM priced p LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY campaign_id ORDER BY modifier DESC, publisher) - 1 AS r,
    row_number() OVER (PARTITION BY campaign_id ORDER BY modifier, publisher DESC) - 1 AS up
  FROM (SELECT campaign_id, publisher, round_even(modifier, 2) AS modifier FROM modifiers WHERE round_even(modifier, 2) <> 0)) m ON m.campaign_id = p.campaign_id
GROUP BY account_id, p.campaign_id, cpc_new""", bid_sql(False)))

register("campaign_daily_roas", lambda spark, sf: pb.campaign_roas(rps_daily(spark, sf), view(spark, sf, "campaign_bodies"), AS_OF, "version"),
         with_views(BID_VIEWS, """
SELECT utc_dt, d.campaign_id, sum(revenue) AS revenue, sum(cpc * sessions) AS cost, sum(revenue) / sum(cpc * sessions) AS roas
FROM (SELECT * REPLACE (CAST(campaign_id AS VARCHAR) AS campaign_id) FROM daily) d JOIN active a ON a.campaign_id = d.campaign_id GROUP BY 1, 2""", bid_sql(False)),
         "revenue:4 cost:4 roas:9")
register("publisher_set_differences", lambda spark, sf: pb.unknown_publishers(rps_daily(spark, sf), view(spark, sf, "publishers")),
         with_views(ALL + " publishers", f"""
SELECT publisher, CASE WHEN s AND a THEN 'both' WHEN s THEN 'seen only' ELSE 'allowed only' END AS side FROM (
  SELECT publisher, max(s) AS s, max(a) AS a FROM (SELECT keyword AS publisher, TRUE AS s, FALSE AS a FROM ({DAILY}) UNION ALL
    SELECT publisher, FALSE, TRUE FROM publishers) GROUP BY 1)""", UNIFIED))

# --- clusters and trees ------------------------------------------------------------------
EVALUATION = "2024-01-21"


def fixed_clusters(spark, sf):
    """Daily rows under a given clustering, so that the reports have a SQL twin."""
    return rps_daily(spark, sf).withColumn("clust", (F.col("campaign_id") % 5).cast("int"))


FIXED = f"{UNIFIED},\nrows AS MATERIALIZED (SELECT *, CAST(campaign_id % 5 AS INT) AS clust FROM ({DAILY}))"
register("clusters_report", lambda spark, sf: cl.cluster_report(fixed_clusters(spark, sf)), with_views(ALL, """
SELECT clust, sum(revenue) AS revenue, CAST(sum(sessions) AS BIGINT) AS sessions, sum(leads) AS leads, sum(rps * sessions) / sum(sessions) AS rps,
  sum(lps * sessions) / sum(sessions) AS lps, sum(coalesce(rpl, 0) * leads) / sum(leads) AS rpl, sum(revenue) / sum(sessions) AS rps_check,
  sum(revenue) / sum(leads) AS rpl_check FROM rows GROUP BY 1""", FIXED), "revenue:4 rps:9 lps:9 rpl:9 rps_check:9 rpl_check:9")
register("clusters_holdout_report", lambda spark, sf: cl.holdout_report(fixed_clusters(spark, sf), SPLIT, EVALUATION), with_views(ALL, f"""
SELECT (SELECT sum(abs(rps - day_rps) * sessions) / sum(sessions) FROM (SELECT *, sum(rps * sessions) OVER d / sum(sessions) OVER d AS day_rps
    FROM rows WINDOW d AS (PARTITION BY clust, utc_dt))) AS rps_mae, b.n AS buckets, b.s AS split_variance, c.n AS clusters, c.s AS cluster_variance
FROM (SELECT count(*) AS n, sqrt(sum(w * v * v) / sum(w) - pow(sum(w * v) / sum(w), 2)) AS s FROM (SELECT sum(sessions) AS w, sum(rps * sessions) / sum(sessions) AS v
    FROM rows WHERE utc_dt >= DATE '{EVALUATION}' GROUP BY state, device, keyword)) b,
  (SELECT count(*) AS n, sqrt(sum(w * v * v) / sum(w) - pow(sum(w * v) / sum(w), 2)) AS s FROM (SELECT sum(sessions) AS w, sum(rps * sessions) / sum(sessions) AS v
    FROM rows WHERE utc_dt >= DATE '{EVALUATION}' GROUP BY clust)) c""", FIXED), "rps_mae:9 split_variance:8 cluster_variance:8")
register("clusters_bucket_means", lambda spark, sf: cl.bucket_means(rps_daily(spark, sf), ["state", "device"]), with_views(ALL, """
SELECT state, device, CAST(sum(sessions) AS BIGINT) AS sessions, sum(revenue) AS revenue, sum(rps * sessions) / sum(sessions) AS rps,
  sum(score * sessions) / sum(sessions) AS score, sum(lps * sessions) / sum(sessions) AS lps, coalesce(sum(rpl * sessions), 0) / sum(sessions) AS rpl
FROM rows GROUP BY 1, 2""", FIXED), "revenue:4 rps:9 score:9 lps:9 rpl:9")
register("clusters_by_mean", lambda spark, sf: cl.mean_clusters(rps_daily(spark, sf), ["state", "device"], 4))
for _similarity, _method in (("cokpi", "mean"), ("cokpi", "stack"), ("correlation", "mean")):
    register(f"clusters_by_curve_{_similarity}_{_method}", lambda spark, sf, s=_similarity, m=_method: cl.curve_clusters(
        checkpointed(rps_daily(spark, sf)), ["state", "device"], 4, similarity=s, method=m))


def _similarity_distances(spark, sf):
    """Squared length of every bucket's similarity row, from the projected vectors."""
    vectors = cl.similarity_table(checkpointed(rps_daily(spark, sf)), ["state", "device"], kpis=["rps", "lps"])
    return vectors.select("state", "device", F.aggregate("v", F.lit(0.0), lambda a, b: a + b * b).alias("length"))


register("clusters_similarity_lengths", _similarity_distances, with_views(ALL, """
SELECT state, device, sum(pow(sim, 2)) AS length FROM (
  SELECT a.state, a.device, b.state AS s2, b.device AS d2, sum(sqrt(a.rps * b.rps)) / max(a.top_rps) / 2 + sum(sqrt(a.lps * b.lps)) / max(a.top_lps) / 2 AS sim
  FROM curves a JOIN curves b ON a.utc_dt = b.utc_dt GROUP BY 1, 2, 3, 4) GROUP BY 1, 2""", FIXED + """,
day_kpis AS (SELECT state, device, utc_dt, sum(rps * sessions) / sum(sessions) AS rps, sum(lps * sessions) / sum(sessions) AS lps FROM rows GROUP BY 1, 2, 3),
axis AS (SELECT DISTINCT state, device, CAST(unnest(generate_series((SELECT min(utc_dt) FROM rows), (SELECT max(utc_dt) FROM rows), INTERVAL 1 DAY)) AS DATE) AS utc_dt FROM rows),
smooth AS MATERIALIZED (SELECT state, device, utc_dt, CASE WHEN count(*) OVER w = 7 THEN avg(coalesce(rps, 0)) OVER w ELSE 0 END AS rps,
    CASE WHEN count(*) OVER w = 7 THEN avg(coalesce(lps, 0)) OVER w ELSE 0 END AS lps
  FROM axis LEFT JOIN day_kpis USING (state, device, utc_dt) WINDOW w AS (PARTITION BY state, device ORDER BY utc_dt ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
tops AS (SELECT max(r) AS top_rps, max(l) AS top_lps FROM (SELECT sum(rps) AS r, sum(lps) AS l FROM smooth GROUP BY state, device)),
curves AS (SELECT * FROM smooth, tops)"""), "length:6")


def fitted(spark, sf):
    rows = checkpointed(rps_daily(spark, sf))
    return rows, tree.fit_tree(rows, SPLIT, 16, min_sessions=10)


def _tree_clusters(spark, sf):
    rows, model = fitted(spark, sf)
    return model.transform(rows).groupBy("clust").agg(
        F.sum("sessions").alias("sessions"), F.sum("revenue").alias("revenue"))


def _tree_estimates(spark, sf):
    rows, model = fitted(spark, sf)
    return tree.estimate_rps(rows, model, session_days=14).select(
        "campaign_id", *SPLIT, "utc_dt", "clust", "rps_est")


# a given tree: twelve leaves under three nodes under the root
GIVEN_PATHS = """SELECT CAST(id AS INT) AS clust, CAST(above AS INT) AS above,
  CAST(CASE above WHEN 0 THEN 100 + id WHEN 1 THEN 10 + id % 3 ELSE 0 END AS INT) AS node
FROM range(12) LATERAL VIEW explode(array(0, 1, 2)) AS above"""


def _tree_rollup(spark, sf, last_whole):
    rows = rps_daily(spark, sf).withColumn("clust", (F.col("campaign_id") % 12).cast("int"))
    return tree.rollup(rows, spark.sql(GIVEN_PATHS), {"lead_volume": "leads", "lead_revenue": "revenue"}, "leads", 15, last_whole)


for _last in (True, False):
    register(f"tree_rollup_{'whole' if _last else 'part'}", lambda spark, sf, w=_last: _tree_rollup(spark, sf, w), with_views(ALL, f"""
SELECT clust, utc_dt, a0 * s0 + a1 * s1 + a2 * s2 AS lead_volume, b0 * s0 + b1 * s1 + b2 * s2 AS lead_revenue
FROM (SELECT *, CASE WHEN ({_last} AND clust = 11) OR a0 < 15 THEN 1 ELSE 15 / a0 END AS s0,
    CASE WHEN a0 + a1 < 15 THEN 1 WHEN a0 < 15 THEN (15 - a0) / a1 ELSE 0 END AS s1,
    CASE WHEN a0 + a1 + a2 < 15 THEN 1 WHEN a0 + a1 < 15 THEN (15 - a0 - a1) / a2 ELSE 0 END AS s2
  FROM (SELECT clust, utc_dt, w AS a0, greatest(w1 - w, 0) AS a1, greatest(w2 - greatest(w, w1), 0) AS a2,
      y AS b0, greatest(y1 - y, 0) AS b1, greatest(y2 - greatest(y, y1), 0) AS b2
    FROM (SELECT *, sum(w) OVER (PARTITION BY utc_dt, clust % 3) AS w1, sum(y) OVER (PARTITION BY utc_dt, clust % 3) AS y1,
        sum(w) OVER (PARTITION BY utc_dt) AS w2, sum(y) OVER (PARTITION BY utc_dt) AS y2
      FROM (SELECT CAST(campaign_id % 12 AS INT) AS clust, utc_dt,
          CAST(sum(leads) AS DOUBLE) AS w, CAST(sum(revenue) AS DOUBLE) AS y FROM rows GROUP BY 1, 2))))""", FIXED), "lead_volume:6 lead_revenue:6")

register("tree_clusters", _tree_clusters)
register("tree_estimates", _tree_estimates)
register("clusters_hybrid", lambda spark, sf: cl.hybrid_clusters(rps_daily(spark, sf), ["state", "device"], 4, 10)[1].groupBy("clust").agg(
    F.sum("sessions").alias("sessions")))
register("days_filled", lambda spark, sf: tree.fill_days(rps_daily(spark, sf, ("state", "device", "utc_dt")), ["state", "device"], ["sessions"],
                                                         rps_daily(spark, sf)).select("state", "device", "utc_dt", "sessions"), with_views(ALL, f"""
SELECT state, device, utc_dt, last_value(sessions IGNORE NULLS) OVER (PARTITION BY state, device ORDER BY utc_dt
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sessions
FROM (SELECT DISTINCT state, device, CAST(unnest(generate_series((SELECT min(utc_dt) FROM rows), (SELECT max(utc_dt) FROM rows), INTERVAL 1 DAY)) AS DATE) AS utc_dt FROM rows)
LEFT JOIN (SELECT state, device, utc_dt, CAST(sum(sessions) AS BIGINT) AS sessions FROM rows GROUP BY 1, 2, 3) USING (state, device, utc_dt)""", FIXED))


def _publisher_bids(spark, sf):
    rows, model = fitted(spark, sf)
    return pb.publisher_bids(rows, model, view(spark, sf, "campaign_bodies"), view(spark, sf, "campaign_config"),
                             view(spark, sf, "publishers"), AS_OF, order="version")


register("publisher_bids", _publisher_bids)

# --- campaign structure ------------------------------------------------------------------
register("structure_weight_threshold", lambda spark, sf: st.weight_threshold(rps_daily(spark, sf), "sessions", 0.8), with_views(ALL, """
SELECT CAST(coalesce(max(w) FILTER (before > total * 0.8), min(w)) AS DOUBLE) AS threshold FROM (
  SELECT sessions AS w, sum(sessions) OVER (ORDER BY sessions DESC, rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - sessions AS before,
    sum(sessions) OVER () AS total FROM (SELECT sessions, row_number() OVER () AS rn FROM rows))""", FIXED))


def structure(spark, sf):
    return st.campaign_structure(fixed_clusters(spark, sf), ["device", "state"], "keyword")


STRUCTURE = f"""{FIXED},
structure AS MATERIALIZED (SELECT device, state, clust, CAST(sum(sessions) AS BIGINT) AS sessions, sum(rps_avg * sessions) / sum(sessions) AS rps_avg,
    list_sort(list(DISTINCT keyword)) AS keyword FROM rows GROUP BY 1, 2, 3)"""
register("structure_campaigns", lambda spark, sf: structure(spark, sf).withColumn("keyword", F.array_join("keyword", ",")),
         with_views(ALL, "SELECT * REPLACE (array_to_string(keyword, ',') AS keyword) FROM structure", STRUCTURE), "rps_avg:9")
def _coverage(spark, sf):
    rows = checkpointed(fixed_clusters(spark, sf))
    return st.coverage_check(st.campaign_structure(rows, ["device", "state"], "keyword"), rows)


register("structure_coverage", _coverage, with_views(ALL, """
SELECT CAST(sum(sessions) AS BIGINT) AS input_sessions, sum(rps_avg * sessions) / sum(sessions) AS input_rps,
  CAST(sum(sessions) AS BIGINT) AS campaign_sessions, sum(rps_avg * sessions) / sum(sessions) AS campaign_rps FROM rows""", FIXED), "input_rps:9 campaign_rps:9")
LISTS = f"""{STRUCTURE},
lists AS (
  SELECT sessions AS sessions_60d, rps_avg AS rps_avg_60d, device, state, 'INCLUDE' AS type, array_to_string(keyword, ',') AS listed FROM structure
  WHERE sessions > (SELECT greatest(sum(sessions) / 3000.0, 100) FROM structure)
  UNION ALL SELECT NULL, NULL, device, state, 'EXCLUDE', array_to_string(list_sort(flatten(list(keyword))), ',') FROM structure GROUP BY device, state)"""
register("structure_targeting_lists", lambda spark, sf: st.targeting_lists(structure(spark, sf), ["device", "state"], "keyword").select(
    "sessions_60d", "rps_avg_60d", F.col("device")["INCLUDE"][0].alias("device"), F.col("state")["INCLUDE"][0].alias("state"),
    F.map_keys("keyword")[0].alias("type"), F.array_join(F.map_values("keyword")[0], ",").alias("listed")),
    with_views(ALL, "SELECT * FROM lists", LISTS), "rps_avg_60d:9")


def _systems(spark, sf):
    lists = st.expand_systems(st.targeting_lists(structure(spark, sf), ["device", "state"], "keyword"))
    return st.targeting_payload(lists, ["device", "state", "operating_system"]).select(
        "sessions_60d", F.col("device")["INCLUDE"][0].alias("device"), F.col("state")["INCLUDE"][0].alias("state"),
        F.map_keys("keyword")[0].alias("type"), F.col("operating_system")["INCLUDE"][0].alias("os"), "targeting", "created")


register("structure_system_payloads", _systems, with_views(ALL, """
SELECT sessions_60d, device, state, type, os, '{"platform_targeting":{"type":"INCLUDE","value":["' || device || '"]},"sub_country_targeting":{"type":"INCLUDE","value":["'
  || state || '"]},"os_targeting":{"type":"INCLUDE","value":[{"os_family":"' || os || '"}]}}' AS targeting, FALSE AS created
FROM (SELECT *, unnest(CASE device WHEN 'DESK' THEN ['Mac_OS_X', 'Linux', 'Windows'] WHEN 'PHON' THEN ['iOS', 'Android'] WHEN 'TBLT' THEN ['iPadOS', 'Android'] END) AS os FROM lists)""", LISTS))


def _method_report(spark, sf):
    splits = {"state_device": (rps_daily(spark, sf, ("state", "device", "utc_dt")), ["state", "device"])}
    return campaign_plan.method_report(splits, EVALUATION, 4)


register("structure_method_report", _method_report)


def _plan(spark, sf):
    rows = checkpointed(rps_daily(spark, sf, ("state", "device", "keyword", "utc_dt")))
    clustered = campaign_plan.clustered_rows(rows, ["state", "device", "keyword"], "tree", EVALUATION, 8, 10)
    return campaign_plan.campaign_plan(clustered, ["state", "device", "keyword"]).select("sessions_60d", "targeting")


register("structure_campaign_plan", _plan)

# --- targets -----------------------------------------------------------------------------
register("geo_expand_cidr", lambda spark, sf: geo.expand_cidr_blocks(view(spark, sf, "geo_blocks_raw")), with_views("geo_blocks_raw", """
SELECT CAST(bucket // 256 AS VARCHAR) || '.' || CAST(bucket % 256 AS VARCHAR) AS ip_index, CAST(greatest(first_ip, bucket * 65536) AS BIGINT) AS start_int,
  CAST(least(last_ip, bucket * 65536 + 65535) AS BIGINT) AS end_int, network, maxmind_id, postal_code
FROM (SELECT *, unnest(range(first_ip // 65536, last_ip // 65536 + 1)) AS bucket FROM (
  SELECT *, first_ip + CAST(pow(2, 32 - CAST(split_part(network, '/', 2) AS INT)) AS BIGINT) - 1 AS last_ip FROM (
    SELECT *, CAST(split_part(network, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(network, '.', 2) AS BIGINT) * 65536
      + CAST(split_part(network, '.', 3) AS BIGINT) * 256 AS first_ip FROM geo_blocks_raw)))"""))
METRO = """metro AS (SELECT dma_code, '(' || string_agg(state, ',' ORDER BY state) || ')' AS state_list FROM (
  SELECT DISTINCT CAST(metro_code AS INT) AS dma_code, subdivision_1_iso_code AS state FROM geo_locations WHERE country_iso_code = 'US' AND metro_code <> '') GROUP BY 1)"""
register("geo_metro_states", lambda spark, sf: geo.metro_states(view(spark, sf, "geo_locations")),
         with_views("geo_locations", "SELECT * FROM metro", METRO))
TARGETS = """
SELECT CAST('200' || n.dma_code AS BIGINT) AS location_id, name, name || ', ' || state_list || ', United States' AS canonical_name, CAST(2840 AS BIGINT) AS parent_id,
  'US' AS country_code, 'DMA' AS target_type, 'Active' AS status FROM dma_names n JOIN metro m ON n.dma_code = m.dma_code
UNION ALL SELECT 0, 'location unknown', NULL, NULL, NULL, NULL, 'Active'"""


def targets(spark, sf):
    return geo.geo_targets(view(spark, sf, "dma_names"), view(spark, sf, "geo_locations"))


register("geo_targets", targets, with_views("geo_locations dma_names", TARGETS, METRO))
register("geo_targets_newer_version", lambda spark, sf: geo.newer_version(
    targets(spark, sf).withColumn("file_version", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("location_id") % 9).cast("int"))),
    view(spark, sf, "campaign_bodies").select(F.date_sub("date", 25).alias("file_version"))).select("location_id", "file_version"),
    with_views("geo_locations dma_names", f"""
SELECT location_id, file_version FROM (SELECT location_id, CAST(DATE '2024-01-01' + CAST(location_id % 9 AS INT) AS DATE) AS file_version FROM ({TARGETS}))
WHERE file_version > DATE '2024-01-05'""", METRO))
