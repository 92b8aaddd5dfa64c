"""Place statistics, tests, buckets, test groups and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from adyield.operators import joins, locations as loc, ordered, sampling
from adyield.operators.sessions import attach_weighted_mean, deduplicate_sessions
from checks.registry import register
from checks.sessions import ALL, DEVICE, UNIFIED, daily_sql, rps_daily, zip_rows
from checks.slots import GEO, LOCATED, REV, inputs
from checks.views import drawn, view, with_views

FACTS = f"""{LOCATED},
{REV},
facts AS MATERIALIZED (
  SELECT s.session_id, product, subdivision_1_iso_code AS state_code, concat(metro_code, subdivision_1_iso_code) AS dma_state,
    city_name AS city, CASE WHEN r.units > 0 THEN 1 ELSE 0 END AS has_conversion,
    CASE WHEN r.units > 0 THEN r.units / 10000.0 ELSE 0.0 END AS revenue
  FROM located s LEFT JOIN rev r ON s.session_id = r.session_id WHERE subdivision_1_iso_code <> '' AND metro_code <> '')"""


def facts(spark, sf):
    return joins.conversion_facts(*inputs(spark, sf))


def stats_sql(keys: str, least: int) -> str:
    return f"""SELECT {keys}, count(*) AS sessions, CAST(sum(has_conversion) AS BIGINT) AS conversions, sum(revenue) AS revenue,
  sum(revenue) / count(*) AS rps FROM facts GROUP BY {keys} HAVING sum(has_conversion) >= {least}"""


for _name, _keys, _least in (("city", ["product", "state_code", "dma_state", "city"], 100), ("dma", ["product", "state_code", "dma_state"], 1),
                             ("state", ["product", "state_code"], 1), ("product", ["product"], 0)):
    register(f"location_stats_{_name}", lambda spark, sf, k=_keys, m=_least: loc.location_stats(facts(spark, sf), k, m),
             with_views(GEO, stats_sql(", ".join(_keys), _least), FACTS), "revenue:4 rps:9")

register("location_stats_stacked", lambda spark, sf: loc.rates_by({
    "dma": loc.location_stats(facts(spark, sf), ["product", "dma_state"]),
    "state": loc.location_stats(facts(spark, sf), ["product", "state_code"])}), with_views(GEO, f"""
SELECT 'dma' AS level, * EXCLUDE (dma_state) FROM ({stats_sql('product, dma_state', 0)}) UNION ALL
SELECT 'state' AS level, * EXCLUDE (state_code) FROM ({stats_sql('product, state_code', 0)})""", FACTS), "revenue:4 rps:9")

CARVED = ["500NY", "501TX", "503CA"]
register("location_carve_out", lambda spark, sf: loc.location_stats(loc.carve_out_region(facts(spark, sf), CARVED), ["product", "region"], 30),
         with_views(GEO, """
SELECT product, CASE WHEN dma_state IN ('500NY', '501TX', '503CA') THEN dma_state ELSE state_code END AS region, count(*) AS sessions,
  CAST(sum(has_conversion) AS BIGINT) AS conversions, sum(revenue) AS revenue, sum(revenue) / count(*) AS rps
FROM facts GROUP BY 1, 2 HAVING sum(has_conversion) >= 30""", FACTS), "revenue:4 rps:9")

register("location_stats_bayes", lambda spark, sf: loc.location_stats_bayes(facts(spark, sf), ["product", "state_code"], 1).drop(
    "rps_beta", "conversion_rate_beta", "rpl_beta"), with_views(GEO, f"""
SELECT *, log10(sessions) AS sessions_log, log10(revenue) AS revenue_log, conversions / sessions AS conversion_rate,
  rps * conversions / sessions AS rpl, revenue / conversions AS revenue_per_lead FROM ({stats_sql('product, state_code', 1)})""", FACTS),
         "revenue:4 rps:9 sessions_log:9 revenue_log:9 conversion_rate:9 rpl:9 revenue_per_lead:8")
register("location_stats_bayes_tails", lambda spark, sf: loc.location_stats_bayes(facts(spark, sf), ["product", "dma_state"], 1).select(
    "product", "dma_state", "rps_beta", "conversion_rate_beta", "rpl_beta"))

PVALUE = """2 * (0.5 - CASE WHEN abs(t) > 0 THEN exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) * (SELECT sum(
  (CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * pow(1 + pow(abs(t) * i / 2000, 2) / df, -(df + 1) / 2)) * abs(t) / 6000
  FROM (SELECT unnest(range(2001)) AS i)) ELSE 0 END)"""


def tests_sql(parent: str, child: str, least: int) -> str:
    """Welch statistics of a child place against its parent's other rows, re-read directly."""
    join = " AND ".join(f"f.{k.strip()} = c.{k.strip()}" for k in parent.split(","))
    return f"""
SELECT {parent}, {child}, m1 AS parent_rps, m2 AS child_rps, t, df, {PVALUE} AS pval FROM (
  SELECT *, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t,
    pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df
  FROM (SELECT {', '.join('c.' + k.strip() for k in parent.split(','))}, c.{child}, count(*) FILTER (f.{child} <> c.{child}) AS n1,
      avg(revenue) FILTER (f.{child} <> c.{child}) AS m1, var_samp(revenue) FILTER (f.{child} <> c.{child}) AS v1,
      count(*) FILTER (f.{child} = c.{child}) AS n2, avg(revenue) FILTER (f.{child} = c.{child}) AS m2,
      var_samp(revenue) FILTER (f.{child} = c.{child}) AS v2
    FROM (SELECT {parent}, {child} FROM facts GROUP BY ALL HAVING sum(has_conversion) >= {least}) c
    JOIN facts f ON {join} GROUP BY ALL) WHERE n1 >= {least})"""


TEST_DIGITS = "parent_rps:8 child_rps:8 t:7 df:6 pval:6"
register("exemptions_city", lambda spark, sf: loc.location_exemptions(
    facts(spark, sf), ["product", "state_code"], ["city"], 20, None), with_views(
    GEO, tests_sql("product, state_code", "city", 20), FACTS), TEST_DIGITS)
register("exemptions_dma", lambda spark, sf: loc.location_exemptions(
    facts(spark, sf), ["product", "state_code"], ["dma_state"], 20, 0.5), with_views(
    GEO, f"SELECT * FROM ({tests_sql('product, state_code', 'dma_state', 20)}) WHERE pval <= 0.5", FACTS), TEST_DIGITS)
register("welch_test_state", lambda spark, sf: loc.welch_test(
    facts(spark, sf), F.col("state_code") == "CA", keys=["product"]), with_views(GEO, f"""
SELECT product, n1 AS parent_sessions, s1 AS parent_revenue, CAST(c1 AS BIGINT) AS parent_conversions, n2 AS child_sessions, s2 AS child_revenue,
  CAST(c2 AS BIGINT) AS child_conversions, t, df, {PVALUE} AS pval, m1 AS parent_rps, s1 / c1 AS parent_avg_value, c1 / n1 AS parent_conv_rate,
  m2 AS child_rps, s2 / c2 AS child_avg_value, c2 / n2 AS child_conv_rate
FROM (SELECT *, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t, pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df
  FROM (SELECT product, """ + ", ".join(f"count(*) FILTER (state_code {op} 'CA') AS n{i}, sum(revenue) FILTER (state_code {op} 'CA') AS s{i}, "
                               f"sum(has_conversion) FILTER (state_code {op} 'CA') AS c{i}, avg(revenue) FILTER (state_code {op} 'CA') AS m{i}, "
                               f"var_samp(revenue) FILTER (state_code {op} 'CA') AS v{i}" for i, op in ((1, "<>"), (2, "="))) +
    " FROM facts GROUP BY product))", FACTS),
    "parent_revenue:4 child_revenue:4 t:7 df:6 pval:6 parent_rps:8 parent_avg_value:8 parent_conv_rate:9 child_rps:8 child_avg_value:8 child_conv_rate:9")

STATE = stats_sql("product, state_code", 1)
register("rank_states", lambda spark, sf: loc.rank_places(loc.location_stats(facts(spark, sf), ["product", "state_code"], 1), "rps"),
         with_views(GEO, f"""
SELECT product, state_code, rps, CAST(row_number() OVER (PARTITION BY product ORDER BY rps, state_code) - 1 AS INT) AS rank FROM ({STATE})""", FACTS), "rps:9")
register("rank_by_product", lambda spark, sf: loc.rank_by_product(
    loc.location_stats(facts(spark, sf), ["product", "state_code"], 1), "HEALTH", "rps", ["HEALTH", "MEDICARE"]).toDF(
        "rank", "state_code", "health_rps", "medicare_rps"), with_views(GEO, f"""
SELECT CAST(row_number() OVER (ORDER BY h.rps, h.state_code) - 1 AS INT) AS rank, h.state_code, h.rps AS health_rps, m.rps AS medicare_rps
FROM (SELECT * FROM ({STATE}) WHERE product = 'HEALTH') h LEFT JOIN (SELECT * FROM ({STATE}) WHERE product = 'MEDICARE') m USING (state_code)""", FACTS),
         "health_rps:9 medicare_rps:9")


def dma_buckets(spark, sf):
    return loc.greedy_buckets(loc.location_stats(facts(spark, sf), ["product", "dma_state"], 1), 4, place="dma_state")


BUCKETS = f"""{FACTS},
places AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY product ORDER BY rps, dma_state) AS pos,
  ceil(sum(conversions) OVER (PARTITION BY product) / 4) AS share FROM ({stats_sql('product, dma_state', 1)})),
walk AS (
  SELECT product, dma_state, rps, conversions, pos, CAST(1 AS INT) AS bucket, conversions AS filled, share FROM places WHERE pos = 1 UNION ALL
  SELECT p.product, p.dma_state, p.rps, p.conversions, p.pos, CAST(w.bucket + CASE WHEN w.filled > w.share THEN 1 ELSE 0 END AS INT),
    CASE WHEN w.filled > w.share THEN 0 ELSE w.filled END + p.conversions, p.share
  FROM walk w JOIN places p ON p.product = w.product AND p.pos = w.pos + 1)"""


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


register("buckets_greedy", dma_buckets, recursive(with_views(GEO, "SELECT product, dma_state, rps, conversions, bucket FROM walk", BUCKETS)), "rps:9")
register("buckets_ranges", lambda spark, sf: loc.bucket_ranges(dma_buckets(spark, sf)), recursive(with_views(GEO, """
SELECT product, bucket, CASE WHEN row_number() OVER o = 1 THEN 0.0 ELSE low END AS rps_min, coalesce(lead(low) OVER o, high * 3) AS rps_max
FROM (SELECT product, bucket, min(rps) AS low, max(rps) AS high FROM walk GROUP BY 1, 2) WINDOW o AS (PARTITION BY product ORDER BY bucket)""", BUCKETS)),
         "rps_min:9 rps_max:8")
register("revenue_spread", lambda spark, sf: loc.revenue_spread(facts(spark, sf), ["product", "state_code"]), with_views(GEO, """
SELECT product, state_code, count(revenue) AS count, sum(revenue) AS sum, stddev_samp(revenue) AS std, var_samp(revenue) AS var, avg(revenue) AS mean,
  stddev_samp(revenue) / avg(revenue) AS std_proportion FROM facts GROUP BY 1, 2""", FACTS), "sum:4 std:8 var:6 mean:8 std_proportion:8")

DMA = stats_sql("product, dma_state", 1)
SCALED = ["sessions", "conversions", "revenue", "rps"]
register("metrics_scaled_max", lambda spark, sf: loc.scaled(loc.location_stats(facts(spark, sf), ["product", "dma_state"], 1), SCALED), with_views(
    GEO, "SELECT product, dma_state, " + ", ".join(f"{c} / max(abs({c})) OVER () AS {c}" for c in SCALED) + f" FROM ({DMA})", FACTS),
    " ".join(f"{c}:9" for c in SCALED))
register("metrics_scaled_standard", lambda spark, sf: loc.scaled(
    loc.location_stats(facts(spark, sf), ["product", "dma_state"], 1), SCALED, "standard"), with_views(
    GEO, "SELECT product, dma_state, " + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in SCALED) + f" FROM ({DMA})", FACTS),
    " ".join(f"{c}:8" for c in SCALED))
register("groups_round_robin", lambda spark, sf: loc.round_robin(loc.location_stats(
    facts(spark, sf), ["dma_state"], 1), 3, "rps", "dma_state").select("dma_state", "rps", "group"), with_views(GEO, f"""
SELECT dma_state, rps, CAST((row_number() OVER (ORDER BY rps DESC, dma_state) - 1) % 3 + 1 AS INT) AS "group" FROM ({stats_sql('dma_state', 1)})""", FACTS), "rps:9")


def split_rows(spark, sf, early: bool):
    rows = ordered.bag_positions(deduplicate_sessions(zip_rows(spark, sf)), "date", "revenue", keys=["product"])
    return rows.filter("date <= '2024-01-20'" if early else "date > '2024-01-20'")


register("groups_balanced_split", lambda spark, sf: loc.balanced_split(split_rows(spark, sf, True), ["500NY", "502CO"], 2, 1).select(
    "region", "sessions", "revenue", "final_score", "group"))
register("groups_split_check", lambda spark, sf: loc.split_check(
    loc.balanced_split(split_rows(spark, sf, True), ["500NY", "502CO"], 2, 1), split_rows(spark, sf, False), ["500NY", "502CO"]))
register("clusters_regions", lambda spark, sf: loc.region_clusters(
    loc.location_stats(facts(spark, sf), ["product", "dma_state"], 1), SCALED, 2).select("product", "dma_state", "cluster"))
register("clusters_elbow", lambda spark, sf: loc.elbow(loc.location_stats(facts(spark, sf), ["product", "dma_state"], 1), SCALED, 6))

register("histogram_scores", lambda spark, sf: loc.histogram(view(spark, sf, "lead_score_sample"), "lead_score", 50), with_views("lead_score_sample", """
SELECT bin, low + bin * ((high - low) / 50) AS "left", count(*) AS n
FROM (SELECT *, CAST(least(CAST(floor((lead_score - low) / (high - low) * 50) AS INT), 49) AS INT) AS bin
  FROM (SELECT lead_score, min(lead_score) OVER () AS low, max(lead_score) OVER () AS high FROM lead_score_sample)) GROUP BY bin, low, high"""), "left:8")
register("histogram_rps_by_product", lambda spark, sf: loc.histogram(
    loc.location_stats(facts(spark, sf), ["product", "dma_state"], 1), "rps", 7, ["product"]), with_views(GEO, f"""
SELECT product, bin, low + bin * ((high - low) / 7) AS "left", count(*) AS n
FROM (SELECT *, CAST(least(CAST(floor((rps - low) / (high - low) * 7) AS INT), 6) AS INT) AS bin
  FROM (SELECT product, rps, min(rps) OVER (PARTITION BY product) AS low, max(rps) OVER (PARTITION BY product) AS high FROM ({DMA})))
GROUP BY product, bin, low, high""", FACTS), "left:8")
register("bootstrap_error", lambda spark, sf: sampling.bootstrap_error(view(spark, sf, "lead_score_sample"), "lead_score", ["row_id"]))
register("resampled_histogram", lambda spark, sf: sampling.resampled_counts(
    view(spark, sf, "lead_score_sample").withColumn("band", F.bround("lead_score", 1)), "band", ["row_id"]), with_views("lead_score_sample", f"""
SELECT band, count(*) AS n
FROM (SELECT CAST(floor({drawn('draw', 7)} * (SELECT count(*) FROM lead_score_sample)) AS BIGINT) AS place
  FROM (SELECT unnest(range(100000)) AS draw))
JOIN (SELECT row_number() OVER (ORDER BY ('0x' || substr(md5(CAST(row_id AS VARCHAR)), 1, 8))::BIGINT % 1024, row_id) - 1 AS place, round_even(lead_score, 1) AS band FROM lead_score_sample) USING (place)
GROUP BY 1"""), "band:3")

DAILY = daily_sql("campaign_id, state, device, keyword, utc_dt", f"{DEVICE} AS device")
register("mutual_information", lambda spark, sf: sampling.mutual_information(rps_daily(spark, sf), ["state", "device"]), with_views(ALL, f"""
SELECT sum(n / total * ln(n * total / (nb * ns))) AS mutual_information, sum(n) FILTER (high) / max(total) AS high_share
FROM (SELECT *, sum(n) OVER (PARTITION BY state, device) AS nb, sum(n) OVER (PARTITION BY high) AS ns, sum(n) OVER () AS total
  FROM (SELECT state, device, rps_avg > mean AS high, sum(sessions) AS n
    FROM (SELECT *, sum(rps_avg * sessions) OVER () / sum(sessions) OVER () AS mean FROM ({DAILY})) GROUP BY 1, 2, 3))""", UNIFIED),
    "mutual_information:9 high_share:9")
register("weighted_density", lambda spark, sf: sampling.weighted_density(rps_daily(spark, sf), "rps_avg", "sessions"), with_views(ALL, f"""
SELECT CAST(point AS INT) AS point, 2.0 * point / 99 AS at, sum(p * exp(-0.5 * pow((2.0 * point / 99 - x) / h, 2)) / (h * sqrt(2 * pi()))) AS density
FROM (SELECT rps_avg AS x, sessions / sum(sessions) OVER () AS p,
    pow(pow(sum(sessions) OVER (), 2) / sum(sessions * sessions) OVER (), -0.2) * sqrt(
      (sum(sessions * rps_avg * rps_avg) OVER () / sum(sessions) OVER () - pow(sum(sessions * rps_avg) OVER () / sum(sessions) OVER (), 2))
      / (1 - sum(sessions * sessions) OVER () / pow(sum(sessions) OVER (), 2))) AS h
  FROM ({DAILY})) CROSS JOIN (SELECT unnest(range(100)) AS point) GROUP BY 1, 2""", UNIFIED), "at:9 density:9")

register("weighted_density_by_device", lambda spark, sf: sampling.weighted_density(
    rps_daily(spark, sf), "rps_avg", "sessions", keys=["device"]), with_views(ALL, f"""
SELECT device, CAST(point AS INT) AS point, 2.0 * point / 99 AS at,
  sum(sessions / n * exp(-0.5 * pow((2.0 * point / 99 - rps_avg) / h, 2)) / (h * sqrt(2 * pi()))) AS density
FROM (SELECT device, rps_avg, sessions FROM ({DAILY})) JOIN (
  SELECT device, n, pow(n * n / n2, -0.2) * sqrt((xx / n - pow(x / n, 2)) / (1 - n2 / (n * n))) AS h FROM (
    SELECT device, CAST(sum(sessions) AS DOUBLE) AS n, CAST(sum(sessions * sessions) AS DOUBLE) AS n2, sum(sessions * rps_avg) AS x,
      sum(sessions * rps_avg * rps_avg) AS xx FROM ({DAILY}) GROUP BY 1)) USING (device),
  (SELECT unnest(range(100)) AS point) GROUP BY 1, 2, 3""", UNIFIED), "at:9 density:9")

register("device_means_attached", lambda spark, sf: attach_weighted_mean(
    rps_daily(spark, sf), ["device"], "rps_avg", "sessions", "device_mean").select(
    "campaign_id", "state", "device", "keyword", "utc_dt", "sessions", "device_mean"), with_views(ALL, f"""
SELECT campaign_id, state, device, keyword, utc_dt, sessions, d.mean AS device_mean FROM ({DAILY}) LEFT JOIN (
  SELECT device, sum(rps_avg * sessions) / sum(sessions) AS mean FROM ({DAILY}) GROUP BY 1) d USING (device)""", UNIFIED), "device_mean:9")
