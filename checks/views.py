"""Input tables derived from the given parquet tables.

The text runs unchanged in Spark SQL and in the checking engine: Spark reads it with the table
names replaced by file paths, the SQL twins use it as common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

SESSION_DETAIL = """
SELECT event_id AS session_id, ts AS creation_date,
  CASE WHEN event_id % 50 = 0 THEN '' ELSE concat('10.', CAST(user_id % 16 AS STRING), '.', CAST(event_id % 256 AS STRING), '.7') END AS ip_address,
  CASE WHEN user_id % 2 = 0 THEN 'HEALTH' ELSE 'MEDICARE' END AS product,
  CASE user_id % 5 WHEN 0 THEN 'GOOGLE' WHEN 1 THEN 'BING' WHEN 2 THEN 'MEDIAALPHA' WHEN 3 THEN 'TABOOLA' ELSE 'FACEBOOK' END AS traffic_source,
  CASE event_id % 3 WHEN 0 THEN 'DESKTOP' WHEN 1 THEN 'MOBILE' ELSE 'T' END AS device,
  CASE event_id % 4 WHEN 0 THEN 'MacIntel' WHEN 1 THEN 'Win32' WHEN 2 THEN 'iPhone' ELSE 'Linux x86_64' END AS operating_system,
  concat('site_', CAST(user_id % 20 AS STRING)) AS keyword,
  user_id % 40 AS campaign_id,
  concat('https://x.example/?zipcode=', CAST(10000 + user_id % 96 AS STRING), '&r=1') AS landing_page,
  CASE event_id % 2 WHEN 0 THEN 'Chrome' ELSE 'Safari' END AS browser, 'SEM' AS channel,
  CASE WHEN event_id % 10 = 9 THEN 'SITE.ORG' ELSE 'SITE.COM' END AS domain
FROM events
"""

SESSION_REVENUE = """
SELECT event_id AS session_id, CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS revenue, ts AS session_creation_date,
  CASE user_id % 5 WHEN 0 THEN 'GOOGLE' WHEN 1 THEN 'BING' WHEN 2 THEN 'MEDIAALPHA' WHEN 3 THEN 'TABOOLA' ELSE 'FACEBOOK' END AS traffic_source, CASE WHEN user_id % 2 = 0 THEN 'HEALTH' ELSE 'MEDICARE' END AS product,
  CASE WHEN event_id % 10 = 9 THEN 'SITE.ORG' ELSE 'SITE.COM' END AS domain, concat('https://x.example/?zipcode=', CAST(10000 + user_id % 96 AS STRING), '&r=1') AS landing_page
FROM events WHERE event_type <> 'error'
UNION ALL
SELECT event_id, value / 10, ts,
  CASE user_id % 5 WHEN 0 THEN 'GOOGLE' WHEN 1 THEN 'BING' WHEN 2 THEN 'MEDIAALPHA' WHEN 3 THEN 'TABOOLA' ELSE 'FACEBOOK' END, CASE WHEN user_id % 2 = 0 THEN 'HEALTH' ELSE 'MEDICARE' END,
  CASE WHEN event_id % 10 = 9 THEN 'SITE.ORG' ELSE 'SITE.COM' END, concat('https://x.example/?zipcode=', CAST(10000 + user_id % 96 AS STRING), '&r=1')
FROM events WHERE event_type = 'signup'
"""

GEO_BLOCKS_RAW = """
SELECT concat(CAST(1 + CAST(floor(p_partkey / 128.0) AS INT) % 220 AS STRING), '.', CAST((p_partkey % 128) * 2 AS STRING),
  CASE p_partkey % 3 WHEN 0 THEN '.0.0/15' WHEN 1 THEN '.64.0/18' ELSE '.8.0/24' END) AS network,
  p_partkey % 25 AS maxmind_id, CAST(10000 + p_partkey AS STRING) AS postal_code
FROM part
"""

GEO_BLOCKS = """
SELECT concat(CAST(10 + CAST(floor(p_partkey / 8192.0) AS INT) AS STRING), '.', CAST(CAST(floor((p_partkey % 8192) / 32.0) AS INT) AS STRING)) AS ip_index,
  (CAST(10 + floor(p_partkey / 8192.0) AS BIGINT) * 256 + CAST(floor((p_partkey % 8192) / 32.0) AS BIGINT)) * 65536 + (p_partkey % 32) * 2048 AS start_int,
  (CAST(10 + floor(p_partkey / 8192.0) AS BIGINT) * 256 + CAST(floor((p_partkey % 8192) / 32.0) AS BIGINT)) * 65536 + (p_partkey % 32) * 2048 + 2047 AS end_int,
  p_partkey % 25 AS maxmind_id, CAST(10000 + p_partkey AS STRING) AS postal_code
FROM part
"""

GEO_LOCATIONS = """
SELECT n_nationkey AS maxmind_id, CASE WHEN n_nationkey % 12 = 11 THEN 'CA' ELSE 'US' END AS country_iso_code,
  CASE n_nationkey % 4 WHEN 0 THEN 'NY' WHEN 1 THEN 'TX' WHEN 2 THEN 'CO' ELSE 'CA' END AS subdivision_1_iso_code,
  CASE WHEN n_nationkey % 9 = 8 THEN '' ELSE CAST(500 + CAST(floor(n_nationkey / 2.0) AS INT) AS STRING) END AS metro_code, n_name AS city_name,
  CASE n_nationkey % 4 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago' WHEN 2 THEN 'America/Denver' ELSE 'America/Los_Angeles' END AS time_zone
FROM nation
"""

LEAD_SCORES_RAW = """
SELECT concat('{"sessionid": ', CAST(event_id AS STRING), ', "on": "', CAST(CAST(ts AS DATE) AS STRING), '", "score": ', CAST(user_id % 100 AS STRING),
  ', "response": {"meta": {"model": ', CASE event_id % 3 WHEN 0 THEN 'null' WHEN 1 THEN '"med-adv"' ELSE '"med-supp"' END, '}}}') AS body,
  CAST(extract(YEAR FROM ts) AS INT) AS year, CAST(extract(MONTH FROM ts) AS INT) AS month
FROM events WHERE event_type IN ('signup', 'purchase')
"""

KEYWORD_PERF = """
SELECT CAST(l_shipdate AS DATE) AS date, l_shipdate AS transaction_date_time,
  CASE WHEN l_linenumber % 2 = 1 THEN 'COST' ELSE 'REVENUE' END AS data_source_type,
  l_partkey % 3 AS account_num, l_partkey % 12 AS campaign_id, l_partkey % 48 AS adgroup_id, l_partkey AS keyword_id,
  CASE WHEN l_partkey % 12 < 3 THEN 'Geo-Granular plans' ELSE concat('Search ', CAST(l_partkey % 12 AS STRING)) END AS campaign,
  CASE WHEN l_partkey % 12 < 3 THEN concat('Plans ', CASE CAST(floor((l_partkey % 48) / 12.0) AS INT) WHEN 0 THEN 'Texas' WHEN 1 THEN 'New York' WHEN 2 THEN 'West Virginia' ELSE 'District of Columbia' END)
       ELSE concat('Group ', CAST(l_partkey % 48 AS STRING)) END AS adgroup,
  CASE WHEN l_partkey % 12 < 3 THEN concat('+plan', CAST(CAST(floor(l_partkey / 48.0) AS INT) % 50 AS STRING), ' +', CASE CAST(floor((l_partkey % 48) / 12.0) AS INT) WHEN 0 THEN 'texas' WHEN 1 THEN 'new +york' WHEN 2 THEN 'west-virginia' ELSE 'district +of +columbia' END)
       ELSE concat('kw ', CAST(l_partkey AS STRING)) END AS keyword,
  CASE WHEN l_linenumber % 2 = 1 THEN l_quantity ELSE 0.0 END AS clicks,
  CASE WHEN l_linenumber % 2 = 1 THEN l_extendedprice / 2000 ELSE 0.0 END AS cost,
  CASE WHEN l_linenumber % 2 = 1 THEN NULL ELSE l_extendedprice / 1900 END AS rev,
  CASE l_returnflag WHEN 'A' THEN 'Broad' WHEN 'N' THEN 'Exact' ELSE 'Phrase' END AS match_type,
  CASE WHEN l_linenumber % 2 = 1 THEN 0.5 + l_discount * 10 ELSE NULL END AS max_cpc,
  l_partkey % 24 AS transaction_hour, CASE WHEN l_orderkey % 10 = 9 THEN 'DISPLAY' ELSE 'SEM' END AS channel,
  CASE WHEN l_orderkey % 20 = 18 THEN 'GOOGLE' ELSE 'BING' END AS traffic_source
FROM lineitem
"""

KEYWORD_ENTITY = """
SELECT p_partkey AS keyword_id, p_partkey % 3 AS account_id, 0.5 + p_size / 25.0 AS latest_max_cpc FROM part
"""

ACCOUNTS = """
SELECT r_regionkey AS account_id, concat('ACC', CAST(r_regionkey AS STRING)) AS account_number, r_name AS account_name,
  CASE WHEN r_regionkey = 2 THEN 'N' ELSE 'Y' END AS keyword_bidder_enabled,
  'Y' AS keyword_geo_bidder_enabled, 120 AS click_threshold, 1.02 AS roi_target, 0.2 AS max_push, -0.3 AS max_cut, 0.05 AS cpc_min
FROM region
"""

CHANNEL_COST = """
SELECT CAST(ts AS DATE) AS date, CASE WHEN user_id % 2 = 0 THEN 'U65 auto' ELSE 'O65 auto' END AS campaign,
  concat('pub', CAST(user_id % 6 AS STRING)) AS pub, concat('ch', CAST(user_id % 18 AS STRING)) AS channel,
  CAST(1 + event_id % 3 AS DOUBLE) AS clicks, value / 20 AS cost, CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS rev
FROM events
"""

APPLICATIONS = """
SELECT CAST(floor(o_orderkey / 3.0) AS BIGINT) AS app_pid, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat('F', CAST(CAST(floor(o_orderkey / 3.0) AS BIGINT) AS STRING)) END AS foreign_pid,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CASE o_orderkey % 5 WHEN 0 THEN 'stm' WHEN 1 THEN 'STM' WHEN 2 THEN 'BTM' WHEN 3 THEN 'DENTAL' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'VISION' ELSE 'SUPPLEMENTAL' END END END AS product_type,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_totalprice / 1000 END AS premium_amount,
  CAST(o_orderdate AS DATE) AS effective_date,
  CAST(o_orderdate AS DATE) + CAST(CASE o_orderkey % 4 WHEN 0 THEN 29 WHEN 1 THEN 89 WHEN 2 THEN 179 ELSE 363 END AS INT) AS expiration_date,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 200 AS INT) ELSE NULL END AS termination_date,
  CASE WHEN o_orderkey % 6 = 1 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 150 AS INT) ELSE NULL END AS date_cancelled,
  CASE WHEN o_orderkey % 997 = 0 THEN 'FAKE' ELSE 'OK' END AS status,
  CASE WHEN o_custkey % 41 = 0 THEN 'My TEST agency' WHEN o_custkey % 43 = 0 THEN NULL ELSE concat('agency', CAST(o_custkey % 7 AS STRING)) END AS agency_id,
  o_custkey % 11 AS carrier_id, CASE WHEN o_custkey % 7 = 0 THEN 'Prepaid' ELSE 'MONTHLY' END AS payment_frequency,
  CAST(o_orderkey % 4 AS DOUBLE) AS billing_fee, CAST(o_orderkey % 5 AS DOUBLE) AS association_fee, CAST(o_orderkey % 6 AS DOUBLE) AS application_fee,
  CAST(o_orderkey % 3 AS DOUBLE) AS admin_fee, CAST(o_orderkey % 2 AS DOUBLE) AS extras_amount,
  o_orderdate AS datetime_created, o_orderdate AS datetime_modified, o_orderkey AS session_id,
  concat('u', CAST(o_custkey AS STRING), '@x.example') AS email,
  concat('555', CAST(o_custkey AS STRING)) AS phone_primary, concat('usr', CAST(o_custkey % 500 AS STRING)) AS session_user_id,
  concat('agent', CAST(o_orderkey % 13 AS STRING)) AS agent_id, concat(' ', CAST(10000 + o_custkey % 96 AS STRING)) AS zip, concat('city', CAST(o_custkey % 30 AS STRING)) AS city,
  CASE o_custkey % 4 WHEN 0 THEN 'NY' WHEN 1 THEN 'TX' WHEN 2 THEN 'CO' ELSE 'CA' END AS state
FROM orders
"""

POLICY_MEMBERS = """
SELECT c_custkey AS app_pid, 'primary' AS relationship, DATE '1940-01-01' + CAST((c_custkey * 37) % 19000 AS INT) AS dob FROM customer
UNION ALL
SELECT c_custkey, 'spouse', DATE '1945-01-01' + CAST((c_custkey * 31) % 12000 AS INT) FROM customer WHERE c_acctbal > 3000
UNION ALL
SELECT c_custkey, 'Child', DATE '1982-01-01' + CAST((c_custkey * 29) % 4000 AS INT) FROM customer WHERE c_mktsegment <> 'BUILDING'
"""

FEE_WIDE = """
SELECT concat('C', CAST(n_regionkey AS STRING)) AS carrier_code, n_nationkey % 2 = 0 AS is_partner, n_name AS state_code,
  0.10 AS m_2019_01, 0.10 AS m_2019_02, 0.10 + (n_nationkey % 3) * 0.05 AS m_2019_03, 0.10 + (n_nationkey % 3) * 0.05 AS m_2019_04, 0.25 AS m_2019_05, 0.25 AS m_2019_06
FROM nation
"""

CAMPAIGN_BODIES = """
SELECT DATE '2024-01-29' + CAST(v AS INT) AS date, v AS version, concat('{"id": "', CAST(p_partkey AS STRING), '", "advertiser_id": "adv', CAST(p_partkey % 2 AS STRING),
  '", "cpc": ', CAST(CAST(1 + (p_partkey + v) % 4 AS INT) AS STRING), ', "is_active": ', CASE WHEN p_partkey % 5 = 4 THEN 'false' ELSE 'true' END,
  ', "platform_targeting": {"type": "INCLUDE", "value": ["DESK"', CASE WHEN p_partkey % 2 = 0 THEN ', "PHON"' ELSE '' END, ']}',
  ', "activity_schedule": {"mode": "', CASE WHEN p_partkey % 3 = 0 THEN 'ALWAYS", "rules": []' ELSE 'CUSTOM", "rules": [{"type": "INCLUDE", "day": "Monday", "from_hour": 6, "until_hour": 20}, {"type": "EXCLUDE", "day": "Monday", "from_hour": 12, "until_hour": 13}]' END, '}',
  ', "publisher_bid_modifier": {"values": [{"target": "site_', CAST(p_partkey % 20 AS STRING), '", "bid_modification": 1.5}]}}') AS body
FROM (SELECT p_partkey, 0 AS v FROM part UNION ALL SELECT p_partkey, 1 AS v FROM part) AS t
"""

CAMPAIGN_CONFIG = """
SELECT CAST(p_partkey AS STRING) AS id, p_partkey % 4 <> 3 AS automatically_managed, 1.0 AS baseline_cpc FROM part
"""

CAMPAIGN_UPDATES = """
SELECT concat('adv', CAST(p_partkey % 2 AS STRING)) AS account_id, CAST(p_partkey AS STRING) AS campaign_id, DATE '2024-01-28' + CAST(v AS INT) AS date, v AS version,
  CASE WHEN v % 2 = 0 THEN concat('{"cpc": ', CAST(1 + (p_partkey + v) % 4 AS STRING), '}') ELSE NULL END AS update_json,
  CASE WHEN v % 2 = 1 THEN '{"day": [0, 0, 1], "hour": [0, 1, 0], "bid_modifier": [0.9, 1.0, 1.1]}'
    WHEN v = 2 AND p_partkey % 3 = 0 THEN '{"day": [2, 2], "hour": [5, 7], "bid_modifier": [1.2, 0.8]}' ELSE NULL END AS schedule_json
FROM (SELECT p_partkey, 0 AS v FROM part UNION ALL SELECT p_partkey, 1 AS v FROM part UNION ALL SELECT p_partkey, 2 AS v FROM part) AS t
"""

PUBLISHERS = """
SELECT concat('site_', CAST(p_partkey AS STRING)) AS publisher FROM part
"""

DMA_NAMES = """
SELECT 500 + p_partkey AS dma_code, concat('DMA ', CAST(p_partkey AS STRING)) AS name FROM part
"""

LEAD_SCORE_SAMPLE = """
SELECT event_id AS row_id, (value + 1) / 500 AS lead_score FROM events
"""

VIEWS = {
    "session_detail": SESSION_DETAIL,
    "session_revenue": SESSION_REVENUE,
    "geo_blocks_raw": GEO_BLOCKS_RAW,
    "geo_blocks": GEO_BLOCKS,
    "geo_locations": GEO_LOCATIONS,
    "lead_scores_raw": LEAD_SCORES_RAW,
    "keyword_perf": KEYWORD_PERF,
    "keyword_entity": KEYWORD_ENTITY,
    "accounts": ACCOUNTS,
    "channel_cost": CHANNEL_COST,
    "applications": APPLICATIONS,
    "policy_members": POLICY_MEMBERS,
    "fee_wide": FEE_WIDE,
    "campaign_bodies": CAMPAIGN_BODIES,
    "campaign_config": CAMPAIGN_CONFIG,
    "campaign_updates": CAMPAIGN_UPDATES,
    "publishers": PUBLISHERS,
    "dma_names": DMA_NAMES,
    "lead_score_sample": LEAD_SCORE_SAMPLE,
}

_TABLE = re.compile(r"\b(FROM|JOIN) (" + "|".join(BASE_TABLES) + r")\b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input table as a DataFrame."""
    text = _TABLE.sub(lambda m: f"{m.group(1)} parquet.`{sf_dir}/{m.group(2)}.parquet`", VIEWS[name])
    return spark.sql(text)


def drawn(key: str, stream: int) -> str:
    """The number that ``uniform_draw`` gives, in SQL."""
    return f"(('0x' || substr(md5({key} || ':{stream}'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def with_views(names: str, body: str, extra: str = "") -> str:
    """SQL text with the named views (blank-separated) as leading common table expressions."""
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in names.split()]
    if extra:
        parts.append(extra.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n" + body
