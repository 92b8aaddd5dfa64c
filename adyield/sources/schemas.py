"""Declared schemas of the input and output files."""

from __future__ import annotations

GEO_BLOCKS = (
    "ip_index string, start_int bigint, end_int bigint, network string, maxmind_id int, "
    "registered_country_id int, represented_country_id int, is_anonymous_proxy boolean, "
    "is_satellite_provider boolean, postal_code string, latitude double, longitude double, accuracy_radius int"
)
GEO_LOCATIONS = (
    "maxmind_id int, locale_code string, continent_code string, continent_name string, "
    "country_iso_code string, country_name string, subdivision_1_iso_code string, subdivision_1_name string, "
    "subdivision_2_iso_code string, subdivision_2_name string, city_name string, metro_code string, "
    "time_zone string, is_in_european_union boolean"
)
CHANNEL_COST = "date date, campaign string, pub string, channel string, clicks double, cost double, rev double"
ACTIVE_CAMPAIGNS = (
    "row_no int, sessions_60d int, rps_avg_60d double, device string, state string, operating_system string, "
    "created boolean, id string"
)
LEAD_SCORES = "prob double"
LEAD_SCORE_BODY = (
    "sessionid bigint, on string, score double, response struct<meta: struct<model: string>>"
)
KEYWORD_BIDS = (
    "account_id bigint, campaign_id bigint, adgroup_id bigint, keyword_id bigint, max_cpc_old double, "
    "max_cpc_new double"
)
INTERVAL_MODIFIERS = (
    "product string, traffic_source string, weekday_index int, weekday string, hr_start_inclusive double, "
    "hr_end_exclusive double, modifier double, calculation_date timestamp"
)
GEO_TARGETS = (
    "location_id bigint, name string, canonical_name string, parent_id bigint, country_code string, "
    "target_type string, status string"
)
