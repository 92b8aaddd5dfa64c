"""A sample of the registered queries against their SQL twins (tools/compare.py runs all of them)."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from checks.views import BASE_TABLES
from tools.compare import sorted_rows

SAMPLE = ["slots_user_tz", "slots_tz_adjusted", "unified_sessions", "agg_rps_by_location", "bag_kpis", "keyword_bids",
          "channel_bids_u65", "modifiers_lowess", "interval_table", "policy_premiums", "exemptions_dma", "buckets_greedy",
          "campaign_update_payloads", "structure_targeting_lists", "geo_expand_cidr"]


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in BASE_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, sf, duck, name):
    df = entry_points.queries()[name](spark, sf)
    cursor = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(names, cursor.fetchall())


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
