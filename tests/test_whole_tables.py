"""Registered queries that read all rows of their tables."""

import pytest

from __spark_entry__ import queries


@pytest.mark.parametrize("name", ["ip_range_join_salted", "ip_range_join_salted_all"])
def test_joins_over_all_traffic_sources(spark, sf, name):
    assert queries()[name](spark, sf).select("traffic_source").distinct().count() > 2


def test_conversions_over_all_traffic_sources(spark, sf):
    found = queries()
    assert found["conversion_facts_all"](spark, sf).count() == found["conversion_facts"](spark, sf).count()
