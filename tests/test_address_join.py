"""The ordered address join against the copied one, on hot addresses and odd rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adyield.functions import network
from adyield.operators import campaigns, joins
from tests.conftest import plan_of

HOT = 1500


@pytest.fixture(scope="module")
def tables(spark):
    """Sessions of which a third have one address and a third lie in one /24; blocks of mixed sizes with gaps."""
    draw = random.Random(1)
    blocks = []
    for first in (10, 11):
        for second in range(3):
            at = (first << 24) + (second << 16)
            end = at + 65535
            while at <= end:
                size = min(draw.choice([64, 256, 1024, 8192]), end - at + 1)
                if draw.random() < 0.8:
                    blocks.append((f"{first}.{second}", at, at + size - 1, len(blocks)))
                at += size
    # a block wider than its two octets counts within them only, one before them not at all
    blocks += [("12.0", (12 << 24), (12 << 24) + (1 << 17), 9001), ("12.9", 5, 6, 9002), (None, 1, 2, 9003), ("12.1", None, 3, 9004)]
    addresses = ["10.0.5.5"] * HOT + [f"10.1.7.{draw.randrange(256)}" for _ in range(HOT)]
    addresses += [f"{draw.choice([10, 11, 12])}.{draw.randrange(4)}.{draw.randrange(256)}.{draw.randrange(256)}" for _ in range(HOT)]
    addresses += ["", None, "x.y", "010.1.1.1", "1.2", "10.0.5.5"] * 3
    sessions = spark.createDataFrame([(i, a, "z", 0.5) for i, a in enumerate(addresses)], "session_id long, ip_address string, part string, at double")
    return sessions, spark.createDataFrame(blocks, "ip_index string, start_int long, end_int long, maxmind_id long")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_ordered_and_copied_joins_agree(tables, how):
    sessions, blocks = tables
    want = sorted(map(str, joins.ip_range_join(sessions, blocks, how, salts=3).collect()))
    for rows in (200, 10**6):
        assert sorted(map(str, joins.ip_ordered_join(sessions, blocks, how, part_rows=rows).collect())) == want


def test_hot_addresses_make_many_parts(tables):
    sessions, blocks = tables
    left, right = joins.ip_parts(sessions, blocks, part_rows=200)
    sizes = Counter(r.part for r in left.select("part").collect())
    assert max(sizes.values()) <= 2 * 200
    assert right.count() <= blocks.count() + len(sizes)
    plan = plan_of(joins.ip_ordered_join(sessions, blocks))
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_large_tables_choose_by_overlap(spark, tables):
    sessions, blocks = tables
    twice = blocks.union(blocks.filter("maxmind_id = 3"))
    assert not joins.blocks_overlap(blocks) and joins.blocks_overlap(twice)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20b")
    try:
        assert "Join" not in plan_of(joins.ip_range_join(sessions, blocks))
        copied = joins.ip_range_join(sessions, twice)
        assert "Join" in plan_of(copied)
        assert sorted(map(str, copied.collect())) == sorted(map(str, joins.ip_range_join(sessions, twice, salts=1).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_no_sessions_and_no_blocks(tables):
    sessions, blocks = tables
    assert joins.ip_ordered_join(sessions.limit(0), blocks).collect() == []
    assert joins.ip_ordered_join(sessions, blocks.limit(0)).collect() == []
    assert joins.ip_ordered_join(sessions, blocks.limit(0), "left").count() == sessions.count()


def test_addresses_are_split_once_and_campaigns_dealt(spark):
    rows = [(i, a) for i, a in enumerate(["1.2.3.4", "", None, "1.2.3", "1.2.3.4.5", "a.1.1.1", "1..2.3", " 1.2.3.4", ".1.2.3."])]
    sessions = spark.createDataFrame(rows, "session_id int, ip_address string")
    ip = F.col("ip_address")
    assert sessions.filter(~network.inet_aton(ip).eqNullSafe(network.octets_aton(network.octets_of(ip)))).count() == 0
    blocks = spark.createDataFrame([("1.2", 16908288, 16973823, 1)], "ip_index string, start_int long, end_int long, maxmind_id int")
    left, _ = joins.ip_parts(sessions, blocks)
    plan = plan_of(left)
    assert plan.count("split(") == 1 and "split_part" not in plan
    bodies = spark.createDataFrame([("2024-01-30", 1, '{"id": "1", "is_active": "true"}')], "date string, version int, body string")
    newest = campaigns.latest_campaigns(bodies.withColumn("date", F.to_date("date")), "2024-01-30", "version")
    assert "RoundRobinPartitioning" in plan_of(newest) and newest.count() == 1
