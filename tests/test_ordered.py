import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from adyield.operators import ordered, rates


def sessions(seed, n=400, rate=0.2):
    rnd = random.Random(seed)
    # few distinct times: many ties, one time holds a third of the rows
    return [(i, 0 if rnd.random() < 0.33 else rnd.randrange(40), float(rnd.random() < rate) * rnd.randrange(1, 9)) for i in range(n)]


def test_running_total_crosses_partitions(spark):
    rows = sessions(1)
    df = spark.createDataFrame(rows, "id long, at int, v double")
    got = {r["id"]: r["total"] for r in ordered.running_total(df, F.col("v"), "total", ["at", "id"], parts=7).collect()}
    total, expected = 0.0, {}
    for i, _, v in sorted(rows, key=lambda r: (r[1], r[0])):
        total += v
        expected[i] = total
    assert got == expected


@pytest.mark.parametrize("parts", [1, 5])
def test_bag_positions_match_a_loop(spark, parts):
    rows = sessions(2, rate=0.05)
    df = spark.createDataFrame(rows, "session_id long, at int, revenue double")
    got = {r["session_id"]: (r["session_no"], r["bag_rps"]) for r in
           ordered.bag_positions(df, "at", "revenue", parts=parts).collect()}
    expected, since = {}, None
    for i, _, v in sorted(rows, key=lambda r: (r[1], r[0])):
        if since is not None:
            since += 1
            expected[i] = (since, v / since if v > 0 else None)
        if v > 0:
            since = 0
    assert got == expected


def test_bag_positions_by_key_equal_separate_runs(spark):
    rows = [(i, at, v, "a" if i % 3 else "b") for i, at, v in sessions(3)]
    df = spark.createDataFrame(rows, "session_id long, at int, revenue double, product string")
    both = {r["session_id"]: r["session_no"] for r in ordered.bag_positions(df, "at", "revenue", keys=["product"], parts=5).collect()}
    apart = {}
    for p in "ab":
        part = ordered.bag_positions(df.filter(F.col("product") == p), "at", "revenue", parts=2)
        apart |= {r["session_id"]: r["session_no"] for r in part.collect()}
    assert both == apart


def test_bag_kpis_match_a_loop(spark):
    rows = [(i, f"2024-01-01 00:{at:02d}:00", int(v * 10000)) for i, at, v in sessions(4)]
    df = spark.createDataFrame(rows, "session_id long, ts string, revenue_units long").withColumn(
        "creation_date", F.col("ts").cast("timestamp_ntz"))
    got = {r["hour"]: (r["clicks_num"], r["leads_num"], r["rev_sum"]) for r in ordered.bag_kpis(df, parts=3).collect()}
    bags, bag = {}, 0
    placed = []
    for i, ts, u in sorted(rows, key=lambda r: (r[1], r[0])):
        bag += u > 0
        bags.setdefault(bag, []).append(u)
        placed.append((int(ts[14:16]) // 15 * 0.25, bag))
    expected = {}
    for hour, b in placed:
        n, leads, rev = expected.get(hour, (0, 0.0, 0.0))
        us = bags[b]
        expected[hour] = (n + 1, leads + sum(u > 0 for u in us) / len(us), rev + sum(us) / 1e4 / len(us))
    assert got.keys() == expected.keys()
    for hour in got:
        assert got[hour] == pytest.approx(expected[hour])


def sequential_rate(rows, threshold):
    """Take rows in order until the clicks reach the threshold; the last row counts in part."""
    clicks = revenue = 0.0
    for c, r in rows:
        if clicks + c >= threshold:
            share = min(1.0, (threshold - clicks) / c)
            clicks, revenue = clicks + c * share, revenue + r * share
            break
        clicks, revenue = clicks + c, revenue + r
    return revenue / clicks if clicks else None


def test_threshold_rate_equals_sequential_cut(spark):
    rnd = random.Random(5)
    rows = [(k, level, day, float(rnd.choice([0, 0, 1, 5, 30])), rnd.random() * 10)
            for k in range(60) for level in range(3) for day in range(rnd.randrange(1, 6))]
    df = spark.createDataFrame(rows, "k int, level int, day int, clicks double, rev double")
    got = {r["k"]: r["rpc_est"] for r in rates.threshold_rate(df, ["k"], [F.col("day").desc()], 40).collect()}
    for k in got:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], -r[2]))
        expected = sequential_rate([(r[3], r[4]) for r in mine], 40)
        assert (got[k] is None) == (expected is None)
        if expected is not None:
            assert got[k] == pytest.approx(expected)


def test_levels_without_narrower_one_add_up(spark):
    rows = [(1, "a", "x", 2.0, 1.0), (1, "a", "y", 3.0, 2.0), (1, "b", "z", 5.0, 4.0)]
    df = spark.createDataFrame(rows, "day int, camp string, kw string, clicks double, rev double")
    facts = rates.attach_level_sums(df, ["day"], [("cmp", ["camp"])], ["clicks", "rev"])
    stacked = rates.stack_levels(facts, ["camp", "kw"], ["day"], ["cmp"], F.lit(1.0))
    got = {(r["kw"], r["level"]): (r["clicks"], r["rev"]) for r in stacked.collect()}
    assert got[("x", 0)] == (2.0, 1.0) and got[("x", 1)] == (3.0, 2.0) and got[("z", 1)] == (0.0, 0.0)


def test_bags_carried_day_by_day(spark):
    """Days joined together equal one run over all, also over days without sessions or conversions."""
    draw = random.Random(12)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=m), draw.choice([0, 0, 0, 0, 0, 70_000, 125_000]) if not 2 * 1440 < m < 4 * 1440 else 0)
            for i, m in enumerate(sorted(draw.randrange(6 * 1440) for _ in range(900))) if not 4 * 1440 < m < 5 * 1440]
    sessions = spark.createDataFrame(rows, "session_id long, creation_date timestamp, revenue_units long")
    whole = ordered.bag_kpis(sessions, parts=5)
    state, closed = None, None
    for day in range(6):
        today = sessions.filter(F.to_date("creation_date") == F.lit(start.date() + dt.timedelta(day)))
        added, state = ordered.bag_step(today, state, parts=3)
        closed = added if closed is None else closed.union(added)
        assert state.select("bag_id").distinct().count() <= 1
    daily = ordered.bag_report(closed, state)
    columns = sorted(whole.columns)
    for a, b in zip(whole.select(columns).orderBy("int_ix").collect(), daily.select(columns).orderBy("int_ix").collect()):
        assert [a["date"], a["hour"], a["int_ix"], a["clicks_num"]] == [b["date"], b["hour"], b["int_ix"], b["clicks_num"]]
        assert [a["leads_num"], a["rev_sum"], a["rev_avg"]] == pytest.approx([b["leads_num"], b["rev_sum"], b["rev_avg"]])
    assert whole.count() == daily.count()
