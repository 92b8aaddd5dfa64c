import pytest
from pyspark.sql import functions as F

from adyield.operators import keywords as kw
from adyield.plans import channel_bids, keyword_bids
from checks.bids import AS_OF, bids, perf_rows
from checks.views import view


def test_rows_are_cost_or_revenue(spark, sf):
    rows = perf_rows(spark, sf, 2000)
    got = rows.agg(F.count("*").alias("n"), F.sum(F.col("is_cost").cast("int") + F.col("is_revenue").cast("int")).alias("m")).first()
    assert got["n"] == got["m"] > 0
    assert rows.filter("is_cost AND rev IS NOT NULL").count() == 0
    assert rows.filter("is_revenue AND max_cpc IS NOT NULL").count() == 0


def test_only_geo_names_change(spark, sf):
    rows = perf_rows(spark, sf, 2000)
    changed = (F.col("keyword") != F.col("keyword_norm")) | (F.col("adgroup") != F.col("adgroup_norm"))
    assert rows.filter(~F.col("geo") & changed).count() == 0
    assert rows.filter(F.col("geo") & ~(F.contains("keyword_norm", F.lit("<STATE>")) & F.contains("adgroup_norm", F.lit("<STATE>")))).count() == 0


@pytest.fixture(scope="module")
def new_bids(spark, sf):
    return bids(spark, sf, 360).cache()


def test_bids_have_no_gaps(new_bids):
    rows = new_bids.collect()
    assert rows
    keys = ["keyword_id", "account_id", "clicks", "rev", "cost", "rpc_est", "cpc_target", "max_cpc_old", "max_cpc_new"]
    assert all(r[k] is not None for r in rows for k in keys)
    assert len({r["keyword_id"] for r in rows}) == len(rows)


def test_bids_stay_within_limits(new_bids):
    for r in new_bids.collect():
        low, high = 0.7 * r["max_cpc_old"], 1.2 * r["max_cpc_old"]
        assert low - 0.0051 <= r["max_cpc_new"] <= max(high, 0.05) + 0.0051


def test_geo_groups_share_their_sums(new_bids):
    rows = [r for r in new_bids.collect() if r["geo"]]
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[k] for k in kw.GROUP), set()).add(round(r["clicks"], 6))
    assert all(len(v) == 1 for v in groups.values())


def test_projection_identity(new_bids):
    row = keyword_bids.projection_identity(new_bids).first()
    assert row["cost_gap"] < 1e-10 and row["rev_gap"] < 1e-10


def test_check_reports_a_status(new_bids):
    assert keyword_bids.bid_check(new_bids).first()["status"] in ("PASS", "WARN")


def test_jitter_is_small_and_repeatable(new_bids):
    first = {r["keyword_id"]: r["max_cpc_test"] for r in keyword_bids.jittered_bids(new_bids).collect()}
    again = {r["keyword_id"]: r["max_cpc_test"] for r in keyword_bids.jittered_bids(new_bids).collect()}
    old = {r["keyword_id"]: r["max_cpc_old"] for r in new_bids.collect()}
    assert first == again
    assert all(abs(first[k] - old[k]) <= 0.0151 for k in old)


def test_files_must_hold_every_bid_twice(spark):
    once = spark.createDataFrame([(1, 0.5), (2, 0.6)], "keyword_id long, bid double")
    assert keyword_bids.publish_check(once.unionByName(once)).first()["halves"] is True
    assert keyword_bids.publish_check(once.unionByName(once).limit(3)).first()["halves"] is False
    assert keyword_bids.publish_set(once.unionByName(once)).count() == 2


@pytest.mark.parametrize("as_of, days", [("2024-01-28", {5, 6}), ("2024-01-29", {5, 6}), ("2024-01-31", {0, 1, 2, 3, 4}),
                                         ("2024-01-27", {0, 1, 2, 3, 4, 5, 6})])
def test_weekday_partition(spark, sf, as_of, days):
    kept = channel_bids.same_day_type(view(spark, sf, "channel_cost"), as_of)
    assert {r[0] for r in kept.select(F.weekday("date")).distinct().collect()} <= days


def test_reset_falls_back_up_the_hierarchy(spark):
    rows = [(1, 1, 1, 11, "2024-01-10", 0.5, 10.0), (1, 1, 1, 12, "2024-01-01", 9.0, 5.0), (1, 1, 2, 21, "2024-01-01", 9.0, 5.0)]
    df = spark.createDataFrame(rows, "account_id int, campaign_id int, adgroup_id int, keyword_id int, d string, max_cpc double, clicks double")
    df = df.withColumn("date", F.to_date("d")).withColumn("transaction_date_time", F.col("d"))
    resets = spark.createDataFrame([(1, "2024-01-10")], "account_id int, r string").select("account_id", F.to_date("r").alias("reset_date"))
    got = {r["keyword_id"]: r["max_cpc"] for r in kw.reset_bids(df, resets).collect()}
    assert got == {11: 0.5, 12: 0.5, 21: 0.5}
    assert AS_OF
