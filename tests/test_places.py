import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adyield.functions.distributions import t_two_sided
from adyield.operators import locations as loc, sampling


def place_rows(seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(1500):
        city = rnd.choice(["c1", "c1", "c1", "c2", "c3"])
        dma = "d1" if city != "c3" else "d2"
        sold = rnd.random() < 0.4
        rows.append(("HEALTH", "NY", dma, city, int(sold), rnd.random() * (30 if city == "c2" else 10) if sold else 0.0))
    return rows


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(
        place_rows(), "product string, state_code string, dma_state string, city string, has_conversion int, revenue double")


def welch(a, b):
    ea, eb = np.var(a, ddof=1) / len(a), np.var(b, ddof=1) / len(b)
    t = (np.mean(a) - np.mean(b)) / math.sqrt(ea + eb)
    df = (ea + eb) ** 2 / (ea**2 / (len(a) - 1) + eb**2 / (len(b) - 1))
    return t, float(t_two_sided(np.array([t]), np.array([df]))[0])


def test_exemptions_equal_pairwise_tests(facts):
    rows = place_rows()
    got = {r["city"]: r for r in loc.location_exemptions(facts, ["product", "dma_state"], ["city"], 50, None).collect()}
    assert set(got) == {"c1", "c2"}  # c3 is alone in its metro
    for city in got:
        child = [r[5] for r in rows if r[3] == city]
        rest = [r[5] for r in rows if r[2] == "d1" and r[3] != city]
        t, p = welch(rest, child)
        assert got[city]["t"] == pytest.approx(t) and got[city]["pval"] == pytest.approx(p)
    significant = loc.location_exemptions(facts, ["product", "dma_state"], ["city"], 50, 0.05)
    assert {r["city"] for r in significant.collect()} == {c for c in got if got[c]["pval"] <= 0.05}


def test_greedy_buckets_restart_their_count(spark):
    stats = spark.createDataFrame([("P", f"s{i:02d}", float(i), c) for i, c in enumerate([5, 5, 1, 9, 2, 2, 6])],
                                  "product string, state_code string, rps double, conversions long")
    got = [r["bucket"] for r in loc.greedy_buckets(stats, 3).orderBy("rps").collect()]
    share, filled, bucket, expected = math.ceil(30 / 3), 0, 1, []
    for c in [5, 5, 1, 9, 2, 2, 6]:
        expected.append(bucket)
        filled += c
        if filled > share:
            filled, bucket = 0, bucket + 1
    assert got == expected
    ranges = loc.bucket_ranges(loc.greedy_buckets(stats, 3)).orderBy("bucket").collect()
    assert ranges[0]["rps_min"] == 0
    assert all(a["rps_max"] == b["rps_min"] for a, b in zip(ranges, ranges[1:]))


def test_round_robin_groups_are_even(spark):
    df = spark.createDataFrame([(f"r{i}", float(i)) for i in range(11)], "region string, final_score double")
    got = [r["group"] for r in loc.round_robin(df, 3).orderBy(F.col("final_score").desc()).collect()]
    assert got == [1, 2, 3] * 3 + [1, 2]


def test_elbow_error_falls(facts):
    stats = loc.location_stats(facts, ["dma_state", "city"])
    errors = [r["squared_error"] for r in loc.elbow(stats, ["sessions", "rps"], 4).orderBy("clusters").collect()]
    assert errors == sorted(errors, reverse=True)


def test_bootstrap_interval_holds_the_mean(spark):
    df = spark.createDataFrame([(i, float(i % 10)) for i in range(500)], "id long, v double")
    rows = sampling.bootstrap_error(df, "v", ["id"], 10, 200).orderBy("sample_size").collect()
    assert [r["sample_size"] for r in rows] == list(range(1, 11))
    assert all(r["lower_ci"] < r["mean_percent_error"] < r["upper_ci"] for r in rows)
    assert rows[0]["mean_percent_error"] > rows[-1]["mean_percent_error"]
    again = sampling.bootstrap_error(df, "v", ["id"], 10, 200).orderBy("sample_size").collect()
    assert [r["mean_percent_error"] for r in rows] == pytest.approx([r["mean_percent_error"] for r in again])


def test_resample_draws_every_time(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(100)], "id long, band int")
    counts = {r["band"]: r["n"] for r in sampling.resampled_counts(df, "band", ["id"], 4000).collect()}
    assert sum(counts.values()) == 4000 and set(counts) == {0, 1, 2, 3}
    assert all(800 < n < 1200 for n in counts.values())


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([(0.5 + 0.1 * (i % 10), 1 + i % 3) for i in range(60)], "x double, w int")
    rows = sampling.weighted_density(df, "x", "w", -2.0, 4.0, 600).orderBy("point").collect()
    step = rows[1]["at"] - rows[0]["at"]
    assert sum(r["density"] for r in rows) * step == pytest.approx(1, abs=1e-3)


def test_histogram_counts_every_row(facts):
    rows = loc.histogram(facts, "revenue", 10).collect()
    assert sum(r["n"] for r in rows) == 1500 and max(r["bin"] for r in rows) == 9


def test_moments_far_from_zero(spark):
    """Values of about 1e8 with a variance of about 1: exemptions and tests as from the values less 1e8."""
    draw = np.random.default_rng(4)
    rows = [("P", "m", f"c{i % 3}", float(v + i % 3 / 10), 1) for i, v in enumerate(draw.normal(size=600).round(6))]
    near = spark.createDataFrame(rows, "product string, dma_state string, city string, revenue double, has_conversion int")
    far = near.withColumn("revenue", F.col("revenue") + 1e8)
    for find in (lambda f: loc.location_exemptions(f, ["product", "dma_state"], ["city"], 1, None).orderBy("city"),
                 lambda f: loc.welch_test(f, F.col("city") == "c1", keys=["product"])):
        for a, b in zip(find(near).collect(), find(far).collect()):
            assert [a["t"], a["df"], a["pval"]] == pytest.approx([b["t"], b["df"], b["pval"]], rel=2e-6, abs=2e-6)
    by_city = {r["city"]: r for r in loc.location_exemptions(far, ["product", "dma_state"], ["city"], 1, None).collect()}
    for city, row in by_city.items():
        t, p = welch([r[3] for r in rows if r[2] != city], [r[3] for r in rows if r[2] == city])
        assert row["t"] == pytest.approx(t, rel=2e-6, abs=2e-6) and row["pval"] == pytest.approx(p, rel=2e-6)


def test_region_clusters_work_their_rows_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.createDataFrame([(f"r{i}", float(i % 7), float(i)) for i in range(40)], "region string, a double, b double")
    for fit in (lambda df: loc.region_clusters(df, ["a", "b"], 2), lambda df: loc.elbow(df, ["a", "b"], 4), lambda df: loc.scaled(df, ["a", "b"])):
        before = seen.value
        fit(rows.mapInPandas(count, rows.schema)).collect()
        assert seen.value - before == 40
