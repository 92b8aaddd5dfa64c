import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from adyield.operators import policies as op
from adyield.plans import lifetime
from checks.views import view


@pytest.fixture(scope="module")
def premiums(spark, sf):
    return lifetime.policy_premiums(view(spark, sf, "applications"), view(spark, sf, "policy_members")).cache()


def test_one_row_per_policy_and_outside_id(premiums):
    assert premiums.count() == premiums.select("app_pid", "foreign_pid").distinct().count()


def test_fake_and_test_policies_are_gone(spark, sf, premiums):
    bad = op.excluded_policies(view(spark, sf, "applications"))
    assert bad.count() > 0
    assert premiums.join(bad, "app_pid", "left_semi").count() == 0


def test_excluded_ids(spark, sf):
    some = lifetime.policy_premiums(view(spark, sf, "applications"), view(spark, sf, "policy_members"), excluded=[3, 4])
    assert some.filter(F.col("app_pid").isin(3, 4)).count() == 0


def test_known_values_ignore_nulls(spark):
    rows = [("a", 1, None, 5), ("a", 2, "x", 4), ("a", None, "y", 3), ("a", 3, "z", None)]
    df = spark.createDataFrame(rows, "k string, at int, v string, w int")
    got = df.groupBy("k").agg(op.first_known(F.col("v"), F.col("at")).alias("first"),
                              op.last_known(F.col("v"), F.col("at")).alias("last"),
                              op.last_known(F.col("w"), F.col("at")).alias("last_w")).first()
    assert (got["first"], got["last"], got["last_w"]) == ("x", "z", 4)


def test_fee_periods_close_up(spark):
    rows = [("C", f"2019-{m:02d}-01", v) for m, v in enumerate([1.0, 1.0, 2.0, 2.0, 1.0], start=1)]
    df = spark.createDataFrame(rows, "c string, d string, fee_share double").withColumn("effective_dt", F.to_date("d"))
    got = [(r["effective_dt"], r["expiration_dt"], r["fee_share"]) for r in op.fee_periods(df, ["c"]).orderBy("effective_dt").collect()]
    assert got == [(dt.date(2019, 1, 1), dt.date(2019, 2, 28), 1.0), (dt.date(2019, 3, 1), dt.date(2019, 4, 30), 2.0),
                   (dt.date(2019, 5, 1), None, 1.0)]


def test_survival_never_rises(spark, sf, premiums):
    rows = op.survival_curve(op.ended_policies(premiums).filter("plan_type = '364x1'"), 364).collect()
    by_month = {}
    for r in sorted(rows, key=lambda r: r["duration_inforce"]):
        by_month.setdefault(r["sold_month"], []).append(r["percent_active"])
    assert by_month and all(len(v) == 364 and all(a >= b for a, b in zip(v, v[1:])) for v in by_month.values())


def test_duration_model_is_least_squares(spark):
    rng = np.random.default_rng(1)
    months = ["90_1_8_7_3", "90_2_6_5", "90_12_4_10_9_11"]
    rows = [(i, "f", "90", months[i % 3], float(20 + i % 45), int(rng.random() < 0.4), 0, 0, 90, 50.0, float(rng.random())) for i in range(200)]
    modelled = spark.createDataFrame(rows, "app_pid long, foreign_pid string, plan_group string, month_group string, primary_age double, "
                                           "has_children int, has_dental int, has_vision int, duration_sold int, duration_inforce double, inforce_percent double")
    model, scored = lifetime.fit_duration(modelled, "90")
    x = np.array([[r[4], r[5], r[3] == months[0], r[3] == months[1], 1.0] for r in rows], dtype=float)
    beta = np.linalg.lstsq(x, np.array([r[10] for r in rows]), rcond=None)[0]
    np.testing.assert_allclose([*model.coefficients, model.intercept], beta, atol=1e-8)
    assert scored.count() == 200
