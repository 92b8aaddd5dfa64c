import numpy as np
import pytest
from pyspark.sql import functions as F

from adyield.functions import distributions as d
from adyield.functions import network, numeric, policy, text, timeparts


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("v")).first()["v"]


def test_inet_aton_and_bucket(spark):
    assert one(spark, network.inet_aton(F.col("ip")), ip="17.198.0.5") == 17 * 2**24 + 198 * 2**16 + 5
    assert one(spark, network.inet_aton(F.col("ip")), ip="") is None
    assert one(spark, network.ip_index(F.col("ip")), ip="17.198.0.5") == "17.198"
    assert one(spark, network.extract_octets(F.col("ip"), (1, 2), join=True), ip="17.198.0.5") == "17.198"
    assert one(spark, network.extract_octets(F.col("ip")), ip="17.198.0.5") == ["17", "198", "0", "5"]


def test_time_zone_parts(spark):
    ts = F.lit("2024-07-07 03:44:59").cast("timestamp_ntz")
    local = timeparts.to_local(ts, F.lit("America/New_York"))
    assert one(spark, timeparts.utc_offset(ts, local)) == -4
    assert one(spark, timeparts.quarter_hour(ts)) == 3.5
    assert one(spark, timeparts.day_of_week(ts)) == 0
    assert one(spark, timeparts.monday_first(timeparts.day_of_week(ts))) == 6
    assert str(one(spark, timeparts.eastern_standard_date(ts))) == "2024-07-06"


@pytest.mark.parametrize("raw, tagged", [
    ("marketplace new york", "marketplace <STATE>"),
    ("+marketplace +new +york", "+marketplace +<STATE>"),
    ("plans WEST-virginia now", "plans <STATE> now"),
    ("+district +of +columbia", "+<STATE>"),
    ("arkansas kansas", "<STATE> <STATE>"),
    ("no place", "no place"),
])
def test_state_tags(spark, raw, tagged):
    assert one(spark, text.tag_states(F.col("t")), t=raw) == tagged


def test_text_helpers(spark):
    assert one(spark, text.url_parameter(F.col("u"), "zipcode"), u="https://a/?x=1&zipcode=123&r=2") == "123"
    assert one(spark, text.recode(F.col("x"), text.DEVICE_NAMES), x="T") == "TBLT"
    assert one(spark, text.recode(F.col("x"), text.DEVICE_NAMES), x="TV") == "TV"
    assert one(spark, text.tag_count(F.lit("<STATE> <STATE>"))) == 2
    assert one(spark, text.contains_flag(F.lit(None).cast("string"), "x")) is False
    assert one(spark, text.clean_zip(F.lit(" 1|2\n"))) == "12"


def test_money_ratio_rounds_half_up(spark):
    assert one(spark, numeric.money_ratio(F.lit(1).cast("long"), F.lit(2))) == 0.0001
    assert one(spark, numeric.money_ratio(F.lit(-1).cast("long"), F.lit(2))) == -0.0001
    assert one(spark, numeric.money_ratio(F.lit(5).cast("long"), F.lit(0))) is None


def test_weighted_statistics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0), (None, 2.0)], "v double, w double")
    row = df.agg(numeric.wavg(F.col("v"), F.col("w")).alias("m"), numeric.wstd(F.col("v"), F.col("w")).alias("s")).first()
    assert row["m"] == pytest.approx(10 / 6)
    none = spark.createDataFrame([(1.0, 0.0)], "v double, w double")
    assert none.agg(numeric.wavg(F.col("v"), F.col("w")).alias("m")).first()["m"] is None


def test_bid_clip(spark):
    def clip(target):
        return one(spark, numeric.bid_clip(F.lit(target).cast("double"), F.lit(1.0), F.lit(-0.3), F.lit(0.2), F.lit(0.05)))

    assert [clip(v) for v in (0.1, 0.99, 5.0, None)] == [0.7, 0.99, 1.2, None]


def test_policy_labels(spark):
    def group(n):
        return one(spark, policy.plan_group(F.lit(n).cast("long")))

    assert [group(n) for n in (44, 45, 74, 75, 134, 135, 264, 265, 364, 365, None)] == [
        "30", "60", "60", "90", "90", "180", "180", "364", "364", "364+", None]
    assert one(spark, policy.plan_type(F.lit(728).cast("long"), F.lit(2).cast("long"))) == "364x2"
    assert one(spark, policy.plan_type(F.lit(269).cast("long"), F.lit(2).cast("long"))) == "90x2"
    assert one(spark, policy.plan_type(F.lit(0).cast("long"), F.lit(0).cast("long"))) is None
    assert one(spark, policy.plan_type_order(F.lit(0).cast("long"), F.lit(0).cast("long"))) == 6
    assert one(spark, policy.month_group(F.lit("180"), F.lit(7))) == "180_2_1_7"
    score = policy.predict_duration_percent(F.lit(180), F.lit(40.0), F.lit(7), F.lit(True), F.lit(False))
    assert one(spark, score) == pytest.approx(0.5645 + 40 * 0.0018 - 0.0849 + 0.1244)


def test_policy_status(spark):
    def status(effective, end):
        return one(spark, policy.policy_status(F.lit(effective).cast("date"), F.lit(end).cast("date"), F.lit("2020-12-31").cast("date")))

    assert status("2020-01-01", "2020-01-11") == "CANCELLED"
    assert status("2020-01-01", "2020-06-01") == "LAPSED"
    assert status("2020-01-01", "2021-06-01") == "ACTIVE"
    assert status("2020-01-01", None) == "ACTIVE"


def test_distributions_against_known_values():
    # table values of Student's t: P(|T| > 2.228139) = .05 at 10 df; 97.5 % point at 5 df is 2.570582
    assert d.t_two_sided(np.array([2.228138852]), np.array([10.0]))[0] == pytest.approx(0.05, abs=1e-9)
    assert d.t_quantile(np.array([0.975]), np.array([5.0]))[0] == pytest.approx(2.570581836, abs=1e-6)
    # Beta(1, b): quantile 1 - (1-p)^(1/b); Beta(a, 1): p^(1/a)
    assert d.beta_quantile(0.95, 1.0, 7.0) == pytest.approx(1 - 0.05 ** (1 / 7), rel=1e-12)
    assert d.beta_quantile(0.05, 9.0, 1.0) == pytest.approx(0.05 ** (1 / 9), rel=1e-12)
    # symmetry and a binomial identity: I_p(k, n-k+1) = P(Bin(n, p) >= k)
    assert d.incomplete_beta(3.0, 5.0, 0.3) == pytest.approx(1 - d.incomplete_beta(5.0, 3.0, 0.7), rel=1e-12)
    from math import comb
    tail = sum(comb(7, k) * 0.3**k * 0.7 ** (7 - k) for k in range(3, 8))
    assert d.incomplete_beta(3.0, 5.0, 0.3) == pytest.approx(tail, rel=1e-12)
    assert np.isnan(d.beta_quantile(0.5, 1.0, -1.0))


def test_beta_udf_gives_null_for_invalid(spark):
    df = spark.createDataFrame([(0.5, 2.0, -1.0), (0.5, 2.0, 2.0)], "p double, a double, b double")
    got = [r["q"] for r in df.select(d.beta_ppf("p", "a", "b").alias("q")).collect()]
    assert got[0] is None and got[1] == pytest.approx(0.5)


def decimal_beta(a, b, x):
    """Distribution function by Simpson sums with 40 digits, out to 14 deviations."""
    from decimal import Decimal, getcontext

    getcontext().prec = 40
    a, b, x = Decimal(a), Decimal(b), Decimal(x)
    top, spread = (a - 1) / (a + b - 2), (a * b / (a + b) ** 3).sqrt()
    low, high = max(Decimal(0), top - 14 * spread), min(Decimal(1), top + 14 * spread)

    def height(t):
        return ((a - 1) * (t / top).ln() + (b - 1) * ((1 - t) / (1 - top)).ln()).exp() if 0 < t < 1 else Decimal(0)

    def area(u, v, n=2000):
        step = (v - u) / n
        return (height(u) + height(v) + 4 * sum(height(u + step * i) for i in range(1, n, 2)) + 2 * sum(height(u + step * i) for i in range(2, n, 2))) * step / 3

    below, above = area(low, x), area(x, high)
    return float(below / (below + above))


@pytest.mark.parametrize("a, b, away", [
    (301.5, 400, 0.3), (350, 9e4, -1), (1e7, 1e7, 1.5), (1e8, 1e8, 0), (1e10, 3e9, -2.2), (1e10, 1e10, 0.7), (5e8, 400, 0.5), (1e10, 500, -1), (250, 1e9, -0.8), (299, 301, 2)])
def test_beta_of_large_counts(a, b, away):
    x = a / (a + b) + away * (a * b / (a + b) ** 3) ** 0.5
    assert d.incomplete_beta(np.array([a]), np.array([b]), np.array([x]))[0] == pytest.approx(decimal_beta(a, b, x), abs=1e-9)


@pytest.mark.parametrize("a, b", [(10, 10), (1e7, 1e7), (1e10, 1e10), (2e4, 7e9), (800, 1e10), (5, 1e10)])
def test_beta_quantiles_of_large_counts(a, b):
    for p in (0.05, 0.5, 0.95):
        at = d.beta_quantile(p, a, b)
        assert d.incomplete_beta(a, b, at) == pytest.approx(p, abs=1e-9)
        if min(a, b) > 100:
            assert decimal_beta(a, b, float(at)) == pytest.approx(p, abs=1e-9)


def test_beta_of_a_small_and_a_huge_count():
    # of whole a the distribution function is a binomial tail
    from decimal import Decimal, getcontext

    getcontext().prec = 60
    for a, b, x in ((40, 10**10, 4.2e-9), (3, 10**9, 1e-9), (1, 10**10, 3e-11)):
        p, total, term = Decimal(x), Decimal(0), (1 - Decimal(x)) ** (a + b - 1)
        for j in range(a):
            total += term
            term = term * (a + b - 1 - j) / (j + 1) * p / (1 - p)
        assert d.incomplete_beta(np.array([float(a)]), np.array([float(b)]), np.array([x]))[0] == pytest.approx(float(1 - total), abs=1e-9)


def test_t_of_many_degrees_of_freedom():
    # the normal law, to which a billion degrees of freedom come within 1e-9
    from statistics import NormalDist

    for t in (0.1, 1.0, 1.959963984540054, 5.0):
        assert d.t_two_sided(np.array([t]), np.array([4e9]))[0] == pytest.approx(2 * NormalDist().cdf(-t), abs=1e-9)
    assert d.t_quantile(np.array([0.975, 0.95]), np.array([4e9, 4e9])) == pytest.approx([1.959963984540054, 1.6448536269514722], abs=1e-7)


def test_unsettled_fractions_are_no_values(monkeypatch):
    monkeypatch.setattr(d, "STEPS", 3)
    with pytest.raises(ArithmeticError):
        d.incomplete_beta(np.array([200.0]), np.array([200.0]), np.array([0.49]))
