"""Policy labels and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adyield.functions.numeric import money_ratio

DAYS_PER_MONTH = 30.436875
HEALTH = ("STM", "BTM")
ADDONS = ("DENTAL", "VISION", "SUPPLEMENTAL")

# Sale months that behave alike, per plan length.
MONTH_GROUPS = {
    "364": [[7, 8, 9], [4, 5, 6], [2, 3, 10], [1, 11, 12]],
    "180": [[10, 11], [8, 9, 12], [2, 1, 7], [3, 4, 5, 6]],
    "90": [[2, 6, 5], [1, 8, 7, 3], [12, 4, 10, 9, 11]],
}
# Coefficients of the published duration score per plan length.
DURATION_SCORES = {
    90: {"intercept": 0.8455, "age": 0.0008, "children": -0.0189, "vision": 0.0,
         "months": {(1, 3, 7, 8): -0.0109, (2, 5, 6): -0.0342}},
    180: {"intercept": 0.5645, "age": 0.0018, "children": -0.0427, "vision": -0.0849,
          "months": {(1, 2, 7): 0.1244, (3, 4, 5, 6): 0.1635, (8, 9, 12): 0.0813}},
    364: {"intercept": 0.5258, "age": 0.0021, "children": -0.0237, "vision": -0.0514,
          "months": {(2, 3, 10): -0.0642, (4, 5, 6): -0.1189, (7, 8, 9): -0.1665}},
}


def _band(days: Column, limits: dict[int, object], last: object) -> Column:
    """First label whose limit exceeds ``days``; ``last`` beyond; NULL stays NULL."""
    out = F.when(days.isNull(), F.lit(None))
    for limit, label in limits.items():
        out = out.when(days < limit, F.lit(label))
    return out.otherwise(F.lit(last))


def plan_group(duration_sold: Column) -> Column:
    return _band(duration_sold, {45: "30", 75: "60", 135: "90", 265: "180", 365: "364"}, "364+")


def term_length(duration_sold: Column, terms: Column) -> Column:
    """Whole days per term."""
    return F.when(terms != 0, F.call_function("div", duration_sold, terms))


def plan_type(duration_sold: Column, terms: Column) -> Column:
    label = _band(term_length(duration_sold, terms), {45: "30", 75: "60", 135: "90", 265: "180"}, "364")
    return F.concat(label, F.lit("x"), terms.cast("string"))


def plan_type_order(duration_sold: Column, terms: Column) -> Column:
    rank = _band(term_length(duration_sold, terms), {45: 1, 75: 2, 135: 3, 265: 4}, 5)
    return F.coalesce(rank, F.lit(6))


def policy_status(effective: Column, end: Column, as_of: Column) -> Column:
    """``end`` is the termination date or, without one, the expiration date."""
    held = F.datediff(end, effective)
    return (F.when(held <= 10, "CANCELLED").when((held > 10) & (end <= as_of), "LAPSED")
            .when(end.isNull() | (end > as_of), "ACTIVE").otherwise("UNKNOWN"))


def coverage_days(effective: Column, expiration: Column) -> Column:
    return F.datediff(expiration, effective) + 1


def is_prepaid(payment_frequency: Column) -> Column:
    return F.coalesce(F.upper(payment_frequency) == "PREPAID", F.lit(False))


def monthly_premium(premium: Column, days: Column, prepaid: Column) -> Column:
    """Prepaid premiums brought to one month, four decimals."""
    return F.when(prepaid, F.round(F.try_divide(premium, days) * F.lit(DAYS_PER_MONTH), 4)).otherwise(premium)


def health_days_in_force(effective: Column, expiration: Column, lapse: Column, prepaid: Column, as_of: Column) -> Column:
    full_term = F.date_add(expiration, 1)
    end = (F.when(prepaid, full_term)
           .when(expiration <= as_of, F.coalesce(lapse, full_term))
           .when(expiration > as_of, F.coalesce(lapse, F.greatest(as_of, effective)))
           .otherwise(lapse))
    return F.greatest(F.datediff(end, effective), F.lit(0))


def addon_days_in_force(effective: Column, lapse: Column, as_of: Column) -> Column:
    return F.greatest(F.datediff(F.coalesce(lapse, F.greatest(as_of, effective)), effective), F.lit(0))


def member_role(relationship: Column, effective: Column, born: Column) -> Column:
    """Lower-cased relationship; a primary member under 18 counts as a child."""
    role = F.lower(relationship)
    return F.when((role == "primary") & (F.datediff(effective, born) < 365 * 18), "child").otherwise(role)


def age_at(effective: Column, born: Column) -> Column:
    return F.round(F.datediff(effective, born) / F.lit(365.25), 2)


def share_in_force(days_in_force: Column, days_sold: Column) -> Column:
    return money_ratio(F.round(days_in_force).cast("long") * F.lit(10000).cast("long"), days_sold)


def month_group(group: Column, sold_month: Column) -> Column:
    """Label of the sale month's group, such as 180_2_1_7."""
    out = F.when(group.isNull(), F.lit(None))
    for name, lists in MONTH_GROUPS.items():
        for months in lists:
            out = out.when((group == name) & sold_month.isin(months), F.lit("_".join([name, *map(str, months)])))
    return out.otherwise(F.lit(None))


def predict_duration_percent(plan_days: Column, age: Column, sold_month: Column, has_vision: Column,
                             has_children: Column) -> Column:
    """Expected share of the sold duration; NULL for other plan lengths."""
    out = F.when(plan_days.isNull(), F.lit(None).cast("double"))
    for days, score in DURATION_SCORES.items():
        value = (F.lit(score["intercept"]) + age * F.lit(score["age"])
                 + F.when(has_children, F.lit(score["children"])).otherwise(F.lit(0.0))
                 + F.when(has_vision, F.lit(score["vision"])).otherwise(F.lit(0.0)))
        for months, effect in score["months"].items():
            value = value + F.when(sold_month.isin(*months), F.lit(effect)).otherwise(F.lit(0.0))
        out = out.when(plan_days == days, value)
    return out


def round_to_tens(value: Column) -> Column:
    return F.bround(value, -1)


def merged_plan_type(plan: Column) -> Column:
    return F.when(plan.isin("30x1", "60x1", "90x1"), "90x1").otherwise(plan)


def merged_plan_group(group: Column) -> Column:
    return F.when(group.isin("30", "60", "90"), "90").otherwise(group)
