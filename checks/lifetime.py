"""Policy tables, fees and durations."""

from __future__ import annotations

from pyspark.sql import functions as F

from adyield.functions import policy as p
from adyield.operators import policies as op
from adyield.plans import lifetime
from checks.registry import register
from checks.views import view, with_views

VIEWS = "applications policy_members"


def premiums(spark, sf):
    return lifetime.policy_premiums(view(spark, sf, "applications"), view(spark, sf, "policy_members"))


# The check's own way: one fold per policy, one join of it to the policy's rows, one grouping that fills the columns of both kinds.
HEALTH = "('STM', 'BTM')"
ASOF = "(SELECT max(datetime_created)::DATE FROM applications)"


def opening(value: str) -> str:
    """What the earliest health row that knows ``value`` says."""
    return (f"(min({{'undated': effective_date IS NULL, 'day': effective_date, 'says': {value}}}) "
            f"FILTER (kind = 'health' AND {value} IS NOT NULL)).says")


POLICY = f"""marked AS (
  SELECT *, least(termination_date, date_cancelled) AS left_on, IF(product_type IS NULL, 'blank', coalesce(
    map {{'STM': 'health', 'BTM': 'health', 'DENTAL': 'addon', 'VISION': 'addon', 'SUPPLEMENTAL': 'addon'}}[upper(product_type)], 'other')) AS kind
  FROM applications WHERE app_pid IS NOT NULL),
folded AS (
  SELECT app_pid, count(*) FILTER (status IN ('FAKE', 'VOID') OR agency_id ILIKE '%test%') AS bad_rows,
    {opening('product_type')} AS usual_product, {opening('premium_amount')} AS usual_premium,
    {', '.join(f"min({v}) FILTER (kind = '{k}' AND left_on IS NOT NULL) AS {k}_{v}" for k in ('health', 'blank', 'addon') for v in ('effective_date', 'left_on'))}
  FROM marked GROUP BY app_pid),
policy AS MATERIALIZED (
  SELECT app_pid, usual_product, usual_premium, addon_effective_date AS addon_min_effective_date, addon_left_on AS addon_lapse_date,
    {', '.join(f"IF(usual_product IS NULL, NULL, least(health_{v}, blank_{v})) AS {n}" for v, n in (('effective_date', 'health_min_effective_date'), ('left_on', 'health_lapse_date')))}
  FROM folded WHERE bad_rows = 0)"""
TERMS = f"""{POLICY},
priced AS (
  SELECT marked.* EXCLUDE (foreign_pid), coalesce(foreign_pid, app_pid::VARCHAR) AS foreign_pid, upper(coalesce(product_type, usual_product)) AS product,
    coalesce(premium_amount, usual_premium) AS price, expiration_date - effective_date + 1 AS days_sold, health_lapse_date, addon_lapse_date,
    coalesce(upper(payment_frequency) = 'PREPAID', false) AS prepaid, {ASOF} AS newest
  FROM marked JOIN policy USING (app_pid)),
terms AS MATERIALIZED (
  SELECT *, product IN {HEALTH} AS is_health, IF(prepaid, round(price / days_sold * 30.436875, 4), price) AS monthly,
    product IN ('DENTAL', 'VISION', 'SUPPLEMENTAL') AND monthly IS NOT NULL AS is_addon,
    IF(expiration_date <= newest, expiration_date + 1, IF(expiration_date > newest, greatest(newest, effective_date), NULL)) AS runs_to,
    greatest(0, IF(prepaid, expiration_date + 1, coalesce(health_lapse_date, runs_to)) - effective_date) AS health_days,
    nullif(greatest(0, coalesce(addon_lapse_date, greatest(newest, effective_date)) - effective_date), 0) AS addon_days
  FROM priced WHERE product IS NOT NULL)"""


def by_days(column: str) -> str:
    return f"sum({column} * days_sold) FILTER (is_health) / sum(days_sold) FILTER (is_health)"


def of_product(product: str, what: str, how: str = "sum") -> str:
    return f"{how}({what}) FILTER (is_addon AND product = '{product}')"


SIDES = {"h": ("is_health", "health_lapse_date"), "a": ("is_addon", "addon_lapse_date")}
BOTH_SIDES = ",\n    ".join(
    f"{fold} FILTER ({rows}) AS {side}_{name}" for side, (rows, lapse) in SIDES.items() for name, fold in {
        "rows": "count(*)", "carrier_id": "min(carrier_id)", "product_type": "min(product)", "datetime_created": "min(datetime_created)",
        "datetime_modified": "max(datetime_modified)", "effective_date": "min(effective_date)", "termination_date": f"min({lapse})",
        "is_prepaid": "max(prepaid::INT)"}.items())
HEALTH_COLUMNS = {
    "expiration_date": "max(expiration_date) FILTER (is_health)", "duration_sold": "(sum(days_sold) FILTER (is_health))::BIGINT",
    "sequence_max": "count(*) FILTER (is_health AND days_sold <> 0)", "premium_health": by_days("monthly"),
    "enrollment_fee_health": "nullif(max(application_fee) FILTER (is_health), 0)", "premium_rider": f"nullif({by_days('extras_amount')}, 0)",
    **{f"{fee}_health": f"nullif({by_days(fee)}, 0)" for fee in ("billing_fee", "association_fee", "admin_fee")}}
ADDON_COLUMNS = {
    **{f"premium_{n}": of_product(v, "monthly") for n, v in (("dental", "DENTAL"), ("vision", "VISION"), ("supp", "SUPPLEMENTAL"))},
    **{f"has_{n}": f"(count(*) FILTER (is_addon AND product = '{v}') > 0)::INT"
       for n, v in (("dental", "DENTAL"), ("vision", "VISION"), ("supp", "SUPPLEMENTAL"))},
    "association_fee_dental": of_product("DENTAL", "nullif(association_fee, 0)"),
    "enrollment_fee_dental": of_product("DENTAL", "nullif(application_fee, 0)"),
    "admin_fee_dental": of_product("DENTAL", "admin_fee"), "admin_fee_vision": of_product("VISION", "admin_fee")}
PLANS = f"""{TERMS},
plans AS MATERIALIZED (
  SELECT app_pid, foreign_pid, {BOTH_SIDES},
    (sum(health_days) FILTER (is_health))::BIGINT AS h_days, avg(addon_days) FILTER (is_addon) AS a_days,
    {', '.join(f'{fold} AS {name}' for name, fold in (HEALTH_COLUMNS | ADDON_COLUMNS).items())}
  FROM terms WHERE is_health OR is_addon GROUP BY app_pid, foreign_pid)"""


def side_of_plans(side: str, columns: dict[str, str]) -> str:
    shared = ("carrier_id", "product_type", "effective_date", "termination_date", "is_prepaid")
    return (f"SELECT app_pid, foreign_pid, {', '.join(f'{side}_{c} AS {c}' for c in shared)}, {side}_days AS duration_inforce, "
            f"{', '.join(columns)} FROM plans WHERE {side}_rows > 0")


FIRST_SAID = {"session_id": "session_id", "user_id": "session_user_id", "email": "email"}
LAST_SAID = {"phone": "phone_primary", "agent_id": "agent_id", "agency_id": "agency_id", "zip": "trim(zip)", "city": "city", "state": "state"}
SAID = [f"({fold}({{'at': datetime_created, 'says': {value}}}) FILTER ({value} IS NOT NULL)).says AS {name}"
        for fold, names in (("min", FIRST_SAID), ("max", LAST_SAID)) for name, value in names.items()]
CONTACT = f"""contact AS (
  SELECT * EXCLUDE (email, phone), md5(email) AS email_md5, md5(phone) AS phone_md5
  FROM (SELECT app_pid, {', '.join(SAID)} FROM applications WHERE NOT agency_id ILIKE '%test%' GROUP BY app_pid))"""
EITHER = ("datetime_created", "carrier_id", "effective_date", "termination_date", "is_prepaid")
STEPS = "[1 + ({0} >= 45)::INT + ({0} >= 75)::INT + ({0} >= 135)::INT + ({0} >= 265)::INT{1}]"
PREMIUM = f"""{PLANS},
{CONTACT},
people AS (
  SELECT app_pid, count(*) AS plan_members, {', '.join(f"count(*) FILTER (role = '{r}') AS {n}_members" for r, n in (('spouse', 'spousal'), ('child', 'children')))},
    {', '.join(f"{fold}(age) FILTER (role = '{r}') AS {n}" for r, fold, n in (
        ('primary', 'max', 'primary_age'), ('spouse', 'max', 'spouse_age'), ('child', 'min', 'child_age_youngest'),
        ('child', 'max', 'child_age_oldest'), ('child', 'avg', 'child_age_average')))}
  FROM (SELECT app_pid, round(lived / 365.25, 2) AS age, IF(relation = 'primary' AND lived < 6570, 'child', relation) AS role
    FROM (SELECT app_pid, lower(relationship) AS relation, coalesce(h_effective_date, a_effective_date) - dob AS lived
      FROM policy_members JOIN plans USING (app_pid)))
  GROUP BY app_pid),
premium AS (
  SELECT app_pid, foreign_pid, {', '.join(f'coalesce(h_{c}, a_{c}) AS {c}' for c in EITHER)},
    coalesce(h_product_type, IF(has_dental = 1, 'DENTAL - SA', IF(has_supp = 1, 'SUPPLEMENTAL - SA', NULL))) AS product_type,
    {', '.join(f'IF(a_rows > 0, {c}, {0 if c.startswith("has_") else "NULL"}) AS {c}' for c in ADDON_COLUMNS)},
    {', '.join(f'IF(h_rows > 0, {c}, NULL) AS {c}' for c in HEALTH_COLUMNS)},
    coalesce(h_days::DOUBLE, a_days) AS duration_inforce, contact.* EXCLUDE (app_pid),
    strftime(least(h_datetime_modified, a_datetime_modified), '%Y-%m-%d') AS app_last_modified,
    coalesce(people.plan_members, 1) AS plan_members, coalesce(people.spousal_members, 0) AS spousal_members,
    coalesce(people.children_members, 0) AS children_members, people.* EXCLUDE (app_pid, plan_members, spousal_members, children_members),
    {ASOF} AS asof_date, coalesce(h_termination_date, a_termination_date, plans.expiration_date) AS over_on,
    IF(over_on - coalesce(h_effective_date, a_effective_date) <= 10, 'CANCELLED', IF(over_on <= {ASOF}, 'LAPSED', 'ACTIVE')) AS status,
    ['30', '60', '90', '180', '364', '364+']{STEPS.format('plans.duration_sold', ' + (plans.duration_sold > 364)::INT')} AS plan_group,
    plans.duration_sold // nullif(plans.sequence_max, 0) AS term,
    ['30', '60', '90', '180', '364']{STEPS.format('term', '')} || 'x' || plans.sequence_max AS plan_type,
    coalesce([1, 2, 3, 4, 5]{STEPS.format('term', '')}, 6)::INT AS plan_type_order,
    IF(plans.duration_sold <> 0, (coalesce(h_days::DOUBLE, a_days).round()::BIGINT * 20000 + plans.duration_sold)
      // (2 * plans.duration_sold) / 10000.0, NULL) AS inforce_percent
  FROM plans LEFT JOIN contact USING (app_pid) LEFT JOIN people USING (app_pid))"""

register("policies_cleaned", lambda spark, sf: op.clean_applications(view(spark, sf, "applications")).select(
    "app_pid", "session_id", "product_fixed", F.col("coverage_duration").cast("long").alias("coverage_duration"), "premium_fixed"),
    with_views("applications", "SELECT app_pid, session_id, product AS product_fixed, days_sold AS coverage_duration, price AS premium_fixed FROM terms", TERMS),
    "premium_fixed:6")
register("policies_lapse_dates", lambda spark, sf: op.lapse_dates(view(spark, sf, "applications")).select(
    "app_pid", "health_lapse_date", "addon_lapse_date", "health_min_effective_date", "addon_min_effective_date").filter(
        "coalesce(health_lapse_date, addon_lapse_date) IS NOT NULL"),
    with_views("applications", """
SELECT app_pid, health_lapse_date, addon_lapse_date, health_min_effective_date, addon_min_effective_date
FROM policy WHERE coalesce(health_lapse_date, addon_lapse_date) IS NOT NULL""", POLICY))
BASE_DIGITS = ("premium_health:9 billing_fee_health:9 association_fee_health:9 admin_fee_health:9 enrollment_fee_health:6 premium_rider:9")
register("policies_base", lambda spark, sf: op.base_policies(op.fixed_applications(view(spark, sf, "applications"))).drop(
    "datetime_created", "datetime_modified"), with_views("applications", side_of_plans("h", HEALTH_COLUMNS), PLANS), BASE_DIGITS)
ADDON_DIGITS = "duration_inforce:9 premium_dental:9 premium_vision:9 premium_supp:9"
register("policies_addon", lambda spark, sf: op.addon_policies(op.fixed_applications(view(spark, sf, "applications"))).drop(
    "datetime_created", "datetime_modified"), with_views("applications", side_of_plans("a", ADDON_COLUMNS), PLANS), ADDON_DIGITS)
register("policies_contact", lambda spark, sf: op.contact_details(view(spark, sf, "applications")),
         with_views("applications", "SELECT * FROM contact", CONTACT))
register("policies_members", lambda spark, sf: op.member_summary(
    view(spark, sf, "policy_members"), op.combined_policies(view(spark, sf, "applications"))),
    with_views(VIEWS, "SELECT * FROM people", PREMIUM), "child_age_average:7")
register("policy_premiums", lambda spark, sf: premiums(spark, sf).withColumns({
    "datetime_created": F.date_format("datetime_created", "yyyy-MM-dd"),
    "app_last_modified": F.date_format("app_last_modified", "yyyy-MM-dd")}),
    with_views(VIEWS, "SELECT * EXCLUDE (over_on, term) REPLACE (strftime(datetime_created, '%Y-%m-%d') AS datetime_created) FROM premium", PREMIUM),
    f"{BASE_DIGITS} {ADDON_DIGITS} child_age_average:7")

def premiums_but_listed(spark, sf):
    """Without the policies of a given list of ids."""
    ids = [r[0] for r in view(spark, sf, "applications").filter("app_pid % 97 = 5").select("app_pid").distinct().collect()]
    return lifetime.policy_premiums(view(spark, sf, "applications"), view(spark, sf, "policy_members"), excluded=ids)


register("policy_premiums_but_listed", lambda spark, sf: premiums_but_listed(spark, sf).withColumns({
    "datetime_created": F.date_format("datetime_created", "yyyy-MM-dd"),
    "app_last_modified": F.date_format("app_last_modified", "yyyy-MM-dd")}),
    with_views(VIEWS, "SELECT * EXCLUDE (over_on, term) REPLACE (strftime(datetime_created, '%Y-%m-%d') AS datetime_created) FROM premium WHERE app_pid % 97 <> 5", PREMIUM),
    f"{BASE_DIGITS} {ADDON_DIGITS} child_age_average:7")

# --- fees --------------------------------------------------------------------------------
FEE_IDS = ["carrier_code", "is_partner", "state_code"]
MONTHS = {f"m_2019_{m:02d}": f"2019-{m:02d}-01" for m in range(1, 7)}
UNPIVOT = "monthly AS (" + " UNION ALL ".join(
    f"SELECT carrier_code, is_partner, state_code, DATE '{day}' AS effective_dt, CAST({c} AS DOUBLE) AS fee_share FROM fee_wide"
    for c, day in MONTHS.items()) + ")"
register("fees_unpivoted", lambda spark, sf: op.unpivot_months(view(spark, sf, "fee_wide"), FEE_IDS, MONTHS),
         with_views("fee_wide", "SELECT * FROM monthly", UNPIVOT), "fee_share:4")
register("fees_periods", lambda spark, sf: lifetime.recurring_fees(view(spark, sf, "fee_wide"), FEE_IDS, MONTHS),
         with_views("fee_wide", """
SELECT carrier_code, is_partner, state_code, effective_dt, CAST(lead(effective_dt) OVER (PARTITION BY carrier_code, is_partner, state_code
  ORDER BY effective_dt) - 1 AS DATE) AS expiration_dt, fee_share
FROM (SELECT *, lag(fee_share) OVER (PARTITION BY carrier_code, is_partner, state_code ORDER BY effective_dt) AS prev FROM monthly)
WHERE prev IS NULL OR fee_share <> prev""", UNPIVOT), "fee_share:4")
register("fees_premium_share", lambda spark, sf: op.single_month_share(
    view(spark, sf, "fee_wide"), ["carrier_code", "state_code"], "m_2019_01", "2019-01-01"), with_views("fee_wide", """
SELECT carrier_code, state_code, DATE '2019-01-01' AS effective_date, CAST(NULL AS DATE) AS expires_date, CAST(m_2019_01 AS DOUBLE) AS fee_share
FROM fee_wide"""), "fee_share:4")

# --- durations ---------------------------------------------------------------------------
ENDED = f"""{PREMIUM},
sold AS (SELECT *, CAST(extract(month FROM datetime_created) AS INT) AS sold_month, CAST(extract(year FROM datetime_created) AS INT) AS sold_year FROM premium),
ended AS (
  SELECT * REPLACE (CASE WHEN plan_type IN ('30x1', '60x1', '90x1') THEN '90x1' ELSE plan_type END AS plan_type, ds AS duration_sold, di AS duration_inforce,
    (CAST(round(di) AS BIGINT) * 20000 + ds) // (2 * ds) / 10000.0 AS inforce_percent)
  FROM (SELECT *, CASE WHEN plan_group = '364+' THEN 364 ELSE duration_sold END AS ds,
      CASE WHEN plan_group = '364+' AND duration_inforce >= 364 THEN 364.0 ELSE duration_inforce END AS di FROM sold)
  WHERE ((plan_group = '364+' AND duration_inforce >= 364) OR status = 'LAPSED') AND is_prepaid = 0 AND product_type IN {HEALTH}
    AND plan_type IN ('180x1', '180x2', '30x1', '60x1', '90x1', '90x2', '90x4', '364x1', '364x2', '364x3'))"""


def ended(spark, sf):
    return op.ended_policies(premiums(spark, sf))


register("durations_ended_policies", lambda spark, sf: ended(spark, sf).select(
    "app_pid", "foreign_pid", "sold_month", "sold_year", "plan_type", "plan_group", "duration_sold", "duration_inforce",
    "inforce_percent"), with_views(VIEWS, """
SELECT app_pid, foreign_pid, sold_month, sold_year, plan_type, plan_group, duration_sold, duration_inforce, inforce_percent FROM ended""", ENDED))
register("durations_group_summary", lambda spark, sf: op.group_summary(
    ended(spark, sf), ["plan_type_order", "plan_group"], ["inforce_percent", "duration_inforce"]), with_views(VIEWS, """
SELECT plan_type_order, plan_group, count(*) AS policies, avg(inforce_percent) AS inforce_percent_mean, stddev_samp(inforce_percent) AS inforce_percent_std,
  avg(duration_inforce) AS duration_inforce_mean, stddev_samp(duration_inforce) AS duration_inforce_std FROM ended GROUP BY 1, 2""", ENDED),
    "inforce_percent_mean:10 inforce_percent_std:10 duration_inforce_mean:8 duration_inforce_std:8")
register("durations_by_age_band", lambda spark, sf: op.group_summary(ended(spark, sf).withColumn(
    "age_est", p.round_to_tens(F.col("primary_age"))), ["plan_type", "age_est"], ["inforce_percent"]), with_views(VIEWS, """
SELECT plan_type, round_even(primary_age / 10, 0) * 10 AS age_est, count(*) AS policies, avg(inforce_percent) AS inforce_percent_mean,
  stddev_samp(inforce_percent) AS inforce_percent_std FROM ended GROUP BY 1, 2""", ENDED), "inforce_percent_mean:10 inforce_percent_std:10")
register("durations_by_state", lambda spark, sf: op.group_summary(ended(spark, sf), ["state"], ["inforce_percent"]), with_views(VIEWS, """
SELECT state, count(*) AS policies, avg(inforce_percent) AS inforce_percent_mean, stddev_samp(inforce_percent) AS inforce_percent_std
FROM ended GROUP BY 1""", ENDED), "inforce_percent_mean:10 inforce_percent_std:10")
register("durations_take_rate", lambda spark, sf: op.share_of_total(
    ended(spark, sf).filter("sold_year = 1997"), ["sold_month"], ["plan_group"]), with_views(VIEWS, """
SELECT sold_month, plan_group, policies, CAST(sum(policies) OVER (PARTITION BY sold_month) AS BIGINT) AS month_total,
  policies / sum(policies) OVER (PARTITION BY sold_month) AS policy_share
FROM (SELECT sold_month, plan_group, count(*) AS policies FROM ended WHERE sold_year = 1997 GROUP BY 1, 2)""", ENDED), "policy_share:9")
DISTRIBUTION = """
SELECT sold_month, plan_group, policies, CAST(sum(policies) OVER (PARTITION BY sold_month) AS BIGINT) AS month_total,
  policies / sum(policies) OVER (PARTITION BY sold_month) AS policy_share
FROM (SELECT sold_month, CASE WHEN duration_sold < 135 THEN '90' WHEN duration_sold <= 264 THEN '180' WHEN duration_sold <= 364 THEN '364'
    ELSE '364+' END AS plan_group, count(*) AS policies FROM sold WHERE sold_year = 1997 AND product_type = 'STM' GROUP BY 1, 2)
WHERE plan_group <> '364+'"""
register("durations_plan_distribution", lambda spark, sf: op.plan_distribution(premiums(spark, sf), 1997),
         with_views(VIEWS, DISTRIBUTION, ENDED), "policy_share:9")
register("durations_plan_pivot", lambda spark, sf: op.pivot_groups(
    op.plan_distribution(premiums(spark, sf), 1997), "sold_month", "plan_group", ["90", "180", "364"], "policy_share").toDF(
        "sold_month", "g90", "g180", "g364"), with_views(VIEWS, f"""
SELECT sold_month, max(CASE WHEN plan_group = '90' THEN policy_share END) AS g90, max(CASE WHEN plan_group = '180' THEN policy_share END) AS g180,
  max(CASE WHEN plan_group = '364' THEN policy_share END) AS g364 FROM ({DISTRIBUTION}) GROUP BY 1""", ENDED), "g90:9 g180:9 g364:9")
register("durations_survival", lambda spark, sf: op.survival_curve(ended(spark, sf).filter("plan_type = '364x1'"), 364), with_views(VIEWS, """
SELECT t.sold_month, CAST(d.day AS INT) AS duration_inforce, t.total,
  (t.total - (SELECT count(*) FROM ended e WHERE plan_type = '364x1' AND e.sold_month = t.sold_month
    AND duration_inforce BETWEEN 1 AND d.day)) / t.total AS percent_active
FROM (SELECT sold_month, count(*) AS total FROM ended WHERE plan_type = '364x1' AND duration_inforce <= 364 GROUP BY 1) t
CROSS JOIN (SELECT unnest(range(1, 365)) AS day) d""", ENDED), "percent_active:9")
LIMITS = {"30": 30, "60": 60, "90": 90, "180": 180, "364": 365, "364+": 365}
register("durations_remaining", lambda spark, sf: op.remaining_counts(ended(spark, sf), LIMITS), with_views(VIEWS, """
SELECT plan_group, duration_inforce, CAST(sum(n) OVER (PARTITION BY plan_group ORDER BY duration_inforce DESC) AS BIGINT) AS active
FROM (SELECT plan_group, duration_inforce, count(*) AS n FROM ended
  WHERE duration_inforce <= CASE plan_group WHEN '30' THEN 30 WHEN '60' THEN 60 WHEN '90' THEN 90 WHEN '180' THEN 180 ELSE 365 END GROUP BY 1, 2)""", ENDED))

MODELLED = f"""{ENDED},
modelled AS (
  SELECT * REPLACE (CASE WHEN plan_group IN ('30', '60', '90') THEN '90' ELSE plan_group END AS plan_group), CAST(children_members > 0 AS INT) AS has_children
  FROM sold WHERE status = 'LAPSED' AND is_prepaid = 0 AND product_type IN {HEALTH} AND plan_group <> '364+' AND duration_inforce <= duration_sold + 1
    AND plan_type IN ('180x1', '180x2', '30x1', '60x1', '90x1', '90x2', '90x4', '364x1'))"""
SCORED = """
SELECT app_pid, foreign_pid, plan_group, CASE plan_group
  WHEN '364' THEN CASE WHEN sold_month IN (7, 8, 9) THEN '364_7_8_9' WHEN sold_month IN (4, 5, 6) THEN '364_4_5_6'
    WHEN sold_month IN (2, 3, 10) THEN '364_2_3_10' ELSE '364_1_11_12' END
  WHEN '180' THEN CASE WHEN sold_month IN (10, 11) THEN '180_10_11' WHEN sold_month IN (8, 9, 12) THEN '180_8_9_12'
    WHEN sold_month IN (2, 1, 7) THEN '180_2_1_7' ELSE '180_3_4_5_6' END
  WHEN '90' THEN CASE WHEN sold_month IN (2, 6, 5) THEN '90_2_6_5' WHEN sold_month IN (1, 8, 7, 3) THEN '90_1_8_7_3' ELSE '90_12_4_10_9_11' END
  END AS month_group, round_even(primary_age / 10, 0) * 10 AS primary_age_est, duration_sold, duration_inforce, duration_sold * CASE plan_group
  WHEN '90' THEN 0.8455 + 0.0008 * primary_age - 0.0189 * has_children + CASE WHEN sold_month IN (1, 3, 7, 8) THEN -0.0109 WHEN sold_month IN (2, 5, 6) THEN -0.0342 ELSE 0 END
  WHEN '180' THEN 0.5645 + 0.0018 * primary_age - 0.0427 * has_children - 0.0849 * has_vision + CASE WHEN sold_month IN (1, 2, 7) THEN 0.1244
    WHEN sold_month IN (3, 4, 5, 6) THEN 0.1635 WHEN sold_month IN (8, 9, 12) THEN 0.0813 ELSE 0 END
  WHEN '364' THEN 0.5258 + 0.0021 * primary_age - 0.0237 * has_children - 0.0514 * has_vision + CASE WHEN sold_month IN (2, 3, 10) THEN -0.0642
    WHEN sold_month IN (4, 5, 6) THEN -0.1189 WHEN sold_month IN (7, 8, 9) THEN -0.1665 ELSE 0 END END AS predicted_duration_inforce
FROM modelled"""
register("durations_scored", lambda spark, sf: lifetime.scored_policies(premiums(spark, sf)).select(
    "app_pid", "foreign_pid", "plan_group", "month_group", "primary_age_est", "duration_sold", "duration_inforce",
    "predicted_duration_inforce", "days_diff", "days_diff_pct"), with_views(VIEWS, f"""
SELECT *, duration_inforce - predicted_duration_inforce AS days_diff,
  CASE WHEN duration_inforce <> 0 THEN abs(duration_inforce - predicted_duration_inforce) / duration_inforce END AS days_diff_pct
FROM ({SCORED})""", MODELLED), "predicted_duration_inforce:7 days_diff:7 days_diff_pct:7")
register("durations_residuals", lambda spark, sf: lifetime.residual_summary(lifetime.scored_policies(premiums(spark, sf))), with_views(VIEWS, f"""
SELECT plan_group, primary_age_est, month_group, avg(duration_inforce) AS duration_inforce, avg(predicted_duration_inforce) AS predicted_duration_inforce,
  avg(duration_inforce - predicted_duration_inforce) AS days_diff,
  avg(CASE WHEN duration_inforce <> 0 THEN abs(duration_inforce - predicted_duration_inforce) / duration_inforce END) AS days_diff_pct
FROM ({SCORED}) GROUP BY 1, 2, 3""", MODELLED), "duration_inforce:8 predicted_duration_inforce:7 days_diff:7 days_diff_pct:7")
register("durations_ols_coefficients", lambda spark, sf: lifetime.duration_coefficients(premiums(spark, sf)))
register("durations_ols_residuals", lambda spark, sf: lifetime.residual_summary(lifetime.duration_predictions(premiums(spark, sf))))
