"""Policy tables: lapses, base and add-on roll-ups, members, fees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adyield.functions import policy as p
from adyield.functions.text import clean_zip, hashed_contact
from adyield.operators.joins import join_spreading_hot_keys


def first_known(value: Column, order: Column) -> Column:
    """First non-null value in order, as an aggregate; rows without an order value come last."""
    entry = F.struct(order.isNull().alias("late"), order.alias("at"), value.alias("value"))
    return F.min(F.when(value.isNotNull(), entry))["value"]


def last_known(value: Column, order: Column) -> Column:
    entry = F.struct(order.alias("at"), value.alias("value"))
    return F.max(F.when(value.isNotNull(), entry))["value"]


def _is_bad() -> Column:
    return F.coalesce(F.col("status").isin("FAKE", "VOID"), F.lit(False)) | F.coalesce(F.col("agency_id").ilike("%test%"), F.lit(False))


def excluded_policies(applications: DataFrame) -> DataFrame:
    """Ids of fake, void and test policies."""
    return applications.filter(_is_bad() & F.col("app_pid").isNotNull()).select("app_pid").distinct()


def policy_facts(applications: DataFrame) -> DataFrame:
    """Everything known per policy id, from one pass: validity, health defaults, lapses, row count.

    A row without a product counts as health where the policy has a health row, which is what the
    default product makes of it.
    """
    product = F.upper("product_type")
    health, addon, blank = product.isin(*p.HEALTH), product.isin(*p.ADDONS), F.col("product_type").isNull()
    ended = F.coalesce("termination_date", "date_cancelled").isNotNull()
    end = F.least("termination_date", "date_cancelled")
    earliest = [F.min(F.when(ended & rows, value)).alias(f"{name}_{what}")
                for name, rows in (("known", health), ("blank", blank), ("addon", addon))
                for what, value in (("start", F.col("effective_date")), ("end", end))]
    by_start = F.col("effective_date")
    facts = applications.filter(F.col("app_pid").isNotNull()).groupBy("app_pid").agg(
        F.count("*").alias("policy_rows"), F.max(_is_bad()).alias("bad"),
        first_known(F.when(health, F.col("product_type")), by_start).alias("product_type_base"),
        first_known(F.when(health, F.col("premium_amount")), by_start).alias("premium_amount_base"), *earliest)
    has_health = F.col("product_type_base").isNotNull()
    return facts.filter(~F.col("bad")).select(
        "app_pid", "policy_rows", "product_type_base", "premium_amount_base",
        *[F.when(has_health, F.least(f"known_{a}", f"blank_{a}")).alias(b)
          for a, b in (("start", "health_min_effective_date"), ("end", "health_lapse_date"))],
        F.col("addon_start").alias("addon_min_effective_date"), F.col("addon_end").alias("addon_lapse_date"))


def clean_applications(applications: DataFrame) -> DataFrame:
    """Rows of valid policies with product, premium and coverage filled in and the policy's lapses."""
    rows = applications.filter(F.col("app_pid").isNotNull())
    kept = join_spreading_hot_keys(rows, policy_facts(applications), "app_pid", "policy_rows")
    return kept.withColumns({
        "product_fixed": F.upper(F.coalesce("product_type", "product_type_base")),
        "coverage_duration": p.coverage_days(F.col("effective_date"), F.col("expiration_date")),
        "premium_fixed": F.coalesce("premium_amount", "premium_amount_base"),
    }).filter(F.col("product_fixed").isNotNull()).drop("product_type_base", "premium_amount_base", "policy_rows")


def lapse_dates(applications: DataFrame) -> DataFrame:
    """Earliest start and end of ended health and add-on rows per policy."""
    return policy_facts(applications).select(
        "app_pid", "health_min_effective_date", "health_lapse_date", "addon_min_effective_date", "addon_lapse_date")


def as_of_date(applications: DataFrame) -> Column:
    """Newest creation date, as a one-value subquery."""
    return applications.agg(F.max(F.to_date("datetime_created"))).scalar()


def fixed_applications(applications: DataFrame) -> DataFrame:
    """Cleaned rows with days in force and monthly premium."""
    rows = clean_applications(applications).withColumn("asof_date", as_of_date(applications))
    prepaid = p.is_prepaid(F.col("payment_frequency"))
    return rows.withColumns({
        "foreign_pid": F.coalesce("foreign_pid", F.col("app_pid").cast("string")),
        "health_duration_inforce": p.health_days_in_force(
            F.col("effective_date"), F.col("expiration_date"), F.col("health_lapse_date"), prepaid, F.col("asof_date")),
        "addon_duration_inforce": p.addon_days_in_force(
            F.col("effective_date"), F.col("addon_lapse_date"), F.col("asof_date")),
        "is_prepaid": prepaid.cast("int"),
        "premium_amount": p.monthly_premium(F.col("premium_fixed"), F.col("coverage_duration"), prepaid),
    })


def _is_health() -> Column:
    return F.col("product_fixed").isin(*p.HEALTH)


def _is_addon() -> Column:
    return F.col("product_fixed").isin(*p.ADDONS) & F.col("premium_amount").isNotNull()


def _shared_aggregates(rows: Column, lapse: str) -> dict[str, Column]:
    def of(name: str) -> Column:
        return F.when(rows, F.col(name))

    return {"carrier_id": F.min(of("carrier_id")), "product_type": F.min(of("product_fixed")),
            "datetime_created": F.min(of("datetime_created")), "datetime_modified": F.max(of("datetime_modified")),
            "effective_date": F.min(of("effective_date")), "termination_date": F.min(of(lapse)),
            "is_prepaid": F.max(of("is_prepaid"))}


def _base_aggregates(rows: Column) -> dict[str, Column]:
    """Health columns of a policy, over the rows where ``rows`` holds."""
    days = F.when(rows, F.col("coverage_duration"))

    def weighted(name: str) -> Column:
        return F.try_divide(F.sum(F.col(name) * days), F.sum(days))

    def zero_to_null(c: Column) -> Column:
        return F.nullif(c, F.lit(0.0))

    return _shared_aggregates(rows, "health_lapse_date") | {
        "expiration_date": F.max(F.when(rows, F.col("expiration_date"))), "duration_sold": F.sum(days),
        "duration_inforce": F.sum(F.when(rows, F.col("health_duration_inforce"))),
        "sequence_max": F.count(F.nullif(days, F.lit(0))), "premium_health": weighted("premium_amount"),
        "billing_fee_health": zero_to_null(weighted("billing_fee")),
        "association_fee_health": zero_to_null(weighted("association_fee")),
        "admin_fee_health": zero_to_null(weighted("admin_fee")),
        "enrollment_fee_health": zero_to_null(F.max(F.when(rows, F.col("application_fee")))),
        "premium_rider": zero_to_null(weighted("extras_amount"))}


def _addon_aggregates(rows: Column) -> dict[str, Column]:
    """Add-on columns of a policy, over the rows where ``rows`` holds."""
    names = {"dental": "DENTAL", "vision": "VISION", "supp": "SUPPLEMENTAL"}

    def only(product: str, value: Column) -> Column:
        return F.when(rows & (F.col("product_fixed") == product), value)

    return _shared_aggregates(rows, "addon_lapse_date") | {
        "duration_inforce": F.avg(F.when(rows, F.nullif("addon_duration_inforce", F.lit(0)))),
        **{f"has_{k}": F.max(F.when(rows, (F.col("product_fixed") == v).cast("int"))) for k, v in names.items()},
        **{f"premium_{k}": F.sum(only(v, F.col("premium_amount"))) for k, v in names.items()},
        "association_fee_dental": F.sum(only("DENTAL", F.nullif("association_fee", F.lit(0.0)))),
        "enrollment_fee_dental": F.sum(only("DENTAL", F.nullif("application_fee", F.lit(0.0)))),
        "admin_fee_dental": F.sum(only("DENTAL", F.col("admin_fee"))),
        "admin_fee_vision": F.sum(only("VISION", F.col("admin_fee")))}


def base_policies(fixed: DataFrame) -> DataFrame:
    """Health rows folded to one row per policy and outside id."""
    return fixed.filter(_is_health()).groupBy("app_pid", "foreign_pid").agg(
        *[c.alias(n) for n, c in _base_aggregates(F.lit(True)).items()])


def addon_policies(fixed: DataFrame) -> DataFrame:
    """Add-on rows folded to one row per policy and outside id."""
    return fixed.filter(_is_addon()).groupBy("app_pid", "foreign_pid").agg(
        *[c.alias(n) for n, c in _addon_aggregates(F.lit(True)).items()])


def contact_details(applications: DataFrame) -> DataFrame:
    """First or last known contact fields per policy; rows without an agency or of test agencies do not count."""
    rows = applications.filter(~F.col("agency_id").ilike("%test%"))
    made = F.col("datetime_created")
    first = {"session_id": F.col("session_id"), "user_id": F.col("session_user_id"), "email_md5": F.col("email")}
    last = {"phone_md5": F.col("phone_primary"), "agent_id": F.col("agent_id"), "agency_id": F.col("agency_id"),
            "zip": clean_zip(F.col("zip")), "city": F.col("city"), "state": F.col("state")}
    known = rows.groupBy("app_pid").agg(
        *[first_known(c, made).alias(n) for n, c in first.items()], *[last_known(c, made).alias(n) for n, c in last.items()])
    return known.withColumns({n: hashed_contact(F.col(n)) for n in ("email_md5", "phone_md5")})


def combined_policies(applications: DataFrame) -> DataFrame:
    """Base policies and add-ons side by side with contact details.

    Both roll-ups have the same keys and the same input, so their full join is one aggregate with
    conditional columns: the rows are read and shuffled once.
    """
    health, addon = _is_health(), _is_addon()
    both = fixed_applications(applications).filter(health | addon).groupBy("app_pid", "foreign_pid").agg(
        *[c.alias(f"s_{n}") for n, c in _base_aggregates(health).items()],
        *[c.alias(f"a_{n}") for n, c in _addon_aggregates(addon).items()])
    stand_alone = F.when(F.col("a_has_dental") == 1, "DENTAL - SA").when(F.col("a_has_supp") == 1, "SUPPLEMENTAL - SA")
    is_base = F.col("s_product_type").isNotNull()

    def base(*names: str) -> list[Column]:
        return [F.col(f"s_{n}").alias(n) for n in names]

    def added(*names: str) -> list[Column]:
        return [F.col(f"a_{n}").alias(n) for n in names]

    def either(*names: str) -> list[Column]:
        return [F.coalesce(f"s_{n}", f"a_{n}").alias(n) for n in names]

    joined = both.select(
        "app_pid", "foreign_pid", *either("datetime_created", "carrier_id"),
        F.coalesce("s_product_type", stand_alone).alias("product_type"),
        *[F.coalesce(f"a_{n}", F.lit(0)).alias(n) for n in ("has_dental", "has_vision", "has_supp")],
        *either("effective_date", "termination_date"), *base("expiration_date", "duration_sold"),
        F.coalesce(F.col("s_duration_inforce").cast("double"), "a_duration_inforce").alias("duration_inforce"),
        *either("is_prepaid"), F.when(is_base, F.col("s_sequence_max")).alias("sequence_max"),
        *base("premium_health", "premium_rider"), *added("premium_dental", "premium_vision", "premium_supp"),
        *base("billing_fee_health", "association_fee_health"), *added("association_fee_dental"), *base("admin_fee_health"),
        *added("admin_fee_dental", "admin_fee_vision"), *base("enrollment_fee_health"), *added("enrollment_fee_dental"),
        F.least("s_datetime_modified", "a_datetime_modified").alias("datetime_modified"))
    return joined.join(contact_details(applications), "app_pid", "left")


def member_summary(members: DataFrame, policies: DataFrame) -> DataFrame:
    """Member counts and ages per policy at its effective date."""
    rows = members.join(policies.select("app_pid", "effective_date"), "app_pid").select(
        "app_pid", p.member_role(F.col("relationship"), F.col("effective_date"), F.col("dob")).alias("role"),
        p.age_at(F.col("effective_date"), F.col("dob")).alias("age"))

    def of(role: str, value: Column) -> Column:
        return F.when(F.col("role") == role, value)

    one, age = F.lit(1), F.col("age")
    return rows.groupBy("app_pid").agg(
        F.count("*").alias("plan_members"), F.count(of("spouse", one)).alias("spousal_members"),
        F.count(of("child", one)).alias("children_members"), F.max(of("primary", age)).alias("primary_age"),
        F.max(of("spouse", age)).alias("spouse_age"), F.min(of("child", age)).alias("child_age_youngest"),
        F.max(of("child", age)).alias("child_age_oldest"), F.avg(of("child", age)).alias("child_age_average"))


# --- fee assumptions ---------------------------------------------------------------------

def unpivot_months(wide: DataFrame, ids: Sequence[str], months: dict[str, str]) -> DataFrame:
    """Month columns to rows; ``months`` maps a column to its first day."""
    pairs = [F.struct(F.lit(day).cast("date").alias("effective_dt"), F.col(c).cast("double").alias("fee_share"))
             for c, day in months.items()]
    return wide.select(*ids, F.inline(F.array(*pairs)))


def fee_periods(monthly: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Months where the fee changed, each valid until the day before the next change."""
    order = Window.partitionBy(*ids).orderBy("effective_dt")
    previous = F.lag("fee_share").over(order)
    changed = monthly.withColumn("previous", previous).filter(
        F.col("previous").isNull() | F.col("fee_share").isNull() | (F.col("fee_share") != F.col("previous")))
    return changed.select(*ids, "effective_dt", F.date_sub(F.lead("effective_dt").over(order), 1).alias("expiration_dt"),
                          "fee_share")


def single_month_share(wide: DataFrame, ids: Sequence[str], column: str, day: str) -> DataFrame:
    return wide.select(*ids, F.lit(day).cast("date").alias("effective_date"),
                       F.lit(None).cast("date").alias("expires_date"), F.col(column).cast("double").alias("fee_share"))


# --- durations ---------------------------------------------------------------------------

def sold_columns(policies: DataFrame) -> DataFrame:
    sold = F.to_date("datetime_created")
    return policies.withColumns({"sold_date": sold, "sold_month": F.month(sold), "sold_year": F.year(sold)})


def ended_policies(policies: DataFrame) -> DataFrame:
    """Policies that ended or ran a full year, durations capped at 364 days beyond a year."""
    plans = ["180x1", "180x2", "30x1", "60x1", "90x1", "90x2", "90x4", "364x1", "364x2", "364x3"]
    beyond = F.col("plan_group") == "364+"
    full_year = beyond & (F.col("duration_inforce") >= 364)
    kept = sold_columns(policies).filter(
        (full_year | (F.col("status") == "LAPSED")) & (F.col("is_prepaid") == 0)
        & F.col("product_type").isin(*p.HEALTH) & F.col("plan_type").isin(plans))
    rows = kept.withColumns({
        "plan_type": p.merged_plan_type(F.col("plan_type")),
        "duration_inforce": F.when(full_year, F.lit(364.0)).otherwise(F.col("duration_inforce")),
        "duration_sold": F.when(beyond, F.lit(364)).otherwise(F.col("duration_sold"))})
    return rows.withColumn("inforce_percent", p.share_in_force(F.col("duration_inforce"), F.col("duration_sold")))


def modelled_policies(policies: DataFrame) -> DataFrame:
    """Lapsed policies of at most a year, with month groups, for the duration models."""
    plans = ["180x1", "180x2", "30x1", "60x1", "90x1", "90x2", "90x4", "364x1"]
    kept = sold_columns(policies).filter(
        (F.col("status") == "LAPSED") & (F.col("is_prepaid") == 0) & F.col("product_type").isin(*p.HEALTH)
        & F.col("plan_type").isin(plans) & (F.col("plan_group") != "364+")
        & (F.col("duration_inforce") <= F.col("duration_sold") + 1))
    return kept.withColumns({
        "plan_type": p.merged_plan_type(F.col("plan_type")), "plan_group": p.merged_plan_group(F.col("plan_group")),
        "has_children": (F.col("children_members") > 0).cast("int"),
    }).withColumn("month_group", p.month_group(F.col("plan_group"), F.col("sold_month")))


def group_summary(rows: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Mean, sample deviation and row count per group."""
    stats = [f(m).alias(f"{m}_{n}") for m in measures for n, f in (("mean", F.avg), ("std", F.stddev))]
    return rows.groupBy(*keys).agg(F.count("*").alias("policies"), *stats)


def share_of_total(rows: DataFrame, within: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Row count per group and its share of the total within ``within``."""
    counts = rows.groupBy(*within, *by).agg(F.count("*").alias("policies"))
    totals = counts.groupBy(*within).agg(F.sum("policies").alias("month_total"))
    return counts.join(totals, list(within)).withColumn("policy_share", F.col("policies") / F.col("month_total"))


def plan_distribution(policies: DataFrame, year: int) -> DataFrame:
    """Policies and share per sale month and duration group of one year's short-term plans."""
    days = F.col("duration_sold")
    group = (F.when(days < 135, "90").when(days.between(135, 264), "180").when(days.between(265, 364), "364")
             .when(days > 364, "364+"))
    rows = sold_columns(policies).filter((F.col("sold_year") == year) & (F.col("product_type") == "STM")).withColumn(
        "plan_group", group).filter(F.col("plan_group").isin("90", "180", "364"))
    return share_of_total(rows, ["sold_month"], ["plan_group"])


def pivot_groups(rows: DataFrame, key: str, column: str, values: Sequence[str], measure: str) -> DataFrame:
    return rows.groupBy(key).pivot(column, list(values)).agg(F.avg(measure))


def survival_curve(rows: DataFrame, max_days: int) -> DataFrame:
    """Share of policies still active per sale month and day, on a gap-free day axis."""
    kept = rows.filter(F.col("duration_inforce") <= max_days)
    counts = kept.groupBy("sold_month", F.col("duration_inforce").cast("int").alias("day")).agg(F.count("*").alias("lapsed"))
    totals = counts.groupBy("sold_month").agg(F.sum("lapsed").alias("total"))
    axis = totals.withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(max_days))))
    running = Window.partitionBy("sold_month").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    filled = axis.join(counts, ["sold_month", "day"], "left").withColumn(
        "ended", F.sum(F.coalesce("lapsed", F.lit(0).cast("long"))).over(running))
    return filled.select("sold_month", F.col("day").alias("duration_inforce"), "total",
                         ((F.col("total") - F.col("ended")) / F.col("total")).alias("percent_active"))


def remaining_counts(rows: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Policies that lasted at least so many days, per plan group up to its day limit."""
    cap = F.create_map(*[F.lit(v) for item in limits.items() for v in item])
    kept = rows.filter(F.col("duration_inforce") <= F.try_element_at(cap, F.col("plan_group")))
    counts = kept.groupBy("plan_group", "duration_inforce").agg(F.count("*").alias("ended"))
    order = Window.partitionBy("plan_group").orderBy(F.col("duration_inforce").desc())
    return counts.select("plan_group", "duration_inforce", F.sum("ended").over(order).alias("active"))
