"""Policy lifetime tables: the policy-level premium table, fee assumptions and duration models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adyield.functions import policy as p
from adyield.operators import policies as op
from adyield.session import checkpointed

# Inputs of the duration model per plan group.
MODEL_INPUTS = {
    "90": ["primary_age", "has_children", "month_group_90_1_8_7_3", "month_group_90_2_6_5"],
    "180": ["has_vision", "primary_age", "has_children", "month_group_180_2_1_7", "month_group_180_3_4_5_6",
            "month_group_180_8_9_12"],
    "364": ["has_vision", "primary_age", "has_children", "month_group_364_2_3_10", "month_group_364_4_5_6",
            "month_group_364_7_8_9"],
}


def policy_premiums(applications: DataFrame, members: DataFrame, excluded: Sequence[int] = ()) -> DataFrame:
    """One row per policy and outside id: status, plan labels, premiums, fees, members, contacts."""
    combined = op.combined_policies(applications)
    people = op.member_summary(members, combined)
    rows = combined.join(people, "app_pid", "left").withColumn("asof_date", op.as_of_date(applications))
    if excluded:
        rows = rows.filter(~F.col("app_pid").isin(list(excluded)))
    end = F.coalesce("termination_date", "expiration_date")
    sold, terms = F.col("duration_sold"), F.col("sequence_max")
    return rows.withColumns({
        "status": p.policy_status(F.col("effective_date"), end, F.col("asof_date")),
        "plan_group": p.plan_group(sold), "plan_type": p.plan_type(sold, terms),
        "plan_type_order": p.plan_type_order(sold, terms),
        "inforce_percent": p.share_in_force(F.col("duration_inforce"), sold),
        "plan_members": F.coalesce("plan_members", F.lit(1).cast("long")),
        "spousal_members": F.coalesce("spousal_members", F.lit(0).cast("long")),
        "children_members": F.coalesce("children_members", F.lit(0).cast("long")),
    }).withColumnRenamed("datetime_modified", "app_last_modified")


def recurring_fees(wide: DataFrame, ids: Sequence[str], months: dict[str, str]) -> DataFrame:
    return op.fee_periods(op.unpivot_months(wide, ids, months), ids)


def model_rows(policies: DataFrame) -> DataFrame:
    """The modelled policies, written out once because every fit reads them several times."""
    return checkpointed(op.modelled_policies(policies).select(
        "app_pid", "foreign_pid", "plan_group", "month_group", "primary_age", "has_children", "has_dental", "has_vision",
        "duration_sold", "duration_inforce", "inforce_percent"))


def model_frame(modelled: DataFrame, group: str) -> DataFrame:
    """Complete rows of one plan group with 0/1 month-group columns (one group left out)."""
    flags = [c for c in MODEL_INPUTS[group] if c.startswith("month_group_")]
    rows = modelled.filter(F.col("plan_group") == group)
    rows = rows.withColumns({
        c: (F.col("month_group") == c.removeprefix("month_group_")).cast("double") for c in flags})
    return rows.na.drop(subset=["inforce_percent", "has_dental", "has_vision", "primary_age", "has_children"])


def fit_duration(modelled: DataFrame, group: str):
    """Ordinary least squares of the share in force; returns (model, scored rows)."""
    inputs = MODEL_INPUTS[group]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    frame = assembler.transform(model_frame(modelled, group))
    model = LinearRegression(featuresCol="features", labelCol="inforce_percent", solver="normal", regParam=0.0).fit(frame)
    return model, model.transform(frame)


def duration_coefficients(policies: DataFrame) -> DataFrame:
    """Coefficient table of the three models (one small row per input)."""
    spark = policies.sparkSession
    modelled = model_rows(policies)
    rows = []
    for group, inputs in MODEL_INPUTS.items():
        model, _ = fit_duration(modelled, group)
        rows += [(group, name, float(value)) for name, value in zip(inputs, model.coefficients)]
        rows.append((group, "intercept", float(model.intercept)))
    return spark.createDataFrame(rows, "plan_group string, input string, coefficient double")


def duration_predictions(policies: DataFrame) -> DataFrame:
    """Policies of all three models with predicted days in force and residuals."""
    modelled = model_rows(policies)
    scored = None
    for group in MODEL_INPUTS:
        _, part = fit_duration(modelled, group)
        part = part.select("app_pid", "foreign_pid", "plan_group", "month_group", "primary_age", "duration_sold",
                           "duration_inforce", "inforce_percent", "prediction")
        scored = part if scored is None else scored.unionByName(part)
    return with_residuals(scored.withColumn("predicted_duration_inforce", F.col("prediction") * F.col("duration_sold")))


def with_residuals(scored: DataFrame) -> DataFrame:
    diff = F.col("duration_inforce") - F.col("predicted_duration_inforce")
    return scored.withColumns({
        "primary_age_est": p.round_to_tens(F.col("primary_age")), "days_diff": diff,
        "days_diff_pct": F.try_divide(F.abs(diff), F.col("duration_inforce"))})


def residual_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("plan_group", "primary_age_est", "month_group").agg(*[
        F.avg(c).alias(c) for c in ("duration_inforce", "predicted_duration_inforce", "days_diff", "days_diff_pct")])


def scored_policies(policies: DataFrame) -> DataFrame:
    """Modelled policies scored with the published coefficients instead of a fresh fit."""
    rows = op.modelled_policies(policies)
    share = p.predict_duration_percent(
        F.col("plan_group").try_cast("int"), F.col("primary_age"), F.col("sold_month"), F.col("has_vision") == 1,
        F.col("has_children") == 1)
    return with_residuals(rows.withColumn("prediction", share).withColumn(
        "predicted_duration_inforce", F.col("prediction") * F.col("duration_sold")))
