"""Campaign and publisher bids of a native-ads account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adyield.functions.numeric import wavg
from adyield.operators import campaigns as cp
from adyield.operators.tree import TreeClusters, estimate_rps

ROI_TARGET = 0.8
MAX_PUSH = 0.2
MAX_CUT = -0.3


def recent_estimates(estimated: DataFrame, as_of, days: int = 7) -> tuple[DataFrame, DataFrame]:
    """Session-weighted estimate of the last days per campaign and per campaign and publisher.

    Rows without an estimate keep their weight, as a missing value adds nothing to the sum.
    """
    recent = estimated.filter(F.col("utc_dt") > F.date_sub(F.lit(str(as_of)).cast("date"), days)).withColumn(
        "campaign_id", F.col("campaign_id").cast("string"))
    rate = wavg(F.col("rps_est"), F.col("sessions")).alias("rps_est")
    by_campaign = recent.groupBy("campaign_id").agg(rate)
    by_publisher = recent.groupBy("campaign_id", F.col("keyword").alias("publisher")).agg(rate)
    return by_campaign, by_publisher


def _clipped(target, current):
    return F.when(target.isNotNull(), F.least(
        F.greatest(target, current * F.lit(1 + MAX_CUT)), current * F.lit(1 + MAX_PUSH)))


def campaign_cpc(bodies: DataFrame, by_campaign: DataFrame, config: DataFrame, as_of, roi_target: float = ROI_TARGET,
                 clip: bool = False, order: str = "datetime") -> DataFrame:
    """Active campaigns with current and new bid; without an estimate the current bid stays."""
    parsed = cp.parse_bodies(cp.latest_campaigns(bodies, as_of, order)).select(
        F.col("c.id").alias("id"), F.col("c.advertiser_id").alias("account_id"), F.col("c.cpc").cast("double").alias("cpc"),
        F.col("c.publisher_bid_modifier.values").alias("current"))
    active = cp.with_config(parsed, config).withColumnRenamed("id", "campaign_id")
    target = F.col("rps_est") / F.lit(roi_target)
    bid = _clipped(target, F.col("cpc")) if clip else target
    return active.join(by_campaign, "campaign_id", "left").withColumn("cpc_new", F.coalesce(bid, F.col("cpc")))


def publisher_modifiers(campaigns: DataFrame, by_publisher: DataFrame, publishers: DataFrame,
                        roi_target: float = ROI_TARGET, clip: bool = False) -> DataFrame:
    """New modifier (publisher bid over campaign bid) or the current one, for allowed publishers.

    A publisher whose new modifiers are all within 1 % of 1 gets no new one. Only pairs with an
    estimate or a current modifier are formed.
    """
    current = campaigns.select("campaign_id", F.inline("current")).withColumnsRenamed(
        {"target": "publisher", "bid_modification": "current_modifier"})
    pairs = by_publisher.withColumnRenamed("rps_est", "publisher_rps").join(current, ["campaign_id", "publisher"], "full")
    pairs = pairs.join(publishers.select("publisher"), "publisher", "left_semi").join(
        campaigns.select("campaign_id", "cpc", "cpc_new"), "campaign_id")
    target = F.col("publisher_rps") / F.lit(roi_target)
    if clip:
        target = _clipped(target, F.coalesce("current_modifier", F.lit(1.0)) * F.col("cpc"))
    pairs = pairs.withColumn("new_modifier", F.try_divide(target, F.col("cpc_new")))
    off_one = pairs.groupBy("publisher").agg(F.max(F.abs(F.col("new_modifier") - 1)).alias("largest_gap"))
    moved = F.when(F.col("largest_gap") >= 1e-2, F.col("new_modifier"))
    return pairs.join(off_one, "publisher").select(
        "campaign_id", "publisher", F.coalesce(moved, F.col("current_modifier")).alias("modifier"))


def publisher_bids(rows: DataFrame, tree: TreeClusters, bodies: DataFrame, config: DataFrame, publishers: DataFrame,
                   as_of, clip: bool = False, order: str = "datetime") -> DataFrame:
    """Update rows (account, campaign, JSON, date) from daily aggregates and the newest campaigns."""
    by_campaign, by_publisher = recent_estimates(estimate_rps(rows, tree), as_of)
    campaigns = campaign_cpc(bodies, by_campaign, config, as_of, clip=clip, order=order)
    modifiers = publisher_modifiers(campaigns, by_publisher, publishers, clip=clip)
    return cp.update_payloads(campaigns, modifiers).withColumn("date", F.lit(str(as_of)).cast("date"))


def campaign_roas(rows: DataFrame, bodies: DataFrame, as_of, order: str = "datetime") -> DataFrame:
    """Daily revenue, cost (bid times sessions) and return of active campaigns."""
    active = cp.parse_bodies(cp.latest_campaigns(bodies, as_of, order)).select(
        F.col("c.id").alias("campaign_id"), F.col("c.cpc").cast("double").alias("cpc"))
    joined = rows.withColumn("campaign_id", F.col("campaign_id").cast("string")).join(active, "campaign_id")
    daily = joined.groupBy("utc_dt", "campaign_id").agg(
        F.sum("revenue").alias("revenue"), F.sum(F.col("cpc") * F.col("sessions")).alias("cost"))
    return daily.withColumn("roas", F.try_divide("revenue", "cost"))


def unknown_publishers(rows: DataFrame, publishers: DataFrame) -> DataFrame:
    """Publishers seen in sessions but not allowed, allowed but unseen, and both."""
    seen = rows.select(F.col("keyword").alias("publisher")).distinct()
    allowed = publishers.select("publisher").distinct()
    return (seen.subtract(allowed).withColumn("side", F.lit("seen only"))
            .unionByName(allowed.subtract(seen).withColumn("side", F.lit("allowed only")))
            .unionByName(seen.intersect(allowed).withColumn("side", F.lit("both"))))
