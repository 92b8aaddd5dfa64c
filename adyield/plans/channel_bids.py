"""Daily channel bids: channel, publisher and campaign levels with a discounted overall fallback."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adyield.functions.numeric import day_decay
from adyield.operators.rates import attach_level_sums, stack_levels, threshold_rate

CLICK_THRESHOLD = 60
ROI_TARGET = 1.2
CHANNEL = ["campaign", "pub", "channel"]


def same_day_type(rows: DataFrame, as_of) -> DataFrame:
    """Keep weekends for a run on Sunday or Monday, weekdays Tuesday to Friday, all on Saturday."""
    run_day = dt.date.fromisoformat(str(as_of)).weekday()
    weekend = F.weekday("date") >= 5
    if run_day in (0, 6):
        return rows.filter(weekend)
    return rows.filter(~weekend) if run_day < 5 else rows


def channel_bids(cost: DataFrame, as_of, campaign: str, threshold: float = CLICK_THRESHOLD,
                 roi_target: float = ROI_TARGET, fallback: bool = True) -> DataFrame:
    last_day = cost.agg(F.max("date")).scalar()
    rows = cost.filter(F.contains("campaign", F.lit(campaign))).withColumn("yesterday", last_day)
    clicked = rows.filter((F.col("clicks") > 0) & (F.col("date") == F.col("yesterday"))).select(*CHANNEL).distinct()
    kept = same_day_type(rows, as_of).withColumn("days_back", F.datediff("yesterday", "date"))
    daily = kept.groupBy("days_back", *CHANNEL).agg(*[F.sum(c).alias(c) for c in ("clicks", "rev", "cost")])

    levels = [("pub", ["campaign", "pub"]), ("cmp", ["campaign"])]
    facts = attach_level_sums(daily, ["days_back"], levels, ["clicks", "rev"])
    stacked = stack_levels(facts.join(clicked, CHANNEL, "left_semi"), CHANNEL, ["days_back"], ["pub", "cmp"],
                           day_decay(F.col("days_back") - 1))
    if fallback:
        overall = daily.agg(F.struct(F.sum("clicks").alias("clicks"), (F.sum("rev") / 2).alias("rev"))).scalar()
        last = stacked.select(*CHANNEL).distinct().withColumn("overall", overall).select(
            *CHANNEL, F.lit(0).alias("days_back"), F.lit(3).alias("level"), "overall.clicks", "overall.rev")
        stacked = stacked.unionByName(last)
    rates = threshold_rate(stacked, CHANNEL, [F.col("days_back")], threshold)

    bids = daily.filter(F.col("days_back") == 0).drop("days_back").join(clicked, CHANNEL, "left_semi")
    return bids.join(rates, CHANNEL, "left").withColumns({
        "cpc_y": F.try_divide("cost", "clicks"), "cpc_target": F.col("rpc_est") / F.lit(roi_target),
    }).withColumn("bid_change", F.try_divide("cpc_target", "cpc_y") - 1)
