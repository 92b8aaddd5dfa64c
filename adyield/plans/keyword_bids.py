"""Daily keyword bids: from reporting rows to a checked bid table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adyield.functions.numeric import bid_clip, day_decay, relative_error
from adyield.operators import keywords as kw
from adyield.operators.rates import attach_level_sums, stack_levels, threshold_rate

CLICK_THRESHOLD = 120
ROI_TARGET = 1.02
MAX_PUSH = 0.2
MAX_CUT = -0.3
CPC_MIN = 0.05
PERF_COLUMNS = [f"{c}_sum_{n}day" for n in kw.SPANS for c in kw.PERFORMANCE]


def keyword_rates(daily: DataFrame, as_of, threshold: float = CLICK_THRESHOLD) -> DataFrame:
    """Estimated revenue per click of each normalised keyword group."""
    time = ["date", "match"]
    levels = [("adg", kw.ADGROUP), ("cmp", kw.CAMPAIGN), ("act", ["account_id"])]
    facts = attach_level_sums(daily, time, levels, ["clicks", "rev"])
    decay = day_decay(F.datediff(F.lit(str(as_of)).cast("date"), F.col("date")))
    stacked = stack_levels(facts, kw.GROUP, time, [name for name, _ in levels], decay)
    return threshold_rate(stacked, kw.GROUP, [F.col("date").desc(), F.col("match").desc()], threshold)


ATTRIBUTES = ["account_num", "match", "campaign_id", "adgroup_id", "campaign", "adgroup", "keyword", "adgroup_norm",
              "keyword_norm", "geo"]


def daily_keywords(rows: DataFrame) -> DataFrame:
    """The one pass over the reporting rows: sums and newest attributes per day and keyword.

    Window sums, attributes and rates are all derived from this much smaller table.
    """
    newest = F.max(F.struct("transaction_date_time", *ATTRIBUTES)).alias("newest")
    return rows.groupBy("date", "match", "keyword_id", "geo", "campaign_id", "adgroup_norm", "keyword_norm").agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in kw.PERFORMANCE], newest)


def bid_candidates(daily: DataFrame, entity: DataFrame, accounts: DataFrame, as_of) -> DataFrame:
    """One row per enabled keyword with its attributes, account switch and window sums."""
    attributes = daily.groupBy("keyword_id").agg(F.max("newest").alias("newest")).select(
        "keyword_id", *[F.col(f"newest.{c}").alias(c) for c in ATTRIBUTES])
    bids = kw.attach_entity(attributes, entity).na.drop(subset=kw.GROUP)
    bids = bids.join(accounts.select(
        "account_id", "click_threshold", "roi_target", "max_push", "max_cut", "cpc_min", "keyword_bidder_enabled",
        "keyword_geo_bidder_enabled"), "account_id", "left").filter(F.col("keyword_bidder_enabled") == "Y")
    bids = bids.join(kw.span_performance(daily, as_of), "keyword_id", "left").na.fill(0.0, subset=PERF_COLUMNS)
    bids = bids.withColumns({f"{c}_raw": F.col(c) for c in PERF_COLUMNS})
    shared = kw.share_geo_groups(bids, PERF_COLUMNS)
    mean_bid = bids.agg(F.avg("latest_max_cpc")).scalar()
    filled = shared.withColumn("latest_max_cpc", F.coalesce(F.col("latest_max_cpc"), mean_bid, F.lit(0.0)))
    return filled.withColumns({c: F.col(f"{c}_sum_7day") for c in kw.PERFORMANCE}).filter(F.col("clicks") > 0)


def keyword_bids(rows: DataFrame, entity: DataFrame, accounts: DataFrame, as_of, roi_target: float = ROI_TARGET,
                 threshold: float = CLICK_THRESHOLD) -> DataFrame:
    """New bids. ``rows`` are cleaned reporting rows (see ``clean_perf``) of the performance window."""
    daily = daily_keywords(rows)
    grouped = kw.group_sums(kw.attach_entity(daily, entity).na.drop(subset=["match", *kw.GROUP]),
                            ["date", "match", *kw.GROUP], kw.PERFORMANCE)
    bids = bid_candidates(daily, entity, accounts, as_of).join(
        keyword_rates(grouped, as_of, threshold), kw.GROUP, "left")
    priced = bids.withColumnRenamed("latest_max_cpc", "max_cpc_old").withColumns({
        "cpc_observed": F.try_divide("cost", "clicks"), "cpc_target": F.col("rpc_est") / F.lit(roi_target)})
    new_bid = bid_clip(F.col("cpc_target"), F.col("max_cpc_old"), F.lit(MAX_CUT), F.lit(MAX_PUSH), F.lit(CPC_MIN))
    return priced.withColumn("max_cpc_new", new_bid).withColumn(
        "bid_change", F.col("max_cpc_new") - F.col("max_cpc_old"))


def _with_roas(bids: DataFrame) -> DataFrame:
    return bids.withColumns({
        f"roas_{n}day": F.when(
            F.abs(f"cost_sum_{n}day_raw") >= 1e-2,
            F.abs(f"rev_sum_{n}day_raw") / (F.abs(f"cost_sum_{n}day_raw") + F.lit(1e-10)))
        for n in kw.SPANS})


def window_summary(bids: DataFrame) -> DataFrame:
    """Sum and mean of clicks, revenue, cost and return on spend per window, one row per window."""
    named = _with_roas(bids)
    parts = []
    for n in kw.SPANS:
        measures = {"clicks": f"clicks_sum_{n}day_raw", "rev": f"rev_sum_{n}day_raw", "cost": f"cost_sum_{n}day_raw",
                    "roas": f"roas_{n}day"}
        aggregates = [f(c).alias(f"w{n}_{m}_{s}") for m, c in measures.items()
                      for s, f in (("sum", F.sum), ("mean", F.avg))]
        parts.extend(aggregates)
    wide = named.agg(*parts)
    rows = [F.struct(F.lit(n).alias("days"), *[
        F.col(f"w{n}_{m}_{s}").alias(f"{m}_{s}") for m in ("clicks", "rev", "cost", "roas") for s in ("sum", "mean")])
        for n in kw.SPANS]
    return wide.select(F.inline(F.array(*rows)))


def top_bids(bids: DataFrame, rows: int = 20) -> DataFrame:
    """The costliest bids of the last week, rounded for reading."""
    columns = {
        "clicks": "clicks_sum_7day_raw", "rev": "rev_sum_7day_raw", "cost": "cost_sum_7day_raw", "roas": "roas_7day",
        "rpc": "rpc_est", "cpc_goal": "cpc_target", "cpc_obs": "cpc_observed", "cpc_old": "max_cpc_old",
        "cpc_new": "max_cpc_new"}
    top = _with_roas(bids).orderBy(F.col("cost_sum_7day_raw").desc(), "keyword_id").limit(rows)
    return top.select("keyword_id", *[F.bround(c, 2).alias(name) for name, c in columns.items()])


def bid_check(bids: DataFrame, roi_target: float = ROI_TARGET, warn_at: float = 0.25) -> DataFrame:
    """Projected totals after the bid change and a PASS / WARN status, as one row."""
    change = F.col("max_cpc_new") / F.greatest("max_cpc_old", F.lit(0.05)) - 1
    cost, rev = F.col("cost_sum_7day_raw"), F.col("rev_sum_7day_raw")
    totals = bids.select(change.alias("change"), cost.alias("cost"), rev.alias("rev")).agg(
        F.sum("cost").alias("cost"), F.sum("rev").alias("rev"),
        F.sum(F.col("cost") * F.col("change")).alias("total_cost_delta_est"),
        F.sum(F.col("rev") * F.col("change")).alias("total_rev_delta_est"))
    out = totals.withColumn("total_roas", F.try_divide("rev", "cost")).withColumn(
        "total_roas_delta_est", F.try_divide(F.col("rev") + F.col("total_rev_delta_est"),
                                             F.col("cost") + F.col("total_cost_delta_est")) - F.col("total_roas"))
    out = out.withColumn("roas_miss", F.lit(roi_target) - F.col("total_roas"))
    out = out.withColumn("roas_miss_delta", F.col("roas_miss") - F.col("total_roas_delta_est"))
    out = out.withColumn("rel_roas_miss_delta", F.try_divide(
        F.abs("roas_miss_delta"), F.least(F.abs("roas_miss"), F.abs("total_roas_delta_est"))))
    warn = (F.col("total_roas") < 1) | (F.col("rel_roas_miss_delta") >= warn_at)
    return out.withColumn("status", F.when(warn, F.lit("WARN")).otherwise(F.lit("PASS")))


def projection_identity(bids: DataFrame) -> DataFrame:
    """Largest gap between scaled totals and totals plus estimated change; zero up to rounding."""
    change = F.col("max_cpc_new") / F.greatest("max_cpc_old", F.lit(0.05)) - 1
    gaps = [F.max(F.abs((change + 1) * F.col(c) - (F.col(c) + F.col(c) * change))).alias(name)
            for name, c in (("cost_gap", "cost_sum_7day_raw"), ("rev_gap", "rev_sum_7day_raw"))]
    return bids.agg(*gaps)


def publish_set(outputs: DataFrame) -> DataFrame:
    """Distinct bids of the day's files; every bid is written per account and in the full file."""
    return outputs.dropDuplicates()


def publish_check(outputs: DataFrame) -> DataFrame:
    """Row counts before and after removing duplicates and whether they halve exactly."""
    keyed = outputs.groupBy(*outputs.columns).agg(F.count("*").alias("copies"))
    return keyed.agg(F.sum("copies").alias("written"), F.count("*").alias("distinct_bids")).withColumn(
        "halves", F.col("distinct_bids") * 2 == F.col("written"))


def jittered_bids(bids: DataFrame, seed: int = 1) -> DataFrame:
    """Test bids: the old bid moved by up to a cent, the same on every run."""
    from adyield.operators.sessions import uniform_draw
    draw = uniform_draw(F.col("keyword_id"), seed)
    return bids.withColumn("max_cpc_test", F.bround(F.col("max_cpc_old") + draw * F.lit(0.02) - F.lit(0.01), 2))


def roas_error(bids: DataFrame) -> DataFrame:
    """Relative error of the estimated against the observed revenue per click."""
    observed = F.try_divide(F.col("rev"), F.col("clicks"))
    return bids.select("keyword_id", "rpc_est", observed.alias("rpc_observed"),
                       relative_error(F.col("rpc_est"), observed).alias("rel_error"))
