"""Keyword reporting rows, geo-granular groups and bid performance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adyield.functions.numeric import wavg
from adyield.functions.text import contains_flag, tag_count, tag_states
from adyield.functions.timeparts import eastern_standard_date

SPANS = (1, 3, 7, 14, 30)
PERFORMANCE = ("clicks", "rev", "cost")
CAMPAIGN = ["account_id", "geo", "campaign_id"]
ADGROUP = [*CAMPAIGN, "adgroup_norm"]
GROUP = [*ADGROUP, "keyword_norm"]
GEO_MARK = "Geo-Granular"


def clean_perf(perf: DataFrame) -> DataFrame:
    """Reporting rows with the fields that do not belong to their source set to NULL, local dates,
    and the geo flag with place names replaced by a tag in geo-granular campaigns."""
    is_cost = F.col("data_source_type") == "COST"
    is_revenue = F.col("data_source_type") == "REVENUE"
    rows = perf.withColumns({
        "rev": F.when(~is_cost, F.col("rev")), "max_cpc": F.when(~is_revenue, F.col("max_cpc")),
        "is_cost": is_cost, "is_revenue": is_revenue,
        "date": eastern_standard_date(F.col("date").cast("timestamp_ntz")),
        "geo": contains_flag(F.col("campaign"), GEO_MARK),
    })
    return rows.withColumns({
        f"{c}_norm": F.when(F.col("geo"), tag_states(F.col(c))).otherwise(F.col(c)) for c in ("adgroup", "keyword")})


def attach_entity(df: DataFrame, entity: DataFrame) -> DataFrame:
    """Add the keyword's account and live bid."""
    return df.join(entity.select("keyword_id", "account_id", "latest_max_cpc"), "keyword_id", "left")


def attach_account_names(df: DataFrame, accounts: DataFrame) -> DataFrame:
    return df.join(accounts.select("account_id", "account_name"), "account_id")


def span_performance(rows: DataFrame, as_of, keys: Sequence[str] = ("keyword_id",)) -> DataFrame:
    """Clicks, revenue and cost of the last 1, 3, 7, 14 and 30 days in one pass."""
    today = F.lit(str(as_of)).cast("date")
    sums = [
        F.coalesce(F.sum(F.when(F.col("date") >= F.date_sub(today, n), F.col(c))), F.lit(0.0)).alias(f"{c}_sum_{n}day")
        for n in SPANS for c in PERFORMANCE]
    recent = rows.filter(F.col("date") >= F.date_sub(today, max(SPANS)))
    return recent.groupBy(*keys).agg(*sums)


def latest_attributes(rows: DataFrame, key: str, columns: Sequence[str],
                      order: str = "transaction_date_time") -> DataFrame:
    """Attributes of the key's newest row (ties: the largest attribute values)."""
    return rows.groupBy(key).agg(F.max(F.struct(order, *columns)).alias("newest")).select(
        key, *[F.col(f"newest.{c}").alias(c) for c in columns])


def group_sums(rows: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def share_geo_groups(bids: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Replace the measures of geo-granular keywords by the sums of their normalised group."""
    totals = bids.filter("geo").groupBy(*GROUP).agg(*[F.sum(m).alias(f"{m}_shared") for m in measures])
    joined = bids.join(totals, GROUP, "left")
    return joined.withColumns({
        m: F.when(F.col("geo"), F.col(f"{m}_shared")).otherwise(F.col(m)) for m in measures
    }).drop(*[f"{m}_shared" for m in measures])


def geo_keyword_counts(rows: DataFrame, limit: int = 60) -> DataFrame:
    """Distinct keywords per normalised group and whether an oversized group carries a doubled tag."""
    distinct = rows.na.drop(subset=GROUP).select(*GROUP, "adgroup_id", "keyword_id").distinct()
    counts = distinct.groupBy(*GROUP).agg(F.count("*").alias("cnt"))
    return counts.withColumns({
        "oversized": F.col("cnt") > limit, "tags": tag_count(F.col("keyword_norm"))})


def geo_shares(rows: DataFrame, bids: DataFrame) -> DataFrame:
    """Share of rows, keywords, campaigns and bids that are geo-granular, as one row."""
    flag = F.col("geo").cast("double")
    by_keyword = rows.select("keyword_id", "geo").distinct().agg(F.avg(flag))
    by_campaign = rows.groupBy("campaign").agg(F.max("geo").alias("geo")).na.drop(subset=["campaign"]).agg(F.avg(flag))
    return rows.agg(F.avg(flag).alias("row_share")).withColumns({
        "keyword_share": by_keyword.scalar(), "campaign_share": by_campaign.scalar(),
        "bid_share": bids.agg(F.avg(flag)).scalar()})


def upsample_check(bids: DataFrame, rows: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Relative gap between shared bid sums and the raw sums of the same days, per geo flag."""
    since = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    raw = rows.filter(F.col("date") >= since).groupBy("geo").agg(
        *[F.sum(c).alias(f"{c}_raw") for c in PERFORMANCE])
    shared = bids.groupBy("geo").agg(*[F.sum(c).alias(f"{c}_shared") for c in PERFORMANCE])
    gap = [F.try_divide(F.abs(F.col(f"{c}_shared") - F.col(f"{c}_raw")), F.col(f"{c}_raw")).alias(f"{c}_gap")
           for c in PERFORMANCE]
    return shared.join(raw, "geo").select("geo", *gap)


def daily_kpis(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Daily revenue, cost, clicks, mean bid and return on spend, per account when keys are given."""
    daily = rows.groupBy(*keys, "date").agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("rev", "cost", "clicks")],
        F.avg("max_cpc").alias("max_cpc"))
    return daily.withColumn("roas", F.try_divide("rev", "cost"))


def pivot_daily_kpi(daily: DataFrame, column: str, values: Sequence[str], measure: str) -> DataFrame:
    return daily.groupBy("date").pivot(column, list(values)).agg(F.first(measure))


def reset_bids(rows: DataFrame, resets: DataFrame) -> DataFrame:
    """Mean bid of the week up to an account's reset date, filled from ad group, campaign, account.

    ``rows`` carry account_id; ``resets`` hold (account_id, reset_date).
    """
    scoped = rows.join(resets, "account_id")
    ids = ["account_id", "campaign_id", "adgroup_id"]
    attributes = latest_attributes(scoped.na.drop(subset=[*ids, "keyword_id"]), "keyword_id", ids)
    in_week = (F.col("date") > F.date_sub("reset_date", 7)) & (F.col("date") <= F.col("reset_date"))
    week = scoped.filter(in_week).groupBy("keyword_id").agg(
        F.avg("max_cpc").alias("max_cpc"), F.sum("clicks").alias("clicks"))
    bids = attributes.join(week, "keyword_id", "left")
    out, filled = bids, [F.col("max_cpc")]
    for key in ("adgroup_id", "campaign_id", "account_id"):
        level = bids.groupBy(key).agg(wavg(F.col("max_cpc"), F.col("clicks")).alias(f"{key}_cpc"))
        out = out.join(level, key)
        filled.append(F.col(f"{key}_cpc"))
    return out.select("keyword_id", *ids, "clicks", F.bround(F.coalesce(*filled), 2).alias("max_cpc"))
