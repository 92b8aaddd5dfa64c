"""Scans: date windows and optional predicates stay in the plan, so they reach the files."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adyield.functions.text import blank_to_null
from adyield.sources import schemas


def equals_if(column: Column, value: str | None, ignore_case: bool = True) -> Column:
    """Equality that is absent (always true) when no value is given."""
    if value is None:
        return F.lit(True)
    return F.upper(column) == value.upper() if ignore_case else column == value


def member_if(column: Column, values: str | Iterable[str] | None) -> Column:
    """Case-insensitive equality or membership; absent when no value is given."""
    if values is None or isinstance(values, str):
        return equals_if(column, values)
    return F.upper(column).isin([v.upper() for v in values])


def between_dates(ts: Column, start, end) -> Column:
    """Inclusive date range as a half-open range on the timestamp itself.

    A predicate on the bare column is pushed to the files; one on ``to_date(ts)`` is not. The bounds are text, which takes
    the column's type, with or without a zone.
    """
    past = date.fromisoformat(str(end)[:10]) + timedelta(days=1)
    return (ts >= F.lit(str(start))) & (ts < F.lit(str(past)))


def scan_sessions(sessions: DataFrame, start, end, product: str | None = None,
                  traffic_source=None, ignore_case: bool = True) -> DataFrame:
    """Sessions of an inclusive date range that have an address."""
    kept = sessions.filter(between_dates(F.col("creation_date"), start, end))
    kept = kept.filter(blank_to_null(F.col("ip_address")).isNotNull())
    return kept.filter(equals_if(F.col("product"), product, ignore_case)).filter(
        member_if(F.col("traffic_source"), traffic_source))


def scan_revenue(revenue: DataFrame, start, end, product: str | None = None, traffic_source=None) -> DataFrame:
    kept = revenue.filter(between_dates(F.col("session_creation_date"), start, end))
    return kept.filter(member_if(F.col("traffic_source"), traffic_source)).filter(
        equals_if(F.col("product"), product))


def scan_keyword_perf(perf: DataFrame, as_of, days: int = 84, channel: str = "SEM",
                      traffic_source: str = "BING") -> DataFrame:
    """Keyword reporting rows of the last ``days`` days of one channel and source."""
    return perf.filter(
        (F.col("date") >= F.date_sub(F.lit(str(as_of)).cast("date"), days))
        & (F.col("channel") == channel) & (F.col("traffic_source") == traffic_source)
    ).select(
        "date", "transaction_hour", "transaction_date_time", "data_source_type", "account_num", "campaign_id",
        "adgroup_id", "keyword_id", "campaign", "adgroup", "keyword", F.col("clicks").cast("double").alias("clicks"),
        "cost", "rev", F.col("match_type").alias("match"), "max_cpc",
    )


def scan_lead_scores(landing: DataFrame, start, end) -> DataFrame:
    """JSON score rows of a month range; the year/month predicate prunes partitions."""
    def month_number(day) -> int:
        year, month = str(day)[:7].split("-")
        return int(year) * 12 + int(month)

    first, last = month_number(start), month_number(end)
    in_range = F.lit(False)
    for year in range((first - 1) // 12, (last - 1) // 12 + 1):
        low, high = max(first - year * 12, 1), min(last - year * 12, 12)
        in_range = in_range | ((F.col("year") == year) & F.col("month").between(low, high))
    return landing.filter(in_range)


def read_csv(spark: SparkSession, path, schema: str) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True)


def read_dated_outputs(spark: SparkSession, prefix: str, calc_date, schema: str) -> DataFrame:
    """All output files below a prefix whose name ends in the calculation date."""
    return (spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", f"*{calc_date}.csv").csv(prefix))


def load_geo_blocks(spark: SparkSession, csv_path: str, target: str) -> DataFrame:
    """Expanded block file to a parquet table sorted for min/max skipping on the address range."""
    blocks = read_csv(spark, csv_path, schemas.GEO_BLOCKS)
    blocks.repartitionByRange("ip_index", "start_int").sortWithinPartitions("ip_index", "start_int") \
        .write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def load_geo_locations(spark: SparkSession, csv_path: str, target: str) -> DataFrame:
    read_csv(spark, csv_path, schemas.GEO_LOCATIONS).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def enable_accounts(accounts: DataFrame, numbers: Iterable[str]) -> DataFrame:
    """Account table with both bidder flags forced on for the listed account numbers."""
    listed = F.col("account_number").isin(list(numbers))
    flags = ("keyword_bidder_enabled", "keyword_geo_bidder_enabled")
    return accounts.withColumns({c: F.when(listed, F.lit("Y")).otherwise(F.col(c)) for c in flags})


def table_head(df: DataFrame, path: str, rows: int = 1000) -> None:
    """Dump the first rows of a table for a look at it."""
    df.limit(rows).write.mode("overwrite").option("header", True).csv(path)
