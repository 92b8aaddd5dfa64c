"""Address blocks from CIDR notation and the advertising target table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adyield.functions.network import inet_aton
from adyield.sources.schemas import GEO_TARGETS

BUCKET = 65536
COUNTRY_TARGET = 2840


def expand_cidr_blocks(blocks: DataFrame) -> DataFrame:
    """One row per first-two-octets bucket a network covers, with its address range inside the bucket."""
    length = F.split_part("network", F.lit("/"), F.lit(2)).cast("int")
    size = F.pow(F.lit(2.0), F.lit(32) - length).cast("long")
    base = inet_aton(F.split_part("network", F.lit("/"), F.lit(1)))
    rows = blocks.withColumn("first_ip", base - F.pmod(base, size)).withColumn("last_ip", F.col("first_ip") + size - 1)
    same_octet = F.shiftright("first_ip", 24) == F.shiftright("last_ip", 24)
    bucket_range = F.when(same_octet, F.sequence(F.shiftright("first_ip", 16), F.shiftright("last_ip", 16))).otherwise(
        F.raise_error(F.concat(F.lit("network spans several first octets: "), F.col("network"))))
    rows = rows.withColumn("bucket", F.explode(bucket_range))
    return rows.select(
        F.concat_ws(".", F.shiftright("bucket", 8).cast("string"), F.pmod("bucket", F.lit(256)).cast("string")).alias("ip_index"),
        F.greatest("first_ip", F.col("bucket") * BUCKET).alias("start_int"),
        F.least("last_ip", F.col("bucket") * BUCKET + (BUCKET - 1)).alias("end_int"), *blocks.columns)


def metro_states(locations: DataFrame) -> DataFrame:
    """States of each metro in alphabetical order, in parentheses."""
    pairs = locations.filter((F.col("country_iso_code") == "US") & (F.col("metro_code") != "")).select(
        F.col("metro_code").cast("int").alias("dma_code"), F.col("subdivision_1_iso_code").alias("state_code")).distinct()
    states = F.array_join(F.sort_array(F.collect_list("state_code")), ",")
    return pairs.groupBy("dma_code").agg(F.concat(F.lit("("), states, F.lit(")")).alias("state_list"))


def geo_targets(names: DataFrame, locations: DataFrame) -> DataFrame:
    """Target rows of the metros plus the row for an unknown location."""
    rows = names.join(metro_states(locations), "dma_code").select(
        F.concat(F.lit("200"), F.col("dma_code").cast("string")).cast("long").alias("location_id"), "name",
        F.concat_ws(", ", "name", "state_list", F.lit("United States")).alias("canonical_name"),
        F.lit(COUNTRY_TARGET).cast("long").alias("parent_id"), F.lit("US").alias("country_code"),
        F.lit("DMA").alias("target_type"), F.lit("Active").alias("status"))
    unknown = names.sparkSession.createDataFrame(
        [(0, "location unknown", None, None, None, None, "Active")], GEO_TARGETS)
    return rows.unionByName(unknown)


def newer_version(targets: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows of a file version later than the newest loaded one; nothing when it is already there."""
    newest = loaded.agg(F.coalesce(F.max("file_version"), F.lit("2000-01-01").cast("date"))).scalar()
    return targets.filter(F.col("file_version") > newest)
