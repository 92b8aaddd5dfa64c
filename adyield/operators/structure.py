"""Campaign structures from clustered attributes: targeting lists, device systems, payloads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adyield.functions.numeric import wavg
from adyield.operators.ordered import running_total
from adyield.session import checkpointed

# Operating systems a campaign may target per device.
DEVICE_SYSTEMS = {
    "DESK": ["Mac_OS_X", "Linux", "Windows"],
    "PHON": ["iOS", "Android"],
    "TBLT": ["iPadOS", "Android"],
}
TARGETING_FIELDS = {"device": "platform_targeting", "state": "sub_country_targeting", "dma": "dma_country_targeting"}


def weight_threshold(df: DataFrame, weight: str, share: float) -> DataFrame:
    """Smallest weight among the largest ones that make up ``share`` of the total.

    Equal weights are folded first, then one running total goes down the distinct weights.
    """
    groups = checkpointed(df.groupBy(F.col(weight).cast("double").alias("w")).agg(F.count("*").alias("n")).withColumn("down", -F.col("w")))
    totals = running_total(groups, F.col("w") * F.col("n"), "reached", ["down"])
    total = groups.agg(F.sum(F.col("w") * F.col("n"))).scalar()
    # the last row of a group has all of the group but itself before it
    crossing = totals.filter(F.col("reached") - F.col("w") > total * F.lit(share)).agg(F.max("w").alias("w"))
    smallest = groups.agg(F.min("w")).scalar()
    return crossing.select(F.coalesce(F.col("w"), smallest).alias("threshold"))


def campaign_structure(clustered: DataFrame, attributes: Sequence[str], listed: str) -> DataFrame:
    """Sessions, mean revenue per session and the list of ``listed`` values per attributes and cluster."""
    keys = [*attributes, "clust"]
    by_value = clustered.groupBy(*keys, listed).agg(
        F.sum("sessions").alias("sessions"), F.sum(F.col("rps_avg") * F.col("sessions")).alias("rps_sessions"))
    return by_value.groupBy(*keys).agg(
        F.sum("sessions").alias("sessions"), F.try_divide(F.sum("rps_sessions"), F.sum("sessions")).alias("rps_avg"),
        F.sort_array(F.collect_list(listed)).alias(listed))


def _as_text(value: Column) -> Column:
    return F.array(value.cast("string"))


def targeting_lists(structure: DataFrame, attributes: Sequence[str], listed: str, min_share: float = 1 / 3000,
                    min_sessions: int = 100) -> DataFrame:
    """Campaign rows that include their values, and per attributes one that excludes all listed values.

    A structure needs more sessions than both a share of the total and a fixed number.
    """
    total = structure.agg(F.greatest(F.sum("sessions") * F.lit(min_share), F.lit(float(min_sessions)))).scalar()
    included = structure.filter(F.col("sessions") > total).select(
        F.col("sessions").alias("sessions_60d"), F.col("rps_avg").alias("rps_avg_60d"),
        *[F.create_map(F.lit("INCLUDE"), _as_text(F.col(a))).alias(a) for a in attributes],
        F.create_map(F.lit("INCLUDE"), F.col(listed).cast("array<string>")).alias(listed))
    rest = structure.groupBy(*attributes).agg(F.sort_array(F.flatten(F.collect_list(listed))).alias("all_values"))
    excluded = rest.select(
        F.lit(None).cast("long").alias("sessions_60d"), F.lit(None).cast("double").alias("rps_avg_60d"),
        *[F.create_map(F.lit("INCLUDE"), _as_text(F.col(a))).alias(a) for a in attributes],
        F.create_map(F.lit("EXCLUDE"), F.col("all_values").cast("array<string>")).alias(listed))
    return included.unionByName(excluded)


def expand_systems(campaigns: DataFrame, systems: Mapping[str, Sequence[str]] = DEVICE_SYSTEMS) -> DataFrame:
    """One campaign per operating system its device allows."""
    table = F.create_map(*[c for device, names in systems.items()
                           for c in (F.lit(device), F.array(*[F.lit(n) for n in names]))])
    device = F.map_values("device")[0][0]
    return campaigns.select("*", F.explode(F.try_element_at(table, device)).alias("os")).withColumn(
        "operating_system", F.create_map(F.lit("INCLUDE"), F.array("os"))).drop("os").withColumns({
            "created": F.lit(False), "id": F.lit(None).cast("string")})


def targeting_payload(campaigns: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Targeting columns as one JSON object in the ad network's field names."""
    fields = []
    for c in columns:
        if c in TARGETING_FIELDS:
            fields.append(F.struct(F.map_keys(c)[0].alias("type"), F.map_values(c)[0].alias("value")).alias(TARGETING_FIELDS[c]))
        elif c == "operating_system":
            families = F.transform(F.map_values(c)[0], lambda name: F.struct(name.alias("os_family")))
            fields.append(F.struct(F.lit("INCLUDE").alias("type"), families.alias("value")).alias("os_targeting"))
    return campaigns.withColumn("targeting", F.to_json(F.struct(*fields)))


def coverage_check(structure: DataFrame, rows: DataFrame) -> DataFrame:
    """Sessions and mean revenue per session of the structure against its input."""
    mine = structure.agg(F.struct(F.sum("sessions").alias("sessions"), wavg(F.col("rps_avg"), F.col("sessions")).alias("rps")))
    return rows.agg(F.sum("sessions").alias("input_sessions"), wavg(F.col("rps_avg"), F.col("sessions")).alias("input_rps")).withColumn(
        "s", mine.scalar()).select("input_sessions", "input_rps", F.col("s.sessions").alias("campaign_sessions"),
                                   F.col("s.rps").alias("campaign_rps"))
