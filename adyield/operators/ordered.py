"""Running totals over one global order, without a one-task window.

Rows are range-partitioned on the full order (ties broken by a unique key), written out once so that
the partition numbers stay fixed, and numbered inside their partition; only one total per partition
and key goes through the small ordered window that turns totals into offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adyield.functions.timeparts import quarter_hour
from adyield.session import checkpointed


def ranged(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    count = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return checkpointed(df.repartitionByRange(count, *keys, *order).withColumn("part_no", F.spark_partition_id()))


def _with_offsets(local: DataFrame, totals: DataFrame, keys: Sequence[str], offsets: dict[str, Column]) -> DataFrame:
    carried = totals.select("part_no", *keys, *[c.alias(n) for n, c in offsets.items()])
    on = local["part_no"] == carried["part_no"]
    for key in keys:
        on = on & local[key].eqNullSafe(carried[key])
    return local.join(carried, on).drop(carried["part_no"], *[carried[key] for key in keys])


def running_total(df: DataFrame, value: Column, name: str, order: Sequence[str], keys: Sequence[str] = (),
                  parts: int | None = None) -> DataFrame:
    """Add the sum of ``value`` over all rows up to and including the current one."""
    rows = ranged(df.withColumn("step", value), order, keys, parts)
    before = Window.partitionBy(*keys).orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part_no", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy("part_no", *keys).agg(F.sum("step").alias("part_total"))
    joined = _with_offsets(rows, totals, keys, {"carried": F.coalesce(F.sum("part_total").over(before), F.lit(0))})
    return joined.withColumn(name, F.col("carried") + F.sum("step").over(inside)).drop("step", "carried", "part_no")


def bag_sessions(sessions: DataFrame, parts: int | None = None) -> DataFrame:
    """Running number of conversions: a bag starts at a conversion and lasts until the next one."""
    rows = sessions.select("session_id", "creation_date", "revenue_units")
    converted = (F.col("revenue_units") > 0).cast("long")
    return running_total(rows, converted, "bag_id", ["creation_date", "session_id"], parts=parts)


def bag_step(sessions: DataFrame, state: DataFrame | None = None, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Carry bags on by the sessions after those seen so far: what the bags that closed add to their slots, and the new state.

    The state is the bag still open, as its (bag, slot) totals: sessions, conversions and revenue units. A bag's figures are known
    when the next one begins, so earlier sessions are never read or sorted again.
    """
    converted = (F.col("revenue_units") > 0).cast("long")
    pieces = bag_sessions(sessions, parts).groupBy(
        "bag_id", F.to_date("creation_date").alias("date"), quarter_hour(F.col("creation_date")).alias("hour")).agg(
        F.count("*").alias("n"), F.sum(converted).alias("leads"), F.sum("revenue_units").alias("units"))
    if state is not None:
        seen = F.coalesce(state.agg(F.max("bag_id")).scalar(), F.lit(0).cast("long"))
        pieces = pieces.withColumn("bag_id", F.col("bag_id") + seen).union(state.select(pieces.columns)) \
            .groupBy("bag_id", "date", "hour").agg(*[F.sum(c).alias(c) for c in ("n", "leads", "units")])
    pieces = checkpointed(pieces)
    last = pieces.agg(F.max("bag_id")).scalar()
    return _slot_sums(pieces.filter(F.col("bag_id") < last)), pieces.filter(F.col("bag_id") == last)


def _slot_sums(pieces: DataFrame) -> DataFrame:
    """What bags add to their slots. Bag figures are combined from (bag, slot) totals: a long bag is never gathered row by row."""
    bags = pieces.groupBy("bag_id").agg(
        (F.sum("leads") / F.sum("n")).alias("bag_lpc"), (F.sum("units") / F.lit(10000.0) / F.sum("n")).alias("bag_rpc"))
    return pieces.join(bags, "bag_id").groupBy("date", "hour").agg(
        F.sum("n").alias("clicks_num"), F.sum(F.col("n") * F.col("bag_lpc")).alias("leads_num"),
        F.sum(F.col("n") * F.col("bag_rpc")).alias("rev_sum"))


def bag_report(closed: DataFrame, state: DataFrame) -> DataFrame:
    """Slots from the sums of every step (their union) and the bag still open.

    Slots are numbered in one task: there are at most 96 a day.
    """
    sums = [F.sum(c).alias(c) for c in ("clicks_num", "leads_num", "rev_sum")]
    slots = closed.union(_slot_sums(state)).groupBy("date", "hour").agg(*sums)
    indexed = F.row_number().over(Window.orderBy("date", "hour")) - 1
    return slots.withColumns({"rev_avg": F.col("rev_sum") / F.col("clicks_num"), "int_ix": indexed})


def bag_kpis(sessions: DataFrame, parts: int | None = None) -> DataFrame:
    """Per UTC date and quarter hour: sessions and the sums of their bags' lead and revenue rates."""
    return bag_report(*bag_step(sessions, None, parts))


def bag_positions(df: DataFrame, ts: str, revenue: str, tie: str = "session_id", keys: Sequence[str] = (),
                  parts: int | None = None) -> DataFrame:
    """Position of each row since the last conversion before it; rows up to the first conversion go.

    Here a bag ends at its conversion, which alone carries the bag's revenue and conversion rate.
    """
    order = [ts, tie]
    converted = F.coalesce(F.col(revenue) > 0, F.lit(False))
    inside = Window.partitionBy("part_no", *keys).orderBy(*order)
    local = ranged(df.withColumn("has_conversion", converted), order, keys, parts).withColumn(
        "row_in_part", F.row_number().over(inside).cast("long"))
    own_index = F.when(F.col("has_conversion"), F.col("row_in_part"))
    local = local.withColumn("last_in_part", F.max(own_index).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    totals = local.groupBy("part_no", *keys).agg(
        F.count("*").alias("n"), F.max(own_index).alias("last_conversion"))
    before = Window.partitionBy(*keys).orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("rows_before", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")))
    last_before = F.max(F.col("rows_before") + F.col("last_conversion")).over(before)
    joined = _with_offsets(local, totals.withColumn("conversion_before", last_before), keys, {
        "rows_before": F.col("rows_before"), "conversion_before": F.col("conversion_before")})
    previous = F.coalesce(F.col("rows_before") + F.col("last_in_part"), F.col("conversion_before"))
    kept = joined.withColumn("session_no", F.col("rows_before") + F.col("row_in_part") - previous).filter(
        F.col("session_no").isNotNull())
    return kept.withColumns({
        "bag_rps": F.when(F.col("has_conversion"), F.col(revenue) / F.col("session_no")),
        "bag_conversion_rate": F.when(F.col("has_conversion"), F.lit(1.0) / F.col("session_no")),
    }).drop("part_no", "row_in_part", "last_in_part", "rows_before", "conversion_before")


def split_to_intervals(bags: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean bag rates and row count per (weekday, hour, fraction), empty rates filled from the slot before."""
    slot = ["weekday", "hourofday", "hourfraction"]
    grouped = bags.groupBy(*keys, *slot).agg(
        F.avg("bag_rps").alias("bag_rps"), F.avg("bag_conversion_rate").alias("bag_conversion_rate"),
        F.count("session_id").alias("sessions"))
    order = Window.partitionBy(*keys).orderBy(*slot)
    filled = F.last("bag_rps", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return grouped.withColumns({"ix": F.row_number().over(order) - 1, "bag_rps": filled})
