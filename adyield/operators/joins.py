"""Joins of sessions to places and revenue."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adyield.functions.network import inet_aton, ip_index, octets_aton, octets_of
from adyield.functions.numeric import money_units
from adyield.session import REPLICATION_SALTS, dealt, fits_broadcast, worked_out


#: Sessions that one part of an ordered join holds on average, and the places that rows of one address are spread over.
PART_ROWS = 250_000
SPREAD = 1 << 20


def replicate(df: DataFrame, salts: int) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def join_spreading_hot_keys(rows: DataFrame, facts: DataFrame, key: str, row_count: str, hot_rows: int = 1_000_000,
                            salts: int = REPLICATION_SALTS) -> DataFrame:
    """Inner join of rows to one-row-per-key facts that know how many rows each key has.

    Keys with more than ``hot_rows`` rows are spread over ``salts`` copies of their fact row. There is
    at most one such key per ``hot_rows`` rows, which bounds the broadcast list of hot keys.
    """
    is_hot = F.col(row_count) > hot_rows
    hot = F.broadcast(facts.filter(is_hot).select(key, F.lit(True).alias("is_hot")))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    place = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    spread = rows.join(hot, key, "left").withColumn("salt", F.when(F.col("is_hot"), place).otherwise(F.lit(0))).drop("is_hot")
    return spread.join(facts.withColumn("salt", F.explode(copies)), [key, "salt"]).drop("salt")


def ip_range_join(sessions: DataFrame, blocks: DataFrame, how: str = "inner", session_key: str = "session_id",
                  salts: int | None = None) -> DataFrame:
    """Join addresses to the block that holds them.

    Blocks that are counted to fit are broadcast, and the equality on the first two octets makes that a hash join with the range
    as residual. Larger tables of blocks that do not overlap are merged in address order (``ip_ordered_join``). Only overlapping
    ones, of which an address may need several, are copied ``salts`` times, with the sessions spread over the copies; ``salts``
    given asks for that.
    """
    if salts is None:
        if fits_broadcast(blocks):
            blocks = F.broadcast(blocks)
            salts = 1
        elif not blocks_overlap(blocks):
            return ip_ordered_join(sessions, blocks, how, session_key)
    salts = salts or REPLICATION_SALTS
    left = sessions.withColumns({
        "s_index": ip_index(F.col("ip_address")), "s_ip": inet_aton(F.col("ip_address"))})
    match = (F.col("s_index") == F.col("ip_index")) & F.col("s_ip").between(F.col("start_int"), F.col("end_int"))
    if salts > 1:
        left = left.withColumn("s_salt", F.pmod(F.xxhash64(session_key, "ip_address"), F.lit(salts)).cast("int"))
        blocks = replicate(blocks, salts)
        match = (F.col("s_salt") == F.col("salt")) & match
    joined = left.join(blocks, match, how)
    return joined.drop("s_index", "s_ip", "ip_index", "start_int", "end_int", "s_salt", "salt")


def _reach(blocks: DataFrame) -> DataFrame:
    """Blocks with the first and last address that they can match: those of their range that begin with their two octets."""
    first = octets_of(F.concat("ip_index", F.lit(".0.0")))
    reach = blocks.select("*", worked_out(first).alias("octets")).select(*blocks.columns, octets_aton(F.col("octets")).alias("reach_first")).withColumns({
        "reach_from": F.greatest("start_int", "reach_first"), "reach_to": F.least(F.col("end_int"), F.col("reach_first") + F.lit(65535))})
    return reach.drop("reach_first").filter("start_int is not null and end_int is not null and reach_from <= reach_to")


def blocks_overlap(blocks: DataFrame) -> bool:
    """Whether some address lies in two blocks."""
    earlier = Window.partitionBy("ip_index").orderBy("reach_from").rowsBetween(Window.unboundedPreceding, -1)
    reach = _reach(dealt(blocks.select("ip_index", "start_int", "end_int"))).select("ip_index", "reach_from", "reach_to")
    return reach.withColumn("taken_to", F.max("reach_to").over(earlier)).filter("taken_to >= reach_from").limit(1).count() > 0


def _address_place(address: Column, spread: Column) -> Column:
    """Place in the order that is cut into parts: by address, rows of one address by a hash. Exact as a double."""
    return (address * F.lit(SPREAD) + spread).cast("double")


def ip_parts(sessions: DataFrame, blocks: DataFrame, session_key: str = "session_id", part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame]:
    """Sessions and blocks dealt to parts of about ``part_rows`` sessions that follow one another in address order.

    Bounds are quantiles of the sessions' own addresses and, within an address, of a hash, so a gateway's addresses, or one
    address alone, make as many parts as they hold rows for. A block goes to every part that its range touches: one copy, and
    one more for each bound inside it. Sessions without a valid address are dealt to parts of their own, without blocks.
    """
    whole = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name) for df, name in ((sessions, "s"), (blocks, "b"))]
    left = sessions.select(whole[0], ip_index(F.col("ip_address")).alias("s_index"), worked_out(octets_of(F.col("ip_address"))).alias("octets"),
                           F.xxhash64(session_key, "ip_address").alias("hash"))
    left = left.select("s", "s_index", octets_aton(F.col("octets")).alias("s_ip"), "hash")
    left = left.withColumn("at", F.coalesce(_address_place(F.col("s_ip"), F.pmod("hash", F.lit(SPREAD))), F.lit(-1.0)))
    parts = max(1, -(-sessions.count() // part_rows))
    shares = [i / parts for i in range(1, parts)]
    cuts = left.filter("at >= 0").agg(F.percentile_approx("at", shares, max(10_000, 10 * parts))).first()[0] if shares else []
    cuts = [-math.inf, *sorted(set(cuts or [])), math.inf]

    def place(df: DataFrame, column: str, out: str) -> DataFrame:
        dealt = Bucketizer(splits=cuts, inputCol=column, outputCol=out).transform(df) if len(cuts) > 2 else df.withColumn(out, F.lit(0))
        return dealt.withColumn(out, F.col(out).cast("int"))

    lost = -1 - F.pmod("hash", F.lit(parts)).cast("int")
    left = place(left, "at", "part").withColumn("part", F.when(F.col("s_ip").isNull(), lost).otherwise(F.col("part")))
    right = _reach(blocks).select(
        whole[1], F.col("ip_index").alias("b_index"), "reach_to", _address_place(F.col("reach_from"), F.lit(0)).alias("at"),
        _address_place(F.col("reach_to"), F.lit(SPREAD - 1)).alias("upto"))
    right = place(place(right, "at", "from_part"), "upto", "to_part")
    return left.select("part", "at", "s", "s_index", "s_ip"), right.select(
        F.explode(F.sequence("from_part", "to_part")).alias("part"), "at", "b", "b_index", "reach_to")


def ip_ordered_join(sessions: DataFrame, blocks: DataFrame, how: str = "inner", session_key: str = "session_id",
                    part_rows: int = PART_ROWS) -> DataFrame:
    """``ip_range_join`` for blocks that do not overlap, as a merge in address order.

    Within a part, blocks and sessions are sorted together and every session looks back at the last block that began.
    Each session is shuffled once and no block is copied for the sake of hot addresses.
    """
    left, right = ip_parts(sessions, blocks, session_key, part_rows)
    held = F.struct("b", "b_index", "reach_to").alias("held")

    def none_of(df: DataFrame, name: str) -> Column:
        return F.lit(None).cast(df.schema[name].dataType).alias(name)

    begin = right.select("part", "at", F.lit(0).alias("kind"), none_of(left, "s"), none_of(left, "s_index"), none_of(left, "s_ip"), held)
    asked = left.select("part", "at", F.lit(1).alias("kind"), "s", "s_index", "s_ip", none_of(begin, "held"))
    back = Window.partitionBy("part").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = begin.union(asked).withColumn("held", F.last("held", ignorenulls=True).over(back)).filter("kind = 1")
    inside = F.coalesce((F.col("held.reach_to") >= F.col("s_ip")) & (F.col("held.b_index") == F.col("s_index")), F.lit(False))
    met = met.filter(inside).withColumn("b", F.col("held.b")) if how == "inner" else met.withColumn("b", F.when(inside, F.col("held.b")))
    found = [c for c in blocks.columns if c not in ("ip_index", "start_int", "end_int")]
    return met.select(*[F.col(f"s.`{c}`").alias(c) for c in sessions.columns], *[F.col(f"b.`{c}`").alias(c) for c in found])


def locate_sessions(sessions: DataFrame, blocks: DataFrame, locations: DataFrame, how: str = "inner",
                    country: str | None = "US") -> DataFrame:
    """Sessions with the location columns of their address.

    Blocks are joined to locations first: both are dimension tables, so the large side is
    shuffled once at most.
    """
    if country is not None:
        locations = locations.filter(F.col("country_iso_code") == country)
    # decided on both tables: the optimizer's estimate of their join is the product of their sizes
    small = fits_broadcast(blocks, locations)
    places = blocks.join(locations, "maxmind_id", "inner" if how == "inner" else "left")
    return ip_range_join(sessions, F.broadcast(places) if small else places, how, salts=1 if small else None)


def revenue_per_session(revenue: DataFrame) -> DataFrame:
    """Revenue summed per session, exactly, before any join."""
    units = F.sum(money_units(F.col("revenue")))
    return revenue.groupBy("session_id").agg(units.alias("revenue_units")).withColumn(
        "revenue", F.col("revenue_units") / F.lit(10000.0))


def converted_sessions(revenue: DataFrame) -> DataFrame:
    return revenue_per_session(revenue).filter(F.col("revenue_units") > 0)


def conversion_facts(sessions: DataFrame, revenue: DataFrame, blocks: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per located session: place, conversion flag, revenue (zero where none)."""
    placed = locate_sessions(sessions, blocks, locations).filter(
        (F.col("subdivision_1_iso_code") != "") & (F.col("metro_code") != ""))
    return placed.join(converted_sessions(revenue), "session_id", "left").select(
        "session_id", "product", F.col("subdivision_1_iso_code").alias("state_code"),
        F.concat("metro_code", "subdivision_1_iso_code").alias("dma_state"), F.col("city_name").alias("city"),
        F.col("revenue_units").isNotNull().cast("int").alias("has_conversion"),
        F.coalesce("revenue_units", F.lit(0).cast("long")).alias("revenue_units"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"))


def zip_located_revenue(revenue: DataFrame, blocks: DataFrame, locations: DataFrame, zip_code: Column) -> DataFrame:
    """Revenue rows placed by the postal code in their landing page (one row per matching location)."""
    postal = blocks.select("maxmind_id", "postal_code").distinct()
    places = postal.join(locations, "maxmind_id").filter(
        (F.col("country_iso_code") == "US") & (F.col("subdivision_1_iso_code") != "") & (F.col("metro_code") != ""))
    rows = revenue.withColumn("zipcode", zip_code).filter(F.col("zipcode") != "")
    match = F.col("zipcode") == F.col("postal_code")
    if fits_broadcast(blocks, locations):
        places = F.broadcast(places)
    else:
        # a popular postal code may hold a third of the rows
        spread = F.pmod(F.xxhash64("session_id", "revenue"), F.lit(REPLICATION_SALTS)).cast("int")
        rows = rows.withColumn("row_salt", spread)
        places = replicate(places, REPLICATION_SALTS)
        match = match & (F.col("row_salt") == F.col("salt"))
    return rows.join(places, match).select(
        "session_id", F.col("session_creation_date").alias("date"), "product", "zipcode",
        F.col("subdivision_1_iso_code").alias("state_code"),
        F.concat("metro_code", "subdivision_1_iso_code").alias("dma_state"),
        (F.col("revenue") > 0).cast("int").alias("has_conversion"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"))
