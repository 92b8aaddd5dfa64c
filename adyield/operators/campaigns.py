"""Campaign JSON: flattening, schedules, newest versions, bid updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adyield.operators.sessions import latest_per_key
from adyield.session import dealt

# Field names of a campaign object.
ATTRIBUTES = ["advertiser_id", "id", "cpc", "safety_rating", "daily_cap", "daily_ad_delivery_model", "bid_type",
              "bid_strategy", "traffic_allocation_mode", "marketing_objective", "is_active"]
TARGETING = ["country_targeting", "sub_country_targeting", "dma_country_targeting", "region_country_targeting",
             "city_targeting", "postal_code_targeting", "contextual_targeting", "platform_targeting",
             "publisher_targeting", "auto_publisher_targeting", "connection_type_targeting", "browser_targeting"]
DAYS = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]
BODY = (", ".join(f"{a} string" for a in ATTRIBUTES) + ", "
        + ", ".join(f"{t} struct<type: string, value: array<string>>" for t in TARGETING)
        + ", activity_schedule struct<mode: string, rules: array<struct<type: string, day: string, from_hour: int, until_hour: int>>>"
        + ", publisher_bid_modifier struct<values: array<struct<target: string, bid_modification: double>>>"
        + ", publisher_bid_strategy_modifiers struct<values: array<struct<target: string, bid_strategy: string>>>")
UPDATE = ("cpc double, publisher_bid_modifier struct<values: array<struct<target: string, bid_modification: double>>>, "
          "publisher_targeting struct<type: string, values: array<string>>")
SCHEDULE = "day array<int>, hour array<double>, bid_modifier array<double>"
MAX_MODIFIERS = 1500
MAX_EXCLUDED = 1500


def parse_bodies(bodies: DataFrame) -> DataFrame:
    return bodies.withColumn("c", F.from_json("body", BODY))


def _day_states(schedule: Column) -> Column:
    """Per day one number: bit h tells whether hour h is on, bit 24 + h whether that is known.

    All on when always active, else the last rule that covers the hour. Rules are applied to a day's hours at once.
    """
    def bits(hour: Column) -> Column:
        """The hours before ``hour``."""
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.lit(0), F.least(F.lit(24), hour))) - F.lit(1)

    def twice(hours: Column) -> Column:
        return hours * F.lit((1 << 24) + 1)

    every = F.lit((1 << 24) - 1).cast("long")
    start = F.when(schedule["mode"] == "ALWAYS", twice(every)).when(schedule["mode"].isNotNull(), every * F.lit(1 << 24)).otherwise(F.lit(0).cast("long"))

    def span(rule: Column) -> Column:
        """The rule's hours; a rule without day or hours has none."""
        covers = rule["from_hour"].isNotNull() & (rule["until_hour"] > rule["from_hour"])
        return F.when(covers, bits(rule["until_hour"]) - bits(rule["from_hour"])).otherwise(F.lit(0).cast("long"))

    rules = F.transform(schedule["rules"], lambda r: F.struct(
        F.upper(r["day"]).alias("day"), twice(span(r)).alias("span"), F.when(r["type"] == "INCLUDE", twice(span(r))).when(
            r["type"].isNotNull(), span(r) * F.lit(1 << 24)).otherwise(F.lit(0).cast("long")).alias("set")))
    none = F.array().cast("array<struct<day:string,span:bigint,set:bigint>>")
    # rules of an always active campaign do not count
    counted = F.when(schedule["mode"] == "ALWAYS", none).otherwise(F.coalesce(rules, none))

    def day_state(known: Column, day: str) -> Column:
        return F.aggregate(known, start, lambda state, rule: F.when(
            rule["day"] == day, state.bitwiseAND(F.bitwise_not(rule["span"])).bitwiseOR(rule["set"])).otherwise(state))

    return F.transform(F.array(counted), lambda known: F.array(*[day_state(known, d) for d in DAYS]))[0]


def _hour_on(states: Column, slot: Column) -> Column:
    """Whether an hour of the week (0 to 167) is on; NULL where that is not known."""
    state = F.get(states, F.floor(slot / F.lit(24)).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(24)))
    known = state.bitwiseAND(bit * F.lit(1 << 24)) != 0
    return F.when(known, state.bitwiseAND(bit) != 0)


def activity_hours(bodies: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """168 rows per campaign: day, hour, 1 or 0."""
    parsed = parse_bodies(dealt(bodies)).withColumn("id", F.col("c.id")).select(*keys, _day_states(F.col("c.activity_schedule")).alias("states"))
    week = F.array(*[F.struct(F.lit(day).alias("day"), F.lit(hour).alias("hour"), F.lit(24 * d + hour).alias("slot"))
                     for d, day in enumerate(DAYS) for hour in range(24)])
    return parsed.select(*keys, "states", F.inline(week)).select(
        *keys, "day", "hour", _hour_on(F.col("states"), F.col("slot")).cast("int").alias("value"))


def flatten_campaigns(bodies: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Long table (keys, section, key, value): attributes, targeting, hours, publisher modifiers.

    Sections a campaign does not have give no rows; an empty targeting list gives one blank value.
    The hours of the week are one constant list; their values are read off the days' states after it is unfolded.
    """
    c = F.col("c")
    shape = "struct<section:string,key:string,slot:int,value:string>"
    no_slot, one = F.lit(None).cast("int"), F.lit("1")

    def entry(section: str, key: Column, value: Column, slot: Column = no_slot) -> Column:
        return F.struct(F.lit(section).alias("section"), key.alias("key"), slot.alias("slot"), value.alias("value"))

    attributes = F.array(*[entry("attrs", F.lit(a), c[a]) for a in ATTRIBUTES])

    def targeted(name: str) -> Column:
        values = F.when(F.size(c[name]["value"]) > 0, c[name]["value"]).otherwise(F.array(F.lit("")))
        return F.when(c[name].isNotNull(), F.transform(values, lambda v: entry(name, F.concat_ws(":", c[name]["type"], v), one)))

    week = F.array(*[entry("activity_schedule", F.lit(f"{day}:{hour}"), F.lit(None).cast("string"), F.lit(24 * d + hour))
                     for d, day in enumerate(DAYS) for hour in range(24)])
    hours = F.when(c["activity_schedule"].isNotNull(), week)
    strategies = F.transform(c["publisher_bid_strategy_modifiers"]["values"], lambda v: entry(
        "publisher_bid_strategy_modifiers", F.concat_ws(":", v["target"], v["bid_strategy"]), one))
    modifiers = F.transform(c["publisher_bid_modifier"]["values"], lambda v: entry(
        "publisher_bid_modifier", F.concat_ws(":", v["target"]), v["bid_modification"].cast("string")))
    none = F.array().cast(f"array<{shape}>")
    parts = [attributes, *[targeted(t) for t in TARGETING], hours, strategies, modifiers]
    parsed = parse_bodies(dealt(bodies)).withColumn("id", F.col("c.id"))
    long = parsed.select(*keys, _day_states(c["activity_schedule"]).alias("states"), F.concat(*[F.coalesce(p, none) for p in parts]).alias("parts"))
    on = F.when(_hour_on(F.col("states"), F.col("slot")), one).otherwise(F.lit("0"))
    # no list is empty; the filter that a plain inline implies would be pushed down to the scan and parse a body once per field
    return long.select(*keys, "states", F.inline_outer("parts")).select(
        *keys, "section", "key", F.when(F.col("slot").isNull(), F.col("value")).otherwise(on).alias("value"))


def sparsity(flat: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Share of empty or zero cells of the campaign x key matrix the long table stands for."""
    filled = F.sum(F.when(F.col("value").isNotNull() & (F.col("value") != "0"), 1).otherwise(0))
    columns = flat.select("section", "key").distinct().agg(F.count("*")).scalar()
    return flat.agg(F.countDistinct(*keys).alias("campaigns"), filled.alias("filled")).withColumn("columns", columns).withColumn(
        "sparsity", 1 - F.col("filled") / (F.col("campaigns") * F.col("columns")))


def latest_updates(updates: DataFrame, with_schedule: bool = False, order: str = "datetime") -> DataFrame:
    """Newest update per account and campaign, or per schedule as well."""
    keys = ["account_id", "campaign_id", *(["schedule_json"] if with_schedule else [])]
    return latest_per_key(updates, keys, [order])


def latest_campaigns(bodies: DataFrame, as_of, order: str = "datetime") -> DataFrame:
    """Newest body per campaign, kept when active and not older than ``as_of``."""
    keyed = dealt(bodies).withColumn("campaign_id", F.get_json_object("body", "$.id"))
    newest = latest_per_key(keyed, ["campaign_id"], [order])
    active = F.get_json_object("body", "$.is_active") == "true"
    return newest.filter(active & (F.col("date") >= F.lit(str(as_of)).cast("date")))


def parse_updates(updates: DataFrame) -> DataFrame:
    return updates.withColumns({"update": F.from_json("update_json", UPDATE), "schedule": F.from_json("schedule_json", SCHEDULE)})


def schedule_hours(updates: DataFrame) -> DataFrame:
    """One row per hour entry of the newest updates' schedules."""
    return parse_updates(latest_updates(updates)).select("account_id", "campaign_id", F.explode("schedule.hour").alias("hour"))


def management_table(campaigns: DataFrame, as_of) -> DataFrame:
    """Start rows of the campaign management table."""
    return campaigns.select(
        "created", "id", F.lit(str(as_of)[:10]).cast("date").alias("created_date"),
        F.lit(str(as_of)).cast("timestamp_ntz").alias("created_datetime"), F.lit(1.0).alias("baseline_cpc"),
        F.lit(False).alias("active"), F.lit(True).alias("automatically_managed"))


def with_config(campaigns: DataFrame, config: DataFrame) -> DataFrame:
    return campaigns.join(config.filter("automatically_managed"), "id", "left")


def ranked_modifiers(modifiers: DataFrame) -> DataFrame:
    """Non-empty modifiers in cents with their rank from both ends per campaign (ties by publisher), from one sort."""
    rounded = modifiers.withColumn("modifier", F.bround("modifier", 2)).filter(
        F.col("modifier").isNotNull() & (F.col("modifier") != 0))
    campaign = Window.partitionBy("campaign_id")
    ranked = rounded.withColumn("rank", F.row_number().over(campaign.orderBy(F.col("modifier").desc(), "publisher")) - 1)
    return ranked.withColumn("rank_up", (F.count("*").over(campaign) - 1 - F.col("rank")).cast("int"))


def update_payloads(campaigns: DataFrame, modifiers: DataFrame, max_modifiers: int = MAX_MODIFIERS,
                    max_excluded: int = MAX_EXCLUDED) -> DataFrame:
    """Campaign update JSON: new bid, the largest publisher modifiers, the publishers in between excluded.

    The exclude list is the middle of the ranking: past the first ``max_modifiers`` and before the
    last ``max_excluded``.
    """
    ranked = ranked_modifiers(modifiers).filter((F.col("rank") < max_modifiers) | (F.col("rank_up") >= max_excluded))
    kept = F.when(F.col("rank") < max_modifiers, F.struct(
        "rank", F.col("publisher").alias("target"), F.col("modifier").alias("bid_modification")))
    dropped = F.when((F.col("rank") >= max_modifiers) & (F.col("rank_up") >= max_excluded), F.struct("rank", "publisher"))
    lists = ranked.groupBy("campaign_id").agg(
        F.array_sort(F.collect_list(kept)).alias("kept"), F.array_sort(F.collect_list(dropped)).alias("dropped"))
    joined = campaigns.join(lists, "campaign_id", "left")
    values = F.transform(F.coalesce("kept", F.array()), lambda v: F.struct(
        v["target"].alias("target"), v["bid_modification"].alias("bid_modification")))
    update = F.struct(
        F.bround("cpc_new", 2).alias("cpc"), F.struct(values.alias("values")).alias("publisher_bid_modifier"),
        F.struct(F.lit("EXCLUDE").alias("type"), F.coalesce(F.col("dropped.publisher"), F.array().cast("array<string>")).alias("values"))
        .alias("publisher_targeting"))
    return joined.select("account_id", "campaign_id", F.to_json(update).alias("update"))
