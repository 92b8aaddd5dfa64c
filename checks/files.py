"""Files and tables written from the given tables and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from adyield.session import shared_folder
from adyield.sources import scans, schemas, sinks
from checks.registry import register
from checks.views import table, view, with_views

CALC_DATE = "2024-05-31"


def place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def as_declared(df, schema: str):
    """All columns of a declared schema in order, those the table lacks as NULL."""
    return df.select(*[(F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
                       for name, kind in (field.split() for field in schema.split(", "))])


def _geo_blocks(spark, sf):
    path = place(spark, "geo-blocks")
    as_declared(view(spark, sf, "geo_blocks"), schemas.GEO_BLOCKS).write.option("header", True).csv(f"{path}/csv")
    return scans.load_geo_blocks(spark, f"{path}/csv", f"{path}/table").select(
        "ip_index", "start_int", "end_int", "maxmind_id", "postal_code")


register("files_geo_blocks", _geo_blocks, with_views("geo_blocks", """
SELECT ip_index, CAST(start_int AS BIGINT) AS start_int, CAST(end_int AS BIGINT) AS end_int,
  CAST(maxmind_id AS INT) AS maxmind_id, postal_code FROM geo_blocks"""))


def _geo_locations(spark, sf):
    path = place(spark, "geo-locations")
    as_declared(view(spark, sf, "geo_locations"), schemas.GEO_LOCATIONS).write.option("header", True).csv(f"{path}/csv")
    return scans.load_geo_locations(spark, f"{path}/csv", f"{path}/table").select(
        "maxmind_id", "country_iso_code", "subdivision_1_iso_code", "metro_code", "city_name", "time_zone")


register("files_geo_locations", _geo_locations, with_views("geo_locations", """
SELECT CAST(maxmind_id AS INT) AS maxmind_id, country_iso_code, subdivision_1_iso_code, nullif(metro_code, '') AS metro_code,
  city_name, time_zone FROM geo_locations"""))


def _dated_csv(spark, sf):
    path = place(spark, "dated")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    sinks.write_dated_csv(orders, path, CALC_DATE, "o_orderstatus")
    back = scans.read_csv(spark, path, "o_orderkey bigint, o_custkey bigint, o_orderpriority string, calc_date date, o_orderstatus string")
    return back.groupBy("calc_date", "o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.sum("o_custkey").alias("customers"))


register("files_dated_csv", _dated_csv, f"""
SELECT DATE '{CALC_DATE}' AS calc_date, o_orderstatus, o_orderpriority, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys,
  CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders GROUP BY ALL""")


def _dated_outputs(spark, sf):
    """Output files of two dates, one folder per status, of which the later date is read back."""
    path = place(spark, "outputs")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for date, part in ((CALC_DATE, orders), ("2024-05-30", orders.filter("o_orderkey % 2 = 0"))):
        part.write.partitionBy("o_orderstatus").option("header", True).csv(f"{path}/{date}-written")
        sinks.name_outputs(spark, f"{path}/{date}-written", f"{path}/outputs", date)
    back = scans.read_dated_outputs(spark, f"{path}/outputs", CALC_DATE, "o_orderkey bigint, o_custkey bigint")
    return back.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


register("files_dated_outputs", _dated_outputs, """
SELECT o_custkey, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1""")


def _appended(spark, sf):
    path = place(spark, "appended")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    for run in ("first", "second", "second"):
        sinks.append_table(orders, path, run)
    return sinks.read_table(spark, path).groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


register("files_appended", _appended, """
SELECT o_custkey, 2 * count(*) AS n, CAST(2 * sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1""")


def _replaced(spark, sf):
    path = place(spark, "replaced")
    sinks.replace_files(table(spark, sf, "part").select(F.col("p_partkey").alias("key")), path)
    sinks.replace_files(table(spark, sf, "customer").select(F.col("c_custkey").alias("key")), path)
    return sinks.read_table(spark, path)


register("files_replaced", _replaced, "SELECT c_custkey AS key FROM customer")

def _rebuilt(spark, sf):
    name = f"rebuilt_{uuid.uuid4().hex}"
    stored = sinks.rebuild_table(table(spark, sf, "orders").select("o_orderkey"), name).first()["num_records"]
    spark.sql(f"DROP TABLE {name}")
    return spark.range(1).select(F.lit(stored).cast("long").alias("num_records"))


register("table_rebuilt", _rebuilt, "SELECT count(*) AS num_records FROM orders")


def _head(spark, sf):
    path = place(spark, "head")
    scans.table_head(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), path)
    head = scans.read_csv(spark, path, "o_orderkey bigint, o_custkey bigint")
    known = head.join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey", "o_custkey"], "left_semi")
    return known.agg(F.count("*").alias("n"))


register("table_head_rows", _head, "SELECT least(1000, count(*)) AS n FROM orders")

register("accounts_enabled", lambda spark, sf: scans.enable_accounts(view(spark, sf, "accounts"), ["ACC2"]).select(
    "account_id", "account_number", "keyword_bidder_enabled", "keyword_geo_bidder_enabled"), with_views("accounts", """
SELECT account_id, account_number, CASE WHEN account_number = 'ACC2' THEN 'Y' ELSE keyword_bidder_enabled END AS keyword_bidder_enabled,
  CASE WHEN account_number = 'ACC2' THEN 'Y' ELSE keyword_geo_bidder_enabled END AS keyword_geo_bidder_enabled FROM accounts"""))
