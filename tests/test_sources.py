import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from adyield.operators import campaigns as cp, geo, joins, sessions, structure
from adyield.sources import scans, schemas, sinks
from checks.views import table, view
from tests.conftest import plan_of


def test_date_filter_and_columns_reach_the_files(spark, sf):
    events = table(spark, sf, "events").withColumnsRenamed({"ts": "creation_date"})
    kept = events.filter(scans.between_dates(F.col("creation_date"), "2024-01-02", "2024-01-03")).select("event_id")
    plan = plan_of(kept)
    assert "PushedFilters: [IsNotNull(creation_date)" in plan or "PushedFilters: [IsNotNull(ts)" in plan
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "props" not in plan.split("ReadSchema")[1]


def test_month_range_prunes_partitions(spark, tmp_path):
    rows = [(y, m, "{}") for y in (2023, 2024) for m in range(1, 13)]
    path = str(tmp_path / "landing")
    spark.createDataFrame(rows, "year int, month int, body string").write.partitionBy("year", "month").parquet(path)
    kept = scans.scan_lead_scores(spark.read.parquet(path), "2023-11-05", "2024-02-10")
    assert {(r["year"], r["month"]) for r in kept.collect()} == {(2023, 11), (2023, 12), (2024, 1), (2024, 2)}
    assert "PartitionFilters: [" in plan_of(kept) and "year" in plan_of(kept).split("PartitionFilters")[1][:80]


def test_optional_filters(spark):
    df = spark.createDataFrame([("HEALTH", "bing"), ("Medicare", "GOOGLE")], "product string, src string")
    assert df.filter(scans.equals_if(F.col("product"), None)).count() == 2
    assert df.filter(scans.equals_if(F.col("product"), "medicare")).count() == 1
    assert df.filter(scans.equals_if(F.col("product"), "medicare", ignore_case=False)).count() == 0
    assert df.filter(scans.member_if(F.col("src"), ("Bing", "google"))).count() == 2


def test_accounts_are_enabled_by_number(spark):
    df = spark.createDataFrame([("A", "N", "N"), ("B", "N", "N")], "account_number string, keyword_bidder_enabled string, keyword_geo_bidder_enabled string")
    got = {r["account_number"]: r["keyword_bidder_enabled"] for r in scans.enable_accounts(df, ["B"]).collect()}
    assert got == {"A": "N", "B": "Y"}


def test_dated_files_round_trip(spark, tmp_path):
    bids = spark.createDataFrame([(1, 2, 3, 4, 0.5, 0.6), (2, 2, 3, 5, 0.5, 0.7)], schemas.KEYWORD_BIDS)
    path = str(tmp_path / "bids")
    sinks.write_dated_csv(bids, path, "2024-01-31", "account_id")
    back = spark.read.option("header", True).option("inferSchema", True).csv(path)
    assert back.count() == 2 and set(back.columns) >= {"account_id", "calc_date"}
    for name in ("a_2024-01-31.csv", "b_2024-01-31.csv", "a_2024-01-30.csv"):
        (tmp_path / name).write_text("account_id,campaign_id,adgroup_id,keyword_id,max_cpc_old,max_cpc_new\n1,2,3,4,0.5,0.6\n")
    assert scans.read_dated_outputs(spark, str(tmp_path), "2024-01-31", schemas.KEYWORD_BIDS).count() == 2


def boom(value):
    raise RuntimeError("lost")


def test_dead_and_repeated_writes_leave_one_copy(spark, tmp_path):
    path = str(tmp_path / "runs")
    failing = spark.range(3).select(F.udf(boom, "long")("id").alias("id"))
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, path)
    assert sinks.read_table(spark, path, "id long").count() == 0
    sinks.append_table(spark.range(5), path, "monday")
    # dies while writing, and between writing and commit
    with pytest.raises(Exception, match="lost"):
        sinks.append_table(failing, path, "tuesday")
    with pytest.raises(Exception, match="lost"):
        sinks.replace_files(failing, path, "wednesday")
    sinks.stage_run(spark.range(7), path, "tuesday")
    assert sinks.read_table(spark, path).count() == 5
    before = sinks.read_table(spark, path)
    for _ in range(2):
        sinks.append_table(spark.range(2), path, "tuesday")
        sinks.append_table(spark.range(5), path, "monday")
    assert sinks.read_table(spark, path).count() == 7 and before.count() == 5
    sinks.replace_files(spark.range(4), path, "thursday")
    sinks.replace_files(spark.range(4), path, "thursday")
    assert sinks.read_table(spark, path).count() == 4 and before.count() == 5
    assert sinks.drop_stale_runs(spark, path) == 3 and sinks.read_table(spark, path).count() == 4


def test_two_writers_lose_no_run(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    newest, other = sinks._newest, iter(["rival"])

    def late(folder):
        found = newest(folder)
        for run in other:
            sinks.append_table(spark.range(3), path, run)
        return found

    sinks.stage_run(spark.range(2), path, "own")
    folder = sinks._Folder(spark, path)
    monkeypatch.setattr(sinks, "_newest", late)
    sinks._commit(folder, "own", replace=False)
    assert sorted(newest(folder)[1]) == ["own", "rival"] and sinks.read_table(spark, path).count() == 5


def test_failed_dated_write_and_rebuild_keep_the_old(spark, tmp_path):
    path = str(tmp_path / "dated")
    rows = spark.range(4).select("id", (F.col("id") % 2).alias("part"))
    sinks.write_dated_csv(rows, path, "2024-01-31", "part")
    with pytest.raises(Exception, match="lost"):
        sinks.write_dated_csv(rows.select(F.udf(boom, "long")("id").alias("id"), "part"), path, "2024-01-31", "part")
    assert spark.read.option("header", True).csv(path).count() == 4
    sinks.write_dated_csv(rows.limit(3), path, "2024-01-31", "part")
    assert spark.read.option("header", True).csv(path).count() == 3
    sinks.rebuild_table(rows, "kept_table")
    with pytest.raises(Exception, match="lost"):
        sinks.rebuild_table(rows.select(F.udf(boom, "long")("id").alias("id")), "kept_table")
    assert spark.table("kept_table").count() == 4


def test_append_rebuild_replace_and_head(spark, tmp_path):
    df = spark.range(5)
    path = str(tmp_path / "t")
    sinks.append_table(df, path)
    sinks.append_table(df, path)
    assert sinks.read_table(spark, path).count() == 10
    sinks.replace_files(df, path)
    assert sinks.read_table(spark, path).count() == 5
    assert sinks.rebuild_table(df, "rebuilt").first()["num_records"] == 5
    scans.table_head(df, str(tmp_path / "head"), 3)
    assert spark.read.option("header", True).csv(str(tmp_path / "head")).count() == 3


def test_geo_files_load_with_declared_types(spark, tmp_path):
    (tmp_path / "blocks.csv").write_text(
        "ip_index,start_int,end_int,network,geoname_id,a,b,c,d,postal,lat,long,r\n"
        "1.0,16777216,16777471,1.0.0.0/24,7,,,false,false,123,-33.5,143.25,1000\n")
    blocks = scans.load_geo_blocks(spark, str(tmp_path / "blocks.csv"), str(tmp_path / "blocks"))
    row = blocks.first()
    assert (row["start_int"], row["latitude"], row["postal_code"]) == (16777216, -33.5, "123")
    (tmp_path / "loc.csv").write_text("id,l,c,cn,iso,n,s1,s1n,s2,s2n,city,metro,tz,eu\n7,en,NA,North America,US,United States,NY,New York,,,Albany,532,America/New_York,false\n")
    assert scans.load_geo_locations(spark, str(tmp_path / "loc.csv"), str(tmp_path / "loc")).first()["metro_code"] == "532"


def test_cidr_expansion_clips_to_buckets(spark):
    df = spark.createDataFrame([("30.41.128.0/17",), ("30.40.0.0/14",)], "network string")
    rows = {(r["network"], r["ip_index"]): (r["start_int"], r["end_int"]) for r in geo.expand_cidr_blocks(df).collect()}
    base = 30 * 2**24 + 41 * 2**16
    assert rows[("30.41.128.0/17", "30.41")] == (base + 32768, base + 65535)
    assert sorted(k[1] for k in rows if k[0].endswith("/14")) == ["30.40", "30.41", "30.42", "30.43"]
    assert rows[("30.40.0.0/14", "30.41")] == (base, base + 65535)


def test_salted_and_plain_range_join_agree(spark, sf):
    sessions = scans.scan_sessions(view(spark, sf, "session_detail"), "2024-01-01", "2024-01-31")
    blocks = view(spark, sf, "geo_blocks")
    plain = joins.ip_range_join(sessions, blocks, salts=1).select("session_id", "maxmind_id")
    salted = joins.ip_range_join(sessions, blocks, salts=5).select("session_id", "maxmind_id")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))
    left = joins.ip_range_join(sessions, blocks, how="left", salts=5)
    assert left.count() == sessions.count()


def test_hot_keys_are_spread_without_losing_rows(spark):
    rows = spark.range(900).select(F.col("id"), F.when(F.col("id") < 300, F.lit(7)).otherwise(F.col("id") % 50 + 100).alias("k"))
    facts = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    spread = joins.join_spreading_hot_keys(rows, facts, "k", "n", hot_rows=100, salts=4)
    plain = rows.join(facts, "k")
    columns = ["id", "k", "n", "top"]
    assert sorted(map(tuple, spread.select(columns).collect())) == sorted(map(tuple, plain.select(columns).collect()))


def test_rules_apply_in_order(spark):
    body = ('{"id": "1", "activity_schedule": {"mode": "CUSTOM", "rules": ['
            '{"type": "INCLUDE", "day": "Monday", "from_hour": 6, "until_hour": 20},'
            '{"type": "EXCLUDE", "day": "Monday", "from_hour": 12, "until_hour": 13}]}}')
    rows = cp.activity_hours(spark.createDataFrame([(body,)], "body string")).collect()
    on = {(r["day"], r["hour"]) for r in rows if r["value"] == 1}
    assert len(rows) == 168 and on == {("MONDAY", h) for h in range(6, 20) if h != 12}


def test_flattening_parses_a_body_once_in_many_tasks(spark):
    bodies = spark.createDataFrame([('{"id": "1", "activity_schedule": {"mode": "ALWAYS"}}', 1)], "body string, version int")
    for read, tasks in ((cp.flatten_campaigns, 4), (cp.activity_hours, 4)):
        # a list that is unfolded implies a filter, which used to parse the body once per field
        plan = plan_of(read(bodies, ["id", "version"]))
        assert plan.count("from_json") == 1 and "Filter" not in plan
        assert read(bodies, ["id", "version"]).rdd.getNumPartitions() == tasks


@pytest.mark.parametrize("mode", ["ALWAYS", "CUSTOM", None])
def test_odd_rules_count_as_one_by_one(spark, mode):
    rules = [("INCLUDE", "monday", -2, 3), (None, "Monday", 2, 5), ("EXCLUDE", "MONDAY", 4, 30), ("INCLUDE", None, 0, 24),
             ("INCLUDE", "SUNDAY", 9, 9), ("INCLUDE", "SUNDAY", 12, 4), ("INCLUDE", "SUNDAY", None, 7), ("INCLUDE", "SUNDAY", 22, 24)]
    wanted = {}
    for day in cp.DAYS:
        for hour in range(24):
            on = None if mode is None else mode == "ALWAYS"
            for kind, rule_day, first, until in rules if mode != "ALWAYS" else []:
                if None not in (rule_day, first, until) and rule_day.upper() == day and first <= hour < until:
                    on = None if kind is None else kind == "INCLUDE"
            wanted[day, hour] = None if on is None else int(on)
    names = ("type", "day", "from_hour", "until_hour")
    body = json.dumps({"id": "1", "activity_schedule": {"mode": mode, "rules": [dict(zip(names, r)) for r in rules]}})
    frame = spark.createDataFrame([(body,)], "body string")
    assert {(r["day"], r["hour"]): r["value"] for r in cp.activity_hours(frame).collect()} == wanted
    flat = {r["key"]: r["value"] for r in cp.flatten_campaigns(frame).filter("section = 'activity_schedule'").collect()}
    assert flat == {f"{day}:{hour}": str(value or 0) for (day, hour), value in wanted.items()}


def test_modifier_slices(spark):
    campaigns = spark.createDataFrame([("acc", "1", 0.5)], "account_id string, campaign_id string, cpc_new double")
    modifiers = spark.createDataFrame([("1", f"p{i:02d}", 2.0 - i / 10) for i in range(8)] + [("1", "zero", 0.0), ("1", "none", None)],
                                      "campaign_id string, publisher string, modifier double")
    update = cp.update_payloads(campaigns, modifiers, 3, 2).withColumn("u", F.from_json("update", cp.UPDATE)).first()["u"]
    assert [v["target"] for v in update["publisher_bid_modifier"]["values"]] == ["p00", "p01", "p02"]
    assert update["publisher_targeting"]["values"] == ["p03", "p04", "p05"]
    few = cp.update_payloads(campaigns, modifiers, 1500, 1500).withColumn("u", F.from_json("update", cp.UPDATE)).first()["u"]
    assert len(few["publisher_bid_modifier"]["values"]) == 8 and few["publisher_targeting"]["values"] == []


def test_management_table_defaults(spark):
    row = cp.management_table(spark.createDataFrame([(False, "7")], "created boolean, id string"), "2024-01-31 10:00:00").first()
    assert (row["created_date"], row["baseline_cpc"], row["active"], row["automatically_managed"]) == (dt.date(2024, 1, 31), 1.0, False, True)


def test_address_tables_are_broadcast_when_small_and_salted_when_large(spark):
    sessions = spark.createDataFrame([("a", "10.0.0.5"), ("b", "10.0.9.9")], "session_id string, ip_address string")
    blocks = spark.createDataFrame([("10.0", 167772160, 167772415, 1)], "ip_index string, start_int long, end_int long, maxmind_id long")
    places = spark.createDataFrame([(1, "US", "NY")], "maxmind_id long, country_iso_code string, subdivision_1_iso_code string")
    small = joins.locate_sessions(sessions, blocks, places)
    assert "BroadcastHashJoin" in plan_of(small) and "Generate explode" not in plan_of(small)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20b")
    try:
        large = joins.locate_sessions(sessions, blocks, places)
        assert "Generate explode" in plan_of(large) and "BroadcastHashJoin" not in plan_of(large)
        assert [r.session_id for r in large.collect()] == ["a"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert [r.session_id for r in small.collect()] == ["a"]


def test_filters_do_not_repeat_what_is_parsed(spark):
    landing = spark.createDataFrame([('{"sessionid": 1, "on": "2024-01-02", "score": 3.0}',), (None,)], "body string")
    scores = sessions.extract_scores(landing)
    assert [tuple(r)[:3] for r in scores.collect()] == [(1, dt.date(2024, 1, 2), 3.0), (None, None, None)]
    assert plan_of(sessions.pivot_scores(scores, "2024-01-01", "2024-02-01")).count("from_json") == 1
    blocks = spark.createDataFrame([("10.0", 167772160, 167772415, 1)], "ip_index string, start_int long, end_int long, maxmind_id long")
    plan = plan_of(joins._reach(blocks))
    assert "split_part" in plan or "element_at" in plan
    assert not any("Filter" in line and ("split_part" in line or "element_at" in line) for line in plan.splitlines())


def test_weights_are_read_once(spark):
    rows = spark.range(1, 11).selectExpr("id AS w")
    found = structure.weight_threshold(rows, "w", 0.8)
    assert "Range (" not in plan_of(found) and found.first()["threshold"] == 4.0
