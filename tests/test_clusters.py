import datetime as dt
import os
import random
import subprocess
import sys
from functools import partial

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from adyield.operators import clusters as cl, sessions, structure as st, tree

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    data = []
    for day in range(20):
        for s, state in enumerate(["NY", "TX", "CO"]):
            for device in ["DESK", "PHON"]:
                n = rnd.randrange(5, 40)
                leads = rnd.randrange(0, n // 2 + 1)
                data.append((state, device, DAY + dt.timedelta(day), n, float(leads), leads * (5.0 + 10 * s + rnd.random())))
    df = spark.createDataFrame(data, "state string, device string, utc_dt date, sessions long, leads double, revenue double")
    return df.withColumns({
        "rps": F.col("revenue") / F.col("sessions"), "rps_avg": F.col("revenue") / F.col("sessions"),
        "lps": F.col("leads") / F.col("sessions"), "rpl": F.try_divide("revenue", "leads"), "score": F.lit(0.0)}).cache()


def test_tree_leaves_hold_enough_sessions(rows):
    model = tree.fit_tree(rows, ["state", "device"], 4, min_sessions=1)
    clustered = model.transform(rows)
    assert clustered.count() == rows.count()
    per_leaf = {r["clust"]: r["n"] for r in clustered.groupBy("clust").agg(F.sum("sessions").alias("n")).collect()}
    assert 1 < len(per_leaf) <= 8
    roots = {node for _, node, above in model.paths if node == 0}
    assert roots == {0}
    leaves = {leaf for leaf, _, above in model.paths if above == 0}
    assert leaves >= set(per_leaf)


@pytest.mark.parametrize("local_rows", [tree.LOCAL_ROWS, 33])
def test_tree_has_no_depth_limit(spark, local_rows):
    data = [(f"k{i:02d}", DAY, 10 + i % 7, 0.0, (10.0 + i % 7) * (1 + i * i)) for i in range(40)]
    rows = spark.createDataFrame(data, "keyword string, utc_dt date, sessions long, leads double, revenue double")
    model = tree.fit_tree(rows, ["keyword"], smooth_days=1, min_sessions=1, local_rows=local_rows)
    found = model.transform(rows).select("keyword", "clust").collect()
    assert len({r.clust for r in found}) == 40 and {r.clust for r in found} == set(range(40))
    ways = {}
    for leaf, node, above in model.paths:
        ways.setdefault(leaf, {})[above] = node
    assert all(sorted(way) == list(range(len(way))) and way[max(way)] == 0 for way in ways.values())
    nodes = {node for way in ways.values() for node in way.values()}
    assert len(nodes) == 2 * 40 - 1 and len({way[0] for way in ways.values()}) == 40
    assert max(map(len, ways.values())) > 30


def brute_tree(data, least):
    """(weight, value sums) of the leaves of a tree over (labels, weight, value) rows, by trying every split of every node."""
    def best(part):
        whole, total = sum(r[1] for r in part), sum(r[2] for r in part)
        found = []
        for a in range(len(part[0][0])):
            for value in sorted({r[0][a] for r in part}):
                inside = [r for r in part if r[0][a] == value]
                w, s = sum(r[1] for r in inside), sum(r[2] for r in inside)
                if len(inside) < len(part) and w >= least and whole - w >= least:
                    gain = s * s / w + (total - s) ** 2 / (whole - w) - total * total / whole
                    found.append((round(gain, 6), -a, value))
        top = [f for f in found if f[0] > 1e-6]
        return min(top, key=lambda f: (-f[0], -f[1], f[2])) if top else None

    done, open_ = [], [data]
    while open_:
        part = open_.pop()
        split = best(part)
        if split is None:
            done.append(frozenset(r[0] for r in part))
            continue
        open_ += [[r for r in part if (r[0][-split[1]] == split[2]) == side] for side in (True, False)]
    return set(done)


@pytest.mark.parametrize("local_rows, clusters", [(tree.LOCAL_ROWS, None), (6, None), (6, 5), (tree.LOCAL_ROWS, 5)])
def test_tree_equals_brute_force_over_days(spark, local_rows, clusters):
    """The days of a combination change nothing but its sums, and where a node is grown changes nothing at all."""
    draw = random.Random(8)
    combos = {(f"s{a}", f"d{b}", None if c == 0 else f"k{c}"): draw.randint(1, 50) for a in range(4) for b in range(3) for c in range(3) if draw.random() < 0.9}
    data = [(*labels, DAY + dt.timedelta(d), n + d, float(draw.randint(0, 900))) for labels, n in combos.items() for d in range(4)]
    rows = spark.createDataFrame(data, "state string, device string, keyword string, utc_dt date, sessions long, revenue double")
    model = tree.fit_tree(rows, ["state", "device", "keyword"], clusters, smooth_days=1, min_sessions=0, local_rows=local_rows)
    found = {}
    for r in model.transform(rows).select("state", "device", "keyword", "clust").distinct().collect():
        found.setdefault(r.clust, set()).add((r.state, r.device, r.keyword or "(none)"))
    sums = {}
    for *labels, _, n, revenue in data:
        key = tuple(x or "(none)" for x in labels)
        w, s = sums.get(key, (0, 0.0))
        sums[key] = (w + n, s + revenue)
    least = 0.5 / clusters * sum(w for w, _ in sums.values()) if clusters else 0
    assert {frozenset(v) for v in found.values()} == brute_tree([(k, w, s) for k, (w, s) in sums.items()], least)
    assert set(found) == set(range(len(found)))


def test_tree_of_nothing_and_of_unseen_values(spark, rows):
    model = tree.fit_tree(rows.limit(0), ["state", "device"], 4)
    assert {r.clust for r in model.transform(rows).collect()} == {0} and model.paths == [(0, 0, 0)]
    model = tree.fit_tree(rows, ["state", "device"], min_sessions=1)
    odd = rows.withColumn("state", F.lit("??"))
    assert {r.clust for r in model.transform(odd).collect()} <= {leaf for leaf, _, _ in model.paths}


def dense_rollup(leaf_days, paths, threshold, last_whole):
    """Sequential form: per leaf and day walk from the leaf to the root."""
    route = {}
    for leaf, node, above in paths:
        route.setdefault(leaf, {})[above] = node
    totals = {}
    for (leaf, day), (y, w) in leaf_days.items():
        for node in route[leaf].values():
            ty, tw = totals.get((node, day), (0.0, 0.0))
            totals[(node, day)] = (ty + y, tw + w)
    out = {}
    for leaf, day in leaf_days:
        total_w = total_y = deep_y = deep_w = 0.0
        for above in sorted(route[leaf]):
            y, w = totals[(route[leaf][above], day)]
            add_y, add_w = max(0.0, y - deep_y), max(0.0, w - deep_w)
            deep_y, deep_w = max(deep_y, y), max(deep_w, w)
            whole = last_whole and leaf == max(route) and above == 0
            share = 1.0 if whole or total_w + add_w < threshold else max(0.0, min(1.0, (threshold - total_w) / add_w)) if add_w else float(total_w < threshold)
            total_w, total_y = total_w + add_w * share, total_y + add_y * share
        out[(leaf, day)] = total_y
    return out


def test_rollup_equals_walk_to_the_root(spark):
    paths = [(0, 2, 0), (0, 1, 1), (0, 0, 2), (1, 3, 0), (1, 1, 1), (1, 0, 2), (2, 4, 0), (2, 0, 1)]
    rnd = random.Random(1)
    leaf_days = {(leaf, DAY + dt.timedelta(d)): (float(rnd.randrange(50)), float(rnd.randrange(12))) for leaf in range(3) for d in range(5)}
    df = spark.createDataFrame([(leaf, day, y, w) for (leaf, day), (y, w) in leaf_days.items()], "clust int, utc_dt date, y double, w double")
    for last_whole in (True, False):
        got = tree.rollup(df, spark.createDataFrame(paths, "clust int, node int, above int"), {"out": "y"}, "w", 15, last_whole)
        expected = dense_rollup(leaf_days, paths, 15, last_whole)
        for r in got.collect():
            assert r["out"] == pytest.approx(expected[(r["clust"], r["utc_dt"])])


def test_estimates_wait_for_full_windows(rows):
    model = tree.fit_tree(rows, ["state", "device"], 4, min_sessions=1)
    out = tree.estimate_rps(rows, model, lead_days=3, session_days=7).collect()
    assert len(out) == rows.count()
    assert all((r["rps_est"] is None) == (r["utc_dt"] < DAY + dt.timedelta(6)) for r in out)


@pytest.mark.parametrize("similarity, method", [("cokpi", "mean"), ("cokpi", "stack"), ("correlation", "mean")])
def test_similarity_vectors_keep_all_distances(rows, similarity, method):
    kpis = ["rps", "lps"]
    curves = cl.daily_curves(rows, ["state", "device"], kpis).orderBy("state", "device").collect()
    tensor = np.array([[r[k] for r in curves] for k in kpis])
    if similarity == "cokpi":
        root = np.sqrt(tensor)
        sims = root @ root.transpose(0, 2, 1)
        sims = sims / sims.max(axis=(1, 2), keepdims=True)
    else:
        z = (tensor - tensor.mean(axis=2, keepdims=True)) / tensor.std(axis=2, keepdims=True)
        sims = z @ z.transpose(0, 2, 1) / tensor.shape[2]
    matrix = sims.mean(axis=0) if method == "mean" else np.concatenate(list(sims), axis=1)
    dense = ((matrix[:, None] - matrix[None]) ** 2).sum(axis=2)
    vectors = np.array([r["v"] for r in cl.similarity_table(
        rows, ["state", "device"], kpis=kpis, similarity=similarity, method=method).orderBy("state", "device").collect()])
    mine = ((vectors[:, None] - vectors[None]) ** 2).sum(axis=2)
    np.testing.assert_allclose(mine, dense, atol=1e-8)


def test_few_buckets_get_a_cluster_each(rows):
    got = cl.mean_clusters(rows, ["state", "device"], 8).collect()
    assert sorted(r["clust"] for r in got) == list(range(6))


def test_structure_covers_all_sessions(rows):
    clustered = rows.withColumn("clust", F.lit(0))
    table = st.campaign_structure(clustered, ["device"], "state")
    check = st.coverage_check(table, clustered).first()
    assert check["input_sessions"] == check["campaign_sessions"]
    assert check["input_rps"] == pytest.approx(check["campaign_rps"])
    lists = st.targeting_lists(table, ["device"], "state", min_sessions=1).collect()
    assert {next(iter(r["state"])) for r in lists} == {"INCLUDE", "EXCLUDE"}
    systems = st.expand_systems(st.targeting_lists(table, ["device"], "state", min_sessions=1))
    assert systems.count() == 2 * 3 + 2 * 2  # include and exclude rows, three desktop and two phone systems


def test_recoding_keeps_the_weighted_average(spark):
    averages = {c: 1.0 for c in sessions.AVERAGES}
    rows = [("DESKTOP", 10, 5.0, 1.0, 2.0), ("D", 30, 15.0, 2.0, 4.0), ("TV", 5, 1.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "device string, sessions long, revenue double, num_leads double, rps_avg double")
    df = df.withColumns({c: F.lit(v) for c, v in averages.items() if c != "rps_avg"})
    out = {r["device"]: r for r in sessions.translate_values(df, ["device"]).collect()}
    assert set(out) == {"DESK", "TV"} and out["DESK"]["sessions"] == 40
    assert out["DESK"]["rps_avg"] == pytest.approx((10 * 2 + 30 * 4) / 40)


def test_weight_threshold_matches_a_walk(spark):
    weights = [9, 7, 7, 7, 3, 2, 2, 1, 1, 1]
    df = spark.createDataFrame([(w,) for w in weights], "w int")
    for share in (0.1, 0.5, 0.8, 0.99):
        taken, expected = 0, None
        for w in sorted(weights, reverse=True):
            expected = w
            if taken > sum(weights) * share:
                break
            taken += w
        assert st.weight_threshold(df, "w", share).first()["threshold"] == expected


def test_tree_functions_travel_with_their_tasks(tmp_path):
    """A process that cannot import the package still runs what a task is sent."""
    data = tmp_path / "function"
    data.write_bytes(cloudpickle.dumps(partial(
        tree._local_splits, np.array([[0], [1]]), np.array([1.0, 1.0]), np.array([0.0, 5.0]), 0.0)))
    code = f"import pickle; print(pickle.load(open({str(data)!r}, 'rb'))()[0])"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True).stdout.strip() == "[0, -1, -1]"
