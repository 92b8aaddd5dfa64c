"""Regression-tree clusters of attribute combinations and the roll-up of their volumes.

Input rows are daily aggregates: attribute columns, utc_dt, sessions, revenue, leads.

A split of such a tree asks whether an attribute has one value, and is judged by sums of sessions and revenue alone. So the rows are
folded to one per attribute combination before anything is fitted, whatever the number of days. Large nodes are split a level at a
time, all in one job over a node column; a node that has few enough combinations is grown to its end in one task, all of them in one job.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adyield.operators.sessions import rare_to_null, trailing_daily_mean
from adyield.session import checkpointed

# ship these helpers inside the task, so that workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Combinations of a node that one task grows to its end.
LOCAL_ROWS = 50_000
#: A split must gain more than rounding does.
ROUNDING = 1e-12
LEAF = -1


@dataclass
class TreeClusters:
    """A grown tree: per node the attribute and value it asks for (LEAF for none) and its two children, its attributes and each leaf's path."""

    asks: np.ndarray
    values: list[str]
    no: np.ndarray
    yes: np.ndarray
    attributes: list[str]
    leaf_of: np.ndarray
    paths: list[tuple[int, int, int]]  # leaf ordinal, node id, steps above the leaf

    def transform(self, rows: DataFrame) -> DataFrame:
        """Rows with the leaf they fall into as ``clust``; unseen attribute values count as none of the known."""
        asks, values, no, yes, leaf_of = self.asks, np.array(self.values, object), self.no, self.yes, self.leaf_of

        @F.pandas_udf("int")
        def leaf(labels: pd.DataFrame) -> pd.Series:
            own = labels.to_numpy(object)
            node = np.zeros(len(own), np.int64)
            going = np.arange(len(own)) if asks[0] != LEAF else np.zeros(0, np.int64)
            while len(going):
                here = node[going]
                fits = own[going, asks[here]] == values[here]
                node[going] = np.where(fits, yes[here], no[here])
                going = going[asks[node[going]] != LEAF]
            return pd.Series(leaf_of[node], dtype="int32")

        return rows.select("*", leaf(F.struct(*[_label(c).alias(f"a{i}") for i, c in enumerate(self.attributes)])).alias("clust"))

    def path_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.paths, "clust int, node int, above int")


def _label(name: str) -> Column:
    """Attribute value as text; missing and blank values are one category."""
    return F.coalesce(F.nullif(F.col(name).cast("string"), F.lit("")), F.lit("(none)"))


def _local_splits(codes: np.ndarray, weight: np.ndarray, value: np.ndarray, least: float) -> tuple[list[int], list[int], list[int], list[int]]:
    """Grow a node to its end: what each node asks for (attribute, code) and its children, ids from 0; depth has no limit."""
    asks, wants, no, yes = [LEAF], [0], [LEAF], [LEAF]
    open_ = [(0, np.arange(len(weight)))]
    while open_:
        node, rows = open_.pop()
        if len(rows) < 2:
            continue
        w, s = weight[rows], value[rows]
        whole, total = w.sum(), s.sum()
        best = (0.0, LEAF, 0)
        for attribute in range(codes.shape[1]):
            own, place = np.unique(codes[rows, attribute], return_inverse=True)
            inside, taken = np.bincount(place, w), np.bincount(place, s)
            rest = whole - inside
            fine = (inside >= least) & (rest >= least) & (inside > 0) & (np.bincount(place) < len(rows))
            if not fine.any():
                continue
            apart = np.where(fine, taken ** 2 / np.where(fine, inside, 1) + (total - taken) ** 2 / np.where(fine, rest, 1), 0)
            gain = np.where(fine, apart - total ** 2 / whole, -1)
            top = int(gain.argmax())
            if gain[top] > max(best[0], ROUNDING * apart[top]):
                best = (float(gain[top]), attribute, int(own[top]))
        if best[1] == LEAF:
            continue
        asks[node], wants[node] = best[1], best[2]
        fits = codes[rows, best[1]] == best[2]
        for side, part in ((no, rows[~fits]), (yes, rows[fits])):
            side[node] = len(asks)
            open_.append((len(asks), part))
            asks.append(LEAF)
            wants.append(0)
            no.append(LEAF)
            yes.append(LEAF)
    return asks, wants, no, yes


_GROWN = "node long, id long, asks long, value string, no long, yes long"


def _grow_small(nodes: DataFrame, names: list[str], least: float) -> DataFrame:
    """Every node of (node, names, w, s), each of at most LOCAL_ROWS rows, grown to its end: one row per node below it."""
    def grow(table: pa.Table) -> pa.Table:
        table = table.sort_by([(n, "ascending") for n in names])
        columns = [table.column(n).combine_chunks().dictionary_encode() for n in names]
        # codes follow the order of the values, so that ties do not depend on where a row lay
        known = [np.array(c.dictionary.to_pylist(), object) for c in columns]
        orders = [np.argsort(np.argsort(k)) for k in known]
        codes = np.stack([o[c.indices.to_numpy()] for o, c in zip(orders, columns)], axis=1)
        asks, wants, no, yes = _local_splits(codes, table.column("w").to_numpy(), table.column("s").to_numpy(), least)
        words = [np.sort(known[a])[v] if a != LEAF else None for a, v in zip(asks, wants)]
        top = table.column("node")[0].as_py()
        return pa.table({"node": pa.array([top] * len(asks), pa.int64()), "id": pa.array(range(len(asks)), pa.int64()),
                         "asks": pa.array(asks, pa.int64()), "value": pa.array(words, pa.string()),
                         "no": pa.array(no, pa.int64()), "yes": pa.array(yes, pa.int64())})

    return nodes.groupBy("node").applyInArrow(grow, _GROWN)


def _best_splits(nodes: DataFrame, names: list[str], least: float) -> DataFrame:
    """The best split of each node of (node, names, w, s): (node, asks, value); nodes that none improves are left out."""
    asked = F.explode(F.array(*[F.struct(F.lit(i).alias("asks"), F.col(n).alias("value")) for i, n in enumerate(names)])).alias("q")
    sums = nodes.select("node", asked, "w", "s").groupBy("node", "q").agg(F.sum("w").alias("inside"), F.sum("s").alias("taken"))
    whole = nodes.groupBy("node").agg(F.sum("w").alias("whole"), F.sum("s").alias("total"))
    rest = F.col("whole") - F.col("inside")
    apart = F.pow("taken", 2) / F.col("inside") + F.pow(F.col("total") - F.col("taken"), 2) / rest
    judged = sums.join(whole, "node").filter((F.col("inside") > 0) & (F.col("inside") >= least) & (rest >= least) & (rest > 0)) \
        .withColumn("apart", apart).withColumn("gain", F.col("apart") - F.pow("total", 2) / F.col("whole")) \
        .filter(F.col("gain") > F.lit(ROUNDING) * F.col("apart"))
    order = Window.partitionBy("node").orderBy(F.desc("gain"), "q.asks", "q.value")
    return judged.withColumn("nth", F.row_number().over(order)).filter("nth = 1").select("node", "q.asks", "q.value")


def fit_tree(rows: DataFrame, attributes: Sequence[str], clusters: int | None = None, smooth_days: int = 7,
             min_sessions: float = 100, local_rows: int = LOCAL_ROWS) -> TreeClusters:
    """Regress smoothed revenue per session on attribute values, weighted by sessions.

    A node is split where one value of one attribute, against all others, takes most out of the weighted variance; ties go to the
    earlier attribute and smaller value. With ``clusters`` given, a leaf holds at least half an even share of the sessions. Depth has no
    limit.
    """
    attributes = list(attributes)
    smooth = trailing_daily_mean(rows, attributes, ["sessions", "revenue"], smooth_days)
    # read once per attribute and once more
    smooth = rare_to_null(checkpointed(smooth.filter(F.col("sessions") > 0)), attributes, min_sessions)
    names = [f"in_{i}" for i in range(len(attributes))]
    folded = smooth.groupBy(*[_label(c).alias(n) for c, n in zip(attributes, names)]).agg(
        F.sum("sessions").cast("double").alias("w"), F.sum("revenue").cast("double").alias("s"))
    nodes = checkpointed(folded.select(F.lit(0).cast("long").alias("node"), *names, "w", F.coalesce("s", F.lit(0.0)).alias("s")))
    least = 0.5 / clusters * (nodes.agg(F.sum("w")).first()[0] or 0) if clusters else 0.0
    asks, values, no, yes = [LEAF], [""], [LEAF], [LEAF]

    def add() -> int:
        for column, empty in ((asks, LEAF), (values, ""), (no, LEAF), (yes, LEAF)):
            column.append(empty)
        return len(asks) - 1

    while True:
        # at most as many nodes as the combinations make of that size
        large = nodes.groupBy("node").count().filter(F.col("count") > local_rows).select("node")
        splits = _best_splits(nodes.join(F.broadcast(large), "node"), names, least).collect() if large.limit(1).count() else []
        if large.limit(1).count():
            ended = {r[0] for r in large.collect()} - {r["node"] for r in splits}
            nodes = nodes.filter(~F.col("node").isin(list(ended))) if ended else nodes
        if not splits:
            break
        made = []
        for node, attribute, value in splits:
            asks[node], values[node], no[node], yes[node] = attribute, value, add(), add()
            made.append((node, attribute, value, no[node], yes[node]))
        table = rows.sparkSession.createDataFrame(made, "node long, asks int, value string, no long, yes long")
        own = F.element_at(F.array(*names), F.col("asks") + 1)
        nodes = checkpointed(nodes.join(F.broadcast(table), "node", "left").select(
            F.when(F.col("asks").isNull(), F.col("node")).when(own == F.col("value"), F.col("yes")).otherwise(F.col("no")).alias("node"),
            *names, "w", "s"))
    grafts: dict[int, dict[int, tuple]] = {}
    for node, place, attribute, value, left, right in _grow_small(nodes, names, least).collect():
        grafts.setdefault(node, {})[place] = (attribute, value, left, right)
    for node in sorted(grafts):
        at = {place: node if place == 0 else add() for place in sorted(grafts[node])}
        for place, (attribute, value, left, right) in grafts[node].items():
            if attribute != LEAF:
                asks[at[place]], values[at[place]], no[at[place]], yes[at[place]] = attribute, value, at[left], at[right]
    return _numbered(asks, values, no, yes, attributes)


def _numbered(asks: list[int], values: list[str], no: list[int], yes: list[int], attributes: list[str]) -> TreeClusters:
    """The tree with nodes in pre-order, those who have the value after those who have not, and leaves numbered as they come."""
    order, stack, above = [], [(0, LEAF)], []
    while stack:
        node, parent = stack.pop()
        place = len(order)
        order.append(node)
        above.append(parent)
        if asks[node] != LEAF:
            stack += [(yes[node], place), (no[node], place)]
    place_of = {node: place for place, node in enumerate(order)}
    kids = [np.array([place_of[side[n]] if asks[n] != LEAF else LEAF for n in order], np.int64) for side in (no, yes)]
    leaf_of, paths = np.full(len(order), LEAF), []
    for place, node in enumerate(order):
        if asks[node] == LEAF:
            leaf = int(leaf_of.max()) + 1
            leaf_of[place] = leaf
            here, steps = place, 0
            while here != LEAF:
                paths.append((leaf, here, steps))
                here, steps = above[here], steps + 1
    return TreeClusters(np.array([asks[n] for n in order]), [values[n] or "" for n in order], *kids, attributes, leaf_of, paths)


def rollup(rows: DataFrame, paths: DataFrame, measures: Mapping[str, str], weight: str, threshold: float,
           last_whole: bool = True) -> DataFrame:
    """Volumes per (cluster, day), widened towards the root until ``weight`` reaches the threshold.

    ``measures`` map an output column to its input column. A node adds what its day total exceeds the
    deeper nodes on the path by, and where that passes the threshold it counts in part. With ``last_whole``
    the tree's last leaf counts whole, however large it is. Rows are folded to (cluster, day)
    first: all rows of a leaf share path and totals.
    """
    inputs = {**{f"{out}_all": c for out, c in measures.items()}, "w_all": weight}
    leaf_days = rows.groupBy("clust", "utc_dt").agg(*[F.sum(c).alias(f"leaf_{n}") for n, c in inputs.items()])
    nodes = leaf_days.join(paths, "clust")
    totals = nodes.groupBy("utc_dt", "node").agg(*[F.sum(f"leaf_{n}").alias(n) for n in inputs])
    steps = nodes.select("clust", "utc_dt", "node", "above").join(totals, ["utc_dt", "node"])
    upward = Window.partitionBy("clust", "utc_dt").orderBy("above")
    deeper = upward.rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumns({
        n.replace("_all", "_add"): F.greatest(F.col(n) - F.coalesce(F.max(n).over(deeper), F.lit(0.0)), F.lit(0.0))
        for n in inputs})
    reached = F.sum("w_add").over(upward.rowsBetween(Window.unboundedPreceding, 0))
    steps = steps.withColumn("reached", reached)
    before = F.col("reached") - F.col("w_add")
    last = paths.agg(F.max("clust")).scalar()
    whole = (F.col("clust") == last) & (F.col("above") == 0) if last_whole else F.lit(False)
    share = F.when(whole | (F.col("reached") < threshold), F.lit(1.0)).when(
        before < threshold, F.try_divide(F.lit(float(threshold)) - before, F.col("w_add"))).otherwise(F.lit(0.0))
    return steps.withColumn("share", share).groupBy("clust", "utc_dt").agg(
        *[F.sum(F.col(f"{out}_add") * F.col("share")).alias(out) for out in measures])


def estimate_rps(rows: DataFrame, tree: TreeClusters, lead_threshold: float = 15, lead_days: int = 7,
                 session_threshold: float = 100, session_days: int = 30) -> DataFrame:
    """Rows with cluster and estimate: revenue per lead of the last days times leads per session of more days.

    Every cluster gets a gap-free day axis, missing days repeat the last known volumes.
    """
    clustered = checkpointed(tree.transform(rows))
    paths = tree.path_table(rows.sparkSession)
    by_leads = rollup(clustered, paths, {"lead_volume": "leads", "lead_revenue": "revenue"}, "leads", lead_threshold)
    by_sessions = rollup(clustered, paths, {"session_volume": "sessions", "session_leads": "leads"}, "sessions", session_threshold)
    volumes = by_leads.join(by_sessions, ["clust", "utc_dt"])
    spans = {"lead_volume": lead_days, "lead_revenue": lead_days, "session_volume": session_days, "session_leads": session_days}
    filled = fill_days(volumes, ["clust"], list(spans), clustered)
    sums = {}
    for m, days in spans.items():
        window = Window.partitionBy("clust").orderBy("utc_dt").rowsBetween(-(days - 1), 0)
        sums[f"{m}_sum"] = F.when(F.count(m).over(window) == days, F.sum(m).over(window))
    out = filled.withColumns(sums)
    rpl = F.col("lead_revenue_sum") / (F.col("lead_volume_sum") + F.lit(1e-10))
    lps = F.col("session_leads_sum") / (F.col("session_volume_sum") + F.lit(1e-10))
    estimates = out.select("clust", "utc_dt", (rpl * lps).alias("rps_est"))
    return clustered.join(estimates, ["clust", "utc_dt"], "left")


def fill_days(df: DataFrame, keys: Sequence[str], measures: Sequence[str], span_of: DataFrame) -> DataFrame:
    """All days of ``span_of`` for every key, empty ones filled from the day before."""
    df = checkpointed(df)
    span = span_of.agg(F.struct(F.min("utc_dt").alias("first"), F.max("utc_dt").alias("last"))).scalar()
    axis = df.select(*keys).distinct().withColumn("span", span).select(
        *keys, F.explode(F.sequence("span.first", "span.last")).alias("utc_dt"))
    window = Window.partitionBy(*keys).orderBy("utc_dt").rowsBetween(Window.unboundedPreceding, 0)
    return axis.join(df, [*keys, "utc_dt"], "left").withColumns({
        m: F.last(m, ignorenulls=True).over(window) for m in measures})
