"""Campaign structure: cluster attribute splits, compare the clusterings, write targeting rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adyield.operators import clusters as cl
from adyield.operators import structure as st
from adyield.operators.tree import fit_tree
from adyield.session import checkpointed

METHODS = ("mean", "tree", "curve", "hybrid")


def clustered_rows(rows: DataFrame, split: Sequence[str], method: str, evaluation_date, clusters: int = 64,
                   min_sessions: float = 100) -> DataFrame:
    """Rows with ``clust`` from a clustering fitted before the evaluation date; unknown buckets get -1."""
    fit, _ = cl.holdout_rows(rows, evaluation_date)
    if method == "tree":
        return fit_tree(fit, split, clusters, min_sessions=min_sessions).transform(rows)
    if method == "hybrid":
        labelled = rows
        for a in split:
            labels = cl.curve_clusters(fit, [a], clusters).select(a, F.col("clust").alias(f"{a}_clust"))
            labelled = labelled.join(labels, a, "left")
        names = [f"{a}_clust" for a in split]
        known, _ = cl.holdout_rows(labelled, evaluation_date)
        return fit_tree(known, names, clusters, min_sessions=min_sessions).transform(labelled).drop(*names)
    labels = (cl.mean_clusters(fit, split, clusters) if method == "mean" else cl.curve_clusters(fit, split, clusters))
    return rows.join(labels, list(split), "left").na.fill(-1, subset=["clust"])


def method_report(splits: Mapping[str, tuple[DataFrame, Sequence[str]]], evaluation_date, clusters: int = 64,
                  methods: Sequence[str] = METHODS) -> DataFrame:
    """Hold-out report of every split and clustering, one row each."""
    out = None
    for name, (rows, split) in splits.items():
        daily = checkpointed(rows)
        for method in methods:
            clustered = checkpointed(clustered_rows(daily, split, method, evaluation_date, clusters))
            factor = cl.split_factor(clustered, split)
            report = cl.holdout_report(clustered, split, evaluation_date).select(
                F.lit(method).alias("method"), F.lit(name).alias("split"), "*", F.lit(factor).alias("split_factor"))
            out = report if out is None else out.unionByName(report)
    return out


def campaign_plan(clustered: DataFrame, split: Sequence[str]) -> DataFrame:
    """Targeting rows of a clustered split: include and exclude lists per device and system."""
    order = cl.attribute_order(clustered, split)
    attributes, listed = order[:-1], order[-1]
    structure = st.campaign_structure(clustered, attributes, listed)
    lists = st.targeting_lists(structure, attributes, listed)
    if "device" in attributes and "operating_system" not in split:
        lists = st.expand_systems(lists)
        return st.targeting_payload(lists, [*attributes, listed, "operating_system"])
    return st.targeting_payload(lists, [*attributes, listed])
