"""Embedding columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adyield.llm.common import pick


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows with an id and a vector of finite numbers, one row per id.

    A row without an id or vector, or with a null or non-finite component, takes no part. Vectors of different lengths have no inner
    product: only those of the commonest length take part, of equally common ones the longest. Where rows share an id, the smallest of
    its vectors stands for it.
    """
    rows = pick(df, id=id_col, vector=vector_col)
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull()).filter((F.size("vector") > 0) & whole)
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    return rows.filter(F.size("vector") == (lengths[0]["length"] if lengths else 0)).groupBy("id").agg(F.min("vector").alias("vector"))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def best(query: np.ndarray, item: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` highest scores, ties to smaller items."""
    order = np.lexsort((item, -score, query))
    first = np.searchsorted(query[order], query[order])
    return order[np.arange(len(order)) - first < k]
