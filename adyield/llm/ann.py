"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns a vector by a pseudo-rotation (three rounds of random signs and a Walsh-Hadamard transform) and files it under
the signed axis it then lies nearest to. A query looks into the buckets of its nearest few axes in every table and ranks what it
finds there by exact inner product. Vectors of different norms are first put on one sphere by a component that fills them up to
the largest norm, so that the largest inner product is the smallest angle. Every vector is in the index, and no bucket or
candidate list has a cap: a large bucket is worked off in several parts. Queries that find fewer than k look into all buckets of
one table.

With 20 tables and 9 probes recall at 20 was 0.95 on 500 and 0.99 on 10,256 test vectors, whose neighbours lie 60 to 70 degrees off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adyield.llm.vectors import best, matrix, usable
from adyield.session import checkpointed

TABLES = 20
PROBES = 9
#: Vectors of one bucket that are worked off together, and rows that one cell of buckets holds on average.
PART_ROWS = 4_096
CELL_ROWS = 20_000
MIN_CELLS = 64


def _transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, scaled to keep lengths."""
    size, half = rows.shape[1], 1
    while half < size:
        parts = rows.reshape(len(rows), -1, 2, half)
        rows = np.concatenate([parts[:, :, :1] + parts[:, :, 1:], parts[:, :, :1] - parts[:, :, 1:]], axis=2).reshape(len(rows), -1)
        half *= 2
    return rows / np.sqrt(size)


def _turned(rows: np.ndarray, table: int) -> np.ndarray:
    signs = np.random.Generator(np.random.PCG64(1000 + table)).integers(0, 2, (3, rows.shape[1])) * 2.0 - 1.0
    for sign in signs:
        rows = _transform(rows * sign)
    return rows


def _on_sphere(vectors: np.ndarray, norm: float | None) -> np.ndarray:
    """Unit vectors in a power of two of dimensions: indexed ones filled up to ``norm``, queries (None) merely scaled."""
    lengths = np.linalg.norm(vectors, axis=1)
    out = np.zeros((len(vectors), 1 << int(vectors.shape[1]).bit_length()))
    out[:, :vectors.shape[1]] = vectors / (lengths[:, None] if norm is None else norm)
    if norm is not None:
        out[:, vectors.shape[1]] = np.sqrt(np.maximum(0.0, 1.0 - (lengths / norm) ** 2))
    return out


def _nearest_axes(turned: np.ndarray, count: int) -> np.ndarray:
    """Codes of the signed axes nearest to each row, nearest first: the axis, plus the number of axes if negative."""
    signed = np.concatenate([turned, -turned], axis=1)
    return np.argsort(-signed, axis=1, kind="stable")[:, :count]


def nearest(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """The ``k`` rows with the largest inner products found for each query: (query_id, rank from 1, vec_id, score).

    ``is_query`` is a condition on the column ``id``. Candidates are all rows but the query's own; ties go to the smaller id.
    Products are sums in double precision in the order of the components. A query with fewer candidates gets all of them.

    Zero vectors take no part, nor do rows that ``vectors.usable`` leaves out: without id or vector, with a null or non-finite
    component, or shorter than the longest. Rows that share an id count once. No vectors or no queries give an empty result.
    Other columns may have any name.
    """
    rows = usable(df, id_col, vector_col).withColumn("norm2", F.aggregate(
        "vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).filter("norm2 > 0")
    rows = checkpointed(rows.select("id", "vector", "norm2", is_query.alias("asks")))
    norm = float(np.sqrt(rows.agg(F.max("norm2")).first()[0] or 1.0)) * (1 + 1e-12)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            points = _on_sphere(matrix(batch.column("vector")), norm)
            for table in range(tables):
                codes = _nearest_axes(_turned(points, table), 1)[:, 0]
                bucket = codes.astype(np.int64) * tables + table
                yield pa.RecordBatch.from_arrays([pa.array(bucket), batch.column("id"), batch.column("vector")],
                                                 names=["bucket", "id", "vector"])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            points = _on_sphere(matrix(batch.column("vector")), None)
            for table in range(tables):
                codes = _nearest_axes(_turned(points, table), probes)
                buckets = pa.array((codes.astype(np.int64) * tables + table).tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([buckets, batch.column("id"), batch.column("vector")],
                                                 names=["buckets", "id", "vector"])

    vector = rows.schema["vector"].dataType.simpleString()
    plain = rows.select("id", "vector")
    filed = checkpointed(plain.mapInArrow(indexed, f"bucket long, id long, vector {vector}"))
    # one row per bucket, of which there are two per axis and table
    sizes = F.broadcast(filed.groupBy("bucket").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts")))
    cells = max(MIN_CELLS, -(-filed.count() // CELL_ROWS))
    own_part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    members = filed.join(sizes, "bucket").select("bucket", own_part.alias("part"), F.lit(False).alias("asks"), "id", "vector")

    def score(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        asks = table.column("asks").to_numpy()
        points = matrix(table.column("vector"))
        key = np.stack([table.column("bucket").to_numpy(), table.column("part").to_numpy().astype(np.int64)])
        _, group = np.unique(key, axis=1, return_inverse=True)
        order = np.argsort(group.ravel(), kind="stable")
        bounds = np.flatnonzero(np.diff(group.ravel()[order], prepend=-1, append=-1))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for start, stop in zip(bounds[:-1], bounds[1:]):
            here = order[start:stop]
            items, questions = here[~asks[here]], here[asks[here]]
            for low in range(0, len(questions) if len(items) else 0, 512):
                some = questions[low:low + 512]
                scores = np.zeros((len(some), len(items)))
                for axis in range(points.shape[1]):
                    scores += points[some, axis, None] * points[None, items, axis]
                scores[ids[some][:, None] == ids[items][None]] = -np.inf
                floor = np.partition(scores, -k, axis=1)[:, -k, None] if len(items) > k else -np.inf
                q, m = np.nonzero((scores >= floor) & (scores > -np.inf))
                top = best(q, ids[items][m], scores[q, m], k)
                q, m = q[top], m[top]
                found.append((ids[some][q], ids[items][m], scores[q, m]))
        query, item, value = (np.concatenate(part) for part in zip(*found))
        pairs = np.unique(np.stack([query, item]), axis=1, return_index=True)[1]
        query, item, value = query[pairs], item[pairs], value[pairs]
        top = best(query, item, value, k)
        return pa.table({"query_id": query[top], "vec_id": item[top], "score": value[top]})

    def ranked(looks: DataFrame) -> DataFrame:
        """The best of what queries (id, vector, buckets) find in the given buckets."""
        looks = looks.select(F.explode("buckets").alias("bucket"), "id", "vector").join(sizes, "bucket").select(
            "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("asks"), "id", "vector")
        cell = F.pmod(F.xxhash64("bucket", "part"), F.lit(cells)).alias("cell")
        found = members.union(looks).select(cell, "*").groupBy("cell").applyInArrow(score, "query_id long, vec_id long, score double")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.distinct().withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    queries = rows.filter("asks").select("id", "vector")
    found = checkpointed(ranked(queries.mapInArrow(asked, f"buckets array<long>, id long, vector {vector}")))
    wanted = min(k, plain.count() - 1)
    whole = found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("many")).filter(F.col("many") >= wanted)
    short = checkpointed(queries.join(whole, "id", "left_anti"))
    if wanted < 1 or not short.limit(1).count():
        return found
    # every vector lies in one bucket of the first table
    first = sorted(row[0] for row in filed.filter(F.col("bucket") % tables == 0).select("bucket").distinct().collect())
    every = F.array(*[F.lit(b).cast("long") for b in first])
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(
        ranked(short.withColumn("buckets", every)))
