"""Exact top-k search by distributed histogram selection.

Queries and candidates are scored block against block. First only histograms leave the tasks: per query, how many scores fall into
each part of the range in which its kth highest must lie; the part that holds it becomes the next range. When few scores are left
at or above the lower end, or the range is one value wide, a last scoring lets only those through, and ties are broken by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adyield.llm.vectors import best, matrix, usable
from adyield.session import checkpointed

BINS = 64
QUERY_ROWS = 1_024
ITEM_ROWS = 2_048
#: Item blocks that one task scores with a block of queries.
ITEM_BLOCKS = 8
#: Rounds end when no query has more scores than this many times k at or above its lower bound.
SLACK = 8


def _blocks(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Rows packed into blocks of about ``size``: (block, ids, matrix of whole numbers)."""
    count = max(1, -(-rows.count() // size))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        values = np.floor(matrix(table.column("vector")) * 256.0).astype(np.int64)
        return pa.table({"block": table.column("block").slice(0, 1), "ids": pa.array([table.column("id").to_numpy().tobytes()], pa.binary()),
                         "values": pa.array([values.tobytes()], pa.binary())})

    numbered = rows.select(F.pmod(F.xxhash64("id"), F.lit(count)).alias("block"), "id", "vector")
    return checkpointed(numbered.groupBy("block").applyInArrow(pack, "block long, ids binary, values binary")), count


def _each(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))


def _scores(query: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers; in floating point where every partial sum is exact there."""
    top = int(np.abs(query).max(initial=0)) * int(np.abs(item).max(initial=0)) * max(1, query.shape[1])
    if top < 1 << 53:
        return (query.astype(np.float64) @ item.astype(np.float64).T).astype(np.int64)
    return query @ item.T


def top_k(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5) -> DataFrame:
    """The ``k`` highest inner products of each query with all other rows: (query_id, rank from 1, vec_id, score).

    Every component x is first made floor(256 * x); ``is_query`` is a condition on the column ``id``. Ties go to the smaller id,
    a query with fewer candidates gets all of them, a lone row gets none. Rows that ``vectors.usable`` leaves out take no part:
    without id or vector, with a null or non-finite component, or of another length than most. Rows that share an id count once.
    No vectors or no queries give an empty result. Other columns may have any name. Scores are whole numbers of 64 bits: components
    so large that a product could leave that range raise a ValueError, as no score of theirs could be given.
    """
    rows = checkpointed(usable(df, id_col, vector_col).select("id", "vector", is_query.alias("asks")))
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    top, length = rows.agg(F.max(largest), F.max(F.size("vector"))).first()
    if top is not None and (256 * top + 1) * length**0.5 >= 2.0**31.5:
        raise ValueError(f"a component of {top:g} gives scores beyond 64 bits")
    items, item_blocks = _blocks(rows, ITEM_ROWS)
    queries, query_blocks = _blocks(rows.filter("asks"), QUERY_ROWS)
    strips = -(-item_blocks // ITEM_BLOCKS)
    items = items.select("ids", "values", F.pmod("block", F.lit(strips)).alias("strip"), _each(query_blocks).alias("block"))
    queries = queries.select("block", F.col("ids").alias("query_ids"), F.col("values").alias("query_values"))

    def pairs(questions: DataFrame) -> DataFrame:
        """Every block of queries with every block of items, dealt by query block and strip of items."""
        return questions.withColumn("strip", _each(strips)).join(items, ["block", "strip"])

    def scored(batch: pa.RecordBatch) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per pair of blocks: its row, query ids, item ids, scores, and which of them are of a row with itself."""
        for row in batch.to_pylist():
            query, item = (np.frombuffer(row[c], np.int64) for c in ("query_ids", "ids"))
            values = [np.frombuffer(row[c], np.int64).reshape(len(x), -1) for c, x in (("query_values", query), ("values", item))]
            yield row, query, item, _scores(*values), query[:, None] == item[None]

    def limits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most, least = np.iinfo(np.int64).max, np.iinfo(np.int64).min
        for batch in batches:
            for row, query, item, scores, own in scored(batch):
                some = ~own.all(axis=1)
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(query[some]), "block": pa.array(np.full(int(some.sum()), row["block"], np.int64)),
                    "low": pa.array(np.where(own, most, scores)[some].min(axis=1)),
                    "high": pa.array(np.where(own, least, scores)[some].max(axis=1))})

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, total = None, np.zeros(0, np.int64), np.zeros((0, BINS + 1), np.int64)

        def counted() -> pa.RecordBatch:
            q, part = np.nonzero(total)
            return pa.RecordBatch.from_pydict({
                "query_id": pa.array(ids[q]), "part": pa.array(part.astype(np.int64)), "many": pa.array(total[q, part])})

        for batch in batches:
            for row, query, item, scores, own in scored(batch):
                low, width = _aligned(query, row["state"])
                place = (scores - low[:, None]) // width[:, None]
                # scores above the range count as its last part, those below it not at all
                place = np.where(own | (place < 0), -1, np.minimum(place, BINS))
                flat = ((place + 1) + np.arange(len(query))[:, None] * (BINS + 2)).ravel()
                counts = np.bincount(flat, minlength=len(query) * (BINS + 2)).reshape(len(query), -1)[:, 1:]
                if row["block"] != block:
                    yield counted()
                    block, ids, total = row["block"], query, np.zeros_like(counts)
                total += counts
        yield counted()

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, query, item, scores, own in scored(batch):
                low, _ = _aligned(query, row["state"])
                q, m = np.nonzero((scores >= low[:, None]) & ~own)
                top = best(q, item[m], scores[q, m], k)
                q, m = q[top], m[top]
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(query[q]), "vec_id": pa.array(item[m]), "score": pa.array(scores[q, m])})

    def with_state(state: DataFrame) -> DataFrame:
        packed = state.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("query_id", "low", "width"))).alias("state"))
        return pairs(queries.join(packed, "block"))

    # the first histogram's range is that of the scores themselves
    state = pairs(queries).mapInArrow(limits, "query_id long, block long, low long, high long").groupBy("query_id", "block").agg(
        F.min("low").alias("low"), F.max("high").alias("high"))
    state = checkpointed(state.select("query_id", "block", "low", F.expr(f"(high - low) div {BINS} + 1").alias("width")))
    while True:
        parts = with_state(state).mapInArrow(histogram, "query_id long, part long, many long") \
            .groupBy("query_id", "part").agg(F.sum("many").alias("many"))
        downward = Window.partitionBy("query_id").orderBy(F.desc("part"))
        reached = parts.withColumn("upto", F.sum("many").over(downward))
        holds = reached.groupBy("query_id").agg(
            F.max(F.when(F.col("upto") >= k, F.col("part"))).alias("part"),
            F.min(F.when(F.col("upto") >= k, F.col("upto"))).alias("upto"))
        moved = state.join(holds, "query_id", "left").select(
            "query_id", "block", F.when(F.col("part").isNull(), F.col("low")).otherwise(F.col("low") + F.col("part") * F.col("width")).alias("low"),
            F.expr(f"case when part is null then 1 else greatest(1, (width + {BINS - 1}) div {BINS}) end").alias("width"),
            F.expr(f"width > 1 and coalesce(upto, 0) > {SLACK * k}").alias("open"))
        state = checkpointed(moved)
        if not state.filter("open").limit(1).count():
            break
        state = state.drop("open")
    found = with_state(state).mapInArrow(passing, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _aligned(query: np.ndarray, state: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Lower end and width of a part for each query of a block; a query without a state has no candidates."""
    ids = np.array([s["query_id"] for s in state], np.int64)
    low, width = np.full(len(query), np.iinfo(np.int64).max // 2), np.ones(len(query), np.int64)
    at = np.searchsorted(query, ids)
    low[at], width[at] = [s["low"] for s in state], [s["width"] for s in state]
    return low, width
