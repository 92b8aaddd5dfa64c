"""Vector searches against brute force, and their edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from adyield.llm import ann, exact_topk, queries

SCHEMA = "vec_id long, embedding array<double>, label int, score double, rank int"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 0.0, 0)
                                  for i, v in zip(ids, vectors)], SCHEMA)


def brute(vectors, ids, asks, k):
    out = {}
    for q, v in zip(ids, vectors):
        if asks(q):
            scored = sorted((-float(np.dot(v, w)), i) for i, w in zip(ids, vectors) if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("scale", [1.0, 1e4])
def test_exact_search_equals_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(exact_topk, "QUERY_ROWS", 16)
    monkeypatch.setattr(exact_topk, "ITEM_ROWS", 32)
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(400, 6)) * scale
    vectors[100:180] = vectors[3]
    whole = np.floor(vectors * 256)
    found = result(exact_topk.top_k(frame(spark, vectors), F.col("id") % 10 == 0))
    assert found == brute(whole, range(400), lambda i: i % 10 == 0, 5)


ODD = [[1, 0], [0, 1], None, [], [None, 1], [float("nan"), 1], [float("inf"), 0], [0, 0], [1], [2, 2], [1, 0]]


def test_searches_leave_out_odd_vectors(spark):
    odd = frame(spark, ODD, [0, 20, 2, 3, 4, 5, 6, 40, 8, 9, None])
    assert result(exact_topk.top_k(odd, F.col("id") % 20 == 0)) == {
        0: [(9, 131072), (20, 0), (40, 0)], 20: [(9, 131072), (0, 0), (40, 0)], 40: [(0, 0), (9, 0), (20, 0)]}
    assert result(ann.nearest(odd, F.col("id") % 20 == 0)) == {0: [(9, 2.0), (20, 0.0)], 20: [(9, 2.0), (0, 0.0)]}
    for search in (exact_topk.top_k, ann.nearest):
        assert search(odd.limit(0), F.col("id") % 20 == 0).count() == 0
        assert search(frame(spark, [[1.0, 2.0]]), F.col("id") % 20 == 0).count() == 0
        twice = result(search(frame(spark, [[1, 0], [1, 0], [1, 0], [1, 0]], [0, 0, 7, 7]), F.col("id") == 0))
        assert [v for v, _ in twice[0]] == [7]


@pytest.mark.parametrize("norms", ["equal", "unequal"])
def test_approximate_search_recall_and_order(spark, monkeypatch, norms):
    monkeypatch.setattr(ann, "PART_ROWS", 64)
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(2000, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if norms == "unequal":
        vectors *= draw.uniform(0.5, 2.0, (2000, 1))
    vectors[500:900] = vectors[40]
    found = result(ann.nearest(frame(spark, vectors), F.col("id") % 20 == 0))
    expected = brute(vectors, range(2000), lambda i: i % 20 == 0, 20)
    recall = np.mean([len({v for v, _ in found[q]} & {v for v, _ in expected[q]}) / 20 for q in expected])
    assert recall >= 0.9
    assert [v for v, _ in found[40]] == [*range(500, 520)]
    for q, got in found.items():
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - float(np.dot(vectors[q], vectors[v]))) < 1e-12 for v, s in got)


@pytest.mark.parametrize("size", [5, 30])
def test_approximate_search_of_few_vectors_is_whole(spark, size):
    vectors = np.random.default_rng(3).normal(size=(size, 16))
    found = result(ann.nearest(frame(spark, vectors), F.col("id") % 2 == 0))
    assert {q: len(v) for q, v in found.items()} == {q: min(20, size - 1) for q in range(0, size, 2)}
    if size <= 21:
        expected = brute(vectors, range(size), lambda i: i % 2 == 0, 20)
        assert {q: [v for v, _ in got] for q, got in found.items()} == {q: [v for v, _ in got] for q, got in expected.items()}


def test_registered_searches(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, vectors = [r.vec_id for r in rows], [np.array(r.embedding, dtype=float) for r in rows]
    whole = [np.floor(v * 256) for v in vectors]
    assert result(queries.QUERIES["op7_histogram_top_k"](spark, sf)) == brute(whole, ids, lambda i: i % 50 == 0, 5)
    found, expected = result(queries.QUERIES["op5_cross_polytope_search"](spark, sf)), brute(vectors, ids, lambda i: i % 20 == 0, 20)
    assert set(found) == set(expected)
    assert np.mean([len({v for v, _ in found[q]} & {v for v, _ in expected[q]}) / len(expected[q]) for q in expected]) >= 0.9


def test_one_odd_vector_changes_nothing(spark):
    """A longer or shorter vector among the others takes no part; it does not take the others' place."""
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in draw.normal(size=3)]) for i in range(60)]
    odd = [(100, [1.0, 2.0, 3.0, 4.0]), (101, [5.0]), (102, []), (103, None)]
    frames = [spark.createDataFrame(r, "vec_id long, embedding array<double>") for r in (rows, rows + odd)]
    plain, mixed = (sorted(tuple(r) for r in exact_topk.top_k(f, F.col("id") % 20 == 0).collect()) for f in frames)
    assert plain == mixed and len(plain) == 15
    plain, mixed = (sorted(tuple(r) for r in ann.nearest(f, F.col("id") % 20 == 0, k=3).collect()) for f in frames)
    assert plain == mixed and len(plain) == 9


def test_scores_beyond_64_bits_are_refused(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1e300, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        exact_topk.top_k(rows, F.col("id") == 0)
    large = spark.createDataFrame([(0, [1e6, 2.0]), (1, [-1e6, 3.0])], "vec_id long, embedding array<double>")
    assert exact_topk.top_k(large, F.col("id") == 0).first()["score"] == -(256 * 10**6) ** 2 + 512 * 768
