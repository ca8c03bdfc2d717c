import math
import random

from pyspark.sql import functions as F

from tidemark.llm import topk


def brute(rows, is_query, k):
    good = {(i, tuple(math.floor(64 * float(x)) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in good:
        if is_query(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in good if c != q)
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def compare(spark, rows, k=20, every=5):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % every == 0, k).collect())
    assert got == brute(rows, lambda q: q % every == 0, k)


def test_random_and_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    rng = random.Random(2)
    compare(spark, [(i, [rng.gauss(0, 1) + (i % 3) for _ in range(10)]) for i in range(300)])


def test_ties_copies_and_bad_vectors(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-1, 1)) for _ in range(3)]) for i in range(120)]
    rows += [(200 + i, [1.0, 0.0, 0.5]) for i in range(60)]
    rows += [(400, None), (401, [1.0, None, 2.0]), (402, [float("nan"), 1.0, 1.0]), (403, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (405, [2.0]), (410, []), (5, rows[5][1])]
    compare(spark, rows, k=7)


def test_few_rows(spark):
    compare(spark, [(0, [1.0, 2.0]), (5, [0.5, -1.0]), (6, [3.0, 3.0])])
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>"), F.col("vec_id") % 2 == 0).count() == 0


def test_many_distinct_vectors_of_one_score(spark, monkeypatch):
    # all vectors differ in the last component, which is 0 in the queries: every score is equal
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 500)
    rows = [(i, [1.0, 0.0, 0.0, float(i)]) for i in range(1, 1200)] + [(0, [2.0, 0.0, 1.0, 0.0]), (5000, [2.0, 0.0, 1.0, 0.0])]
    frame = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id long, embedding array<double>, x string, node int, s int")
    got = sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 5000 == 0, 5).collect())
    assert got == brute(rows, lambda q: q % 5000 == 0, 5)


def test_more_nodes(spark):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(9)]) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for nodes in (1, 3, 20):
        got = sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 7 == 0, 4, nodes=nodes).collect())
        assert got == brute(rows, lambda q: q % 7 == 0, 4)
