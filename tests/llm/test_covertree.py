import math

import numpy as np
from pyspark.sql import functions as F

from skyfare.llm import covertree as C
from skyfare.llm.queries import QUERIES, SQL

from .helpers import SF_SMALL, clashing, same_as_oracle, ws


def test_query_equals_its_sql(spark):
    same_as_oracle(spark, QUERIES["op8_top_k"], SQL["op8_top_k"], SF_SMALL)


def plain(rows, k):
    """rows: {(id, tuple)}; queries are ids divisible by 3."""
    out = []
    for q in sorted({i for i, _ in rows if i % 3 == 0}):
        qv = min(v for i, v in rows if i == q)
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in rows if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def search(spark, rows, cfg):
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    v = df.select("vec_id", C.scaled(F.col("embedding"), 1).alias("v"), "key")
    got = C.top_k(v, F.col("vec_id") % 3 == 0, ws(spark), cfg)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def test_clusters_and_ties_against_all_pairs(spark):
    """Small nodes, many pruned pairs, repeated vectors and equal scores."""
    rng = np.random.default_rng(4)
    centres = rng.integers(-200, 200, (12, 6))
    rows = [(i, [float(x) for x in centres[rng.integers(12)] + rng.integers(-3, 4, 6)]) for i in range(600)]
    rows += [(1000 + i, [float(x) for x in centres[0]]) for i in range(300)]
    cfg = C.CoverTree(pivots=8, sample=200, block_rows=40, leaf_rows=8, query_rows=16, queries_at_once=3)
    assert search(spark, rows, cfg) == plain({(i, tuple(map(int, v))) for i, v in rows}, 5)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (3, [5.0, -1.0]), (3, [4.0, 9.0]), (1, [2.0]), (2, []), (4, None),
            (5, [math.nan, 1.0]), (6, [math.inf, 1.0]), (7, [None, 1.0]), (None, [9.0, 9.0]), (9, [2.0 ** 30, -2.0 ** 30]),
            (10, [2.0 ** 31, 2.0 ** 31])]
    kept = {(0, (1, 2)), (3, (5, -1)), (3, (4, 9)), (1, (2, 0)), (2, (0, 0)), (9, (2 ** 30, -2 ** 30)),
            (10, (2 ** 31, 2 ** 31))}
    assert search(spark, rows, C.CoverTree()) == plain(kept, 5)
    assert search(spark, rows[:1], C.CoverTree()) == []
    assert search(spark, [(4, None)], C.CoverTree()) == []
    assert search(spark, [(0, []), (3, [])], C.CoverTree()) == [(0, 1, 3, 0), (3, 1, 0, 0)]


def test_bound_holds():
    rng = np.random.default_rng(6)
    for _ in range(50):
        q, d = rng.normal(size=(20, 5)) * 30, rng.normal(size=(30, 5)) * 30 + 10
        qc, dc = q.mean(axis=0), d.mean(axis=0)
        qr, dr = np.linalg.norm(q - qc, axis=1).max(), np.linalg.norm(d - dc, axis=1).max()
        assert C.bound(qc, qr, dc[None], np.array([dr]))[0] >= (q @ d.T).max()
