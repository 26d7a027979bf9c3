from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from opsreport.llm import ann
from opsreport.llm.queries import op2_projected_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(vectors, asked, k):
    out = {}
    for q in asked:
        s = [(-float(sum(a * b for a, b in zip(vectors[q], v, strict=True))), i)
             for i, v in vectors.items() if i != q]
        out[q] = [(i, -d) for d, i in sorted(s)[:k]]
    return out


def found(rows):
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_query_recall(spark, data):
    table = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    vectors = {r.vec_id: [float(x) for x in r.embedding] for r in table}
    got = found(op2_projected_neighbours(spark, data).collect())
    want = exact(vectors, [i for i in vectors if i % 20 == 0], 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, rows in got.items():
        for i, s in rows:
            assert abs(s - np.dot(vectors[q], vectors[i])) < 1e-9
        assert rows == sorted(rows, key=lambda x: (-x[1], x[0]))


def test_many_blocks_norms_and_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL", 64)
    monkeypatch.setattr(ann, "ASKED", 16)
    rng = np.random.default_rng(4)
    points = rng.normal(size=(900, 10)) * rng.uniform(0.2, 4, (900, 1))
    points[300:600] = points[300]
    rows = [(i, [float(x) for x in p.astype(np.float32)], 0) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(ann.nearest(df, df.where("vec_id % 20 = 0"), k=20).collect())
    want = exact({i: v for i, v, _ in rows}, range(0, 900, 20), 20)
    hits = sum(
        sum(s >= want[q][-1][1] - 1e-9 for _, s in got[q]) for q in want
    )
    assert hits >= 0.9 * 20 * len(want)
    # Ties of the repeated vector go to the smaller ids.
    ids = [i for i, _ in got[400] if 300 <= i < 600]
    assert ids == sorted(ids)


def test_quantile():
    assert abs(ann.chi_square_quantile(0.95, 8) - 15.507) < 1e-2
    assert abs(ann.chi_square_quantile(0.5, 2) - 1.3863) < 1e-3


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.5], 1), (20, [0.0, 1.0], None),
        (3, None, 1), (4, [], 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1),
        (8, [None, 1.0], 1), (9, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (40, None, 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("?")).withColumn("id", F.lit(1))
    got = found(ann.nearest(df, df.where("vec_id % 20 = 0")).collect())
    assert got == {0: [(1, 1.0), (2, 0.5), (20, 0.0)], 20: [(2, 0.5), (0, 0.0), (1, 0.0)]}
    empty = df.limit(0)
    assert ann.nearest(empty, empty).count() == 0
    none = ann.nearest(df, empty)
    assert none.count() == 0 and none.columns == ["query_id", "rank", "vec_id", "score"]


def test_a_query_given_twice_is_one_query(spark):
    rows = [(i, [float(i % 7), 1.0, float(i % 3)], 0) for i in range(80)]
    df = spark.createDataFrame(rows, SCHEMA)
    asked = df.where("vec_id = 20")
    once = sorted(map(tuple, ann.nearest(df, asked).collect()))
    twice = sorted(map(tuple, ann.nearest(df, asked.unionByName(asked)).collect()))
    assert twice == once and len(once) == 20 and len({r[2] for r in once}) == 20
