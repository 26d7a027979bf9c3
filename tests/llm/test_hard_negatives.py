from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from opsreport.llm import queries
from opsreport.llm.hard_negatives import Bucket, _indexed, hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, is_anchor, positives=5, negatives=10, band=(30, 90)):
    """Rows by definition, from (id, vector, label) without repeats."""
    kept = [
        (i, [math.floor(256 * x) for x in v], l)
        for i, v, l in rows
        if i is not None and l is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, q, own in kept:
        if not is_anchor(a):
            continue
        scored = [
            (-sum(x * y for x, y in zip(q, v, strict=False)), i, l) for i, v, l in kept if i != a
        ]
        scored.sort()
        for s, p, _ in [x for x in scored if x[2] == own][:positives]:
            fits = [
                x for x in scored
                if x[2] != own and band[0] * -s <= 100 * -x[0] <= band[1] * -s
            ]
            for k, (t, n, _) in enumerate(fits[:negatives]):
                out.append((a, p, k + 1, n, -s, -t))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def clustered(seed, n, d=6, spread=0.3):
    """Vectors of very unlike lengths around a few directions, so that bounds prune."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, d))
    rows = []
    for i in range(n):
        c = int(rng.integers(5))
        v = (centres[c] + spread * rng.normal(size=d)) * float(rng.choice([0.05, 0.3, 1.0, 4.0]))
        rows.append((i, [float(x) for x in v], c if rng.random() < 0.8 else int(rng.integers(5))))
    return rows


def test_whole_table_equals_the_plain_version(spark):
    sf = "/root/testdata/sf0.01"
    rows = [
        (r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
        for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ]
    df = queries.QUERIES["op12_hard_negatives"](spark, sf)
    assert df.columns == (
        "anchor_id positive_id rank negative_id positive_score negative_score".split()
    )
    assert got(df) == plain(rows, lambda i: i % 100 == 0)


def test_many_buckets_and_pruning(spark):
    rows = clustered(1, 900)
    df = spark.createDataFrame(rows, SCHEMA)
    found = hard_negatives(df, F.col("vec_id") % 9 == 0, bucket_rows=40)
    assert got(found) == plain(rows, lambda i: i % 9 == 0)


def test_candidates_hold_every_row_that_counts_and_fewer_than_all():
    import pyarrow as pa

    rows = clustered(2, 600)
    v = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int32)
    lengths2 = (v.astype(np.int64) ** 2).sum(axis=1)
    table = pa.table(
        {
            "vec_id": np.arange(600),
            "label": np.zeros(600, np.int64),
            "v": pa.array(v.tolist(), pa.list_(pa.int32())),
            "length2": lengths2,
        }
    )
    bucket = Bucket(_indexed(1)((pa.scalar(0),), table).to_pylist()[0])
    fewer = skipped = 0
    for i in range(0, 600, 7):
        scores = v.astype(np.int64) @ v[i].astype(np.int64)
        for k in (1, 5, 60):
            least = int(np.sort(scores)[-k])
            length = math.sqrt(lengths2[i])
            hits = bucket.candidates(v[i] / max(length, 1.0), length, least)
            want = set(np.nonzero(scores >= least)[0].tolist())
            if hits is not None:
                fewer += 1
                assert want <= set(hits.tolist())
        skipped += len(bucket.candidates(v[i] / length, length, 2 * length * bucket.longest)) == 0
    assert fewer > 20 and skipped > 80


def test_equal_vectors_and_ties(spark):
    rng = random.Random(4)
    rows = [(i, [1.0, 2.0, -0.5], i % 3) for i in range(300)]
    rows += [(300 + i, [rng.gauss(0, 1) for _ in range(3)], i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = hard_negatives(df, F.col("vec_id") % 50 == 0, bucket_rows=32, band=(30, 100))
    assert got(found) == plain(rows, lambda i: i % 50 == 0, band=(30, 100))


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.5 * i, 1.0, -0.25 * i], i % 2) for i in range(40)]
    odd = [
        (None, [1.0, 1.0, 1.0], 1),
        (100, None, 1),
        (200, [1.0, None, 1.0], 0),
        (300, [nan, 1.0, 1.0], 0),
        (400, [inf, 1.0, 1.0], 0),
        (500, [1.0, 1.0, 1.0], None),
        (600, [0.0, 0.0, 0.0], 0),
        (700, [], 1),
        (800, [2.0], 1),
        (900, [-5.0, 0.0, 0.0], 7),
    ]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    every = lambda i: i % 20 == 0
    assert got(hard_negatives(df, F.col("vec_id") % 20 == 0)) == plain(rows + odd, every)
    # Beyond what a long holds.
    huge = spark.createDataFrame([*rows, (1000, [1e30, 0.0, 0.0], 0)], SCHEMA)
    assert got(hard_negatives(huge, F.col("vec_id") % 20 == 0)) == plain(rows, every)
    # Scores that doubles do not hold.
    large = [(i, [x * 2.0**16 + i for x in v], l) for i, v, l in rows]
    df = spark.createDataFrame(large, SCHEMA)
    assert got(hard_negatives(df, F.col("vec_id") % 20 == 0)) == plain(large, every)


def test_repeats_clashes_and_nothing(spark):
    rows = clustered(3, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    twice = df.unionByName(df.where("vec_id % 4 = 0"))
    twice = twice.unionByName(df.where("vec_id = 20").withColumn("label", F.lit(9)))
    want = plain(rows, lambda i: i % 20 == 0)
    assert got(hard_negatives(twice, F.col("vec_id") % 20 == 0)) == want
    names = "v r x length2 bucket part tile goals score rank anchor_id _at".split()
    more = df.select("*", *[F.lit("?").alias(n) for n in names])
    assert got(hard_negatives(more, F.col("vec_id") % 20 == 0)) == want
    assert got(hard_negatives(df.limit(0), F.col("vec_id") % 20 == 0)) == []
    assert got(hard_negatives(df, F.col("vec_id") < 0)) == []
