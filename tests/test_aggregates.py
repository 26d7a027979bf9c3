"""Sums that do not depend on the order of the rows."""

import math
import random

from pyspark.sql import functions as F

from opsreport.functions.aggregates import stable_sum

SCHEMA = "k string, v double"


def sums(df):
    return {r.k: r.s for r in df.groupBy("k").agg(stable_sum("v").alias("s")).collect()}


def test_equal_bits_for_any_order_and_partitioning(spark):
    rng = random.Random(12)
    kinds = [
        lambda: rng.uniform(-1e3, 1e3),
        lambda: rng.choice([0.1, -0.1, 1e-9, 3.3e7]),
        lambda: rng.gauss(0, 1) * 10 ** rng.randrange(-8, 9),
        lambda: None,
    ]
    rows = [(rng.choice("abc"), rng.choice(kinds)()) for _ in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = None
    for parts, order in ((1, "v"), (7, "-v"), (3, "hash(v, 1)"), (16, "hash(v, 2)")):
        got = sums(df.repartition(parts).sortWithinPartitions(F.expr(order)))
        bits = {k: v.hex() for k, v in got.items()}
        assert want is None or bits == want
        want = bits
    for k, v in got.items():
        exact = math.fsum(x for j, x in rows if j == k and x is not None)
        assert abs(v - exact) <= 1e-12 * sum(abs(x) for j, x in rows if j == k and x)


def test_a_sum_of_nothing_and_values_beyond_whole_numbers(spark):
    rows = [("none", None), ("zero", 0.0), ("zero", -0.0), ("large", 2.0**60), ("large", 1.0)]
    rows += [("nan", float("nan")), ("nan", 1.0), ("inf", float("inf")), ("inf", 1.0)]
    rows += [("less", -5.5), ("less", 5.25)]
    got = sums(spark.createDataFrame(rows, SCHEMA))
    assert got["none"] is None and got["zero"] == 0.0 and got["less"] == -0.25
    assert got["large"] == 2.0**60 and math.isnan(got["nan"]) and got["inf"] == math.inf
