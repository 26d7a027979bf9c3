import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import t
from pyspark.sql import functions as F

from opsreport.functions.clean import reading
from opsreport.operators.asof import carry_forward, effective_lookup, month_factors


def events(spark, n=600, seed=5):
    """Random readings with many equal time stamps, in one hot and some small series."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        series = "hot" if rng.random() < 0.6 else rng.choice("abc")
        # Clustered within seconds, minutes and days.
        ts = start + timedelta(
            days=rng.choice([0, 0, 1, 5]),
            minutes=rng.choice([0, 1, 1, 600, 1439]),
            microseconds=rng.randrange(4),
        )
        value = rng.choice([-999.0, None, float(rng.randrange(50))])
        rows.append((i, series, ts, value))
    rows.append((n, "a", None, 4.0))
    return rows, spark.createDataFrame(rows, "id int, series string, ts timestamp_ntz, v double")


def expected(rows, inclusive, floor=None):
    """What the definition says, row by row."""
    out = {}
    for i, series, ts, _ in rows:
        best = None
        for _, s, u, v in rows:
            if ts is None or u is None or s != series or v in (None, -999.0):
                continue
            if (u < ts or (inclusive and u == ts)) and (floor is None or u > ts - floor):
                best = max(best, (u, v)) if best else (u, v)
        out[i] = best
    return out


@pytest.mark.parametrize("inclusive", [False, True])
def test_carry_forward_equals_its_definition(spark, inclusive):
    rows, df = events(spark)
    got = carry_forward(df, ["series"], "ts", reading("v"), inclusive).collect()
    want = expected(rows, inclusive)
    assert len(got) == len(rows)
    for r in got:
        assert (r.carried_ts, r.carried) == (want[r.id] or (None, None))


def test_nothing_is_carried_from_the_floor_or_before(spark):
    rows, df = events(spark, seed=9)
    floor = F.col("ts") - F.expr("INTERVAL '1' DAY")
    got = carry_forward(df, ["series"], "ts", reading("v"), floor=floor).collect()
    want = expected(rows, False, timedelta(days=1))
    assert {r.id: r.carried for r in got} == {i: b and b[1] for i, b in want.items()}


def test_effective_lookup_strict_and_inclusive(spark):
    dim = spark.createDataFrame(
        [("a", t("2024-01-05"), 1), ("a", t("2024-01-10"), 2), ("b", t("2024-01-07"), 9),
         ("a", t("2024-01-10"), 1)],
        "k string, eff timestamp_ntz, rate int",
    )
    asked = [("a", d) for d in (4, 5, 6, 10, 11)] + [("b", 8), ("c", 8), ("a", 11), ("a", None)]
    facts = spark.createDataFrame(
        [(k, d and datetime(2024, 1, d).date()) for k, d in asked], "k string, d date"
    )

    def lookup(strict):
        out = effective_lookup(facts, dim, ["k"], "d", "eff", "rate", strict).collect()
        assert len(out) == len(asked)
        return {(r.k, r.d and r.d.day): r.rate for r in out}

    base = {("b", 8): 9, ("c", 8): None, ("a", None): None, ("a", 4): None, ("a", 11): 2}
    assert lookup(True) == base | {("a", 5): None, ("a", 6): 1, ("a", 10): 1}
    assert lookup(False) == base | {("a", 5): 1, ("a", 6): 1, ("a", 10): 2}


def test_a_missing_month_is_null_and_a_null_factor_is_zero(spark):
    factors = spark.createDataFrame(
        [(1, 2024, Decimal("1.5")), (1, 2024, Decimal("2.5")), (2, 2024, None)],
        "month int, year int, f decimal(38,18)",
    )
    days = spark.createDataFrame(
        [(t("2024-01-31"),), (t("2024-02-01"),), (t("2023-01-01"),)], "day timestamp_ntz"
    )
    got = {r.day: r.f for r in month_factors(days, factors, "day", ["f"]).collect()}
    assert got == {t("2024-01-31"): 2.5, t("2024-02-01"): 0.0, t("2023-01-01"): None}


@pytest.mark.parametrize("strict", [True, False])
def test_effective_lookup_at_any_time_equals_a_search(spark, strict):
    rng = random.Random(9)
    start = datetime(2024, 1, 1)
    moment = lambda: start + timedelta(hours=rng.randrange(24 * 150))
    dim = [(k, moment(), float(i)) for i, k in enumerate("aab" * 12)]
    dim += [("a", datetime(2024, 2, 1), 900.0), ("a", datetime(2024, 2, 1), 901.0)]
    facts = [(i, rng.choice("abc"), moment()) for i in range(400)]
    facts += [(400, "a", datetime(2024, 2, 1)), (401, "a", None), (402, None, moment())]
    facts += [(403 + i, k, at) for i, (k, at, _) in enumerate(dim)]
    got = effective_lookup(
        spark.createDataFrame(facts, "i int, k string, at timestamp_ntz"),
        spark.createDataFrame(dim, "k string, since timestamp_ntz, rate double"),
        ["k"], "at", "since", "rate", strict=strict,
    )

    def want(k, at):
        known = [(s, r) for d, s, r in dim if at and d == k and (s < at or not strict and s == at)]
        return max(known)[1] if known else None

    assert {r.i: r.rate for r in got.collect()} == {i: want(k, at) for i, k, at in facts}
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
