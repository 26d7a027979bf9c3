import random
from datetime import datetime, timedelta

import pytest
from conftest import ASSAY, t, table
from pyspark.sql import functions as F

from opsreport.functions.clean import reading, reading_or
from opsreport.operators.readings import (
    attach_grades,
    factored_sum,
    grade_pivot,
    mill_readings,
    valid_grade,
)


def test_factored_sum_equals_the_joined_form(spark):
    """avg(factor) * sum(measure) over the full join of readings and factor rows."""
    readings = spark.createDataFrame(
        [(t("2024-01-01"), 10.0), (t("2024-01-01"), -999.0), (t("2024-01-01"), None),
         (t("2024-01-02"), 5.0), (t("2024-01-03"), 7.0)],
        "day timestamp_ntz, x double",
    )
    factors = spark.createDataFrame(
        [(t("2024-01-01"), 2.0), (t("2024-01-01"), 4.0), (t("2024-01-02"), None)],
        "day timestamp_ntz, factor double",
    )
    x = reading_or("x", 0.0)
    got = factored_sum(readings, factors, {"s": x})
    joined = readings.join(factors, "day").groupBy("day").agg(
        (F.avg(F.coalesce("factor", F.lit(1.0))) * F.sum(x)).alias("s")
    )
    want = {t("2024-01-01"): 60.0, t("2024-01-02"): 5.0}  # no factor row, no day
    assert {r.day: r.s for r in got.collect()} == want
    assert {r.day: r.s for r in joined.collect()} == want


def random_rows(spark, rng, name, n, *extra):
    def value():
        return rng.choice([-999.0, None, 0.0, float(rng.randrange(1, 9))])

    hours = [datetime(2024, 1, 1) + timedelta(hours=h) for h in range(8)]
    # One time stamp holds a third of all rows.
    return [
        (hours[0] if rng.random() < 0.33 else rng.choice(hours), *extra, value()) for _ in range(n)
    ]


def test_mill_readings_equal_the_multiplied_rows(spark):
    rng = random.Random(3)
    mill = random_rows(spark, rng, "mill_readings", 20)
    size = random_rows(spark, rng, "particle_size", 25)
    conc = random_rows(spark, rng, "concentrate", 15)
    moist = random_rows(spark, rng, "assays", 12, *ASSAY["moisture"])
    want = {}
    for ts, w in mill:
        for ts2, p in size:
            for ts3, c in conc:
                for ts4, *_, m in moist:
                    if not ts == ts2 == ts3 == ts4:
                        continue
                    w_, c_, p_ = (0.0 if v in (None, -999.0) else v for v in (w, c, p))
                    dry = w_ * (1 - (5.0 if m in (None, -999.0) else m) / 100)
                    row = want.setdefault(ts, [0.0] * 4)
                    for i, v in enumerate((dry, c_, p_ * dry, dry if p_ > 0 else 0.0)):
                        row[i] += v
    got = mill_readings(
        table(spark, "mill_readings", mill),
        table(spark, "particle_size", size),
        table(spark, "concentrate", conc),
        table(spark, "assays", moist),
    ).collect()
    assert {r.ts for r in got} == set(want) and len(got) == len(want)
    for r in got:
        assert r[1:] == pytest.approx(want[r.ts])


@pytest.mark.parametrize("moisture, dry", [(10.0, 900.0), (-999.0, 950.0), (None, 950.0)])
def test_missing_moisture_reads_as_five_percent(spark, moisture, dry):
    ts = t("2024-01-01 08:00")
    got = mill_readings(
        table(spark, "mill_readings", [(ts, 1000.0)]),
        table(spark, "particle_size", [(ts, -999.0)]),
        table(spark, "concentrate", [(ts, 1.0)]),
        table(spark, "assays", [(ts, *ASSAY["moisture"], moisture)]),
    ).first()
    assert (got.dry_t, got.p80_weight) == (pytest.approx(dry), 0.0)


def test_a_reading_without_a_moisture_row_is_lost(spark):
    ts = t("2024-01-01 08:00")
    got = mill_readings(
        table(spark, "mill_readings", [(ts, 1000.0)]),
        table(spark, "particle_size", [(ts, 150.0)]),
        table(spark, "concentrate", [(ts, 1.0)]),
        table(spark, "assays", []),
    )
    assert got.count() == 0


def repair(spark, assays, moments, floor="2023-12-01 06:00", factors=((1, 2024, 0, 0, 0, 0),)):
    from decimal import Decimal

    readings = spark.createDataFrame(
        [(m, t("2024-01-15"), t(floor)) for m in moments],
        "ts timestamp_ntz, day timestamp_ntz, floor timestamp_ntz",
    )
    rows = [(m, y, *[None if f is None else Decimal(f) for f in fs]) for m, y, *fs in factors]
    table_ = table(spark, "month_factors", rows)
    out = attach_grades(readings, table(spark, "assays", assays), table_)
    return {r.ts: r for r in out.collect()}


def test_bad_assays_are_carried_but_absent_ones_stay_null(spark):
    h = [t(f"2024-01-15 0{i}:00") for i in range(6)]
    cu = ASSAY["feed_cu"]
    assays = [
        (h[0], *cu, 0.5),
        (h[1], *cu, -999.0),
        (h[2], *cu, None),
        (h[4], *cu, 0.7),
        (h[4], *cu, -999.0),  # the valid one of two wins
        (h[5], *cu, -999.0),
    ]
    got = repair(spark, assays, h)
    assert [got[m].feed_cu for m in h] == [0.5, 0.5, 0.5, None, 0.7, 0.7]
    assert all(r.feed_au is None for r in got.values())


def test_carried_values_come_from_the_same_location_and_analyte(spark):
    h = [t(f"2024-01-15 0{i}:00") for i in range(3)]
    assays = [
        (h[0], *ASSAY["tails_cu"], 0.1),
        (h[1], *ASSAY["feed_cu"], 0.6),
        (h[1], 3, "Alimentação Sag", "Au", 9.0),  # wrong circuit
        (h[2], *ASSAY["tails_cu"], -999.0),
        (h[2], *ASSAY["feed_au"], -999.0),
    ]
    got = repair(spark, assays, h)[h[2]]
    assert (got.tails_cu, got.feed_au, got.feed_cu) == (0.1, None, None)


def test_the_look_back_floor_is_exclusive(spark):
    now, cu = t("2024-01-15 08:00"), ASSAY["feed_cu"]
    for old, carried in (("2023-12-01 06:00", None), ("2023-12-01 06:00:00.000001", 0.5)):
        assays = [(t(old), *cu, 0.5), (now, *cu, -999.0)]
        assert repair(spark, assays, [now])[now].feed_cu == carried


def test_gold_in_tails_uses_a_valid_row_of_the_same_moment(spark):
    now, au = t("2024-01-15 08:00"), ASSAY["tails_au"]
    assays = [(t("2024-01-15 07:00"), *au, 0.9), (now, *au, -999.0), (now, *au, 0.2)]
    assert repair(spark, assays, [now])[now].tails_au == 0.2


def test_stock_factors_correct_four_grades_and_a_missing_month_nulls_them(spark):
    now = t("2024-01-15 08:00")
    assays = [(now, *ASSAY[g], 2.0) for g in ASSAY if g != "moisture"]
    got = repair(spark, assays, [now], factors=[(1, 2024, 10, 20, 30, None)])[now]
    # Factors come as gold feed, copper feed, copper column, gold column.
    assert (got.feed_au, got.feed_cu, got.conc_cu, got.conc_au) == pytest.approx((2.2, 2.4, 2.6, 2))
    assert (got.feed_s, got.tails_cu, got.tails_au) == (2.0, 2.0, 2.0)
    got = repair(spark, assays, [now], factors=[(2, 2024, 10, 20, 30, 40)])[now]
    assert (got.feed_au, got.feed_cu, got.conc_cu, got.conc_au) == (None, None, None, None)
    assert (got.feed_s, got.tails_cu, got.tails_au) == (2.0, 2.0, 2.0)


def test_pivot_tells_bad_rows_from_no_rows(spark):
    ts = t("2024-01-01")
    rows = [(ts, "a", -999.0), (ts, "a", 3.0), (ts, "b", None)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, g string, v double")
    groups = {g: F.col("g") == g for g in "abc"}
    out = grade_pivot(df, groups, reading("v"))
    r = out.select(*groups, *[valid_grade(g).alias(f"{g}_v") for g in groups]).first()
    assert (r.a_v, r.b_v, r.c_v) == (3.0, None, None)
    assert (r.b is not None, r.c is None) == (True, True)
