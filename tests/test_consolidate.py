import random
from datetime import date, datetime, timedelta

import pytest
from conftest import t

from opsreport.operators.consolidate import consolidate, summarize, union_by_name

SCHEMA = (
    "Data timestamp_ntz, x double, y double, note string, "
    "_source_mtime timestamp_ntz, _source_name string, _source_row bigint"
)
OLD, MID, NEW = t("2024-02-01"), t("2024-02-02"), t("2024-02-03")
DAY = t("2024-01-05")


def merged(spark, rows, limit=None):
    out = consolidate(spark.createDataFrame(rows, SCHEMA), limit).orderBy("Data").collect()
    return [tuple(r) for r in out]


def test_the_newest_nonzero_value_wins_per_column(spark):
    rows = [
        (DAY, 5.0, 1.0, "old", OLD, "a", 0),
        (DAY, 7.0, 0.0, None, MID, "b", 0),
        (DAY, 0.0, None, None, NEW, "c", 0),
    ]
    assert merged(spark, rows) == [(DAY, 7.0, 1.0, "old")]


def test_nothing_but_null_and_zero_gives_zero(spark):
    rows = [(DAY, None, 0.0, None, OLD, "a", 0), (DAY, None, None, None, NEW, "b", 0)]
    assert merged(spark, rows) == [(DAY, 0.0, 0.0, None)]


def test_nan_counts_as_missing(spark):
    rows = [(DAY, 3.0, 1.0, "", OLD, "a", 0), (DAY, float("nan"), 2.0, "", NEW, "b", 0)]
    assert merged(spark, rows) == [(DAY, 3.0, 2.0, "")]


def test_equal_times_go_by_greater_name_then_earlier_row(spark):
    rows = [
        (DAY, 1.0, 1.0, "a", NEW, "02.01.2024", 0),
        (DAY, 2.0, 2.0, "b", NEW, "10.01.2024", 1),
        (DAY, 3.0, 3.0, "c", NEW, "10.01.2024", 0),
    ]
    assert merged(spark, rows) == [(DAY, 3.0, 3.0, "c")]


def test_dates_after_the_limit_and_without_a_date_are_dropped(spark):
    rows = [
        (DAY, 1.0, 1.0, "a", OLD, "a", 0),
        (t("2024-01-06 23:59"), 1.0, 1.0, "a", OLD, "a", 1),
        (t("2024-01-07"), 1.0, 1.0, "a", OLD, "a", 2),
        (None, 1.0, 1.0, "a", OLD, "a", 3),
    ]
    assert [r[0] for r in merged(spark, rows, date(2024, 1, 6))] == [DAY, t("2024-01-06 23:59")]


def test_text_dates_are_parsed_day_first(spark):
    schema = SCHEMA.replace("Data timestamp_ntz", "Data string")
    texts = ["05.01.2024", "2024-01-05", "06/01/2024", "99.01.2024", "x", None]
    rows = [(text, 1.0, 1.0, "a", OLD, "a", i) for i, text in enumerate(texts)]
    out = consolidate(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.Data for r in out) == [DAY, t("2024-01-06")]


@pytest.mark.parametrize("partitions", [1, 7])
def test_the_result_does_not_depend_on_partitioning(spark, partitions):
    rng = random.Random(1)
    rows = []
    for i in range(500):
        # A third of the rows belong to one day.
        day = DAY if rng.random() < 0.33 else datetime(2024, 1, 1) + timedelta(rng.randrange(9))
        x, y = (rng.choice([None, 0.0, float(rng.randrange(1, 99))]) for _ in "xy")
        mtime = rng.choice([OLD, MID, NEW])
        rows.append((day, x, y, rng.choice([None, "n%d" % i]), mtime, rng.choice("ab"), i))

    def best(day, column):
        ranked = sorted((r for r in rows if r[0] == day), key=lambda r: (r[4], r[5], -r[6]))
        good = [r[column] for r in ranked if r[column] not in (None, 0.0)]
        return good[-1] if good else (None if column == 3 else 0.0)

    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = {r.Data: tuple(r)[1:] for r in consolidate(df).collect()}
    assert got == {d: tuple(best(d, c) for c in (1, 2, 3)) for d in {r[0] for r in rows}}


def test_union_and_summary(spark):
    a = spark.createDataFrame([(1, t("2024-01-01"))], "x int, Data timestamp_ntz")
    b = spark.createDataFrame([(t("2024-01-09"), 2)], "Data timestamp_ntz, y int")
    both = union_by_name([a, b])
    assert sorted((r.x or 0, r.y or 0) for r in both.collect()) == [(0, 2), (1, 0)]
    assert tuple(summarize(both).first()) == (2, 3, t("2024-01-01"), t("2024-01-09"))
