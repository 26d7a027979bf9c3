import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsreport.functions.clean import (
    nan_to_null,
    parse_date,
    ratio,
    reading_or,
    sentinel_to_null,
    trimmed_eq,
)
from opsreport.functions.aggregates import positive_weighted_mean


def test_sentinel_becomes_null_and_defaults_apply(spark):
    df = spark.createDataFrame([(-999.0, 1), (None, 2), (3.5, 3)], "x double, i int")
    assert [r.x for r in sentinel_to_null(df, ["x"]).orderBy("i").collect()] == [None, None, 3.5]
    got = df.orderBy("i").select(reading_or("x", 5.0).alias("x")).collect()
    assert [r.x for r in got] == [5.0, 5.0, 3.5]


def test_nan_becomes_null_only_in_floating_columns(spark):
    df = spark.createDataFrame([(math.nan, "NaN", 1)], "x double, s string, i int")
    assert nan_to_null(df).first() == (None, "NaN", 1)


def test_labels_are_compared_without_blanks(spark):
    df = spark.createDataFrame([(" Moagem ",), ("Moagem",), ("moagem",), (None,)], "s string")
    assert df.where(trimmed_eq("s", "Moagem")).count() == 2


def test_division_by_zero_is_null(spark):
    assert spark.range(1).select(ratio(F.lit(1.0), F.lit(0.0)).alias("r")).first().r is None


@pytest.mark.parametrize(
    "text, day",
    [
        ("05.01.2024", datetime(2024, 1, 5)),
        ("5.1.2024", datetime(2024, 1, 5)),
        ("2024-01-05", datetime(2024, 1, 5)),
        (" 2024-1-5 ", datetime(2024, 1, 5)),
        ("32.01.2024", None),
        ("2024-13-01", None),
        ("30.02.2024", None),
        ("05.01.24", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_two_date_spellings(spark, text, day):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(parse_date("s").alias("d")).first().d == day


@pytest.mark.parametrize(
    "text, moment",
    [
        ("02/01/2024", datetime(2024, 1, 2)),
        ("02.01.2024 10:30:00", datetime(2024, 1, 2, 10, 30)),
        ("05-01-2024 10:00:00", datetime(2024, 1, 5, 10)),
        ("5.1.2024 7:05:09", datetime(2024, 1, 5, 7, 5, 9)),
        ("05/01/2024 10:00", datetime(2024, 1, 5, 10)),
        ("2024-01-05T00:00:00", datetime(2024, 1, 5)),
        ("2024/01/05", datetime(2024, 1, 5)),
        (" 2024-01-05 00:00:00.000 ", datetime(2024, 1, 5)),
        ("2024.1.5 23:59:59.1234567", datetime(2024, 1, 5, 23, 59, 59, 123456)),
        ("05.01-2024", None),
        ("05.01.2024 25:00", None),
        ("31.02.2024", None),
        ("05.01.2024 10", None),
    ],
)
def test_spellings_of_dates_and_times(spark, text, moment):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(parse_date("s").alias("d")).first().d == moment


def test_parsing_stays_in_generated_code(spark):
    texts = [(f"{d}.01.2024",) for d in range(1, 32)]
    df = spark.createDataFrame(texts, "s string")
    parsed = df.withColumn("s", parse_date("s")).where(F.col("s").isNotNull()).groupBy("s").count()
    # Without the fallback, code that does not compile is an error.
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert len(parsed.collect()) == 31
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


@pytest.mark.parametrize(
    "pairs, mean",
    [
        ([(2.0, 1.0), (4.0, 3.0)], 3.5),
        ([(0.0, 5.0), (4.0, 3.0)], 4.0),  # a zero grade does not weigh
        ([(None, 5.0), (4.0, 3.0)], 4.0),  # nor does a missing one
        ([(-1.0, 3.0), (4.0, 3.0)], 3.0),  # a negative one counts above the line only
        ([(0.0, 5.0), (None, 2.0)], None),
        ([(4.0, 0.0)], None),
    ],
)
def test_positive_weighted_mean(spark, pairs, mean):
    df = spark.createDataFrame(pairs, "v double, w double")
    assert df.agg(positive_weighted_mean("v", "w").alias("m")).first().m == mean
