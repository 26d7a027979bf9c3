import pytest

from opsreport.operators.treatment import RENAME_MAP, treat, zero_row_when


def raw(spark, *rows):
    names = ", ".join(f"{c} double" for c in list(RENAME_MAP)[1:])
    return spark.createDataFrame(list(rows), f"other int, PeriodIndex string, {names}")


def test_idle_days_are_zeroed_but_keep_their_date(spark):
    df = raw(
        spark,
        (1, "a", 5.0, 1.0, None, 2.0, 3.0, 4.0, 5.0),
        (2, "b", 0.0, 1.0, None, 2.0, 3.0, 4.0, 5.0),
        (3, "c", None, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0),
    )
    out = treat(df)
    assert out.columns == list(RENAME_MAP.values())
    assert [tuple(r) for r in out.orderBy("Data").collect()] == [
        ("a", 5.0, 1.0, None, 2.0, 3.0, 4.0, 5.0),
        ("b", *[0.0] * 7),
        ("c", *[0.0] * 7),
    ]


def test_strict_refuses_missing_columns_and_lenient_drops_them(spark):
    df = raw(spark, (1, "a", 0.0, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0)).drop("RecuperacaoOuroReal")
    with pytest.raises(ValueError, match="RecuperacaoOuroReal"):
        treat(df)
    out = treat(df, strict=False)
    assert out.columns == [c for c in RENAME_MAP.values() if c != "Recuperação Ouro"]
    assert out.first()[1:] == (0.0,) * 6


def test_without_a_feed_column_nothing_is_zeroed(spark):
    df = raw(spark, (1, "a", 0.0, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0)).drop("AlimentacaoPlantaReal")
    assert treat(df, strict=False).first()[1:] == (1.0, 1.0, 2.0, 3.0, 4.0, 5.0)


def test_zeroing_keeps_types(spark):
    df = spark.createDataFrame([(0, 7, "x")], "f int, n bigint, k string")
    out = zero_row_when(df, "f", ["k"])
    assert out.dtypes == df.dtypes and out.first() == (0, 0, "x")
