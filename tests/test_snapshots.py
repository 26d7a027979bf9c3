from datetime import date

import pytest
from conftest import t

from opsreport.operators.consolidate import consolidate
from opsreport.sources.snapshots import (
    read_snapshots,
    stored_dates,
    write_consolidated,
    write_snapshot,
)

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "report_date date, Data timestamp_ntz, x double")


def values(spark, path, limit=None):
    rows = read_snapshots(spark, path, limit).collect()
    return sorted((r._source_name, r.Data.day, r.x) for r in rows)


def test_only_absent_dates_are_added(spark, tmp_path):
    path = str(tmp_path / "s")
    assert stored_dates(spark, path, [D1]) == set()
    first = frame(spark, (D1, t("2024-01-01"), 1.0), (D2, t("2024-01-01"), 2.0))
    assert write_snapshot(first, path) == 2
    again = frame(spark, (D2, t("2024-01-01"), 9.0), (D3, t("2024-01-01"), 3.0))
    assert write_snapshot(again, path) == 1
    assert write_snapshot(again, path) == 0
    assert [v[2] for v in values(spark, path)] == [1.0, 2.0, 3.0]
    assert stored_dates(spark, path, [D2, D3, date(2024, 1, 4)]) == {D2, D3}


def test_force_replaces_only_the_given_dates(spark, tmp_path):
    path = str(tmp_path / "s")
    write_snapshot(frame(spark, (D1, t("2024-01-01"), 1.0), (D2, t("2024-01-02"), 2.0)), path)
    assert write_snapshot(frame(spark, (D2, t("2024-01-02"), 9.0)), path, force=True) == 1
    assert [v[2] for v in values(spark, path)] == [1.0, 9.0]


def test_later_snapshots_are_pruned_and_bad_names_skipped(spark, tmp_path):
    path = str(tmp_path / "s")
    write_snapshot(frame(spark, *[(d, t("2024-01-01"), 1.0) for d in (D1, D2, D3)]), path)
    assert [v[0] for v in values(spark, path, D2)] == ["2024-01-01", "2024-01-02"]
    plan = read_snapshots(spark, path, D2)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "report_date" in filters
    spark.createDataFrame([(t("2024-01-01"), 5.0)], "Data timestamp_ntz, x double").write.parquet(
        f"{path}/report_date=unknown"
    )
    assert [v[0] for v in values(spark, path)] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    # Such a folder neither hides stored dates nor stops later runs.
    assert stored_dates(spark, path, [D1, D3, date(2024, 5, 1)]) == {D1, D3}
    more = frame(spark, (D3, t("2024-01-03"), 8.0), (date(2024, 1, 4), t("2024-01-04"), 4.0))
    assert write_snapshot(more, path) == 1
    assert write_snapshot(frame(spark, (D1, t("2024-01-01"), 6.0)), path, force=True) == 1


def test_a_missing_date_column_reads_as_the_report_date(spark, tmp_path):
    path = str(tmp_path / "s")
    write_snapshot(spark.createDataFrame([(D2, 1.0)], "report_date date, x double"), path)
    assert values(spark, path) == [("2024-01-02", 2, 1.0)]


def test_a_later_run_outranks_and_one_run_goes_by_report_date(spark, tmp_path):
    path = str(tmp_path / "s")
    day = t("2024-01-01")
    write_snapshot(frame(spark, (D3, day, 3.0)), path, at=t("2024-02-01"))
    write_snapshot(frame(spark, (D1, day, 1.0), (D2, day, 2.0)), path, at=t("2024-02-02"))
    assert consolidate(read_snapshots(spark, path)).first().x == 2.0


def test_schemas_may_grow(spark, tmp_path):
    path = str(tmp_path / "s")
    write_snapshot(frame(spark, (D1, t("2024-01-01"), 1.0)), path)
    more = frame(spark, (D2, t("2024-01-02"), 2.0)).selectExpr("*", "7.0D AS y")
    write_snapshot(more, path)
    got = {r.Data.day: (r.x, r.y) for r in consolidate(read_snapshots(spark, path)).collect()}
    assert got == {1: (1.0, 0.0), 2: (2.0, 7.0)}


def test_an_existing_consolidated_table_is_kept(spark, tmp_path):
    path = str(tmp_path / "c")
    assert read_snapshots(spark, path) is None
    assert write_consolidated(spark.range(1), path)
    assert not write_consolidated(spark.range(2), path)
    assert spark.read.parquet(path).count() == 1
    assert write_consolidated(spark.range(2), path, overwrite=True)
    assert spark.read.parquet(path).count() == 2


@pytest.mark.parametrize("force", [False, True])
def test_nothing_to_write(spark, tmp_path, force):
    path = str(tmp_path / "s")
    assert write_snapshot(frame(spark).where("false"), path, force) == 0
    assert read_snapshots(spark, path) is None
