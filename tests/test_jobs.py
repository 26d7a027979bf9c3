from datetime import date, datetime

import pytest
from conftest import plant_of, plant_rows, t

from opsreport import __main__ as main_module
from opsreport.operators.treatment import RENAME_MAP
from opsreport.plans import jobs
from opsreport.plans.jobs import Outcome, Store, in_parts, isolated, run, run_report
from opsreport.sources.schema import TABLES, conform
from opsreport.sources.tables import jdbc_options, read_inputs

DATES = [date(2024, 1, 1), date(2024, 1, 2), date(2024, 2, 1)]


def test_parts_are_months_then_dates():
    assert in_parts(DATES) == [DATES[:2], DATES[2:]]
    assert in_parts(DATES[:2]) == [DATES[:1], DATES[1:2]]


def test_one_bad_date_does_not_stop_the_others():
    tried = []

    def work(part):
        tried.append(list(part))
        if DATES[1] in part:
            raise RuntimeError("bad reading")

    outcome = Outcome()
    isolated(DATES, work, outcome)
    assert tried == [DATES, DATES[:2], DATES[:1], DATES[1:2], DATES[2:]]
    assert (outcome.written, outcome.failed) == ([DATES[0], DATES[2]], [DATES[1]])


def test_a_run_writes_skips_and_consolidates(spark, tmp_path, monkeypatch):
    inputs = plant_of(spark)
    root = str(tmp_path)
    store = Store(root)
    outcome = run_report(spark, inputs, DATES[:2], store, at=datetime(2024, 1, 3))
    assert outcome.written == DATES[:2]
    raw = spark.read.parquet(store.raw)
    assert (raw.count(), len(raw.columns)) == (62, 253)
    treated = spark.read.parquet(store.treated)
    assert (treated.count(), len(treated.columns)) == (62, 10)

    # Stored dates are not computed again.
    def not_again(*args):
        raise AssertionError("computed again")

    monkeypatch.setattr(jobs, "plant_report", not_again)
    code = run(spark, inputs, root, start="01.01.2024", end="2024-01-02", today=date(2024, 1, 9))
    assert code == 0
    merged = {r.Data.day: r for r in spark.read.parquet(store.consolidated).collect()}
    # Only days up to the limit, the second from the report of the second.
    assert sorted(merged) == [1, 2]
    assert merged[2][RENAME_MAP["AlimentacaoPlantaReal"]] == pytest.approx(900.0)
    assert merged[2]["Produtividade"] == pytest.approx(900 / 16)


def test_nothing_to_consolidate_is_an_error_code(spark, tmp_path):
    assert jobs.run_consolidation(spark, Store(str(tmp_path)), date(2024, 1, 1)) == 1


def test_a_failing_report_is_reported_per_date(spark, tmp_path):
    inputs = plant_of(spark) | {"assays": plant_of(spark)["assays"].drop("circuit")}
    outcome = run_report(spark, inputs, DATES[:2], Store(str(tmp_path)))
    assert (outcome.written, outcome.failed) == ([], DATES[:2])


def test_inputs_are_read_under_source_names(spark, tmp_path):
    frames = plant_of(spark)
    for name, table in TABLES.items():
        renamed = frames[name].toDF(*[src for _, src, _ in table.columns])
        renamed.coalesce(1).write.parquet(f"{tmp_path}/{name}")
    back = read_inputs(spark, str(tmp_path))
    for name, table in TABLES.items():
        assert back[name].schema == table.schema
    assert back["scale_readings"].count() == len(plant_rows()["scale_readings"])


def test_the_command_line_runs_a_range(spark, tmp_path, monkeypatch):
    for name, df in plant_of(spark).items():
        df.coalesce(1).write.parquet(f"{tmp_path}/in/{name}")
    seen = {}
    monkeypatch.setattr(main_module, "run", lambda *a, **k: seen.update(k, args=a) or 0)
    args = ["--inputs", f"{tmp_path}/in", "--store", "out", "--days", "3", "--force"]
    assert main_module.main(args) == 0
    assert (seen["days"], seen["force"], seen["strict"]) == (3, True, True)
    assert seen["args"][1].keys() == TABLES.keys() and seen["args"][2] == "out"


def test_missing_source_columns_are_named(spark):
    df = spark.createDataFrame([(t("2024-01-01"),)], "CDL_DATETIME_00001 timestamp_ntz")
    with pytest.raises(ValueError, match="CDL_NUMBER_00012"):
        conform(df, "mill_readings")


def test_jdbc_scans_are_split_on_the_time_column():
    bounds = (datetime(2024, 1, 1), datetime(2024, 2, 1))
    got = jdbc_options("assays", {"url": "jdbc:x"}, bounds, 8)
    assert got["dbtable"] == "TBL_GPROD_OBJ_2" and got["url"] == "jdbc:x"
    assert got["partitionColumn"] == "CDL_DATETIME_00001" and got["numPartitions"] == "8"
    assert (got["lowerBound"], got["upperBound"]) == ("2024-01-01 00:00:00", "2024-02-01 00:00:00")
    assert "partitionColumn" not in jdbc_options("month_factors", {}, bounds)
