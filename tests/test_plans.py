"""What the physical plans must look like to hold at scale."""

import re
from datetime import date

import pytest
from conftest import plant_of, t, table
from pyspark.sql import functions as F

from opsreport.functions.clean import reading
from opsreport.operators.asof import carry_forward
from opsreport.operators.consolidate import consolidate, limit_dates
from opsreport.operators.intervals import assign_period
from opsreport.operators.readings import crusher_feed
from opsreport.operators.timeaxis import dates_frame, period_spine
from opsreport.plans.report import narrowed, pinned, plant_report
from opsreport.sources.tables import read_inputs


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_plant(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plant")
    for name, df in plant_of(spark).items():
        df.write.parquet(f"{root}/{name}")
    return read_inputs(spark, str(root))


@pytest.fixture(scope="module")
def spine(spark):
    shifts = table(spark, "shifts", [(t("2023-12-01"), 1, 360)])
    return pinned(period_spine(dates_frame(spark, [date(2024, 1, 2)]), shifts))


def test_no_plan_joins_every_row_with_every_row(spark, stored_plant):
    text = plan(plant_report(spark, stored_plant, [date(2024, 1, 2)], 2))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_nothing_runs_in_python(spark, stored_plant):
    text = plan(plant_report(spark, stored_plant, [date(2024, 1, 2)], 2))
    assert "Python" not in text and "Pandas" not in text


def test_periods_are_assigned_without_moving_the_readings(stored_plant, spine):
    text = plan(assign_period(stored_plant["scale_readings"], spine, "ts"))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_the_spine_keeps_zone_free_types(spine):
    assert dict(spine.dtypes)["start"] == dict(spine.dtypes)["floor"] == "timestamp_ntz"


def test_crusher_feed_sums_before_it_shuffles(stored_plant, spine):
    scales, factors = stored_plant["scale_readings"], stored_plant["daily_factor"]
    text = plan(crusher_feed(scales, factors, spine))
    before = text.split("Exchange hashpartitioning")
    assert len(before) == 3  # one exchange per side, both of day totals
    assert all("partial_sum" in part or "partial_avg" in part for part in before[1:])


def test_time_range_and_columns_reach_the_scans(stored_plant, spine):
    cut = narrowed(stored_plant, spine, [date(2024, 1, 2)])
    text = plan(cut["scale_readings"].select("ts", "ipc_t"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: (\S+)", text)
    assert "GreaterThanOrEqual(ts,2024-01-01T06:00)" in pushed.group(1)
    assert "LessThan(ts,2024-02-01T06:00)" in pushed.group(1)
    assert pushed.group(2) == "struct<ts:timestamp_ntz,ipc_t:double>"
    # Assays reach back to the look-back floor.
    assert "GreaterThan(ts,2023-12-01T06:00)" in plan(cut["assays"])


def test_carry_forward_cuts_large_series_and_moves_rows_once(spark):
    rows = [("a", t(f"2024-01-0{d} 0{h}:00"), 1.0) for d in (1, 2) for h in range(9)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    text = plan(carry_forward(df, ["k"], "ts", reading("v")))
    windows = re.findall(r"Window \[.*?windowspecdefinition\((.*?), specifiedwindow", text)
    specs = [re.sub(r"#\d+L?", "", w).split(" ASC")[0] for w in windows]
    # Rows within their piece, and only pieces per series.
    assert sorted(specs) == ["k, _piece", "k, _piece, _micros"]
    # One exchange carries rows as they are; the others carry sums per piece.
    lines = [x for x in text.split("\n") if re.search("Exchange hash|HashAgg|Window|Join|Scan", x)]
    below = [b for a, b in zip(lines, lines[1:], strict=False) if "Exchange hash" in a]
    assert sum("Join" in x or "Scan" in x for x in below if "SortMergeJoin" not in x) == 1
    assert "NestedLoop" not in text
    # No task sorts rows to sum them up.
    assert "SortAggregate" not in text


def test_a_crowded_minute_is_cut(spark):
    from opsreport.operators.asof import _in_pieces

    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 700)).alias("k"),
        F.timestamp_add(
            "MICROSECOND",
            F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.col("id") * 10**9),
            F.lit("2024-01-01").cast("timestamp_ntz"),
        ).alias("ts"),
    )
    parts = 8
    sizes = _in_pieces(df, ["k"], "ts", parts).groupBy("k", "_piece").count().collect()
    assert max(r["count"] for r in sizes) <= 1.1 * 9000 / parts
    assert {r["_piece"] for r in sizes if r["k"] != "hot"} == {-1}


def test_consolidation_hashes_its_groups(spark):
    schema = (
        "Data timestamp_ntz, x double, n int, ok boolean, note string, "
        "_source_mtime timestamp_ntz, _source_name string, _source_row bigint"
    )
    rows = [(t("2024-01-01"), 1.0, 1, True, "a", t("2024-02-01"), "s", 0)]
    text = plan(consolidate(spark.createDataFrame(rows, schema).drop("note")))
    assert "HashAggregate" in text and "SortAggregate" not in text
    assert "ObjectHashAggregate" not in text
    # Text joins the few rows that won; no rows are sorted to be summed up.
    assert "SortAggregate" not in plan(consolidate(spark.createDataFrame(rows, schema)))


def test_a_date_is_split_once_for_every_use(spark):
    df = spark.createDataFrame([("01.02.2024", 1.0)], "Data string, x double")
    done = limit_dates(df, "Data", date(2024, 12, 31)).groupBy("Data").agg(F.sum("x"))
    text = done._jdf.queryExecution().optimizedPlan().toString()
    # Once in the filter, once in what it lets through.
    assert text.count("split(") <= 3
