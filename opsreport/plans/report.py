"""The daily report for any number of report dates, as one DataFrame.

What happened on a day does not depend on the report date, only on the month. So the
readings are scanned and summed up once per day, whatever the number of report dates,
and the report dates join the day rows at the end: actuals show up to the report date,
plans to the end of its month.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsreport.functions.clean import at
from opsreport.functions.metrics import silver_ounces
from opsreport.operators.asof import latest_effective
from opsreport.operators.pivots import area_plan_pivot, kpi_pivot, production_plan_pivot
from opsreport.operators.readings import crusher_feed, mill_production
from opsreport.operators.timeaxis import dates_frame, period_spine
from opsreport.plans.columns import report_columns
from opsreport.sources.codes import AREAS

READING_TABLES = ("scale_readings", "mill_readings", "particle_size", "concentrate")
DAY_TABLES = ("shipments", "area_plans", "production_plans", "daily_factor", "downtime_kpis")


def pinned(calendar: DataFrame) -> DataFrame:
    """A calendar table worked out once and held in the plan as literal rows.

    Its size is bounded by what the caller names: one row per day of the months asked for.
    It is used in several joins and gives the time range of the scans.
    """
    return calendar.sparkSession.createDataFrame(calendar.toArrow(), calendar.schema)


def month_runs(dates: Sequence[date]) -> list[tuple[date, date]]:
    """First day and day after the last of every run of adjacent months."""
    months = sorted({12 * d.year + d.month - 1 for d in dates})
    first = lambda m: date(m // 12, m % 12 + 1, 1)
    runs: list[list[int]] = []
    for m in months:
        if runs and runs[-1][1] == m:
            runs[-1][1] = m + 1
        else:
            runs.append([m, m + 1])
    return [(first(a), first(b)) for a, b in runs]


def narrowed(
    inputs: dict[str, DataFrame], spine: DataFrame, dates: Sequence[date]
) -> dict[str, DataFrame]:
    """Inputs cut to the time range of the run by literals that reach the scans.

    Every run of adjacent months has a range of its own.
    """
    # A pinned calendar is literal rows: no job runs for them.
    shifts = spine.select("month", "start", "end", "floor").collect()
    days = days_back = ts_in = F.lit(False)
    ts, day = F.col("ts"), F.col("day")
    for first, after in month_runs(dates):
        midnight = [F.lit(d).cast("timestamp_ntz") for d in (first, after)]
        days = days | ((day >= midnight[0]) & (day < midnight[1]))
        own = [r for r in shifts if first <= r["month"].date() < after]
        starts, ends, floors = (
            [r[c] for r in own if r[c] is not None] for c in ("start", "end", "floor")
        )
        # Without any shift in force no reading belongs to a day.
        if starts and ends:
            end = at(max(ends))
            ts_in = ts_in | ((ts >= at(min(starts))) & (ts < end))
            days_back = days_back | ((ts > at(min(floors))) & (ts < end))
    out = dict(inputs)
    for name in READING_TABLES:
        out[name] = inputs[name].where(ts_in)
    out["assays"] = inputs["assays"].where(days_back)
    for name in DAY_TABLES:
        out[name] = inputs[name].where(days)
    return out


def with_shipments(grid: DataFrame, shipments: DataFrame) -> DataFrame:
    """Left join of the grid to the shipments of past days.

    Several shipments of one day give several rows. Written as inner join plus the rest
    so that the shipments are the streamed side: a day holding most of them is split
    like any other input instead of being buffered in one task.
    """
    silver = shipments.select(
        F.col("day").alias("_ship_day"), silver_ounces("mass", "ag_grade").alias("silver_oz")
    )
    past = (F.col("_ship_day") == F.col("day")) & (F.col("_ship_day") <= F.col("report_date"))
    hits = silver.join(grid, past).select(*grid.columns, "silver_oz")
    keys = ["report_date", "day"]
    rest = grid.join(hits.select(*keys).distinct(), keys, "left_anti")
    return hits.unionByName(rest.withColumn("silver_oz", F.lit(None).cast("double")))


def area_rates(dates: DataFrame, rates: DataFrame) -> DataFrame:
    """Nominal rate of every area on each report date, one row per date.

    The rate counts from its effective date on; the dating is our assumption, the
    source only offers a routine that returns the rate of a date.
    """
    areas = F.explode(F.array(*[F.lit(a.code) for a in AREAS.values()]))
    asked = dates.select("report_date", areas.alias("area"))
    rates = rates.withColumn("area", F.trim("area"))
    found = latest_effective(
        asked, rates, ["area"], "report_date", "effective", "rate", strict=False
    )
    return found.groupBy("report_date").agg(
        *[F.max(F.when(F.col("area") == a.code, F.col("rate"))).alias(f"{name}_rate")
          for name, a in AREAS.items()]
    )


def day_facts(
    spark: SparkSession,
    inputs: dict[str, DataFrame],
    dates: Sequence[date],
    plan_type: int | None = None,
) -> DataFrame:
    """One row per report date and day of its month, with everything the columns need."""
    dates = sorted(set(dates))
    if not dates:
        raise ValueError("no report dates")
    asked = dates_frame(spark, dates)
    spine = pinned(period_spine(asked, inputs["shifts"]))
    inputs = narrowed(inputs, spine, dates)

    month = F.trunc("report_date", "MM").cast("timestamp_ntz")
    grid = asked.withColumn("month", month).join(spine.select("month", "day", "hours"), "month")
    grid = with_shipments(grid.drop("month"), inputs["shipments"])
    actuals = [
        crusher_feed(inputs["scale_readings"], inputs["daily_factor"], spine),
        mill_production(inputs, spine),
        kpi_pivot(inputs["downtime_kpis"]),
    ]
    plans = [
        area_plan_pivot(inputs["area_plans"], plan_type),
        production_plan_pivot(inputs["production_plans"], plan_type),
    ]
    past = F.to_date("day") <= F.col("report_date")
    joined = grid
    for facts in (*actuals, *plans):
        joined = joined.join(facts, "day", "left")
    joined = joined.join(area_rates(asked, inputs["nominal_rates"]), "report_date", "left")
    hidden = {c for facts in actuals for c in facts.columns if c != "day"}
    return joined.select(
        *[F.when(past, F.col(c)).alias(c) if c in hidden else F.col(c) for c in joined.columns],
        past.alias("past"),
    )


def plant_report(
    spark: SparkSession,
    inputs: dict[str, DataFrame],
    dates: Sequence[date],
    plan_type: int | None = None,
    in_order: bool = True,
) -> DataFrame:
    """The report of every date: ``report_date`` and the 251 report columns.

    ``plan_type`` selects the budget; without it every budget column is zero. Who writes the
    rows away does not need them ``in_order``.
    """
    facts = day_facts(spark, inputs, dates, plan_type)
    report = facts.select("report_date", *[value.alias(name) for name, value in report_columns()])
    return report.orderBy("report_date", "PeriodIndex") if in_order else report
