"""Every operator of the library as a query over whole benchmark tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsreport.functions import metrics as M
from opsreport.functions.aggregates import positive_weighted_mean
from opsreport.functions.clean import or_zero, ratio, reading
from opsreport.operators.accumulate import (
    MEASURES,
    accumulated_grades,
    splice_projection,
)
from opsreport.operators.asof import carry_forward, effective_lookup, month_factors
from opsreport.operators.consolidate import consolidate, limit_dates, summarize, union_by_name
from opsreport.operators.intervals import assign_period, assign_spans
from opsreport.operators.pivots import area_plan_pivot, kpi_pivot, production_plan_pivot
from opsreport.operators.readings import (
    attach_grades,
    crusher_feed,
    grade_pivot,
    is_assay,
    mill_production,
    mill_readings,
    valid_grade,
)
from opsreport.operators.timeaxis import DateRange, dates_frame, period_spine
from opsreport.operators.treatment import treat
from opsreport.plans.columns import SCENARIO_SUFFIX, accumulated_columns, actual_columns
from opsreport.plans.columns import plan_columns
from opsreport.plans.incremental import refresh
from opsreport.plans.jobs import Store, run, set_aside
from opsreport.plans.report import area_rates, day_facts, pinned, plant_report
from opsreport.sources.codes import MOISTURE
from opsreport.sources.quarantine import screened
from opsreport.sources.snapshots import read_snapshots, write_consolidated, write_snapshot
from workload.standins import plant, standin, tables

REPORT_DATES = (date(2024, 1, 10), date(2024, 1, 20))
BUDGET = 2

Query = Callable[[SparkSession, str], DataFrame]


def half_up(x: Column, digits: int) -> Column:
    """Rounding that engines agree on: a hair of tolerance lifts what lies just below a tie."""
    return F.floor(x * 10.0**digits + 0.5001) / 10.0**digits


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    return df.select(
        [
            half_up(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shift days of every month with events, as literal rows."""
    events = tables(spark, sf_dir, "events")["events"]
    months = events.select(F.to_date(F.trunc("ts", "MM")).alias("report_date")).distinct()
    return pinned(period_spine(months, standin(spark, sf_dir, "shifts")))


def _feed(spark: SparkSession, sf_dir: str, spine: DataFrame) -> DataFrame:
    scales, factors = (standin(spark, sf_dir, n) for n in ("scale_readings", "daily_factor"))
    return crusher_feed(scales, factors, spine)


def daily_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = _spine(spark, sf_dir)
    feed = _feed(spark, sf_dir, spine)
    out = spine.join(feed, "day", "left")
    lines = ["ipc_feed", "mmd_feed", "jaw_feed", "crusher_feed"]
    return rounded(out.select("day", "hours", *[or_zero(c).alias(c) for c in lines]))


def shift_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shift days of every month with events, months and offsets both taken from the data."""
    events = tables(spark, sf_dir, "events")["events"]
    months = events.select(F.to_date("ts").alias("report_date"))
    spine = period_spine(months, standin(spark, sf_dir, "shifts"))
    return rounded(spine.select("day", "start", "end", "hours", "floor"))


def _bad_every_17th() -> Column:
    return F.when(F.col("event_id") % 17 == 0, -999.0).otherwise(F.col("value"))


def _carry(inclusive: bool, keys: list[str]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = tables(spark, sf_dir, "events")["events"]
        events = events.select("event_id", "ts", *keys, _bad_every_17th().alias("value"))
        return carry_forward(events, keys, "ts", reading("value"), inclusive).select(
            "event_id", "carried", F.col("carried_ts").alias("carried_at")
        )

    return query


def carry_forward_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad events repaired from the last half day only."""
    events = tables(spark, sf_dir, "events")["events"]
    events = events.select("event_id", "ts", "user_id", _bad_every_17th().alias("value"))
    floor = F.col("ts") - F.expr("INTERVAL '12' HOUR")
    out = carry_forward(events, ["user_id"], "ts", reading("value"), floor=floor)
    return out.select("event_id", F.coalesce(reading("value"), "carried").alias("value"))


def _priority_rates(orders: DataFrame) -> DataFrame:
    """One rate per priority and month, effective from its first order of the month on."""
    return orders.groupBy("o_orderpriority", F.trunc("o_orderdate", "MM").alias("month")).agg(
        F.min("o_orderdate").alias("effective"), F.max("o_totalprice").alias("rate")
    )


def _effective(strict: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = tables(spark, sf_dir, "orders")["orders"]
        out = effective_lookup(
            orders,
            _priority_rates(orders),
            ["o_orderpriority"],
            "o_orderdate",
            "effective",
            "rate",
            strict,
        )
        return out.select("o_orderkey", "rate")

    return query


def _line_factors(orders: DataFrame) -> DataFrame:
    """A factor for every month but one, NULL in months with an even number of orders."""
    at = F.col("o_orderdate")
    months = orders.select(F.year(at).alias("year"), F.month(at).alias("month"))
    skip = (F.col("year") == 1997) & (F.col("month") == 7)
    n = F.count(F.lit(1))
    return (
        months.withColumn("month", F.when(skip, 13).otherwise(F.col("month")))
        .groupBy("year", "month")
        .agg(F.when(n % 2 == 1, n % 9).cast("decimal(38,18)").alias("factor"))
    )


def month_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir, "lineitem", "orders")
    lines = month_factors(t["lineitem"], _line_factors(t["orders"]), "l_shipdate", ["factor"])
    adjusted = M.stock_adjusted(F.col("l_discount") * 100.0, F.col("factor"))
    return rounded(
        lines.groupBy(F.trunc("l_shipdate", "MM").cast("timestamp_ntz").alias("month")).agg(
            F.count(F.lit(1)).alias("n"),
            F.count("factor").alias("n_factor"),
            F.sum(adjusted).alias("adjusted"),
        )
    )


def _grade() -> Column:
    """Discount in percent as a grade; the top discount plays a negative reading."""
    return F.when(F.col("l_discount") > 0.095, -1.0).otherwise(F.col("l_discount") * 100.0)


def weighted_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables(spark, sf_dir, "lineitem")["lineitem"]
    return rounded(
        lines.groupBy(F.col("l_shipdate").alias("day")).agg(
            positive_weighted_mean(_grade(), F.col("l_quantity")).alias("grade")
        ),
        6,
    )


def grade_pivot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables(spark, sf_dir, "lineitem")["lineitem"]
    assays = lines.select(
        F.col("l_shipdate").alias("ts"),
        F.concat(F.lit(" "), "l_returnflag").alias("location"),
        "l_linestatus",
        F.when(F.col("l_linenumber") >= 3, -999.0).otherwise(F.col("l_discount")).alias("value"),
    )
    groups = {
        f"{flag}_{status}".lower(): (F.trim("location") == flag) & (F.col("l_linestatus") == status)
        for flag in "ANR"
        for status in "FO"
    }
    out = grade_pivot(assays, groups, reading("value"))
    return out.select(
        "ts",
        *[valid_grade(g).alias(g) for g in groups],
        *[F.col(g).isNotNull().cast("int").alias(f"{g}_row") for g in groups],
    )


def mill_readings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("mill_readings", "particle_size", "concentrate", "assays")
    mill, size, conc, assays = (standin(spark, sf_dir, n) for n in names)
    return rounded(mill_readings(mill, size, conc, assays.where(is_assay(MOISTURE))), 2)


def attach_grades_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour of a reading with its seven repaired and adjusted grades."""
    spine = _spine(spark, sf_dir)
    hours = standin(spark, sf_dir, "mill_readings").select("ts").distinct()
    placed = assign_period(hours, spine.select("day", "start", "end", "floor"), "ts")
    placed = placed.drop("start", "end")
    out = attach_grades(
        placed, standin(spark, sf_dir, "assays"), standin(spark, sf_dir, "month_factors")
    )
    return rounded(out.drop("floor"), 6)


def mill_production_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mill_production(plant(spark, sf_dir), _spine(spark, sf_dir)))


def _line_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed, concentrate and tails grade per ship date, one per return flag."""
    lines = tables(spark, sf_dir, "lineitem")["lineitem"]

    def grade(flag: str, scale: float) -> Column:
        value = F.when(F.col("l_returnflag") == flag, F.col("l_discount") * scale)
        return positive_weighted_mean(value, F.col("l_quantity"))

    return lines.groupBy(F.col("l_shipdate").alias("day")).agg(
        F.sum("l_quantity").alias("feed"),
        grade("A", 20.0).alias("f"),
        grade("N", 500.0).alias("c"),
        grade("R", 2.0).alias("t"),
        F.sum("l_tax").alias("silver"),
    )


def recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _line_grades(spark, sf_dir)
    feed, f, c, t = (F.col(x) for x in ("feed", "f", "c", "t"))
    rec = M.recovery(f, c, t)
    gold = M.gold_ounces(feed, f, rec)
    return rounded(
        g.select(
            "day",
            (rec * 100.0).alias("recovery_pct"),
            M.pyrite(c, f).alias("pyrite"),
            M.copper_contained(feed, f).alias("cu_contained"),
            M.gold_contained(feed, f).alias("au_contained"),
            gold.alias("au_oz"),
            M.gold_equivalent(gold, F.col("silver")).alias("geo_oz"),
            M.copper_produced(feed, f, rec).alias("cu_t"),
            (M.copper_produced(feed, f, rec) / M.TONNES_PER_KLB).alias("cu_klb"),
        )
    )


def kpi_pivot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(kpi_pivot(standin(spark, sf_dir, "downtime_kpis")))


def _plans(plan_type: int | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        areas = area_plan_pivot(standin(spark, sf_dir, "area_plans"), plan_type)
        production = production_plan_pivot(standin(spark, sf_dir, "production_plans"), plan_type)
        return rounded(areas.join(production, "day", "full"))

    return query


def oee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effectiveness of three lines against the rate in force on each day."""
    spine = _spine(spark, sf_dir)
    dates = spine.select(F.to_date("day").alias("report_date"))
    rates = area_rates(dates, standin(spark, sf_dir, "nominal_rates"))
    kpis = kpi_pivot(standin(spark, sf_dir, "downtime_kpis"))
    joined = (
        spine.join(_feed(spark, sf_dir, spine), "day", "left")
        .join(kpis, "day", "left")
        .withColumn("report_date", F.to_date("day"))
        .join(rates, "report_date", "left")
    )
    c = F.col
    used, available = c("mmd_used") + c("jaw_used"), c("mmd_available") + c("jaw_available")
    return rounded(
        joined.select(
            "day",
            ratio(c("ipc_available") * 100.0, c("hours")).alias("ipc_availability"),
            ratio(c("ipc_used") * 100.0, c("ipc_available")).alias("ipc_utilisation"),
            ratio(c("ipc_feed"), c("ipc_used")).alias("ipc_productivity"),
            M.oee(c("ipc_feed"), c("hours"), c("ipc_rate")).alias("ipc_oee"),
            (available * 100.0 / M.COMBINED_CRUSHER_HOURS).alias("combined_availability"),
            ratio(c("crusher_feed"), used).alias("combined_productivity"),
            M.oee(
                c("mmd_feed") + c("jaw_feed"), c("hours"), c("mmd_rate") + c("jaw_rate")
            ).alias("combined_oee"),
        )
    )


def _accumulation_sides(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Actuals, mill plan and plan grades per day.

    The plan lies half a year later than the orders and its grades half a year earlier, so
    that there are days on one side only.
    """
    t = tables(spark, sf_dir, "lineitem", "orders")
    grades = {m: F.col("l_discount") * (i + 1.0) for i, m in enumerate(MEASURES)}
    actual = t["lineitem"].groupBy(F.col("l_shipdate").alias("day")).agg(
        F.sum("l_quantity").alias("feed_t"),
        *[positive_weighted_mean(v, F.col("l_quantity")).alias(m) for m, v in grades.items()],
    )
    scenarios = {
        "budget": F.col("o_orderpriority") < "4",
        "very_short": F.col("o_orderpriority") >= "4",
    }
    half_year = F.expr("INTERVAL '6' MONTH")
    price = F.col("o_totalprice") / 1000.0
    plan = t["orders"].groupBy((F.col("o_orderdate") + half_year).alias("day")).agg(
        *[
            F.sum(F.when(kind, price).otherwise(0.0)).alias(f"feed_{s}")
            for s, kind in scenarios.items()
        ]
    )
    tenth = (F.col("o_custkey") % 100) / 10.0
    late = scenarios["very_short"]
    grade_plan = t["orders"].groupBy((F.col("o_orderdate") - half_year).alias("day")).agg(
        F.sum(F.when(late, price).otherwise(0.0)).alias("conc_t_very_short"),
        *[
            F.avg(F.when(kind, tenth * (i + 1.0))).alias(f"{m}_{s}")
            for i, m in enumerate(MEASURES)
            for s, kind in scenarios.items()
        ],
    )
    return [actual, plan, grade_plan]


def full_outer_accum(spark: SparkSession, sf_dir: str) -> DataFrame:
    actual, plan, grades = _accumulation_sides(spark, sf_dir)
    past = F.col("day") < F.lit("1999-07-01").cast("timestamp_ntz")
    return rounded(accumulated_grades(actual, plan, grades, ["day"], past))


def splice_projection_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly grade: shipped lines before the cut-off, orders from there on."""
    t = tables(spark, sf_dir, "lineitem", "orders")
    actual = t["lineitem"].groupBy(F.col("l_shipdate").alias("day")).agg(
        positive_weighted_mean(_grade(), F.col("l_quantity")).alias("grade"),
        F.sum("l_quantity").alias("feed"),
    )
    plan = t["orders"].groupBy(F.col("o_orderdate").alias("day")).agg(
        F.avg(F.when(F.col("o_orderstatus") == "P", F.col("o_custkey") % 10)).alias("plan_grade"),
        F.sum("o_totalprice").alias("plan_feed"),
    )
    past = F.col("day") < F.lit("1999-07-01").cast("timestamp_ntz")
    both = actual.join(plan, "day", "full")
    pairs = (("grade", "feed"), ("plan_grade", "plan_feed"))
    return rounded(
        both.groupBy(F.trunc("day", "MM").cast("timestamp_ntz").alias("month")).agg(
            splice_projection(past, *pairs).alias("projected"),
            splice_projection(past, *pairs, positive_test="feed").alias("projected_by_feed"),
        )
    )


def treat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily line totals as a raw report; days whose quantities add up to sevens are idle."""
    lines = tables(spark, sf_dir, "lineitem")["lineitem"]
    raw = lines.groupBy(F.col("l_shipdate").alias("PeriodIndex")).agg(
        (F.sum("l_quantity") % 7).alias("AlimentacaoPlantaReal"),
        F.avg("l_quantity").alias("ProdutividadePlantaReal"),
        F.min("l_discount").alias("TeorAlimentacaoCobreReal"),
        F.max("l_discount").alias("TeorAlimentacaoOuroReal"),
        F.min("l_tax").alias("RecuperacaoCobreReal"),
        F.max("l_tax").alias("RecuperacaoOuroReal"),
        F.max(F.col("l_tax") - F.col("l_discount")).alias("TeorAlimentacaoPiritaReal"),
        F.count(F.lit(1)).alias("unused"),
    )
    return rounded(treat(raw))


def _event_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of many snapshots: one column per type, some zero, some missing."""
    events = tables(spark, sf_dir, "events")["events"]
    value = F.when(F.col("event_id") % 3 == 0, 0.0).otherwise(F.col("value"))
    return events.select(
        F.to_date("ts").cast("timestamp_ntz").alias("Data"),
        *[
            F.when(F.col("event_type") == t, value).alias(t)
            for t in ("click", "view", "purchase", "error", "signup")
        ],
        F.when(F.col("event_type") == "click", F.col("props")).alias("note"),
        (F.col("value") > 60).alias("high"),
        F.col("ts").alias("_source_mtime"),
        F.col("event_type").alias("_source_name"),
        F.col("event_id").alias("_source_row"),
    )


def consolidate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate(_event_snapshots(spark, sf_dir), date(2024, 1, 25))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(consolidate(_event_snapshots(spark, sf_dir)))


def union_by_name_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir, "orders", "lineitem")
    orders = t["orders"].select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"), "o_orderpriority"
    )
    lines = t["lineitem"].select(
        F.col("l_quantity").alias("quantity"), F.col("l_orderkey").alias("key"), "l_returnflag"
    )
    both = union_by_name([orders, lines])
    return rounded(
        both.groupBy("o_orderpriority", "l_returnflag").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("key").alias("keys"),
            F.sum("price").alias("price"),
            F.sum("quantity").alias("quantity"),
        ),
        2,
    )


#: Spellings of an order's date by its key; the fourth is broken, after the last comes none.
SPELLINGS = (
    "{d2}.{m2}.{y}",
    "{y}-{m2}-{d2}",
    "{d2}/{m2}/{y}",
    "32.{m2}.{y}",
    "{d2}-{m2}-{y} {time}",
    "{d}.{m}.{y} 0:00:00",
    "{d2}/{m2}/{y} 00:00",
    "{y}-{m2}-{d2}T{time}",
    "{y}/{m2}/{d2}",
    "{y}-{m2}-{d2} {time}.000",
)


def _spelled(moment: str, spelling: str) -> Column:
    """A date written from its numbers, in which no time zone has a part."""
    number = {"d": F.day(moment), "m": F.month(moment), "y": F.year(moment)}
    two = {f"{k}2": F.lpad(number[k].cast("string"), 2, "0") for k in "dm"}
    fill = {k: v.cast("string") for k, v in number.items()} | two | {"time": F.lit("00:00:00")}
    pieces = re.split(r"\{(\w+)\}", spelling)
    return F.concat(*[fill[x] if i % 2 else F.lit(x) for i, x in enumerate(pieces)])


def limit_and_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in many spellings, some of them broken."""
    orders = tables(spark, sf_dir, "orders")["orders"]
    text = F.lit(None).cast("string")
    for k, spelling in enumerate(SPELLINGS):
        turn = F.col("o_orderkey") % (len(SPELLINGS) + 1) == k
        text = F.when(turn, _spelled("o_orderdate", spelling)).otherwise(text)
    df = orders.select(text.alias("Data"), "o_totalprice")
    return rounded(
        limit_dates(df, "Data", date(1999, 12, 31))
        .groupBy("Data")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")),
        2,
    )


def report_dates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date from the first order to a limit, with the orders of that date."""
    orders = tables(spark, sf_dir, "orders")["orders"]
    first, last = orders.agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    dates = DateRange(first, last, limit=date(2001, 6, 30)).dates()
    days = dates_frame(spark, dates).select(F.col("report_date").cast("timestamp_ntz"))
    counts = orders.groupBy(F.col("o_orderdate").alias("report_date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return days.join(counts, "report_date", "left").select(
        "report_date", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("report_date", F.col("report_date").cast("timestamp_ntz"))


def plant_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report, all 251 columns, for two report dates."""
    return rounded(_stamp(plant_report(spark, plant(spark, sf_dir), REPORT_DATES, BUDGET)))


def report_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = day_facts(spark, plant(spark, sf_dir), REPORT_DATES, BUDGET)
    cols = [v.alias(n) for n, v in actual_columns()]
    return rounded(_stamp(facts.select("report_date", F.col("day").alias("PeriodIndex"), *cols)))


def report_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = day_facts(spark, plant(spark, sf_dir), REPORT_DATES, BUDGET)
    cols = [v.alias(n) for s in SCENARIO_SUFFIX for n, v in plan_columns(s)]
    return rounded(_stamp(facts.select("report_date", F.col("day").alias("PeriodIndex"), *cols)))


def report_accumulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = day_facts(spark, plant(spark, sf_dir), REPORT_DATES, BUDGET)
    cols = [v.alias(n) for n, v in accumulated_columns()]
    return rounded(_stamp(facts.select("report_date", F.col("day").alias("PeriodIndex"), *cols)))


def multi_date_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight kept columns for ten report dates in one job, no budget type."""
    dates = [date(2024, 1, 14) + timedelta(days=i) for i in range(10)]
    report = plant_report(spark, plant(spark, sf_dir), dates)
    return rounded(_stamp(treat(report, extra=("report_date",))))


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder that the session names.

    A local session without one uses its warehouse, which is on the same machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{name}-{datetime.now():%Y%m%d%H%M%S%f}"


def _event_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A snapshot per day of events, one that must change nothing, and a restatement."""
    events = tables(spark, sf_dir, "events")["events"]
    day = F.to_date("ts")
    kinds = ("click", "view", "purchase", "error", "signup")
    daily = events.groupBy(day.alias("report_date")).agg(
        F.max(day.cast("timestamp_ntz")).alias("Data"),
        *[F.sum(F.when(F.col("event_type") == k, F.col("value"))).alias(k) for k in kinds],
    )
    lowered = daily.withColumns({k: F.lit(-1.0) for k in kinds})
    late = daily.where(F.dayofmonth("report_date") >= 20)
    return daily, lowered, late.withColumns({k: F.col(k) * 2.0 for k in kinds})


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event snapshots written twice per date, corrected once, read back, consolidated.

    The second write finds the dates stored and must change nothing; the forced one
    restates the dates from the 20th on. A folder that is no date lies among them, and the
    snapshot of the 15th has no date column of its own.
    """
    root = _scratch(spark, "snapshots")
    daily, lowered, late = _event_days(spark, sf_dir)
    first = F.dayofmonth("report_date")
    write_snapshot(daily.where(first == 15).drop("Data"), root, at=datetime(2024, 2, 1))
    daily.limit(1).drop("report_date").write.parquet(f"{root}/report_date=old")
    write_snapshot(daily, root, at=datetime(2024, 2, 1))
    write_snapshot(lowered, root, at=datetime(2024, 2, 2))
    write_snapshot(late, root, force=True, at=datetime(2024, 2, 3))
    merged = consolidate(read_snapshots(spark, root, date(2024, 1, 28)), date(2024, 1, 28))
    write_consolidated(merged, f"{root}-consolidated")
    return rounded(spark.read.parquet(f"{root}-consolidated"))


def incremental_consolidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same snapshots, arriving in three steps with a state that is refreshed after each.

    First the days up to the 10th, then the others, then the restated ones, whose former
    values must be gone from the state.
    """
    root, limit = _scratch(spark, "increments"), date(2024, 1, 28)
    daily, lowered, late = _event_days(spark, sf_dir)
    early = F.dayofmonth("report_date") <= 10
    write_snapshot(daily.where(early), root, at=datetime(2024, 2, 1))
    refresh(spark, root, f"{root}-state", limit)
    write_snapshot(daily.where(~early), root, at=datetime(2024, 2, 1))
    write_snapshot(lowered, root, at=datetime(2024, 2, 2))
    refresh(spark, root, f"{root}-state", limit)
    write_snapshot(late, root, force=True, at=datetime(2024, 2, 3))
    return rounded(refresh(spark, root, f"{root}-state", limit).table)


def overlapping_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events within the spans that events of the same kind open, of a second to two weeks."""
    events = tables(spark, sf_dir, "events")["events"]
    n = F.col("event_id")
    # Mostly short ones; every 50th is long.
    seconds = F.when(n % 50 == 0, (n * 7919) % 1_209_600).otherwise((n * 7919) % 3600) + 1
    spans = events.select(
        "event_type",
        n.alias("span"),
        F.col("ts").alias("start"),
        F.timestamp_add("SECOND", seconds, F.col("ts")).alias("end"),
    )
    totals = {
        "n": (F.count(F.lit(1)), F.sum),
        "first": (F.min("span"), F.min),
        "until": (F.max("end"), F.max),
    }
    points = events.select("event_id", "event_type", "ts")
    return assign_spans(points, spans, ["event_type"], by=["event_id"], totals=totals)


#: Times of readings that can be.
POSSIBLE = (datetime(2000, 1, 1), datetime(2100, 1, 1))


def _raw_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale readings as text, with words for numbers and times a century off among them."""
    events = tables(spark, sf_dir, "events")["events"]
    n, kind, bad = F.col("event_id"), F.col("event_type"), F.lit("-999")
    ts, value = F.col("ts").cast("string"), F.col("value").cast("string")
    missing = n % 17 == 0
    return events.select(
        F.when(n % 29 == 0, F.concat(F.lit("2124"), F.substring(ts, 5, 30))).otherwise(ts).alias("ts"),
        F.when(n % 13 == 0, "n/a").when(missing, bad).when(kind == "click", value).alias("ipc_t"),
        F.when(missing, bad).when(kind == "view", value).alias("mmd_t"),
        F.when(kind == "purchase", value).alias("c160_t"),
    )


def screened_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crusher feed per shift day from the readings that fit; the dates of the others go on."""
    good, _ = screened(_raw_scales(spark, sf_dir), "scale_readings", *POSSIBLE)
    spine = _spine(spark, sf_dir)
    feed = crusher_feed(good, standin(spark, sf_dir, "daily_factor"), spine)
    lines = ["ipc_feed", "mmd_feed", "jaw_feed", "crusher_feed"]
    out = spine.join(feed, "day", "left")
    return rounded(out.select("day", "hours", *[or_zero(c).alias(c) for c in lines]))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the same readings leave in quarantine, by reason."""
    store = Store(_scratch(spark, "quarantine"))
    raw = {"scale_readings": _raw_scales(spark, sf_dir)}
    inputs, rows = set_aside(raw, store, *POSSIBLE, at=datetime(2024, 2, 1))
    stored = spark.read.parquet(store.quarantine)
    return stored.groupBy("table", "reason", "set_aside_at").agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(rows).cast("long").alias("of"),
        F.max(F.get_json_object("row", "$.ts")).alias("last"),
    )


def empty_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each write of a snapshot counted on its way; one finds nothing to write."""
    root = _scratch(spark, "guard")
    daily, _, _ = _event_days(spark, sf_dir)
    first = F.dayofmonth("report_date")
    steps = [first <= 10, first > 31, first <= 20, first == 5]
    rows = [
        (k, write_snapshot(daily.where(part), root, at=datetime(2024, 2, 1 + k)))
        for k, part in enumerate(steps)
    ]
    return spark.createDataFrame(rows, "step int, rows long")


def report_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run over ten report dates, done twice, and its consolidated table.

    The second run finds every date stored, and the table of the first.
    """
    root, inputs = _scratch(spark, "run"), plant(spark, sf_dir)
    for _ in range(2):
        run(spark, inputs, root, start="14.01.2024", end="2024-01-23", today=date(2024, 2, 1))
    return rounded(spark.read.parquet(Store(root).consolidated))


QUERIES: dict[str, Query] = {
    "daily_feed": daily_feed,
    "shift_spine": shift_spine,
    "carry_forward_strict": _carry(False, ["user_id"]),
    "carry_forward_inclusive": _carry(True, ["user_id"]),
    "carry_forward_hot_series": _carry(False, ["event_type"]),
    "carry_forward_floor": carry_forward_floor,
    "effective_rate": _effective(True),
    "effective_rate_inclusive": _effective(False),
    "month_factor": month_factor,
    "weighted_grade": weighted_grade,
    "grade_pivot": grade_pivot_query,
    "mill_readings": mill_readings_query,
    "attach_grades": attach_grades_query,
    "mill_production": mill_production_query,
    "recovery": recovery,
    "kpi_pivot": kpi_pivot_query,
    "plan_scenarios": _plans(BUDGET),
    "plan_scenarios_without_budget": _plans(None),
    "oee": oee,
    "full_outer_accum": full_outer_accum,
    "splice_projection": splice_projection_query,
    "treat": treat_query,
    "consolidate": consolidate_query,
    "summary": summary,
    "union_by_name": union_by_name_query,
    "limit_and_parse": limit_and_parse,
    "report_dates": report_dates_query,
    "plant_report": plant_report_query,
    "report_actual": report_actual,
    "report_plans": report_plans,
    "report_accumulated": report_accumulated,
    "multi_date_report": multi_date_report,
    "snapshot_roundtrip": snapshot_roundtrip,
    "incremental_consolidation": incremental_consolidation,
    "overlapping_spans": overlapping_spans,
    "screened_feed": screened_feed,
    "quarantine": quarantine,
    "empty_guard": empty_guard,
    "report_run": report_run,
}
