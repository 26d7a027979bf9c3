"""Entity-attribute tables turned into one row per day.

Every pivot works in two steps. First the rows are summed up by day, entity and
attribute: few aggregates per row, combined on the map side. Then the groups, of which
a day has a handful, are spread into columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsreport.functions.clean import or_zero, trimmed_eq
from opsreport.functions.metrics import external_share
from opsreport.sources.codes import (
    AREAS,
    HOUR_ORDERS,
    HOURS_TYPE,
    KPI_ORDERS,
    KPI_TYPE,
    PLAN_VERSION,
    scenarios,
)


def label_of(c: str, labels: dict[str, str]) -> Column:
    """Our name for a stored label; NULL for any other label."""
    chosen = F.lit(None).cast("string")
    for name, label in labels.items():
        chosen = F.when(trimmed_eq(c, label), name).otherwise(chosen)
    return chosen


def sum_where(member: Column, condition: Column, value: Column) -> Column:
    """Sum over the member rows that meet the condition.

    Zero when there are member rows but none meets it, NULL without member rows.
    """
    return F.sum(F.when(member, F.when(condition, value).otherwise(0.0)))


def only(condition: Column, value: Column) -> Column:
    """The value of the single group that meets the condition."""
    return F.max(F.when(condition, value))


def kpi_measure() -> Column:
    """Which measure a downtime row belongs to; NULL for rows of no interest."""
    hours = trimmed_eq("kpi_type", HOURS_TYPE)
    chosen = F.lit(None).cast("string")
    for name, orders in HOUR_ORDERS.items():
        chosen = F.when(hours & F.trim("kpi_order").isin(*orders), name).otherwise(chosen)
    for name, (order, text) in KPI_ORDERS.items():
        row = (
            trimmed_eq("kpi_type", KPI_TYPE)
            & trimmed_eq("kpi_order", order)
            & trimmed_eq("kpi_description", text)
        )
        chosen = F.when(row, name).otherwise(chosen)
    return chosen


def kpi_pivot(kpis: DataFrame, day: str = "day") -> DataFrame:
    """Hours and ratios of the downtime KPIs, ``<area>_<measure>`` per day.

    Hours are summed, ratios averaged. Stop hours are only reported for the mill.
    """
    areas = {name: area.code for name, area in AREAS.items()}
    groups = (
        kpis.select(
            day,
            label_of("area", areas).alias("_area"),
            kpi_measure().alias("_measure"),
            "kpi_value",
        )
        .where(F.col("_area").isNotNull())
        .groupBy(day, "_area", "_measure")
        .agg(F.sum("kpi_value").alias("_sum"), F.avg("kpi_value").alias("_mean"))
    )
    cols = []
    for area in areas:
        member = F.col("_area") == area
        for m in HOUR_ORDERS:
            if area == "mill" or not m.startswith("stop_"):
                hours = sum_where(member, F.col("_measure") == m, F.col("_sum"))
                cols.append(hours.alias(f"{area}_{m}"))
        for m in KPI_ORDERS:
            ratio = only(member & (F.col("_measure") == m), F.col("_mean"))
            cols.append(ratio.alias(f"{area}_{m}"))
    return groups.groupBy(day).agg(*cols)


def of_type(plan_type: int | None) -> Column:
    """Groups of one plan type; never true without a type."""
    return F.col("_type") == F.lit(plan_type).cast("int")


def current_version(plans: DataFrame, plan_type: int | None) -> DataFrame:
    """Rows of the plan version that counts, with ``_type`` NULL for types nobody asks for."""
    for name, version in PLAN_VERSION.items():
        plans = plans.where(F.col(name) == version)
    wanted = [t for t in scenarios(plan_type).values() if t is not None]
    return plans.withColumn("_type", F.when(F.col("plan_type").isin(*wanted), F.col("plan_type")))


AREA_MEANS = ("availability", "utilisation", "productivity")
MILL_MEANS = ("scheduled", "corrective", "external")


def area_plan_pivot(
    plans: DataFrame, plan_type: int | None = None, day: str = "day"
) -> DataFrame:
    """Area plans, ``<area>_<measure>_<scenario>`` per day."""
    areas = {name: area.plan for name, area in AREAS.items()}
    external = external_share(*[F.col(c) for c in ("c14", "c15", "c16", "c17")])
    groups = (
        current_version(plans, plan_type)
        .withColumns({"_area": label_of("plan_name", areas), "external": external})
        .where(F.col("_area").isNotNull())
        .groupBy(day, "_area", "_type")
        .agg(
            F.sum(or_zero("feed_t")).alias("feed"),
            *[F.avg(m).alias(m) for m in (*AREA_MEANS, *MILL_MEANS)],
        )
    )
    cols = []
    for area in areas:
        member = F.col("_area") == area
        for scenario, kind in scenarios(plan_type).items():
            chosen = of_type(kind)
            feed = sum_where(member, chosen, F.col("feed"))
            cols.append(feed.alias(f"{area}_feed_{scenario}"))
            for m in (*AREA_MEANS, *(MILL_MEANS if area == "mill" else ())):
                cols.append(only(member & chosen, F.col(m)).alias(f"{area}_{m}_{scenario}"))
    return groups.groupBy(day).agg(*cols)


PRODUCTION_MEANS = (
    "cu_grade",
    "cu_content",
    "au_grade",
    "au_content",
    "cu_rec",
    "au_rec",
    "cu_conc",
    "au_conc",
)
PRODUCTION_SUMS = ("conc_t", "ag_oz", "au_oz", "au_geo", "cu_klb", "au_kg", "cu_t")


def production_plan_pivot(
    plans: DataFrame, plan_type: int | None = None, day: str = "day"
) -> DataFrame:
    """Production plans, ``plan_<measure>_<scenario>`` per day."""
    groups = (
        current_version(plans, plan_type)
        .groupBy(day, "_type")
        .agg(
            *[F.avg(m).alias(m) for m in PRODUCTION_MEANS],
            *[F.sum(or_zero(m)).alias(m) for m in PRODUCTION_SUMS],
        )
    )
    everything = F.lit(True)
    cols = []
    for scenario, kind in scenarios(plan_type).items():
        chosen = of_type(kind)
        for m in PRODUCTION_MEANS:
            cols.append(only(chosen, F.col(m)).alias(f"plan_{m}_{scenario}"))
        for m in PRODUCTION_SUMS:
            cols.append(sum_where(everything, chosen, F.col(m)).alias(f"plan_{m}_{scenario}"))
    return groups.groupBy(day).agg(*cols)
