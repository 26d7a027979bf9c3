"""Shared session and a small plant whose numbers can be checked by hand."""

from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from opsreport.sources.schema import TABLES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "America/Sao_Paulo")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def t(text: str) -> datetime:
    """'2024-01-02 03:00' or '2024-01-02'."""
    return datetime.fromisoformat(text)


def table(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    """Rows as literal data in the plan, which keeps the many small runs quick."""
    schema = TABLES[name].schema
    dicts = [dict(zip(schema.names, row, strict=True)) for row in rows]
    local = pa.Table.from_pylist(dicts, schema=to_arrow_schema(schema))
    return spark.createDataFrame(local, schema)


def by_day(rows: list, column: str = "day") -> dict:
    """Collected rows keyed by day of month."""
    return {r[column].day: r for r in rows}


ASSAY = {
    "moisture": (4, " Moagem ", "Umidade Minério"),
    "feed_cu": (8, "Alimentação Sag", "Cu "),
    "feed_au": (8, "Alimentação Sag", "Au"),
    "feed_s": (8, "Alimentação Sag", "S"),
    "conc_cu": (3, "Concentrado Coluna", "Cu"),
    "conc_au": (3, " Concentrado Coluna", "Au"),
    "tails_cu": (7, "Rejeito Final", "Cu"),
    "tails_au": (7, "Rejeito Final", "Au"),
}
GRADE = {
    "feed_cu": 0.5,
    "feed_au": 0.4,
    "feed_s": 1.5,
    "conc_cu": 25.0,
    "conc_au": 20.0,
    "tails_cu": 0.1,
    "tails_au": 0.1,
}


def plan_row(day: str, name: str, kind: int, feed: float, version: int = 1) -> tuple:
    """An area plan: 80 % available, 90 % used."""
    return (t(day), name, version, 80.0, 4, kind, 90.0, feed, 7.0, 10.0, 20.0, 5.0, 5.0, 40.0, 60.0)


def production_row(day: str, kind: int, version: int = 1) -> tuple:
    grades = (0.6, 0.5, 11.0, 12.0, 85.0, 75.0, 24.0, 22.0)
    return (t(day), version, 4, kind, *grades, 100.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0)


def plant_rows() -> dict[str, list[tuple]]:
    """Readings at 08:00 on 1, 2 and 3 January 2024, plans for 1 to 5 January."""
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    noon = [t(f"{d} 08:00") for d in days]
    assays = []
    for ts in noon:
        assays.append((ts, *ASSAY["moisture"], 10.0))
        assays += [(ts, *ASSAY[g], v) for g, v in GRADE.items()]
    kpis = []
    for d in days:
        for area in ("310 BRITAGEM IPC", "310 BRITAGEM MMD", "310 BRITAGEM C160", "330 MOAGEM"):
            for order, hours in (("1.1", 20.0), ("1.1.1", 16.0), ("1.1.2", 1.0), ("1.1.3", 3.0),
                                 ("1.2.1", 2.0), ("1.2.2", 1.5), ("1.2.3", 0.5)):
                kpis.append((area, t(d), "1_TimeClassDuration", order, "h", hours, None))
            kpis.append((area, t(d), "3_KPI", "9999.1", "Disponibilidade (%)", 0.83, None))
            kpis.append((area, t(d), "3_KPI", "9999.2", "Utilização (%)", 0.8, None))
    planned = [f"2024-01-0{i}" for i in range(1, 6)]
    names = ("Britagem IPC", "Britagem MMD", "Britagem Mandíbula", "Moagem")
    return {
        "scale_readings": [(ts, 100.0, 200.0, 300.0) for ts in noon],
        "assays": assays,
        "particle_size": [(ts, 150.0) for ts in noon],
        "mill_readings": [(ts, 1000.0) for ts in noon],
        "concentrate": [(ts, 50.0) for ts in noon],
        "shipments": [(t("2024-01-02"), 10.0, 31.1034768)],
        "area_plans": [
            plan_row(d, f"Planejamento - {n}", k, 1000.0 * k)
            for d in planned for n in names for k in (2, 3, 4)
        ],
        "production_plans": [production_row(d, k) for d in planned for k in (2, 3, 4)],
        "month_factors": [(1, 2024, 10, 0, 0, None)],
        "daily_factor": [(t(d), 1.1) for d in days],
        "shifts": [(t("2023-12-01"), 1, 360), (t("2023-12-01"), 2, 1080)],
        "nominal_rates": [
            (a, t("2023-06-01"), 50.0)
            for a in ("310 BRITAGEM IPC", "310 BRITAGEM MMD", "310 BRITAGEM C160", "330 MOAGEM")
        ],
        "downtime_kpis": kpis,
    }


def plant_of(spark: SparkSession, **changes: list[tuple]) -> dict[str, DataFrame]:
    """The small plant, with the rows of some tables replaced."""
    from decimal import Decimal

    rows = plant_rows() | changes
    rows["month_factors"] = [
        (m, y, *[None if f is None else Decimal(f) for f in fs])
        for m, y, *fs in rows["month_factors"]
    ]
    return {name: table(spark, name, rows[name]) for name in TABLES}
