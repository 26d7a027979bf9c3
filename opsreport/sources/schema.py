"""Input tables: our column names, their types and the names they have in the source.

Source column types are not known exactly, so numbers are read as double, codes as
int, and every timestamp as zone-free.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS = T.TimestampNTZType()
DAY = T.DateType()
NUM = T.DoubleType()
INT = T.IntegerType()
TEXT = T.StringType()
FACTOR = T.DecimalType(38, 18)


@dataclass(frozen=True)
class Table:
    """One input table; ``columns`` holds (our name, source name, type)."""

    source: str
    columns: tuple[tuple[str, str, T.DataType], ...]
    time: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, dtype) for name, _, dtype in self.columns])

    @property
    def source_time(self) -> str | None:
        return next((src for name, src, _ in self.columns if name == self.time), None)


# Source table and column names.
TABLES: dict[str, Table] = {
    "scale_readings": Table(
        "TBL_GPROD_OBJ_0",
        (
            ("ts", "CDL_DATETIME_00001", TS),
            ("ipc_t", "CDL_NUMBER_00018", NUM),
            ("mmd_t", "CDL_NUMBER_00012", NUM),
            ("c160_t", "CDL_NUMBER_00015", NUM),
        ),
        "ts",
    ),
    "assays": Table(
        "TBL_GPROD_OBJ_2",
        (
            ("ts", "CDL_DATETIME_00001", TS),
            ("circuit", "CDL_NUMBER_00001", INT),
            ("location", "CDL_STR50_00001", TEXT),
            ("analyte", "CDL_STR100_00001", TEXT),
            ("value", "CDL_NUMBER_00002", NUM),
        ),
        "ts",
    ),
    "particle_size": Table(
        "TBL_GPROD_OBJ_3",
        (("ts", "CDL_DATETIME_00001", TS), ("p80", "CDL_NUMBER_00009", NUM)),
        "ts",
    ),
    "mill_readings": Table(
        "TBL_GPROD_OBJ_4",
        (("ts", "CDL_DATETIME_00001", TS), ("wet_t", "CDL_NUMBER_00012", NUM)),
        "ts",
    ),
    "concentrate": Table(
        "TBL_GPROD_OBJ_5",
        (("ts", "CDL_DATETIME_00001", TS), ("conc_t", "CDL_NUMBER_00012", NUM)),
        "ts",
    ),
    "shipments": Table(
        "TBL_GPROD_OBJ_6",
        (
            ("day", "CDL_DATETIME_00001", TS),
            ("mass", "CDL_NUMBER_00001", NUM),
            ("ag_grade", "CDL_NUMBER_00004", NUM),
        ),
        "day",
    ),
    "area_plans": Table(
        "TBL_GPROD_OBJ_15",
        (
            ("day", "CDL_DATETIME_00001", TS),
            ("plan_name", "CDL_STR50_00003", TEXT),
            ("f1", "CDL_NUMBER_00001", INT),
            ("availability", "CDL_NUMBER_00002", NUM),
            ("f5", "CDL_NUMBER_00005", INT),
            ("plan_type", "CDL_NUMBER_00006", INT),
            ("utilisation", "CDL_NUMBER_00008", NUM),
            ("feed_t", "CDL_NUMBER_00009", NUM),
            ("productivity", "CDL_NUMBER_00010", NUM),
            ("c14", "CDL_NUMBER_00014", NUM),
            ("c15", "CDL_NUMBER_00015", NUM),
            ("c16", "CDL_NUMBER_00016", NUM),
            ("c17", "CDL_NUMBER_00017", NUM),
            ("corrective", "CDL_NUMBER_00018", NUM),
            ("scheduled", "CDL_NUMBER_00019", NUM),
        ),
        "day",
    ),
    "production_plans": Table(
        "TBL_GPROD_OBJ_18",
        (
            ("day", "CDL_DATETIME_00001", TS),
            ("f1", "CDL_NUMBER_00001", INT),
            ("f5", "CDL_NUMBER_00005", INT),
            ("plan_type", "CDL_NUMBER_00006", INT),
            ("cu_grade", "CDL_NUMBER_00007", NUM),
            ("au_grade", "CDL_NUMBER_00008", NUM),
            ("cu_content", "CDL_NUMBER_00009", NUM),
            ("au_content", "CDL_NUMBER_00010", NUM),
            ("cu_rec", "CDL_NUMBER_00011", NUM),
            ("au_rec", "CDL_NUMBER_00012", NUM),
            ("cu_conc", "CDL_NUMBER_00013", NUM),
            ("au_conc", "CDL_NUMBER_00014", NUM),
            ("conc_t", "CDL_NUMBER_00015", NUM),
            ("cu_t", "CDL_NUMBER_00016", NUM),
            ("au_kg", "CDL_NUMBER_00017", NUM),
            ("ag_oz", "CDL_NUMBER_00018", NUM),
            ("au_oz", "CDL_NUMBER_00019", NUM),
            ("au_geo", "CDL_NUMBER_00020", NUM),
            ("cu_klb", "CDL_NUMBER_00021", NUM),
        ),
        "day",
    ),
    "month_factors": Table(
        "TBL_GPROD_OBJ_27",
        (
            ("month", "CDL_NUMBER_00001", INT),
            ("year", "CDL_NUMBER_00002", INT),
            ("au_feed", "CDL_NUMBER_00008", FACTOR),
            ("cu_feed", "CDL_NUMBER_00009", FACTOR),
            ("cu_col", "CDL_NUMBER_00010", FACTOR),
            ("au_col", "CDL_NUMBER_00011", FACTOR),
        ),
    ),
    "daily_factor": Table(
        "TBL_GPROD_OBJ_32",
        (("day", "CDL_DATETIME_00001", TS), ("factor", "CDL_NUMBER_00030", NUM)),
        "day",
    ),
    "shifts": Table(
        "TBL_SHIFTS",
        (
            ("effective", "DATE_EFFECTED", TS),
            ("shift_order", "SHIFT_ORDER_SHT", INT),
            ("start_minutes", "SHIFT_ADD_MINUTES_START", INT),
        ),
    ),
    # The next two stand for the results of database routines whose bodies are not public.
    "nominal_rates": Table(
        "nominal_rates",
        (("area", "area", TEXT), ("effective", "effective", TS), ("rate", "rate", NUM)),
    ),
    "downtime_kpis": Table(
        "downtime_kpis",
        (
            ("area", "AreaDTM", TEXT),
            ("day", "PeriodIndex", TS),
            ("kpi_type", "KPIType", TEXT),
            ("kpi_order", "KPIOrder", TEXT),
            ("kpi_description", "KPIDescription", TEXT),
            ("kpi_value", "KPIValue", NUM),
            ("kpi_target", "KPITarget", NUM),
        ),
        "day",
    ),
}


def source_columns(df: DataFrame, name: str) -> list[tuple[str, str, T.DataType]]:
    """(our name, name in ``df``, type) of a table's columns, found by source or own names."""
    have = set(df.columns)
    table = TABLES[name]
    missing = [src for ours, src, _ in table.columns if src not in have and ours not in have]
    if missing:
        raise ValueError(f"columns missing from {name}: {missing}")
    return [(ours, src if src in have else ours, dtype) for ours, src, dtype in table.columns]


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select a table's columns under our names and types, from source or own names."""
    return df.select(
        [F.col(src).cast(dtype).alias(ours) for ours, src, dtype in source_columns(df, name)]
    )


def require_columns(df: DataFrame, cols: list[str], strict: bool = True) -> DataFrame:
    """Keep the listed columns in list order; when strict, all of them must be there."""
    missing = [c for c in cols if c not in df.columns]
    if missing and strict:
        raise ValueError(f"required columns missing: {missing}")
    return df.select([c for c in cols if c in df.columns])
