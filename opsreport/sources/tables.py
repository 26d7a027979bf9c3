"""Reading the input tables, from files or over JDBC."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from opsreport.sources.schema import TABLES, conform


def jdbc_options(
    name: str,
    connection: Mapping[str, str],
    bounds: tuple[datetime, datetime] | None = None,
    partitions: int = 16,
) -> dict[str, str]:
    """Options of a JDBC scan that splits the table on its time column.

    The bounds only set the stride of the split; rows outside them are still read,
    by the first and the last partition.
    """
    table = TABLES[name]
    # Times of the source carry no zone; without this they would shift by that of the session.
    options = {
        "dbtable": table.source,
        "fetchsize": "10000",
        "preferTimestampNTZ": "true",
        **connection,
    }
    if table.source_time and bounds:
        low, high = bounds
        options |= {
            "partitionColumn": table.source_time,
            "lowerBound": low.isoformat(sep=" "),
            "upperBound": high.isoformat(sep=" "),
            "numPartitions": str(partitions),
        }
    return options


def day_counts_query(name: str) -> str:
    """A derived table (day, n) of a source table, to be read before the table itself."""
    table = TABLES[name]
    day = f"CAST({table.source_time} AS DATE)"
    return f"(SELECT {day} AS day, COUNT(*) AS n FROM {table.source} GROUP BY {day}) counts"


def row_ranges(
    counts: Sequence[tuple[date, int]], partitions: int
) -> list[tuple[datetime | None, datetime | None]]:
    """Half-open time ranges of about equal row counts, by rows per day; None is unbounded.

    Days are put together until they hold a part's share; a day that holds more is cut into
    equal times of day. The ranges leave no gap and do not overlap.
    """
    days = sorted((d, n) for d, n in counts if n > 0)
    share = max(1.0, sum(n for _, n in days) / partitions)
    cuts: list[datetime] = []
    filled = 0.0
    for day, n in days:
        midnight = datetime(day.year, day.month, day.day)
        pieces = math.ceil(n / share)
        if filled and filled + n > share:
            cuts.append(midnight)
            filled = 0.0
        cuts += [midnight + k * timedelta(days=1) / pieces for k in range(1, pieces)]
        filled += n / pieces
    edges = [None, *cuts, None]
    return list(zip(edges[:-1], edges[1:], strict=True))


def range_predicates(
    column: str, ranges: Sequence[tuple[datetime | None, datetime | None]]
) -> list[str]:
    """One SQL condition per range; rows without a time belong to the first."""
    out = []
    for low, high in ranges:
        parts = [f"{column} >= '{low.isoformat(sep=' ')}'"] if low else []
        parts += [f"{column} < '{high.isoformat(sep=' ')}'"] if high else []
        within = " AND ".join(parts) or f"{column} IS NOT NULL"
        out.append(within if low else f"({within}) OR {column} IS NULL")
    return out


def read_by_rows(
    spark: SparkSession, name: str, connection: Mapping[str, str], partitions: int = 16
) -> DataFrame:
    """One table over JDBC in parts of equal row counts instead of equal time strides.

    The database counts rows per day first. Takes the same connection options as a plain scan.
    """
    counts = spark.read.format("jdbc").options(
        **{**jdbc_options(name, connection), "dbtable": day_counts_query(name)}
    )
    days = [(r["day"], r["n"]) for r in counts.load().collect() if r["day"] is not None]
    predicates = range_predicates(TABLES[name].source_time, row_ranges(days, partitions))
    options = jdbc_options(name, connection)
    url, table = options.pop("url"), options.pop("dbtable")
    return conform(spark.read.jdbc(url, table, predicates=predicates, properties=options), name)


def read_raw(
    spark: SparkSession,
    name: str,
    location: str | None = None,
    fmt: str = "parquet",
    connection: Mapping[str, str] | None = None,
    bounds: tuple[datetime, datetime] | None = None,
    partitions: int = 16,
) -> DataFrame:
    """One input table as the source has it."""
    if fmt == "jdbc":
        options = jdbc_options(name, connection or {}, bounds, partitions)
        return spark.read.format("jdbc").options(**options).load()
    return spark.read.format(fmt).load(f"{location}/{name}")


def read_source(
    spark: SparkSession,
    name: str,
    location: str | None = None,
    fmt: str = "parquet",
    connection: Mapping[str, str] | None = None,
    bounds: tuple[datetime, datetime] | None = None,
    partitions: int = 16,
) -> DataFrame:
    """One input table under our names and types."""
    return conform(read_raw(spark, name, location, fmt, connection, bounds, partitions), name)


def read_inputs(
    spark: SparkSession,
    location: str | None = None,
    fmt: str = "parquet",
    connection: Mapping[str, str] | None = None,
    bounds: tuple[datetime, datetime] | None = None,
    partitions: int = 16,
) -> dict[str, DataFrame]:
    """All input tables, kept below one folder or reached by one JDBC connection."""
    return {
        name: read_source(spark, name, location, fmt, connection, bounds, partitions)
        for name in TABLES
    }


def read_raws(spark: SparkSession, **source: Any) -> dict[str, DataFrame]:
    """All input tables as their source has them, to be screened; arguments as ``read_raw``."""
    return {name: read_raw(spark, name, **source) for name in TABLES}
