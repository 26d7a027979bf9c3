"""Storage of daily snapshots and of the consolidated table.

A snapshot set is a Parquet folder partitioned by ``report_date``. Every row carries
``snapshot_at``, the start of the run that wrote it: file times of one distributed
write are not ordered, this is. Rows of one run are ranked by report date, the order
in which a date-by-date run would have written them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsreport.functions import clean

# Columns that describe where a row comes from, in order of priority.
SOURCE_COLUMNS = ("_source_mtime", "_source_name", "_source_row")

PARTITION = "report_date"
STAMP = "snapshot_at"


def stored(spark: SparkSession, path: str, merged: bool = False) -> DataFrame | None:
    """The Parquet data below a path, or None if there is none yet.

    Only with ``merged`` are the columns of all files looked up.
    """
    try:
        return spark.read.option("mergeSchema", str(merged).lower()).parquet(path)
    except AnalysisException as error:
        # No folder yet, or a folder without data files.
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def partition_date() -> Column:
    """The report date of a stored row; NULL in a folder whose name is no date."""
    return F.expr(f"try_cast({PARTITION} as date)")


def stored_dates(spark: SparkSession, path: str, dates: Sequence[date]) -> set[date]:
    """Which of the given report dates have a snapshot; never more rows than given."""
    have = stored(spark, path)
    if have is None:
        return set()
    day = partition_date()
    found = have.where(day.isin(*dates)).select(day).distinct()
    return {row[0] for row in found.collect()}


def write_snapshot(
    df: DataFrame,
    path: str,
    force: bool = False,
    at: datetime | None = None,
    dates: Sequence[date] | None = None,
) -> int:
    """Write snapshots by report date and return the number of rows written.

    Without ``force`` only report dates that are not stored yet are added; with it the
    partitions of the given dates are replaced and the others stay. ``at`` identifies the
    run. ``dates``, if known, narrows the look at the stored partitions.
    """
    spark = df.sparkSession
    at = at or datetime.now()

    def partitions() -> DataFrame | None:
        have = stored(spark, path)
        if have is None:
            return None
        return have.where(
            partition_date().isNotNull() if dates is None else partition_date().isin(*dates)
        )

    have = None if force else partitions()
    if have is not None:
        seen = have.select(partition_date().alias(PARTITION)).distinct()
        df = df.join(seen, PARTITION, "left_anti")
    # Brings the few rows of a report date together into one file; a date that turns out
    # large is split at run time.
    out = df.withColumn(STAMP, clean.at(at)).hint("rebalance", PARTITION)
    # Rows are counted on their way to the files.
    counted = Observation()
    writer = out.observe(counted, F.count(F.lit(1)).alias("rows")).write.partitionBy(PARTITION)
    if force:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)
    return counted.get["rows"]


def read_snapshots(
    spark: SparkSession,
    path: str,
    limit: date | None = None,
    date_column: str = "Data",
    only: Sequence[date] | None = None,
) -> DataFrame | None:
    """Rows of all snapshots up to the limit, with their source columns.

    Folders whose name is not a date are skipped. The limit is a partition filter, so
    later snapshots are not read, and so are the report dates in ``only``. A missing date
    reads as the report date.
    """
    df = stored(spark, path, merged=True)
    if df is None:
        return None
    day = partition_date()
    df = df.where(day.isNotNull())
    if limit is not None:
        df = df.where(day <= F.lit(limit))
    if only is not None:
        df = df.where(day.isin(*only))
    written = F.col("_metadata.file_modification_time").cast("timestamp_ntz")
    mtime, name, row = SOURCE_COLUMNS
    default = day.cast("timestamp_ntz")
    if date_column not in df.columns:
        own = default
    elif isinstance(df.schema[date_column].dataType, T.StringType):
        own = F.coalesce(date_column, F.date_format(day, "yyyy-MM-dd"))
    else:
        own = F.coalesce(F.col(date_column).cast("timestamp_ntz"), default)
    rest = [c for c in df.columns if c not in (date_column, PARTITION, STAMP)]
    return df.select(
        own.alias(date_column),
        *rest,
        (F.coalesce(F.col(STAMP), written) if STAMP in df.columns else written).alias(mtime),
        F.date_format(day, "yyyy-MM-dd").alias(name),
        F.col("_metadata.row_index").alias(row),
    )


def write_consolidated(
    df: DataFrame, path: str, overwrite: bool = False, date_column: str = "Data"
) -> dict[str, Any] | None:
    """Write the consolidated table; an existing one is kept unless overwritten.

    What was written, summed up on the way: ``rows``, ``first_date``, ``last_date``. None
    where the existing table was kept.
    """
    if not overwrite and stored(df.sparkSession, path) is not None:
        return None
    summed = Observation()
    sums = [F.count(F.lit(1)).alias("rows")]
    if date_column in df.columns:
        sums += [F.min(date_column).alias("first_date"), F.max(date_column).alias("last_date")]
    out = df.observe(summed, *sums)
    out.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
    return summed.get
