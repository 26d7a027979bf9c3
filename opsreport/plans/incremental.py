"""Consolidation that reads new snapshots only.

Beside the consolidated table a state is kept: per date and column the best value so far and
the rank of the row it is from, together with the snapshots that went into it. A run reads the
snapshots that are new since then, merges their state into the stored one, and finishes the
table from it. Where a snapshot that won somewhere is gone or was restated, the dates it won
are worked out again from all snapshots; values that it did not win do not depend on it.

States are versions in one folder, written completely before they are listed in ``commits``;
a run that is lost leaves the last listed version as it was. Versions before are not deleted.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsreport.operators.asof import micros
from opsreport.operators.consolidate import (
    finished,
    merge_states,
    names_of_rank,
    state_of,
    state_values,
)
from opsreport.sources.snapshots import (
    SOURCE_COLUMNS,
    STAMP,
    partition_date,
    read_snapshots,
    stored,
)


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did, and the table it ended with."""

    table: DataFrame
    read: int
    gone: int


def _sources(spark: SparkSession, path: str, limit: date | None) -> DataFrame:
    """(micros, day) of every stored snapshot up to the limit; reads one column."""
    have = stored(spark, path)
    empty = spark.createDataFrame([], "micros long, day date")
    if have is None or STAMP not in have.columns:
        return empty
    day = partition_date()
    have = have.where(day.isNotNull() & F.col(STAMP).isNotNull())
    if limit is not None:
        have = have.where(day <= F.lit(limit))
    return have.select(micros(STAMP).alias("micros"), day.alias("day")).distinct()


def _version(spark: SparkSession, root: str) -> int:
    commits = stored(spark, f"{root}/commits")
    return 0 if commits is None else commits.agg(F.max("version")).first()[0]


def refresh(
    spark: SparkSession, snapshots: str, root: str, limit: date | None = None
) -> Refreshed | None:
    """Bring the state below ``root`` up to date with the snapshots; None without any.

    The result equals a consolidation of all snapshots up to the limit. Snapshots must carry
    the time of their run; those up to another limit than last time count as new or gone.
    """
    have = _sources(spark, snapshots, limit)
    version = _version(spark, root)
    old = stored(spark, f"{root}/state-{version}") if version else None
    seen = spark.read.parquet(f"{root}/sources-{version}") if version else have.limit(0)
    keys = ["micros", "day"]
    # As many rows as there are report dates.
    new = have.join(seen, keys, "left_anti").collect()
    gone = seen.join(have, keys, "left_anti").persist()
    try:
        n_gone = gone.count()
        if not new and not n_gone:
            return None if old is None else Refreshed(finished(old, limit), 0, 0)
        states = [old] if old is not None else []
        if n_gone:
            won = [
                old.select("Data", names_of_rank(F.col(f"{v}_rank")).alias("s"))
                for v in state_values(old)
            ]
            won = reduce(DataFrame.unionAll, won).select("Data", "s.*")
            lost = won.join(gone, keys).select("Data").distinct()
            # Dates that no snapshot holds any more are lost as well.
            left = read_snapshots(spark, snapshots, limit)
            if left is None:
                return None
            held = left.select("Data").distinct()
            unheld = old.select("Data").join(held, "Data", "left_anti")
            lost = lost.union(unheld).distinct()
            states = [
                old.join(lost, "Data", "left_anti"),
                state_of(left.join(lost, "Data", "left_semi")),
            ]
        if new:
            days = sorted({r["day"] for r in new})
            stamps = sorted({r["micros"] for r in new})
            mtime = F.col(SOURCE_COLUMNS[0])
            fresh = read_snapshots(spark, snapshots, limit, only=days)
            fresh = fresh.where(micros(mtime).isin(stamps))
            states.append(state_of(fresh))
        merged = reduce(merge_states, states)
        merged.write.mode("overwrite").parquet(f"{root}/state-{version + 1}")
    finally:
        gone.unpersist()
    have.write.mode("overwrite").parquet(f"{root}/sources-{version + 1}")
    listed = spark.range(1).select(F.lit(version + 1).alias("version"))
    listed.write.mode("append").parquet(f"{root}/commits")
    state = spark.read.parquet(f"{root}/state-{version + 1}")
    return Refreshed(finished(state, limit), len(new), n_gone)


