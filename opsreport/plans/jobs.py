"""The run: reports for many dates, their snapshots, and the consolidated table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opsreport.functions import clean
from opsreport.operators.consolidate import consolidate, limit_dates
from opsreport.operators.timeaxis import DEFAULT_LOOK_BACK, resolve_range
from opsreport.operators.treatment import treat
from opsreport.plans.incremental import refresh
from opsreport.plans.report import plant_report
from opsreport.sources.quarantine import screen_inputs
from opsreport.sources.snapshots import (
    PARTITION,
    read_snapshots,
    stored_dates,
    write_consolidated,
    write_snapshot,
)

log = logging.getLogger("opsreport")


@dataclass(frozen=True)
class Store:
    """Folders of a run below one root."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def treated(self) -> str:
        return f"{self.root}/treated"

    @property
    def consolidated(self) -> str:
        return f"{self.root}/consolidated"

    @property
    def state(self) -> str:
        return f"{self.root}/state"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"


@dataclass
class Outcome:
    """What a run did."""

    written: list[date] = field(default_factory=list)
    skipped: list[date] = field(default_factory=list)
    failed: list[date] = field(default_factory=list)


def in_parts(dates: Sequence[date]) -> list[list[date]]:
    """Split by month; a single month splits into its dates."""
    months: dict[tuple[int, int], list[date]] = {}
    for d in dates:
        months.setdefault((d.year, d.month), []).append(d)
    return list(months.values()) if len(months) > 1 else [[d] for d in dates]


def isolated(
    dates: Sequence[date], work: Callable[[Sequence[date]], None], outcome: Outcome
) -> None:
    """Do all dates in one job; only if that fails, retry in ever smaller parts.

    A date that fails on its own is logged, and the others go on. What is wrong with the
    tables or the plan itself is wrong for every date, so it fails all of them at once.
    """
    try:
        work(dates)
        outcome.written.extend(dates)
    except Exception as error:
        if len(dates) == 1 or isinstance(error, AnalysisException):
            log.exception("report of %s to %s failed", dates[0], dates[-1])
            outcome.failed.extend(dates)
            return
        log.warning("%d dates failed together, retrying in parts", len(dates), exc_info=True)
        for part in in_parts(dates):
            isolated(part, work, outcome)


def run_report(
    spark: SparkSession,
    inputs: dict[str, DataFrame],
    dates: Sequence[date],
    store: Store,
    force: bool = False,
    plan_type: int | None = None,
    strict: bool = True,
    at: datetime | None = None,
) -> Outcome:
    """Write the raw and the treated snapshot of every date that has none yet.

    Dates that are stored already are not computed, so a run that was cut off can
    simply be repeated. ``force`` computes and replaces all of them.
    """
    at = at or datetime.now()
    dates = sorted(set(dates))
    outcome = Outcome()
    if not dates:
        return outcome
    paths = (store.raw, store.treated)
    have = {p: set() if force else stored_dates(spark, p, dates) for p in paths}

    def work(part: Sequence[date]) -> None:
        # A few hundred rows, needed by both snapshots.
        report = plant_report(spark, inputs, part, plan_type, in_order=False).persist()
        try:
            treated = treat(report, strict, (PARTITION,))
            for df, path in ((report, store.raw), (treated, store.treated)):
                todo = [d for d in part if d not in have[path]]
                if not todo:
                    continue
                kept = df.where(F.col(PARTITION).isin(*todo))
                rows = write_snapshot(kept, path, force, at, todo)
                if not rows:
                    log.warning("no rows for %s to %s", todo[0], todo[-1])
        finally:
            report.unpersist()

    todo = [d for d in dates if any(d not in seen for seen in have.values())]
    outcome.skipped = [d for d in dates if d not in todo]
    if todo:
        isolated(todo, work, outcome)
    return outcome


def set_aside(
    raw: dict[str, DataFrame],
    store: Store,
    since: datetime | None = None,
    before: datetime | None = None,
    at: datetime | None = None,
) -> tuple[dict[str, DataFrame], int]:
    """The rows of raw inputs that fit, and how many were written to the quarantine.

    Rows are written with the time of the run, below the store; a run that is repeated writes
    them again under its own time.
    """
    inputs, bad = screen_inputs(raw, since, before)
    counted = Observation()
    stamped = bad.withColumn("set_aside_at", clean.at(at or datetime.now()))
    stamped.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(
        store.quarantine
    )
    rows = counted.get["rows"]
    if rows:
        log.warning("%d rows do not fit their tables, see %s", rows, store.quarantine)
    return inputs, rows


def run_consolidation(
    spark: SparkSession,
    store: Store,
    limit: date | None,
    force: bool = False,
    incremental: bool = False,
) -> int:
    """Consolidate all treated snapshots up to the limit; 1 when there is nothing to.

    With ``incremental`` only snapshots that are new since the last run are read, and the
    table is replaced by what they lead to.
    """
    if incremental:
        done = refresh(spark, store.treated, store.state, limit)
        if done is None:
            log.error("nothing to consolidate in %s", store.treated)
            return 1
        summed = write_consolidated(done.table, store.consolidated, overwrite=True)
        log.info("consolidated from %d new snapshots: %s", done.read, summed)
        return 0
    snapshots = read_snapshots(spark, store.treated, limit)
    if snapshots is None or limit_dates(snapshots, "Data", limit).isEmpty():
        log.error("nothing to consolidate in %s", store.treated)
        return 1
    done = write_consolidated(consolidate(snapshots, limit), store.consolidated, force)
    if done is None:
        log.info("consolidated table exists, kept: %s", store.consolidated)
    else:
        log.info("consolidated: %s", done)
    return 0


def run(
    spark: SparkSession,
    inputs: dict[str, DataFrame],
    root: str,
    start: str | date | None = None,
    end: str | date | None = None,
    days: int | None = None,
    force: bool = False,
    plan_type: int | None = None,
    strict: bool = True,
    look_back: int = DEFAULT_LOOK_BACK,
    today: date | None = None,
    incremental: bool = False,
) -> int:
    """A whole run: resolve the range, write the snapshots, consolidate; 0 when done."""
    span = resolve_range(today or date.today(), start, end, days, look_back)
    store = Store(root)
    outcome = run_report(
        spark, inputs, span.dates(), store, force, plan_type, strict
    )
    log.info(
        "dates written %d, stored before %d, failed %d",
        len(outcome.written),
        len(outcome.skipped),
        len(outcome.failed),
    )
    return run_consolidation(spark, store, span.limit, force, incremental)
