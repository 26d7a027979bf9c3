"""Rows that do not fit their table, set aside with the reason instead of failing the run.

A text where a number belongs, or a time that cannot be, would stop every date that reads the
row. ``screened`` splits a raw table in two: rows that fit, under our names and types, and rows
that do not, as text with what is wrong with them. Both are plain projections of one scan; the
dates of a run go on with the rows that fit.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsreport.functions.clean import at
from opsreport.sources.schema import TABLES, source_columns

#: What the rows set aside look like, whatever their table.
QUARANTINE = "table string, reason string, row string"


def _fault(raw: Column, typed: Column, name: str, dtype: T.DataType, ok: Column) -> Column:
    """What is wrong with one value, or NULL."""
    bad = F.when(raw.isNotNull() & typed.isNull(), F.lit(f"{name}: not {dtype.simpleString()}"))
    return bad.when(typed.isNotNull() & ~ok, F.lit(f"{name}: out of range"))


def screened(
    df: DataFrame,
    name: str,
    since: datetime | None = None,
    before: datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, rows set aside) of a raw table.

    A value fits if it is NULL or can be read as its column's type, a NaN or infinity aside;
    the table's time must lie in ``[since, before)``. NULLs are left to the report, which has
    rules for them. Of a row with several faults all are named, in the order of the columns.
    """
    table = TABLES[name]
    checked = []
    for ours, src, dtype in source_columns(df, name):
        raw, typed = F.col(f"`{src}`"), F.col(f"`{src}`").try_cast(dtype)
        ok = F.lit(True)
        if isinstance(dtype, T.DoubleType):
            ok = ~F.isnan(typed) & (F.abs(typed) < F.lit(float("inf")))
        if ours == table.time and since is not None:
            ok = ok & (typed >= at(since))
        if ours == table.time and before is not None:
            ok = ok & (typed < at(before))
        checked.append((src, typed.alias(ours), _fault(raw, typed, ours, dtype, ok)))
    faults = F.array_compact(F.array(*[fault for _, _, fault in checked]))
    fine = reduce(lambda a, b: a & b, [fault.isNull() for _, _, fault in checked])
    good = df.where(fine).select(*[typed for _, typed, _ in checked])
    bad = df.where(~fine).select(
        F.lit(name).alias("table"),
        F.array_join(faults, "; ").alias("reason"),
        F.to_json(F.struct(*[F.col(f"`{src}`").cast("string").alias(src) for src, _, _ in checked]))
        .alias("row"),
    )
    return good, bad


def screen_inputs(
    raw: Mapping[str, DataFrame],
    since: datetime | None = None,
    before: datetime | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """All tables screened, and what was set aside in any of them."""
    split = {name: screened(df, name, since, before) for name, df in raw.items()}
    bad = reduce(DataFrame.unionByName, [b for _, b in split.values()])
    return {name: good for name, (good, _) in split.items()}, bad
