"""Lookups along a time axis: carry-forward, effective-dated rows, month factors.

A plain window over a whole series would put that series in one task. The carry-forward here
is a prefix scan: a series with more rows than a task should hold is cut at quantiles of the
time stamps, a window looks back within each piece, and the last values of the pieces, a small
table, are scanned once and handed to the pieces that follow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsreport.operators.ranges import parts_of, range_of, rough_edges

_UP_TO = (Window.unboundedPreceding, Window.currentRow)


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a zone-free time stamp, in any session zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def _all_set(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def _in_pieces(df: DataFrame, keys: list[str], ts: str, parts: int) -> DataFrame:
    """``df`` with ``_micros`` and ``_piece``, so that no (keys, piece) holds many more rows
    than a ``parts``-th of the table, be they years or one minute of a series.

    Pieces are cut where the time stamps of the whole table have their quantiles. Only series
    with more than a ``parts``-th of all rows are cut (piece 0 and up); there are fewer than
    ``parts`` of them, which become literal rows. Other series are piece -1 as a whole. Rows
    without a key or time stamp belong to no series; a hash spreads them over lower numbers.
    """
    spark = df.sparkSession
    at = range_of(F.col("_micros"), rough_edges(df, micros(ts), parts))
    columns = [c.name for c in df.schema]
    spread = -2 - F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")
    df = df.withColumn("_micros", micros(ts))
    if not keys:
        return df.withColumn("_piece", F.when(F.col(ts).isNotNull(), at).otherwise(spread))
    named = df.where(_all_set([*keys, ts])).select(*keys)
    sizes = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = sizes.where(F.col("_n") * parts > named.count()).drop("_n").toArrow()
    large = spark.createDataFrame(found, named.schema).withColumn("_large", F.lit(True))
    piece = F.when(F.col("_large"), at).otherwise(F.lit(-1))
    return (
        df.join(F.broadcast(large), keys, "left")
        .withColumn("_piece", F.when(_all_set([*keys, ts]), piece).otherwise(spread))
        .select(*columns, "_micros", "_piece")
    )


#: Pieces of all cut series that are broadcast to find the values at their ends.
_FEW_PIECES = 100_000


def _handed_on(
    rows: DataFrame, keys: list[str], ts: str, values: list[str], parts: int
) -> DataFrame:
    """(keys, ``_piece``, ``<v>_before``): what the pieces before have as their last value of
    ``v``, as (``ts``, ``value``). One row per piece of a cut series. Sums up without sorting
    rows: first the last time stamps of each piece, then the values at these. There are fewer
    than ``parts`` cut series with at most ``parts`` pieces each; up to ``_FEW_PIECES`` they are
    broadcast, beyond that the rows of cut series are shuffled to meet them."""
    group = [*keys, "_piece"]
    cut = rows.where(F.col("_piece") >= 0)
    last = cut.groupBy(*group).agg(
        *[F.max(F.when(F.col(v).isNotNull(), F.col("_micros"))).alias(f"{v}_last") for v in values]
    )
    here = lambda v: F.col("_micros") == F.col(f"{v}_last")
    at_ends = F.broadcast(last) if parts * parts <= _FEW_PIECES else last
    ends = cut.join(at_ends, group).where(reduce(lambda a, b: a | b, [here(v) for v in values]))
    ends = ends.groupBy(*group).agg(
        *[F.max(F.when(here(v), F.col(ts))).alias(f"{v}_ts") for v in values],
        *[F.max(F.when(here(v), F.col(v))).alias(v) for v in values],
    )
    # A piece without a value of its own still hands on what came to it.
    pieces = last.select(*group).join(ends, group, "left")
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(_UP_TO[0], -1)

    def handed(v: str) -> Column:
        pair = F.struct(F.col(f"{v}_ts").alias("ts"), F.col(v).alias("value"))
        return F.last(F.when(F.col(v).isNotNull(), pair), ignorenulls=True).over(before)

    return pieces.select(*group, *[handed(v).alias(f"{v}_before") for v in values])


def carry_points(
    df: DataFrame, keys: list[str], ts: str, values: list[str], inclusive: bool = False
) -> DataFrame:
    """Add ``<v>_carried``: (``ts``, ``value``) of the latest earlier row where ``v`` is set.

    Series are told apart by ``keys``; without keys all rows are one series. Among rows of one
    time stamp the greatest value counts. With ``inclusive`` a row sees the values of its own
    time stamp. Rows without a key or a time stamp find nothing.

    The rows move once, to their piece of a series; the look-back within it and the join with
    what is handed on keep them there.
    """
    parts = parts_of(df.sparkSession)
    rows = _in_pieces(df, keys, ts, parts)
    group = [*keys, "_piece"]
    back = Window.partitionBy(*group).orderBy("_micros")
    back = back.rangeBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    mark = lambda v: F.when(
        F.col(v).isNotNull(), F.struct(F.col(ts).alias("ts"), F.col(v).alias("value"))
    )
    inside = {f"{v}_inside": F.max(mark(v)).over(back) for v in values}
    found = rows.withColumns(inside).join(_handed_on(rows, keys, ts, values, parts), group, "left")
    complete = F.col("_piece") >= -1
    return found.select(
        *df.columns,
        *[
            F.when(complete, F.coalesce(f"{v}_inside", f"{v}_before")).alias(f"{v}_carried")
            for v in values
        ],
    )


def carry_forward(
    df: DataFrame,
    keys: list[str],
    ts: str,
    value: Column,
    inclusive: bool = False,
    floor: Column | None = None,
    out: str = "carried",
) -> DataFrame:
    """Add to every row the last valid value of its series before its time stamp.

    ``value`` must be NULL on bad rows. ``inclusive`` lets rows with the very same
    time stamp count. ``floor`` may use the columns of ``df``; a value stamped at or
    before it is not carried. Adds ``out`` and ``<out>_ts``.

    Among valid rows of one time stamp the greatest value counts, which makes the choice
    deterministic.
    """
    carried = carry_points(df.withColumn("_value", value), keys, ts, ["_value"], inclusive)
    hit = F.col("_value_carried")
    if floor is not None:
        hit = F.when(F.col("_value_carried.ts") > floor, hit)
    return carried.withColumn("_hit", hit).select(
        *df.columns,
        F.col("_hit.value").alias(out),
        F.col("_hit.ts").alias(f"{out}_ts"),
    )


def _effective_row(value: str) -> Column:
    """The value of a date as a struct, which is there even if the value is NULL."""
    return F.struct(F.col("_value").alias(value)).alias("_row")


def latest_effective(
    asked: DataFrame,
    dim: DataFrame,
    keys: list[str],
    at: str,
    effective: str,
    value: str,
    strict: bool = True,
    out: str | None = None,
) -> DataFrame:
    """Add to every row of ``asked`` the value of the latest ``dim`` row effective before it.

    ``strict`` excludes a row effective on ``at`` itself; without such a row the value is
    NULL. The rows of both sides are ordered along one axis per key, so ``asked`` should
    be a calendar: use ``effective_lookup`` for facts.
    """
    mine, theirs = (0, 1) if strict else (1, 0)
    rows = (
        dim.where(F.col(effective).isNotNull())
        .groupBy(*keys, F.col(effective).cast("timestamp_ntz").alias("_at"))
        .agg(F.max(value).alias("_value"))
        .select(*keys, "_at", _effective_row(value), F.lit(theirs).alias("_side"))
    )
    merged = asked.withColumns(
        {"_at": F.col(at).cast("timestamp_ntz"), "_side": F.lit(mine)}
    ).unionByName(rows, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(*_UP_TO)
    return (
        merged.withColumn("_hit", F.last("_row", ignorenulls=True).over(w))
        .where(F.col("_side") == mine)
        .select(*asked.columns, F.col("_hit")[value].alias(out or value))
    )


def effective_lookup(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    day: str,
    effective: str,
    value: str,
    strict: bool = True,
    out: str | None = None,
) -> DataFrame:
    """``latest_effective`` for facts of any number, at days or at any time.

    The dimension alone is turned into spans of validity, filed under the month they begin in
    and under every later month with facts that they still hold at the start of. Facts join the
    few spans of their key and month, so no window holds facts; one window per key goes over
    the dimension and one over it and the months.
    """
    at = F.col(day).cast("timestamp_ntz")
    month = F.trunc(at, "MM").cast("timestamp_ntz")
    spans = (
        dim.where(F.col(effective).isNotNull())
        .groupBy(*keys, F.col(effective).cast("timestamp_ntz").alias("_from"))
        .agg(F.max(value).alias("_value"))
        .select(*keys, "_from", _effective_row(value))
    )
    until = F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from"))
    spans = spans.withColumn("_until", until)
    spans = spans.withColumn("_span", F.struct("_from", "_until", "_row"))
    needed = facts.where(at.isNotNull()).select(*keys, month.alias("_month")).distinct()
    held = latest_effective(needed, spans, keys, "_month", "_from", "_span")
    begun = spans.select(
        *keys, F.trunc("_from", "MM").cast("timestamp_ntz").alias("_month"), "_span"
    )
    filed = held.where(F.col("_span").isNotNull()).unionByName(begun)
    filed = filed.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_month", "_span")

    start, end = F.col("_span._from"), F.col("_span._until")
    if strict:
        inside = (start < F.col("_at")) & (end.isNull() | (F.col("_at") <= end))
    else:
        inside = (start <= F.col("_at")) & (end.isNull() | (F.col("_at") < end))
    same = F.col("_own_month") == F.col("_month")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_key_{k}"))
    joined = facts.withColumns({"_at": at, "_own_month": month}).join(filed, same & inside, "left")
    return joined.select(*facts.columns, F.col("_span._row")[value].alias(out or value))


def month_factors(needed: DataFrame, factors: DataFrame, day: str, names: list[str]) -> DataFrame:
    """Add the factors of each day's month.

    A NULL factor in an existing row reads as zero; a month without a row leaves NULL.
    Of several rows for one month the greatest wins. Spark sees the size of the table after
    the grouping and broadcasts it if it is small.
    """
    table = (
        factors.groupBy("year", "month")
        .agg(F.max(F.struct(*names)).alias("_f"))
        .select(
            F.col("year").cast("int").alias("_year"),
            F.col("month").cast("int").alias("_month"),
            *[F.coalesce(F.col("_f")[n].cast("double"), F.lit(0.0)).alias(n) for n in names],
        )
    )
    keyed = needed.withColumns({"_year": F.year(day), "_month": F.month(day)})
    joined = keyed.join(table, ["_year", "_month"], "left")
    return joined.select(*needed.columns, *names)
