"""Readings assigned to the shift day that contains them, and points to spans of any length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsreport.operators.asof import micros


def assign_period(
    readings: DataFrame,
    spine: DataFrame,
    ts: str = "ts",
) -> DataFrame:
    """Inner join of readings to the period with ``start <= ts < end``.

    The spine is spread over the calendar dates each period touches, which turns the
    range join into an equality join with a residual range check. Spark broadcasts the
    spine by its own size check: a pinned one has an exact size.
    """
    covered = F.sequence(
        F.to_date("start"), F.to_date(F.col("end") - F.expr("INTERVAL '0.000001' SECOND"))
    )
    spread = spine.where(F.col("start") < F.col("end")).withColumn("_date", F.explode(covered))
    keyed = readings.withColumn("_date", F.to_date(ts))
    return (
        keyed.join(spread, "_date")
        .where((F.col(ts) >= F.col("start")) & (F.col(ts) < F.col("end")))
        .drop("_date")
    )


#: A span is cut into cells of a sixteenth to an eighth of its length.
_FINENESS = 3


def _floor_log2(n: Column) -> Column:
    return F.char_length(F.bin(n)) - 1


def _shift(at: Column, by: Column | int) -> Column:
    return F.call_function("shiftright", at, F.lit(by) if isinstance(by, int) else by)


def assign_spans(
    points: DataFrame,
    spans: DataFrame,
    keys: list[str],
    ts: str = "ts",
    by: list[str] | None = None,
    totals: dict[str, tuple[Column, Callable[[str], Column]]] | None = None,
) -> DataFrame:
    """Inner join of points to every span (``start``, ``end``) with ``start <= ts < end``.

    Spans may overlap and be of any length, from a microsecond to many years. A span is
    covered by cells whose width is a power of two near its own length, at most seventeen of
    them; a point looks into one cell of every width that spans have. So neither a span of
    years is spread over thousands of dates, nor do the many spans within one day share a key,
    and at most two of a span's cells hold points outside of it. Spans without a start, an end
    or a length hold nothing. ``keys`` are equal on both sides; names must not clash otherwise.

    One pass over the spans finds the widths, of which there are sixty at most.

    With ``totals`` the pairs are summed up by the columns ``by`` of the points and none of them
    is made that a cell can stand for: each total is an aggregate of span columns and the
    function that merges two of it. See ``_span_totals``.
    """
    start, end = micros("start"), micros("end")
    held = spans.where(F.col("start") < F.col("end"))
    points = points.where(F.col(ts).isNotNull())
    if totals is not None:
        return _span_totals(points, held, keys, ts, by or [], totals)
    sized = held.withColumn(
        "_width", F.greatest(_floor_log2(end - start) - _FINENESS, F.lit(0))
    )
    widths = sorted(r[0] for r in sized.select("_width").distinct().collect())
    cell = lambda at: _shift(at, F.col("_width"))
    filed = sized.withColumn("_cell", F.explode(F.sequence(cell(start), cell(end - 1))))
    looked = points.withColumn(
        "_width", F.explode(F.array(*[F.lit(w) for w in widths]).cast("array<int>"))
    )
    looked = looked.withColumn("_cell", cell(micros(ts)))
    # Spark's estimate of a size leaves out what explode adds, so it must not choose a broadcast.
    return (
        looked.join(filed.hint("merge"), [*keys, "_width", "_cell"])
        .where((F.col(ts) >= F.col("start")) & (F.col(ts) < F.col("end")))
        .drop("_width", "_cell")
    )


#: Points of all keys that a leaf cell holds on average, and the most of one key it may hold.
_IN_LEAF = 32
_CROWD = 256


def _leaf_shift(points: DataFrame, keys: list[str], at: Column) -> int:
    """Power of two of a leaf's microseconds: few points in every leaf, or one microsecond."""
    n, low, high = points.agg(F.count(F.lit(1)), F.min(at), F.max(at)).first()
    shift = max((_IN_LEAF * (high - low) // n).bit_length() - 1, 0) if n else 0
    while shift:
        counts = points.groupBy(*keys, _shift(at, shift).alias("_cell")).count()
        if counts.agg(F.max("count")).first()[0] <= _CROWD:
            break
        shift = max(shift - 3, 0)
    return shift


def _span_totals(
    points: DataFrame,
    spans: DataFrame,
    keys: list[str],
    ts: str,
    by: list[str],
    totals: dict[str, tuple[Column, Callable[[str], Column]]],
) -> DataFrame:
    """Totals over all pairs of a point and a span that holds it, by columns of the points.

    The leaves that lie wholly in a span are put together to cells of twice, four times, ... a
    leaf, at most two of each width; spans are summed up by cell. A leaf that has points merges
    the sums of the one cell of every width above it, and its points take them as they are. Only
    the points in the leaves where a span begins or ends are compared with it, at most ``_CROWD``
    points in each; leaves of a microsecond need no comparison. So rows grow with the points and
    the spans, not with their pairs.
    """
    at, start, end = micros(ts), micros("start"), micros("end")
    shift = _leaf_shift(points, keys, at)
    first, last = -_shift(-start, shift), _shift(end, shift)
    longest = spans.agg(F.max(last - first)).first()[0] or 0
    # The cells of a width that the wider ones leave over: an odd one at either end.
    low, high = (lambda w: -_shift(-first, w)), (lambda w: _shift(last, w))
    odd = lambda c: c.bitwiseAND(F.lit(1)) == 1
    cells = [
        F.when(
            (low(w) < high(w)) & odd(edge),
            F.struct(F.lit(w).alias("_width"), cell.alias("_above")),
        )
        for w in range(max(longest, 1).bit_length())
        for edge, cell in ((low(w), low(w)), (high(w), high(w) - 1))
    ]
    sums = [made.alias(n) for n, (made, _) in totals.items()]
    merged = [merge(n).alias(n) for n, (_, merge) in totals.items()]
    filed = spans.withColumn("_c", F.explode(F.array_compact(F.array(*cells)))).select("*", "_c.*")
    filed = filed.groupBy(*keys, "_width", "_above").agg(*sums)
    placed = points.withColumn("_cell", _shift(at, shift))
    widths = F.array(*[F.lit(w) for w in range(max(longest, 1).bit_length())])
    leaves = placed.select(*keys, "_cell").distinct().withColumn("_width", F.explode(widths))
    leaves = leaves.withColumn("_above", _shift(F.col("_cell"), F.col("_width")))
    # Spark's estimate of a size leaves out what explode adds, so it must not choose a broadcast.
    inside = leaves.join(filed.hint("merge"), [*keys, "_width", "_above"])
    inside = inside.groupBy(*keys, "_cell").agg(*merged)
    whole = placed.select(*keys, "_cell", *by).join(inside.hint("merge"), [*keys, "_cell"])
    cut = F.array_distinct(
        F.array_compact(
            F.array(
                F.when(first != _shift(start, shift), _shift(start, shift)),
                F.when(-_shift(-end, shift) != last, last),
            )
        )
    )
    edges = placed.join(spans.withColumn("_cell", F.explode(cut)).hint("merge"), [*keys, "_cell"])
    edges = edges.where((F.col(ts) >= F.col("start")) & (F.col(ts) < F.col("end")))
    both = whole.select(*by, *totals).unionByName(edges.groupBy(*by).agg(*sums))
    return both.groupBy(*by).agg(*merged)
