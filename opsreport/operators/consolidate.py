"""Many snapshots of the same days merged into one row per day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsreport.functions.aggregates import counts_as_value, is_fixed_width, or_zero_of
from opsreport.functions.clean import nan_to_null, parse_date
from opsreport.operators.asof import micros
from opsreport.sources.snapshots import SOURCE_COLUMNS


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column absent from one of them is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def limit_dates(df: DataFrame, column: str, limit: date | None) -> DataFrame:
    """Parse the date column; drop rows without a readable date or later than the limit."""
    if isinstance(df.schema[column].dataType, T.StringType):
        parsed = parse_date(column)
    else:
        parsed = F.col(column).cast("timestamp_ntz")
    df = df.withColumn(column, parsed).where(F.col(column).isNotNull())
    return df if limit is None else df.where(F.to_date(column) <= F.lit(limit))


#: Room of a rank: rows of one source, and names of sources.
_ROWS, _NAMES = 10**11, 10**8


def rank_of(mtime: Column, number: Column, row: Column) -> Column:
    """Priority of a row as one number: newer source first, then the greater name, given by its
    number, then the earlier row. Greater is better; a null time ranks lowest of all, a null
    name or row last among its like. A decimal has a fixed width in aggregation buffers."""
    wide = lambda c: c.cast("decimal(38,0)")
    oldest = F.lit("0001-01-01").cast("timestamp_ntz")
    when = F.coalesce(micros(mtime), micros(oldest) - 1)
    place = F.lit(_ROWS - 1) - F.coalesce(row.cast("long"), F.lit(_ROWS - 1))
    named = F.coalesce(number.cast("long"), F.lit(0))
    return wide(wide(when) * wide(F.lit(str(_ROWS * _NAMES))) + wide(named * F.lit(_ROWS) + place))


def with_rank(df: DataFrame, helpers: Sequence[str] = SOURCE_COLUMNS) -> DataFrame:
    """``df`` with ``_rank``. The distinct names of sources, about as many as report dates, are
    numbered once in their order; rows get the number of theirs by a join."""
    mtime, name, row = helpers
    number = F.row_number().over(Window.orderBy(name)).alias("_number")
    numbered = df.where(F.col(name).isNotNull()).select(name).distinct().select(name, number)
    rank = rank_of(F.col(mtime), F.col("_number"), F.col(row))
    return df.join(numbered, name, "left").select(*df.columns, rank.alias("_rank"))


def best_by_rank(ranked: DataFrame, column: str, values: Sequence[T.StructField]) -> DataFrame:
    """Per date and value column the best rank (``<c>_rank``) and its value (``<c>``).

    Ranks and values of fixed width are aggregated by hash; the values of other columns are
    looked up afterwards in the few rows that won, by date and rank.
    """
    ok = {f.name: counts_as_value(F.col(f.name), f.dataType) for f in values}
    mine = [f for f in values if is_fixed_width(f.dataType)]
    rest = [f.name for f in values if not is_fixed_width(f.dataType)]
    rank = F.col("_rank")
    best = ranked.groupBy(column).agg(
        *[F.max(F.when(c, rank)).alias(f"{n}_rank") for n, c in ok.items()],
        *[F.max_by(F.when(ok[f.name], F.col(f.name)), F.when(ok[f.name], rank)).alias(f.name)
          for f in mine],
    )
    if rest:
        asked = best.select(
            column, F.explode(F.array_distinct(F.array(*[f"{n}_rank" for n in rest]))).alias("_rank")
        ).where(F.col("_rank").isNotNull())
        # Of rows of one rank the greatest value counts.
        won = ranked.join(asked, [column, "_rank"]).groupBy(column, "_rank")
        won = won.agg(*[F.array_max(F.collect_set(n)).alias(n) for n in rest])
        pairs = won.groupBy(column).agg(
            *[F.map_from_entries(F.collect_list(F.struct("_rank", n))).alias(f"_{n}") for n in rest]
        )
        best = best.join(pairs, column, "left").withColumns(
            {n: F.element_at(f"_{n}", F.col(f"{n}_rank")) for n in rest}
        )
    return best.select(column, *[f"{f.name}_rank" for f in values], *[f.name for f in values])


def value_fields(df: DataFrame, column: str, helpers: Sequence[str]) -> list[T.StructField]:
    return [f for f in df.schema if f.name != column and f.name not in helpers]


def consolidate(
    df: DataFrame,
    limit: date | None = None,
    column: str = "Data",
    helpers: Sequence[str] = SOURCE_COLUMNS,
) -> DataFrame:
    """One row per date: for each column the newest value that is not zero.

    Columns may come from different sources for one date. Everything is a partial
    aggregate over hashes, so a date with very many rows shuffles one row per task.
    """
    df = limit_dates(nan_to_null(df), column, limit)
    values = value_fields(df, column, helpers)
    best = best_by_rank(with_rank(df, helpers), column, values)
    return best.select(
        column, *[or_zero_of(F.col(f.name), f.dataType).alias(f.name) for f in values]
    )


def state_of(
    df: DataFrame, column: str = "Data", helpers: Sequence[str] = SOURCE_COLUMNS
) -> DataFrame:
    """What a consolidation keeps to go on from: per date and value column the best value and
    its rank. Dates of rows without any value are rows of their own.

    Ranks must mean the same in every state to be merged, so sources must be named by ISO
    dates, as those of a snapshot set are: the name's number is its day.
    """
    mtime, name, row = helpers
    day = F.unix_date(F.to_date(F.col(name))) + F.lit(_NAMES // 2)
    ranked = limit_dates(nan_to_null(df), column, None)
    ranked = ranked.withColumn("_rank", rank_of(F.col(mtime), day, F.col(row)))
    return best_by_rank(ranked, column, value_fields(df, column, helpers))


def state_values(state: DataFrame, column: str = "Data") -> list[str]:
    return [c for c in state.columns if c != column and not c.endswith("_rank")]


def merge_states(a: DataFrame, b: DataFrame, column: str = "Data") -> DataFrame:
    """The state of the rows behind both. Rows meet by date; nothing is sorted or aggregated."""
    values = list(dict.fromkeys([*state_values(a, column), *state_values(b, column)]))
    types = {f.name: f.dataType for f in (*a.schema, *b.schema)}

    def of(side: DataFrame, tag: str) -> DataFrame:
        typed = lambda c: F.col(c) if c in side.columns else F.lit(None).cast(types[c])
        names = [c for v in values for c in (f"{v}_rank", v)]
        return side.select(column, *[typed(c).alias(f"{tag}_{c}") for c in names])

    both = of(a, "a").join(of(b, "b"), column, "full")
    better = lambda v: F.coalesce(
        F.col(f"a_{v}_rank") >= F.col(f"b_{v}_rank"), F.col(f"b_{v}_rank").isNull()
    )
    pick = lambda v, c: F.when(better(v), F.col(f"a_{c}")).otherwise(F.col(f"b_{c}"))
    return both.select(
        column,
        *[pick(v, f"{v}_rank").alias(f"{v}_rank") for v in values],
        *[pick(v, v).alias(v) for v in values],
    )


def finished(state: DataFrame, limit: date | None = None, column: str = "Data") -> DataFrame:
    """The consolidated table of a state."""
    kept = state if limit is None else state.where(F.to_date(column) <= F.lit(limit))
    types = {f.name: f.dataType for f in state.schema}
    return kept.select(
        column, *[or_zero_of(F.col(v), types[v]).alias(v) for v in state_values(state, column)]
    )


def names_of_rank(rank: Column) -> Column:
    """(time in microseconds, day) of the source behind a rank of ``state_of``."""
    room = F.lit(str(_ROWS * _NAMES)).cast("decimal(38,0)")
    place = F.pmod(rank, room)
    # Whole division; the quotient of decimals would be rounded up.
    when = F.call_function("div", rank - place, room)
    day = F.call_function("div", place, F.lit(_ROWS)) - F.lit(_NAMES // 2)
    return F.struct(when.alias("micros"), F.date_from_unix_date(day.cast("int")).alias("day"))


def summarize(df: DataFrame, column: str = "Data") -> DataFrame:
    """Row count, column count and date span."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        F.min(column).alias("first_date"),
        F.max(column).alias("last_date"),
    )
