"""Null, sentinel, text and date cleaning.

All helpers return plain Column expressions, so they stay inside whole-stage
code generation and never block filter pushdown.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsreport.functions.bind import let

# Fixed values: "no reading" marker and the defaults used where a reading is missing.
SENTINEL = -999.0
DEFAULT_MOISTURE = 5.0
DEFAULT_SCALE_FACTOR = 1.0
DEFAULT_SCHEDULED_SHARE = 100.0


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reading(c: Column | str, sentinel: float = SENTINEL) -> Column:
    """The value of a reading, NULL where it holds the "no reading" marker."""
    return F.nullif(col(c), F.lit(sentinel))


def reading_or(c: Column | str, default: float, sentinel: float = SENTINEL) -> Column:
    return F.coalesce(reading(c, sentinel), F.lit(default))


def or_zero(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """A division that gives NULL on a zero denominator, in ANSI mode too."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def at(moment: datetime) -> Column:
    """A zone-free timestamp literal; the text form keeps every time zone out of it."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def sentinel_to_null(
    df: DataFrame, cols: Iterable[str], sentinel: float = SENTINEL
) -> DataFrame:
    return df.withColumns({c: reading(c, sentinel) for c in cols})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, for input that was born in pandas."""
    floats = [
        f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    if not floats:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats})


def trimmed_eq(c: Column | str, text: str) -> Column:
    """Equality that ignores blanks around the stored label."""
    return F.trim(col(c)) == F.lit(text)


# A date in figures, day or year first, one separator throughout; then perhaps a time.
_DATE = (
    r"^(?:\d{1,2}([./-])\d{1,2}\1\d{4}|\d{4}([./-])\d{1,2}\2\d{1,2})"
    r"(?:[ T]+\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?$"
)


def parse_date(c: Column | str) -> Column:
    """Text to a zone-free timestamp; NULL for any other text.

    Read as day, month, year or, with four figures in front, as year, month, day, each value
    on its own. Separators are ``.``, ``/`` and ``-``; the time may lack seconds or carry a
    fraction, of which microseconds are kept. Put together from its numbers: the parsers of
    Spark go through a time zone, where some midnights do not exist. Text and numbers are bound,
    so that neither is worked out again for every number.
    """
    return let(F.trim(col(c)), lambda text: F.when(text.rlike(_DATE), _moment(text)))


def _moment(text: Column) -> Column:
    def put_together(parts: Column) -> Column:
        def number(k: int) -> Column:
            return F.coalesce(F.get(parts, F.lit(k)).try_cast("int"), F.lit(0))

        year_first = F.length(F.get(parts, F.lit(0))) == 4
        fraction = F.substring(F.coalesce(F.get(parts, F.lit(6)), F.lit("0")), 1, 6)
        seconds = F.concat(number(5).cast("string"), F.lit("."), fraction)
        return F.try_make_timestamp_ntz(
            F.when(year_first, number(0)).otherwise(number(2)),
            number(1),
            F.when(year_first, number(2)).otherwise(number(0)),
            number(3),
            number(4),
            seconds.try_cast("decimal(16,6)"),
        )

    return let(F.split(text, "[^0-9]+"), put_together)
