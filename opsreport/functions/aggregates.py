"""Aggregate expressions.

Each one is a composition of sum / avg / max_by, so Spark combines it on the map
side before any shuffle and a hot group costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsreport.functions.clean import col, or_zero, ratio


def positive_weighted_mean(value: Column | str, weight: Column | str) -> Column:
    """Mean of ``value`` weighted by ``weight``, where only positive values weigh.

    A negative value still counts above the line; the mean is NULL when nothing
    positive carries weight.
    """
    v, w = or_zero(value), col(weight)
    return ratio(F.sum(v * w), F.sum(F.when(v > 0, w).otherwise(0.0)))


#: A stable sum counts in units of 2^-20, and what is left of a value in units of 2^-62; values
#: from 2^43 on are beyond its whole numbers.
_UNIT, _FINE, _TOO_LARGE = 2.0**20, 2.0**42, 2.0**43


def stable_sum(value: Column | str) -> Column:
    """A sum of doubles whose bits do not depend on the order of the rows, so that two runs over
    other partitions agree.

    Each value is split into two whole numbers of units; sums of whole numbers are exact in any
    order, and are put together once at the end. What a value has below 2^-62 is cut off. Groups
    with a value too large for that, or one that is not finite, are summed up as they come.
    NULLs do not count; a sum of nothing is NULL.
    """
    v = col(value).cast("double")
    small = F.abs(v) < _TOO_LARGE
    units = F.when(small, F.floor(v * _UNIT))
    rest = F.when(small, F.floor((v * _UNIT - units) * _FINE))
    whole = lambda c: F.sum(c.cast("decimal(20,0)")).cast("double")
    exact = whole(units) / _UNIT + whole(rest) / (_UNIT * _FINE)
    return F.when(F.max(F.abs(v)) < _TOO_LARGE, exact).otherwise(F.sum(v))


def counts_as_value(v: Column, dtype: T.DataType) -> Column:
    """Whether a value may win: neither NULL nor the zero of its type; any text may."""
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(v, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(v != 0, F.lit(False))
    return v.isNotNull()


def or_zero_of(v: Column, dtype: T.DataType) -> Column:
    """Numbers fall back to 0, truth values to false, everything else to NULL."""
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(v, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(v, F.lit(0).cast(dtype))
    return v


def is_fixed_width(dtype: T.DataType) -> bool:
    """Whether a value can be updated in place in an aggregation buffer; a buffer that cannot
    makes Spark sort the rows instead of hashing their groups."""
    return isinstance(
        dtype, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    )
