"""Values that an expression uses more than once but that are to be worked out once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once a row, however often ``use`` names it.

    Catalyst copies a projected expression into every place that reads it when it merges
    projections; a lambda variable it cannot copy. The value is the start of a fold over no
    elements, so it reaches ``use`` as it is, without a copy of its own.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, use)
