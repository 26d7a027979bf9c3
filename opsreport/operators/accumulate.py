"""Second-level grades: actual, budget, and the splice of actual and plan.

The report needs them per day only and takes them from its joined day rows
(``opsreport.plans.columns.accumulated_columns``); ``accumulated_grades`` is the general form
over three tables. A test holds the two against each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsreport.functions.aggregates import positive_weighted_mean
from opsreport.functions.clean import col, or_zero, ratio
from opsreport.functions.metrics import recovery

# Grade measures in the order feed, concentrate, tails, for both metals.
MEASURES = ("feed_cu", "feed_au", "conc_cu", "conc_au", "tails_cu", "tails_au")


def splice(past: Column, actual: Column | str, plan: Column | str) -> Column:
    """The actual before the cut-off, the plan from there on (and where that is unknown)."""
    return F.when(past, or_zero(actual)).otherwise(or_zero(plan))


def splice_projection(
    past: Column,
    actual: tuple[Column | str, Column | str],
    plan: tuple[Column | str, Column | str],
    positive_test: Column | str | None = None,
) -> Column:
    """Weighted mean over (value, weight) pairs spliced at the cut-off.

    A weight counts where the spliced value is positive. ``positive_test`` replaces
    the actual value in that test only.
    """
    value, weight = splice(past, actual[0], plan[0]), splice(past, actual[1], plan[1])
    test = value if positive_test is None else splice(past, positive_test, plan[0])
    return ratio(F.sum(value * weight), F.sum(F.when(test > 0, weight).otherwise(0.0)))


def with_recoveries(df: DataFrame, suffixes: list[str]) -> DataFrame:
    """Add ``rec_<metal><suffix>`` in percent from the six grades of each suffix."""
    cols = {}
    for s in suffixes:
        for metal in ("cu", "au"):
            f, c, t = (F.col(f"{part}_{metal}{s}") for part in ("feed", "conc", "tails"))
            cols[f"rec_{metal}{s}"] = recovery(f, c, t) * 100.0
    return df.withColumns(cols)


def accumulated_grades(
    actual: DataFrame, mill_plan: DataFrame, grade_plan: DataFrame, keys: list[str], past: Column
) -> DataFrame:
    """Actual, budget and projected grades per key of the mill plan.

    Inputs are unique by ``keys``:
    ``actual``: ``feed_t`` and the grades; ``mill_plan``: ``feed_budget`` and
    ``feed_very_short``; ``grade_plan``: ``<grade>_budget``, ``<grade>_very_short`` and
    ``conc_t_very_short``. ``past`` is a condition on the key columns.

    Both full joins hang on the key of ``actual`` and the result is grouped by the key
    of ``mill_plan``. So plan grades of a key without actuals end up in the NULL-key
    group, together with actuals that have no mill plan. That is the contract.
    """

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.withColumnsRenamed({k: f"_{tag}_{k}" for k in keys})

    def on(tag: str) -> Column:
        cond = F.lit(True)
        for k in keys:
            cond = cond & (F.col(f"_a_{k}") == F.col(f"_{tag}_{k}"))
        return cond

    joined = (
        side(actual, "a")
        .join(side(mill_plan, "m"), on("m"), "full")
        .join(side(grade_plan, "g"), on("g"), "full")
        .withColumnsRenamed({f"_m_{k}": k for k in keys})
    )
    feed = or_zero("feed_t")
    cols = []
    for m in MEASURES:
        cols.append(positive_weighted_mean(m, feed).alias(f"{m}_actual"))
        cols.append(
            positive_weighted_mean(f"{m}_budget", or_zero("feed_budget")).alias(f"{m}_budget")
        )
        in_concentrate = m.startswith("conc_")
        # Concentrate is special: plans weigh by concentrate mass, and the actual side
        # tests the feed instead of the grade.
        cols.append(
            splice_projection(
                past,
                (m, "feed_t"),
                (
                    f"{m}_very_short",
                    "conc_t_very_short" if in_concentrate else "feed_very_short",
                ),
                col("feed_t") if in_concentrate else None,
            ).alias(f"{m}_projected")
        )
    grouped = joined.groupBy(*keys).agg(*cols)
    return with_recoveries(grouped, ["_actual", "_budget", "_projected"])
