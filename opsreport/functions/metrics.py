"""Plant formulas as Column expressions.

Letters: f, c and t are the grades of feed, concentrate and tails, in percent for
copper and grams per tonne for gold; recoveries are fractions unless a name ends
in ``_pct``.
"""

from __future__ import annotations

from pyspark.sql import Column

from opsreport.functions.clean import or_zero, ratio, reading, reading_or

# Unit conversions and mineral chemistry.
GRAMS_PER_OUNCE = 31.1034768
TONNES_PER_KLB = 0.453592370380378
SILVER_PER_GOLD = 50.0
COPPER_IN_CHALCOPYRITE = 34.63
SULPHUR_IN_CHALCOPYRITE = 34.94
SULPHUR_IN_PYRITE = 53.45
# Fixed value: the two combined crushers are always rated on two 24-hour days.
COMBINED_CRUSHER_HOURS = 48.0


def percent(x: Column) -> Column:
    return x / 100.0


def dry_share(moisture_pct: Column) -> Column:
    """Dry fraction of a wet tonne."""
    return 1.0 - percent(moisture_pct)


def stock_adjusted(grade: Column, factor_pct: Column) -> Column:
    """Grade corrected by a stock factor; NULL when the month has no factor."""
    return grade * (1.0 + percent(factor_pct.cast("double")))


def recovery(f: Column, c: Column, t: Column) -> Column:
    """Two-product recovery as a fraction."""
    return ratio(f - t, c - t) * ratio(c, f)


def tails_from_plan(f: Column, c: Column, rec_pct: Column, grade_in_percent: bool) -> Column:
    """Tails grade that a planned feed grade, concentrate grade and recovery imply."""
    r = percent(rec_pct)
    if grade_in_percent:
        f, c = percent(f), percent(c)
    tails = ratio(f * c * (r - 1.0), r * f - c)
    return or_zero(tails * 100.0 if grade_in_percent else tails)


def pyrite(sulphur: Column, copper: Column) -> Column:
    """Pyrite grade from the sulphur that copper does not explain."""
    bound = reading(copper) / COPPER_IN_CHALCOPYRITE * SULPHUR_IN_CHALCOPYRITE
    return (reading(sulphur) - bound) / SULPHUR_IN_PYRITE * 100.0


def copper_contained(feed: Column, grade: Column) -> Column:
    return feed * percent(grade)


def gold_contained(feed: Column, grade: Column) -> Column:
    """Kilograms of gold in the feed."""
    return feed * grade / 1000.0


def copper_produced(feed: Column, grade: Column, rec: Column) -> Column:
    """Tonnes of copper."""
    return copper_contained(feed, grade) * rec


def gold_ounces(feed: Column, grade: Column, rec: Column) -> Column:
    return feed * grade * rec / GRAMS_PER_OUNCE


def gold_equivalent(gold_oz: Column, silver_oz: Column) -> Column:
    return gold_oz + silver_oz / SILVER_PER_GOLD


def silver_ounces(mass: Column | str, grade: Column | str) -> Column:
    return reading_or(mass, 0.0) * reading_or(grade, 0.0) / GRAMS_PER_OUNCE


def oee(tonnes: Column, hours: Column, rate: Column) -> Column:
    """Overall effectiveness against the nominal rate; NULL where the rate is zero."""
    return ratio(ratio(tonnes * 100.0, hours), rate)


def plan_available(hours: Column, availability: Column) -> Column:
    return hours * percent(availability)


def plan_used(hours: Column, availability: Column, utilisation: Column) -> Column:
    return plan_available(hours, availability) * percent(utilisation)


def plan_idle(hours: Column, availability: Column, utilisation: Column) -> Column:
    """Hours available but not used."""
    return plan_available(hours, availability) * (1.0 - percent(utilisation))


def plan_down(hours: Column, availability: Column, *shares: Column) -> Column:
    """Hours not available, narrowed by one or more percentage shares."""
    down = hours * (1.0 - percent(availability))
    for share in shares:
        down = down * percent(share)
    return down


def external_share(c14: Column, c15: Column, c16: Column, c17: Column) -> Column:
    # The signs are the contract: only the first two are taken off the hundred.
    return 100.0 - (c14 + c15) + c16 + c17
