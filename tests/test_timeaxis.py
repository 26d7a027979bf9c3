from datetime import date, datetime, timedelta

import pytest
from conftest import by_day, t, table

from opsreport.operators.intervals import assign_period
from opsreport.operators.timeaxis import (
    DateRange,
    argument_date,
    dates_frame,
    period_spine,
    resolve_range,
)

TODAY = date(2024, 3, 10)


def test_default_range_looks_back_sixteen_days_and_stops_yesterday():
    got = resolve_range(TODAY)
    assert got == DateRange(date(2024, 2, 23), TODAY, date(2024, 3, 9))
    assert len(got.dates()) == 16 and got.dates()[-1] == date(2024, 3, 9)


def test_days_and_explicit_ranges_move_the_limit_to_the_end():
    assert resolve_range(TODAY, days=0) == DateRange(TODAY, TODAY, TODAY)
    got = resolve_range(TODAY, start="01.03.2024", end="2024-03-05")
    assert got == DateRange(date(2024, 3, 1), date(2024, 3, 5), date(2024, 3, 5))


def test_a_future_end_is_clipped_to_today():
    got = resolve_range(TODAY, start="2024-03-01", end="2024-12-31")
    assert (got.last, got.limit) == (TODAY, TODAY)


@pytest.mark.parametrize(
    "args",
    [
        {"days": 3, "start": "2024-03-01"},
        {"start": "2024-03-01"},
        {"end": "2024-03-01"},
        {"days": -1},
        {"start": "2024-03-05", "end": "2024-03-01"},
        {"start": "5/3/2024", "end": "2024-03-06"},
    ],
)
def test_bad_ranges_are_refused(args):
    with pytest.raises(ValueError):
        resolve_range(TODAY, **args)


def test_argument_dates():
    assert argument_date("31.12.2023") == argument_date("2023-12-31") == date(2023, 12, 31)
    assert argument_date("1.2.2024") == date(2024, 2, 1)
    assert argument_date(datetime(2024, 2, 1, 5)) == date(2024, 2, 1)
    for bad in ("31.12.23", "2024-13-01", "30.02.2024", ""):
        with pytest.raises(ValueError):
            argument_date(bad)


def spine_of(spark, shifts, *dates):
    return period_spine(dates_frame(spark, dates), table(spark, "shifts", shifts))


def test_one_report_date_gives_its_whole_month(spark):
    rows = spine_of(spark, [(t("2023-01-01"), 1, 0)], date(2024, 2, 10)).collect()
    assert sorted(r.day for r in rows) == [datetime(2024, 2, d) for d in range(1, 30)]


def test_an_offset_counts_from_the_day_after_it_takes_effect(spark):
    shifts = [(t("2023-01-01"), 1, 360), (t("2024-01-10"), 1, 420), (t("2024-01-10"), 2, 900)]
    days = by_day(spine_of(spark, shifts, date(2024, 1, 5)).collect())
    assert days[9].start == t("2024-01-09 06:00") and days[9].hours == 24.0
    assert days[10].start == t("2024-01-10 06:00")
    assert days[10].end == days[11].start == t("2024-01-11 07:00")
    assert days[10].hours == 25.0
    assert days[31].end == t("2024-02-01 07:00")
    assert days[1].floor == t("2023-12-01 06:00")


def test_neighbouring_months_meet_without_gaps(spark):
    shifts = [(t("2023-01-01"), 1, 360), (t("2024-01-31"), 1, 300)]
    rows = spine_of(spark, shifts, date(2024, 1, 5), date(2024, 2, 5), date(2024, 1, 9)).collect()
    rows.sort(key=lambda r: r.day)
    assert len(rows) == 31 + 29
    assert all(a.end == b.start for a, b in zip(rows, rows[1:]))


def test_without_an_offset_in_force_bounds_are_null(spark):
    days = by_day(spine_of(spark, [(t("2024-01-03"), 1, 360)], date(2024, 1, 5)).collect())
    assert days[1].start is None and days[1].end is None
    # The close of a day is the open of the next one, which already has an offset.
    assert days[3].start is None and days[3].end == t("2024-01-04 06:00")
    assert days[4].start == t("2024-01-04 06:00")
    # The look-back floor stays unshifted instead.
    assert days[4].floor == t("2023-12-01")


def test_readings_fall_in_half_open_periods(spark):
    spine = spine_of(spark, [(t("2023-01-01"), 1, 360)], date(2024, 1, 5))
    moments = [
        "2024-01-01 05:59:59.999999",
        "2024-01-01 06:00:00",
        "2024-01-02 05:59:59.999999",
        "2024-01-02 06:00:00",
        "2024-02-01 05:59:59",
        "2024-02-01 06:00:00",
    ]
    readings = spark.createDataFrame([(datetime.fromisoformat(m),) for m in moments],
                                     "ts timestamp_ntz")
    got = {r.ts: r.day.day for r in assign_period(readings, spine, "ts").collect()}
    assert got == {
        datetime.fromisoformat(moments[1]): 1,
        datetime.fromisoformat(moments[2]): 1,
        datetime.fromisoformat(moments[3]): 2,
        datetime.fromisoformat(moments[4]): 31,
    }


def test_every_reading_has_at_most_one_period(spark):
    shifts = [(t("2023-01-01"), 1, 360), (t("2024-01-10"), 1, 1380), (t("2024-01-20"), 1, 0)]
    spine = spine_of(spark, shifts, date(2024, 1, 5))
    start = datetime(2023, 12, 30)
    times = [(start + timedelta(minutes=17 * i),) for i in range(3000)]
    readings = spark.createDataFrame(times, "ts timestamp_ntz")
    got = assign_period(readings, spine, "ts").collect()
    periods = [(r.start, r.end) for r in spine.collect()]
    want = [ts for (ts,) in times if any(a <= ts < b for a, b in periods)]
    assert sorted(r.ts for r in got) == want
    assert all(r.start <= r.ts < r.end for r in got)
