"""Parts of a database read, and rows that do not fit."""

import random
from datetime import date, datetime, timedelta

from conftest import t
from pyspark.sql import functions as F

from opsreport.operators.intervals import assign_spans
from opsreport.plans.jobs import Store, set_aside
from opsreport.sources.quarantine import screened
from opsreport.sources.tables import day_counts_query, range_predicates, row_ranges


def test_ranges_leave_no_gap_and_share_the_rows():
    rng = random.Random(2)
    first = date(2024, 1, 1)
    counts = [(first + timedelta(days=d), rng.choice([0, 5, 40, 60, 2000])) for d in range(90)]
    rows = [
        datetime(d.year, d.month, d.day) + timedelta(days=k / n)
        for d, n in counts for k in range(n)
    ]
    for parts in (1, 7, 32):
        ranges = row_ranges(counts, parts)
        assert ranges[0][0] is None and ranges[-1][1] is None
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:], strict=False))
        held = [
            sum((lo is None or lo <= r) and (hi is None or r < hi) for r in rows)
            for lo, hi in ranges
        ]
        assert sum(held) == len(rows)
        assert max(held) <= 2.1 * len(rows) / parts
    assert row_ranges([], 4) == [(None, None)]


def test_predicates_split_every_row_once(spark):
    ranges = row_ranges([(date(2024, 1, 1), 90), (date(2024, 1, 2), 1), (date(2024, 1, 5), 9)], 5)
    predicates = range_predicates("ts", ranges)
    rows = [(t("2024-01-01") + timedelta(hours=h),) for h in range(-30, 200)] + [(None,)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    hits = sum((F.expr(f"({p})").cast("int") for p in predicates), F.lit(0))
    hits = F.coalesce(hits, F.lit(1))
    assert df.where(hits != 1).count() == 0
    assert len(predicates) >= 4 and predicates[0].endswith("ts IS NULL")
    assert df.where(" OR ".join(f"({p})" for p in predicates)).count() == len(rows)
    assert range_predicates("ts", [(None, None)]) == ["(ts IS NOT NULL) OR ts IS NULL"]
    assert "GROUP BY CAST(CDL_DATETIME_00001 AS DATE)" in day_counts_query("scale_readings")


RAW = "ts string, ipc_t string, mmd_t string, c160_t string"


def test_rows_that_do_not_fit_are_set_aside_with_their_reason(spark, tmp_path):
    rows = [
        ("2024-01-01 06:00:00", "1.5", None, "-999"),
        ("2024-01-01 07:00:00", "n/a", "2", None),
        ("2224-01-01 07:00:00", "x", "2", None),
        ("never", "1", "NaN", "Infinity"),
        (None, None, None, None),
    ]
    raw = spark.createDataFrame(rows, RAW)
    span = (datetime(2000, 1, 1), datetime(2100, 1, 1))
    good, bad = screened(raw, "scale_readings", *span)
    assert [tuple(r) for r in good.collect()] == [
        (t("2024-01-01 06:00"), 1.5, None, -999.0),
        (None, None, None, None),
    ]
    assert [r.reason for r in bad.collect()] == [
        "ipc_t: not double",
        "ts: out of range; ipc_t: not double",
        "ts: not timestamp_ntz; mmd_t: out of range; c160_t: out of range",
    ]
    store = Store(str(tmp_path))
    inputs, n = set_aside({"scale_readings": raw}, store, *span, at=t("2024-02-01"))
    assert n == 3 and inputs["scale_readings"].count() == 2
    kept = spark.read.parquet(store.quarantine)
    assert kept.count() == 3 and kept.where("row like '%never%'").count() == 1
    # Nothing wrong, nothing set aside; types that fit already stay as they are.
    again = set_aside({"scale_readings": good}, store, *span, at=t("2024-02-02"))
    assert again[1] == 0


def test_spans_of_any_length_equal_a_search(spark):
    rng = random.Random(6)
    start = datetime(2020, 1, 1)
    moment = lambda: start + timedelta(microseconds=rng.randrange(10**15))
    spans = []
    for i in range(150):
        a = moment()
        spans.append((rng.choice("ab"), i, a, a + timedelta(microseconds=10 ** rng.randrange(16))))
    spans += [("a", 900, start, start), ("a", 901, None, start), ("b", 902, moment(), None)]
    points = [(i, rng.choice("abc"), moment()) for i in range(300)]
    points += [(300 + s[1], s[0], s[2]) for s in spans[:150]]
    points += [(500 + s[1], s[0], s[3]) for s in spans[:150]]
    points += [(999, "a", None)]
    got = assign_spans(
        spark.createDataFrame(points, "i int, k string, ts timestamp_ntz"),
        spark.createDataFrame(spans, "k string, s int, start timestamp_ntz, end timestamp_ntz"),
        ["k"],
    )
    want = {
        (i, s) for i, k, ts in points for j, s, a, b in spans
        if j == k and ts and a and b and a <= ts < b
    }
    rows = got.select("i", "s").collect()
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_no_more_than_a_few_rows_are_joined_for_each_match(spark):
    # Year-long spans beside spans of seconds within one day.
    spans = spark.range(400).selectExpr(
        "'a' as k", "id as s",
        "timestampadd(SECOND, int(id * 200), timestamp_ntz'2024-01-01') as start",
        "timestampadd(SECOND, int(id * 200 + if(id % 40 = 0, 31536000, 150)), "
        "timestamp_ntz'2024-01-01') as end",
    )
    points = spark.range(4000).selectExpr(
        "'a' as k", "timestampadd(SECOND, int(id * 20), timestamp_ntz'2024-01-01') as ts"
    )
    joined = assign_spans(points, spans, ["k"])
    matches = joined.count()
    # The same join without the exact check, as the cells alone would have it.
    from unittest import mock

    from pyspark.sql import DataFrame

    with mock.patch.object(DataFrame, "where", lambda self, c: self):
        loose = assign_spans(points, spans, ["k"]).count()
    assert matches <= loose <= 1.5 * matches


def test_totals_of_spans_equal_those_of_the_pairs(spark):
    from pyspark.sql import functions as F

    rng = random.Random(8)
    start = datetime(1969, 12, 31)
    spans = [("a", 901, start, start), ("a", 902, None, start)]
    spans.append((None, 900, start, start + timedelta(days=1)))
    for i in range(200):
        a = start + timedelta(microseconds=rng.randrange(2 * 86_400 * 10**6))
        spans.append((rng.choice("ab"), i, a, a + timedelta(microseconds=10 ** rng.randrange(13))))
    moment = lambda: start + timedelta(milliseconds=rng.randrange(2 * 86_400_000))
    points = [(i % 500, rng.choice("abc"), moment()) for i in range(600)]
    points += [(None, s[0], s[2]) for s in spans[:40]] + [(600 + s[1], s[0], s[3]) for s in spans]
    # More points in a microsecond than a leaf may hold.
    crowd = [(2000 + i % 3, "a", spans[53][2]) for i in range(300)]
    totals = {
        "n": (F.count(F.lit(1)), F.sum),
        "least": (F.min("s"), F.min),
        "until": (F.max("end"), F.max),
    }
    held = spark.createDataFrame(spans, "k string, s int, start timestamp_ntz, end timestamp_ntz")
    for some in (points, points + crowd, []):
        at = spark.createDataFrame(some, "i int, k string, ts timestamp_ntz")
        pairs = assign_spans(at, held, ["k"])
        want = pairs.groupBy("i").agg(*[made.alias(n) for n, (made, _) in totals.items()])
        got = assign_spans(at, held, ["k"], by=["i"], totals=totals)
        key = lambda df: sorted(map(str, df.collect()))
        assert key(got) == key(want) and got.columns == want.columns


def test_exploded_spans_are_not_broadcast(spark):
    from pyspark.sql import functions as F

    spans = spark.range(50).selectExpr(
        "'a' as k", "id as s", "timestampadd(SECOND, int(id), timestamp_ntz'2024-01-01') as start",
        "timestampadd(SECOND, int(id * 90 + 90), timestamp_ntz'2024-01-01') as end",
    )
    points = spans.selectExpr("k", "s as i", "end as ts")
    totals = {"n": (F.count(F.lit(1)), F.sum)}
    for joined in (
        assign_spans(points, spans, ["k"]),
        assign_spans(points, spans, ["k"], by=["i"], totals=totals),
    ):
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
