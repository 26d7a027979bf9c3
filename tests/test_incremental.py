"""A state merged step by step equals one consolidation of everything."""

import random
from datetime import date, datetime, timedelta

from opsreport.operators.consolidate import (
    consolidate,
    finished,
    merge_states,
    state_of,
    union_by_name,
)
from opsreport.plans.incremental import refresh
from opsreport.plans.jobs import Store, run_consolidation
from opsreport.sources.snapshots import read_snapshots, write_snapshot

SCHEMA = "report_date date, Data timestamp_ntz, x double, n int, ok boolean, note string"
FIRST = date(2024, 1, 1)


def snapshots(spark, seed, days, null=0.3):
    """Each snapshot restates the month to date, with gaps and zeros."""
    rng = random.Random(seed)
    rows = []
    for d in days:
        for back in range(min(d, 4)):
            data = datetime(2024, 1, 1) + timedelta(days=d - back)
            pick = lambda *of: None if rng.random() < null else rng.choice(of)
            row = (pick(0.0, 1.5, 2.5 + d), pick(0, d, 7), pick(True, False), pick("", f"s{d}"))
            rows.append((FIRST + timedelta(days=d), data, *row))
    return spark.createDataFrame(rows, SCHEMA)


def whole(spark, path, limit):
    return sorted(map(str, consolidate(read_snapshots(spark, path, limit), limit).collect()))


def test_steps_equal_one_consolidation(spark, tmp_path):
    path, root = str(tmp_path / "s"), str(tmp_path / "state")
    limit = date(2024, 1, 20)
    assert refresh(spark, path, root, limit) is None

    def step(expected_read, expected_gone, upto=limit):
        done = refresh(spark, path, root, upto)
        assert sorted(map(str, done.table.collect())) == whole(spark, path, upto)
        assert (done.read, done.gone) == (expected_read, expected_gone)

    write_snapshot(snapshots(spark, 1, range(1, 6)), path, at=datetime(2024, 2, 1))
    step(5, 0)
    write_snapshot(snapshots(spark, 2, range(5, 9)), path, at=datetime(2024, 2, 2))
    step(3, 0)
    # Restated days: what they said before must not come back, also where they now say nothing.
    write_snapshot(
        snapshots(spark, 3, (4, 8), null=0.9), path, force=True, at=datetime(2024, 2, 3)
    )
    step(2, 2)
    # Snapshots beyond the limit wait for a later one; a column may be new.
    write_snapshot(snapshots(spark, 4, (25,)), path, at=datetime(2024, 2, 4))
    step(0, 0)
    more = snapshots(spark, 5, (26,)).selectExpr("*", "cast(2.5 as double) as later")
    write_snapshot(more, path, at=datetime(2024, 2, 5))
    step(2, 0, date(2024, 1, 31))


def test_states_merge_in_any_order(spark, tmp_path):
    path = str(tmp_path / "s")
    for k, days in enumerate((range(1, 5), range(5, 8), range(8, 11))):
        write_snapshot(snapshots(spark, k, days), path, at=datetime(2024, 2, 1 + k))
    rows = read_snapshots(spark, path)
    days = [
        state_of(read_snapshots(spark, path, only=[FIRST + timedelta(days=d) for d in part]))
        for part in (range(1, 5), range(5, 8), range(8, 11))
    ]
    want = sorted(map(str, consolidate(rows).collect()))
    for a, b, c in ((0, 1, 2), (2, 0, 1), (1, 2, 0)):
        left = merge_states(merge_states(days[a], days[b]), days[c])
        right = merge_states(days[a], merge_states(days[b], days[c]))
        assert sorted(map(str, finished(left).collect())) == want
        assert sorted(map(str, finished(right).collect())) == want
    again = merge_states(merge_states(days[0], days[0]), state_of(union_by_name([rows, rows])))
    assert sorted(map(str, finished(again).collect())) == want


def test_a_run_may_consolidate_from_its_state(spark, tmp_path):
    store, limit = Store(str(tmp_path)), date(2024, 1, 20)
    assert run_consolidation(spark, store, limit, incremental=True) == 1
    for k, days in enumerate((range(1, 4), range(4, 6))):
        write_snapshot(snapshots(spark, k, days), store.treated, at=datetime(2024, 2, 1 + k))
        assert run_consolidation(spark, store, limit, incremental=True) == 0
        got = spark.read.parquet(store.consolidated).collect()
        assert sorted(map(str, got)) == whole(spark, store.treated, limit)
