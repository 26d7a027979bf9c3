from datetime import date, datetime

import pytest

from opsreport import __main__ as cli
from opsreport.operators.timeaxis import DateRange
from opsreport.sources import tables
from opsreport.sources.schema import TABLES

JDBC = ["--jdbc", "jdbc:x://h/db", "--store", "s", "--jdbc-option", "user=a=b"]


def test_jdbc_arguments_become_a_connection():
    args = cli.arguments([*JDBC, "--jdbc-option", "driver=d.D", "--jdbc-partitions", "8"])
    assert cli.connection(args) == {"url": "jdbc:x://h/db", "user": "a=b", "driver": "d.D"}
    assert args.jdbc_partitions == 8


@pytest.mark.parametrize(
    "argv",
    [
        ["--store", "s"],
        [*JDBC, "--inputs", "folder"],
        [*JDBC, "--days", "3", "--start-date", "2024-01-01", "--end-date", "2024-01-02"],
        [*JDBC, "--jdbc-option", "nothing"],
    ],
)
def test_bad_arguments_are_refused(argv):
    with pytest.raises(SystemExit):
        cli.arguments(argv)


def test_bounds_span_the_months_and_the_look_back():
    low, high = cli.time_bounds(DateRange(date(2024, 1, 20), date(2024, 2, 3), date(2024, 2, 3)))
    assert low <= datetime(2023, 11, 30) and high >= datetime(2024, 3, 1, 23)


@pytest.mark.parametrize("name", list(TABLES))
def test_times_are_read_without_a_zone_and_split_if_they_can(name):
    bounds = (datetime(2024, 1, 1), datetime(2024, 2, 1))
    options = tables.jdbc_options(name, {"url": "u"}, bounds, 4)
    assert options["preferTimestampNTZ"] == "true" and options["dbtable"] == TABLES[name].source
    split = TABLES[name].source_time
    assert options.get("partitionColumn") == split
    assert ("numPartitions" in options) == bool(split)
    assert "numPartitions" not in tables.jdbc_options(name, {"url": "u"})


def test_a_jdbc_run_hands_its_options_to_every_scan(monkeypatch):
    seen = {}

    def scan(spark, name, location, fmt, connection, bounds, partitions):
        seen[name] = (fmt, connection["url"], bounds is not None, partitions)

    monkeypatch.setattr(tables, "read_source", scan)
    monkeypatch.setattr(cli, "run", lambda *a, **k: 0)
    monkeypatch.setattr(cli.SparkSession, "builder", FakeBuilder())
    assert cli.main([*JDBC, "--days", "3"]) == 0
    assert seen == {name: ("jdbc", "jdbc:x://h/db", True, 16) for name in TABLES}


class FakeBuilder:
    def appName(self, _):
        return self

    def getOrCreate(self):
        return None
