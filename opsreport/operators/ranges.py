"""Rows dealt to ranges of a key, so that an order over all rows needs no single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parts_of(spark: SparkSession) -> int:
    """How many ranges an order over a whole table is cut into: a few for every task."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def rough_edges(df: DataFrame, key: Column, parts: int) -> list[int]:
    """Inner edges of about ``parts`` ranges of equal row counts, ascending. Empty without a
    key that is not null. Keys above the last edge are a range too.

    One pass over the key column with a mergeable sketch, which rounds long keys to doubles;
    ``parts`` numbers reach the driver.
    """
    shares = [i / parts for i in range(1, parts)] or [0.5]
    found = df.agg(F.percentile_approx(key, shares, max(10_000, 10 * parts))).first()[0]
    return sorted(set(found or ()))


def range_edges(df: DataFrame, key: Column, parts: int) -> list[int]:
    """Greatest keys of the ranges, ascending; the last one is the greatest key of all. Edges
    are keys that occur, also where a double would not hold them: a second pass takes the
    greatest key between two rough edges. A key that holds more rows than a range has shares
    its range with few others."""
    rough = rough_edges(df, key, parts)
    keys = df.where(key.isNotNull()).select(key.alias("key"), range_of(key, rough).alias("at"))
    return sorted(r["top"] for r in keys.groupBy("at").agg(F.max("key").alias("top")).collect())


def range_of(key: Column, edges: list[int]) -> Column:
    """Index of the first edge that is not below the key, by binary search; ``len(edges)``
    beyond the last. The edges are one literal array, so the plan does not grow with them."""
    if not edges:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, edges))), ",").cast("array<bigint>")
    steps = [1 << b for b in reversed(range(len(edges).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(
            (at + s <= len(edges)) & (F.get(table, at + s - 1) < key), at + s
        ).otherwise(at),
    )
