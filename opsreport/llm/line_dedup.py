"""Line dedup by site-relative frequency, in DataFrame functions.

Of all pages of a host, which share holds a line? Lines above ``ratio`` are boilerplate of that
host and are dropped from its pages; the same line stays elsewhere. A line counts once per
page, without the white space around it, and only from ``least_pages`` pages on, so that three
copies on a small site do not empty each other.

Lines without text are kept, as are all lines of rows without a host; a null text stays null;
a repeated row is one more page. A text that loses all lines stays as an empty text.
With ``by_text`` pages of a host with the same lines are one page, so that a group of copies
does not make all its lines boilerplate; near copies remain pages of their own.

Plan: pages are counted per host and lines per (host, line) with partial sums; lines travel as
two 64-bit hashes. The boilerplate of a host, of which there are at most lines per page / ratio,
joins its pages once; the pages of a host are spread over ``salts`` keys, so a host with a third
of all pages does not meet in one task. Raise ``salts`` with the cluster, and keep adaptive
execution on: it sends small rules to every task, and splits what is still uneven otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATIO = 0.1
LEAST_PAGES = 5
SALTS = 16
BLANK = " \t\r\x0b\x0c"


def line_keys(text: Column) -> Column:
    """Array with a pair of hashes for each line; null for a line without text."""
    trimmed = F.transform(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANK)))
    return F.transform(
        trimmed,
        lambda x: F.when(
            x != "", F.struct(F.xxhash64(x).alias("a"), F.xxhash64(x, F.lit(1)).alias("b"))
        ),
    )


def boilerplate(
    pages: DataFrame,
    host_col: str,
    text_col: str,
    ratio: float,
    least_pages: int,
    by_text: bool = False,
) -> DataFrame:
    """host and the array of its boilerplate lines."""
    own = pages.select(F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    own = own.where(F.col("host").isNotNull()).select(
        "host", F.array_distinct(F.array_compact(line_keys(F.col("text")))).alias("keys")
    )
    if by_text:
        one = [F.xxhash64("keys").alias("x"), F.xxhash64("keys", F.lit(1)).alias("y")]
        own = own.select("host", "keys", *one).dropDuplicates(["host", "x", "y"])
    totals = own.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = own.select("host", F.explode("keys").alias("k"))
    counts = (
        lines.groupBy("host", F.col("k.a").alias("a"), F.col("k.b").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_pages)
    )
    often = counts.join(totals, "host").where(F.col("n") > ratio * F.col("pages"))
    return often.groupBy("host").agg(F.collect_set(F.struct("a", "b")).alias("dropped"))


def drop_boilerplate(
    pages: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    salts: int = SALTS,
    counts: bool = False,
    by_text: bool = False,
) -> DataFrame:
    """``pages`` with the boilerplate lines gone from the text.

    With ``counts`` the columns ``n_lines`` and ``n_dropped`` are added: lines with text, and
    those of them that went.
    """
    names = pages.columns
    rules = boilerplate(pages, host_col, text_col, ratio, least_pages, by_text)
    rules = rules.select(
        F.col("host").alias("_host"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
        F.col("dropped").alias("_dropped"),
    )
    left = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
        F.col(host_col).alias("_host"),
        F.pmod(F.xxhash64(text_col), F.lit(salts)).cast("int").alias("_salt"),
    )
    joined = left.join(rules, ["_host", "_salt"], "left")
    text = F.col("_row").getField(text_col)
    keys = line_keys(text)
    lost = lambda k: F.array_contains(F.col("_dropped"), k)
    pairs = F.arrays_zip(F.split(text, "\n").alias("line"), keys.alias("key"))
    kept = F.filter(pairs, lambda p: p["key"].isNull() | ~lost(p["key"]))
    new = F.when(
        F.col("_dropped").isNotNull() & F.exists(keys, lambda k: k.isNotNull() & lost(k)),
        F.array_join(F.transform(kept, lambda p: p["line"]), "\n"),
    ).otherwise(text)
    columns = [
        (new if c == text_col else F.col("_row").getField(c)).alias(c) for c in names
    ]
    if counts:
        dropped = F.filter(keys, lambda k: k.isNotNull() & lost(k))
        columns += [
            F.coalesce(F.size(F.array_compact(keys)), F.lit(0)).cast("long").alias("n_lines"),
            F.when(F.col("_dropped").isNull() | text.isNull(), 0)
            .otherwise(F.size(dropped))
            .cast("long")
            .alias("n_dropped"),
        ]
    return joined.select(columns)
