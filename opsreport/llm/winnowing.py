"""Document fingerprints by winnowing, in DataFrame functions.

A text is cut into words; every run of ``k`` words has a rolling (polynomial) hash; of each
window of ``w`` neighbouring hashes the smallest is kept, the rightmost one of equals. What is
kept, each time with its position, is the fingerprint. Two texts that share ``w + k - 1`` words
in a row share a whole window and so at least one hash, wherever the run stands; the positions
tell where. About 2 / (w + 1) of all hashes are kept.

A word is a run without white space; a character of a script that does not part words (Han,
kana, Thai) is a word of its own. Its code is the CRC-32 of its UTF-8 bytes. The hash of a run
is the sum of code * BASE^(k - 1 - i) modulo 2^31 - 1, built for all places at once from the
hashes of half as long runs. A text of fewer than k words has one hash, as if followed by words
of code 0; one of fewer than w hashes is a single window.

A null text counts as empty; a text without words has an empty fingerprint. Likeness is the
share of distinct hashes in common; two empty fingerprints are alike (1.0), an empty and
another one are not (0.0). Positions count words from 0.

``neighbours`` puts the next document in descending order of ids beside each one. Rows follow
each other by (id, hash of the text), so rows of the same id are documents of their own, and
equal rows are interchangeable. Rows without an id stand outside the order: they borrow nothing
and have no next document. A single row is its own next one. Ids are dealt to ranges whose edges
are quantiles (as many ranges as four times the shuffle partitions), each range is one window,
and the first row of a range also goes to the range before it; only the edges reach the driver.
Rows of one id share a range; ids are expected to be nearly unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsreport.functions.bind import let
from opsreport.operators.ranges import range_edges, range_of

GRAM = 5
WINDOW = 16
#: A prime below 2^31: a hash, a position of 32 bits and products of two hashes fit in a long.
PRIME = 2**31 - 1
BASE = 1_103_515_245
SPACELESS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}"


def words(text: Column) -> Column:
    """The words of a text without nulls. A text of one byte a character has no character of
    the scripts that do not part words, which saves looking for them."""
    apart = F.when(F.octet_length(text) == F.char_length(text), text).otherwise(
        F.regexp_replace(text, f"[{SPACELESS}]", " $0 ")
    )
    return F.filter(F.split(apart, "[ \\t-\\r]+"), lambda x: x != "")


def _beside(a: Column, b: Column, offset: int, both) -> Column:
    """``both(a[i], b[i + offset])`` for every i up to the end of b."""
    n = F.greatest(F.size(b) - offset, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1 + offset), n), both)


def _joined(power: int):
    factor = pow(BASE, power, PRIME)
    return lambda x, y: (x * F.lit(factor) + y) % F.lit(PRIME)


def rolling(codes: Column, k: int) -> Column:
    """Hash of each run of k codes: runs of 1, 2, 4, ... codes are put together."""

    def grow(made: dict[int, Column], length: int) -> Column:
        if length == k:
            return made[k]
        if 2 * length <= k:
            longer = _beside(made[length], made[length], length, _joined(length))
            return let(longer, lambda h: grow(made | {2 * length: h}, 2 * length))
        # The rest of k's binary digits.
        more = max(n for n in made if length + n <= k)
        longer = _beside(made[length], made[more], length, _joined(more))
        return let(longer, lambda h: grow(made | {length + more: h}, length + more))

    if k == 1:
        return F.transform(codes, lambda c: c % F.lit(PRIME))
    return let(codes, lambda c: grow({1: c}, 1))


def window_minima(values: Column, w: int) -> Column:
    """Smallest of each w neighbours, by windows of 1, 2, 4, ... and one overlapping step."""

    def widen(v: Column, width: int) -> Column:
        if width == w:
            return v
        step = min(width, w - width)
        wider = _beside(v, v, step, lambda x, y: F.least(x, y))
        return let(wider, lambda x: widen(x, width + step))

    return let(values, lambda v: widen(v, 1))


def fingerprint(text: Column, k: int = GRAM, w: int = WINDOW) -> Column:
    """Array of longs, in the order of the text: the hash times 2^32, less the position."""

    def padded(codes: Column) -> Column:
        short = (F.size(codes) > 0) & (F.size(codes) < k)
        zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(k) - F.size(codes))
        return F.when(short, F.concat(codes, zeros)).otherwise(codes)

    def selected(packed: Column) -> Column:
        few = (F.size(packed) > 0) & (F.size(packed) < w)
        return F.when(few, F.array(F.array_min(packed))).otherwise(
            let(
                window_minima(packed, w),
                lambda m: F.filter(m, lambda x, i: (i == 0) | (x != F.get(m, i - 1))),
            )
        )

    codes = F.transform(words(F.coalesce(text, F.lit(""))), lambda x: F.crc32(x))
    hashes = rolling(let(codes, padded), k)
    # The larger position makes the smaller value, so the rightmost of equals wins.
    return let(F.transform(hashes, lambda h, i: F.shiftleft(h, 32) - i), selected)


def prints(marks: Column) -> Column:
    """Array of structs (hash, position) of a fingerprint."""
    return F.transform(
        marks,
        lambda m: F.struct(hashes_of(m).alias("hash"), position_of(m).alias("position")),
    )


def hashes_of(mark: Column) -> Column:
    return F.shiftright(mark + F.lit(2**32 - 1), 32)


def position_of(mark: Column) -> Column:
    return F.pmod(-mark, F.lit(2**32))


def written_out(marks: Column) -> Column:
    """The fingerprint as text: ``hash:position``, parted by blanks."""
    return F.array_join(
        F.transform(marks, lambda m: F.concat_ws(":", hashes_of(m), position_of(m))), " "
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of distinct hashes that two fingerprints have in common."""

    def shared(x: Column, y: Column) -> Column:
        common = F.size(F.array_intersect(x, y)).cast("double")
        return F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(1.0)).otherwise(
            let(common, lambda c: c / (F.size(x) + F.size(y) - c))
        )

    distinct = lambda marks: F.array_distinct(F.transform(marks, hashes_of))
    return let(distinct(a), lambda x: let(distinct(b), lambda y: shared(x, y)))


def with_next(docs: DataFrame, id_col: str, order: list[str], carried: list[str]) -> DataFrame:
    """``docs`` with a struct ``_next`` of the ``carried`` columns of the row that follows in
    descending order of the id, then ascending order of ``order``; after the last comes the
    first. Null in rows without an id."""
    spark = docs.sparkSession
    key = F.col(id_col)
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = range_edges(docs, key, parts)
    payload = F.struct(*carried)
    outside = docs.where(key.isNull()).withColumn("_next", F.when(F.lit(False), payload))
    if not edges:
        return outside
    at = range_of(key, edges)
    # An edge is the greatest id of its range: the rows that follow the range above it.
    guests = docs.where(key.isin(edges)).select(
        "*",
        F.when(key == edges[-1], F.lit(0)).otherwise(at + 1).alias("_range"),
        F.lit(True).alias("_guest"),
    )
    placed = docs.where(key.isNotNull()).select(
        "*", at.alias("_range"), F.lit(False).alias("_guest")
    )
    within = Window.partitionBy("_range").orderBy("_guest", key.desc(), *order)
    return (
        placed.unionByName(guests)
        .withColumn("_next", F.lead(payload).over(within))
        .where(~F.col("_guest"))
        .drop("_range", "_guest")
        .unionByName(outside)
    )


def edited_fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = GRAM,
    w: int = WINDOW,
) -> DataFrame:
    """One row per document: its fingerprint, that of the text with its second half replaced
    by the beginning of the next document, and how alike they are.

    Texts are moved once, with their fingerprints; both fingerprints of a row are worked out
    where the row is.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id",
        "text",
        F.xxhash64("text").alias("_order"),
        fingerprint(F.col("text"), k, w).alias("marks"),
    )
    paired = with_next(own, "doc_id", ["_order"], ["text", "marks"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - half),
        F.substring(F.coalesce(F.col("_next.text"), F.lit("")), F.lit(1), half),
    )
    made = let(
        edited,
        lambda e: let(
            fingerprint(e, k, w),
            lambda m: F.struct(
                F.sha2(e, 256).alias("sha256"),
                written_out(m).alias("marks"),
                likeness(F.col("marks"), m).alias("near"),
            ),
        ),
    )
    return paired.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        written_out(F.col("marks")).alias("fingerprint"),
        F.when(F.col("_next").isNull(), 0.0)
        .otherwise(likeness(F.col("marks"), F.col("_next.marks")))
        .alias("near_next"),
        made.alias("_made"),
    ).select(
        "doc_id",
        "n_chars",
        F.col("_made.sha256").alias("edited_sha256"),
        "fingerprint",
        F.col("_made.marks").alias("edited_fingerprint"),
        F.col("_made.near").alias("near_edited"),
        "near_next",
    )


def fingerprints(
    docs: DataFrame, text_col: str = "text", k: int = GRAM, w: int = WINDOW
) -> DataFrame:
    """``docs`` with their fingerprint as an array of (hash, position), for an index by hash.
    A column of that name is replaced."""
    return docs.withColumn(
        "fingerprint", prints(fingerprint(F.col(text_col).cast("string"), k, w))
    )
