"""Spelling variants: words one edit apart, grouped under the commoner one.

Letters are hashed to a few symbols. Each *reduced* word (there are fewer of them than words)
generates its full one-edit neighbourhood over the small alphabet: itself, as a replaced letter
may fall to the same symbol, and every deletion, replacement and insertion. Neighbourhoods meet
the reduced words that occur; the words behind both ends are joined, and a pair stays if the
original strings are exactly one edit apart. Words one edit apart reduce to equal words or to
words one edit apart, so no pair is missed.

A neighbour is a 64-bit polynomial hash worked out from the hashes of what stands before and
behind the edit, at a cost that does not depend on the length of the word, in slices of bounded
size; equal reduced words have equal hashes, and a chance match is dropped by the exact check.
Distinct reduced words are told apart by 128 bits.

Words are maximal runs of letters, with A-Z in lower case, at least ``least_length`` code points
long, that occur at least ``least_count`` times. A word's *form* is its commonest near word
(ties: least in code-point order) if that is at least ``ratio`` times as common as the word; its
*root* is where the chain of forms ends. Counts at least double along a chain, so it has no
cycles and is at most as long as the logarithm of the greatest count.

Null and empty texts have no words; a repeated row counts again; a null id counts as an empty
one; an empty table gives no rows. The words of a text are counted where it is read, and only
counts move; near pairs are rows of joins, never a group in one task. The tables between the
joins are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsreport.llm.common import written
from opsreport.llm.components import chain_ends

SYMBOLS = 6
LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
#: What a run of letters is: Basic Latin and Latin-1 letters, with the two signs among them.
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Every deletes-th run by its checksum loses a letter, which plants variants in the text.
DELETES = 97
BASE, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Keys of one slice of neighbourhoods.
SLICE = 1 << 20

WITH_OWN = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("own", T.LongType()),
        T.StructField("second", T.LongType()),
    ]
)
KEYS = T.StructType([T.StructField("own", T.LongType()), T.StructField("key", T.LongType())])


def lower_ascii(run: Column) -> Column:
    """A-Z in lower case and nothing else; the general function will do where all is ASCII."""
    return F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(
        F.translate(run, UPPER, UPPER.lower())
    )


def planted(id_column: Column, run: Column) -> Column:
    """The run, or the run without one letter where its checksum with the id says so."""
    h = F.crc32(F.concat(F.coalesce(id_column.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % DELETES == 0, shorter).otherwise(run)


def vocabulary(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n)."""
    runs = docs.select(
        F.col(id_col).alias("id"),
        F.explode(
            F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(LETTERS), F.lit(0))
        ).alias("run"),
    ).where(F.char_length("run") >= least_length)
    low = runs.select("id", lower_ascii(F.col("run")).alias("run"))
    words = low.select(planted(F.col("id"), F.col("run")).alias("word"))
    counts = words.where(F.char_length("word") >= least_length).groupBy("word")
    return counts.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def symbol_codes(words: list[str], symbols: int) -> np.ndarray:
    """Symbols 1 to ``symbols`` of all letters of words of one length, a row for each word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    mixed = (points * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)
    codes = ((mixed * np.uint64(symbols)) >> np.uint64(32)) + np.uint64(1)
    return codes.reshape(len(words), -1)


def _powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    out[1:] = BASE
    return np.multiply.accumulate(out)


def _before(codes: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """Hash of the first i symbols of each row, for every i."""
    n, length = codes.shape
    out = np.zeros((n, length + 1), np.uint64)
    for i in range(length):
        out[:, i + 1] = out[:, i] * base + codes[:, i]
    return out


def own_keys(codes: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    return _before(codes, base)[:, -1]


def neighbourhoods(codes: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, key) arrays: keys of every reduced word at most one edit from each row's own.

    Edits with one result (deleting either of two equal symbols, putting a symbol before or
    behind an equal one) count once.
    """
    n, length = codes.shape
    before, power = _before(codes), _powers(length + 1)
    own = before[:, -1]
    # What stands from place i on weighs the whole less the part before it.
    behind = own[:, None] - before * power[length - np.arange(length + 1)]
    rows = np.arange(n)
    yield rows, own
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    width = max(1, SLICE // max(1, n * symbols))
    for lo in range(0, length + 1, width):
        i = np.arange(lo, min(lo + width, length + 1))
        put = (
            before[:, i, None] * power[length - i + 1][None, :, None]
            + every * power[length - i][None, :, None]
            + behind[:, i, None]
        )
        at = i[i < length]
        here = codes[:, at, None] == every
        new = np.ones(put.shape, bool)
        new[:, : len(at)] &= ~here
        r, *_ = np.nonzero(new)
        yield r, put[new]
        if not len(at):
            continue
        swapped = own[:, None, None] + (every - codes[:, at, None]) * power[length - 1 - at][
            None, :, None
        ]
        r, *_ = np.nonzero(~here)
        yield r, swapped[~here]
        gone = before[:, at] * power[length - 1 - at] + behind[:, at + 1]
        last = np.ones(gone.shape, bool)
        inner = at[at + 1 < length]
        last[:, : len(inner)] = codes[:, inner] != codes[:, inner + 1]
        r, _ = np.nonzero(last)
        yield r, gone[last]


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    """Indices of words of one length, so many at once that their letters fill a slice."""
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths):
        found = np.nonzero(lengths == length)[0]
        step = max(1, SLICE // (8 * (int(length) + 1)))
        for lo in range(0, len(found), step):
            yield found[lo : lo + step]


def _with_own(symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            own, second = np.zeros((2, len(words)), np.uint64)
            for group in _by_length(words):
                codes = symbol_codes([words[i] for i in group], symbols)
                own[group], second[group] = own_keys(codes), own_keys(codes, SECOND)
            keys = [pa.array(x.view(np.int64)) for x in (own, second)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), *keys], WITH_OWN.names
            )

    return run


def _generated(symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for group in _by_length(words):
                codes = symbol_codes([words[i] for i in group], symbols)
                own = own_keys(codes)
                for rows, keys in neighbourhoods(codes, symbols):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[rows].view(np.int64)), pa.array(keys.view(np.int64))],
                        ["own", "key"],
                    )

    return run


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words exactly one edit apart."""
    own = written(words.select("word", "n").mapInArrow(_with_own(symbols), WITH_OWN), "reduced")
    # One word stands for all that reduce to the same; two hashes tell reduced words apart.
    stands = own.groupBy("own", "second").agg(F.min("word").alias("word"))
    met = (
        stands.select("word")
        .mapInArrow(_generated(symbols), KEYS)
        .join(stands.select(F.col("own").alias("key")), "key", "left_semi")
    )
    ends = own.select(
        F.col("own").alias("key"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    candidates = own.join(met, "own").select("word", "n", "key").join(ends, "key")
    return candidates.where(F.levenshtein("word", "near", 1) == 1).select(
        "word", "n", "near", "near_n"
    )


def spelling_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    symbols: int = SYMBOLS,
    ratio: int = RATIO,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = written(vocabulary(docs, id_col, text_col, least_length, least_count), "words")
    best = (
        near_words(words, symbols)
        .dropDuplicates(["word", "near"])
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"),
        )
    )
    enough = -F.col("best.rank") >= F.lit(ratio) * F.col("n")
    formed = written(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.rank")).alias("form_n"),
        ),
        "forms",
    )
    links = formed.where(F.col("form").isNotNull())
    ends = chain_ends(links.select(F.col("word").alias("x"), F.col("form").alias("p")))
    return formed.join(
        ends.select(F.col("x").alias("word"), F.col("p").alias("root")), "word", "left"
    ).select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
