"""Quality rules by compression bands.

Text that says little compresses too well, noise hardly at all. Every whole document and
every fixed chunk of it is compressed with zstandard; a ratio (compressed to raw bytes)
outside the limits for its length rejects. Word statistics of the base rules come along.

Limits: ``DOC_BANDS`` by document bytes, ``CHUNK_BAND`` for chunks of ``CHUNK`` bytes, the last
of which may overlap the one before, so that every byte of a text of that size is read. A
document fails by its chunks if more than ``CHUNK_SHARE`` of them lie outside. Below
``SHORTEST`` bytes the header of the format weighs more than the text, so only the base
rules decide. Null and empty texts have no words and fail the base rules; repeated rows
each get their own equal result; other columns of the input are not looked at.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from opsreport.llm.common import bytes_list, record, struct_column, text_or_empty

LEVEL = 3
SHORTEST = 256
#: (from bytes, least ratio, largest ratio)
DOC_BANDS = (
    (256, 0.47, 0.95),
    (1024, 0.455, 0.85),
    (2048, 0.435, 0.80),
    (4096, 0.41, 0.75),
    (8192, 0.385, 0.70),
    (32768, 0.36, 0.70),
)
CHUNK = 4096
CHUNK_BAND = (0.30, 0.75)
CHUNK_SHARE = 0.25
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_NOT_A_CHARACTER = SPACE + bytes(range(0x80, 0xC0))
_STARTS = [b[0] for b in DOC_BANDS]

SPARK, ARROW = record(
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_bytes long, doc_ratio double, n_chunks long, n_chunks_out long, in_bands boolean"
)


def repeated_words(words: list[bytes]) -> int:
    """Words lying in a window of three that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    code: dict[bytes, int] = {}
    ids = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, n)
    m = len(code)
    if m < 1 << 20:
        key = (ids[:-2] * m + ids[1:-1]) * m + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * m + ids[1:], return_inverse=True)[1]
        key = pairs[:-1] * m + ids[2:]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k : n - 2 + k] |= twice
    return int(inside.sum())


def doc_stats(data: bytes, zstd: zstandard.ZstdCompressor) -> tuple:
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    size = len(data)
    ratio, n_chunks, out = None, 0, 0
    in_bands = True
    if size >= SHORTEST:
        ratio = len(zstd.compress(data)) / size
        _, least, most = DOC_BANDS[bisect_right(_STARTS, size) - 1]
        in_bands = least <= ratio <= most
        if size >= CHUNK:
            # What is left behind the last whole chunk is read as the last CHUNK bytes.
            for at in [*range(0, size - CHUNK + 1, CHUNK), *([size - CHUNK] if size % CHUNK else [])]:
                part = len(zstd.compress(data[at : at + CHUNK])) / CHUNK
                n_chunks += 1
                out += not CHUNK_BAND[0] <= part <= CHUNK_BAND[1]
            in_bands = in_bands and out <= CHUNK_SHARE * n_chunks
    return (
        len(words),
        len(data.translate(None, _NOT_A_CHARACTER)),
        size - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        size,
        ratio,
        n_chunks,
        out,
        in_bands,
    )


@arrow_udf(SPARK)
def _stats(text: pa.Array) -> pa.Array:
    zstd = zstandard.ZstdCompressor(level=LEVEL)
    return struct_column([doc_stats(b, zstd) for b in bytes_list(text)], ARROW)


def band_stats(text: str | Column) -> Column:
    """Struct of all counts, ratios and the verdict of the bands for a text column."""
    return _stats(text_or_empty(text))


def base_failed(stats: Column) -> Column:
    n = stats["n_words"]
    return (n < LEAST_WORDS) | (
        100 * stats["n_repeat_words"] > MOST_REPEATED_PERCENT * n
    )


def compression_bands(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, counts, ratios, ``base_failed``, ``in_bands`` and ``kept``."""
    s = docs.select(F.col(id_col), band_stats(text_col).alias("s"))
    failed = base_failed(F.col("s"))
    return s.select(
        id_col,
        "s.*",
        failed.alias("base_failed"),
        (~failed & F.col("s.in_bands")).alias("kept"),
    )


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text passes, with the columns they came with."""
    s = band_stats(text_col)
    return docs.where(~base_failed(s) & s["in_bands"])
