"""Token counts: lengths of encodings, worked out in Arrow batches.

Texts of an Arrow batch are cut into pieces of about ``PIECE`` characters at safe boundaries and
gathered into calls of about ``CALL`` bytes, however long or short the texts are. Only the
lengths leave the function.

A boundary is safe if no token can cross it. In the sentencepiece model a space opens a word,
and no piece of its vocabulary holds the mark of a space after another character, which is
checked when the model is loaded. So a text may be cut at a single space between two other
characters: the space is dropped and comes back as the prefix of the next part. Without such a
space, or with another kind of model, a text stays whole.

For ``.json`` files the tokenizers library counts whole texts; for ``.model`` files
sentencepiece does. Null and empty texts have no tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from opsreport.llm.common import text_or_empty

PIECE = 1 << 14
CALL = 1 << 20
LIMIT = 4096
MARK = "▁"

_LOADED: dict[str, tuple] = {}


def _sentencepiece(path: str) -> tuple:
    """The processor, and whether texts may be cut at spaces."""
    if path not in _LOADED:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        inner = any(
            MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size())
        )
        sample = "a  b c"
        cut = sp.encode("a  b") + sp.encode("c")
        _LOADED[path] = (sp, not inner and sp.encode(sample) == cut)
    return _LOADED[path]


def _tokenizer(path: str):
    if path not in _LOADED:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _LOADED[path] = (t, False)
    return _LOADED[path]


def safe_pieces(text: str, most: int = PIECE) -> Iterator[str]:
    """The text in parts of about ``most`` characters, cut at lone spaces only."""
    start, n = 0, len(text)
    while n - start > most:
        at = text.find(" ", start + most)
        while 0 <= at and (
            at + 1 >= n or text[at + 1] in (" ", MARK) or text[at - 1] in (" ", MARK)
        ):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at + 1
    yield text[start:]


def lengths(texts: list[str], path: str) -> list[int]:
    """Numbers of tokens, in calls balanced by size."""
    is_piece_model = path.endswith(".model")
    model, may_cut = _sentencepiece(path) if is_piece_model else _tokenizer(path)
    counts = [0] * len(texts)
    owners: list[int] = []
    call: list[str] = []
    size = 0

    def flush() -> None:
        if is_piece_model:
            found = [len(x) for x in model.encode(call, num_threads=1)]
        else:
            found = [len(x) for x in model.encode_batch(call, add_special_tokens=False)]
        for owner, k in zip(owners, found, strict=True):
            counts[owner] += k
        owners.clear()
        call.clear()

    for i, text in enumerate(texts):
        for part in safe_pieces(text) if may_cut else (text,):
            if not part:
                continue
            owners.append(i)
            call.append(part)
            size += len(part.encode("utf-8", "replace"))
            if size >= CALL:
                flush()
                size = 0
    if call:
        flush()
    return counts


def token_count(text: str | Column, path: str) -> Column:
    """Number of tokens of a text column."""

    @arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        return pa.array(lengths(column.to_pylist(), path), pa.int64())

    return count(text_or_empty(text))


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """One row per row of ``docs``: id, UTF-8 bytes, tokens, and whether they pass ``limit``."""
    text = text_or_empty(text_col)
    n = docs.select(
        F.col(id_col),
        F.octet_length(text).cast("long").alias("n_bytes"),
        token_count(text, path).alias("n_tokens"),
    )
    return n.withColumn("over_limit", F.col("n_tokens") > limit)
