from __future__ import annotations

import os
import random
import re

import zstandard
from pyspark.sql import functions as F

from opsreport.llm import quality as Q
from opsreport.llm.queries import op5_compression_bands


def plain(text: str | None) -> dict:
    """The definitions word for word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {
        i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)
    } if len(windows) < 3000 else None
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": None if inside is None else len(inside),
    }


def band_verdict(text: str) -> bool:
    data = text.encode()
    if len(data) < Q.SHORTEST:
        return True
    z = zstandard.ZstdCompressor(level=3)
    _, low, high = [b for b in Q.DOC_BANDS if b[0] <= len(data)][-1]
    good = low <= len(z.compress(data)) / len(data) <= high
    if len(data) >= 2 * Q.CHUNK:
        parts = [data[i : i + Q.CHUNK] for i in range(0, len(data) - Q.CHUNK + 1, Q.CHUNK)]
        ratios = [len(z.compress(p)) / len(p) for p in parts]
        out = sum(not Q.CHUNK_BAND[0] <= r <= Q.CHUNK_BAND[1] for r in ratios)
        good = good and out <= Q.CHUNK_SHARE * len(parts)
    return good


def test_query_equals_the_definitions(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = op5_compression_bands(spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        for name, value in plain(texts[r.doc_id]).items():
            assert value is None or r[name] == value, (r.doc_id, name)
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed
        assert r.kept == (not failed and band_verdict(texts[r.doc_id]))


def test_clean_labelled_documents_are_kept(spark):
    folder = "/root/testdata/sf0.01"
    good = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1")
    rows = op5_compression_bands(spark, folder).join(good, "doc_id").where("not base_failed")
    assert rows.where("not kept").count() == 0


def test_repetitive_and_incompressible_texts_go(spark):
    rng = random.Random(5)
    noise = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) + " " * (i % 3 == 0) for i in range(9000))
    cases = [
        (1, "buy now at our shop " * 400),
        (2, os.urandom(6000).hex() + " " + noise),
        (3, noise),
    ]
    rows = Q.compression_bands(spark.createDataFrame(cases, "doc_id long, text string"))
    found = {r.doc_id: r for r in rows.collect()}
    assert not found[1].kept and not found[1].in_bands
    assert not found[3].in_bands


def test_one_bad_part_of_a_long_text_is_seen_by_its_chunks():
    z = zstandard.ZstdCompressor(level=3)
    clean = "".join(random.Random(2).choices("abcdefghijklmnopqrstuvwxyz    ", k=40_000))
    assert Q.doc_stats(clean.encode(), z)[9]
    mixed = clean + "spam spam " * 2500
    stats = Q.doc_stats(mixed.encode(), z)
    assert stats[8] > Q.CHUNK_SHARE * stats[7] and not stats[9]


def test_repeated_words_with_many_different_words():
    words = [str(i).encode() for i in range((1 << 20) + 10)]
    assert Q.repeated_words(words) == 0
    assert Q.repeated_words([*words, b"0", b"1", b"2"]) == 6


def test_edges(edges, nothing, clashing):
    rows = Q.compression_bands(edges).collect()
    assert len(rows) == 10
    assert [r.n_words for r in rows if r.doc_id in (3, 4, 5)] == [0, 0, 0]
    assert all(r.base_failed for r in rows if r.doc_id in (3, 4, 5, 7))
    assert Q.compression_bands(nothing).count() == 0
    key = lambda df: sorted(map(str, Q.compression_bands(df).collect()))
    assert key(clashing) == key(edges)
    kept = Q.keep_good(clashing)
    assert kept.columns == clashing.columns
    assert kept.where(F.col("doc_id") == 3).count() == 0


def test_the_tail_of_a_text_is_read():
    import random

    import zstandard

    from opsreport.llm.quality import CHUNK, CHUNK_BAND, doc_stats

    zstd = zstandard.ZstdCompressor(level=3)
    rng = random.Random(8)
    clean = " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(4000)).encode()
    junk = b"ab " * 2000
    for head in (CHUNK - 100, CHUNK, 2 * CHUNK - 1, 3 * CHUNK - 1):
        whole = len(zstd.compress(clean[-CHUNK:])) / CHUNK
        assert CHUNK_BAND[0] <= whole <= CHUNK_BAND[1]
        n_chunks, n_out = doc_stats(clean[:head] + junk[: CHUNK - 1], zstd)[7:9]
        size = head + CHUNK - 1
        assert n_chunks == size // CHUNK + (size % CHUNK > 0) and n_out >= 1
        assert doc_stats(clean[: head + CHUNK], zstd)[8] == 0
    assert doc_stats(clean[: CHUNK - 1], zstd)[7] == 0
