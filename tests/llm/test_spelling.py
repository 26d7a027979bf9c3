from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsreport.llm import queries
from opsreport.llm.spelling import (
    SYMBOLS,
    neighbourhoods,
    own_keys,
    spelling_groups,
    symbol_codes,
)

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def one_edit(word):
    """Patterns that two words share just if one edit parts them at most."""
    holes = {word[:i] + "\0" + word[i + 1 :] for i in range(len(word))}
    return holes, {word[:i] + word[i + 1 :] for i in range(len(word))}


def plain(rows):
    """word -> (form, root, n, n_near, form_n) by definition."""
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    holes, shorter, near = {}, {}, {w: set() for w in counts}
    for w in counts:
        a, b = one_edit(w)
        for x in a:
            holes.setdefault(x, []).append(w)
        for x in b:
            shorter.setdefault(x, []).append(w)
    for group in holes.values():
        for w in group:
            near[w] |= set(group) - {w}
    for w in counts:
        for x in shorter.get(w, []):
            near[w].add(x)
            near[x].add(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts.get(form[w]))
    return out


def by_word(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("symbols", [2, 6])
def test_neighbourhoods_are_full_and_without_repeats(symbols):
    rng = random.Random(symbols)
    for length in (1, 2, 5, 9):
        words = ["".join(rng.choice("abcdeéÿz") for _ in range(length)) for _ in range(30)]
        codes = symbol_codes(words, symbols)
        got = [[] for _ in words]
        for rows, keys in neighbourhoods(codes, symbols):
            for r, k in zip(rows.tolist(), keys.tolist(), strict=True):
                got[r].append(k)

        def key(c):
            return int(own_keys(np.array([c], np.uint64))[0]) if c else 0

        for c, found in zip(codes.tolist(), got, strict=True):
            want = {tuple(c)} | {tuple(c[:i] + c[i + 1 :]) for i in range(length)}
            for s in range(1, symbols + 1):
                want |= {tuple(c[:i] + [s] + c[i + 1 :]) for i in range(length)}
                want |= {tuple(c[:i] + [s] + c[i:]) for i in range(length + 1)}
            assert sorted(found) == sorted(key(list(x)) for x in want)


def test_whole_table_equals_the_plain_version(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = queries.QUERIES["op13_spelling_variants"](spark, data)
    assert got.columns == "word form root n n_near form_n".split()
    assert by_word(got) == plain(rows)


def variants(seed, n):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("aábcdeiÀo÷") for _ in range(rng.randrange(4, 9))) for _ in range(40)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(60):
            w = rng.choice(bases[: 1 + rng.randrange(40)])
            if rng.random() < 0.4:
                at = rng.randrange(len(w) + 1)
                w = w[:at] + rng.choice(["", "a", "É"]) + w[at + rng.randrange(2) :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "\n", "_", "9"]).join(words)))
    return rows


def test_dense_variants_and_chains(spark):
    rows = variants(5, 300)
    want = plain(rows)
    got = by_word(spelling_groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == want
    assert any(form and want[form][0] for form, *_ in want.values())


def test_very_long_words_and_ties(spark):
    long = "ab" * 30_000
    twins = ["house", "mouse", "louse"]
    rows = [(None, f"{long} {long}c {' '.join(twins)}")] * 3 + [(1, "xhouse " * 7)]
    got = by_word(spelling_groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain(rows)
    assert got[long][3] == 1 and got["mouse"][:2] == (None, "mouse")
    assert got["house"][:2] == ("xhouse", "xhouse")


def test_edges(spark, edges, nothing, clashing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert by_word(spelling_groups(edges)) == plain(rows)
    assert by_word(spelling_groups(clashing.withColumn("word", F.lit("?")))) == plain(rows)
    assert spelling_groups(nothing).count() == 0
    assert SYMBOLS == 6
