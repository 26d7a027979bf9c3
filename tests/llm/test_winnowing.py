from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from opsreport.llm import queries
from opsreport.llm.winnowing import (
    BASE,
    GRAM,
    PRIME,
    SPACELESS,
    WINDOW,
    edited_fingerprints,
    fingerprints,
)
from tests.llm.conftest import prose

SINGLE = "[぀-ヿ一-鿿฀-๿]"


def plain_prints(text, k=GRAM, w=WINDOW):
    """(hash, position) by definition."""
    words = [x for x in re.split("[ \t-\r]+", re.sub(f"({SINGLE})", r" \1 ", text)) if x]
    codes = [zlib.crc32(x.encode()) for x in words]
    if 0 < len(codes) < k:
        codes += [0] * (k - len(codes))
    hashes = [
        sum(c * BASE ** (k - 1 - i) for i, c in enumerate(codes[at : at + k])) % PRIME
        for at in range(len(codes) - k + 1)
    ]
    got = []
    for at in range(max(len(hashes) - w + 1, 1) if hashes else 0):
        window = range(at, min(at + w, len(hashes)))
        best = min(window, key=lambda i: (hashes[i], -i))
        if (hashes[best], best) not in got[-1:]:
            got.append((hashes[best], best))
    return got


def plain_likeness(a, b):
    x, y = {h for h, _ in a}, {h for h, _ in b}
    return len(x & y) / len(x | y) if x or y else 1.0


def plain(rows):
    """The digest rows of documents with distinct ids."""
    rows = sorted(((i, t or "") for i, t in rows), reverse=True)
    out = {}
    for at, (i, text) in enumerate(rows):
        after = rows[(at + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, new = plain_prints(text), plain_prints(edited)
        out[i] = (
            len(text),
            hashlib.sha256(edited.encode()).hexdigest(),
            " ".join(f"{h}:{p}" for h, p in own),
            " ".join(f"{h}:{p}" for h, p in new),
            plain_likeness(own, new),
            plain_likeness(own, plain_prints(after)),
        )
    return out


def by_id(df):
    return {r.doc_id: tuple(r)[1:] for r in df.collect()}


def test_whole_table_equals_the_plain_version(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = queries.QUERIES["op11_winnowing"](spark, data)
    assert by_id(got) == plain(rows)
    assert got.columns == (
        "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()
    )


@pytest.mark.parametrize(("k", "w"), [(1, 1), (2, 3), (3, 4), (7, 5), (8, 16)])
def test_any_run_and_window(spark, k, w):
    rng = random.Random(k * w)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(80)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [[tuple(p) for p in r.fingerprint] for r in fingerprints(df, k=k, w=w).collect()]
    assert got == [plain_prints(t, k, w) for t in texts]


def test_a_shared_run_of_the_guaranteed_length_is_found(spark):
    shared = prose(9, GRAM + WINDOW - 1)
    rows = [(f"{prose(i, 40 + i)} {shared} {prose(100 + i, 30)}",) for i in range(20)]
    df = spark.createDataFrame(rows, "text string")
    sets = [{p["hash"] for p in r.fingerprint} for r in fingerprints(df).collect()]
    assert set.intersection(*sets)


def test_spread_ids_cross_every_range(spark):
    rng = random.Random(3)
    ids = list({rng.randrange(-(2**62), 2**62) for _ in range(400)})
    rows = [(i, prose(n, rng.randrange(40))) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert by_id(edited_fingerprints(df)) == plain(rows)


def test_edges(spark, edges, nothing, clashing):
    got = edited_fingerprints(edges).collect()
    assert len(got) == 10
    at = {}
    for r in got:
        at.setdefault(r.doc_id, []).append(r)
    # Equal rows follow each other; without an id nothing is borrowed.
    twins = at[2]
    assert {r.fingerprint for r in twins} == {at[1][0].fingerprint}
    assert max(r.near_next for r in twins) == 1.0
    alone = at[None][0]
    assert alone.near_next == 0.0 and 0 < alone.near_edited < 1
    assert at[3][0].fingerprint == at[4][0].fingerprint == at[5][0].fingerprint == ""
    assert at[4][0].near_next == 1.0 and at[3][0].n_chars == 0
    assert at[6][0].n_chars == len(prose(3, 30_000))
    plainly = " ".join(f"{h}:{p}" for h, p in plain_prints(prose(3, 30_000)))
    assert at[6][0].fingerprint == plainly
    odd = "Ünï ▁ café 日本語 \U0001f600 don't\x00 | <|im_end|> \\"
    assert at[8][0].fingerprint == " ".join(f"{h}:{p}" for h, p in plain_prints(odd))
    assert edited_fingerprints(nothing).count() == 0
    assert fingerprints(nothing).count() == 0
    same = edited_fingerprints(clashing).collect()
    assert sorted(map(str, same)) == sorted(map(str, got))
    assert len(fingerprints(clashing.withColumn("fingerprint", F.lit(1))).collect()) == 10
    single = spark.createDataFrame([(7, prose(1, 50))], "doc_id long, text string")
    assert by_id(edited_fingerprints(single)) == plain([(7, prose(1, 50))])


def test_no_python_and_no_single_partition(spark, edges):
    plan = edited_fingerprints(edges)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "SinglePartition" not in plan and SPACELESS in plan
