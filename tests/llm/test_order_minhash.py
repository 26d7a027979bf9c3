from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from opsreport.llm import order_minhash as O
from opsreport.llm.components import components
from tests.llm.conftest import prose

SCHEMA = "doc_id long, text string"


def shingles(text):
    words = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (text or "").lower()).split()
    if not words:
        return []
    grams = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
    return [(g, grams[:i].count(g)) for i, g in enumerate(grams)]


def similarity(a, b):
    """Longest common subsequence of labelled shingles, by the textbook table."""
    x, y = shingles(a), shingles(b)
    row = [0] * (len(y) + 1)
    for p in x:
        old = row
        row = [0] * (len(y) + 1)
        for j, q in enumerate(y):
            row[j + 1] = old[j] + 1 if p == q else max(old[j + 1], row[j])
    return row[-1] / max(1, len(x) + len(y) - row[-1])


def classes(texts):
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        if similarity(texts[a], texts[b]) >= 0.8:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in texts}


def edited(text, seed, edits):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice(([], [f"new{rng.random()}"], [words[k], f"in{rng.random()}"]))
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    out, k = {}, 100
    for base in range(8):
        text = prose(base, 90 + 20 * base)
        for copy in range(6):
            out[k] = edited(text, k, copy % 4 if copy else 0)
            k += 1
    for base in range(20):
        out[k] = prose(1000 + base, 60)
        k += 1
    halves = out[100].split()
    out[k] = " ".join(halves[45:] + halves[:45])
    out[k + 1] = ("again and again and " * 30) + "end"
    out[k + 2] = ("again and again and " * 31) + "end"
    out[k + 3] = out[k + 4] = "two words"
    return out


def test_classes_equal_all_pairs(spark, texts):
    df = spark.createDataFrame(list(texts.items()), SCHEMA)
    got = {r.doc_id: r.class_id for r in O.near_duplicate_classes(df).collect()}
    assert got == classes(texts)


def test_alignment_equals_the_table(texts):
    ids = sorted(texts)
    for a, b in zip(ids, ids[1:], strict=False):
        x, y = (O.labelled(O.words_of(texts[i])) for i in (a, b))
        order = np.argsort(x)
        s = similarity(texts[a], texts[b])
        got = O.aligned(x, order, x[order], y, 0.8)
        assert got == pytest.approx(s if s >= 0.8 else 0.0)


def test_moved_halves_are_no_copy(texts):
    assert similarity(texts[100], texts[max(texts) - 4]) < 0.8


def test_a_large_group_of_near_copies_is_one_class(spark):
    text = prose(7, 200)
    rows = [(i, edited(text, i, 2)) for i in range(400)] + [(i, prose(i, 150)) for i in range(500, 600)]
    got = {r.doc_id: r.class_id for r in
           O.near_duplicate_classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {got[i] for i in range(400)} == {0}
    assert all(got[i] == i for i in range(500, 600))


def test_a_chain_of_versions_is_one_class(spark):
    rows, text = [], prose(3, 150)
    for i in range(12):
        rows.append((i, text))
        text = edited(text, i, 3)
    want = classes(dict(rows))
    got = {r.doc_id: r.class_id for r in
           O.near_duplicate_classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_edges(spark, edges, nothing, clashing):
    rows = {r.doc_id: r for r in O.near_duplicate_classes(clashing).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert rows[2].class_id == 1 and not rows[2].kept
    assert all(rows[i].class_id == i for i in (3, 4, 5, 6, 7, 8))
    assert O.near_duplicate_classes(nothing).count() == 0
    kept = O.keep_one_of_each(clashing)
    assert kept.columns == clashing.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted("1 3 4 5 6 7 8 None".split())
    again = edges.where("doc_id = 2")
    assert [r.doc_id for r in O.keep_one_of_each(again).collect()] == [2]


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(200, x) for x in range(150, 260, 3)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    parent: dict = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    alone = {a for a, b in edges if a == b and sum(a in e for e in edges) == 1}
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in rows} == {i: root(i) for i in parent if i not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_versions_of_linked_members_are_compared_with_them(spark):
    """H, versions A_i linked to it, and one version B_i of each A_i too far from H."""
    base = prose(11, 400)
    texts = {0: base}
    for i in range(1, 81):
        texts[i] = edited(base, i, 7)
        texts[1000 + i] = edited(texts[i], 1000 + i, 9)
    value = {i: O.labelled(O.words_of(x)) for i, x in texts.items()}

    def alike(a, b):
        order = np.argsort(value[a])
        return O.aligned(value[a], order, value[a][order], value[b], 0.8)

    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        if alike(a, b):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    hidden = [i for i in range(1, 81) if alike(i, 1000 + i) and not alike(0, 1000 + i)]
    assert len(hidden) > 20
    df = spark.createDataFrame(list(texts.items()), SCHEMA)
    got = {r.doc_id: r.class_id for r in O.near_duplicate_classes(df).collect()}
    assert got == {i: root(i) for i in texts}


def test_a_document_of_two_texts_keeps_the_links_of_both(spark):
    first, second = prose(51, 90), prose(52, 200)
    rows = [(1, first), (5, first), (5, edited(second, 3, 4)), (9, second), (12, prose(53, 90))]
    got = O.near_duplicate_classes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.class_id for r in got} == {1: 1, 5: 1, 9: 1, 12: 12}
    # Ties alone, without any near link.
    rows = [(1, first), (5, first), (5, second), (9, second)]
    got = O.near_duplicate_classes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.class_id for r in got} == {1: 1, 5: 1, 9: 1}


def test_open_pairs_hold_every_pair_of_the_bound(spark):
    # One large class, some stragglers, two small classes: versions of one template.
    base = prose(60, 150)
    texts = [(i, 1 if i < 60 else i, edited(base, 700 + i, 2 + i % 9)) for i in range(80)]
    texts += [(100 + i, 100 + i // 2, edited(base, 900 + i, 3)) for i in range(4)]
    docs = spark.createDataFrame(texts, "doc_id long, label long, text string")
    found = {(r.hub, r.doc) for r in O.open_pairs(docs, 0.8).collect()}
    assert all(a < b for a, b in found)
    values = {i: O.labelled(O.words_of(t)) for i, _, t in texts}
    label = {i: x for i, x, _ in texts}
    for (a, x), (b, y) in combinations(values.items(), 2):
        order = np.argsort(x)
        if label[a] != label[b] and O.aligned(x, order, x[order], y, 0.8):
            assert (a, b) in found
