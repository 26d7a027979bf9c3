from __future__ import annotations

import random
import re

from opsreport.llm import license_scan as L
from opsreport.llm.queries import op3_license_scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in L.PHRASES:
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(labels)),
    )


def test_query_equals_the_definitions(spark):
    data = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in op3_license_scan(spark, data).collect():
        got = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
        assert got == plain(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert (r.score >= L.LEAST_COVER) == bool(r.labels)


def test_adjacent_phrases_all_count():
    row = L.scanner().scan(b"MIT license mit-license, gnu general public license cc BY cc by")
    assert row[:5] == (12, 5, 0, 10, "cc-by,gpl,mit")


def test_matching_statistics_equal_all_runs():
    rng = random.Random(1)
    seqs = [[rng.randrange(3) for _ in range(14)] for _ in range(5)]
    automaton = L.Automaton(seqs)
    runs = {tuple(q[i:j]) for q in seqs for i in range(14) for j in range(i + 1, 15)}
    for _ in range(200):
        x = [rng.randrange(4) for _ in range(25)]
        longest = [
            max(k for k in range(e + 2) if k == 0 or tuple(x[e - k + 1 : e + 1]) in runs)
            for e in range(25)
        ]
        want = [
            (e, longest[e])
            for e in range(25)
            if longest[e] >= 2 and (e == 24 or longest[e + 1] != longest[e] + 1)
        ]
        got = list(automaton.matches(x, 2))
        assert [m[:2] for m in got] == want
        for end, size, state in got:
            run = x[end - size + 1 : end + 1]
            places = {
                (t, k + size - 1)
                for t, q in enumerate(seqs)
                for k in range(15 - size)
                if q[k : k + size] == run
            }
            assert places == set(automaton.ends[state])


def test_broken_templates_are_chained():
    text = dict(L.TEMPLATES)["bsd-text"].split()
    noisy = ["Intro."] * 30 + text[:12] + ["our", "own"] + text[12:24] + ["EXTRA"] + text[26:]
    row = L.scanner().scan(" ".join(noisy).encode())
    assert "bsd-text" in row[5].split(",") and 0.8 < row[6] < 1
    far = text[:12] + ["x"] * 40 + text[12:24]
    assert "bsd-text" not in L.scanner().scan(" ".join(far).encode())[5]


def test_chains_do_not_overlap():
    hits = [(0, 0, 5), (3, 3, 6), (20, 0, 4), (26, 8, 4), (26, 2, 4)]
    assert L.chains(hits) == [(0, 8, 9), (20, 29, 8)]


def test_edges(edges, nothing, clashing):
    rows = L.scan_licenses(edges).collect()
    assert len(rows) == 10
    assert {(r.n_words, r.labels, r.score) for r in rows if r.doc_id in (3, 4, 5)} == {(0, "", 0.0)}
    assert L.scan_licenses(nothing).count() == 0
    key = lambda df: sorted(map(str, L.scan_licenses(df).collect()))
    assert key(clashing) == key(edges)


def test_a_template_inside_the_run_of_another_is_found():
    text = b"Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
    row = L.scanner().scan(text)
    assert "apache-2.0" in row[5].split(",") and row[6] == 1.0
