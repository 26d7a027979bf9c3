from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from opsreport.llm import segmentation as S
from opsreport.llm.queries import op9_n_best_segmentation

PATH = public_tokenizers.path("piece_bpe_32k.model")


def every_way(p: S.Pieces, text: str):
    """All segmentations of a short text, best first."""
    marked = S.MARK + text.replace(" ", S.MARK) if text else ""
    out = []

    def go(at, ids, score):
        if at == len(marked):
            out.append((score, tuple(ids)))
            return
        single = False
        for end in range(at + 1, len(marked) + 1):
            i = p.id.get(marked[at:end])
            if i is not None:
                single |= end == at + 1
                go(end, [*ids, i], score + p.score[i])
        if not single:
            go(at + 1, [*ids, *(p.byte[b] for b in marked[at].encode())], score + p.unknown)

    go(0, [], 0.0)
    return sorted(out, key=lambda x: -x[0])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="theing .,\né日a1", max_size=9), st.integers(1, 8))
def test_equals_all_ways(text, n):
    p = S.pieces(PATH)
    got, want = p.encode(text, n), every_way(p, text)
    assert [s for s, _ in got] == [s for s, _ in want[:n]]
    assert set(got) <= set(want) and len(set(got)) == len(got)
    assert all(p.decode(ids) == text for _, ids in got)


def test_a_part_without_cuts_equals_the_whole_lattice():
    p = S.pieces(PATH)
    for text in ("window, there.", "naïve\nlines. end", "x  y"):
        whole = p.n_best(S.MARK + text.replace(" ", S.MARK), 6)
        assert [s for s, _ in whole] == [s for s, _ in p.encode(text, 6)]


def test_query(spark, data):
    p = S.pieces(PATH)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in op9_n_best_segmentation(spark, data).collect():
        found = p.encode(texts[r.doc_id] or "", S.N_BEST)
        assert r.decodes and r.n_segmentations == len(found)
        assert (r.score, r.n_tokens) == (found[0][0], len(found[0][1]))
        assert r.ids_crc32 == zlib.crc32(np.array(found[0][1], "<u4").tobytes())
        assert r.next_score == (found[1][0] if len(found) > 1 else None)


def test_columns_round_trip(spark, edges, nothing, clashing):
    from pyspark.sql import functions as F

    best = edges.select("doc_id", "text", S.encoded("text", PATH, 2).alias("e"))
    back = best.select("text", S.decoded(F.col("e")[0]["ids"], PATH).alias("back")).collect()
    assert all(r.back == (r.text or "").replace(S.MARK, " ") for r in back)
    rows = S.segmentations(edges, PATH).collect()
    assert len(rows) == 10 and all(r.decodes for r in rows)
    assert {(r.n_segmentations, r.n_tokens) for r in rows if r.doc_id in (3, 4)} == {(1, 0)}
    assert S.segmentations(nothing, PATH).count() == 0
    key = lambda df: sorted(map(str, S.segmentations(df, PATH).collect()))
    assert key(clashing) == key(edges)


def test_memory_turns_over(monkeypatch):
    fresh = S.Pieces(PATH)
    monkeypatch.setattr(S, "MEMO", 4)
    for k in range(20):
        text = f"some words, number {k} and more{k % 3}."
        assert fresh.encode(text, 3) == S.pieces(PATH).encode(text, 3)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="theing.,é日aonti", min_size=1, max_size=50), min_size=1, max_size=30))
def test_texts_searched_together_equal_each_alone(texts):
    p = S.pieces(PATH)
    found = dict(p._learnt(list(dict.fromkeys(texts))))
    for text, (score, loss, ids) in found.items():
        best, less, own = p.best_two(text)
        assert (score, loss, ids) == (best, less, np.array(own, "<u4").tobytes())
    assert set(found) == set(texts)


def test_texts_of_all_kinds_keep_their_order():
    p = S.Pieces(PATH)
    texts = ["two words", "", " x", "a  b", "plain text, here.", f"a{S.MARK}b", "é\n日 x", "end "]
    for text, (ids, found, _) in zip(texts, p.ways_of_many(texts, 3), strict=True):
        want = p.encode(text, 3)
        assert tuple(ids.tolist()) == want[0][1] and [s for s, _ in found] == [s for s, _ in want]
        assert p.reads(ids, text.replace(S.MARK, " ")) and not p.reads(ids, text + "x")


def test_short_texts_are_searched_together(monkeypatch):
    p = S.Pieces(PATH)
    texts = ["some plain words of a text.", "other wordsandmorewords, too", ""]
    want = [p.encode(t, 3) for t in texts]
    p = S.Pieces(PATH)
    alone = []
    monkeypatch.setattr(S, "AT_ONCE", 10)
    monkeypatch.setattr(S.Pieces, "best_two", lambda self, text: alone.append(text) or (0.0, 0.0, ()))
    assert [p.encode(t, 3) for t in texts] == want and not alone
