from __future__ import annotations

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from opsreport.llm import token_counts as T
from opsreport.llm.queries import op10_token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_query_equals_whole_texts(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in op10_token_counts(spark, data).collect():
        n = len(SP.encode(texts[r.doc_id] or ""))
        assert (r.n_tokens, r.over_limit) == (n, n > 4096)
        assert r.n_bytes == len((texts[r.doc_id] or "").encode())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab ▁é.\n日1,", max_size=60), st.integers(1, 7))
def test_cut_texts_count_as_whole_ones(text, most):
    parts = [p for p in T.safe_pieces(text, most) if p]
    assert sum(len(SP.encode(p)) for p in parts) == len(SP.encode(text))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_other_libraries_count_whole_texts(name):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    texts = ["", "Hello world", "a<|endoftext|>b", "x " * 50_000]
    whole = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for t in texts]
    assert T.lengths(texts, path) == whole


def test_calls_are_balanced_by_size(monkeypatch):
    calls = []

    class Model:
        def encode(self, parts, num_threads):
            calls.append(sum(map(len, parts)))
            return [p.split() for p in parts]

    monkeypatch.setitem(T._LOADED, "fake.model", (Model(), True))
    texts = ["w " * 400_000, *["a b"] * 1000, "v " * 900_000]
    assert T.lengths(texts, "fake.model") == [400_000, *[2] * 1000, 900_000]
    assert max(calls) < T.CALL + 2 * T.PIECE


def test_edges(edges, nothing, clashing):
    rows = T.token_counts(edges, MODEL).collect()
    assert len(rows) == 10 and all(r.n_tokens == 0 for r in rows if r.doc_id in (3, 4))
    assert T.token_counts(nothing, MODEL).count() == 0
    key = lambda df: sorted(map(str, T.token_counts(df, MODEL).collect()))
    assert key(clashing) == key(edges)
