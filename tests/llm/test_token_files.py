from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from opsreport.llm import token_files as TF
from opsreport.llm.queries import op4_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 1]


def plain(rows):
    start, out = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(text)
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query(spark, data):
    table = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    rows = [tuple(r) for r in op4_token_files(spark, data).collect()]
    assert sorted(rows) == plain([tuple(r) for r in table])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aZ.,' |<>\n\tüİ́  1'sßΣ", max_size=40))
def test_words_give_the_ids_of_whole_texts(text):
    got = TF.encoder(PATH).encode([text])[0].tolist()
    assert got == WHOLE.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text", ["a<|endoftext|>b", "<|ENDOFTEXT|> X", "end.<|startoftext|>", "A. B, c.d e.\n", "|||"]
)
def test_special_strings(text):
    assert TF.encoder(PATH).encode([text])[0].tolist() == ids_of(text)[:-1]


def test_memory_of_words_turns_over(monkeypatch):
    monkeypatch.setattr(TF, "MEMO", 5)
    e = TF.WordEncoder(PATH)
    for k in range(30):
        text = f"word{k} and other{k % 3} | things{k}"
        assert e.encode([text])[0].tolist() == ids_of(text)[:-1]


def test_words_of_small_letters_need_the_model_alone(monkeypatch):
    e = TF.WordEncoder(PATH)
    texts = ["thndhain élève, größe ÿøß", "Ending oft### naïve?! thndhain."]
    want = [ids_of(t)[:-1] for t in texts]
    e.encode(["### ?! , ."])
    asked = []
    whole = e._ids
    monkeypatch.setattr(e, "_ids", lambda texts: asked.extend(texts) or whole(texts))
    assert [x.tolist() for x in e.encode(texts)] == want
    assert not asked


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abéßÿ÷×ÀÞµª.,;:!?#$%&*'’ \ń", max_size=30))
def test_letters_and_marks_give_the_ids_of_whole_texts(text):
    got = TF.encoder(PATH).encode([text])[0].tolist()
    assert got == WHOLE.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_take_whole_texts():
    e = TF.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not e.by_word
    assert e.encode(["a  b"])[0].tolist() == e.tokenizer.encode("a  b").ids


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_the_hash_is_minimal_and_perfect(keys):
    keys = sorted(keys)
    rows = [np.array([k & 0xFFFF, 7], "<u4") for k in keys]
    shard = TF.Shard(TF.pack_shard(keys, rows))
    assert [shard.first_row(k) for k in keys] == list(range(len(keys)))
    assert shard.first_rows(np.array(keys, np.int64)).tolist() == list(range(len(keys)))
    _, slots = TF.build_index(np.array(keys, np.int64))
    assert sorted(slots.tolist()) == list(range(len(keys)))
    others = [k for k in range(-50, 50) if k not in keys]
    assert all(shard.first_row(k) == -1 for k in others)


def test_look_up_opens_by_key(spark, tmp_path, edges):
    folder = f"file://{tmp_path}/files"
    TF.write_token_files(edges, PATH, folder, shard_tokens=50)
    keys = spark.createDataFrame([(1,), (2,), (6,), (99,), (None,), (-4,)], "doc_id long")
    got = sorted((r.doc_id, list(r.ids)) for r in TF.look_up(spark, folder, keys).collect())
    texts = [(r.doc_id, r.text) for r in edges.collect() if r.doc_id in (1, 2, 6)]
    assert got == sorted((k, ids_of(t)) for k, t in texts)


def test_edges(spark, edges, nothing, clashing):
    want = plain([(r.doc_id, r.text) for r in edges.collect()])
    for df in (edges, clashing):
        got = [tuple(r) for r in TF.token_file_digest(df, PATH, shard_tokens=300).collect()]
        assert sorted(got, key=lambda r: r[1]) == want
    assert TF.token_file_digest(nothing, PATH).count() == 0


def test_not_a_shard():
    with pytest.raises(ValueError):
        TF.Shard(b"x" * 64)
