"""Token ids in binary shards with a minimal perfect hash index.

Documents are put in order of doc_id and encoded; each ends with ``END_ID``. Consecutive
documents fill shards of about ``SHARD_TOKENS`` ids; a document is never divided. A shard is
one binary value:

    magic and three counts          32 bytes
    displacement of each bucket     uint32 each
    slots: fingerprint, first row   two uint32 each, one slot for each distinct key
    keys of the rows, in order      int64 each (0 for a row without a key)
    whether a row has a key         uint8 each
    ends of the rows, in ids        uint64 each, one more than rows
    payload: all ids                uint32 each, little endian

The index is a minimal perfect hash by hash and displace: a key's bucket has a displacement that
sends all keys of the bucket to free slots, as many slots as keys. A slot gives the first row of
the key and a fingerprint of it; an unknown key fails by its fingerprint, or in one case of 2^32
by the key that the row holds. Rows that share a key follow each other.

The shards are rows of a Parquet table (partition, sequence, first and last key, counts, ids before it in
its partition, blob):
Spark's commit protocol then covers lost executors and any file system, and the blob of a row is
the file as it would lie on a disk. Memory of a task: one shard.

Null texts are empty and still get their end id. Rows without doc_id come first and have no key;
repeated rows are repeated documents. An empty table gives no shards.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsreport.llm.common import record, record_batch, shared_folder, text_or_empty

MAGIC = b"TOKSHARD"
END_ID = 1
SHARD_TOKENS = 1 << 20
BUCKET = 4
#: Bytes of words that a worker remembers, at most twice, and what a word takes; words encoded in
#: one call; bytes of text at a time.
MEMO = 64 << 20
ENTRY = 220
JOINED = 512
AT_ONCE = 1 << 22

SHARDS, SHARDS_ARROW = record(
    "part int, seq long, first_key long, last_key long, n_rows long, before long, n_ids long, shard binary"
)
READ, READ_ARROW = record("doc_id long, start long, n_tokens long, ids_crc32 long")
GOT, GOT_ARROW = record("doc_id long, ids longs")


# -- minimal perfect hash ---------------------------------------------------------------


def _hash(keys: np.ndarray, seed: int | np.ndarray) -> np.ndarray:
    x = keys.astype(np.uint64) + np.asarray(seed, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 0xF1) >> np.uint64(32)).astype(np.uint32)


def _bucket_count(n: int) -> int:
    return (n + BUCKET - 1) // BUCKET


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacement of each bucket, slot of each key) for distinct int64 keys."""
    n = len(keys)
    if n == 0:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    buckets = _bucket_count(n)
    own = keys.view(np.uint64)
    of = (_hash(own, 0) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    ends = np.searchsorted(of[order], np.arange(buckets + 1))
    displaced = np.zeros(buckets, np.uint32)
    slots = np.full(n, -1, np.int64)
    taken = np.zeros(n, bool)
    for b in np.argsort(ends[:-1] - ends[1:], kind="stable").tolist():
        members = order[ends[b] : ends[b + 1]]
        if not len(members):
            break
        first = 1
        while True:
            tries = np.arange(first, first + 64, dtype=np.uint64)
            to = (_hash(own[members][None, :], tries[:, None]) % np.uint64(n)).astype(np.int64)
            free = ~taken[to].any(1)
            if len(members) > 1:
                ranked = np.sort(to, axis=1)
                free &= (ranked[:, 1:] != ranked[:, :-1]).all(1)
            if free.any():
                k = int(np.argmax(free))
                displaced[b] = first + k
                slots[members] = to[k]
                taken[to[k]] = True
                break
            first += 64
    return displaced, slots


# -- the shard --------------------------------------------------------------------------


def pack_shard(keys: list[int | None], rows: list[np.ndarray]) -> bytes:
    """The bytes of a shard; rows with equal keys must follow each other."""
    has = np.array([k is not None for k in keys], np.uint8)
    all_keys = np.array([k or 0 for k in keys], np.int64)
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype("<u8")
    keyed = np.flatnonzero(has)
    distinct, first = np.unique(all_keys[keyed], return_index=True)
    displaced, slots = build_index(distinct)
    table = np.zeros((len(distinct), 2), "<u4")
    table[slots, 0] = fingerprints(distinct.view(np.uint64))
    table[slots, 1] = keyed[first]
    head = np.array([len(rows), len(distinct), int(ends[-1])], "<u8")
    return b"".join(
        (
            MAGIC,
            head.tobytes(),
            displaced.astype("<u4").tobytes(),
            table.tobytes(),
            all_keys.astype("<i8").tobytes(),
            has.tobytes(),
            ends.tobytes(),
            *(r.astype("<u4").tobytes() for r in rows),
        )
    )


class Shard:
    """Keyed access to the bytes of a shard; nothing is copied."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a token shard")
        rows, self.n_keys, ids = (int(x) for x in np.frombuffer(data, "<u8", 3, 8))
        at = 32

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.displaced = take("<u4", _bucket_count(self.n_keys))
        self.slots = take("<u4", 2 * self.n_keys).reshape(-1, 2)
        self.keys = take("<i8", rows)
        self.has_key = take("u1", rows)
        self.ends = take("<u8", rows + 1)
        self.payload = take("<u4", ids)

    def first_row(self, key: int) -> int:
        """The first row of a key, or -1: two hashes and one comparison."""
        if not self.n_keys:
            return -1
        own = np.array([key], np.int64).view(np.uint64)
        bucket = int(_hash(own, 0)[0] % np.uint64(len(self.displaced)))
        slot = int(_hash(own, int(self.displaced[bucket]))[0] % np.uint64(self.n_keys))
        mark, row = self.slots[slot]
        if mark != fingerprints(own)[0] or self.keys[row] != key:
            return -1
        return int(row)

    def first_rows(self, keys: np.ndarray) -> np.ndarray:
        """``first_row`` of many keys."""
        if not self.n_keys or not len(keys):
            return np.full(len(keys), -1, np.int64)
        own = keys.astype(np.int64).view(np.uint64)
        buckets = (_hash(own, 0) % np.uint64(len(self.displaced))).astype(np.int64)
        seeds = self.displaced[buckets].astype(np.uint64)
        found = self.slots[(_hash(own, seeds) % np.uint64(self.n_keys)).astype(np.int64)]
        row = found[:, 1].astype(np.int64)
        good = (found[:, 0] == fingerprints(own)) & (self.keys[row] == keys)
        return np.where(good, row, -1)

    def rows_of(self, key: int) -> Iterator[np.ndarray]:
        """The ids of every document with this key."""
        row = self.first_row(key)
        while 0 <= row < len(self.keys) and self.has_key[row] and self.keys[row] == key:
            yield self.ids(row)
            row += 1

    def ids(self, row: int) -> np.ndarray:
        return self.payload[int(self.ends[row]) : int(self.ends[row + 1])]


# -- encoding ---------------------------------------------------------------------------

_ODD = re.compile(rb"[|<]")
#: Marks between a letter and white space.
_MARKS = ".,;:!?#$%&*"
_END = rf"([A-Za-zÀ-ÖØ-öø-ÿ])([{_MARKS}]+)([ \t\n\x0b\x0c\r]|$)"
#: Small letters of Latin-1, and a word of them alone in UTF-8.
_SMALL = [chr(c) for c in (*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100))]
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


class WordEncoder:
    """Ids of whole texts from those of their words, which are remembered.

    Right for tokenizers that drop white space and never join what it parts: then the ids of a
    text are those of its words in order. That this holds is tried when the file is loaded, and
    texts are encoded whole if it does not. Words are parted at ASCII white space only, and from
    marks at their end. Words of small letters, which the tokenizer gives to its model as they
    are, are encoded by the model at once; that too is tried when the file is loaded.
    """

    PROBE = ("Don't  stop, OK?\n42 x", " Ünï 中文 tab\tend ", "a<|endoftext|>b c")

    def __init__(self, path: str) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        bar = self._whole("|")
        self.bar = bar[0] if len(bar) == 1 else None
        self.by_word = all(
            self._whole(t) == [i for w in t.encode().split() for i in self._whole(w.decode())]
            for t in self.PROBE
        )
        # Whether marks after a letter at the end of a word are encoded alone.
        self.end_alone = all(
            self._whole(w + e) == self._whole(w) + self._whole(e)
            for w in ("word", "Things", "zq", "A", "ré", "É", "ß")
            for e in (*_MARKS, *(a + b for a in _MARKS for b in _MARKS), _MARKS)
        )
        # Whether ASCII capitals are encoded as their small letters, outside of special tokens.
        self.folds = self._whole("THE Zq'S") == self._whole("the zq's")
        self.four = [pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        self.spelt = self._spelt()
        # Whether ASCII letters are given as they are.
        self.same = bool(self.spelt) and all(self.spelt[ord(c)] == c for c in _SMALL[:26])

    def _spelt(self) -> dict[int, str] | None:
        """What the model is given for each small letter, if words of these come to it whole and
        letter by letter: then the model alone gives their ids."""

        def given(text: str) -> list[str]:
            normal, parted = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
            text = normal.normalize_str(text) if normal else text
            return [x for x, _ in parted.pre_tokenize_str(text)] if parted else [text]

        words = [*_SMALL, *(a + b for a in _SMALL for b in _SMALL), "".join(_SMALL)]
        letters = [given(c) for c in _SMALL]
        if any(len(x) != 1 for x in letters):
            return None
        table = {ord(c): x for c, (x,) in zip(_SMALL, letters, strict=True)}
        if given(" ".join(words)) != [w.translate(table) for w in words]:
            return None
        ids = [t.id for w in words for t in self.tokenizer.model.tokenize(w.translate(table))]
        return table if ids == [i for w in words for i in self._whole(w)] else None

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _learn(self, words: set[bytes]) -> None:
        """Words of small letters go to the model; others are encoded many in one call, parted by
        bars, whose id no word without one has."""
        if self.spelt is not None:
            small = [w for w in words if _PLAIN.fullmatch(w)]
            words = words.difference(small)
            tokenize, four, table = self.tokenizer.model.tokenize, self.four, self.spelt
            for w in small:
                text = w.decode() if w.isascii() and self.same else w.decode().translate(table)
                self.memo[w] = b"".join([four[t.id] for t in tokenize(text)])
        plain = [w for w in words if not _ODD.search(w)]
        odd = [w for w in words if _ODD.search(w)]
        for at in range(0, len(plain), JOINED):
            some = plain[at : at + JOINED]
            ids = self._ids([" | ".join([w.decode() for w in some])])[0]
            bars = (np.flatnonzero(ids == self.bar) if self.bar is not None else ids[:0]).tolist()
            if len(bars) != len(some) - 1:
                odd += some
                continue
            data = ids.tobytes()
            starts = [0, *[4 * b + 4 for b in bars]]
            ends = [*[4 * b for b in bars], len(data)]
            self.memo.update(zip(some, [data[x:y] for x, y in zip(starts, ends)], strict=True))
        for w, ids in zip(odd, self._ids([w.decode() for w in odd]), strict=True):
            self.memo[w] = ids.tobytes()

    def _words(self, texts: list[str]) -> pa.LargeListArray:
        column = pa.array(texts, pa.large_string())
        if self.folds:
            special = pc.match_substring(column, "<|")
            column = pc.if_else(special, column, pc.ascii_lower(column))
        if self.end_alone:
            column = pc.replace_substring_regex(column, pattern=_END, replacement=r"\1 \2\3")
        return pc.ascii_split_whitespace(column)

    def _known(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as bytes; words not remembered are encoded."""
        memo, old = self.memo, self.old
        found = list(map(memo.get, words))
        missing = set()
        for w in [w for w, ids in zip(words, found, strict=True) if ids is None]:
            if w in old:
                memo[w] = old[w]
            else:
                missing.add(w)
        if missing:
            self._learn(missing)
        if None in found:
            found = list(map(memo.__getitem__, words))
        if ENTRY * len(memo) > MEMO:
            self.old, self.memo = memo, {}
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. The words of all texts are numbered at once, each different word is
        looked up once, and ids are gathered by numbers."""
        if not texts or not self.by_word:
            return self._ids(texts)
        words = self._words(texts)
        coded = words.flatten().dictionary_encode()
        found = self._known(coded.dictionary.cast(pa.large_binary()).to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(found), "<u4")
        codes = coded.indices.to_numpy()
        own = sizes[codes]
        ends = np.cumsum(own)
        ids = ids[np.repeat(starts[codes] - ends + own, own) + np.arange(own.sum())]
        places = np.concatenate([[0], ends])[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return np.split(ids, places[1:-1])


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# -- writing and reading ----------------------------------------------------------------


def _encoded(batches: Iterator[pa.RecordBatch], encode) -> Iterator[tuple[int | None, np.ndarray]]:
    """(key, ids) of every row in order, encoded some megabytes at a time."""
    for batch in batches:
        keys, texts, size = [], [], 0
        for key, text in zip(batch[0], batch[1], strict=True):
            keys.append(key.as_py())
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= AT_ONCE:
                yield from zip(keys, encode(texts), strict=True)
                keys, texts, size = [], [], 0
        if keys:
            yield from zip(keys, encode(texts), strict=True)


def _shard_writer(path: str, end_id: int, shard_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = encoder(path).encode
        keys: list[int | None] = []
        rows: list[np.ndarray] = []
        size = seq = before = 0

        def flush() -> pa.RecordBatch:
            known = [k for k in keys if k is not None]
            row = (part, seq, known[0] if known else None, known[-1] if known else None)
            row = (*row, len(rows), before, size, pack_shard(keys, rows))
            return record_batch([row], SHARDS_ARROW)

        end = np.array([end_id], "<u4")
        for key, ids in _encoded(batches, encode):
            ids = np.concatenate([ids, end])
            if rows and size + len(ids) > shard_tokens:
                yield flush()
                keys, rows, size, seq, before = [], [], 0, seq + 1, before + size
            keys.append(key)
            rows.append(ids)
            size += len(ids)
        if rows:
            yield flush()

    return write


def write_token_files(
    docs: DataFrame,
    path: str,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> str:
    """Encodes ``docs`` in order of id and writes the shards below ``folder``."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = own.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    shards = ordered.mapInArrow(_shard_writer(path, end_id, shard_tokens), SHARDS)
    shards.write.option("compression", "zstd").parquet(folder)
    return folder


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob, before in zip(batch[0], batch[1].to_pylist(), strict=True):
            shard = Shard(blob.as_py())
            rows = []
            keyed = np.flatnonzero(shard.has_key)
            first = np.zeros(len(shard.keys), np.int64)
            first[keyed] = shard.first_rows(shard.keys[keyed])
            if (shard.keys[first[keyed]] != shard.keys[keyed]).any() or (first[keyed] < 0).any():
                raise ValueError("a key of the shard is not found by its index")
            for r in range(len(shard.keys)):
                ids = shard.ids(r)
                key = int(shard.keys[r]) if shard.has_key[r] else None
                rows.append((key, before + int(shard.ends[r]), len(ids), zlib.crc32(ids.tobytes())))
            yield record_batch(rows, READ_ARROW)


def read_token_files(spark, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32, from the shards.

    Every key is looked up through the index of its shard on the way.
    """
    shards = spark.read.schema(SHARDS).parquet(folder)
    by_part = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per partition of the writing job, a number that the configuration sets.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    placed = shards.join(F.broadcast(bases), "part")
    return placed.select("shard", (F.col("base") + F.col("before")).alias("before")).mapInArrow(
        _reader, READ
    )


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for blob, keys in zip(batch[0], batch[1].to_pylist(), strict=True):
            shard = Shard(blob.as_py())
            rows += [(k, ids.tolist()) for k in keys for ids in shard.rows_of(k)]
        yield record_batch(rows, GOT_ARROW)


def look_up(spark, folder: str, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id and ids of the documents with these keys, each found through a shard's index.

    Only the shards whose range of keys holds one of them are opened.
    """
    shards = spark.read.schema(SHARDS).parquet(folder)
    spans = shards.where("first_key is not null").select("part", "seq", "first_key", "last_key")
    wanted = keys.select(F.col(id_col).cast("long").alias("k")).where("k is not null").distinct()
    # At most one row per partition of the writing job; a key lies in one partition only.
    lows = spans.groupBy("part").agg(F.min("first_key").alias("low")).orderBy("low").collect()
    if not lows:
        return wanted.limit(0).select(F.col("k").alias("doc_id"), F.array("k").alias("ids"))
    firsts = F.array(*[F.lit(r["low"]) for r in lows])
    parts = F.array(*[F.lit(r["part"]) for r in lows])
    below = F.size(F.filter(firsts, lambda x: x <= F.col("k")))
    wanted = wanted.where(F.col("k") >= lows[0]["low"]).select(
        "k", F.element_at(parts, below).alias("part")
    )
    inside = F.col("k").between(F.col("first_key"), F.col("last_key"))
    hits = wanted.join(spans, "part").where(inside)
    asked = hits.groupBy("part", "seq").agg(F.collect_list("k").alias("keys"))
    return (
        shards.select("part", "seq", "shard")
        .join(asked, ["part", "seq"])
        .select("shard", "keys")
        .mapInArrow(_finder, GOT)
    )


def token_file_digest(docs: DataFrame, path: str, **options) -> DataFrame:
    """Writes the shards in the shared folder and returns what reading them back gives."""
    spark = docs.sparkSession
    folder = write_token_files(docs, path, shared_folder(spark, "token-files"), **options)
    return read_token_files(spark, folder)
