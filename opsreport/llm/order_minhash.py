"""Near-duplicates by Order MinHash, verified by banded alignment.

A document is the sequence of its five-word shingles (lower case, letters and digits; a text
of one to four words is one shingle). The k-th occurrence of a shingle is labelled k, so all
labelled shingles of a document differ. Each of ``BANDS`` hash functions picks the ``DRAWN``
labelled shingles with the least values and keeps them in text order; documents that agree in
such a tuple are candidates. Two documents are linked if an alignment of their labelled
shingles leaves a share of 0.8 or more:

    similarity = common / (n_a + n_b - common)

where ``common`` is the longest sequence of shared labelled shingles in the same order in both,
looked for within a band about the diagonal. Every shared shingle occurs once on each side, so
the longest common sequence is a longest increasing sequence of places. A match further from
the diagonal than the edits that 0.8 allows cannot be part of a sufficient alignment, so the
band loses nothing. A class is a connected component of links; its id is its least doc_id.

At 0.8 two documents agree in one band with probability 0.8 ** 3 = 0.51, and miss each other
in all 20 with 6e-7.

How it scales
- Equal texts (by a 128-bit hash of their words) are one class at once; only one document of
  each takes part further, so groups of copies cost one row each.
- Only hashes are shuffled for the candidates. A bucket never pairs its members with each
  other: they are all compared with one hub, the member with the most company in its other
  buckets. What the hub does not link is dealt with in the next round, with a hub of its own;
  rounds go on while at least a tenth of their comparisons link, and are linear in the members.
- What rounds leave open is settled exactly. Documents of buckets of three or more whose members
  are not all of one class are joined on their rarest labelled shingles: two documents that
  share enough of them for the bound share one among the rarest n - needed + 1 of each (prefix
  filter), whatever the order. Pairs of different classes are verified. Shingles of one class
  alone drop out before the join; in the others only the rows outside of the most frequent class
  ask, each of them once for every ``CHUNK`` rows. Nothing is capped: a group whose members all
  reach just below the bound costs its pairs.
- Hubs meet their members in chunks of ``CHUNK``, streamed: a task holds one hub and one member.
- Texts meet ids in sort-merge joins at every size: ids of candidates grow with the corpus, so
  a plan that sends them to every task would only do for a small one.
- Every round is a table in the shared folder.

Rows without doc_id belong to no class and give no row. Texts without words, null or empty,
are classes of their own. Rows with one doc_id are one document, whose class is the smallest of
its texts'. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsreport.llm.common import record, record_batch, text_or_empty, written
from opsreport.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 20
DRAWN = 3
CHUNK = 64
CELLS = 1 << 20
LEAST_PAYING = 0.1

_KEPT = b"".join(
    bytes([c]) if chr(c).isalnum() and c < 128 or c >= 128 else b" " for c in range(256)
)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)

SKETCH, SKETCH_ARROW = record("doc_id long, n long, h1 long, h2 long, sketch longs")
LINKS, LINKS_ARROW = record("hub long, doc long, similarity double")
COUNTS, COUNTS_ARROW = record("cell long, k long")
RAREST, RAREST_ARROW = record("h long, doc long, label long, n long, place long")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_KEPT).split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _MULTIPLIER
    return x ^ (x >> _SHIFT)


def labelled(words: list[bytes]) -> np.ndarray:
    """64-bit values of the labelled shingles, in text order, all different."""
    if not words:
        return np.empty(0, np.uint64)
    known: dict[bytes, int] = {}
    h = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        v = known.get(w)
        if v is None:
            v = known[w] = xxhash.xxh64_intdigest(w)
        h[i] = v
    n = max(1, len(h) - SHINGLE + 1)
    value = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(h))):
        value = _mixed(value + h[k : k + n])
    order = np.argsort(value, kind="stable")
    run = value[order]
    same = run[1:] == run[:-1]
    if same.any():
        starts = np.flatnonzero(np.concatenate(([True], ~same)))
        nth = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        occurrence = np.empty(n, np.uint64)
        occurrence[order] = nth.astype(np.uint64)
        value = _mixed(value + occurrence * np.uint64(0xD6E8FEB86659FD93))
    return value


_FACTORS = (
    np.random.default_rng(20190724).integers(1 << 62, 1 << 63, BANDS, dtype=np.uint64)
    * np.uint64(2)
    + np.uint64(1)
)


def sketch(value: np.ndarray) -> list[int]:
    """For each band one hash of the drawn shingles in text order."""
    n = len(value)
    if n == 0:
        return []
    out = []
    rows = max(1, (1 << 21) // n)
    for at in range(0, BANDS, rows):
        hashed = value[None, :] * _FACTORS[at : at + rows, None]
        if n > DRAWN:
            drawn = np.argpartition(hashed, DRAWN - 1, axis=1)[:, :DRAWN]
            drawn.sort(axis=1)
        else:
            drawn = np.broadcast_to(np.arange(n), (len(hashed), n))
        picked = value[drawn]
        together = np.zeros(len(picked), np.uint64)
        for k in range(picked.shape[1]):
            together = _mixed(together + picked[:, k])
        out.append(together)
    return np.concatenate(out).view(np.int64).tolist()


def aligned(
    a: np.ndarray, order: np.ndarray, ranked: np.ndarray, b: np.ndarray, least: float
) -> float:
    """Similarity of b to a, or 0 where it is below ``least``.

    ``order`` and ``ranked`` are the places and values of a in order of value.
    """
    na, nb = len(a), len(b)
    if not na or not nb:
        return 0.0
    needed = least * (na + nb) / (1 + least) - 1e-9
    if min(na, nb) < needed:
        return 0.0
    at = np.searchsorted(ranked, b)
    at[at == na] = 0
    hit = ranked[at] == b
    if hit.sum() < needed:
        return 0.0
    i = np.flatnonzero(hit)
    j = order[at[hit]]
    band = na + nb - 2 * needed
    j = j[np.abs(i - j) <= band]
    if len(j) < needed:
        return 0.0
    if np.all(j[1:] > j[:-1]):
        common = len(j)
    else:
        tails: list[int] = []
        for x in j.tolist():
            k = bisect_left(tails, x)
            if k == len(tails):
                tails.append(x)
            else:
                tails[k] = x
        common = len(tails)
    similarity = common / (na + nb - common)
    return similarity if similarity >= least - 1e-12 else 0.0


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
            words = words_of(text)
            value = labelled(words)
            h = xxhash.xxh3_128_digest(b" ".join(words))
            h1, h2 = np.frombuffer(h, np.int64).tolist()
            rows.append((doc, len(value), h1, h2, sketch(value)))
        yield record_batch(rows, SKETCH_ARROW)


def _verifier(least: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, variants = None, []
        for batch in batches:
            rows = []
            for key, is_member, doc, text in zip(*(c.to_pylist() for c in batch), strict=True):
                value = labelled(words_of(text))
                if not is_member:
                    if key != hub:
                        hub, variants = key, []
                    order = np.argsort(value)
                    variants.append((value, order, value[order]))
                elif key == hub:
                    best = max((aligned(*v, value, least) for v in variants), default=0.0)
                    if best:
                        rows.append((hub, doc, best))
            yield record_batch(rows, LINKS_ARROW)

    return verify


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (hub, doc) that the alignment confirms, with their similarity."""
    counts = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("members"))
    chunks = F.ceil(F.col("members") / CHUNK)
    dealt = written(
        pairs.join(counts, "hub").select(
            "hub", "doc", F.pmod(F.xxhash64("doc"), chunks).alias("chunk")
        ),
        "pairs",
    )
    members = dealt.join(texts.withColumnRenamed("doc_id", "doc").hint("merge"), "doc").select(
        "hub", "chunk", F.lit(1).alias("is_member"), "doc", "text"
    )
    hubs = dealt.select("hub", "chunk").distinct()
    hubs = hubs.join(texts.withColumnRenamed("doc_id", "hub").hint("merge"), "hub").select(
        "hub", "chunk", F.lit(0).alias("is_member"), F.col("hub").alias("doc"), "text"
    )
    together = (
        members.union(hubs)
        .repartition("hub", "chunk")
        .sortWithinPartitions("hub", "chunk", "is_member")
        .select("hub", "is_member", "doc", "text")
    )
    return together.mapInArrow(_verifier(least), LINKS)


def _cells(value: np.ndarray) -> np.ndarray:
    return (value & np.uint64(CELLS - 1)).astype(np.int64)


def _cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    k = np.zeros(CELLS, np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            np.add.at(k, _cells(labelled(words_of(text))), 1)
    cells = np.flatnonzero(k)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(k[cells])], schema=COUNTS_ARROW)


def _rarest(often, least: float):
    """The labelled shingles among which any partner of the bound shares one, rarest first."""

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "label", "text"))
            for doc, label, text in zip(*columns, strict=True):
                value = labelled(words_of(text))
                n = len(value)
                seen = often.value[_cells(value)]
                order = np.lexsort((value, seen))[: n - math.ceil(least * n - 1e-9) + 1]
                place = np.flatnonzero(seen[order] > 1)  # one in its cell has no partner
                h = value[order[place]].view(np.int64)
                same = [np.full(len(h), x, np.int64) for x in (doc, label, n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (h, *same, place)], schema=RAREST_ARROW
                )

    return rarest


def open_pairs(docs: DataFrame, least: float) -> DataFrame:
    """Pairs (hub, doc) of ``docs`` (doc_id, label, text) with different labels that share one
    of their rarest labelled shingles: all pairs of the bound are among them."""
    counts = docs.mapInArrow(_cell_counts, COUNTS).groupBy("cell").agg(F.sum("k").alias("k"))
    counts = counts.toArrow()
    often = np.zeros(CELLS, np.uint32)
    often[counts["cell"].to_numpy()] = np.minimum(counts["k"].to_numpy(), 0xFFFFFFFF)
    often = docs.sparkSession.sparkContext.broadcast(often)
    entries = written(docs.mapInArrow(_rarest(often, least), RAREST), "rarest")
    by_label = entries.groupBy("h", "label").agg(F.count(F.lit(1)).alias("k"))
    shared = by_label.groupBy("h").agg(
        F.ceil(F.sum("k") / CHUNK).cast("int").alias("salts"),
        F.max_by("label", "k").alias("main"),
        F.count(F.lit(1)).alias("labels"),
    )
    shared = shared.where("labels > 1").drop("labels")
    entries = written(entries.join(shared, "h"), "rarest")
    # Within a label nothing is left to find, so only the rows outside of a shingle's main label
    # ask, and each pair of these once.
    a = entries.where("label <> main").select(
        "h",
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        *[F.col(c).alias(f"{c}_a") for c in ("doc", "label", "n", "place")],
    )
    b = entries.select(
        "h",
        F.pmod(F.xxhash64("doc"), "salts").cast("int").alias("salt"),
        (F.col("label") == F.col("main")).alias("is_main"),
        *[F.col(c).alias(f"{c}_b") for c in ("doc", "label", "n", "place")],
    )
    needed = F.ceil((F.col("n_a") + F.col("n_b")) * (least / (1 + least)) - 1e-6)
    pairs = a.join(b, ["h", "salt"]).where(
        (F.col("is_main") | (F.col("doc_a") < F.col("doc_b")))
        & (F.col("label_a") != F.col("label_b"))
        & (F.col("n_a") - F.col("place_a") >= needed)
        & (F.col("n_b") - F.col("place_b") >= needed)
    )
    ends = [F.least("doc_a", "doc_b").alias("hub"), F.greatest("doc_a", "doc_b").alias("doc")]
    return pairs.select(*ends).distinct()


def _with_label(df: DataFrame, column: str, labels: DataFrame | None, name: str) -> DataFrame:
    if labels is None:
        return df.withColumn(name, F.col(column))
    known = labels.select(F.col("node").alias(column), F.col("label").alias("_l"))
    return df.join(known, column, "left").withColumn(name, F.coalesce("_l", column)).drop("_l")


def near_duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """One row per document: doc_id, class_id, n_shingles, and kept (it is its class's id)."""
    own = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    )
    sketches = written(own.mapInArrow(_sketches, SKETCH), "sketches")
    worded = sketches.where("n > 0")
    copies = written(
        worded.groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("k"))
        .where("k > 1"),
        "copies",
    )
    member = written(
        sketches.select("doc_id", "n", "h1", "h2")
        .join(copies.select("h1", "h2", "rep"), ["h1", "h2"], "left")
        .select(
            "doc_id",
            "n",
            "h1",
            "h2",
            F.when(F.col("n") > 0, F.coalesce("rep", "doc_id"))
            .otherwise(F.col("doc_id"))
            .alias("rep"),
        ),
        "members",
    )
    later = member.where("rep <> doc_id").select("doc_id", "h1", "h2").distinct()
    reps = worded.join(later, ["doc_id", "h1", "h2"], "left_anti").select("doc_id", "n", "sketch")
    # A document of several texts ties those together that they are copies of.
    spread = [f(c).alias(f"{n}_{c}") for c in ("h1", "h2") for n, f in (("lo", F.min), ("hi", F.max))]
    several = member.groupBy("doc_id").agg(*spread).where("lo_h1 <> hi_h1 or lo_h2 <> hi_h2")
    ties = written(
        member.join(several, "doc_id", "left_semi")
        .where("rep <> doc_id")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        .distinct(),
        "ties",
    )

    tied = not ties.isEmpty()

    def classes_of(links: DataFrame) -> DataFrame:
        edges = links.select(F.col("hub").alias("a"), F.col("doc").alias("b"))
        return components(edges.unionByName(ties) if tied else edges)

    keys = reps.select("doc_id", "n", F.posexplode("sketch").alias("band", "value"))
    full = (
        keys.groupBy("band", "value")
        .agg(F.count(F.lit(1)).alias("size"))
        .where("size > 1")
    )
    full = written(full, "buckets")
    active = written(keys.join(full, ["band", "value"]), "active")
    company = active.groupBy("doc_id").agg(F.sum("size").alias("company"))
    active = written(
        active.select("band", "value", "doc_id", "n").distinct().join(company, "doc_id"), "active"
    )
    candidates = active.select("doc_id").distinct()
    texts = written(own.join(candidates.hint("merge"), "doc_id", "left_semi"), "texts")
    labels, links, buckets = None, None, active
    while not active.isEmpty():
        first = F.max(F.struct("company", (-F.col("doc_id")).alias("doc")))
        hubs = active.groupBy("band", "value").agg(first.alias("h"), F.count(F.lit(1)).alias("k"))
        hubs = written(
            hubs.where("k > 1").select("band", "value", (-F.col("h.doc")).alias("hub")), "hubs"
        )
        sized = active.join(hubs, ["band", "value"])
        sized = _with_label(_with_label(sized, "doc_id", labels, "own"), "hub", labels, "its")
        sized = written(sized, "sized")
        pairs = sized.where("own <> its").select("hub", F.col("doc_id").alias("doc")).distinct()
        pairs = written(pairs, "compared")
        found = written(verified(pairs, texts, least), "links")
        n_found = found.count()
        if not n_found:
            break
        links = found if links is None else links.unionByName(found)
        labels = classes_of(links)
        if n_found < LEAST_PAYING * pairs.count():
            break
        rest = sized.drop("own", "its")
        rest = _with_label(_with_label(rest, "doc_id", labels, "own"), "hub", labels, "its")
        active = written(
            rest.where("own <> its").select("band", "value", "doc_id", "n", "company"), "active"
        )
    # Every bucket's first hub has met all its members, so a bucket of two is settled.
    owned = _with_label(buckets.select("band", "value", "doc_id"), "doc_id", labels, "label")
    mixed = owned.groupBy("band", "value").agg(
        F.count(F.lit(1)).alias("k"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    mixed = mixed.where("k > 2 and low <> high").select("band", "value")
    left = owned.join(mixed, ["band", "value"], "left_semi").select("doc_id", "label").distinct()
    left = written(texts.join(left.hint("merge"), "doc_id"), "open")
    if not left.isEmpty():
        pairs = written(open_pairs(left, least), "compared")
        found = written(verified(pairs, texts, least), "links")
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels = classes_of(links)
    if labels is None and tied:
        labels = components(ties)
    classes = _with_label(member, "rep", labels, "class_id")
    per = classes.groupBy("doc_id").agg(
        F.min("class_id").alias("class_id"), F.max("n").alias("n_shingles")
    )
    return per.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def keep_one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its class, each document once.

    Rows without doc_id stay.
    """
    classes = written(near_duplicate_classes(docs, least=least), "classes")
    gone = classes.where("not kept").select("doc_id")
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k"))
    repeated = written(ids.where("k > 1 and doc_id is not null").select("doc_id"), "repeated")
    kept = docs.join(gone.hint("merge"), "doc_id", "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        kept = kept.join(repeated, "doc_id", "left_anti").unionByName(once)
    return kept.select(docs.columns)
