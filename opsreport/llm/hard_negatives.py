"""Hard negatives by inner product, with length buckets and coordinate pruning.

Vectors become integers, floor(scale * x). An anchor's positives are its ``positives`` best other
rows of the same label; the hard negatives of an anchor and a positive are its best rows of
other labels whose score lies between two shares of the positive's. Higher inner products come
first, ties by smaller id.

Rows are put into buckets of like length. A bucket holds its vectors and, for each coordinate,
the order of its rows by the normalised value there. A row can reach a score ``t`` against an
anchor only if its cosine is at least c = t / (length of the anchor * greatest length of the
bucket): a bucket with c > 1 is skipped; else the angles limit every normalised coordinate of
the row to the range cos(a + b) .. cos(a - b) with a, b the arc cosines of the anchor's
coordinate and of c. The ranges of the anchor's largest coordinates (its focus) are cut out of
the sorted lists, the rows in all of them are verified exactly. The score to reach is the worst
of the best found so far: first in the longest bucket, then from bucket to bucket, from long to
short. Where ranges are wide all rows of a bucket are verified; no bound drops a row that counts.

Rows with a null id, label or vector, or a null or non-finite component, take no part, nor do
vectors of a length of 2^31 or more after scaling, whose scores a long may not hold. A zero
vector does (it scores 0); shorter vectors count as filled up with zeros. A repeated id counts
once, with its least label, then its least vector.
An empty table gives no rows, and an anchor without rows of its label none either.

Anchors meet all rows by definition, in tiles: groups of buckets against groups of anchors, each
of bounded size. A bucket is split by a hash of the id beyond ``bucket_rows``, so that equal
vectors, which share a length, share no task. A tile returns at most k rows per anchor. Index
and intermediate tables lie in the shared folder.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsreport.llm.common import record, written
from opsreport.operators.ranges import range_edges, range_of

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: Percent of the positive's score that a negative has at least and at most.
BAND = (30, 90)
BUCKET_ROWS = 4096
#: Length classes at most; beyond, classes have more buckets. Bounds what the driver holds.
CLASSES = 4096
#: A tile's bounds: buckets and anchors.
TILE_BUCKETS = 32
TILE_ANCHORS = 4096
FOCUS = 4
#: Scores below this are exact in doubles.
EXACT = 2.0**53

INDEX = record(
    "bucket long, part long, longest double, ids binary, labels binary, vectors binary, "
    "orders binary"
)
FOUND = record("anchor_id long, positive_id long, positive_score long, vec_id long, score long")


def prepared(
    vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: int
) -> DataFrame:
    """(vec_id, label, v, length2): one row per id that takes part, v of one size throughout."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform(vector_col, lambda x: x.cast("double")).alias("x"),
    )
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(2.0**31)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite)
    rows = rows.select(
        "vec_id", "label", F.transform("x", lambda x: F.floor(x * F.lit(float(scale)))).alias("v")
    )
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = rows.where(square < F.lit(2.0**62)).select(
        "vec_id", F.struct("label", F.transform("v", lambda x: x.cast("int")).alias("v")).alias("r")
    )
    once = written(rows.groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.*"), "once")
    size = once.agg(F.max(F.size("v"))).first()[0] or 1
    filled = F.concat("v", F.array_repeat(F.lit(0), F.lit(size) - F.size("v")))
    square = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x)
    return once.select("vec_id", "label", filled.alias("v"), square.alias("length2"))


def in_buckets(rows: DataFrame, bucket_rows: int) -> tuple[DataFrame, int]:
    """``rows`` with a bucket number that grows with length, and the number of buckets."""
    length2 = F.col("length2")
    n = rows.count()
    edges = range_edges(rows, length2, max(1, min(CLASSES, math.ceil(n / bucket_rows))))
    if not edges:
        return rows.withColumn("bucket", F.lit(0).cast("long")), 0
    at = range_of(length2, edges)
    counts = dict(rows.select(at.alias("at")).groupBy("at").count().collect())
    buckets = [math.ceil(counts.get(i, 0) / bucket_rows) for i in range(len(edges))]
    first = [sum(buckets[:i]) for i in range(len(edges))]
    numbers = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    split = F.pmod(F.xxhash64("vec_id"), F.get(numbers(buckets), F.col("_at")))
    return (
        rows.withColumn("_at", at)
        .withColumn("bucket", F.get(numbers(first), F.col("_at")) + split)
        .drop("_at"),
        sum(buckets),
    )


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = pa.concat_arrays(c.flatten() for c in column.chunks) if column.num_chunks else None
    values = flat.to_numpy(zero_copy_only=False) if flat is not None else np.zeros(0)
    return np.asarray(values, np.int32).reshape(n, -1)


def _unit(vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return vectors / np.where(lengths > 0, lengths, 1.0)[:, None]


def _indexed(parts: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        ids = rows.column("vec_id").to_numpy()
        by_id = np.argsort(ids, kind="stable")
        vectors = _matrix(rows.column("v"), len(ids))[by_id]
        lengths = np.sqrt(rows.column("length2").to_numpy().astype(np.float64))[by_id]
        orders = np.argsort(_unit(vectors, lengths), axis=0, kind="stable").T.astype(np.int32)
        bucket = key[0].as_py()
        row = {
            "bucket": bucket,
            "part": bucket % parts,
            "longest": float(lengths.max()),
            "ids": ids[by_id].astype(np.int64).tobytes(),
            "labels": rows.column("label").to_numpy()[by_id].astype(np.int64).tobytes(),
            "vectors": vectors.tobytes(),
            "orders": np.ascontiguousarray(orders).tobytes(),
        }
        return pa.Table.from_pylist([row], schema=INDEX[1])

    return run


class Bucket:
    """One bucket of the index, ready to search."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels = np.frombuffer(row["labels"], np.int64)
        n = len(self.ids)
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(n, -1)
        self.orders = np.frombuffer(row["orders"], np.int32).reshape(-1, n)
        self.longest = row["longest"]
        self.doubles = self.vectors.astype(np.float64)
        unit = _unit(self.doubles, np.sqrt((self.doubles**2).sum(axis=1)))
        self.sorted = np.take_along_axis(unit.T, self.orders, axis=1)

    def candidates(self, unit: np.ndarray, length: float, least: float) -> np.ndarray | None:
        """Rows that may score ``least`` or more, None for all of them."""
        if least <= 0 or not len(unit):
            return None
        reach = length * self.longest
        # Room for rounding: bounds are loosened, never tightened.
        cosine = least / reach * (1 - 1e-9) if reach else 2.0
        if cosine > 1:
            return np.zeros(0, np.int64)
        b = math.acos(cosine) + 1e-7
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        cuts = []
        for f in focus:
            a = math.acos(max(-1.0, min(1.0, float(unit[f]))))
            low, high = math.cos(min(math.pi, a + b)), math.cos(max(0.0, a - b))
            lo = np.searchsorted(self.sorted[f], low - 1e-9, "left")
            hi = np.searchsorted(self.sorted[f], high + 1e-9, "right")
            cuts.append((hi - lo, f, lo, hi))
        cuts.sort()
        if cuts[0][0] > len(self.ids) // 2:
            return None
        seen = np.zeros(len(self.ids), np.uint8)
        for _, f, lo, hi in cuts:
            seen[self.orders[f, lo:hi]] += 1
        return np.nonzero(seen == len(cuts))[0]

    def scores(self, vector: np.ndarray, length: float, rows: np.ndarray | None) -> np.ndarray:
        if length * self.longest < EXACT:
            part = self.doubles if rows is None else self.doubles[rows]
            return (part @ vector.astype(np.float64)).astype(np.int64)
        part = self.vectors if rows is None else self.vectors[rows]
        return part.astype(np.int64) @ vector.astype(np.int64)


class Best:
    """The k best (score, id) so far between two scores."""

    def __init__(self, k: int, least: int, most: int | None):
        self.k, self.least, self.most = k, least, most
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = scores >= self.least
        if self.most is not None:
            fits &= scores <= self.most
        if not fits.any():
            return
        scores = np.concatenate([self.scores, scores[fits]])
        ids = np.concatenate([self.ids, ids[fits]])
        if len(scores) > 4 * self.k:
            # Every row that ties with the k-th best stays until ids decide.
            edge = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            near = scores >= edge
            scores, ids = scores[near], ids[near]
        first = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[first], ids[first]
        if len(first) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


#: Below any score.
NO_BOUND = -(2**62)


def _searched(k: int, same_label: bool):
    """Searches a tile. Right rows: anchor_id, label, v and ``goals``, an array of structs
    (positive_id, positive_score, least, most), each of which asks for k rows."""

    def run(index: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if index.num_rows and anchors.num_rows:
            rows = sorted(index.to_pylist(), key=lambda r: -r["longest"])
            vectors = _matrix(anchors.column("v"), anchors.num_rows)
            ids, labels = (anchors.column(c).to_pylist() for c in ("anchor_id", "label"))
            goals = anchors.column("goals").to_pylist()
            best = [
                [(g, Best(k, g["least"], g["most"])) for g in asked] for asked in goals
            ]
            lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
            units = _unit(vectors, lengths)
            for row in rows:
                bucket = Bucket(row)
                for i, asked in enumerate(best):
                    if not asked:
                        continue
                    least = min(b.least for _, b in asked)
                    length = float(lengths[i])
                    hits = bucket.candidates(units[i], length, least)
                    if hits is not None and not len(hits):
                        continue
                    scores = bucket.scores(vectors[i], length, hits)
                    found, kinds = bucket.ids, bucket.labels
                    if hits is not None:
                        found, kinds = found[hits], kinds[hits]
                    right = (kinds == labels[i]) == same_label
                    right &= (found != ids[i]) & (scores >= least)
                    scores, found = scores[right], found[right]
                    for _, b in asked:
                        b.add(scores, found)
            for i, asked in zip(ids, best, strict=True):
                for g, b in asked:
                    for s, v in zip(b.scores.tolist(), b.ids.tolist(), strict=True):
                        out.append((i, g["positive_id"], g["positive_score"], v, s))
        columns = zip(*out, strict=True) if out else ([] for _ in FOUND[1])
        return pa.table([pa.array(list(c), pa.int64()) for c in columns], schema=FOUND[1])

    return run


def _search(index: DataFrame, parts: int, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """The k best of each goal over the whole index, without ties left open."""
    groups = max(1, math.ceil(anchors.count() / TILE_ANCHORS))
    left = index.withColumn(
        "tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    )
    right = anchors.withColumn("tile", F.pmod(F.xxhash64("anchor_id"), F.lit(groups))).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    )
    found = (
        left.groupBy("part", "tile")
        .cogroup(right.groupBy("part", "tile"))
        .applyInArrow(_searched(k, same), FOUND[0])
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _goal(positive: Column, score: Column, least: Column, most: Column) -> Column:
    return F.struct(
        positive.cast("long").alias("positive_id"),
        score.cast("long").alias("positive_score"),
        least.cast("long").alias("least"),
        most.cast("long").alias("most"),
    )


def _raised(asked: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """Goals whose least score is the k-th best of the seeds, where those were k."""
    worst = seeds.groupBy("anchor_id", "positive_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("worst")
    )
    g = asked.withColumn("g", F.explode("goals")).withColumn("positive_id", F.col("g.positive_id"))
    raised = F.when(F.col("n") == k, F.greatest("g.least", "worst")).otherwise(F.col("g.least"))
    goal = _goal(F.col("g.positive_id"), F.col("g.positive_score"), raised, F.col("g.most"))
    goals = (
        g.join(worst, ["anchor_id", "positive_id"], "left")
        .groupBy("anchor_id")
        .agg(F.collect_list(goal).alias("goals"))
    )
    return asked.drop("goals").join(goals, "anchor_id")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``vec_id``; ``label`` may be an expression.
    """
    label = F.col(label) if isinstance(label, str) else label
    spark = vectors.sparkSession
    rows = prepared(vectors, id_col, vector_col, label, scale)
    placed, buckets = in_buckets(rows, bucket_rows)
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, math.ceil(buckets / TILE_BUCKETS), min(buckets, wanted))
    index = written(
        placed.groupBy("bucket").applyInArrow(_indexed(parts), INDEX[0]), "length-buckets"
    )
    # The longest bucket alone, as one part, gives the first bounds.
    seeds = index.where(F.col("bucket") == buckets - 1).withColumn("part", F.lit(0).cast("long"))
    anchors = rows.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "v")
    none = F.lit(None)
    any_row = F.array(_goal(F.lit(0), none, F.lit(NO_BOUND), none))
    asked = anchors.withColumn("goals", any_row)
    first = _search(seeds, 1, asked, positives, True)
    mates = _search(index, parts, _raised(asked, first, positives), positives, True)
    mates = written(mates.select("anchor_id", "vec_id", "score"), "positives")
    score = F.col("score")
    # Decimals hold the products of any long.
    least = F.ceil(score.cast("decimal(20,0)") * band[0] / 100)
    most = F.floor(score.cast("decimal(20,0)") * band[1] / 100)
    banded = mates.where(score >= 0).groupBy("anchor_id")
    goals = banded.agg(F.collect_list(_goal(F.col("vec_id"), score, least, most)).alias("goals"))
    asked = written(anchors.join(goals, "anchor_id"), "goals")
    first = _search(seeds, 1, asked, negatives, False)
    found = _search(index, parts, _raised(asked, first, negatives), negatives, False)
    return found.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
