"""Approximate nearest neighbours: low-dimensional stable projections in kd-trees.

Vectors are projected on ``M`` Gaussian directions. For two points at distance d, the squared
distance of their projections divided by d squared follows a chi-square distribution with M
degrees of freedom. So a search goes through the points in order of projected distance,
verifies them on the original vectors, and stops as soon as the next projected distance, over
the distance of the k-th neighbour found so far, lies beyond the ``CONFIDENCE`` quantile: a
point still nearer than the k-th would have been met before with that probability.

Largest inner products become least distances by one more coordinate, sqrt(R2 - |x|^2) for
points and 0 for queries, where R2 is the largest squared norm.

Layout
- Cells: a kd-tree over the projections of a sample of at most ``SAMPLE`` rows (by hash of the
  id; only the cut planes come from it) cuts the space in cells of about ``CELL`` rows. Every row
  goes to its cell. A cell with more rows than that, such as one vector repeated a million
  times, is dealt over several blocks, as many as its exact count asks for.
- Round 1: every query searches the cell whose box is nearest and gets a bound for its k-th distance.
- Round 2: it searches the other cells whose box, worked out over all rows, lies within the
  stopping radius of that bound. A group holds one block and at most about ``ASKED`` of its
  queries. Inside a block a kd-tree gives leaves in order of projected distance, with the same
  stopping test leaf by leaf.

Queries are the rows the caller names; candidates all rows. Vectors that are null, empty, zero,
of another length than most, or that hold null or non-finite components take no part, nor do
rows without an id. Equal scores go to the smaller id. With fewer than k candidates all are
returned. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsreport.llm.common import record, record_batch, written

M = 8
CONFIDENCE = 0.97
SAMPLE = 50_000
CELL = 2048
ASKED = 4096
LEAF = 64
SEED = 77

POINTS, POINTS_ARROW = record("id long, x doubles, p doubles, cell long")
VISITS, VISITS_ARROW = record("cell long, id long, x doubles, p doubles, bound double")
FOUND, _ = record("query long, id long, score double")


def chi_square_quantile(p: float, m: int) -> float:
    """Of an even number of degrees of freedom, by bisection of the closed form."""
    half = m // 2

    def below(x: float) -> float:
        term, total = 1.0, 0.0
        for k in range(half):
            total += term
            term *= x / 2 / (k + 1)
        return 1.0 - np.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, M))


def kd_cells(points: np.ndarray, least: int) -> list[tuple]:
    """Cut planes (axis, value, left, right) of a tree; a negative child -c - 1 is cell c."""
    nodes: list[tuple] = []
    cells = 0

    def cut(rows: np.ndarray) -> int:
        nonlocal cells
        own = points[rows]
        axis = int(np.argmax(own.max(0) - own.min(0))) if len(rows) else 0
        if len(rows) >= 2 * least:
            value = float(np.median(own[:, axis]))
            left = own[:, axis] < value
            if left.any() and not left.all():
                at = len(nodes)
                nodes.append(())
                nodes[at] = (axis, value, cut(rows[left]), cut(rows[~left]))
                return at
        cells += 1
        return -cells

    root = cut(np.arange(len(points)))
    return nodes or [(0, float("-inf"), root, root)]


def cell_of(p: np.ndarray, nodes: list[tuple]) -> np.ndarray:
    out = np.zeros(len(p), np.int64)
    stack = [(0, np.arange(len(p)))]
    while stack:
        at, rows = stack.pop()
        if at < 0:
            out[rows] = -at - 1
            continue
        axis, value, left, right = nodes[at]
        side = p[rows, axis] < value
        stack += [(left, rows[side]), (right, rows[~side])]
    return out


class Leaves:
    """A kd-tree over the projections of one block, as boxes of its leaves."""

    def __init__(self, p: np.ndarray) -> None:
        parts = []
        stack = [np.arange(len(p))]
        while stack:
            rows = stack.pop()
            if len(rows) > LEAF:
                own = p[rows]
                axis = int(np.argmax(own.max(0) - own.min(0)))
                half = len(rows) // 2
                rows = rows[np.argpartition(own[:, axis], half)]
                stack += [rows[:half], rows[half:]]
            else:
                parts.append(rows)
        self.order = np.concatenate(parts)
        self.ends = np.cumsum([0, *map(len, parts)])
        self.low = np.array([p[r].min(0) for r in parts])
        self.high = np.array([p[r].max(0) for r in parts])

    def by_distance(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves in order of squared projected distance, and those distances."""
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0.0)
        d = np.einsum("ij,ij->i", gap, gap)
        order = np.argsort(d, kind="stable")
        return order, d[order]


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, the same for equal rows wherever they stand."""
    return np.einsum("ij,j->i", x, q, optimize=False)


def search_block(
    ids: np.ndarray,
    x: np.ndarray,
    leaves: Leaves,
    query: tuple,
    k: int,
    r2: float,
    quantile: float,
) -> list[tuple[int, float]]:
    """The k best of a block for one query: (id, score), by the stopping test.

    Scores below the bound are left out: k others are known to be better.
    """
    qid, q, qp, bound = query
    q2 = float(q @ q) + r2
    best_ids = np.empty(0, np.int64)
    best = np.empty(0)
    order, gaps = leaves.by_distance(qp)
    at, step = 0, 4
    while at < len(order):
        kth = max(bound, best[k - 1] if len(best) >= k else -np.inf)
        far = max(q2 - 2 * kth, 0.0)
        if gaps[at] > quantile * far:
            break
        rows = np.concatenate(
            [leaves.order[leaves.ends[o] : leaves.ends[o + 1]] for o in order[at : at + step]]
        )
        s = scores(x[rows], q)
        own = (ids[rows] != qid) & (s >= bound)
        rows, s = rows[own], s[own]
        best_ids, best = np.concatenate([best_ids, ids[rows]]), np.concatenate([best, s])
        ranked = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[ranked], best[ranked]
        at += step
        step = min(2 * step, 64)
    return list(zip(best_ids.tolist(), best.tolist(), strict=True))


def _projector(dim: int, r2: float, nodes: list[tuple], query: bool):
    axes = directions(dim + 1)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch[1].to_pylist(), float).reshape(-1, dim)
            rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(r2 - scores2(x), 0.0))
            p = np.column_stack([x, rest]) @ axes
            rows = zip(batch[0].to_pylist(), x.tolist(), p.tolist(), cell_of(p, nodes).tolist())
            yield record_batch(list(rows), POINTS_ARROW)

    return project


def _router(
    cells: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    r2: float,
    quantile: float,
    nearest_only: bool,
):
    """Sends queries (id, x, p, bound) to the nearest cell, or to all others within reach."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            names = ["id", "x", "p", *([] if nearest_only else ["bound"])]
            for row in batch.select(names).to_pylist():
                p, x = np.asarray(row["p"]), np.asarray(row["x"])
                gap = np.maximum(np.maximum(low - p, p - high), 0.0)
                d = np.einsum("ij,ij->i", gap, gap)
                home = int(np.argmin(d))
                bound = row.get("bound", float("-inf"))
                if nearest_only:
                    to = [home]
                else:
                    far = quantile * max(float(x @ x) + r2 - 2 * bound, 0.0)
                    to = [c for c in np.flatnonzero(d <= far).tolist() if c != home]
                rows += [(int(cells[c]), row["id"], row["x"], row["p"], bound) for c in to]
            yield record_batch(rows, VISITS_ARROW)

    return route


def scores2(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x, optimize=False)


def _searcher(k: int, r2: float, quantile: float):
    def search(_: tuple, points, queries):
        import pandas as pd

        out = []
        if len(points) and len(queries):
            ids = points["id"].to_numpy(np.int64)
            x = np.stack(points["x"].to_numpy())
            leaves = Leaves(np.stack(points["p"].to_numpy()))
            for row in queries.itertuples(index=False):
                query = (row.id, np.asarray(row.x), np.asarray(row.p), row.bound)
                found = search_block(ids, x, leaves, query, k, r2, quantile)
                out += [(row.id, i, s) for i, s in found]
        return pd.DataFrame(out, columns=["query", "id", "score"]).astype(
            {"query": "int64", "id": "int64", "score": "float64"}
        )

    return search


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists(x, lambda v: v != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(
        F.col("id").isNotNull() & F.col("x").isNotNull() & finite & some
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k largest inner products found.

    A query id given more than once is one query, with its least vector; repeated rows of
    ``vectors`` are candidates of their own.
    """
    all_rows = usable(vectors, id_col, vector_col)
    norm = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    sizes = all_rows.groupBy(F.size("x").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.max(norm).alias("r2")
    )
    top = sizes.orderBy(F.desc("n"), "dim").first()
    empty = all_rows.limit(0).select(
        F.col("id").alias("query_id"),
        F.lit(0).alias("rank"),
        F.col("id").alias("vec_id"),
        F.lit(0.0).alias("score"),
    )
    if top is None:
        return empty
    dim, rows, r2 = int(top["dim"]), int(top["n"]), float(top["r2"])
    all_rows = all_rows.where(F.size("x") == dim)
    asked = usable(queries, id_col, vector_col).where(F.size("x") == dim)
    asked = asked.groupBy("id").agg(F.min("x").alias("x"))
    axes = directions(dim + 1)
    sample = (
        all_rows.orderBy(F.xxhash64("id"), "id").limit(min(SAMPLE, rows)).select("x").toArrow()
    )
    sx = np.array(sample["x"].to_pylist(), float).reshape(-1, dim)
    sp = np.column_stack([sx, np.sqrt(np.maximum(r2 - scores2(sx), 0.0))]) @ axes
    nodes = kd_cells(sp, max(1, int(CELL * min(1.0, len(sp) / rows))))

    points = written(all_rows.mapInArrow(_projector(dim, r2, nodes, False), POINTS), "points")
    asking = written(asked.mapInArrow(_projector(dim, r2, nodes, True), POINTS), "queries")
    corner = [
        f(F.col("p")[i]).alias(f"{n}{i}") for n, f in (("l", F.min), ("h", F.max)) for i in range(M)
    ]
    boxes = points.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), *corner)
    # At most SAMPLE cells, as every cell holds a row of the sample.
    box = boxes.orderBy("cell").toArrow()
    blocks = boxes.select("cell", F.ceil(F.col("rows") / CELL).alias("blocks"))
    quantile = chi_square_quantile(confidence, M)
    search = _searcher(k, r2, quantile)

    def run(visits: DataFrame, name: str) -> DataFrame:
        """visits: cell, id, x, p, bound. Groups hold a block and a bounded part of its queries."""
        parts = written(
            visits.groupBy("cell")
            .agg(F.ceil(F.count(F.lit(1)) / ASKED).alias("parts"))
            .join(blocks, "cell"),
            "parts",
        )
        upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
        there = points.join(parts, "cell").select(
            "cell",
            F.pmod(F.xxhash64("id"), "blocks").alias("block"),
            upto("parts").alias("part"),
            "id",
            "x",
            "p",
        )
        asking = visits.join(parts, "cell").select(
            "cell",
            upto("blocks").alias("block"),
            F.pmod(F.xxhash64("id"), "parts").alias("part"),
            "id",
            "x",
            "p",
            "bound",
        )
        keys = ("cell", "block", "part")
        pairs = there.groupBy(*keys).cogroup(asking.groupBy(*keys))
        return written(_best(pairs.applyInPandas(search, FOUND), k).drop("rank"), name)

    cells = np.array(box["cell"].to_pylist(), np.int64)
    low, high = (
        np.column_stack([box[f"{n}{i}"].to_numpy() for i in range(M)]) for n in ("l", "h")
    )
    none = float("-inf")
    near = asking.mapInArrow(_router(cells, low, high, r2, quantile, True), VISITS)
    first = run(written(near, "near"), "first")
    bounds = first.groupBy(F.col("query").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")
    )
    bounded = asking.join(bounds, "id", "left").select(
        "id", "x", "p", F.when(F.col("n") >= k, F.col("kth")).otherwise(none).alias("bound")
    )
    router = _router(cells, low, high, r2, quantile, False)
    second = run(written(bounded.mapInArrow(router, VISITS), "visits"), "second")
    best = _best(first.unionByName(second), k)
    return best.select(
        F.col("query").alias("query_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("vec_id"),
        "score",
    )
