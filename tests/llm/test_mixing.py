from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from opsreport.llm import mixing as M
from opsreport.llm.queries import WEIGHTS
from tests.llm.conftest import prose

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def corpus(spark):
    rows = []
    for i in range(240):
        kind = ("code", "news", "talk")[i % 3 if i % 7 else 0]
        marks = {"code": "def return", "news": "today minister", "talk": "hello thanks"}[kind]
        rows.append((i, f"{prose(i, 30 + i % 50)} {marks}", kind))
    df = spark.createDataFrame(rows, f"{SCHEMA}, kind string")
    labels = df.where("doc_id < 150").select("doc_id", F.col("kind").alias("domain"))
    return df, labels


def solved(n, p, targets, start, steps=400):
    """Projected gradient in plain Python."""
    k = range(len(targets))
    m = [sum(w * q[j] for w, q in zip(n, p)) for j in k]
    r = [start] * len(n)
    for _ in range(steps):
        s = [sum(w * x * q[j] for w, x, q in zip(n, r, p)) for j in k]
        move = [(s[j] - targets[j]) / m[j] for j in k]
        r = [max(0.0, x - sum(q[j] * move[j] for j in k)) for x, q in zip(r, p)]
    return r


def test_totals_meet_targets(corpus):
    df, labels = corpus
    want = {"code": 0.2, "news": 0.5, "talk": 0.3}
    rows = M.mixture(df, labels, want).collect()
    total = sum(r.n_words for r in rows)
    for d, share in want.items():
        got = sum(r.rate * r.n_words * r[f"p_{d}"] for r in rows)
        assert abs(got - share * total) <= M.TOLERANCE * total
    assert all(r.rate >= 0 and abs(sum(r[f"p_{d}"] for d in want) - 1) < 1e-9 for r in rows)
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in rows)
    plan = M.mixture(df, labels, want)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rates_are_those_of_plain_steps(spark):
    n, p = [10, 30, 5, 0, 20], [[0.9, 0.1], [0.2, 0.8], [0.5, 0.5], [1.0, 0.0], [0.6, 0.4]]
    scored = spark.createDataFrame(list(zip(n, p)), "n long, p array<double>")
    fitted = M.fit_rates(scored, [0.8, 0.2], tolerance=0.0, max_steps=20)
    rates = [r[0] for r in scored.select(M.rate_of(F.col("p"), fitted)).collect()]
    own = solved(n, p, fitted.targets, fitted.start, len(fitted.moves))
    assert rates == pytest.approx(own)
    assert sum(w * x * q[0] for w, x, q in zip(n, own, p)) == pytest.approx(fitted.totals[0])


def test_steps_over_written_rates(spark, monkeypatch):
    rows = [(10, [0.9, 0.1]), (30, [0.2, 0.8]), (7, [0.5, 0.5])]
    scored = spark.createDataFrame(rows, "n long, p array<double>")
    long = M.fit_rates(scored, [0.5, 0.5], tolerance=1e-9, max_steps=12)
    monkeypatch.setattr(M, "WRITE_EVERY", 2)
    short = M.fit_rates(scored, [0.5, 0.5], tolerance=1e-9, max_steps=12)
    assert short.totals == pytest.approx(long.totals)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = M.quality_domains(spark.read.parquet(f"{folder}/labels.parquet"))
    model = M.fit(docs, labels.where("doc_id % 2 = 0"))
    told = M.with_posteriors(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), model)
    names = F.array(*[F.lit(d) for d in model.domains])
    best = F.element_at(names, F.array_position("_p", F.array_max("_p")).cast("int"))
    rows = told.groupBy("domain").agg(F.avg((best == F.col("domain")).cast("int")).alias("right"))
    right = {r["domain"]: r["right"] for r in rows.collect()}
    assert right["good"] > 0.99 and right["poor"] > 0.95 and right["toxic"] > 0.6


def test_documents_are_repeated_by_their_copies(corpus):
    df, labels = corpus
    want = {"code": 0.1, "news": 0.8, "talk": 0.1}
    copies = {r.doc_id: r.copies for r in M.mixture(df, labels, want).collect()}
    out = M.mixed_documents(df, labels, want)
    assert out.columns == df.columns
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {i: c for i, c in copies.items() if c}


def test_edges(spark, edges, nothing, clashing, corpus):
    labels = spark.createDataFrame(
        [(1, "good"), (7, "poor"), (None, "good"), (8, None), (1, "good")],
        "doc_id long, domain string",
    )
    rows = M.mixture(edges, labels, WEIGHTS).collect()
    assert len(rows) == 10 and all(r.rate >= 0 for r in rows)
    assert {r.n_words for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert M.mixed_documents(clashing, labels, WEIGHTS).columns == clashing.columns
    assert M.mixture(nothing, labels, WEIGHTS).count() == 0
    none = labels.limit(0)
    assert {r.rate for r in M.mixture(edges, none, WEIGHTS).collect()} == {1.0}
    blank = edges.where("doc_id in (3, 4)")
    assert {r.rate for r in M.mixture(blank, labels, WEIGHTS).collect()} == {0.0}


def test_each_domain_has_its_share_of_the_features(spark):
    rows = []
    for i in range(300):
        loud = " ".join(f"loud{k}" for k in range(20))
        own = loud if i % 3 == 0 else "quiet" if i % 15 == 1 else ""
        rows.append((i, f"{prose(i, 20)} {own}", ("a", "b", "c")[i % 3]))
    df = spark.createDataFrame(rows, f"{SCHEMA}, domain string")
    model = M.fit(df, df.select("doc_id", "domain"), max_features=12)
    assert "quiet" in model.features and len(model.features) <= 12
