"""Mixing documents to target weights by soft membership, in DataFrame functions.

1. A classifier learnt from a labelled table gives each document posteriors over the domains.
   It is Bernoulli naive Bayes over at most ``MAX_FEATURES`` features, those whose log odds
   between a domain and the rest lie furthest from zero in standard errors, and at least
   ``LEAST_ODDS`` from it. Domains take turns in choosing, what speaks for them first, so each has its share: weak features, such as the common words of one language, hang
   together, and naive Bayes would count them over and over. Features are the
   distinct lower-case words of a text, and shape features for the share of symbols, capitals
   and different words. It learns from at most ``MAX_LABELLED`` labelled documents, those with
   the least hash of their id; the weights are a few thousand numbers and travel as literals.
2. Rates r_i >= 0 of the documents minimise

       sum over k of (sum over i of r_i n_i p_ik - T_k)^2 / m_k,    m_k = sum over i of n_i p_ik

   (n_i words, p_ik posteriors, T_k = budget * weight of domain k) by projected gradient. With
   the gradient taken per word the step is one: r_i <- max(0, r_i - sum over k of
   p_ik (S_k - T_k) / m_k). A step is one sum over all documents; rates are written to the
   shared folder every ``WRITE_EVERY`` steps. It ends when all totals are within ``TOLERANCE`` of
   the budget of their targets, or when a step betters the objective by less than ``LEAST_GAIN``
   (targets that no rates can reach, such as none of a domain that all documents share in).

A document comes out ``copies`` times: the rate rounded up or down by a hash of its id and text,
so that the expected number is the rate.

Null and empty texts have no words and weigh nothing: their posteriors are the priors', and
they get rates like any other. Repeated rows are documents of their own with equal rates. An id
labelled twice with different domains counts once for each. Without labels there is one domain.
Weights of domains without labels are left out, the others scaled to one. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsreport.llm.common import text_or_empty, written

MAX_LABELLED = 20_000
MAX_FEATURES = 256
LEAST_Z = 3.0
LEAST_ODDS = 2.5
SMOOTHING = 0.5
TOLERANCE = 5e-3
MAX_STEPS = 200
LEAST_GAIN = 0.01
WRITE_EVERY = 8
SYMBOLS = "#$%&*|!<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BREAKS = r"[\s.,;:?!()\"#$%&*|<>]+"


@dataclass(frozen=True)
class Model:
    domains: tuple[str, ...]
    features: tuple[str, ...]
    bias: tuple[float, ...]
    weights: tuple[tuple[float, ...], ...]  # by domain, then feature


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), BREAKS), lambda w: w != "")


def _share(part: Column, whole: Column, name: str, steps: int) -> Column:
    return F.concat(
        F.lit(f" {name} "),
        F.when(whole > 0, F.floor(part * steps / whole)).otherwise(0).cast("string"),
    )


def with_features(docs: DataFrame, text_col: str) -> DataFrame:
    """docs with ``_words`` (their number) and ``_features`` (distinct)."""
    text = text_or_empty(text_col)
    size = F.length(text)
    gone = lambda chars: size - F.length(F.translate(text, chars, ""))
    words = docs.withColumn("_all", _words(text))
    distinct = words.withColumn("_distinct", F.array_distinct("_all"))
    shapes = F.array(
        _share(gone(SYMBOLS), size, "symbols", 50),
        _share(gone(CAPITALS), size, "capitals", 10),
        _share(F.size("_distinct"), F.size("_all"), "different", 10),
    )
    return distinct.select(
        *docs.columns,
        F.size("_all").cast("long").alias("_words"),
        F.concat("_distinct", shapes).alias("_features"),
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_labelled: int = MAX_LABELLED,
    max_features: int = MAX_FEATURES,
    least_odds: float = LEAST_ODDS,
) -> Model:
    """The classifier; ``labels`` has the id and a ``domain``."""
    known = labels.select(F.col(id_col).alias("_id"), F.col("domain").alias("_domain"))
    known = known.where(F.col("_id").isNotNull() & F.col("_domain").isNotNull()).distinct()
    sample = known.orderBy(F.xxhash64("_id"), "_id", "_domain").limit(max_labelled)
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # At most max_labelled rows of an id and a label: safe to send to every task.
    labelled = own.join(F.broadcast(sample), "_id")
    told = written(
        with_features(labelled, "_text").select("_domain", "_features"), "labelled"
    )
    sizes = told.groupBy("_domain").count().orderBy("_domain").collect()
    if not sizes:
        return Model(("all",), (), (0.0,), ((),))
    names = [r["_domain"] for r in sizes]
    n = [float(r["count"]) for r in sizes]
    total = sum(n)
    count = [
        F.sum((F.col("_domain") == d).cast("long")).cast("double").alias(f"c{k}")
        for k, d in enumerate(names)
    ]
    seen = told.select("_domain", F.explode("_features").alias("w")).groupBy("w").agg(*count)
    z, above = [], []
    for k in range(len(names)):
        c = F.col(f"c{k}")
        rest = sum((F.col(f"c{j}") for j in range(len(names)) if j != k), F.lit(0.0))
        a = SMOOTHING
        odds = F.log((c + a) / (n[k] - c + a)) - F.log((rest + a) / (total - n[k] - rest + a))
        far = F.abs(odds) / F.sqrt(1 / (c + a) + 1 / (rest + a))
        z.append(F.when(F.abs(odds) >= least_odds, far).otherwise(0.0))
        above.append(odds > 0)
    strong = seen.select(
        "*",
        *[x.alias(f"z{k}") for k, x in enumerate(z)],
        *[x.alias(f"above{k}") for k, x in enumerate(above)],
    )
    strong = written(
        strong.where(F.greatest(*[F.col(f"z{k}") for k in range(len(z))], F.lit(0.0)) >= LEAST_Z),
        "features",
    )
    ranked = [
        strong.where(F.col(f"z{k}") >= LEAST_Z)
        .orderBy(F.desc(f"above{k}"), F.desc(f"z{k}"), "w")
        .limit(max_features)
        .collect()
        for k in range(len(names))
    ]
    chosen: dict = {}
    for turn in zip_longest(*ranked):
        for r in turn:
            if r is not None and len(chosen) < max_features:
                chosen.setdefault(r["w"], r)
    kept = list(chosen.values())
    bias, weights = [], []
    for k in range(len(names)):
        p = [(r[f"c{k}"] + SMOOTHING) / (n[k] + 2 * SMOOTHING) for r in kept]
        bias.append(math.log(n[k] / total) + sum(math.log(1 - x) for x in p))
        weights.append(tuple(math.log(x / (1 - x)) for x in p))
    return Model(tuple(names), tuple(r["w"] for r in kept), tuple(bias), tuple(weights))


def _log_likelihood(bias: float, weights: Column) -> Column:
    return F.aggregate("_at", F.lit(bias), lambda a, i: a + F.element_at(weights, i))


def with_posteriors(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with ``_words`` and ``_p``, the array of posteriors in the order of the domains."""
    columns = docs.columns
    if not model.features:
        prior = F.array(*[F.lit(math.exp(b)) for b in model.bias])
        return with_features(docs, text_col).select(*columns, "_words", prior.alias("_p"))
    vocabulary = F.array(*[F.lit(w) for w in model.features])
    places = F.transform(
        F.array_intersect(F.col("_features"), vocabulary),
        lambda w: F.array_position(vocabulary, w).cast("int"),
    )
    placed = with_features(docs, text_col).select(*columns, "_words", places.alias("_at"))
    logs = []
    for b, w in zip(model.bias, model.weights, strict=True):
        logs.append(_log_likelihood(b, F.array(*[F.lit(x) for x in w])))
    scored = placed.select(*columns, "_words", F.array(*logs).alias("_logs"))
    raised = F.transform("_logs", lambda x: F.exp(x - F.array_max("_logs")))
    scored = scored.select(*columns, "_words", raised.alias("_e"))
    total = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
    return scored.select(
        *columns, "_words", F.transform("_e", lambda x: x / total).alias("_p")
    )


def _step(rate: Column, move: list[float]) -> Column:
    change = sum((F.col("p")[k] * m for k, m in enumerate(move)), F.lit(0.0))
    return F.greatest(rate - change, F.lit(0.0))


@dataclass(frozen=True)
class Fit:
    start: float
    moves: tuple[tuple[float, ...], ...]
    totals: tuple[float, ...]
    targets: tuple[float, ...]


def fit_rates(
    scored: DataFrame,
    weights: list[float],
    budget: float | None = None,
    tolerance: float = TOLERANCE,
    max_steps: int = MAX_STEPS,
) -> Fit:
    """Projected gradient over ``scored`` (n, p); ``weights`` by domain, summing to one."""
    domains = range(len(weights))
    mass = scored.agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col("p")[k]).alias(f"m{k}") for k in domains]
    ).first()
    words = float(mass["n"] or 0)
    m = [float(mass[f"m{k}"] or 0) for k in domains]
    budget = words if budget is None else float(budget)
    targets = [budget * w for w in weights]
    if not words:
        return Fit(0.0, (), tuple(m), tuple(targets))
    start = budget / words
    state = scored.select("n", "p", F.lit(start).alias("r"))
    moves: list[list[float]] = []
    rate, totals, least = F.col("r"), [start * x for x in m], math.inf
    for step in range(max_steps):
        off = [s - t for s, t in zip(totals, targets, strict=True)]
        loss = sum(o * o / x for o, x in zip(off, m, strict=True) if x > 0)
        if max(map(abs, off)) <= tolerance * budget or loss >= least * (1 - LEAST_GAIN):
            break
        least = loss
        move = [o / x if x > 0 else 0.0 for o, x in zip(off, m, strict=True)]
        moves.append(move)
        rate = _step(rate, move)
        if (step + 1) % WRITE_EVERY == 0:
            state = written(state.select("n", "p", rate.alias("r")), "rates")
            rate = F.col("r")
        sums = state.select("n", "p", rate.alias("r")).agg(
            *[F.sum(F.col("n") * F.col("r") * F.col("p")[k]).alias(f"s{k}") for k in domains]
        )
        row = sums.first()
        totals = [float(row[f"s{k}"]) for k in domains]
    return Fit(start, tuple(map(tuple, moves)), tuple(totals), tuple(targets))


def rate_of(p: Column, fitted: Fit) -> Column:
    """The fitted rate of a document with posteriors ``p``: the same steps again."""
    moves = F.array(*[F.array(*[F.lit(x) for x in m]) for m in fitted.moves])
    if not fitted.moves:
        return F.lit(fitted.start)

    def step(rate: Column, move: Column) -> Column:
        change = F.aggregate(
            F.zip_with(p, move, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x
        )
        return F.greatest(rate - change, F.lit(0.0))

    return F.aggregate(moves, F.lit(fitted.start), step)


def _scaled(model: Model, weights: dict[str, float]) -> list[float]:
    own = [max(0.0, weights.get(d, 0.0)) for d in model.domains]
    total = sum(own)
    return [w / total for w in own] if total else [1 / len(own)] * len(own)


def mixed_rates(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float],
    budget: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    whole: bool = False,
) -> tuple[DataFrame, Model, Fit]:
    """Every row's id, n, p and draw (and with ``whole`` the row), written once; the classifier;
    the fitted rates."""
    model = fit(docs, labels, id_col, text_col)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    own = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *([row] if whole else [])
    )
    scored = with_posteriors(own, model, "_text").select(
        F.col("_id").alias("id"),
        F.col("_words").alias("n"),
        F.col("_p").alias("p"),
        _draw(F.col("_id"), F.col("_text")).alias("draw"),
        *(["_row"] if whole else []),
    )
    scored = written(scored, "scored")
    return scored, model, fit_rates(scored, _scaled(model, weights), budget)


def _draw(key: Column, text: Column) -> Column:
    """Even in [0, 1), by hash."""
    return F.pmod(F.xxhash64(key, text, F.lit(7)), F.lit(1 << 30)) / float(1 << 30)


def mixture(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float],
    budget: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_words, rate, copies, and one ``p_<domain>`` for each domain."""
    scored, model, fitted = mixed_rates(docs, labels, weights, budget, id_col, text_col)
    rated = scored.withColumn("rate", rate_of(F.col("p"), fitted))
    return rated.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_words"),
        "rate",
        F.floor(F.col("rate") + F.col("draw")).cast("long").alias("copies"),
        *[F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(model.domains)],
    )


def mixed_documents(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float],
    budget: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, with their own columns."""
    # From the written rows: a filter on copies would carry the classifier with it to the scan.
    scored, _, fitted = mixed_rates(docs, labels, weights, budget, id_col, text_col, whole=True)
    copies = F.floor(rate_of(F.col("p"), fitted) + F.col("draw")).cast("int")
    repeated = scored.select("_row", F.explode(F.array_repeat(F.lit(0), copies)))
    return repeated.select([F.col("_row").getField(c).alias(c) for c in docs.columns])


def quality_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain (toxic, good or poor) of a table of quality and toxic flags."""
    domain = (
        F.when(F.col("toxic") == 1, "toxic")
        .when(F.col("quality") == 1, "good")
        .when(F.col("quality") == 0, "poor")
    )
    return labels.select("doc_id", domain.alias("domain"))
