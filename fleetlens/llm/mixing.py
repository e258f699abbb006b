"""Mixing to target weights with soft domain membership.

A classifier, fitted on labelled documents, gives each document a posterior
over domains. Every document gets a nonnegative rate, so that the expected
tokens per domain (rate x tokens x posterior, summed) match targets: a least
squares problem over all documents that is solved by projected gradient. One
step is one aggregation to a number per domain, and a document's rate follows
from its posterior and those numbers, so nothing per document leaves a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import apart, numbered, one_text, stored
from .words import SPACE, U64, each_text

DOMAINS = ("good", "low", "toxic")
#: The classifier is fitted on at most so many labelled documents, those with
#: the smallest hashes of their ids; a documented bound, as is its table.
MOST_LABELLED = 20_000
FEATURE_BITS = 16
#: A word counts if a domain has it this much too often, in so many documents.
LEAST_SCORE, LEAST_HAVE = 5.0, 5
STEPS, RATE, SHRINK = 150, 0.1, 2e-4
#: Bytes that end a word of the classifier: all of ASCII but letters, digits.
BREAKS = SPACE.copy()
BREAKS[:128] = True
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
UPPER, MARKS = np.zeros(256, bool), BREAKS & ~SPACE
UPPER[65:91] = True
MARKS[[*range(0, 32), 127]] = False
#: Least squares: relative change at which it ends, and a safeguard (the report
#: says which it was). So small a change is where documents clearly of one
#: domain have come to a bound, 0 or ``most_rate``. Rates are stored every
#: ``STORE_ROUNDS`` rounds.
TOLERANCE, MOST_ROUNDS, STORE_ROUNDS = 1e-5, 200, 10


# ---------------------------------------------------------------- classifier


def features(word_hashes: np.ndarray, buf: np.ndarray) -> np.ndarray:
    """Cells of a text's distinct words, then four cells for what it is made
    of, in eight steps each: upper-case letters, symbols, the share of distinct
    words, the logarithm of the number of words."""
    step = lambda x: int(min(7, max(0, x)))
    cells = np.unique((word_hashes >> U64(64 - FEATURE_BITS)).astype(np.int64))
    n, words = max(1, len(buf)), max(1, len(word_hashes))
    made = [16 * UPPER[buf].sum() / n, 32 * MARKS[buf].sum() / n, 8 * len(cells) / words, np.log2(words + 1) - 2]
    return np.concatenate([cells, [(1 << FEATURE_BITS) + 8 * i + step(x) for i, x in enumerate(made)]]).astype(np.int32)


N_FEATURES = (1 << FEATURE_BITS) + 32


def telling(at: np.ndarray, label: np.ndarray, domains: np.ndarray) -> np.ndarray:
    """Which features to use: those that some domain has too often to be
    chance (a binomial score above ``LEAST_SCORE``), and the last 32."""
    n = len(domains)
    df = np.bincount(at, minlength=N_FEATURES).astype(float)
    use = np.arange(N_FEATURES) >= 1 << FEATURE_BITS
    for d in range(len(DOMAINS)):
        own = int((domains == d).sum())
        have = np.bincount(at[label == d], minlength=N_FEATURES)
        p = (df + 1) / (n + 2)
        use |= ((have - own * df / n) / np.sqrt(own * p * (1 - p) * (1 - own / n) + 1e-9) > LEAST_SCORE) & (have >= LEAST_HAVE)
    return use & (df > 0)


def fit_classifier(rows: list[np.ndarray], domains: np.ndarray) -> dict[str, np.ndarray]:
    """Softmax regression on the presence of telling features, by Adam on all
    rows at once. Without rows: equal posteriors."""
    k, n = len(DOMAINS), len(rows)
    if not n:
        return {"weights": np.zeros((N_FEATURES, k)), "bias": np.zeros(k)}
    at, doc = np.concatenate(rows), np.repeat(np.arange(n), [len(r) for r in rows])
    use = telling(at, domains[doc], domains)
    at, doc = (np.cumsum(use) - 1)[at[use[at]]], doc[use[at]]
    want = np.eye(k)[domains]
    weights, bias = np.zeros((int(use.sum()), k)), np.log((want.sum(0) + 1) / (n + k))
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        scores = np.stack([np.bincount(doc, weights[at, c], n) for c in range(k)], 1) + bias
        p = np.exp(scores - scores.max(1, keepdims=True))
        gap = p / p.sum(1, keepdims=True) - want
        grad = np.stack([np.bincount(at, gap[doc, c], len(weights)) for c in range(k)], 1) / n + SHRINK * weights
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        weights -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        bias -= RATE * gap.mean(0)
    full = np.zeros((N_FEATURES, k))
    full[use] = weights
    return {"weights": full, "bias": bias}


def posterior(model: dict, row: np.ndarray) -> np.ndarray:
    scores = model["weights"][row].sum(0) + model["bias"]
    p = np.exp(scores - scores.max())
    return p / p.sum()


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and domains of the bounded sample of labelled documents. Of
    several labels of one document the worst counts; nulls are left out."""
    named = numbered(labels, "doc_id", "quality", "toxic")
    labels = named[0].select(*(F.col(c).alias(name) for c, name in zip(named[1], ("doc_id", "quality", "toxic"))))
    each = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    own = each.agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    sample = docs.join(F.broadcast(own.select("doc_id", domain.alias("domain"))), "doc_id").select("doc_id", "domain", F.xxhash64("text").alias("hash"), "text")

    def run(batches):
        for batch in batches:
            cells = [features(h, buf) for buf, h, _, _ in each_text(batch.column("text"), lower=True, breaks=BREAKS)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "domain", "hash")), pa.array(cells, pa.list_(pa.int32()))], names=["doc_id", "domain", "hash", "cells"])

    # Of rows that share an id one counts, so there are as many as ids at most.
    found = sample.mapInArrow(run, "doc_id long, domain int, hash long, cells array<int>")
    got = found.groupBy("doc_id").agg(F.min(F.struct("hash", "domain", "cells")).alias("x")).select("x.domain", "x.cells").toArrow()
    cells = got.column("cells").combine_chunks()
    flat, off = cells.flatten().to_numpy(), np.concatenate([[0], np.cumsum([len(x) for x in cells])]).astype(int)
    rows = [flat[a:b] for a, b in zip(off[:-1], off[1:])]
    domains = got.column("domain").to_numpy()
    order = sorted(range(len(rows)), key=lambda i: (int(domains[i]), rows[i].tobytes()))
    return [rows[i] for i in order], domains[order] if len(rows) else np.empty(0, np.int64)


def with_posteriors(rows: DataFrame, model: dict, keep_text: bool = False) -> DataFrame:
    """Rows with a column ``text`` -> the other columns (the text with
    ``keep_text``), ``n_tokens`` (words) and the posterior of each domain."""
    others = [c for c in rows.columns if keep_text or c != "text"]
    kind = T.StructType([rows.schema[c] for c in others] + [T.StructField("n_tokens", T.LongType()), *(T.StructField(f"p_{d}", T.DoubleType()) for d in DOMAINS)])
    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            n, p = [], []
            for buf, h, _, _ in each_text(batch.column("text"), lower=True, breaks=BREAKS):
                n.append(len(h))
                p.append(posterior(held.value, features(h, buf)))
            p = np.array(p).reshape(-1, len(DOMAINS))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(n, pa.int64()), *(pa.array(p[:, i], pa.float64()) for i in range(len(DOMAINS)))],
                names=[*others, "n_tokens", *(f"p_{d}" for d in DOMAINS)],
            )

    return rows.mapInArrow(run, kind)


# --------------------------------------------------------------------- rates


def _step(rate: Column, gradient: np.ndarray, most_rate: float | None) -> Column:
    """One step from ``rate``: minus the posterior's product with the scaled
    gradient, projected."""
    rate = F.greatest(rate - sum(F.col(f"p_{d}") * float(x) for d, x in zip(DOMAINS, gradient)), F.lit(0.0))
    return rate if most_rate is None else F.least(rate, F.lit(float(most_rate)))


def rate_column(history: list[np.ndarray], most_rate: float | None) -> Column:
    """A document's rate after the steps so far, from 1 on."""
    if not history:
        return F.lit(1.0)
    steps = F.array(*(F.array(*(F.lit(float(x)) for x in g)) for g in history))

    def step(rate, g):
        rate = F.greatest(rate - sum(F.col(f"p_{d}") * g[i] for i, d in enumerate(DOMAINS)), F.lit(0.0))
        return rate if most_rate is None else F.least(rate, F.lit(float(most_rate)))

    return F.aggregate(steps, F.lit(1.0), step)


def fit_rates(rows: DataFrame, weights: dict[str, float], most_rate: float | None = None, budget_domain: str = "good") -> tuple[list[np.ndarray], dict]:
    """(n_tokens, p_*) -> (the steps' gradients, a report with the totals
    before, after and wanted, the rounds and whether they ended by themselves).

    Targets: the domain ``budget_domain`` keeps its expected tokens, the others
    stand to it as ``weights`` say. Least squares weighs each domain by one
    over its present total and each document by its tokens; then a step of
    length one never overshoots, because posteriors sum to one.
    """
    rows = rows.select("n_tokens", *(f"p_{d}" for d in DOMAINS))
    total = lambda rows, rate: rows.agg(*(F.sum(F.col("n_tokens") * F.col(f"p_{d}") * rate).alias(d) for d in DOMAINS)).first()
    vector = lambda row: np.array([float(row[d] or 0.0) for d in DOMAINS])
    present = vector(total(rows, F.lit(1.0)))
    share = np.array([weights.get(d, 0.0) for d in DOMAINS])
    i = DOMAINS.index(budget_domain)
    wanted = share * (present[i] / share[i])
    scale = np.maximum(present, 1e-9 * max(present.sum(), 1.0))
    history: list[np.ndarray] = []
    now, ended, rate = present, not present.sum(), F.lit(1.0)
    while not ended and len(history) < MOST_ROUNDS:
        history.append((now - wanted) / scale)
        rate = _step(rate, history[-1], most_rate)
        if len(history) % STORE_ROUNDS == 0:
            rows, rate = stored(rows.withColumn("rate", rate), "rates"), F.col("rate")
        after = vector(total(rows, rate))
        ended = np.abs(after - now).max() <= TOLERANCE * present.sum()
        now = after
    return history, {"present": present, "wanted": wanted, "reached": now, "rounds": len(history), "converged": bool(ended)}


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float], most_rate: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, labels (doc_id, quality, toxic) -> (doc_id, n_tokens, p_good,
    p_low, p_toxic, domain, rate), one row per input row.

    ``rate`` is how many times a document is to be used on average; ``domain``
    is the likeliest one. A null or empty text has no tokens, and a rate like
    any other text with its posterior; very long texts are taken whole, one at a
    time. Rows with a null id get rates but can't
    be labelled. Repeated rows count each; without usable labels all posteriors
    are equal; an empty table gives no rows. Other columns are ignored.
    """
    docs = one_text(docs, id_col, text_col)
    model = fit_classifier(*labelled_rows(docs, labels))
    rows = stored(with_posteriors(docs, model), "posteriors")
    history, _ = fit_rates(rows, weights, most_rate)
    best = F.greatest(*(F.col(f"p_{d}") for d in DOMAINS))
    domain = F.coalesce(*(F.when(F.col(f"p_{d}") == best, F.lit(d)) for d in DOMAINS))
    return rows.select("doc_id", "n_tokens", *(f"p_{d}" for d in DOMAINS), domain.alias("domain"), rate_column(history, most_rate).alias("rate"))


def draw_column(doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) that depends on the row's id and text alone."""
    return F.pmod(F.xxhash64(F.lit("copies"), doc_id.cast("long"), text.cast("string")), F.lit(1 << 53)) / F.lit(float(1 << 53))


def copies_column(rate: Column, draw: Column) -> Column:
    """Whole copies whose expectation is the rate: its fraction is the chance
    of one more."""
    return F.floor(rate + draw).cast("int")


def resample(docs: DataFrame, labels: DataFrame, weights: dict[str, float], most_rate: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whatever those are called, in
    whole copies drawn by a hash of id and text (see ``copies_column``). Odd
    rows are as in ``mix``; an empty table gives no rows."""
    own = one_text(docs, id_col, text_col)
    model = fit_classifier(*labelled_rows(own, labels))
    history, _ = fit_rates(stored(with_posteriors(own, model).drop("doc_id"), "posteriors"), weights, most_rate)
    rows, as_docs = apart(docs, id_col, text_col)
    rows = rows.select("rest", "text", draw_column(F.col("doc_id"), F.col("text")).alias("draw"))
    rows = with_posteriors(rows, model, keep_text=True).withColumn("copies", copies_column(rate_column(history, most_rate), F.col("draw")))
    rows = rows.where("copies > 0").select("rest", "text", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return as_docs(rows, F.col("text"))
