"""Quality rules by robust multivariate outliers.

Each text gives a vector of transformed statistics. For every language and
source the minimum-covariance-determinant estimate of location and scatter is
found over all its rows, and a text is rejected when its Mahalanobis distance
from that estimate is too large. An estimate from few rows says little, so each
is drawn towards that of its language, and a language's towards that of all
rows, the more the fewer rows it has: one formula at every size.

The estimate comes from concentration steps: take the half of the rows that is
nearest by the present estimate, estimate anew from it, repeat until the
determinant stops falling. Here one step is one aggregation: rows are counted and summed per
group and per cell of (logarithmic) distance, and the cells that make up the
nearest half are added up. A group's rows never meet, only its cells do (at
most ``CELLS`` per group); a source with a third of all rows is combined
map-side. Vectors are fixed-point integers, so sums are exact and the estimate
does not depend on how rows are partitioned or which task ran twice.
"""

from __future__ import annotations

import logging
import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import apart, stored
from .textstats import COUNTS, text_counts

log = logging.getLogger(__name__)

#: Fixed-point steps of a vector's components.
UNIT = 4096
DIMS = 5
#: The scatter of each component is at least this (log words, log mean word
#: length, symbols per word, log repeated lines, share of repeated words): most
#: texts have no symbol and no repeated line, and one of either is no reason.
FLOOR = np.array([0.30, 0.06, 0.02, 0.35, 0.06])
#: Every group has an estimate of its own, drawn towards its language's as if
#: that were so many rows of it, and a language's towards that of all rows.
PRIOR_ROWS = 10 * DIMS
#: Rows (five a dimension) below which the nearest half can't outvote outliers:
#: only those beyond count for a group's own scatter, and a table of fewer
#: allows no estimate.
LEAST_EVERY = 5 * DIMS
#: Key of the estimate over all rows; no language's key looks like it.
EVERY = "every"
#: Mahalanobis distance beyond which a text is rejected.
MOST_DISTANCE = 8.0
#: Cells of log2 squared distance: 16 an octave over 2**-20 to 2**40.
PER_OCTAVE, LOW_OCTAVE, HIGH_OCTAVE = 16, -20, 40
CELLS = PER_OCTAVE * (HIGH_OCTAVE - LOW_OCTAVE)
#: Both starts take so many concentration steps; the one with the smaller
#: determinant goes on until a step lowers its logarithm by less than this.
#: Determinants never rise, so that ends; the bound is a safeguard.
TRIAL_STEPS, TOLERANCE, MOST_STEPS = 2, 1e-3, 40
#: Groups per task where only a row or a list of cells per group is left.
GROUPS_PER_TASK = 64

PAIRS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
X = [f"x{i}" for i in range(DIMS)]
STATE = "key string, start int, n long, used long, sums array<double>, mean array<double>, inverse array<double>, logdet double, done boolean"


# -------------------------------------------------------- statistics of texts


def with_counts(rows: DataFrame, keep_text: bool = False) -> DataFrame:
    """Rows with a column ``text`` -> the other columns (the text with
    ``keep_text``) and the counts of the text (see ``textstats``); a null text
    counts as empty."""
    held = [c for c in rows.columns if keep_text or c != "text"]
    kind = T.StructType([rows.schema[c] for c in held] + [T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches):
        for batch in batches:
            counts = text_counts(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in held] + [pa.array(counts[c], pa.int64()) for c in COUNTS], names=[*held, *COUNTS])

    return rows.mapInArrow(run, kind)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def with_vector(rows: DataFrame) -> DataFrame:
    """Adds the fixed-point vector ``x0..x4`` and the group keys: ``own`` for
    language and source, ``wide`` for the language. Nulls are a value of their
    own there."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    parts = [
        F.log1p(F.col("n_words")),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        F.least(F.col("n_symbols") / words, F.lit(15.0)),
        F.log1p(F.col("n_dup_lines")),
        F.col("n_repeat_words") / words,
    ]
    rows = rows.withColumns({x: F.round(p * UNIT).cast("long") for x, p in zip(X, parts)})
    text = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    return rows.withColumn("wide", F.concat(F.length(text("lang")).cast("string"), F.lit(":"), text("lang"))).withColumn("own", F.concat("wide", F.lit("/"), text("source")))


# ----------------------------------------------------------------- estimates


def chi2_cdf(x: float, k: int) -> float:
    """Distribution function of chi-square with an odd number of degrees."""
    p = math.erf(math.sqrt(x / 2))
    for d in range(3, k + 1, 2):
        p -= (x / 2) ** (d / 2 - 1) * math.exp(-x / 2) / math.gamma(d / 2)
    return p


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return (lo + hi) / 2


def consistency(share: float) -> float:
    """What the scatter of the nearest ``share`` of normal rows is scaled by."""
    if share >= 1:
        return 1.0
    return share / chi2_cdf(chi2_quantile(share, DIMS), DIMS + 2)


#: Rows within this squared distance make the final, reweighted estimate.
REWEIGHT = 0.975


def moments(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance from (count, sums, sums of products)."""
    n, s, q = sums[0], sums[1 : 1 + DIMS], sums[1 + DIMS :]
    mean = s / n
    cov = np.empty((DIMS, DIMS))
    for (i, j), v in zip(PAIRS, q):
        cov[i, j] = cov[j, i] = v / n - mean[i] * mean[j]
    return mean / UNIT, cov / UNIT**2


def estimate(mean: np.ndarray, cov: np.ndarray, scale: float = 1.0) -> dict:
    cov = scale * cov + np.diag(FLOOR**2)
    inverse = np.linalg.inv(cov)
    return {"mean": mean.tolist(), "inverse": [float(inverse[i, j]) for i, j in PAIRS], "logdet": float(np.linalg.slogdet(cov)[1])}


def squared_distance(x, mean, inverse):
    """Works on columns and on arrays; x0..x4 in fixed point."""
    d = [x[i] / float(UNIT) - mean[i] for i in range(DIMS)]
    total = None
    for p, (i, j) in enumerate(PAIRS):
        term = d[i] * d[j] * inverse[p] * (1.0 if i == j else 2.0)
        total = term if total is None else total + term
    return total


def _distance_column() -> Column:
    return squared_distance([F.col(x) for x in X], [F.col("mean")[i] for i in range(DIMS)], [F.col("inverse")[p] for p in range(len(PAIRS))])


def _sums() -> list[Column]:
    return [F.count("*").alias("s0")] + [F.sum(x).alias(f"s{1 + i}") for i, x in enumerate(X)] + [
        F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{1 + DIMS + p}") for p, (i, j) in enumerate(PAIRS)
    ]


N_SUMS = 1 + DIMS + len(PAIRS)


def _step(rows: DataFrame, state: DataFrame, tasks: int) -> DataFrame:
    """One concentration step for the keys and starts of ``state``: per key and
    start, the sums of each distance cell as a bounded list, then the new
    estimate."""
    octave = F.log2(F.greatest(_distance_column(), F.lit(2.0**LOW_OCTAVE)))
    cell = F.least(F.floor((octave - LOW_OCTAVE) * PER_OCTAVE), F.lit(CELLS - 1)).cast("int")
    near = rows.join(state.select("key", "start", "mean", "inverse", F.col("logdet").alias("before")), "key").withColumn("cell", cell)
    by_cell = near.groupBy("key", "start", "cell").agg(*_sums(), F.max("before").alias("before"))
    listed = by_cell.groupBy("key", "start").agg(F.collect_list(F.struct("cell", F.array(*(F.col(f"s{i}") for i in range(N_SUMS))).alias("s"))).alias("cells"), F.max("before").alias("before"))
    return stored(listed.coalesce(tasks).mapInPandas(_concentrate, STATE), "state")


def nearest_half(cells: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Sums over the nearest cells that hold at least (n + p + 1) / 2 rows;
    the rows of a cell go in together."""
    order = np.argsort(cells)
    count = np.cumsum(sums[order, 0])
    h = min((int(count[-1]) + DIMS + 1) // 2, int(count[-1]))
    last = int(np.searchsorted(count, h))
    return sums[order[: last + 1]].sum(axis=0)


def _concentrate(batches):
    for pdf in batches:
        out = []
        for key, start, cells, before in zip(pdf["key"], pdf["start"], pdf["cells"], pdf["before"]):
            sums = np.array([list(c["s"]) for c in cells], np.float64)
            own = nearest_half(np.array([c["cell"] for c in cells]), sums)
            n = int(sums[:, 0].sum())
            new = estimate(*moments(own))
            out.append({"key": key, "start": start, "n": n, "used": int(own[0]), "sums": own.tolist(), **new, "done": before - new["logdet"] < TOLERANCE})
        yield pd.DataFrame(out, columns=[c.split()[0] for c in STATE.split(", ")])


def median_start(dims: np.ndarray, cells: np.ndarray, counts: np.ndarray) -> dict:
    """From per-component histograms of x // 64: medians and MADs."""
    mean, sd = np.zeros(DIMS), np.zeros(DIMS)
    for d in range(DIMS):
        own = dims == d
        at, n = (cells[own] * 64 + 32) / UNIT, counts[own]

        def middle(v):
            o = np.argsort(v)
            c = np.cumsum(n[o])
            return v[o][np.searchsorted(c, (c[-1] + 1) // 2)]

        mean[d] = middle(at)
        sd[d] = 1.4826 * middle(np.abs(at - mean[d]))
    return estimate(mean, np.diag(sd**2))


def _starts(batches):
    for pdf in batches:
        out = []
        for key, hist, sums in zip(pdf["key"], pdf["hist"], pdf["sums"]):
            n = int(sums[0])
            dims, cells, counts = (np.array([h[i] for h in hist], np.int64) for i in ("d", "c", "n"))
            both = [median_start(dims, cells, counts), estimate(*moments(np.asarray(sums, np.float64)))]
            out += [{"key": key, "start": i, "n": n, "used": n, "sums": [], **e, "logdet": math.inf, "done": False} for i, e in enumerate(both)]
        yield pd.DataFrame(out, columns=[c.split()[0] for c in STATE.split(", ")])


def _final(share_of):
    def run(batches):
        for pdf in batches:
            out = []
            for key, n, sums in zip(pdf["key"], pdf["n"], pdf["sums"]):
                own = np.asarray(sums, np.float64)
                out.append({"key": key, "start": 0, "n": int(n), "used": int(own[0]), "sums": own.tolist(), **estimate(*moments(own), scale=consistency(share_of(own[0] / n))), "done": True})
            yield pd.DataFrame(out, columns=[c.split()[0] for c in STATE.split(", ")])

    return run


def drawn(n: float, mean: np.ndarray, cov: np.ndarray, to_mean: np.ndarray, to_cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of ``n`` rows together with ``PRIOR_ROWS`` rows of
    another estimate. A few rows can move the mean a little; their scatter
    counts only as far as they are more than ``LEAST_EVERY``."""
    w, many = n / (n + PRIOR_ROWS), max(0.0, n - LEAST_EVERY)
    v = many / (many + PRIOR_ROWS)
    gap = mean - to_mean
    return w * mean + (1 - w) * to_mean, v * cov + (1 - v) * to_cov + v * (1 - v) * np.outer(gap, gap)


def _drawn(every):
    def run(batches):
        scale = consistency(REWEIGHT)
        of = lambda sums: (lambda m, c: (m, scale * c))(*moments(np.asarray(sums, np.float64)))
        for pdf in batches:
            out = []
            for key, n, sums, wide_n, wide_sums in zip(pdf["key"], pdf["n"], pdf["sums"], pdf["wide_n"], pdf["wide_sums"]):
                wide = drawn(wide_n, *of(wide_sums), *of(every))
                e = estimate(*drawn(n, *of(sums), *wide))
                out.append({"key": key, "mean": e["mean"], "inverse": e["inverse"]})
            yield pd.DataFrame(out, columns=["key", "mean", "inverse"])

    return run


def fit(rows: DataFrame) -> DataFrame | None:
    """Rows with vectors and keys -> the estimate (key, mean, inverse) of each
    language and source, each drawn towards its language's and that of all rows
    (``drawn``). Texts without words have no vector. None where fewer than
    ``LEAST_EVERY`` have one."""
    rows = rows.where("n_words > 0").select("own", "wide", *X)
    groups = stored(rows.groupBy("own", "wide").agg(F.count("*").alias("n")), "groups")
    if (groups.agg(F.sum("n")).first()[0] or 0) < LEAST_EVERY:
        return None
    rows = stored(rows.select(F.explode(F.array("own", "wide", F.lit(EVERY))).alias("key"), *X), "vectors")
    hist = rows.select("key", F.posexplode(F.array(*X)).alias("d", "x")).groupBy("key", "d", F.floor(F.col("x") / 64).cast("long").alias("c")).agg(F.count("*").alias("n"))
    hist = hist.groupBy("key").agg(F.collect_list(F.struct("d", "c", "n")).alias("hist"))
    sums = rows.groupBy("key").agg(*_sums()).select("key", F.array(*(F.col(f"s{i}") for i in range(N_SUMS))).alias("sums"))
    tasks = -(-3 * groups.count() // GROUPS_PER_TASK)
    state = stored(hist.join(sums, "key").coalesce(tasks).mapInPandas(_starts, STATE), "state")
    for _ in range(TRIAL_STEPS):
        state = _step(rows, state, tasks)
    best = F.min_by(F.struct(*(F.col(c) for c in state.columns if c != "key")), F.struct("logdet", "start"))
    state = stored(state.groupBy("key").agg(best.alias("b")).select("key", "b.*").coalesce(tasks), "state")
    ended = [state.where("done")]
    for _ in range(MOST_STEPS):
        state = state.where("not done")
        if state.isEmpty():
            break
        state = _step(rows, state, tasks)
        ended.append(state.where("done"))
    else:
        log.warning("%d groups were still concentrating after %d steps", state.where("not done").count(), MOST_STEPS)
        ended.append(state.where("not done"))
    best = reduce(DataFrame.unionByName, ended).select("key", "n", "sums")
    raw = stored(best.coalesce(tasks).mapInPandas(_final(lambda share: share), STATE), "state")
    limit = chi2_quantile(REWEIGHT, DIMS)
    near = rows.join(raw.select("key", "n", "mean", "inverse"), "key").where(_distance_column() <= limit)
    again = near.groupBy("key").agg(F.first("n").alias("n"), *_sums()).select("key", "n", F.array(*(F.col(f"s{i}").cast("double") for i in range(N_SUMS))).alias("sums"))
    again = stored(again.coalesce(tasks), "sums")
    every = again.where(F.col("key") == EVERY).first().sums
    wide = again.select(F.col("key").alias("wide"), F.col("n").alias("wide_n"), F.col("sums").alias("wide_sums"))
    each = groups.select(F.col("own").alias("key"), "wide").join(again, "key").join(wide, "wide").select("key", "n", "sums", "wide_n", "wide_sums")
    return stored(each.coalesce(tasks).mapInPandas(_drawn(every), "key string, mean array<double>, inverse array<double>"), "estimates")


def judge(rows: DataFrame, estimates: DataFrame | None) -> DataFrame:
    """Rows with vectors and keys -> all their columns with ``base_failed``,
    ``distance`` (null without words or estimates) and ``kept``."""
    if estimates is None:
        rows = rows.withColumn("distance", F.lit(None).cast("double"))
    else:
        rows = rows.join(estimates.select(F.col("key").alias("own"), F.struct("mean", "inverse").alias("e")), "own", "left")
        d2 = squared_distance([F.col(x) for x in X], [F.col("e.mean")[i] for i in range(DIMS)], [F.col("e.inverse")[p] for p in range(len(PAIRS))])
        rows = rows.withColumn("distance", F.when(F.col("n_words") > 0, F.sqrt(d2))).drop("e")
    rows = rows.withColumn("base_failed", base_failed())
    return rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= MOST_DISTANCE, F.lit(True)))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """docs -> (doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, distance, kept), one row per input row.

    A null text has no words and fails the base rules. Null languages and
    sources are groups like any other. A group of any size has an estimate of
    its own, drawn towards its language's (see ``fit``); a table of fewer than
    ``LEAST_EVERY`` rows with words is left to the base rules. Repeated rows
    count each; ties in distance go in together; very long texts are taken
    whole; an empty table gives no rows. Other columns are ignored.
    """
    rows = apart(docs, id_col, text_col, lang=lang_col, source=source_col)[0].select("doc_id", "lang", "source", "text")
    rows = stored(with_vector(with_counts(rows)), "counts")
    return judge(rows, fit(rows)).select("doc_id", *COUNTS, "base_failed", "distance", "kept")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of docs that ``quality_rules`` keeps, with all their columns,
    whatever those are called. Odd rows are judged as there; an empty table
    gives no rows. The texts are counted again rather than stored or
    shuffled."""
    rows, as_docs = apart(docs, id_col, text_col, lang=lang_col, source=source_col)
    estimates = fit(stored(with_vector(with_counts(rows.select("lang", "source", "text"))), "counts"))
    rows = with_vector(with_counts(rows.select("rest", "lang", "source", "text"), keep_text=True))
    return as_docs(judge(rows, estimates).where("kept"), F.col("text"))
