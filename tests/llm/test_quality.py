import random

import numpy as np
import pyarrow as pa
import pytest

from fleetlens.llm import quality as Q
from fleetlens.llm.textstats import text_counts

from .conftest import DOC_SCHEMA, some_words


def corpus():
    rng = random.Random(8)
    rows = []
    for i in range(900):
        lang, source = rng.choice(["de", "en"]), rng.choice(["s1", "s1", "s1", "s2", "rare", None])
        w = some_words(rng, rng.randint(55, 300), 3000)
        if i % 9 == 0:
            w = [x + rng.choice("*%&$") * 3 for x in w]
        if i % 50 == 1:
            w = w[:20]
        rows.append((i, " ".join(w), lang, source, 0))
    return rows


def brute(rows):
    """The same estimate from whole arrays in memory."""
    counts = text_counts(pa.array([r[1] for r in rows]))
    n = np.array(counts["n_words"], float)
    words = np.maximum(n, 1)
    x = np.stack([np.log1p(n), np.log(np.maximum(counts["word_chars"], 1) / words), np.array(counts["n_symbols"]) / words, np.log1p(counts["n_dup_lines"]), np.array(counts["n_repeat_words"]) / words], 1)
    x = np.floor(x * Q.UNIT + 0.5)
    has = n > 0
    own = [(r[2], r[3]) for r in rows]
    members = {k: [h and (len(k) == 0 or o[: len(k)] == k) for o, h in zip(own, has)] for k in {(), *own, *((o[0],) for o in own)}}
    finals = {}

    def sums(v):
        return np.concatenate([[len(v)], v.sum(0), [(v[:, i] * v[:, j]).sum() for i, j in Q.PAIRS]])

    out = [None] * len(rows)
    for key, at in members.items():
        v = x[at]
        if not len(v) or has.sum() < Q.LEAST_EVERY:
            continue
        best = None
        hist = [(d, c, m) for d in range(Q.DIMS) for c, m in zip(*np.unique(v[:, d] // 64, return_counts=True))]

        def step(state):
            d2 = Q.squared_distance(v.T, state["mean"], state["inverse"])
            cell = np.minimum(np.floor((np.log2(np.maximum(d2, 2.0**Q.LOW_OCTAVE)) - Q.LOW_OCTAVE) * Q.PER_OCTAVE), Q.CELLS - 1)
            limit = np.sort(cell)[(len(v) + Q.DIMS + 1) // 2 - 1]
            s = sums(v[cell <= limit])
            return Q.estimate(*Q.moments(s)), s

        for start in (Q.median_start(*(np.array([h[i] for h in hist], np.int64) for i in range(3))), Q.estimate(*Q.moments(sums(v)))):
            first, _ = step(start)
            second, s = step(first)
            if best is None or second["logdet"] < best[0]["logdet"]:
                best = second, s, first["logdet"] - second["logdet"] < Q.TOLERANCE
        state, s, done = best
        while not done:
            new, s = step(state)
            done, state = state["logdet"] - new["logdet"] < Q.TOLERANCE, new
        raw = Q.estimate(*Q.moments(s), scale=Q.consistency(s[0] / len(v)))
        near = v[Q.squared_distance(v.T, raw["mean"], raw["inverse"]) <= Q.chi2_quantile(Q.REWEIGHT, Q.DIMS)]
        mean, cov = Q.moments(sums(near))
        finals[key] = len(v), mean, cov * Q.consistency(Q.REWEIGHT)
    for i, k in enumerate(own):
        if has[i] and finals:
            # Each level with ten rows a dimension of the one above it.
            mean, cov = finals[()][1:]
            for level in (k[:1], k):
                n, m, c = finals[level]
                gap, many = np.outer(m - mean, m - mean), max(0, n - 25)
                cov = (many * c + 50 * cov) / (many + 50) + many * 50 * gap / (many + 50) ** 2
                mean = (n * m + 50 * mean) / (n + 50)
            d = x[i] / Q.UNIT - mean
            out[i] = float(np.sqrt(d @ np.linalg.inv(cov + np.diag(Q.FLOOR**2)) @ d))
    base = [(c < 50) or 100 * r > 50 * c for c, r in zip(counts["n_words"], counts["n_repeat_words"])]
    return [(r[0], *(counts[c][i] for c in Q.COUNTS), base[i], out[i], not base[i] and (out[i] is None or out[i] <= Q.MOST_DISTANCE)) for i, r in enumerate(rows)]


@pytest.fixture(scope="module")
def judged(llm):
    rows = corpus()
    got = Q.quality_rules(llm.createDataFrame(rows, DOC_SCHEMA).repartition(6)).collect()
    return rows, sorted(tuple(r) for r in got)


def test_against_whole_arrays(judged):
    rows, got = judged
    for a, b in zip(got, sorted(brute(rows))):
        assert a[:7] == b[:7] and a[8] == b[8]
        assert (a[7] is None) == (b[7] is None) and (a[7] is None or a[7] == pytest.approx(b[7], rel=1e-6))


def test_rejects_symbols_and_keeps_the_rest(judged):
    rows, got = judged
    for r in got:
        if not r[6]:
            assert r[8] == (r[0] % 9 != 0), r


def test_odd_rows(llm, odd_docs, clash, no_docs):
    rows = [tuple(r) for r in odd_docs.collect()]
    got = sorted((tuple(r) for r in Q.quality_rules(clash).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)
    assert Q.quality_rules(no_docs).collect() == []
    kept = Q.keep_good(clash)
    assert kept.columns == clash.columns
    assert sorted((r.text for r in kept.collect()), key=repr) == sorted((r[1] for r, g in zip(rows, brute(rows)) if g[8]), key=repr)


def test_small_tables_are_left_to_the_base_rules(llm):
    for n, judged in ((Q.LEAST_EVERY - 1, False), (Q.LEAST_EVERY, True)):
        got = Q.quality_rules(llm.createDataFrame([r for r in corpus() if len(r[1].split()) >= 50][:n], DOC_SCHEMA)).collect()
        assert len(got) == n and all((r.distance is not None) == judged for r in got)
        assert judged or all(r.kept == (not r.base_failed) for r in got)


def test_each_group_has_an_estimate(llm):
    """A group of 30 rows is judged by its own kind, not by its language."""
    rng = random.Random(4)
    text = lambda marks: " ".join(w + ("*" if rng.random() < marks else "") for w in some_words(rng, rng.randint(80, 200), 3000))
    rows = [(i, text(0.0), "en", "plain", 0) for i in range(400)] + [(1000 + i, text(0.3), "en", "starred", 0) for i in range(30)] + [(2000 + i, text(0.3), "en", "plain", 0) for i in range(5)]
    got = {r.doc_id: r.kept for r in Q.quality_rules(llm.createDataFrame(rows, DOC_SCHEMA)).collect()}
    assert all(got[r[0]] == (r[0] < 2000) for r in rows)


def test_small_languages_are_judged_by_all_rows(llm):
    """No language has rows enough; and one has, beside small ones, a null
    language included."""
    rows = [r[:2] + (["de", "fr", "es", None, "misspelt"][r[0] % 5 if r[0] < 45 else 0],) + r[3:] for r in corpus()]
    for some in (rows[:150], rows):
        got = Q.quality_rules(llm.createDataFrame(some, DOC_SCHEMA)).collect()
        assert len(got) == len(some)
        for r in got:
            assert r.distance is not None
            if not r.base_failed:
                assert r.kept == (r.doc_id % 9 != 0), r


def test_chi_square():
    assert Q.chi2_cdf(11.0705, 5) == pytest.approx(0.95, abs=1e-5)
    assert Q.chi2_quantile(0.975, 5) == pytest.approx(12.8325, abs=1e-3)
    assert Q.consistency(1.0) == 1.0 and Q.consistency(0.5) > 1.5
