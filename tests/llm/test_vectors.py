import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import vectors as V


def brute(rows, least=0.9):
    ok = [i is not None and v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(np.asarray(v) != 0) for i, v in rows]
    low = [i for i, _ in rows]
    unit = [np.asarray(v, float) / np.linalg.norm(v) if k else None for (_, v), k in zip(rows, ok)]
    links = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(len(rows)):
            if a != b and ok[a] and ok[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                links[a].append(b)
    changed = True
    while changed:
        changed = False
        for a, own in enumerate(links):
            for b in own:
                if low[b] < low[a]:
                    low[a], changed = low[b], True
    return sorted(((i, len(x), c, i is not None and i == c) for (i, _), x, c in zip(rows, links, low)), key=repr)


def corpus(n=900, dims=24):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(n // 3):
        base = rng.normal(size=dims)
        rows += [base, base + rng.normal(size=dims) * rng.choice([0.05, 0.3, 0.45]), rng.normal(size=dims)]
    hot = rng.normal(size=dims)
    rows += [hot + rng.normal(size=dims) * 0.15 for _ in range(150)] + [hot] * 40
    rows = [np.float32(v).tolist() for v in rows]
    random.Random(1).shuffle(rows)
    return [(i * 2, v) for i, v in enumerate(rows)]


@pytest.mark.parametrize("block", [2048, 40])
def test_against_all_pairs(llm, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK_ROWS", block)
    monkeypatch.setattr(V, "LIST_ROWS", 100)
    rows = corpus()
    got = V.near_vectors(llm.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5))
    want = brute(rows)
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    found, exact = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found >= 0.99 * exact and found <= exact
    assert sum(a == b for a, b in zip(got, want)) >= 0.98 * len(want)


@pytest.fixture(scope="module", params=[16_384, 1000])
def unclustered(llm, request):
    """Two hundred lists without clusters; near pairs, many across two lists."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(2000, 64))
    near = base + rng.normal(size=base.shape) * rng.choice([0.42, 0.46], size=(2000, 1))
    x = rng.permutation(np.concatenate([base, near])).astype(np.float32)
    u = V.unit(x)
    pairs = [(a, b) for a, b in zip(*np.nonzero(u @ u.T >= 0.9)) if a != b]
    with pytest.MonkeyPatch.context() as patch:
        for name, value in (("BLOCK_ROWS", request.param), ("LIST_ROWS", 20), ("MOST_SAMPLE", 1600)):
            patch.setattr(V, name, value)
        df = llm.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
        return pairs, {r.vec_id: r for r in V.near_vectors(df).collect()}


def test_many_lists_lose_no_pair(unclustered):
    pairs, got = unclustered
    assert len(pairs) > 2000
    assert [p for p in pairs if got[p[0]].component_id != got[p[1]].component_id] == []


def test_links_count_at_both_ends(unclustered):
    pairs, got = unclustered
    want = np.bincount([a for a, _ in pairs], minlength=len(got))
    assert [got[i].n_links for i in range(len(got))] == want.tolist()


def test_probes_reach_the_recall_asked_for(llm):
    """Two hundred lists without clusters, the hardest case: many pairs lie
    just over the threshold, across lists. Far fewer lists are probed, and the
    share found is what was asked for; both ends of each link count."""
    rng = np.random.default_rng(14)
    base = rng.normal(size=(2000, 64))
    x = V.unit(rng.permutation(np.concatenate([base, base + rng.normal(size=base.shape) * rng.choice([0.3, 0.46], size=(2000, 1))])).astype(np.float32))
    pairs = [(a, b) for a, b in zip(*np.nonzero(x @ x.T >= 0.9)) if a < b]
    index = V.Index(x[:1600], 256 * 200)
    own = index.list_of(x)
    gap = np.sqrt(((x - index.lists[own]) ** 2).sum(1))
    ends = [np.array([f(gap[own == c]) if (own == c).any() else e for c in range(len(index.lists))]) for f, e in ((np.min, np.inf), (np.max, -np.inf))]
    everything = index.reached(x, V.reach_of(0.9), *ends)
    for recall in (0.95, 0.99):
        probed = index.reached(x, V.reach_of(0.9), *ends, index.margin(x[1600:2400], 0.9, recall))
        met = np.mean([probed[a, own[b]] and probed[b, own[a]] for a, b in pairs])
        assert met >= recall - 0.01 and probed.mean() < 0.35 < everything.mean()
    with pytest.MonkeyPatch.context() as patch:
        for name, value in (("LIST_ROWS", 20), ("MOST_SAMPLE", 1600), ("BLOCK_ROWS", 300)):
            patch.setattr(V, name, value)
        df = llm.createDataFrame([(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))], "vec_id long, embedding array<float>")
        got = {r.vec_id: r for r in V.near_vectors(df, recall=0.99).collect()}
    want = np.bincount(np.array(pairs).ravel(), minlength=len(x))
    links = np.array([got[i].n_links for i in range(len(x))])
    assert (links <= want).all() and links.sum() >= 0.98 * want.sum()
    assert np.mean([got[a].component_id == got[b].component_id for a, b in pairs]) >= 0.98


def test_lists_left_out_hold_no_near_vector():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16)) * 3
    x = V.unit(np.concatenate([c + rng.normal(size=(30, 16)) for c in centres]))
    index = V.Index(x, V.LIST_ROWS * 40)
    own = index.list_of(x)
    gap = np.sqrt(((x - index.lists[own]) ** 2).sum(1))
    inner, outer = (np.array([f(gap[own == c]) if (own == c).any() else e for c in range(len(index.lists))]) for f, e in ((np.min, np.inf), (np.max, -np.inf)))
    reached = index.reached(x, V.reach_of(0.95), inner, outer)
    assert reached.mean() < 0.9
    a, b = np.nonzero(x @ x.T >= 0.95)
    assert reached[a, own[b]].all()


def test_table_distance_drops_no_near_pair():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 20))
    x = np.concatenate([x, x + rng.normal(size=x.shape) * 0.2])
    index = V.Index(x, 1200)
    u = V.unit(x)
    own = index.list_of(u)
    codes, error = index.code(u, own)
    for c in range(len(index.lists)):
        at = own == c
        near = index.table_distances(u, c, codes[at]) <= np.sqrt(0.2) + 1e-9 + error[at]
        assert not ((u @ u[at].T >= 0.9) & ~near).any()


def test_odd_rows(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [1.0, -0.0]), (9, [2.0, 0.0]), (9, [2.0, 0.0]), (None, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [1.0, 0.1, 0.0]), (12, [-1.0, 0.0])]
    for kind in ("float", "double"):
        df = llm.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({c: F.lit("clash") for c in "v raw node copies list codes label links component".split()})
        assert sorted((tuple(r) for r in V.near_vectors(df).collect()), key=repr) == brute(rows)
        assert V.near_vectors(df.limit(0)).collect() == []
