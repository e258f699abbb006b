import random

import numpy as np
import pytest

from fleetlens.llm import shingle_join as S
from fleetlens.llm.words import U64

from .conftest import some_words


def brute(rows, k=5, num=80, den=100):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    low = [r[0] for r in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if rows[i][0] is not None and rows[j][0] is not None and (rows[i][0] == rows[j][0] or (sets[i] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])))
    ]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            m = min(low[i], low[j])
            changed |= low[i] != m or low[j] != m
            low[i] = low[j] = m
    return sorted(((r[0], len(s), c) for r, s, c in zip(rows, sets, low)), key=repr)


def corpus():
    """Chains of edited copies, a large group round one text, a passage that
    many short texts share, exact copies, and texts of few words."""
    rng = random.Random(11)
    texts = [some_words(rng, rng.randint(1, 120)) for _ in range(60)]
    base = some_words(rng, 150, 5000)
    for _ in range(70):
        own = list(base)
        for _ in range(rng.randint(1, 5)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(9999)}"
        texts.append(own)
    passage = some_words(rng, 40, 5000)
    texts += [some_words(rng, rng.randint(0, 9), 5000) + passage + some_words(rng, rng.randint(0, 9), 5000) for _ in range(60)]
    chain = some_words(rng, 100, 5000)
    for i in range(12):
        chain = chain[4:] + some_words(rng, 4, 5000)
        texts.append(chain)
    texts += [["a", "b"], ["A", "b"], ["b", "a"], ["a", "b", "c", "d"], ["a"], []]
    texts += [list(t) for t in rng.choices(texts, k=30)]
    rng.shuffle(texts)
    return [(i * 3 + 1, (" " if i % 2 else "\n").join(t)) for i, t in enumerate(texts)]


def run(df, **kw):
    return sorted((tuple(r) for r in S.shingle_join(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("lists, frequent", [(128, 4096), (6, 4)])
def test_against_all_pairs(llm, monkeypatch, lists, frequent):
    """The second case sends short lists through blocks and salts shingles."""
    monkeypatch.setattr(S, "LIST_ROWS", lists)
    monkeypatch.setattr(S, "BLOCK_ROWS", 16 if lists < 100 else 1024)
    monkeypatch.setattr(S, "FREQUENT", frequent)
    rows = corpus()
    assert run(llm.createDataFrame(rows, "doc_id long, text string").repartition(7)) == brute(rows)


def test_odd_rows(llm, odd_docs, clash, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = brute(rows)
    assert run(clash) == want
    assert run(no_docs) == []
    kept = S.one_of_each(clash)
    assert kept.columns == clash.columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=repr)
    groups = {c for i, _, c in want if i is not None}
    assert ids == sorted([*groups, None, None], key=repr)


def test_prefix_choice_and_bitmaps():
    counts = np.array([1] * 30 + [500] * 70)
    m, length = S.choose_prefix(counts, 0.0, 80, 100)
    assert length == 100 - 80 + m and m >= 4
    assert S.choose_prefix(np.array([1]), 0.0, 80, 100) == (1, 1)
    rng = np.random.default_rng(0)
    for _ in range(200):
        x = rng.integers(0, 1 << 63, rng.integers(1, 90)).astype(U64)
        y = np.unique(np.concatenate([x[: rng.integers(0, len(x) + 1)], rng.integers(0, 1 << 63, rng.integers(0, 60)).astype(U64)]))
        x = np.unique(x)
        if len(y):
            assert S.overlap_bound(S.bitmap(x), S.bitmap(y), len(x), len(y)) >= len(np.intersect1d(x, y))
