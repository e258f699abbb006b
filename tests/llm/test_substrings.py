import hashlib
import random

import numpy as np
import pytest

from fleetlens.llm import substrings as S

from .conftest import some_words


def brute(rows, span):
    words = [(r[1] or "").encode().split() for r in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for j in range(len(w) - span + 1):
            k = tuple(w[j : j + span])
            if i is not None and i < first.get(k, 1 << 62):
                first[k] = i
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for j in range(len(w) - span + 1):
            if i is not None and first[tuple(w[j : j + span])] < i:
                gone[j : j + span] = [True] * span
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def run(df, **kw):
    return sorted((tuple(r) for r in S.remove_repeats(df, **kw).collect()), key=repr)


def corpus():
    rng = random.Random(2)
    passages = [some_words(rng, n, 3000) for n in (49, 50, 51, 75, 200)]
    rows = []
    for i in range(120):
        own = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, 10)
            own += some_words(rng, rng.randint(0, 40), 3000) + p[a : len(p) - rng.randint(0, 10)]
        rows.append((rng.randrange(10_000), (" " if i % 3 else "\n").join(own)))
    rows.append((20_000, " ".join(["x"] * 200)))
    rows.append((20_001, " ".join(["x"] * 120)))
    return rows


@pytest.mark.parametrize("span, contents", [(50, 2000), (50, 3)])
def test_against_brute_force(llm, monkeypatch, span, contents):
    monkeypatch.setattr(S, "BLOCK_CONTENTS", contents)
    rows = list({r[0]: r for r in corpus()}.values())
    assert run(llm.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows, span)


def test_odd_rows(llm, odd_docs, clash, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert run(clash) == brute(rows, 50)
    assert run(no_docs) == []
    cut = S.without_repeats(clash)
    assert cut.columns == clash.columns
    left = sorted(hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest() for r in cut.collect())
    assert left == sorted(r[3] for r in brute(rows, 50))
    assert [r for r in cut.where("doc_id = 10").collect()][0].text == rows[-1][1]


def test_factors():
    starts, sources = np.array([7, 3, 4, 5, 20]), np.array([2, 1, 1, 2, 9])
    assert S.factors_of(starts, sources, 50) == [(3, 51, 1), (5, 50, 2), (7, 50, 2), (20, 50, 9)]
    assert S.covered([(1, 2, 0)], 4).tolist() == [False, True, True, False]
    assert S.factors_of(np.empty(0, int), np.empty(0, int)) == []


def _w(text):
    return [x.encode().ljust(S.WINDOW.itemsize) for x in text]


def test_a_factor_goes_as_far_as_the_reference():
    block = S.Block()
    block.add(1, _w("abcdef"))
    block.add(2, _w("xcdeyz"))
    assert block.parse(_w("bcdq")) == [(0, 3, 1)]
    assert block.parse(_w("qq")) == []
    assert block.parse(_w("qyz")) == [(1, 2, 2)]


def test_windows_across_the_end_of_a_factor_are_looked_up():
    """Two factors meet, and the window across their boundary is in a third
    document. A parse that went on behind the whole factor would not see it."""
    block = S.Block()
    block.add(1, _w("abc"))
    block.add(2, _w("efg"))
    block.add(3, _w("d"))
    assert block.parse(_w("abcdefg")) == [(0, 3, 1), (3, 1, 3), (4, 3, 2)]


def test_a_text_made_of_two_references_and_their_seam(llm):
    """Documents 1 and 2 hold the halves, document 3 the 50 words in the middle:
    document 4 goes as a whole, since its seam is looked up too."""
    rng = random.Random(6)
    left, right = some_words(rng, 60, 5000), some_words(rng, 60, 5000)
    seam = left[-30:] + right[:30]
    rows = [(1, " ".join(left + ["x"] * 3)), (2, " ".join(["y"] * 3 + right)), (3, " ".join(["z", *seam, "z"])), (4, " ".join(left + right))]
    got = run(llm.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows, 50)
    assert [r[2] for r in got] == [0, 0, 0, 120]


def test_parts_of_a_block_find_the_same():
    rng = random.Random(8)
    passages = [[bytes([rng.randrange(256)]) + rng.randbytes(3) for _ in range(3)] for _ in range(20)]
    texts = [[w for p in rng.choices(passages, k=3) for w in p] for _ in range(60)]
    found = []
    for parts in (1, 4):
        covered = [set() for _ in texts]
        for part in range(parts):
            block = S.Block(part, parts)
            for i, t in enumerate(texts):
                covered[i] |= {a + j for a, m, _ in block.parse(t) for j in range(m)}
                block.add(i, t)
        found.append(covered)
    assert found[0] == found[1]
