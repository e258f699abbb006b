import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fleetlens.llm import bloom, words
from fleetlens.llm.components import components, spanning_forest
from fleetlens.llm.textstats import text_counts

from .conftest import odd_rows, some_words


def texts():
    rng = random.Random(1)
    out = [r[1] for r in odd_rows()] + [" ".join(some_words(rng, rng.randrange(200))) for _ in range(50)]
    return out + ["a" * 700_000, "\n".join(["line one", "line two", "line one", " ", " "]), "x y z x y z", "a a a a"]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_are_runs_without_ascii_space(kind):
    seen: dict[int, bytes] = {}
    for text, (buf, h, start, end) in zip(texts(), words.each_text(pa.array(texts(), kind), lower=True)):
        want = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
        raw = buf.tobytes().lower()
        assert [raw[a:b] for a, b in zip(start, end)] == want
        for x, w in zip(h.tolist(), want):
            assert seen.setdefault(x, w) == w
    assert len(set(seen.values())) == len(seen)


def test_sliced_array_and_rolling_hash():
    a = pa.array(["p q", None, "a b c a b c a b", ""]).slice(1)
    got = [h for _, h, _, _ in words.each_text(a)]
    assert [len(h) for h in got] == [0, 8, 0]
    runs = words.rolling(got[1], 3)
    assert runs[0] == runs[3] and runs[1] == runs[4] and len(set(runs.tolist())) == 3
    assert len(words.shingle_set(got[1], 5)) == 3 + 1 - 0 or len(words.shingle_set(got[1], 5)) == 3
    assert len(words.shingle_set(got[1][:3], 5)) == 1 and len(words.shingle_set(got[0], 5)) == 0


def test_counts_against_plain_python():
    own = texts()
    got = text_counts(pa.array(own))
    for i, text in enumerate(own):
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        grams = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
        many = {g for g in grams if grams.count(g) > 1} if len(grams) < 5000 else {g for g, n in __import__("collections").Counter(grams).items() if n > 1}
        inside = {j + k for j, g in enumerate(grams) if g in many for k in range(3)}
        want = [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)]
        assert [got[c][i] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == want


def test_bloom_has_no_false_negatives_and_few_false_positives(llm):
    keys = llm.range(5000).selectExpr("xxhash64(id) k")
    held = bloom.build(keys, 5000)
    mine = np.array([r.k for r in keys.collect()])
    others = np.array([r.k for r in llm.range(10_000, 30_000).selectExpr("xxhash64(id) k").collect()])
    assert bloom.might_hold(held, mine).all()
    assert bloom.might_hold(held, others).mean() < 0.01
    assert len(bloom.build(keys, 5000, most_bits=1 << 12)) == (1 << 12) // 64


def test_components_against_union_find(llm):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(1000, 1001 + i) for i in range(300)] + [(2000 + i, 2001 + i) for i in range(60)]
    low = {x: x for ab in links for x in ab}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    joined = {x for a, b in links if a != b for x in (a, b)}
    got = {r.node: r.component for r in components(llm.createDataFrame(links + [(None, 5)], "a long, b long")).collect()}
    assert got == {x: low[x] for x in joined}
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0
    node, least = spanning_forest(np.array([3, 4, 9]), np.array([4, 5, 9]))
    assert dict(zip(node.tolist(), least.tolist())) == {4: 3, 5: 3}
