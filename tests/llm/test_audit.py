import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest

from fleetlens.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABEL_SCHEMA = "doc_id long, quality int, toxic int"


def fails_of(doc_id, text, first):
    words = WORD.findall(text)
    hits = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search(r"[#$%&*|]", text))]
    return {f for f, x in zip("ABCDE", [*hits, doc_id is not None and first.get(text, doc_id) < doc_id]) if x}


def brute(docs, labels):
    """Applies the filters in every order, document by document."""
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    parts = defaultdict(list)
    for doc_id, text, part in docs:
        parts[part or ""].append((doc_id, fails_of(doc_id, text or "", first)))
    out = {}
    for part, own in parts.items():
        total = defaultdict(int)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, left = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                total[f] += len(gone)
                failing = [d for d in own if f in d[1]]
                lost = lambda ids: sum(d[0] in ids for d in gone)  # noqa: E731,B023
                out[part, "".join(order), step] = [len(left), len(gone), len(failing) - len(gone), sum(d[1] == {f} for d in own), lost(good), lost(toxic)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(docs, labels):
    got = audit.filter_audit(audit.judged(docs, labels))
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == ["part string", "filter_order string", "step int"] + [f"{c} bigint" for c in audit.SIZES]
    rows = got.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def some_docs(n=300, seed=9):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(rng.choice([20, 400]))}" for _ in range(rng.choice([10, 49, 50, 120]))]
        text = " ".join(words)
        text = text.upper() if rng.random() < 0.2 else text + "#" if rng.random() < 0.2 else text
        rows.append((i * 3, rows[rng.randrange(len(rows))][1] if rows and rng.random() < 0.2 else text, "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "", None])))
    labels = [(i * 3, rng.randrange(2), rng.randrange(2)) for i in range(0, n, 2)]
    return rows, labels


@pytest.mark.parametrize("block", [audit.BLOCK_IDS, 7])
def test_all_orders_as_brute_force(llm, monkeypatch, block):
    monkeypatch.setattr(audit, "BLOCK_IDS", block)
    docs, labels = some_docs()
    want = brute(docs, labels)
    frame = llm.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    assert found(frame, llm.createDataFrame(labels, LABEL_SCHEMA)) == want
    assert len(want) == 4 * 600


def test_odd_rows(llm, odd_docs, clash, no_docs):
    labels = [(6, 1, 0), (6, 0, 1), (7, None, 1), (None, 1, 1), (8, 1, None), (9, 0, 0)]
    frame = llm.createDataFrame(labels, LABEL_SCHEMA)
    rows = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    want = brute(rows, labels)
    assert found(odd_docs, frame) == want
    names = ["doc_id", "page url", "a.b", "source", "row", "text", 'q"`x']
    other = llm.createDataFrame([(i, "x", "y", s, 1, t, "z") for i, t, s in rows], "c0 long, c1 string, c2 string, c3 string, c4 int, c5 string, c6 string").toDF(*names)
    assert found(other, frame.toDF("doc_id", "quality", "toxic")) == want
    assert found(no_docs, frame) == {}
    assert found(odd_docs, frame.limit(0)) == brute(rows, [])


def test_galloping_merge():
    rng = np.random.default_rng(4)
    for sizes in ([0, 0, 0], [1, 0, 3], [5000, 20000, 3], [9000, 9000, 9000], [50, 0, 0]):
        lists = [np.sort(rng.choice(30_000, n, replace=False)).astype(np.int64) for n in sizes]
        lists[1] = lists[1] + 10_000  # far apart at one end
        want = np.zeros(8, np.int64)
        for x in set(np.concatenate(lists).tolist()):
            want[sum(1 << i for i, own in enumerate(lists) if x in own)] += 1
        got = audit.merged_cells(lists)
        assert got.tolist() == want.tolist()
    ids = np.arange(0, 1000, 3)
    for at in (0, 5, 300):
        for bound in (-1, 0, 14, 15, 16, 998, 2000):
            assert audit.gallop(ids, at, bound) == max(at, int(np.searchsorted(ids, bound, side="right")))
