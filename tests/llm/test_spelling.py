import random
import re
import zlib
from collections import Counter

import pytest

from fleetlens.llm import spelling
from fleetlens.llm.spelling import Grams, near

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def edits(word, letters):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            out |= {word[:i] + word[i + 1 :]} | {word[:i] + c + word[i + 1 :] for c in letters}
    return out - {word}


def brute(rows, times=10):
    words = brute_words(rows)
    letters = set("".join(words))
    forms, out = {}, {}
    for w, n in words.items():
        found = sorted((x for x in edits(w, letters) if x in words), key=lambda x: (-words[x], x))
        form = found[0] if found and words[found[0]] >= times * n else None
        forms[w] = form
        out[w] = (form, n, len(found), words[form] if form else None)
    for w in out:
        root = w
        while forms[root]:
            root = forms[root]
        form, n, n_near, form_n = out[w]
        out[w] = (form, root, n, n_near, form_n)
    return out


def found(docs):
    got = spelling.spelling_groups(docs)
    assert [f"{f.name}:{f.dataType.simpleString()}" for f in got.schema] == ["word:string", "form:string", "root:string", "n:bigint", "n_near:bigint", "form_n:bigint"]
    rows = got.collect()
    out = {r.word: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def some_rows(n=400, seed=2, alphabet="abcdeé"):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(7, 12))) for _ in range(60)]
    weights = [4 ** rng.randrange(6) for _ in base]
    rows = []
    for i in range(n):
        words = rng.choices(base, weights, k=40)
        for k in range(len(words)):
            if rng.random() < 0.3:
                words[k] = rng.choice(sorted(edits(words[k], alphabet)))
        # A form that has a form itself.
        words += ["lantern"] + ["lanterna"] * (i < 26) + ["lanternaa"] * (i < 2)
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in words) + " aaaaaaa aaaaaaaa, abababab;babababa"))
    return rows


@pytest.mark.parametrize("held, block", [(20_000, 2048), (200, 2048), (20_000, 8)])
def test_groups_as_brute_force(llm, monkeypatch, held, block):
    monkeypatch.setattr(spelling, "DICTIONARY", held)
    monkeypatch.setattr(spelling, "BLOCK_ROWS", block)
    monkeypatch.setattr(spelling, "CHUNK_ROWS", 50)
    rows = some_rows()
    want = brute(rows)
    assert found(llm.createDataFrame(rows, "doc_id long, text string").repartition(5)) == want
    chains = [w for w, x in want.items() if x[0] and x[0] != x[1]]
    assert sum(x[2] > 0 for x in want.values()) > 300 and sum(x[0] is not None for x in want.values()) > 100 and chains


def test_odd_rows(llm, odd_docs, clash, no_docs):
    long = "q" * 5000
    extra = [(30, f"{long} {long}x", "en", "a", 1), (31, f"{long} {long}x", "en", "a", 1), (None, "letters LETTERS lettera lettera", None, None, 1)]
    docs = odd_docs.unionByName(llm.createDataFrame(extra, odd_docs.schema))
    words = brute_words([(r.doc_id, r.text) for r in docs.collect()])
    got = found(docs)
    assert {w: x[2] for w, x in got.items()} == words
    for w, x in got.items():
        assert x[3] == sum(near(w, y) for y in words)
    assert got["letters"][3] == 1 and got[long][3] == 1
    assert found(clash) == found(odd_docs)
    assert found(no_docs) == {}


def test_bound_on_affected_grams():
    """Whatever the dictionary, an edit takes away no more grams than the
    bound says, and two near words meet on a list."""
    rng = random.Random(11)
    weak = 0
    for _ in range(300):
        letters = "abc"[: rng.randint(2, 3)]
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 12))) for _ in range(4)]
        every = sorted({w[p : p + q] for w in words for q in (3, 4) for p in range(len(w) - q + 1)})
        grams = Grams(rng.sample(every, rng.randint(0, len(every))))
        grams.counts = Counter(w[p:e] for w in words for p, e in grams.decompose(w))
        for w in words:
            own = grams.decompose(w)
            assert all(own[i][0] < own[i + 1][0] and own[i][1] < own[i + 1][1] for i in range(len(own) - 1))
            most = grams.most_affected(w, own)
            for x in rng.sample(sorted(edits(w, letters)), 8):
                i = next((i for i, (a, b) in enumerate(zip(w, x)) if a != b), min(len(w), len(x)))
                shift = len(x) - len(w)
                there = {(p, x[p:e]) for p, e in grams.decompose(x)}
                # The gram lies before the first difference, or behind it at
                # its new place.
                stay = sum((p, w[p:e]) in there and e <= i or (p + shift, w[p:e]) in there and p > i - (shift > 0) for p, e in own)
                assert len(own) - stay <= most
                if len(x) >= 7:
                    weak += not grams.short_lists(w)[1] and not grams.short_lists(x)[1]
                    assert set(spelling.list_keys(w, grams, 4)) & set(spelling.list_keys(x, grams, 4))
    assert weak > 50


def test_near():
    rng = random.Random(3)
    for _ in range(3000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(1, 5))) for _ in range(2))
        assert near(a, b) == (b in edits(a, "ab"))
        if near(a, b):
            assert bin((spelling.letters_of(a) ^ spelling.letters_of(b)) & (2**64 - 1)).count("1") <= 2
