import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from fleetlens.llm import lines

BLANK = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows, least_chars=40, least_docs=5):
    """rows of (doc_id, text) -> (doc_id, n_lines, n_dropped, digest, text)."""
    holds = defaultdict(set)
    for doc_id, text in rows:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                if len(key_of(line)) >= least_chars:
                    holds[key_of(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        own = (text or "").split("\n")
        keep = [x for x in own if doc_id is None or len(holds[key_of(x)]) < least_docs or max(holds[key_of(x)]) == doc_id]
        whole = "\n".join(keep)
        out.append((doc_id, len(own), len(own) - len(keep), hashlib.sha256(whole.encode()).hexdigest(), whole if text is not None else None))
    return out


def some_rows(n=120, seed=3):
    rng = random.Random(seed)
    common = [f"  This line number {i} is held by a good many DOCUMENTS, é ß {'x' * i}\t" for i in range(12)]
    rows = []
    for i in range(n):
        own = [rng.choice(common).swapcase() if rng.random() < 0.2 else rng.choice(common) for _ in range(rng.randrange(6))]
        own += [f"a line of its own {rng.randrange(10**9)} with enough letters to count {i}" for _ in range(rng.randrange(4))] + ["", "short"] * rng.randrange(2)
        rng.shuffle(own)
        rows.append((i * 7, "\n".join(own)))
    return rows


def results(docs):
    maps = lines.line_bitmaps(docs)
    got = lines.line_digests(docs, maps)
    assert [f.simpleString() for f in got.schema] == ["doc_id:bigint", "n_lines:bigint", "n_dropped:bigint", "kept_sha256:string"]
    return maps, sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_lines_as_brute_force(llm, parts):
    # One line in every document, so that its hash spans many ranges.
    rows = [(i, t + "\nThe same line stands in each and every one of these documents") for i, t in some_rows()]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    before = llm.conf.get("spark.sql.shuffle.partitions")
    llm.conf.set("spark.sql.shuffle.partitions", "37")
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        maps, got = results(docs)
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", before)
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = brute(rows)
    assert got == sorted((w[:4] for w in want), key=repr)
    assert sum(w[2] for w in want) > 100
    for r in maps.collect():
        keep = lines.unpack_bitmap(r.n_lines, r.bitmap)
        assert len(keep) == r.n_lines and (~keep).sum() == r.n_dropped
    cut = lines.without_lines(docs, maps)
    assert sorted(map(tuple, cut.collect())) == sorted((w[0], w[4]) for w in want)


def test_odd_rows(llm, odd_docs, no_docs):
    line = "A line of more than forty characters, held by several of these rows"
    extra = [(20 + i, f"{line}\n{line} \r\nown {i}", "en", "a", 1) for i in range(5)] + [(24, line, "en", "a", 1), (24, line, "en", "a", 1), (None, line, None, None, 1), (1 << 60, line + "\n" * 3, "en", "a", 1)]
    docs = odd_docs.unionByName(llm.createDataFrame(extra, odd_docs.schema))
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    maps, got = results(docs)
    assert got == sorted((w[:4] for w in want), key=repr)
    assert sum(w[2] > 0 for w in want) >= 6
    assert results(no_docs)[1] == [] and lines.without_lines(no_docs, lines.line_bitmaps(no_docs)).count() == 0


def test_columns_of_any_name(llm, clash):
    line = "A line of more than forty characters, held by several of these rows"
    names = ["doc_id", "same", "rest", "kept", "bitmap", "page url", "a.b", 'q"`x', "text"]
    rows = [(i, "s", None, 1.5, "b", "u", "ab", "q", f"{line}\n{i}" if i else None) for i in range(9)]
    docs = llm.createDataFrame(rows, "c0 long, c1 string, c2 string, c3 double, c4 string, c5 string, c6 string, c7 string, c8 string").toDF(*names)
    cut = lines.without_lines(docs, lines.line_bitmaps(docs))
    assert cut.columns == names
    assert sorted(map(tuple, cut.collect())) == [(*r[:8], r[8] if i in (0, 8) else str(i)) for i, r in enumerate(rows)]
    assert lines.without_lines(clash, lines.line_bitmaps(clash)).columns == clash.columns


def test_stream_hands_on_what_it_cannot_decide():
    """A hash in three ranges: the rows are decided by the summaries alone."""
    rows = {"k1": [5] * 6, "k2": [0] * 6, "doc_id": [9, 9, 8, 8, 7, 6], "same": [0] * 6, "pos": [0, 1, 0, 1, 0, 0]}
    kinds = {"pos": pa.int32()}
    cut = lambda a, b: pa.RecordBatch.from_pydict({c: pa.array(x[a:b], kinds.get(c, pa.int64())) for c, x in rows.items()})
    out = [pa.Table.from_batches(lines._first_occurrences(4)(iter([cut(a, b)]))).to_pylist() for a, b in ((0, 1), (1, 3), (3, 6))]
    sums = [[(r["doc_id"], r["docs"], r["last"]) for r in part if r["docs"] is not None] for part in out]
    assert sums == [[(9, 1, 9)], [(9, 2, 8)], [(8, 3, 6)]]
    assert not any(r["sure"] for part in out for r in part)


def test_bitmap_round_trip():
    for n in (1, 7, 8, 9, 1000):
        gone = np.arange(0, n, 3)
        keep = lines.unpack_bitmap(n, lines.pack_bitmap(n, gone))
        assert len(keep) == n and np.flatnonzero(~keep).tolist() == gone.tolist()
