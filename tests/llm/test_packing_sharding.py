import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from fleetlens.llm import packing as P
from fleetlens.llm import sharding as H
from fleetlens.llm.tokens import Encoder

from .conftest import odd_rows, some_words

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def direct():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_those_of_whole_texts(direct, monkeypatch):
    from fleetlens.llm import tokens

    rng = random.Random(6)
    odd = " \n\t\r\x0b\x0c\x1c\x85\u00a0\u1680\u2003\u2028\u3000\u200b éß'sx'll1²½#!.,日本語🙂\u0301"
    texts = [r[1][:3000] if r[1] else r[1] for r in odd_rows()] + ["".join(rng.choice(odd) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += [" ".join(some_words(rng, 50)) for _ in range(50)] + ["  lead", "trail  ", "a\n\n b", "don't  we'll\t\tgo"]
    want = [direct(t) for t in texts]
    for chunk, pieces in ((1 << 20, 400_000), (64, 50)):
        monkeypatch.setattr(tokens, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(tokens, "MOST_PIECES", pieces)
        assert [x.tolist() for x in Encoder(PATH).encode(pa.array(texts))] == want


def check_pieces(rows, docs, direct, width):
    """docs: (doc_id, text) in any order, ids may repeat."""
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, parts in by_sequence.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == width or s == len(by_sequence) - 1 and at < width
    for doc in {d for d, _ in docs}:
        want = sorted(direct(t) + [0] for d, t in docs if d == doc)
        place = sorted(by_doc[doc], key=lambda r: (r.sequence_id, r.offset))
        got, now = [], []
        for r in place:
            assert r.start == len(now) and r.length * 4 == len(r.ids)
            now = now + np.frombuffer(r.ids, "<u4").tolist()
            if len(now) == r.doc_tokens:
                got.append(now)
                now = []
        assert sorted(got) == want and not now


@pytest.mark.parametrize("width", [1024, 16])
def test_pack(llm, odd_docs, clash, no_docs, direct, width):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check_pieces(P.pack(clash.repartition(3), PATH, width=width).collect(), docs, direct, width)
    assert P.pack(no_docs, PATH).collect() == []
    assert P.padded(1000) == 1024 and P.padded(512) == 512 and P.padded(1024) == 1024


def test_shards(llm, odd_docs, clash, no_docs):
    rng = random.Random(7)
    rows = [(i, "x" * int(rng.paretovariate(0.8)) if i % 3 else "copy") for i in range(3000)]
    got = H.shard_documents(llm.createDataFrame(rows, "doc_id long, text string").repartition(5), 8).collect()
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        text = dict(rows)[r.doc_id]
        assert r.size == len(text) + 1 and r.text_crc32 == zlib.crc32(text.encode()) and r.law == "bytes" and r.grown_shard is None
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(got) == 3000 and set(sizes) <= set(range(8))
    largest = max(r.size for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    odd = H.shard_documents(clash).collect()
    assert len(odd) == odd_docs.count()
    assert sorted(r.size for r in odd) == sorted(len((r.text or "").encode()) + 1 for r in odd_docs.collect())
    assert H.shard_documents(no_docs).collect() == []


def test_slot_map_versions(llm):
    rng = np.random.default_rng(1)
    size = (rng.pareto(1.2, H.SLOTS) * 100).astype(np.int64)
    first = H.first_map(8)
    even = H.rebalance(first, size, 8)
    sums = np.bincount(even, size, 8)
    assert sums.max() - sums.min() <= np.bincount(first, size, 8).max() - np.bincount(first, size, 8).min()
    more = H.grow(even, size, 8)
    moved = more != even
    assert (more[moved] == 8).all() and np.bincount(more, size, 9)[8] <= size.sum() / 9 and moved.sum() > 0
    kept = H.SlotMap(llm)
    kept.write(first)
    kept.write(more)
    for version, want in ((0, first), (1, more)):
        assert [r.shard for r in kept.read(version).orderBy("vslot").collect()] == want.tolist()


def test_a_map_lives_on(llm):
    """Opened again, the newest version is edited: more documents, and then a
    shard more, move few slots, and no whole map is laid anew."""
    rng = random.Random(3)
    rows = [(i, "x" * int(rng.paretovariate(1.1) * 50)) for i in range(9000)]
    docs = lambda n: llm.createDataFrame(rows[:n], "doc_id long, text string")
    kept = H.SlotMap(llm)
    H.shard_documents(docs(8000), 8, slot_map=kept).count()
    assert kept.version == 1  # the first map, and what today's bytes made of it
    before = kept.newest()
    again = H.SlotMap(llm, kept.folder)
    H.shard_documents(docs(8000), 8, slot_map=again).count()
    assert again.version == 1 and (again.newest() == before).all()  # nothing to change
    H.shard_documents(docs(9000), 8, slot_map=again).count()
    after = again.newest()
    assert again.version == 2 and 0 < (after != before).sum() < H.SLOTS / 20
    assert (after != H.first_map(8)).sum() < H.SLOTS / 4
    opened = H.SlotMap(llm, kept.folder)
    got = H.shard_documents(docs(9000), 9, slot_map=opened).collect()
    grown = opened.newest()
    moved = grown != after
    assert opened.version == 3 and (grown[moved] == 8).mean() > 0.9 and 0 < moved.sum() < H.SLOTS / 8
    sizes = np.bincount([r.shard for r in got], [r.size for r in got], 9)
    assert sizes.max() - sizes.min() <= 2 * max(r.size for r in got)
    H.shard_documents(docs(9000), 8, slot_map=opened).count()
    assert opened.newest().max() == 7 and (opened.newest() != grown).sum() < H.SLOTS / 5
    assert (opened.read(0).count(), opened.read().count()) == (H.SLOTS, H.SLOTS)


def test_encoder_keeps_little_and_learns_in_parts(direct, monkeypatch):
    """A worker's memory: the tokenizer gets new pieces in bounded parts, and a
    piece that is kept takes 12 bytes beside its ids."""
    from fleetlens.llm import tokens

    monkeypatch.setattr(tokens, "LEARN_PIECES", 7, raising=False)
    rng, parts = random.Random(8), []
    texts = [" ".join("".join(rng.choice("abcdxyz") for _ in range(6)) for _ in range(60)) for _ in range(4)]
    encoder, ids_of = Encoder(PATH), Encoder._ids_of
    monkeypatch.setattr(Encoder, "_ids_of", lambda self, pieces: parts.append(len(pieces)) or ids_of(self, pieces))
    want = [direct(t) for t in texts]
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == want
    assert max(parts) <= 7 and sum(parts) > 100
    learnt = len(parts)
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == want and len(parts) == learnt
    assert encoder.hashes.nbytes + encoder.places.nbytes == 12 * sum(parts)
