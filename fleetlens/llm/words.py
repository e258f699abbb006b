"""Words of many texts and 64-bit hashes of word sequences, vectorised.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``, found on the UTF-8 bytes
(none of these white-space bytes occurs inside a longer UTF-8 sequence). Texts
come as one Arrow array; all work runs on its flat byte buffer, a few hundred
kilobytes at a time, so a Python loop runs per text and not per word.

A word's hash is a polynomial over random 64-bit values of its bytes, modulo
2**64, then mixed; the hash of a run of words is a polynomial over word hashes.
Two different sequences share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the byte and word polynomials, with their inverses.
BYTE_STEP, WORD_STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
BYTE_BACK, WORD_BACK = (pow(x, -1, 1 << 64) for x in (BYTE_STEP, WORD_STEP))
CHUNK_BYTES = 1 << 18
#: Powers kept for each multiplier (32 MB).
MOST_POWERS = 1 << 22

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_VALUES = np.random.Generator(np.random.PCG64(20250320)).integers(1, 1 << 64, 256, dtype=U64, endpoint=False)

_powers: dict[int, np.ndarray] = {}
_kept: dict[str, dict] = {}


def kept(work: str) -> dict:
    """What this Python worker keeps from task to task for one kind of work.
    Spark gives a worker to the stages of all operators, one after the other:
    what another kind of work has kept is dropped first."""
    if work not in _kept:
        _kept.clear()
        pa.default_memory_pool().release_unused()
    return _kept.setdefault(work, {})


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls up to a bound."""
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, U64)
    while len(have) < n:
        have = np.concatenate([have, have * U64(pow(base, len(have), 1 << 64))])
    if len(have) <= MOST_POWERS:
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (one to one)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The byte buffer of a string or binary array and its offsets (n + 1); a
    null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    _, offsets, data = texts.buffers()
    kind = np.int64 if large else np.int32
    off = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return buf, off


def word_bounds(buf: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run without the bytes that ``breaks`` marks."""
    inside = np.empty(len(buf) + 2, np.int8)
    inside[0] = inside[-1] = 0
    np.logical_not(breaks[buf], out=inside[1:-1].view(bool))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[0::2], edge[1::2]


def _hash_piece(buf: np.ndarray, lower: bool, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word of a piece that cuts no word."""
    start, end = word_bounds(buf, breaks)
    if lower:
        buf = LOWER[buf]
    total = np.zeros(len(buf) + 1, U64)
    np.cumsum(BYTE_VALUES[buf] * _power(BYTE_STEP, len(buf)), out=total[1:])
    return mix((total[end] - total[start]) * _power(BYTE_BACK, len(buf) + 1)[start]), start, end


def text_words(buf: np.ndarray, lower: bool = False, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of one text, whatever its length."""
    if len(buf) <= 2 * CHUNK_BYTES:
        return _hash_piece(buf, lower, breaks)
    parts, at = [], 0
    while at < len(buf):
        stop = min(len(buf), at + CHUNK_BYTES)
        while stop < len(buf) and not SPACE[buf[stop]]:  # a word is not cut
            more = np.flatnonzero(SPACE[buf[stop : stop + CHUNK_BYTES]])
            stop = stop + int(more[0]) if len(more) else min(len(buf), stop + CHUNK_BYTES)
        h, s, e = _hash_piece(buf[at:stop], lower, breaks)
        parts.append((h, s + at, e + at))
        at = stop
    return tuple(np.concatenate(x) for x in zip(*parts))


def each_text(texts: pa.Array, lower: bool = False, breaks: np.ndarray = SPACE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, word hashes, word starts, word ends) of every text in order;
    ``breaks`` must mark the white-space bytes at least."""
    kept("texts")
    buf, off = flat_bytes(texts)
    n, i = len(off) - 1, 0
    while i < n:
        j = i + 1  # as many whole texts as fit a piece
        while j < n and off[j + 1] - off[i] <= CHUNK_BYTES:
            j += 1
        if j == i + 1:
            own = buf[off[i] : off[j]]
            yield (own, *text_words(own, lower, breaks))
        else:
            # A space between texts keeps their words apart.
            gap = np.arange(j - i)
            lo = off[i:j] - off[i] + gap
            piece = np.full(int(off[j] - off[i]) + j - i, 0x20, np.uint8)
            keep = np.ones(len(piece), bool)
            keep[off[i + 1 : j + 1] - off[i] + gap] = False
            piece[keep] = buf[off[i] : off[j]]
            h, s, e = _hash_piece(piece, lower, breaks)
            cut = np.searchsorted(s, np.append(lo, len(piece)))
            for k in range(j - i):
                a, b = cut[k], cut[k + 1]
                yield buf[off[i + k] : off[i + k + 1]], h[a:b], s[a:b] - lo[k], e[a:b] - lo[k]
        i = j


def rolling(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (empty when there is none)."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    total = np.zeros(len(word_hashes) + 1, U64)
    np.cumsum(word_hashes * _power(WORD_STEP, len(word_hashes)), out=total[1:])
    return mix((total[k:] - total[:-k]) * _power(WORD_BACK, n))


def shingle_set(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; a shorter text is
    one shingle of all its words, a text without words has none."""
    n = len(word_hashes)
    if n == 0:
        return np.empty(0, U64)
    if n < k:
        return mix(rolling(word_hashes, n) + U64(n))
    h = np.sort(rolling(word_hashes, k))
    first = np.empty(len(h), bool)
    first[0] = True
    np.not_equal(h[1:], h[:-1], out=first[1:])
    return h[first]


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.view(np.int64)


def unsigned(h: np.ndarray) -> np.ndarray:
    return np.asarray(h, np.int64).view(U64)
