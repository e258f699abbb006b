"""Counts over the words and lines of each text of an Arrow array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .words import each_text, rolling

#: Symbols that count as such: fixed values.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
REPEAT_WORDS = 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(word_hashes: np.ndarray, k: int = REPEAT_WORDS) -> int:
    """Words that lie in a run of ``k`` words that the text has twice or more."""
    runs = rolling(word_hashes, k)
    if len(runs) < 2:
        return 0
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(runs), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(word_hashes), bool)
    for i in range(k):
        covered[i : i + len(runs)] |= twice
    return int(covered.sum())


def repeated_lines(raw: bytes) -> int:
    """Lines (cut at \\n) with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def text_counts(texts: pa.Array) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {c: [] for c in COUNTS}
    for buf, h, start, end in each_text(texts):
        # A code point is a byte that doesn't continue one; those outside
        # words are the white-space bytes.
        points = int(((buf & 0xC0) != 0x80).sum())
        inside = int((end - start).sum())
        out["n_words"].append(len(h))
        out["word_chars"].append(points - (len(buf) - inside))
        out["n_symbols"].append(int(SYMBOLS[buf].sum()))
        out["n_dup_lines"].append(repeated_lines(buf.tobytes()))
        out["n_repeat_words"].append(repeated_words(h))
    return out
