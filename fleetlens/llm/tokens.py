"""Token ids of many texts by a public byte-level BPE vocabulary.

No token of this vocabulary's pattern has white space behind something else, or
a mark behind a letter, so a text can be cut at such places: the pieces' ids,
joined, are the text's ids. Pieces repeat a lot;
each distinct one is encoded once per worker by the ``tokenizers`` library and
looked up by its hash afterwards.
"""

from __future__ import annotations

import gc
import os
import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from .words import BYTE_BACK, BYTE_STEP, BYTE_VALUES, SPACE, U64, _power, flat_bytes, mix

#: A piece without white space but for one blank before it.
PLAIN = re.compile(r" ?\S+").fullmatch
#: Bytes of text cut and looked up at a time, and pieces kept by a worker.
CHUNK_BYTES = (1 << 20) - 1
MOST_PIECES = 1_000_000
#: New pieces given to the tokenizer at a time: its own records of a token take
#: a hundred times the room of an id.
LEARN_PIECES = 1 << 15


LETTER, MARK = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
MARK[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def piece_starts(buf: np.ndarray) -> np.ndarray:
    """Where the bytes of a text may be cut, 0 first: before ASCII white space
    that follows a character which can't be white space (after a byte that
    might end a Unicode space the text is left whole), after a lone one that is
    no blank, and before an ASCII mark, other than ', that follows an ASCII
    letter."""
    here = SPACE[buf]
    at = np.flatnonzero(here[1:] & ~here[:-1]) + 1
    one, two, three = buf[at - 1], buf[np.maximum(at - 2, 0)], buf[np.maximum(at - 3, 0)]
    control = (one >= 0x1C) & (one <= 0x1F)
    unsure = control | ((one >= 0x80) & ((two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))))
    at = at[~unsure]
    # A lone line end or tab is a token of its own.
    lone = at[at + 1 < len(buf)]
    after = buf[np.minimum(lone + 1, len(buf) - 1)]
    sure = (after < 0x80) | ((after >= 0xC3) & (after < 0xE1))  # no Unicode space begins so
    lone = lone[(buf[lone] != 0x20) & ~SPACE[after] & sure] + 1
    start = np.zeros(len(buf), bool)
    start[:1] = start[at] = start[lone] = True
    start[1:] |= MARK[buf[1:]] & LETTER[buf[:-1]]
    return np.flatnonzero(start)


class Encoder:
    """ids of texts, with the pieces seen so far (bounded)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids[-1]
        self.clear()

    def clear(self) -> None:
        # Sorted hashes and places of the pieces: a dict takes ten times the room.
        self.hashes, self.places = np.empty(0, U64), np.empty(0, np.int32)
        self.ids = np.empty(1 << 16, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after the other, and how many each has.

        A piece without white space, but for a blank before it, is encoded the
        same between line ends, which are a token of their own there: so all of
        these are one text for the tokenizer, and it is cut at the line ends."""
        plain = [i for i, p in enumerate(pieces) if PLAIN(p)]
        others = [p for p in pieces if not PLAIN(p)]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        count, ids = np.zeros(len(pieces), np.int64), np.empty(0, np.uint32)
        if plain:
            joined = self.tokenizer.encode_batch_fast(["\n".join([pieces[i] for i in plain])], add_special_tokens=False)[0].ids
            joined = np.fromiter(joined, np.uint32, len(joined))
            breaks = np.flatnonzero(joined == self.line_end)
            if len(breaks) != len(plain) - 1:
                raise ValueError("this vocabulary has no token of its own for a line end between pieces")
            count[plain] = np.diff(np.concatenate([[-1], breaks, [len(joined)]])) - 1
            ids = np.delete(joined, breaks)
        rest = np.ones(len(pieces), bool)
        rest[plain] = False
        count[rest] = [len(x) for x in found]
        if not found:
            return ids, count
        out, of = np.empty(int(count.sum()), np.uint32), np.repeat(rest, count)
        out[of], out[~of] = np.fromiter(chain.from_iterable(found), np.uint32), ids
        return out, count

    def _learn(self, pieces: list[bytes]) -> None:
        gc.disable()  # or it walks the new lists again and again
        try:
            ids, count = self._ids_of([p.decode("utf-8", "replace") for p in pieces])
        finally:
            gc.enable()
        ends = self.ends[-1] + np.cumsum(count)
        while ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.ends[-1] : ends[-1]] = ids
        self.ends = np.concatenate([self.ends, ends])

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash's piece stands among those seen, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.places[at], -1).astype(np.int64)

    def _note(self, hashes: np.ndarray, places: np.ndarray) -> None:
        order = np.argsort(hashes)
        hashes = hashes[order]
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.places = np.insert(self.places, at, places[order].astype(np.int32))

    def _chunk(self, buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the pieces that begin at ``starts``, and how many each has."""
        ends = np.append(starts[1:], len(buf))
        total = np.zeros(len(buf) + 1, U64)
        np.cumsum(BYTE_VALUES[buf] * _power(BYTE_STEP, len(buf)), out=total[1:])
        h = mix((total[ends] - total[starts]) * _power(BYTE_BACK, len(buf) + 1)[starts])
        which, distinct = pd.factorize(h)
        first = np.empty(len(distinct), np.int64)
        first[which] = np.arange(len(h))
        if len(self.places) + len(distinct) > MOST_PIECES:
            self.clear()
        place = self._places(distinct)
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = len(self.ends) - 1 + np.arange(len(new))
            raw = buf.tobytes()
            for i in range(0, len(new), LEARN_PIECES):
                some = first[new[i : i + LEARN_PIECES]]
                self._learn([raw[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist())])
            self._note(distinct[new], place[new])
        place = place[which]
        lo, n = self.ends[place], self.ends[place + 1] - self.ends[place]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return self.ids[at], n

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; a null is an empty text."""
        buf, off = flat_bytes(texts)
        out: list[np.ndarray] = []
        n, i = len(off) - 1, 0
        while i < n:
            j = i + 1
            while j < n and off[j + 1] - off[i] <= CHUNK_BYTES:
                j += 1
            if off[j] - off[i] > 2 * CHUNK_BYTES:
                out.append(self._long(buf[off[i] : off[j]]))
            else:
                own = buf[off[i] : off[j]]
                lo = off[i:j] - off[i]
                starts = piece_starts(own)
                # A text's first piece begins with it, whatever stands before.
                starts = np.sort(np.concatenate([starts, lo[lo < len(own)]]))
                starts = starts[np.append(True, starts[1:] != starts[:-1])] if len(own) else starts
                ids, count = self._chunk(own, starts) if len(own) else (np.empty(0, np.uint32), np.empty(0, np.int64))
                total = np.concatenate([[0], np.cumsum(count)])
                cut = total[np.searchsorted(starts, np.append(lo, len(own)))]
                out += [ids[cut[k] : cut[k + 1]] for k in range(j - i)]
            i = j
        return out

    def _long(self, buf: np.ndarray) -> np.ndarray:
        starts, parts, i = piece_starts(buf), [], 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + CHUNK_BYTES)))
            end = starts[j] if j < len(starts) else len(buf)
            parts.append(self._chunk(buf[starts[i] : end], starts[i:j] - starts[i])[0])
            i = j
        return np.concatenate(parts)
