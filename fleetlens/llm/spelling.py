"""Spelling variants by an index of variable-length grams.

Words of a corpus are grouped by edit distance one. A gram dictionary is built
from the words themselves: of the grams of ``SHORT`` + 1 to ``LONG`` letters
only the frequent ones are in it, so a gram whose list would be long is told
apart by a further letter, and the size of the dictionary has a fixed bound.
A word is decomposed from left to right into the longest dictionary grams
(``SHORT`` letters where none fits), leaving out grams inside an earlier one.

One edit changes only some of a word's grams. ``most_affected`` bounds their
number from the word and the dictionary alone; all others stand in the near
word too, in the same order. So of two near words' grams, rarest first, one of
the first bound + 1 on either side is the same: just these go on lists, and the
lists of common grams are never merged. The edit lies left or right of a
shared gram, and the letters on the other side agree; a list is therefore kept
per gram and side with the letters there. Words whose bound leaves no gram are
on the lists of all their grams, and on those of their two halves, which near
words of this kind share. Lists are merged in blocks of bounded size inside the
tasks: letter counts first, then the words themselves.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import one_text, stored
from .words import flat_bytes

#: One code point in so many runs is left out: fixed value of the contract.
DROP_EVERY = 31
LEAST_CHARS, LEAST_COUNT, TIMES = 7, 2, 10
#: Lengths of grams; of each length above the shortest at most this many are in
#: the dictionary (those with 1 / DICTIONARY of all letters at least).
SHORT, LONG, DICTIONARY = 2, 4, 20_000
#: Distinct words or grams that a task holds before it hands them on.
MOST_HELD = 200_000
#: Words of one block of a list, and rows merged at a time.
BLOCK_ROWS, CHUNK_ROWS = 2048, 1 << 15


# -------------------------------------------------------------------- words


def _flush(total: Counter, name: str) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=[name, "n"])
    total.clear()
    return out


def _runs(least_chars):
    run_of = re.compile(f"[a-zÀ-ÿ]{{{least_chars},}}")

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            buf, off = flat_bytes(batch.column(1))
            for doc_id, a, b in zip(batch.column(0).to_pylist(), off[:-1], off[1:]):
                own = Counter(run_of.findall(buf[a:b].tobytes().lower().decode("utf-8", "replace")))
                start = zlib.crc32(f"{doc_id}:".encode())
                for word, n in own.items():
                    if doc_id is not None:
                        h = zlib.crc32(word.encode(), start)
                        if h % DROP_EVERY == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_chars:
                                continue
                    total[word] += n
            if len(total) > MOST_HELD:
                yield _flush(total, "word")
        yield _flush(total, "word")

    return run


def word_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(doc_id, text) -> (word, n): runs of letters, A-Z lower-cased, each
    without one code point where the checksum of id and run says so."""
    runs = docs.select("doc_id", "text").mapInArrow(_runs(least_chars), "word string, n long")
    return runs.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ----------------------------------------------------------- gram dictionary


class Grams:
    """A gram dictionary: ``held`` are its grams longer than ``SHORT``."""

    def __init__(self, held, counts=None):
        self.held = frozenset(held)
        #: Proper beginnings and ends of dictionary grams.
        self.begin = frozenset(g[:i] for g in self.held for i in range(1, len(g)))
        self.end = frozenset(g[i:] for g in self.held for i in range(1, len(g)))
        #: Words on a gram's list.
        self.counts = counts or {}

    def decompose(self, word: str) -> list[tuple[int, int]]:
        """(start, end) of the word's grams, both ascending."""
        out, last, n, held = [], 0, len(word), self.held
        for p in range(n - SHORT + 1):
            e = p + SHORT
            for q in range(min(LONG, n - p), SHORT, -1):
                if word[p : p + q] in held:
                    e = p + q
                    break
            if e > last:
                out.append((p, e))
                last = e
        return out

    def most_affected(self, word: str, grams: list[tuple[int, int]]) -> int:
        """At most so many of the word's grams are missing after one edit.

        An edit at i (the letter goes or is another, or a new one comes before
        it) takes away the grams that hold its place. On the left a longer gram
        can replace or cover those that begin within ``word[p:i]``, if that is
        the beginning of a dictionary gram; on the right a gram can cover those
        that end within ``word[r:e]``, if that is the end of one."""
        n, most = len(word), 0
        for i in range(n + 1):
            left = next((p for p in range(max(0, i - LONG + 1), i) if word[p:i] in self.begin), i)
            for r in (i, i + 1) if i < n else (i,):
                right = next((e for e in range(min(n, r + LONG - 1), r, -1) if word[r:e] in self.end), r)
                hit = 0
                for p, e in grams:
                    hit += p >= left if e <= i else e <= right if p >= r else 1
                most = max(most, hit)
        return most

    def short_lists(self, word: str) -> tuple[list[tuple[int, int]], bool]:
        """The grams on whose lists the word goes, the rarest ones, and whether
        these suffice (see ``most_affected``); else all of them."""
        grams = self.decompose(word)
        most = self.most_affected(word, grams)
        if len(grams) <= most:
            return grams, False
        return sorted(grams, key=lambda g: (self.counts.get(word[g[0] : g[1]], 0), word[g[0] : g[1]], g))[: most + 1], True


def _count(pieces):
    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                total.update(pieces(word))
            if len(total) > MOST_HELD:
                yield _flush(total, "gram")
        yield _flush(total, "gram")

    return run


def gram_dictionary(words: DataFrame) -> Grams:
    """The dictionary over all words and the length of each gram's list; both
    have a bounded size (``DICTIONARY`` grams a length, and the pairs of
    letters)."""
    count = lambda pieces: words.select("word").mapInArrow(_count(pieces), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    letters = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    every = lambda word: [word[p : p + q] for q in range(SHORT + 1, LONG + 1) for p in range(len(word) - q + 1)]
    held = [r.gram for r in count(every).where(F.col("n") >= max(2, -(-letters // DICTIONARY))).select("gram").collect()]
    grams = Grams(held)
    shared = words.sparkSession.sparkContext.broadcast(grams)
    own = lambda word: [word[p:e] for p, e in shared.value.decompose(word)]
    return Grams(held, {r.gram: r.n for r in count(own).collect()})


# ------------------------------------------------------------ list merging


def letters_of(word: str) -> int:
    """A bit for each letter (code point modulo 64) that is there an odd number
    of times: one edit flips two bits at most."""
    bits = 0
    for c in word:
        bits ^= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def list_keys(word: str, grams: Grams, half: int) -> list[str]:
    """The lists that the word is on."""
    own, enough = grams.short_lists(word)
    keys = [k for p, e in own for k in (f"<{word[:p]} {word[p:e]}", f"{word[p:e]} {word[e:]}>")]
    if not enough:
        keys += [f"<{word[:half]}", f"{word[half:]}>", f"{word[half + 1 :]}>"]
    return keys


def _postings(shared, half):
    def run(batches):
        grams = shared.value
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("key", "word", "n", "letters")}
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                bits = letters_of(word)
                for key in dict.fromkeys(list_keys(word, grams, half)):
                    for c, x in zip(out.values(), (xxhash.xxh64_intdigest(key), word, n, bits)):
                        c.append(x)
            keys = pa.array(np.array(out["key"], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([keys, pa.array(out["word"], pa.string()), pa.array(out["n"], pa.int64()), pa.array(out["letters"], pa.int64())], names=list(out))

    return run


def near(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point apart."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[at + 1 :] == b[at + (len(a) == len(b)) :]


def _merge(rows: dict[str, np.ndarray]) -> list[tuple[str, str, int, int]]:
    """Near words of the lists (equal ``list``, in order) in these rows."""
    of, words, counts, letters, block = (rows[c] for c in ("list", "word", "n", "letters", "block"))
    size = np.fromiter(map(len, words), np.int64, len(words))
    new = np.concatenate([[True], of[1:] != of[:-1]])
    last = np.append(np.flatnonzero(new)[1:], len(of))[np.cumsum(new) - 1]
    out, x, d = [], np.arange(len(of)), 0
    while True:
        d += 1
        x = x[x + d < last[x]]
        if not len(x):
            return out
        y = x + d
        fits = (np.bitwise_count(letters[x] ^ letters[y]) <= 2) & (np.abs(size[x] - size[y]) <= 1)
        # Two blocks meet one another; each is merged with itself elsewhere.
        fits &= (block[x] < 0) | (block[x] != block[y])
        for i, j in zip(x[fits].tolist(), y[fits].tolist()):
            a, b = words[i], words[j]
            if near(a, b):
                out.append((a, b, counts[i], counts[j]) if a < b else (b, a, counts[j], counts[i]))


def _merged(batches):
    """Rows in order of their lists -> links; whole lists at a time."""
    held: list[pa.RecordBatch] = []

    def links(table: pa.Table) -> pa.RecordBatch:
        rows = {c: table.column(c).to_numpy() for c in ("word", "n", "letters", "block")}
        edges = [table.column(c).to_numpy() for c in ("key", "i", "j")]
        new = np.concatenate([[True], np.logical_or.reduce([x[1:] != x[:-1] for x in edges])])
        found = sorted(set(_merge(rows | {"list": np.cumsum(new)})))
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)], names=["a", "b", "na", "nb"])

    for batch in batches:
        held.append(batch)
        if sum(len(x) for x in held) < CHUNK_ROWS:
            continue
        table = pa.Table.from_batches(held)
        edges = [table.column(c).to_numpy() for c in ("key", "i", "j")]
        same = np.logical_and.reduce([x == x[-1] for x in edges])
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:  # the last list may go on
            yield links(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
    if held and sum(len(x) for x in held):
        yield links(pa.Table.from_batches(held))


def near_words(words: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(word, n), distinct words -> (a, b, na, nb), a < b: all pairs of words
    that are exactly one edit apart, once each."""
    spark = words.sparkSession
    grams = spark.sparkContext.broadcast(gram_dictionary(words))
    # A few bytes a word, but much work: not as few tasks as the bytes ask for.
    words = words.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = stored(words.mapInArrow(_postings(grams, (least_chars + 1) // 2), "key long, word string, n long, letters long"), "gram-lists")
    # Lists of more than a block are dealt out: every two blocks meet once.
    long = stored(rows.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > BLOCK_ROWS), "long-lists")
    rows = rows.join(long, "key", "left").withColumn("blocks", F.coalesce(F.ceil(F.col("rows") / BLOCK_ROWS), F.lit(1)).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # Within one block all pairs count: block -1.
    own = F.when(F.col("block") == F.col("other"), -1).otherwise(F.col("block"))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), own.alias("block"), "word", "n", "letters")
    merged = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_merged, "a string, b string, na long, nb long")
    return stored(merged.distinct(), "near-words")


# --------------------------------------------------------------- the groups


def _roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root) by doubling: a form is ``TIMES`` as
    frequent as its word, so chains are short and have no rings."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            return roots.drop("moved")
        roots = roots.drop("moved")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """docs -> (word, form, root, n, n_near, form_n), one row per word.

    Words are the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of whole texts, A-Z
    lower-cased, where the checksum of ``<doc_id>:<run>`` says so without one
    code point; those of ``least_chars`` code points and ``least_count``
    occurrences. ``form`` is the near word (one edit away) with the largest
    count, the smallest of equals, if it has ``times`` as many occurrences;
    ``root`` is where forms end.

    Null and empty texts have no words; in a row with a null id no code point
    is left out. Repeated rows count each. Very long texts are taken whole, one
    at a time, and very long runs are words like others. An empty table gives
    no rows. Other columns are ignored.
    """
    words = stored(word_counts(one_text(docs, id_col, text_col), least_chars, least_count), "words")
    links = near_words(words, least_chars)
    both = links.select("a", "b", "na", "nb").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("nb").alias("na"), F.col("na").alias("nb")))
    best = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("nb")).alias("m"), F.col("b").alias("w"))).alias("best"))
    fits = -F.col("best.m") >= times * F.col("n")
    rows = words.join(best, "word", "left").select("word", F.when(fits, F.col("best.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, -F.col("best.m")).alias("form_n"))
    rows = stored(rows, "forms")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
