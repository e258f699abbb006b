"""A blocked Bloom filter built by Spark tasks, of a size with a fixed bound.

A key is a 64-bit hash. It picks one block of eight 64-bit words and sets one
bit in each of them, so a probe touches one cache line. Past the bound the
filter lets more keys through; whoever uses it must check the hits exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import U64, mix, unsigned

BLOCK_WORDS = 8
BITS_PER_KEY = 16
#: 2**26 bits: at most 8 MB in the driver and in each task.
MOST_BITS = 1 << 26
PART_WORDS = 4096


def filter_words(n_keys: int, most_bits: int = MOST_BITS) -> int:
    """Words of a filter for so many keys: a power of two, bounded."""
    bits = min(most_bits, 1 << max(9, int(BITS_PER_KEY * n_keys).bit_length()))
    return bits // 64


def _places(keys: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of each key's block; a one-bit mask per word."""
    h = mix(unsigned(keys))
    block = (h & U64(words // BLOCK_WORDS - 1)).astype(np.int64) * BLOCK_WORDS
    h = mix(h ^ U64(0x2545F4914F6CDD1D))
    bit = (h[:, None] >> (U64(6) * np.arange(BLOCK_WORDS, dtype=U64))) & U64(63)
    return block, U64(1) << bit


def add(words: np.ndarray, keys: np.ndarray) -> None:
    block, mask = _places(keys, len(words))
    for i in range(BLOCK_WORDS):
        np.bitwise_or.at(words, block + i, mask[:, i])


def might_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(0, bool)
    block, mask = _places(keys, len(words))
    held = np.ones(len(keys), bool)
    for i in range(BLOCK_WORDS):
        held &= (words[block + i] & mask[:, i]) != 0
    return held


def _parts(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([x.tobytes() for x in parts.values()], pa.binary())], names=["part", "words"])


def build(keys: DataFrame, n_keys: int, most_bits: int = MOST_BITS) -> np.ndarray:
    """The filter over the one long column of ``keys`` (nulls left out). Tasks
    build partial filters; their non-empty parts are or-ed in a second step,
    and the driver receives the whole, at most ``most_bits`` bits."""
    n_words = filter_words(n_keys, most_bits)
    size = min(PART_WORDS, n_words)

    def partial(batches):
        words = np.zeros(n_words, U64)
        for batch in batches:
            add(words, batch.column(0).drop_null().to_numpy(zero_copy_only=False))
        yield _parts({i: x for i, x in enumerate(words.reshape(-1, size)) if x.any()})

    def merge(batches):
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, words in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.frombuffer(words, U64)
                parts[part] = parts[part] | x if part in parts else x
        yield _parts(parts)

    kind = "part int, words binary"
    out = np.zeros((n_words // size, size), U64)
    for row in keys.mapInArrow(partial, kind).repartition(min(64, n_words // size), "part").mapInArrow(merge, kind).collect():
        out[row.part] = np.frombuffer(row.words, U64)
    return out.reshape(-1)


def held(ids: DataFrame):
    """The filter over ``doc_id`` of a stored table, as a broadcast value."""
    ids = ids.select("doc_id")
    return ids.sparkSession.sparkContext.broadcast(build(ids, ids.count()))


def probe(words: np.ndarray, ids: pa.Array) -> pa.Array:
    """Which ids may be in the filter; a null never is."""
    there = ids.is_valid().to_numpy(zero_copy_only=False)
    return pa.array(there & might_hold(words, ids.fill_null(0).to_numpy(zero_copy_only=False)))


def split(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs as (rows whose ``doc_id`` may be one of ``ids``, rows whose isn't):
    the second part needs no join, so its texts need no shuffle."""
    words = held(ids)

    @F.pandas_udf("boolean")
    def maybe(key):
        import pandas as pd

        return pd.Series(might_hold(words.value, key.fillna(0).to_numpy("int64")))

    return docs.where(maybe(F.col("doc_id"))), docs.where(~maybe(F.col("doc_id")))
