"""Exchange of hashed n-grams between blocks of documents, as arrays instead of rows.

Documents are cut in blocks of about ``BLOCK_BYTES`` of text.  A block has each of its n-grams
once, as a sorted array of 64-bit keys; the range of keys is cut in buckets of about
``BUCKET_KEYS``, and a block sends one row per bucket.  A bucket gathers the rows of all blocks,
answers, and the answers go back to the blocks.  So a frequent n-gram costs one key per block,
and a task holds one block or one bucket; both bounds are parameters, whatever the input.
"""

from __future__ import annotations

import gc
import time
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
BUCKET_KEYS = 1_000_000


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, without the planes that are all zero."""
    values = np.ascontiguousarray(values, "<u8")
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    return values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(data: bytes, size: int) -> np.ndarray:
    planes = np.zeros((size, 8), np.uint8)
    if size and len(data):
        width = len(data) // size
        planes[:, :width] = np.frombuffer(data, np.uint8).reshape(width, size).T
    return planes.view("<u8").reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(unpack(data, size), dtype=np.uint64)


def scramble(keys: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys (the finisher of splitmix64)."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def bucket_bounds(buckets: int) -> np.ndarray:
    """The first key of every bucket but the first."""
    return np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)


@dataclass(frozen=True)
class Words:
    """The words of a list of texts: ``code`` numbers the distinct words, ``ends`` ends the texts."""

    code: np.ndarray
    ends: np.ndarray
    distinct: pa.Array

    @property
    def starts(self) -> np.ndarray:
        return np.append(0, self.ends[:-1]).astype(np.int64)[: len(self.ends)]

    def hashes(self, seed: int) -> np.ndarray:
        """Two independent 64-bit hashes of every distinct word, a row each."""
        digest = xxhash.xxh3_128_digest
        every = b"".join([digest(w, seed) for w in self.distinct.cast(pa.large_binary()).to_pylist()])
        return np.frombuffer(every, "<u8").reshape(-1, 2)


def words_of(texts: pa.Array | pa.ChunkedArray, lower: bool) -> Words:
    """Split whole texts at ASCII white space; null has no words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    values = split.flatten()
    # Space at either end of a text leaves an empty string there.
    full = pc.greater(pc.binary_length(values), 0)
    mask = full.to_numpy(zero_copy_only=False).astype(bool)
    ends = np.append(0, np.cumsum(mask))[split.offsets.to_numpy()[1:] - split.offsets[0].as_py()]
    coded = values.filter(full).dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), ends.astype(np.int64), coded.dictionary)


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def blocks_for(n_bytes: int, block_bytes: int = BLOCK_BYTES) -> int:
    return max(1, -(-n_bytes // block_bytes))


def buckets_for(n_bytes: int, bucket_keys: int = BUCKET_KEYS) -> int:
    """About six bytes of text to a word and so to a key."""
    return max(1, -(-n_bytes // (6 * bucket_keys)))


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are no longer referred to.

    It does so when the driver collects its garbage, which a driver with little to do may
    put off until the next phase has filled the disks.  One collection finds the plans,
    the next one their shuffles.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)
