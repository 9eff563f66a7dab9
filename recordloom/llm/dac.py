"""Token ids as directly addressable codes.

A value is cut in chunks of 8 bits.  Level 0 holds the low chunk of every value; a bitmap
beside it says which values go on, and those have their next chunk in level 1, and so on.
A directory holds the number of set bits before every 512, so the place of a value in the
next level is one directory entry and a count over at most 64 bytes: any token is read
without decoding the others (Brisaboa, Ladra and Navarro, "DACs: bringing direct access to
variable-length codes", 2013).

One segment is a byte string, little-endian throughout::

    4s   b"DAC1"
    u32  number of values
    u32  number of levels
    for each level:  u32 number of chunks
                     chunks, one byte each
                     bitmap of ceil(chunks / 8) bytes, low bit first
                     u32 directory of ceil(chunks / 512) entries

The token file is a Parquet table of segments in ascending document order (``part``, ``first``):
whole documents up to ``SEGMENT`` tokens each, or one longer document.  Being a Spark
table, a task that is lost writes its part again, and readers see committed parts only.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAGIC = b"DAC1"
RANK_BITS = 512
SEGMENT = 1 << 18  # tokens
END = 0  # id after each document
#: Pieces whose ids a task remembers, some 20 MB; beyond it the memory starts afresh.
KNOWN_PIECES = 500_000
SLICE = 4 << 20  # bytes of text that are encoded together
GROUP = 256  # new pieces that go to the tokenizer in one string

SCHEMA = "first long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, codes binary"


# -- codes ---------------------------------------------------------------------------


def encode(values: np.ndarray) -> bytes:
    values = np.asarray(values, np.uint64)
    levels = []
    rest = values
    while True:
        more = rest >= 256
        bitmap = np.packbits(more, bitorder="little")
        words = np.zeros(-(-len(more) // RANK_BITS) * RANK_BITS, bool)
        words[: len(more)] = more
        set_bits = words.reshape(-1, RANK_BITS).sum(axis=1)
        before = np.concatenate([[0], np.cumsum(set_bits)[:-1]]) if len(set_bits) else set_bits
        levels.append(
            struct.pack("<I", len(rest))
            + (rest & np.uint64(255)).astype(np.uint8).tobytes()
            + bitmap.tobytes()
            + before.astype("<u4").tobytes()
        )
        if not more.any():
            break
        rest = rest[more] >> np.uint64(8)
    return MAGIC + struct.pack("<II", len(values), len(levels)) + b"".join(levels)


class Codes:
    """Read access to one segment."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.size, levels = struct.unpack_from("<II", data, 4)
        self.levels, at = [], 12
        for _ in range(levels):
            (n,) = struct.unpack_from("<I", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 4)
            bitmap = np.frombuffer(data, np.uint8, -(-n // 8), at + 4 + n)
            at += 4 + n + len(bitmap)
            before = np.frombuffer(data, "<u4", -(-n // RANK_BITS), at)
            at += 4 * len(before)
            self.levels.append((chunks, bitmap, before))

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, index: int) -> int:
        """One value, from its own chunks only."""
        if not 0 <= index < self.size:
            raise IndexError(index)
        value = 0
        for depth, (chunks, bitmap, before) in enumerate(self.levels):
            value |= int(chunks[index]) << (8 * depth)
            byte, bit = divmod(index, 8)
            if not bitmap[byte] >> bit & 1:
                break
            start = index // RANK_BITS * (RANK_BITS // 8)
            inside = int(np.bitwise_count(bitmap[start:byte]).sum())
            inside += int(bitmap[byte] & ((1 << bit) - 1)).bit_count()
            index = int(before[index // RANK_BITS]) + inside
        return value

    def all(self) -> np.ndarray:
        """Every value, level by level from the last."""
        values = np.zeros(0, np.uint64)
        for chunks, bitmap, _ in reversed(self.levels):
            here = chunks.astype(np.uint64)
            more = np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)
            here[more] |= values << np.uint64(8)
            values = here
        return values


# -- tokenizer -----------------------------------------------------------------------

# A single space before anything but white space begins a piece whatever stands before it,
# so texts can be cut there and every distinct piece encoded once.
_AWKWARD = r" (?:[\x09-\x0d\x1c-\x20\x85]|\p{Z}|\z)"
_CUT = re.compile(r" (?=\S)")


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of runs of ``counts``, one run after the other."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


class Encoder:
    """Ids of whole texts from a byte-level tokenizer, each distinct piece encoded once.

    Known pieces are an Arrow array with their ids in one flat array, so neither a word of
    a text nor a known piece is a Python object.
    """

    def __init__(self, path: str | None):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
        # Added tokens are found in whole texts before these are cut, and only the usual byte-level
        # splitting can be followed piece by piece; other texts and tokenizers are encoded whole.
        settings = json.loads(self.tokenizer.to_str())
        splitter = settings["pre_tokenizer"] or {}
        self.by_pieces = (
            settings["normalizer"] is None
            and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", False)
            and not splitter.get("add_prefix_space", True)
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in settings["added_tokens"])
        )
        self.added = "|".join(re.escape(t["content"]) for t in settings["added_tokens"])
        # In a byte-level vocabulary a token has one character for each byte.
        names = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(names.values()) + 1, np.int64)
        self.n_bytes[list(names.values())] = list(map(len, names))
        self._forget()

    def _forget(self) -> None:
        self.pieces = pa.array([], pa.string())
        self.counts, self.flat = np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(coded), np.fromiter(map(len, coded), np.int64, len(coded))

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and counts of distinct pieces, each behind one space."""
        # A full stop or comma after a letter is a token of its own.
        marked = pc.match_substring_regex(pieces, r"\p{L}[.,]\z")
        words = pc.if_else(marked, pc.utf8_slice_codeunits(pieces, 0, -1), pieces).dictionary_encode()
        some, code = words.dictionary, words.indices.to_numpy()
        # Every word begins with a space, so a string of them is cut as they are alone.
        bounds = pa.array(np.append(np.arange(0, len(some), GROUP), len(some)), pa.int32())
        groups = pc.binary_join(pa.ListArray.from_arrays(bounds, some), " ").to_pylist()
        ids, _ = self._ids([" " + g for g in groups])
        bytes_ = pc.binary_length(some).to_numpy().astype(np.int64) + 1
        stops = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum(bytes_)) + 1
        starts = np.append(0, stops[:-1])
        word_counts = (stops - starts)[code]
        marks = marked.to_numpy(zero_copy_only=False)
        counts = word_counts + marks
        flat = np.empty(counts.sum(), "<u4")
        places = np.cumsum(counts) - counts
        flat[_runs(places, word_counts)] = ids[_runs(starts[code], word_counts)]
        comma = pc.ends_with(pieces, ",").to_numpy(zero_copy_only=False)
        stop_id, comma_id = (self.tokenizer.encode(m).ids[0] for m in ".,")
        flat[(places + word_counts)[marks]] = np.where(comma, comma_id, stop_id)[marks]
        return flat, counts

    def _rows(self, pieces: pa.Array) -> np.ndarray:
        """Where distinct pieces stand among the known ones, learning those that are new."""
        at = pc.index_in(pieces, value_set=self.pieces)
        if len(self.pieces) + at.null_count > KNOWN_PIECES:
            self._forget()
            at = pc.index_in(pieces, value_set=self.pieces)
        new = at.is_null()
        if at.null_count:
            some = pieces.filter(new)
            flat, counts = self._encode(some)
            first = len(self.pieces)
            self.pieces = pa.concat_arrays([self.pieces, some])
            self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])
            rows = pc.fill_null(at, 0).to_numpy().astype(np.int64)
            rows[new.to_numpy(zero_copy_only=False)] = first + np.arange(len(some))
            return rows
        return at.to_numpy().astype(np.int64)

    def _gather(self, pieces: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of rows of pieces, and the number of ids of each row."""
        values, starts = pieces.flatten(), pieces.offsets.to_numpy()[:-1] - pieces.offsets[0].as_py()
        head = np.zeros(len(values), bool)
        head[starts] = True
        head_ids, head_counts = self._ids(values.filter(pa.array(head)).to_pylist())
        tails = values.filter(pa.array(~head)).dictionary_encode()
        rows = self._rows(tails.dictionary)[tails.indices.to_numpy()] if len(tails) else np.zeros(0, np.int64)
        count, source = np.empty((2, len(values)), np.int64)
        count[head], count[~head] = head_counts, self.counts[rows]
        source[head] = len(self.flat) + np.cumsum(head_counts) - head_counts
        source[~head] = (np.cumsum(self.counts) - self.counts)[rows]
        ids = np.concatenate([self.flat, head_ids])[_runs(source, count)]
        return ids, np.add.reduceat(count, starts)

    def _holding(self, texts: pa.Array, pattern: str) -> np.ndarray:
        return pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(bool)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        awkward = self._holding(texts, _AWKWARD)
        whole = self._holding(texts, self.added) if self.added else np.zeros(len(texts), bool)
        if not self.by_pieces:
            whole[:] = True
        result: list = [None] * len(texts)
        if whole.any():
            some = np.nonzero(whole)[0]
            ids, count = self._ids(texts.take(pa.array(some)).to_pylist())
            for row, part in zip(some.tolist(), np.split(ids, np.cumsum(count)[:-1])):
                result[row] = part
        for some, cut in ((np.nonzero(~awkward & ~whole)[0], None), (np.nonzero(awkward & ~whole)[0], _CUT)):
            if len(some):
                chosen = texts.take(pa.array(some))
                if cut is None:
                    pieces = pc.split_pattern(chosen, " ")
                else:
                    pieces = pa.array([cut.split(t) for t in chosen.to_pylist()], pa.list_(pa.string()))
                ids, count = self._gather(pieces)
                for row, part in zip(some.tolist(), np.split(ids, np.cumsum(count)[:-1])):
                    result[row] = part
        return result

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text (null: none), worked off in slices of ``SLICE`` bytes or one longer text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(texts):
            done = size[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(size, done + SLICE, "right")))
            yield from self.encode(texts.slice(lo, hi - lo))
            lo = hi


# -- token file ----------------------------------------------------------------------


def _write(path: str | None, segment: int):
    schema = pa.schema(
        [
            ("first", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
            ("doc_tokens", pa.list_(pa.int64())), ("codes", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        first, held, ids, size = 0, [], [], 0

        def row() -> pa.RecordBatch:
            values = np.concatenate(held)
            columns = [[first], [size], [ids], [[len(h) for h in held]], [encode(values)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
            )

        for batch in batches:
            for doc_id, tokens in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1))):
                if size and size + len(tokens) + 1 > segment:
                    yield row()
                    first, held, ids, size = first + size, [], [], 0
                held.append(np.append(tokens, np.uint32(END)))
                ids.append(doc_id)
                size += len(tokens) + 1
        if size:
            yield row()

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str | None = None, segment: int = SEGMENT,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write the ids of all ``docs``, each followed by id 0, in ascending id order to ``path``.

    ``tokenizer`` is the file of the tokenizers library, on every machine; by default the
    public byte-level one with 50,257 ids.  Null ids come first; null texts are empty; rows
    of one id are ordered by a hash of their text, and equal rows are written as often as
    they occur; other columns are not read; no rows make an empty table.
    """
    order = ["doc_id", "text_hash"]
    (
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
            F.xxhash64(F.col(text_col)).alias("text_hash"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(_write(tokenizer, segment), SCHEMA)
        .withColumn("part", F.spark_partition_id())
        .write.parquet(path)
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for segment in batch.to_pylist():
            values = Codes(segment["codes"]).all().astype("<u4")
            ends = np.cumsum(segment["doc_tokens"])
            starts = ends - segment["doc_tokens"]
            crcs = [zlib.crc32(values[s:e].tobytes()) for s, e in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(segment["doc_ids"], pa.int64()),
                    pa.array(segment["start"] + starts, pa.int64()),
                    pa.array(segment["doc_tokens"], pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a token file with ``start``, the number of tokens before each.

    The running sum is over one row per part.
    """
    rows = spark.read.parquet(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"))
    # One row per part: the broadcast is as small as the number of parts.
    return rows.join(F.broadcast(offsets), "part").withColumn("start", F.col("offset") + F.col("first")).drop("offset")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the file alone."""
    chosen = segments(spark, path).select("start", "doc_ids", "doc_tokens", "codes")
    return chosen.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
