"""An inverted index that finds the text pairs of a block whose score can pass a threshold.

The items of a text are its bytes, told apart by occurrence (first 'e', second 'e', ...), in one order
for all texts, rarest first.  With M matched bytes a Jaro-Winkler score above t needs
M > share * la * lb / (la + lb), where ``share`` depends on t and on the common first bytes.  Two
texts with so many common items share one within their prefixes of ``length - M + 1`` items,
so texts meet on the items of their prefixes only, and no pair that passes is lost.

A pair has one of three kinds by its first bytes, each with the share it needs: the first four bytes are equal
(they are part of the key), only the first one is sure (so is it), or the first one differs.
A text plays two parts, the shorter of a pair and the longer one, since the shorter has the shorter
prefix.  So a pair meets under one kind and with one text in each part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.similarity import PREFIX_WEIGHT, SIGNATURE_COLUMNS, byte_rows, could_exceed
from ..session import stage
from .joins import split_hot_keys
from .shape import stack

OCCURRENCES = 256  # further occurrences of a byte count as one item, which is taken for the rarest
_SLOTS = 256 * OCCURRENCES
ANY, FIRST, FOUR = 0, 1, 2  # kinds of pairs: first byte differs, is equal, all four are
POSTINGS_ROWS = 8192  # of one item of a block that meet in a task, per side
SLICE_BYTES = 128 << 10  # of text that is worked off together; a byte makes about two postings


def share_needed(kind: int, threshold: float) -> float:
    """M (1/la + 1/lb) must exceed this for a pair of the kind."""
    boost = {ANY: 0, FIRST: 3, FOUR: 4}[kind] * PREFIX_WEIGHT
    return 3 * (threshold - boost) / (1 - boost) - 1 - 1e-9


def prefix_sizes(sizes: np.ndarray, share: float, shorter: bool) -> np.ndarray:
    """Items of the prefix of texts of ``sizes`` bytes, partners being at least or at most as long.

    The shorter one needs M > share / 2 times its length, whatever the partner.  A partner
    of the longer one has more than (share - 1) times its length, and so has M.
    """
    least = np.floor(sizes * (share / 2 if shorter else share - 1) - 1e-9).astype(np.int64) + 1
    return sizes - np.clip(least, 1, sizes + 1) + 1


def _items(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and slot (byte value, occurrence) of every byte, and the byte lengths."""
    rows, values, lengths = byte_rows(texts)
    order = np.argsort(rows * 256 + values, kind="stable")
    group = (rows * 256 + values)[order]
    new = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    nth = np.arange(len(group)) - np.repeat(new, np.diff(np.append(new, len(group))))
    slot = np.where(nth < OCCURRENCES, (group % 256) * OCCURRENCES + nth, -1)
    return group // 256, slot, lengths


def _slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with ``SLICE_BYTES`` of text, or one longer text."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False))
        low = 0
        while low < batch.num_rows:
            done = sizes[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, "right")))
            yield batch.slice(low, high - low)
            low = high


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_SLOTS, np.int64)
    for batch in _slices(batches, "_text"):
        slots = _items(batch.column(0))[1]
        total += np.bincount(slots[slots >= 0], minlength=_SLOTS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["slot", "n"])


def item_ranks(*texts: DataFrame) -> np.ndarray:
    """Rank of every slot by its number of texts, from 1 for the rarest.

    Each task counts into a table of ``_SLOTS`` numbers, which also bounds what the driver reads.
    """
    every = stack(*[t.select("_text") for t in texts])
    counts = every.mapInArrow(_count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    n = np.zeros(_SLOTS, np.int64)
    for row in counts.collect():
        n[row.slot] = row.n
    ranks = np.empty(_SLOTS, np.int64)
    ranks[np.lexsort((np.arange(_SLOTS), n))] = np.arange(1, _SLOTS + 1)
    return ranks


def _post(ranks: np.ndarray, threshold: float, left: bool):
    """Rows of id, text and head become postings (id, key); equal texts of a side are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, "_text"):
            rows, slots, sizes = _items(batch.column("_text"))
            rank = np.where(slots >= 0, ranks[slots], 0)
            order = np.lexsort((rank, rows))
            rows, rank = rows[order], rank[order]
            nth = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            head = batch.column("head").to_numpy(zero_copy_only=False).astype(np.int64) & 0xFFFFFFFF
            lead = {ANY: np.zeros_like(head), FIRST: head >> 24, FOUR: head}
            at, keys = [], []
            for kind in (ANY, FIRST, FOUR):
                share = share_needed(kind, threshold)
                for shorter in (True, False):
                    chosen = nth < prefix_sizes(sizes, share, shorter)[rows]
                    # Who is the shorter one: the left text or the right one.
                    part = 2 * kind + (shorter == left)
                    # A text's rarest items beyond the table share rank 0 and post once.
                    first = np.append(True, (rows[1:] != rows[:-1]) | (rank[1:] != rank[:-1])) if len(rows) else chosen
                    chosen &= first
                    at.append(rows[chosen])
                    keys.append((part << 49) | (rank[chosen] << 32) | lead[kind][rows[chosen]])
            take = pa.array(np.concatenate(at))
            columns = [c.take(take) for c, name in zip(batch.columns, batch.schema.names) if name != "_text"]
            names = [name for name in batch.schema.names if name != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.concatenate(keys), pa.int64())], names=[*names, "_key"]
            )

    return run


def postings(texts: DataFrame, block: Sequence[str], ranks: np.ndarray, threshold: float, left: bool) -> DataFrame:
    """(block, _id, sketch, _key): one row for every item of a text's prefixes."""
    rows = texts.select(*block, "_id", *SIGNATURE_COLUMNS, "_text")
    fields = [f for f in rows.schema.fields if f.name != "_text"]
    return rows.mapInArrow(_post(ranks, threshold, left), T.StructType([*fields, T.StructField("_key", T.LongType())]))


def _kind(head_a: Column, head_b: Column) -> Column:
    differing = head_a.bitwiseXOR(head_b)
    return (
        F.when(differing == 0, FOUR).when(F.shiftrightunsigned(differing, 24) == 0, FIRST).otherwise(ANY)
    )


def meetings(a: DataFrame, b: DataFrame, block: Sequence[str]) -> DataFrame:
    """(block, _meetings): how often postings of both sides would meet, from their counts by item."""
    keys = [*block, "_key"]
    left = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("_a"))
    right = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("_b"))
    return left.join(right, keys).groupBy(*block).agg(F.sum(F.col("_a") * F.col("_b")).alias("_meetings"))


def candidates(
    a: DataFrame, b: DataFrame, block: Sequence[str], threshold: float, rows: int = POSTINGS_ROWS
) -> DataFrame:
    """(block, _id_a, _id_b): pairs of texts that meet on an item and may pass, each once.

    ``a`` and ``b`` are postings; an item with more than ``rows`` of them is split over tasks.
    """

    def named(df: DataFrame, suffix: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in ("_id", *SIGNATURE_COLUMNS)})

    left, right, keys = split_hot_keys(
        named(a, "a"), named(b, "b"), [*block, "_key"], F.col("_id_a"), F.col("_id_b"), rows
    )
    part = F.shiftright("_key", 49)
    left_is_shorter = F.col("size_a") <= F.col("size_b")
    same_kind = F.shiftright(part, 1) == _kind(F.col("head_a"), F.col("head_b"))
    met = left.join(right, keys).filter(
        (part.bitwiseAND(1) == left_is_shorter.cast("long")) & same_kind & could_exceed("a", "b", threshold)
    )
    return met.select(*block, "_id_a", "_id_b").distinct()


def staged_postings(
    texts_a: DataFrame, texts_b: DataFrame, block: Sequence[str], threshold: float
) -> tuple[DataFrame, DataFrame]:
    ranks = item_ranks(texts_a, texts_b)
    return (
        stage(postings(texts_a, block, ranks, threshold, True), "postings"),
        stage(postings(texts_b, block, ranks, threshold, False), "postings"),
    )
