"""Near-duplicate documents by SimHash and an exact tiled comparison of fingerprints.

Fingerprints are compared once per distinct value.  They are sorted by the population
counts of their four 16-bit quarters and cut in tiles; two fingerprints within ``radius``
bits differ by at most ``radius`` in the sum of those counts, so a pair of tiles whose
count ranges lie further apart is never made.  The rest is compared bit for bit with
numpy, block by block under the same bound.  A pair of tiles gives the spanning links of
its groups, not all pairs of a group.

The comparison is exact and so grows with the square of the number of distinct
fingerprints, divided by what the counts rule out; it holds two tiles at a time.

Defined cases: null and empty texts have fingerprint zero and are linked like any other;
a null id is never the name of a group unless the group has no other; equal rows share
fingerprint and group; further columns are ignored (``near_duplicates``) or kept
(``drop_near_duplicates``); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import stage
from .common import free_names, row_key, word_spans

SEED = 42
TILE = 2048  # fingerprints in a tile: 16 kB; a pair of tiles is 4 million comparisons
BLOCK = 128  # rows of a tile that are compared at once
QUARTERS = ("p0", "p1", "p2", "p3")


def fingerprint(data: bytes | None, shingle: int) -> int:
    """The 64-bit SimHash of a text: majority bits of the hashes of its word shingles."""
    words, starts, ends = word_spans((data or b"").lower())
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    digest = xxhash.xxh64_intdigest
    total = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    first, last = starts[:total].tolist(), ends[shingle - 1 :].tolist()
    for lo in range(0, total, 8192):
        hashes = np.array(
            [digest(joined[s:e], SEED) for s, e in zip(first[lo : lo + 8192], last[lo : lo + 8192])],
            "<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row key, fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            prints = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))],
                names=["id", "row", "fp"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text")
    )
    return rows.mapInArrow(run, "id long, row long, fp long")


def _pack(tile: int):
    """Cut a sorted partition in tiles: count ranges and the fingerprints as bytes."""

    def row(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        prints = np.concatenate([p for p, _ in held])
        counts = np.concatenate([c for _, c in held])
        low, high = counts.min(axis=0).tolist(), counts.max(axis=0).tolist()
        return pa.RecordBatch.from_pydict(
            {"low": [low], "high": [high], "data": [prints.astype("<i8").tobytes()]},
            schema=pa.schema([("low", pa.list_(pa.int32())), ("high", pa.list_(pa.int32())), ("data", pa.binary())]),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            counts = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5)], 1)
            at = 0
            while at < len(prints):
                take = min(tile - size, len(prints) - at)
                held.append((prints[at : at + take], counts[at : at + take]))
                size, at = size + take, at + take
                if size == tile:
                    yield row(held)
                    held, size = [], 0
        if size:
            yield row(held)

    return run


def _quarter_counts(prints: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints.view("<u2").reshape(-1, 4)).astype(np.int64)


def _ranges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.arange(0, len(counts), BLOCK)
    return np.minimum.reduceat(counts, starts), np.maximum.reduceat(counts, starts)


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever lies within ``radius`` bits between two tiles.

    Every fingerprint is linked to the least of its group inside the two tiles, so the
    number of links is at most the number of fingerprints.
    """
    a_low, a_high = _ranges(_quarter_counts(a))
    b_low, b_high = _ranges(_quarter_counts(b))
    gaps = np.maximum(a_low[:, None] - b_high[None], b_low[None] - a_high[:, None]).clip(0).sum(2)
    left, right = [], []
    for i, j in zip(*np.nonzero(gaps <= radius)):
        x, y = a[i * BLOCK : (i + 1) * BLOCK], b[j * BLOCK : (j + 1) * BLOCK]
        at, to = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= radius)
        left.append(x[at])
        right.append(y[to])
    if not left:
        return a[:0], a[:0]
    u, v = np.concatenate(left), np.concatenate(right)
    differ = u != v
    nodes, ends = np.unique(np.concatenate([u[differ], v[differ]]), return_inverse=True)
    u, v = ends[: len(ends) // 2], ends[len(ends) // 2 :]
    label = np.arange(len(nodes))
    while True:  # each round halves the distance to the least label at least
        after = label.copy()
        np.minimum.at(after, u, label[v])
        np.minimum.at(after, v, label[u])
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1)):
                a, b = (np.frombuffer(x.as_buffer(), "<u8") for x in (a, b))
                u, v = tile_links(a, b, radius)
                if len(u):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"]
                    )

    return run


def similar_prints(prints: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links (u, v) connecting the distinct fingerprints ``fp`` that lie within ``radius`` bits."""
    quarter = [
        F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long"))).alias(q)
        for i, q in enumerate(QUARTERS)
    ]
    order = [*QUARTERS, "fp"]
    tiles = stage(
        prints.select("fp", *quarter)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_pack(tile), "low array<int>, high array<int>, data binary")
        .withColumn("tile", F.monotonically_increasing_id()),
        "tiles",
    )
    ends = tiles.select("tile", "low", "high")
    # The counts of the first two quarters are the join key; a pair of tiles meets at the
    # least key that both ranges hold, and so once.
    a = ends.select(F.col("tile").alias("a"), F.col("low").alias("al"), F.col("high").alias("ah"))
    b = ends.select(F.col("tile").alias("b"), F.col("low").alias("bl"), F.col("high").alias("bh"))
    for i, k in enumerate(("k0", "k1")):
        a = a.withColumn(k, F.explode(F.sequence(F.col("al")[i], F.col("ah")[i])))
        b = b.withColumn(k, F.explode(F.sequence(F.col("bl")[i] - radius, F.col("bh")[i] + radius)))
    gap = sum(
        F.greatest(F.col("al")[i] - F.col("bh")[i], F.col("bl")[i] - F.col("ah")[i], F.lit(0))
        for i in range(4)
    )
    meet = [a[k] == b[k] for k in ("k0", "k1")]
    first = [a[k] == F.greatest(F.col("al")[i], F.col("bl")[i] - radius) for i, k in enumerate(("k0", "k1"))]
    pairs = a.join(b, [*meet, *first, F.col("a") <= F.col("b"), gap <= radius]).select("a", "b")
    left = tiles.select(F.col("tile").alias("a"), F.col("data").alias("x"))
    right = tiles.select(F.col("tile").alias("b"), F.col("data").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("x", "y")
    return both.mapInArrow(_compare(radius), "u long, v long")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, row, fp, component, first_row): groups of linked fingerprints, named by their least id.

    ``shingle`` words make a shingle; fingerprints link at ``radius`` or fewer differing
    bits.  ``first_row`` is the row key of the least row of the group.
    """
    rows = stage(fingerprints(docs, shingle, id_col, text_col), "prints")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    prints = stage(rows.groupBy("fp").agg(least.alias("least")), "distinct-prints")
    links = connected_components(stage(similar_prints(prints.select("fp"), radius), "print-links"))
    of = prints.join(links.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("group"), "least"
    )
    named = of.groupBy("group").agg(F.min("least").alias("first"))
    groups = of.select("fp", "group").join(named, "group").select("fp", "first")
    return rows.join(groups, "fp").select(
        "id", "row", "fp", F.col("first.id").alias("component"), F.col("first.row").alias("first_row")
    )


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document of each group: the one with the least id.

    Rows equal in id and text count as one document, of which one row stays.
    """
    key, kept_id = free_names(docs, "row_key", "kept_id")
    kept = (
        near_duplicates(docs, shingle, radius, id_col, text_col)
        .filter((F.col("row") == F.col("first_row")) & F.col("id").eqNullSafe(F.col("component")))
        .select(F.col("row").alias(key), F.col("id").alias(kept_id))
        .distinct()
    )
    keyed = docs.withColumn(key, row_key(id_col, text_col))
    met = [keyed[key] == kept[key], keyed[id_col].cast("long").eqNullSafe(kept[kept_id])]
    return keyed.join(kept, met, "left_semi").dropDuplicates([key, id_col]).select(*docs.columns)
