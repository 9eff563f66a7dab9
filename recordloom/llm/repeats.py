"""Remove repeated word sequences by compacted de Bruijn paths.

Windows of ``WINDOW`` consecutive words are the edges of a de Bruijn graph over the corpus.
Documents are cut in blocks by ranges of their id, so that an earlier occurrence lies in an
earlier block or earlier in the same one.  Blocks exchange their distinct edges
(``exchange``); every edge that an earlier block holds is answered with its source
coordinate, the block and word where it first occurs.  Along a document, edges whose sources
follow one another word by word form a nonbranching path and compact to one span with one source
coordinate: where the graph branches, the sources jump and the path ends.  Distinct spans
are joined with the blocks of their sources, and there an independent hash of every edge on
the way verifies the whole span.  Edges are 64-bit hashes, so of n windows about n^2 / 2^65 pairs share
one.  A span over such a pair is refuted; then the next pass gives the hashes on its way a
hash of the next level, and only texts under these are looked at with other eyes.  Passes end when
no span is refuted, at any size; a second one is to be expected from some 10^10 windows on.

Every word under a window that also starts earlier (smaller id, or same document and earlier
start) is removed; windows are judged on the input.

Defined cases: null and empty texts have no words; rows of one id are ordered by a hash of
their text and count as documents one after the other, equal rows included; a null id comes
before all others; texts of fewer than ``WINDOW`` words lose nothing; further columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import exchange as X

WINDOW = 20
KEY_BITS = 64


@dataclass(frozen=True)
class Avoid:
    """Keys that two different windows shared, by the pass that found them; as few as collisions are."""

    bits: int = KEY_BITS
    keys: tuple[np.ndarray, ...] = ()


class Edges:
    """The words of a block, in order of its documents, and the windows over them."""

    def __init__(self, docs: pa.Table, avoid: Avoid, window: int):
        self.docs = docs.sort_by([("place", "ascending"), ("text_hash", "ascending")])
        self.window, self.avoid = window, avoid
        self.words = X.words_of(self.docs.column("text"), lower=False)
        code, ends = self.words.code, self.words.ends
        sizes = ends - self.words.starts
        left = np.repeat(ends, sizes) - np.arange(len(code))  # words up to the document's end
        self.start = np.nonzero(left >= window)[0]  # ordinals of the windows

    @cached_property
    def _hashes(self) -> np.ndarray:
        return self.words.hashes(0)

    def _rolled(self, level: int, which: int) -> np.ndarray:
        hashes = self.words.hashes(level) if level else self._hashes
        word = X.scramble(hashes[:, which])[self.words.code]
        value = np.zeros(len(self.start), np.uint64)
        for i in range(self.window):
            value *= np.uint64(0x9E3779B97F4A7C15)
            value += word[self.start + i]
        return X.scramble(value)

    @cached_property
    def key(self) -> np.ndarray:
        """A hash of each window, of the next level where that of one level is to be avoided."""
        mask = np.uint64((1 << 64) - (1 << (64 - self.avoid.bits)))
        value = self._rolled(0, 0) & mask
        for level, keys in enumerate(self.avoid.keys, 1):
            hit = np.isin(value, keys)
            if hit.any():
                value[hit] = (self._rolled(level, 0) & mask)[hit]
        return value

    @cached_property
    def check(self) -> np.ndarray:
        """Another hash of each window, independent of the key."""
        return self._rolled(0, 1)

    @cached_property
    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys in order, the first window of each, and the number of each window's key."""
        return np.unique(self.key, return_index=True, return_inverse=True)

    @property
    def keys(self) -> np.ndarray:
        return self.distinct[0]

    @property
    def first(self) -> np.ndarray:
        return self.distinct[1]

    @property
    def number(self) -> np.ndarray:
        return self.distinct[2]

    def cuts(self, buckets: int) -> list[int]:
        """Where the distinct keys of each bucket begin, and the end."""
        return [0, *np.searchsorted(self.keys, X.bucket_bounds(buckets)).tolist(), len(self.keys)]


REQUEST = "bucket int, block int, size int, keys binary, ordinals binary"
ANSWER = "bucket int, block int, size int, which binary, source_block binary, source_ordinal binary"
FOUND = (
    "doc_id long, n_words long, n_removed long, kept_sha256 string, "
    "start long, words long, block int, source_block int, source_ordinal long, check long"
)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _requests(buckets: int, avoid: Avoid, window: int):
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        edges = Edges(docs, avoid, window)
        ordinal = edges.start[edges.first].astype(np.uint64)
        cuts = edges.cuts(buckets)
        rows = [
            (b, key[0].as_py(), hi - lo, X.pack_sorted(edges.keys[lo:hi]), X.pack(ordinal[lo:hi]))
            for b, (lo, hi) in enumerate(zip(cuts, cuts[1:]))
            if hi > lo
        ]
        return _table(rows, REQUEST)

    return run


def _answer(key: tuple, requests: pa.Table) -> pa.Table:
    """For each block, the keys of a bucket that an earlier block holds, with their first place."""
    rows = requests.sort_by("block").to_pylist()
    sizes = [r["size"] for r in rows]
    keys = np.concatenate([X.unpack_sorted(r["keys"], r["size"]) for r in rows])
    ordinal = np.concatenate([X.unpack(r["ordinals"], r["size"]) for r in rows])
    block = np.repeat(np.array([r["block"] for r in rows], np.uint64), sizes)
    _, first, number = np.unique(keys, return_index=True, return_inverse=True)
    source = first[number]  # blocks ascend, so the first is the earliest
    answers = []
    for r, hi in zip(rows, np.cumsum(sizes).tolist()):
        lo = hi - r["size"]
        which = np.nonzero(source[lo:hi] < lo)[0]
        if len(which):
            at = source[lo:hi][which]
            answers.append(
                (key[0].as_py(), r["block"], len(which), X.pack_sorted(which.astype(np.uint64)), X.pack(block[at]), X.pack(ordinal[at]))
            )
    return _table(answers, ANSWER)


def _resolve(buckets: int, avoid: Avoid, window: int):
    """Per document what stays and its digest; per compacted path its span, source and check."""

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        me = key[0].as_py()
        edges = Edges(docs, avoid, window)
        source_block = np.full(len(edges.keys), me, np.int64)
        source = edges.start[edges.first].astype(np.int64)
        cuts = edges.cuts(buckets)
        for a in answers.to_pylist():
            at = cuts[a["bucket"]] + X.unpack_sorted(a["which"], a["size"]).astype(np.int64)
            source_block[at] = X.unpack(a["source_block"], a["size"])
            source[at] = X.unpack(a["source_ordinal"], a["size"])
        from_block, origin = source_block[edges.number], source[edges.number]
        again = (from_block != me) | (origin != edges.start)
        start, from_block, origin, check = (v[again] for v in (edges.start, from_block, origin, edges.check))
        # Words under a repeated window.
        n = len(edges.words.code)
        cover = np.zeros(n + window + 1, np.int64)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + window, -1)
        removed = np.cumsum(cover)[:n] > 0
        ends = edges.words.ends
        kept_before = np.append(0, np.cumsum(~removed))
        kept_ends = kept_before[ends]
        kept_words = edges.words.distinct.cast(pa.large_binary()).take(pa.array(edges.words.code[~removed]))
        lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, kept_ends), pa.int64()), kept_words)
        joined = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))
        sizes = ends - edges.words.starts
        kept = np.diff(kept_ends, prepend=0)
        doc_id = edges.docs.column("doc_id").to_pylist()
        rows = [
            (i, size, size - k, hashlib.sha256(text.as_buffer()).hexdigest(), *[None] * 6)
            for i, size, k, text in zip(doc_id, sizes.tolist(), kept.tolist(), joined)
        ]
        # Nonbranching paths: the next window is the next word here and at the source, in one document.
        doc = np.searchsorted(ends, start, "right")
        follows = (np.diff(start) == 1) & (np.diff(origin) == 1) & (np.diff(from_block) == 0) & (np.diff(doc) == 0)
        begin = np.nonzero(np.append(True, ~follows))[0] if len(start) else np.zeros(0, np.int64)
        length = np.diff(np.append(begin, len(start)))
        sums = np.add.reduceat(check, begin).view(np.int64) if len(begin) else np.zeros(0, np.int64)
        place = start[begin] - edges.words.starts[doc[begin]]
        rows += [
            (doc_id[d], None, None, None, s, w, me, b, o, c)
            for d, s, w, b, o, c in zip(
                doc[begin].tolist(), place.tolist(), (length + window - 1).tolist(),
                from_block[begin].tolist(), origin[begin].tolist(), sums.tolist(),
            )
        ]
        return _table(rows, FOUND)

    return run


def _refuted(avoid: Avoid, window: int):
    """Keys on the way of spans whose words differ from those at their source."""

    def run(key: tuple, docs: pa.Table, paths: pa.Table) -> pa.Table:
        wrong = np.zeros(0, np.uint64)
        if paths.num_rows:
            edges = Edges(docs, avoid, window)
            position = np.full(len(edges.words.code) + 1, -1, np.int64)
            position[edges.start] = np.arange(len(edges.start))
            total = np.append(np.uint64(0), np.cumsum(edges.check, dtype=np.uint64))
            at = position[paths.column("source_ordinal").to_numpy()]
            last = at + paths.column("words").to_numpy() - window + 1
            sums = (total[last] - total[at]).view(np.int64)
            bad = np.flatnonzero(sums != paths.column("check").to_numpy())
            if len(bad):
                wrong = np.unique(np.concatenate([edges.key[at[i] : last[i]] for i in bad.tolist()]))
        return pa.table({"wrong": pa.array(wrong.view(np.int64), pa.int64())})

    return run


def range_number(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are not above ``value``: coarse steps, then one step."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    every = F.array(*[F.lit(b) for b in bounds])
    coarse = F.size(F.filter(F.array(*[F.lit(b) for b in bounds[::step]]), lambda b: b <= value))
    fine = F.size(F.filter(F.slice(every, (coarse - 1) * step + 1, step), lambda b: b <= value))
    return F.when(value < bounds[0], F.lit(0)).otherwise((coarse - 1) * step + fine)


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = X.BLOCK_BYTES, bucket_keys: int = X.BUCKET_KEYS, key_bits: int = KEY_BITS,
) -> DataFrame:
    """The staged table of ``FOUND``: rows with ``n_words`` are documents, the others spans.

    A span is ``words`` words from ``start`` on of a document; its source coordinate is the
    block and the ordinal of the word in the block.  All spans are verified.
    """
    spark = docs.sparkSession
    size = X.text_bytes(docs, text_col)
    blocks, buckets = X.blocks_for(size, block_bytes), X.buckets_for(size, bucket_keys)
    place = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    cut = [i / blocks for i in range(1, blocks)]
    bounds = docs.select(place.alias("place")).agg(F.percentile_approx("place", cut, 100 * blocks)).first()[0] if cut else []
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        place.alias("place"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("text_hash"),
        range_number(place, sorted(set(bounds or []))).cast("int").alias("block"),
    )
    avoid = Avoid(key_bits)
    while True:
        requests = rows.groupBy("block").applyInArrow(_requests(buckets, avoid, window), REQUEST)
        answers = stage(requests.groupBy("bucket").applyInArrow(_answer, ANSWER), "edge-sources")
        X.free_shuffles(spark)
        found = stage(
            rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_resolve(buckets, avoid, window), FOUND),
            "repeats",
        )
        X.free_shuffles(spark)
        paths = found.filter("n_words IS NULL").select(
            F.col("source_block").alias("block"), "source_ordinal", "words", "check"
        )
        checked = rows.groupBy("block").cogroup(paths.distinct().groupBy("block"))
        wrong = checked.applyInArrow(_refuted(avoid, window), "wrong long").distinct().collect()
        X.free_shuffles(spark)
        if not wrong:
            return found
        avoid = replace(avoid, keys=(*avoid.keys, np.array(sorted(r.wrong for r in wrong), np.int64).view(np.uint64)))


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    found = repeated_spans(docs, window, id_col, text_col, **sizes)
    return found.filter("n_words IS NOT NULL").select("doc_id", "n_words", "n_removed", "kept_sha256")


#: The same by window texts: a window goes if its text stands earlier in the order of documents.
REPEATS_SQL = """
    WITH words AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS words
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words)
    ),
    later AS (
        SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) AS nth FROM windows)
        WHERE nth > 1
    ),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
    kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
        FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words) ANTI JOIN gone USING (doc_id, i)
        GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)
"""
