"""Benchmark decontamination by spaced seeds.

A seed mask keeps some positions of a run of tokens and ignores the others, so a seed still
meets its partner when ignored tokens were replaced.  Masks are fixed.  Seeds of the benchmark
meet those of the documents by their hash; every hit names a benchmark item and a shift, and
along each such diagonal the tokens are compared around the hit: an overlap is verified if
some ``least_run`` consecutive item tokens (the whole item, if shorter) agree in at least
``least_share`` of their positions.

The benchmark is the stated query set.  It is worked off in blocks of about ``BLOCK_TOKENS``
tokens: a block's seed table is sent to the tasks, which read all documents in whole texts.  Each
block but a single one is a pass of its own, whose result is written and whose table is given up before the
next one is read, so a larger benchmark takes more passes, not more memory.  Documents are never
shuffled, so a passage that a third of them share costs what its hits cost.

Tokens are runs of word characters, lower-cased.  Items of fewer than ``LEAST_ITEM`` tokens must stand
in a text as a whole, token by token: the seed of their length ignores none.  Defined cases: null and
empty texts have no tokens and no overlap, and neither have items without a token; an item with a
null id is an item, named by null; of items with equal tokens every id is named, and rows of one id and
equal tokens are one; repeated documents get equal results; further columns are kept as they are; an
empty benchmark or table gives no overlaps.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: Fixed masks: 1 is compared, 0 is ignored.
MASKS = ("1101011", "1110010101", "1001110011")
#: For items shorter than ``LEAST_RUN`` too; with it no allowed number of replaced tokens hides all seeds.
SHORT_MASK = "111"
LEAST_RUN = 13
LEAST_SHARE = 0.8
LEAST_ITEM = 8
BLOCK_TOKENS = 1_000_000

_TOKEN = re.compile(r"\w+")
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def seeds(ids: np.ndarray, mask: str, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the seeds of one mask and where they start; unknown tokens (0) give none."""
    care = [i for i, c in enumerate(mask) if c == "1"]
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    known = ids != 0
    usable = known[care[0] : care[0] + n].copy()
    for i in care[1:]:
        usable &= known[i : i + n]
    at = np.nonzero(usable)[0]
    value = np.full(len(at), which + 1, np.uint64)
    for i, factor in zip(care, _MIX):
        value = (value ^ ids[at + i].astype(np.uint64)) * np.uint64(factor)
        value ^= value >> np.uint64(29)
    return value, at


def _masks(length: int) -> list[tuple[int, str]]:
    """Numbers and masks of the seeds of an item: short ones take part as a whole."""
    if length < LEAST_ITEM:
        return [(len(MASKS) + length, "1" * length)]
    return list(enumerate(MASKS if length >= LEAST_RUN else (*MASKS, SHORT_MASK)))


@dataclass(frozen=True)
class Block:
    """Seed table of part of a benchmark: sorted hashes with the item and place of each."""

    vocabulary: dict[str, int]
    items: list[np.ndarray]
    names: list[list[int | None]]  # the ids of the items with these tokens, null last
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray

    @cached_property
    def masks(self) -> list[tuple[int, str]]:
        """Numbers and masks that some item uses."""
        used = {m for item in self.items for m in _masks(len(item))}
        return sorted(used)

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Block:
        named: dict[tuple[str, ...], set[int | None]] = {}
        for name, text in rows:
            if words := tuple(tokens(text)):
                named.setdefault(words, set()).add(name)
        vocabulary: dict[str, int] = {}
        items = [
            np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words], np.int64) for words in named
        ]
        found = []
        for number, ids in enumerate(items):
            for which, mask in _masks(len(ids)):
                value, at = seeds(ids, mask, which)
                found.append((value, np.full(len(at), number), at))
        hashes, item, place = (
            (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
        )
        order = np.argsort(hashes, kind="stable")
        names = [sorted(ids, key=lambda i: (i is None, i)) for ids in named.values()]
        return cls(vocabulary, items, names, hashes[order], item[order], place[order])

    def overlaps(
        self, text: str | None, least_run: int = LEAST_RUN, least_share: float = LEAST_SHARE
    ) -> list[tuple[int | None, int, int, int]]:
        """(item id, first token in the text, tokens compared, tokens equal) of verified overlaps.

        One per item: the run with the most equal tokens, then the first.
        """
        get = self.vocabulary.get
        words = tokens(text)
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        if not len(self.hashes) or not ids.any():
            return []
        diagonals = []
        for which, mask in self.masks:
            value, at = seeds(ids, mask, which)
            lo = np.searchsorted(self.hashes, value, "left")
            count = np.searchsorted(self.hashes, value, "right") - lo
            at, lo, count = at[count > 0], lo[count > 0], count[count > 0]
            hit = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
            diagonals.append(np.stack([self.item[hit], np.repeat(at, count) - self.place[hit]], 1))
        best: dict[int, tuple[int, int, int]] = {}
        for item, shift in np.unique(np.concatenate(diagonals), axis=0).tolist():
            run = self._verified(self.items[item], ids, shift, least_run, least_share)
            if run and (item not in best or (-run[2], run[0]) < (-best[item][2], best[item][0])):
                best[item] = run
        return [(name, *run) for item, run in sorted(best.items()) for name in self.names[item]]

    @staticmethod
    def _verified(item: np.ndarray, ids: np.ndarray, shift: int, least_run: int, least_share: float):
        """The best run of a diagonal, where item token i lies at text token i + shift."""
        run = min(least_run, len(item))
        if len(item) < LEAST_ITEM:
            least_share = 1.0
        first, last = max(0, -shift), min(len(item), len(ids) - shift)
        if last - first < run:
            return None
        equal = np.cumsum(np.append(0, item[first:last] == ids[first + shift : last + shift]))
        inside = equal[run:] - equal[:-run]
        if inside.max() < least_share * run:
            return None
        at = int(inside.argmax())
        return first + shift + at, run, int(inside[at])


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS):
    """The benchmark's seed tables, one bounded block after the other."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    # About six characters to a token; items of equal tokens share a block.
    count = -(-size // (6 * block_tokens))
    for number in range(count):
        plain = F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{M}\p{N}_]+", " "))
        part = rows.filter(F.pmod(F.xxhash64(plain), F.lit(count)) == number) if count > 1 else rows
        yield Block.of([tuple(r) for r in part.collect()])


def _passes(docs: DataFrame, benchmark: DataFrame, step: Callable[[Broadcast], DataFrame]) -> Iterator[DataFrame]:
    """What ``step`` makes of each block's seed table; of several, each is staged and its table given up."""
    several = False
    last = None
    for block in blocks(benchmark):
        if last is not None:
            several = True
            yield _given_up(step, last)
        last = docs.sparkSession.sparkContext.broadcast(block)
    if last is not None:
        yield _given_up(step, last) if several else step(last)


def _given_up(step: Callable[[Broadcast], DataFrame], table: Broadcast) -> DataFrame:
    found = stage(step(table), "overlaps")
    table.destroy()
    return found


def overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits
) -> DataFrame:
    """(doc_id, item_id, at, compared, equal): verified overlaps of all documents with all items."""
    schema = "doc_id long, item_id long, at long, compared long, equal long"
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))

    def found_by(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = [
                    (doc, *overlap)
                    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for overlap in shared.value.overlaps(text.as_py(), **limits)
                ]
                columns = zip(*hits) if hits else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "at", "compared", "equal"]
                )

        return rows.mapInArrow(run, schema)

    found = list(_passes(docs, benchmark, found_by))
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """``docs`` without those that have a verified overlap with any item."""
    at = docs.columns.index(text_col)

    kept = docs

    def clean(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [not shared.value.overlaps(text.as_py(), **limits) for text in batch.column(at)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return kept.mapInArrow(run, docs.schema)

    for kept in _passes(docs, benchmark, clean):
        pass
    return kept
