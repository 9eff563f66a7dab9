"""Jaro-Winkler over UTF-8 bytes, and an exact bound on it that Spark evaluates natively.

Spark has no Jaro-Winkler.  The score is therefore an Arrow function, and a cheap
upper bound made of built-in integer operations decides inside the join which
pairs reach it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import as_column

# Fixed values of the Winkler boost.
PREFIX_LIMIT = 4
PREFIX_WEIGHT = 0.1
BOOST_ABOVE = 0.7

_WORDS = 4  # 256 signature bits
_BLOCK_BYTES = 1 << 18  # text bytes scored at a time, per side
_PART_BYTES = 1 << 24  # text bytes of the pairs whose texts are sorted together
_PART_PAIRS = 1 << 14
_LONG = 1 << 12  # bytes; pairs with a longer text are scored one by one
_GROUP_PAIRS = 8  # pairs of a text, from which on they are scored as rows of a matrix
_CELLS = 1 << 21  # pairs times bytes of their longer text that are scored at a time


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte buffer, start offsets and byte lengths of a string array; NULL has length 0."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets[:-1], np.diff(offsets)


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and value of every byte of a string array, and the byte lengths."""
    raw, starts, lengths = _bytes_of(column)
    first = int(starts[0]) if len(column) else 0
    values = raw[first : first + int(lengths.sum())].astype(np.int64)
    return np.repeat(np.arange(len(column)), lengths), values, lengths


def _matrix(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte rows padded to a common width with 255, which no UTF-8 text contains."""
    width = max(int(lengths.max(initial=0)), 1)
    at = np.arange(width)
    inside = at < lengths[:, None]
    out = np.full((len(starts), width), 255, np.uint8)
    out[inside] = raw[(starts[:, None] + at)[inside]]
    return out


class _Texts:
    """Distinct texts as flat arrays, one entry per byte: what the pairs of a text share is made once.

    ``nth`` counts the equal bytes before a byte; ``order`` holds the positions of a text by byte value, where
    those of a value begin at ``begins`` and number ``counts`` (both by text and value).
    """

    def __init__(self, column: pa.Array):
        raw, starts, lengths = _bytes_of(column)
        first, n = int(starts[0]) if len(starts) else 0, len(lengths)
        self.lengths, self.starts = lengths, starts - first
        self.values = raw[first : first + int(lengths.sum())].astype(np.int64)
        self.order, self.nth = np.zeros((2, len(self.values) + 1), np.int64)
        self.begins, self.counts = np.zeros((2, n, 256), np.int32)
        sorted_ = np.argsort(lengths, kind="stable")
        done = int(np.searchsorted(lengths[sorted_], 0, "right"))
        while done < n:
            size = lengths[sorted_[done]]
            similar = int(np.searchsorted(lengths[sorted_], 2 * size, side="right"))
            block = sorted_[done : min(similar, done + max(_BLOCK_BYTES // int(2 * size), 1))]
            self._sort(block, _matrix(raw, starts[block], lengths[block]))
            done += len(block)

    def _sort(self, texts: np.ndarray, m: np.ndarray) -> None:
        lengths = self.lengths[texts]
        counts = np.bincount((np.arange(len(m))[:, None] * 256 + m).ravel(), minlength=len(m) * 256).reshape(-1, 256)
        begins = np.cumsum(counts, axis=1) - counts
        counts[:, 255] = 0  # the padding, which comes last in the order
        inside = np.flatnonzero(np.arange(m.shape[1]) < lengths[:, None])
        order = np.argsort(m, axis=1, kind="stable").ravel().take(inside)
        before = np.cumsum(lengths) - lengths
        flat = np.arange(len(order)) + np.repeat(self.starts[texts] - before, lengths)
        own = np.repeat(self.starts[texts], lengths) + order
        begin = begins.ravel().take(np.repeat(np.arange(len(m)) * 256, lengths) + self.values.take(own))
        self.order[flat] = order
        self.nth[own] = np.arange(len(order)) - np.repeat(before, lengths) - begin
        self.counts[texts], self.begins[texts] = counts, begins


def _merge(
    pair: np.ndarray, value: np.ndarray, texts: _Texts, a: np.ndarray, b: np.ndarray, window: np.ndarray,
    off_a: np.ndarray, off_b: np.ndarray, hit_a: np.ndarray, hit_b: np.ndarray,
) -> None:
    """Set the hits of some (pair, byte value) by the greedy rule, all of them one occurrence at a time."""
    sizes = texts.counts[a[pair], value]
    largest = np.argsort(-sizes, kind="stable")
    pair, value, sizes = pair[largest], value[largest], sizes[largest]
    at_a = texts.starts[a[pair]] + texts.begins[a[pair], value]
    at_b = texts.starts[b[pair]] + texts.begins[b[pair], value]
    end_b = at_b + texts.counts[b[pair], value]
    reach, row_a, row_b = window[pair], off_a[pair], off_b[pair]
    order = texts.order  # one entry more, read past the last group and never used
    for k in range(int((end_b - at_b).max())):
        some = np.flatnonzero(at_b + k < end_b)
        hit_b[row_b[some] + order[at_b[some] + k]] = False
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes.max()), "right")
    for k, live in enumerate(active):
        i = order[at_a[:live] + k]
        at, end = at_b[:live], end_b[:live]
        low = i - reach[:live]
        behind = np.flatnonzero((at < end) & (order[at] < low))
        while len(behind):
            at[behind] += 1
            behind = behind[(at[behind] < end[behind]) & (order[at[behind]] < low[behind])]
        j = order[at]
        hit = (at < end) & (j <= i + reach[:live])
        hit_a[row_a[:live] + i] = hit
        hit_b[(row_b[:live] + j)[hit]] = True
        at += hit


def _jaro_winkler_block(texts: _Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scores of pairs (a, b) of non-empty texts.

    Greedy matching pairs equal bytes only, so each (pair, byte value) is a merge of two ascending
    position lists.  Where the first, second, ... occurrences on both sides lie within the window of each
    other, the merge pairs just these, and a byte is a hit if the other side has as many of its
    value.  Only the other groups are merged step by step.
    """
    n = len(a)
    la, lb = texts.lengths[a], texts.lengths[b]
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    counts, begins = texts.counts.ravel(), texts.begins.ravel()

    def side(own: np.ndarray, other: np.ndarray, lengths: np.ndarray):
        off = np.cumsum(lengths) - lengths
        source = np.arange(int(lengths.sum())) + np.repeat(texts.starts[own] - off, lengths)
        values = texts.values.take(source)
        cells = np.repeat(other * 256, lengths) + values
        nth = texts.nth.take(source)
        return off, values, cells, nth, nth < counts.take(cells)

    off_a, values_a, cells, nth, hit_a = side(a, b, la)
    off_b, values_b, _, _, hit_b = side(b, a, lb)

    at = np.flatnonzero(hit_a)
    matches = np.add.reduceat(hit_a, off_a, dtype=np.int64)
    partner = begins.take(cells.take(at)) + nth.take(at) + np.repeat(texts.starts[b], matches)
    distance = texts.order.take(partner) - at + np.repeat(off_a, matches)
    far = np.flatnonzero(np.abs(distance) > np.repeat(window, matches))
    if len(far):
        groups = np.zeros(n * 256, bool)
        groups[np.repeat(np.arange(n) * 256, matches).take(far) + values_a.take(at.take(far))] = True
        pair, value = np.divmod(np.flatnonzero(groups), 256)
        _merge(pair, value, texts, a, b, window, off_a, off_b, hit_a, hit_b)
        at = np.flatnonzero(hit_a)
        matches = np.add.reduceat(hit_a, off_a, dtype=np.int64)

    # Both sides hold the same number of matched bytes per row, so the two
    # flattened runs line up.
    unequal = np.flatnonzero(values_a.take(at) != values_b.take(np.flatnonzero(hit_b)))
    transposed = np.bincount(np.repeat(np.arange(n), matches).take(unequal), minlength=n) // 2

    shared = np.zeros(n, np.int64)
    running = np.ones(n, bool)
    last_a, last_b = len(values_a) - 1, len(values_b) - 1
    for k in range(PREFIX_LIMIT):
        equal = values_a[np.minimum(off_a + k, last_a)] == values_b[np.minimum(off_b + k, last_b)]
        running &= (k < la) & (k < lb) & equal
        shared += running
    return _winkler(la, lb, matches, transposed, shared)


def _winkler(la, lb, matches, transposed, shared) -> np.ndarray:
    some = np.maximum(matches, 1)
    jaro = (matches / la + matches / lb + (matches - transposed) / some) / 3
    jaro = np.where(matches == 0, 0.0, jaro)
    return np.where(jaro > BOOST_ABOVE, jaro + shared * PREFIX_WEIGHT * (1 - jaro), jaro)


class _Rows:
    """Some texts as rows of matrices: their bytes, what slot (byte value, occurrence) each is, where a slot stands."""

    def __init__(self, texts: _Texts, some: np.ndarray):
        most = texts.counts[some].max(0).astype(np.int64)
        self.base = np.cumsum(most) - most
        self.slots = int(most.sum())
        self.row = np.full(len(texts.lengths), -1)
        self.row[some] = np.arange(len(some))
        lengths = texts.lengths[some]
        row = np.repeat(np.arange(len(some)), lengths)
        at = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        source = at + np.repeat(texts.starts[some], lengths)
        value = texts.values.take(source)
        slot = self.base.take(value) + texts.nth.take(source)
        shape = (len(some), int(lengths.max()))
        self.bytes, self.slot = np.zeros(shape, np.uint8), np.full(shape, self.slots)
        self.bytes[row, at], self.slot[row, at] = value, slot
        # A slot that a text does not hold stands further away than any window reaches.
        self.place = np.full((len(some), self.slots + 1), -4 * _LONG, np.int16)
        self.place[row, slot] = at


def _hits(texts: _Texts, rows: _Rows, a: int, theirs: np.ndarray, window: np.ndarray, hit_a: np.ndarray, hit_b: np.ndarray):
    """Mark the bytes of a text and of others that have a partner by occurrence; where it is beyond the window."""
    own = slice(texts.starts[a], texts.starts[a] + texts.lengths[a])
    value, nth = texts.values[own], texts.nth[own]
    held = nth < np.append(rows.base[1:], rows.slots)[value] - rows.base[value]
    slot = np.where(held, rows.base[value] + nth, rows.slots)
    place = rows.place.ravel().take(theirs[:, None] * rows.place.shape[1] + slot, mode="clip")
    np.greater_equal(place, 0, out=hit_a)
    place -= np.arange(len(value), dtype=np.int16)
    near = np.abs(place, out=place) <= window[:, None].astype(np.int16)
    holds = np.zeros(rows.slots + 1, bool)
    holds[slot[held]] = True
    holds.take(rows.slot[:, : hit_b.shape[1]].take(theirs, 0), mode="clip", out=hit_b)
    pair, at = np.divmod(np.flatnonzero((hit_a != near).ravel()), len(value))
    return pair, value[at]


def _score_groups(texts: _Texts, rows: _Rows, a: np.ndarray, b: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Scores of pairs as ``_jaro_winkler_block`` gives them; from each of ``begins`` on, ``a`` is one text."""
    ends = np.append(begins[1:], len(a))
    la, lb = texts.lengths[a], texts.lengths[b]
    widths = np.repeat(np.maximum.reduceat(lb, begins), ends - begins)
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    off_a, off_b = np.cumsum(la) - la, np.cumsum(widths) - widths
    hit_a, hit_b = np.zeros(int(la.sum()), bool), np.zeros(int(widths.sum()), bool)

    def of(flat: np.ndarray, off: np.ndarray, sizes: np.ndarray, low: int, high: int) -> np.ndarray:
        return flat[off[low] : off[low] + (high - low) * sizes[low]].reshape(high - low, sizes[low])

    found = []
    for low, high in zip(begins.tolist(), ends.tolist()):
        views = of(hit_a, off_a, la, low, high), of(hit_b, off_b, widths, low, high)
        pair, value = _hits(texts, rows, a[low], rows.row[b[low:high]], window[low:high], *views)
        found.append((pair + low) * 256 + value)
    far = np.unique(np.concatenate(found))
    if len(far):
        _merge(*np.divmod(far, 256), texts, a, b, window, off_a, off_b, hit_a, hit_b)

    matches, equal, shared = np.zeros((3, len(a)), np.int64)
    for low, high in zip(begins.tolist(), ends.tolist()):
        mine = texts.values[texts.starts[a[low]] :][: la[low]].astype(np.uint8)
        others = rows.bytes[:, : widths[low]].take(rows.row[b[low:high]], 0)
        mark_a, mark_b = of(hit_a, off_a, la, low, high), of(hit_b, off_b, widths, low, high)
        matches[low:high] = np.count_nonzero(mark_a, axis=1)
        same = np.flatnonzero(np.tile(mine, high - low)[mark_a.ravel()] == others[mark_b])
        upto = np.searchsorted(same, np.append(0, np.cumsum(matches[low:high])))
        equal[low:high] = np.diff(upto)
        head = min(PREFIX_LIMIT, la[low], widths[low])
        alike = (others[:, :head] == mine[:head]) & (np.arange(head) < lb[low:high, None])
        shared[low:high] = np.logical_and.accumulate(alike, axis=1).sum(1)
    return _winkler(la, lb, matches, (matches - equal) // 2, shared)


def _grouped(texts: _Texts, a: np.ndarray, b: np.ndarray, scores: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Score the pairs of texts that have several, and return the other pairs."""
    short = texts.lengths <= _LONG
    fits = short[a[pairs]] & short[b[pairs]]
    times = np.bincount(a[pairs[fits]], minlength=len(texts.lengths))
    fits &= times[a[pairs]] >= _GROUP_PAIRS
    if not fits.any():
        return pairs
    # By length, so that a matrix has rows of similar lengths.
    chosen = pairs[fits]
    chosen = chosen[np.lexsort((texts.lengths[b[chosen]], a[chosen]))]
    some = np.unique(b[chosen])
    some = some[np.argsort(texts.lengths[some], kind="stable")]
    step = max(1, 4 * _CELLS // (int(texts.counts[some].max(0).sum()) + 8 * int(texts.lengths[some].max())))
    for low in range(0, len(some), step):
        rows = _Rows(texts, some[low : low + step])
        mine = chosen[rows.row[b[chosen]] >= 0]
        lefts, widest = a[mine], np.maximum(texts.lengths[a[mine]], texts.lengths[b[mine]])
        # Parts of a text's pairs, of which the last is the longest.
        fresh = np.append(True, (lefts[1:] != lefts[:-1]) | (widest[1:] // 256 != widest[:-1] // 256))
        begin, used = 0, np.cumsum(widest)
        while begin < len(mine):
            end = max(begin + 1, int(np.searchsorted(used, used[begin] + _CELLS, "right")))
            group = mine[begin:end]
            new = fresh[begin:end].copy()
            new[0] = True
            scores[group] = _score_groups(texts, rows, a[group], b[group], np.flatnonzero(new))
            begin = end
    return pairs[~fits]


def _score_part(left: pa.Array, right: pa.Array) -> np.ndarray:
    kind = pa.large_string()
    both = pa.chunked_array([left.cast(kind), right.cast(kind)]).combine_chunks().dictionary_encode()
    texts = _Texts(both.dictionary)
    codes = pc.fill_null(both.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    a, b = codes[: len(left)], codes[len(left) :]
    lengths = np.append(texts.lengths, 0)  # of NULL
    la, lb = lengths[a], lengths[b]
    scores = np.zeros(len(left))
    pairs = _grouped(texts, a, b, scores, np.flatnonzero((la > 0) & (lb > 0)))
    ends = np.cumsum(np.maximum(la, lb)[pairs])
    done = 0
    while done < len(pairs):
        # At most this many bytes per side, or one pair.
        before = ends[done - 1] if done else 0
        high = max(int(np.searchsorted(ends, before + _BLOCK_BYTES, "right")), done + 1)
        block = pairs[done:high]
        scores[block] = _jaro_winkler_block(texts, a[block], b[block])
        done = high
    return scores


def score_pairs(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Scores of two aligned string arrays; empty text scores 0."""
    # Joined pairs repeat their texts, and what is made of a text is made once in a part.
    sizes = np.cumsum(_bytes_of(left)[2] + _bytes_of(right)[2])
    parts = [np.zeros(0)]
    done = 0
    while done < len(left):
        before = sizes[done - 1] if done else 0
        high = min(max(int(np.searchsorted(sizes, before + _PART_BYTES, "right")), done + 1), done + _PART_PAIRS)
        parts.append(_score_part(left.slice(done, high - done), right.slice(done, high - done)))
        done = high
    return np.concatenate(parts)


@F.arrow_udf(T.DoubleType())
def _jaro_winkler(left: pa.Array, right: pa.Array) -> pa.Array:
    unknown = np.asarray(left.is_null()) | np.asarray(right.is_null())
    return pa.array(score_pairs(left, right), pa.float64(), mask=unknown)


# Declared non-deterministic so that a filter on the score is not moved below its
# projection, which would compute every score twice.
_score_once = _jaro_winkler.asNondeterministic()


def jaro_winkler(a: Column | str, b: Column | str) -> Column:
    """Byte-wise Jaro-Winkler similarity; NULL if either text is NULL, 0 if either is empty."""
    return _score_once(as_column(a), as_column(b))


_SIGNATURE = pa.struct(
    [("size", pa.int32()), ("head", pa.int32())]
    + [(f"bits{w}", pa.int64()) for w in range(_WORDS)]
)


def _occurrence_bits() -> np.ndarray:
    """Entry [v, k]: the bits of the first k occurrences of byte value v.

    The step is odd, so 256 occurrences of one value fill the whole sketch.
    """
    width = 64 * _WORDS
    bit = (np.arange(256)[:, None] * 37 + np.arange(width) * 101) % width
    flags = np.zeros((256, width + 1, _WORDS), np.uint64)
    value, k = np.indices(bit.shape)
    flags[value, k + 1, bit // 64] = np.uint64(1) << (bit % 64).astype(np.uint64)
    return np.bitwise_or.accumulate(flags, axis=1)


_OCCURRENCE_BITS = _occurrence_bits()
_SKETCH_ROWS = 4096


def signatures(column: pa.Array) -> pa.Array:
    """Byte length, first four bytes, and a 256-bit sketch of the bag of bytes.

    Each occurrence of a byte (first 'e', second 'e', ...) sets one bit, so a bit
    set on one side only proves an unmatched byte there.
    """
    raw, starts, lengths = _bytes_of(column)
    n = len(column)
    first = starts[0] if n else 0
    text = raw[first : first + int(lengths.sum())]
    sketch = np.zeros((n, _WORDS), np.uint64)
    for low in range(0, n, _SKETCH_ROWS):
        high = min(low + _SKETCH_ROWS, n)
        begin = int(starts[low] - first)
        owner = np.repeat(np.arange(high - low), lengths[low:high])
        part = text[begin : begin + len(owner)]
        counts = np.bincount(owner * 256 + part, minlength=(high - low) * 256)
        cells = np.flatnonzero(counts)
        if len(cells):
            flags = _OCCURRENCE_BITS[cells % 256, np.minimum(counts[cells], 64 * _WORDS)]
            rows, begins = np.unique(cells // 256, return_index=True)
            sketch[low + rows] = np.bitwise_or.reduceat(flags, begins, axis=0)

    head = np.zeros(n, np.uint32)
    for k in range(4):
        longer = lengths > k
        head[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * (3 - k))
    return pa.StructArray.from_arrays(
        [pa.array(lengths.astype(np.int32)), pa.array(head.view(np.int32))]
        + [pa.array(sketch[:, w].copy().view(np.int64)) for w in range(_WORDS)],
        fields=list(_SIGNATURE),
    )


@F.arrow_udf(
    T.StructType(
        [T.StructField("size", T.IntegerType()), T.StructField("head", T.IntegerType())]
        + [T.StructField(f"bits{w}", T.LongType()) for w in range(_WORDS)]
    )
)
def _signature(column: pa.Array) -> pa.Array:
    return signatures(column)


def with_signature(df: DataFrame, text: str) -> DataFrame:
    """Add the sketch columns ``could_exceed`` reads: linear in the text, once per text."""
    return df.withColumn("_sketch", _signature(F.col(text))).select("*", "_sketch.*").drop("_sketch")


SIGNATURE_COLUMNS = tuple(_SIGNATURE.names)


def could_exceed(left: str, right: str, threshold: float) -> Column:
    """False only for pairs whose score provably stays at or below ``threshold``.

    ``left`` and ``right`` are the suffixes of the sketch columns.  With at most M
    matched bytes, jaro <= (M/la + M/lb + 1) / 3, and M cannot exceed a side's length
    less the bits only that side has set.  A shared prefix of p bytes lowers the jaro
    a pair needs to (t - p/10) / (1 - p/10).  The cheap length test comes first.
    Every operation is a built-in on integers, so the test runs inside the join.
    """
    # As bigints: the product of the lengths of two long texts passes 32 bits.
    la, lb = (F.col(f"size_{side}").cast("long") for side in (left, right))

    def only_in(one: str, other: str) -> Column:
        counts = [
            F.bit_count(
                F.col(f"bits{w}_{one}").bitwiseAND(F.bitwise_not(F.col(f"bits{w}_{other}")))
            )
            for w in range(_WORDS)
        ]
        return sum(counts[1:], counts[0])

    def needed(prefix: int) -> Column:
        boost = prefix * PREFIX_WEIGHT
        return F.lit(3 * (threshold - boost) / (1 - boost) - 1 - 1e-9)

    differing = F.col(f"head_{left}").bitwiseXOR(F.col(f"head_{right}"))
    share = (
        F.when(differing == 0, needed(4))
        .when(F.shiftrightunsigned(differing, 8) == 0, needed(3))
        .when(F.shiftrightunsigned(differing, 16) == 0, needed(2))
        .when(F.shiftrightunsigned(differing, 24) == 0, needed(1))
        .otherwise(needed(0))
    )
    # M * (1/la + 1/lb) > share, for M the shorter length and then for each side's bound.
    total = la + lb
    return (
        (la > 0)
        & (lb > 0)
        & (total > share * F.greatest(la, lb))
        & ((la - only_in(left, right)) * total > share * la * lb)
        & ((lb - only_in(right, left)) * total > share * la * lb)
    )


_BOUND_ROWS = 256  # texts whose pairs are ruled out together


def exceeding_pairs(
    sizes: np.ndarray, head: np.ndarray, bits: np.ndarray, side: np.ndarray | None, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs a < b of rows that ``could_exceed`` lets pass, in parts; with ``side``, of different sides only."""
    needs = np.array([3 * (threshold - p * PREFIX_WEIGHT) / (1 - p * PREFIX_WEIGHT) - 1 - 1e-9 for p in range(5)])
    n, head, sizes = len(sizes), head.astype(np.uint32), sizes.astype(np.int64)
    for low in range(0, n, _BOUND_ROWS):
        mine = slice(low, min(low + _BOUND_ROWS, n))
        differing = head[mine, None] ^ head[None, :]
        equal = (differing == 0) * 1 + (differing >> 8 == 0) + (differing >> 16 == 0) + (differing >> 24 == 0)
        share = needs[equal]
        la, lb = sizes[mine, None], sizes[None, :]
        pass_ = (la + lb) > share * np.maximum(la, lb)
        pass_ &= np.arange(low, mine.stop)[:, None] < np.arange(n)[None, :]
        if side is not None:
            pass_ &= side[mine, None] != side[None, :]
        a, b = np.nonzero(pass_)
        a += low
        only_a = np.bitwise_count(bits[a] & ~bits[b]).sum(1, dtype=np.int64)
        only_b = np.bitwise_count(bits[b] & ~bits[a]).sum(1, dtype=np.int64)
        la, lb = sizes[a], sizes[b]
        least = share[a - low, b] * la * lb
        good = ((la - only_a) * (la + lb) > least) & ((lb - only_b) * (la + lb) > least)
        yield a[good], b[good]
