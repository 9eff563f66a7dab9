"""Maximal periodic runs of words, by maximal pairs of the LCP-interval tree.

A run is a stretch of a text with smallest period q and at least max(``LEAST_WORDS``,
``LEAST_TIMES`` q) words that no neighbouring word extends.  A run of length L is a maximal pair:
the places i and i + q begin equal stretches of exactly L - q words (their longest common prefix),
and the words left of them differ.  So nothing is extended; a pair of distance q in a node of
prefix length l of the tree is a run if l + q meets the two length constraints.

The suffixes of a slice of texts are sorted by prefix doubling (numpy), words being numbered per text, so that no
prefix crosses texts; only suffixes whose first words occur again in the text are sorted further.
The ranks of all doublings give the common prefix of neighbours.  The tree is then walked
bottom-up.  A node holds its places by position, each with the class of its left word; where two
children meet, every place of the smaller looks for its nearest neighbours in the larger one, and
neighbours of different classes are maximal pairs.  Nearest ones suffice: three places of
one node within a third of its prefix length lie at multiples of a smaller period, so a pair
around another place is not of the smallest period; what is left of these goes because the same
stretch is found with its smallest period.  Subtrees without two places near enough are skipped.

Texts are whole rows and independent of one another, so nothing is shuffled.

Defined cases: null and empty texts have no words, no runs and an empty rest; repeated rows get
equal results; a text of one repeated word is one run; further columns are carried along and the
added name never clashes; no rows give no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import WORD, free_names
from .exchange import words_of

LEAST_WORDS = 6
LEAST_TIMES = 4
SLICE_BYTES = 2 << 20  # of text whose suffixes are sorted together; a longer text has a slice of its own


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of ``keys``, the first place of each one's group in that order, and which groups have two or more."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(keys)))
    return order, np.repeat(first, sizes), np.repeat(sizes > 1, sizes)


def doubled_ranks(code: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... codes, until all differ.

    Equal ranks mean equal prefixes; suffixes that end sooner come first.
    """
    n = len(code)
    order, first, again = _groups(code)
    rank = np.empty(n, np.int64)
    rank[order] = first
    active = order[again]  # in the order of their ranks
    ranks, width = [rank], 1
    while len(active):
        behind = active + width
        follow = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        order, first, again = _groups(rank[active] * (n + 1) + follow)
        sorted_active = active[order]
        old = rank[sorted_active]
        # An old group keeps its range of ranks; its parts start where they lie in it.
        begin = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), np.arange(len(old)), 0))
        rank = rank.copy()
        rank[sorted_active] = old + first - begin
        active = sorted_active[again]
        ranks.append(rank)
        width *= 2
    return ranks


def common_prefix(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common prefixes of the suffixes at ``a`` and at ``b``."""
    n = len(ranks[0])
    a, b = a.copy(), b.copy()
    length = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        rank = ranks[level]
        inside = (a < n) & (b < n)
        same = inside & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        length[same] += 1 << level
        a[same] += 1 << level
        b[same] += 1 << level
    return length


def _walk(places: list[int], prefix: list[int], left: list[int], least_words: int, times: int, found: dict) -> None:
    """Bottom-up over the intervals of sorted suffixes; ``prefix[i]`` is that of suffixes i - 1 and i.

    Adds (start, end) -> smallest period to ``found``.
    """
    near = times - 1

    def merged(node: list[int], child: list[int], length: int) -> list[int]:
        large, small = (node, child) if len(node) >= len(child) else (child, node)
        for place in small:
            at = bisect_left(large, place)
            for other in large[max(at - 1, 0) : at + 1]:
                period = abs(place - other)
                if near * period <= length and length + period >= least_words and left[place] != left[other]:
                    start = min(place, other)
                    run = (start, start + length + period)
                    if found.get(run, period) >= period:
                        found[run] = period
        for place in small:
            insort(large, place)
        return large

    stack: list[tuple[int, list[int]]] = []
    for i in range(1, len(places) + 1):
        length = prefix[i] if i < len(places) else -1
        done = [places[i - 1]]
        while stack and stack[-1][0] > length:
            value, node = stack.pop()
            done = merged(node, done, value)
        if stack and stack[-1][0] == length:
            stack[-1] = (length, merged(stack[-1][1], done, length))
        elif length >= 0:
            stack.append((length, done))


def runs_of(code: np.ndarray, ends: np.ndarray, least_words: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of texts, ``code`` numbering the words and ``ends`` ending the texts.

    Starts count over all texts; the runs are in order of start, then period.
    """
    n = len(code)
    if n < least_words:
        return []
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    own = text * (int(code.max()) + 1) + code
    ranks = doubled_ranks(own)
    # The prefix of a run of period q has max(least_words, times * q) - q words, least around this q.
    q = least_words // times
    least = max(1, min(least_words - q, (times - 1) * (q + 1)))
    deep = int(np.log2(least))
    if len(ranks) <= deep:
        return []
    # Suffixes that share their first words with another one, in order.
    level = ranks[deep]
    some = np.flatnonzero(np.bincount(level, minlength=n)[level] > 1)
    suffixes = some[np.argsort(ranks[-1][some], kind="stable")]
    if not len(suffixes):
        return []
    prefix = np.append(0, common_prefix(ranks, suffixes[:-1], suffixes[1:]))
    tree = np.cumsum(prefix < least)  # subtrees of prefixes that are long enough
    longest = np.maximum.reduceat(np.where(prefix < least, 0, prefix), np.flatnonzero(np.append(True, np.diff(tree) > 0)))
    tree -= tree[0]
    by_place = np.lexsort((suffixes, tree))
    gap = np.diff(suffixes[by_place])
    close = (np.diff(tree[by_place]) == 0) & ((times - 1) * gap <= longest[tree[by_place][1:]])
    chosen = np.unique(tree[by_place][1:][close])
    begins, stops = np.searchsorted(tree, chosen), np.searchsorted(tree, chosen, "right")
    # The word left of a place; a text's first place has a class of its own.
    left = np.append(-1, own[:-1])
    starts = np.append(0, ends[:-1])[np.diff(ends, prepend=0) > 0]
    left[starts] = -1 - np.arange(len(starts))
    left_list = _Lookup(left)
    found: dict[tuple[int, int], int] = {}
    for lo, hi in zip(begins.tolist(), stops.tolist()):
        _walk(suffixes[lo:hi].tolist(), prefix[lo:hi].tolist(), left_list, least_words, times, found)
    return sorted((start, end - start, period) for (start, end), period in found.items())


class _Lookup:
    """Plain integers of an array, read one by one."""

    def __init__(self, values: np.ndarray):
        self.get = values.item

    def __getitem__(self, i: int) -> int:
        return self.get(i)


FOUND = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring rows with ``most`` bytes of text together, or one row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def _find(carried: int, name: str, least_words: int, times: int, slice_bytes: int):
    def found_in(texts: pa.Array) -> list[dict]:
        words = words_of(texts, lower=False)
        runs = runs_of(words.code, words.ends, least_words, times)
        by_text: dict[int, list] = {}
        of = np.searchsorted(words.ends, [r[0] for r in runs], "right").tolist()
        for i, run in zip(of, runs):
            by_text.setdefault(i, []).append(run)
        rows = []
        for i, text in enumerate(texts.cast(pa.binary()).to_pylist()):
            split = (text or b"").split()
            n, mine = len(split), []
            if i in by_text:
                keep, begin = np.ones(n, bool), int(words.ends[i]) - n
                for start, length, period in by_text[i]:
                    start -= begin
                    keep[start + period : start + length] = False
                    mine.append({"start": start, "length": length, "period": period})
                split = [split[j] for j in np.flatnonzero(keep).tolist()]
            rows.append({"n_words": n, "runs": mine, "collapsed": b" ".join(split).decode()})
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(carried)
            for lo, hi in _slices(texts, slice_bytes):
                rows = pa.array(found_in(texts.slice(lo, hi - lo)), _FOUND)
                kept = [c.slice(lo, hi - lo) for c in batch.columns[:carried]]
                yield pa.RecordBatch.from_arrays([*kept, rows], names=[*batch.schema.names[:carried], name])

    return run


def periodic_runs(
    docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, name: str = "found",
    least_words: int = LEAST_WORDS, times: int = LEAST_TIMES, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The columns ``carry`` (all by default) and a struct ``name``: n_words, runs and the text without repeats.

    Of every run the words after its first period are left out of ``collapsed``, words joined by one space.
    """
    carry = docs.columns if carry is None else carry
    (text,) = free_names(docs, "whole_text")
    rows = docs.select(*carry, F.col(text_col).alias(text))
    fields = docs.select(*carry).schema.add(name, StructType.fromDDL(FOUND))
    return rows.mapInArrow(_find(len(carry), name, least_words, times, slice_bytes), fields)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, a tenth of them (by the crc32 of the id) periodic from some word on.

    With h the crc32 and g = floor(h / 10): if h % 10 = 0, each word i >= a becomes word
    a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h, words = F.crc32(F.col(id_col).cast("string").cast("binary")), F.regexp_extract_all(text_col, F.lit(WORD), 0)

    def planted(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        again = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.slice(F.concat(F.slice(w, F.lit(1), a), again), F.lit(1), n.cast("int")), " ")

    holds = F.col(text_col).rlike(WORD)
    return docs.withColumn(text_col, F.when((h % 10 == 0) & holds, planted(words)).otherwise(F.col(text_col)))


def digests(found: DataFrame, id_col: str = "doc_id", name: str = "found") -> DataFrame:
    """Number of runs, the run with the greatest exponent, and digests of all runs and of what is left."""
    runs = F.col(name)["runs"]
    # Two fractions of numbers under 2^26 differ by more than a double's step.
    ranked = F.transform(
        runs,
        lambda r: F.struct(
            (r["length"] / r["period"]).alias("times"), (-r["start"]).alias("start"), (-r["period"]).alias("period"),
            r["length"].alias("length"),
        ),
    )
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size(runs) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    best = F.col("best")
    return found.select(
        id_col, F.size(runs).cast("long").alias("n_runs"), F.array_max(ranked).alias("best"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col(name)["collapsed"].cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        id_col, "n_runs", (-best["start"]).alias("start"), best["length"].alias("length"),
        (-best["period"]).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


#: The runs as islands of places i whose five words come again q words later; crc32 is folded bit by bit.
RUNS_SQL = """
    WITH given AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
               xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
                   string_split(doc_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                   lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) AS h
        FROM documents
    ),
    sized AS (
        SELECT doc_id, w, len(w)::BIGINT AS n, h // 10 AS g, h % 10 = 0 AND len(w) > 0 AS planted FROM given
    ),
    cut AS (
        SELECT *, CASE WHEN planted THEN g % n ELSE n END AS a,
               CASE WHEN planted THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p
        FROM sized
    ),
    texts AS (
        SELECT doc_id, n, list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) AS w
        FROM cut
    ),
    grams AS (
        SELECT doc_id, i, array_to_string(w[i + 1 : i + 5], ' ') AS gram
        FROM (SELECT doc_id, w, unnest(range(n - 4)) AS i FROM texts WHERE n > 5)
    ),
    pairs AS (
        SELECT x.doc_id, x.i, y.i - x.i AS q
        FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i
    ),
    stretches AS (
        SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length
        FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
        GROUP BY doc_id, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)
    ),
    runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
    dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
    rest AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
        FROM (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM texts) ANTI JOIN dropped USING (doc_id, i)
        GROUP BY doc_id
    ),
    lists AS (
        SELECT doc_id, count(*) AS n_runs,
               string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
        FROM runs GROUP BY doc_id
    ),
    best AS (
        SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1
    )
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
           period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
           sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
    FROM documents LEFT JOIN lists USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN rest USING (doc_id)
"""
