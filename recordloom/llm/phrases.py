"""Phrase collocations per language: Misra-Gries summaries find the frequent phrases, a second pass counts them.

Texts are lower-cased (A-Z), cut in pieces at punctuation and line ends and split at spaces and
tabs.  A phrase is a stretch of up to ``most_words`` words within a piece.

First pass: blocks of texts (``BLOCK_BYTES``) hash their phrases, count them once per block and send them
to hash partitions, cut so that each has about ``PARTITION_MASS`` occurrences.  A partition merges the
blocks' counts into one Misra-Gries summary: beyond its capacity the (capacity + 1)th largest
count is taken off all counters.  The capacity is ``SLACK`` times the partition's mass divided by
``least``, so in all less than ``least`` is taken off, and every phrase of ``least``
occurrences survives.  Hashes that collide only add up, so none is lost by them either; the width of the
hashes follows the mass.  Partitions answer each block with one bit per phrase it sent.

Second pass: blocks count their surviving phrases as texts, and Spark adds these up exactly.

A candidate of two or more words is cut at every place into l and r occurrences of its parts and
scored floor(10^6 a a / (l r)) by its worst cut, in decimals.  Parts meet their candidates in
``SALTS`` copies, so that a part of very many candidates is dealt over as many tasks.  Candidates inside
a longer one with at least half of their occurrences are dropped, and each language's first
``top`` are returned.

Defined cases: null texts are empty; null languages are ``und``; repeated rows count as often as they
occur; a text longer than a block is a block of its own; further columns tell rows apart and are not
read otherwise; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .exchange import blocks_for, pack, pack_sorted, scramble, text_bytes, unpack, unpack_sorted

LEAST = 10
MOST_WORDS = 3
TOP = 2000
BLOCK_BYTES = 8 << 20
PARTITION_MASS = 24_000_000
SLACK = 2
SPARE_BITS = 12  # a phrase shares its hash with another one with a chance of about 2^-12
SALTS = 8
SLICES = 64  # in which a language's candidates are ranked before its first are taken
MERGED_KEYS = 2_000_000  # phrases that are added to a summary at a time

_BREAK = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)  # 0 word, 1 space, 2 break
_KIND[list(b" \t")] = 1
_KIND[list(_BREAK)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hash(values: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(v) for v in values], np.uint64)


class Phrases:
    """Distinct phrases of the texts of a block, numbered by length; ``counts`` are their occurrences.

    ``keys`` are the distinct hashes in order, ``at`` leads from a number to its key.
    """

    def __init__(self, texts: pa.ChunkedArray, langs: pa.ChunkedArray, most_words: int, bits: int):
        coded = pc.fill_null(langs, "und").combine_chunks().dictionary_encode()
        self.langs = coded.dictionary
        lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self._split(pc.fill_null(texts, "").combine_chunks().cast(pa.large_binary()))
        word, self.doc_lang = self.word, lang
        n_words = max(1, len(self.words))
        # Words of a language: one number for each pair.
        pair = lang[self.doc] * n_words + word
        distinct, number, counts = np.unique(pair, return_inverse=True, return_counts=True)
        self.parts = [(distinct // n_words, (distinct % n_words)[:, None])]  # language, words
        lang_hash, word_hash = _hash([x.encode() for x in self.langs.to_pylist()]), _hash(self.words.to_pylist())
        plain = scramble(word_hash)[distinct % n_words]
        hashes = [scramble(plain + scramble(lang_hash)[distinct // n_words])]
        self.counts = [counts]
        base, of, ids = len(distinct), number, number
        valid = np.ones(len(word), bool)
        for n in range(2, most_words + 1):
            size = max(0, len(word) - n + 1)
            valid = valid[:size] & (self.piece[:size] == self.piece[n - 1 :][:size])
            starts = np.flatnonzero(valid)
            joined = ids[starts] * base + of[starts + n - 1]
            distinct, number, counts = np.unique(joined, return_inverse=True, return_counts=True)
            head, tail = distinct // max(1, base), distinct % max(1, base)
            lang_of, words_of = self.parts[-1]
            self.parts.append((lang_of[head], np.hstack([words_of[head], self.parts[0][1][tail]])))
            hashes.append(scramble(hashes[-1][head] * _MIX + plain[tail]))
            self.counts.append(counts)
            ids = np.full(len(word), -1, np.int64)
            ids[starts] = number
        every = np.concatenate(hashes) >> np.uint64(64 - bits)
        self.keys, self.at = np.unique(every, return_inverse=True)
        self.key_counts = np.bincount(self.at, np.concatenate(self.counts), len(self.keys)).astype(np.int64)

    def _split(self, texts: pa.LargeBinaryArray) -> None:
        """Number of every word, its text and its piece; ``words`` are the distinct words."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        lo, hi = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[lo:hi]
        kind = _KIND[data]
        is_word = kind == 0
        first = is_word.copy()
        first[1:] &= ~is_word[:-1]
        begins = offsets - lo
        inside = begins[begins < len(data)]
        first[inside] = is_word[inside]
        last = is_word.copy()
        last[:-1] &= ~is_word[1:] | first[1:]
        starts = np.flatnonzero(first)
        ends = np.append(0, np.cumsum(np.flatnonzero(last) - starts + 1)).astype(np.int64)
        kept = _LOWER[data[is_word]]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(kept)])
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.doc = np.searchsorted(begins, starts, "right") - 1
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), starts) + self.doc

    def texts(self, chosen: np.ndarray) -> pa.RecordBatch:
        """(lang, words, phrase, n) of the phrases whose keys are chosen, and of each language's words in all."""
        out, begin = [], 0
        for (lang, words), counts in zip(self.parts, self.counts):
            here = np.flatnonzero(chosen[self.at[begin : begin + len(counts)]])
            begin += len(counts)
            columns = [self.words.take(pa.array(words[here, i])).cast(pa.large_string()) for i in range(words.shape[1])]
            phrase = pc.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string())) if len(columns) > 1 else columns[0]
            size = pa.array(np.full(len(here), words.shape[1], np.int32))
            out.append((self.langs.take(pa.array(lang[here])), size, phrase, pa.array(counts[here], pa.int64())))
        total = np.bincount(self.doc_lang[self.doc], minlength=len(self.langs)).astype(np.int64)
        none = pa.array([""] * len(total), pa.large_string())
        out.append((self.langs, pa.array(np.zeros(len(total), np.int32)), none, pa.array(total)))
        columns = [pa.concat_arrays([o[i] for o in out]) for i in range(4)]
        columns[0], columns[2] = columns[0].cast(pa.string()), columns[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(columns, names=["lang", "words", "phrase", "n"])


REQUEST = "part int, block int, size int, mass long, keys binary, counts binary"
ANSWER = "part int, block int, size int, frequent binary"


def _bounds(parts: int, bits: int) -> np.ndarray:
    """The first key of every hash partition."""
    return np.array([(i << bits) // parts for i in range(parts)], np.uint64)


def _requests(parts: int, bits: int, most_words: int):
    bounds = _bounds(parts, bits)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        found = Phrases(table.column("text"), table.column("lang"), most_words, bits)
        cuts = [*np.searchsorted(found.keys, bounds).tolist(), len(found.keys)]
        rows = [
            (p, key[0].as_py(), hi - lo, int(found.key_counts[lo:hi].sum()),
             pack_sorted(found.keys[lo:hi] - bounds[p]), pack(found.key_counts[lo:hi] - 1))
            for p, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if hi > lo
        ]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        columns = list(zip(*rows)) or [()] * len(types)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["part", "block", "size", "mass", "keys", "counts"])

    return run


class Summary:
    """A Misra-Gries summary with ``capacity`` counters: sorted keys, their counts, and what was taken off."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, taken: int = 0) -> None:
        """Add the counters of another summary, or plain counts."""
        self.keys, which = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        weights = np.concatenate([self.counts, counts]).astype(np.float64)
        self.counts = np.bincount(which, weights, len(self.keys)).astype(np.int64)
        self.taken += taken
        if (over := len(self.keys) - self.capacity) > 0:
            # The (capacity + 1)th largest count.
            least = int(np.partition(self.counts, over - 1)[over - 1])
            left = self.counts > least
            self.keys, self.counts = self.keys[left], self.counts[left] - least
            self.taken += least

    def frequent(self, least: int) -> np.ndarray:
        """Keys that may have ``least`` occurrences."""
        return self.keys[self.counts + self.taken >= least]


def _answers(least: int, slack: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        size = table.column("size").to_pylist()
        keys, counts = table.column("keys"), table.column("counts")
        capacity = int(slack * pc.sum(table.column("mass")).as_py() / least) + 1
        summary = Summary(capacity)
        begin = 0
        while begin < len(size):
            end, total = begin, 0
            while end < len(size) and (total == 0 or total + size[end] <= MERGED_KEYS):
                total += size[end]
                end += 1
            some = range(begin, end)
            summary.merge(
                np.concatenate([unpack_sorted(keys[i].as_py(), size[i]) for i in some]),
                np.concatenate([unpack(counts[i].as_py(), size[i]) for i in some]).astype(np.int64) + 1,
            )
            begin = end
        frequent = summary.frequent(least)

        def bits(i: int) -> bytes:
            sent = unpack_sorted(keys[i].as_py(), size[i])
            place = np.minimum(np.searchsorted(frequent, sent), max(0, len(frequent) - 1))
            hit = frequent[place] == sent if len(frequent) else np.zeros(len(sent), bool)
            return np.packbits(hit).tobytes()

        answer = pa.array([bits(i) for i in range(len(size))], pa.binary())
        return pa.table(
            {"part": table.column("part"), "block": table.column("block"), "size": table.column("size"), "frequent": answer}
        )

    return run


def _counted(bits: int, most_words: int):
    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        found = Phrases(docs.column("text"), docs.column("lang"), most_words, bits)
        answers = answers.sort_by("part")
        chosen = [
            np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
            for b, n in zip(answers.column("frequent").to_pylist(), answers.column("size").to_pylist())
        ]
        return pa.Table.from_batches([found.texts(np.concatenate(chosen) if chosen else np.zeros(0, bool))])

    return run


def phrase_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most_words: int = MOST_WORDS, least: int = LEAST,
    block_bytes: int = BLOCK_BYTES, partition_mass: int = PARTITION_MASS, slack: float = SLACK,
) -> DataFrame:
    """(lang, words, phrase, n) of every phrase of 1 to ``most_words`` words with ``least`` occurrences.

    Rows of 0 words hold the number of words of a language.
    """
    size = text_bytes(docs, text_col)
    blocks = blocks_for(size, block_bytes)
    # At most one word in two bytes; about one in six is usual.
    mass = max(1, size * most_words // 6)
    parts, bits = max(1, -(-mass // partition_mass)), min(64, mass.bit_length() + SPARE_BITS)
    # All columns tell rows apart, so copies of a text with ids of their own lie in different blocks.
    rows = docs.select(
        F.pmod(F.xxhash64(*docs.columns), F.lit(blocks)).cast("int").alias("block"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    requests = rows.groupBy("block").applyInArrow(_requests(parts, bits, most_words), REQUEST)
    answers = stage(requests.groupBy("part").applyInArrow(_answers(least, slack), ANSWER), "frequent-phrases")
    counted = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _counted(bits, most_words), "lang string, words int, phrase string, n long"
    )
    counts = counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return counts.filter((F.col("n") >= least) | ((F.col("words") == 0) & (F.col("n") > 0)))


def _part(phrase: Column, words: Column) -> Column:
    """The first words of a phrase, or the last ones if ``words`` is negative."""
    return F.substring_index(phrase, F.lit(" "), words)


def scored(counts: DataFrame, salts: int = SALTS) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of the candidates among ``phrase_counts``, by their worst cut."""
    candidates = counts.filter("words >= 2").select("lang", "phrase", "words", F.col("n").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "*",
        F.pmod(F.xxhash64("phrase"), F.lit(salts)).cast("int").alias("salt"),
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("rest"),
    )
    parts = counts.filter("words >= 1").select("lang", "phrase", "n", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(parts.withColumnsRenamed({"phrase": part, "n": name}), ["lang", part, "salt"])
    exact = "decimal(38,0)"
    score = F.expr(
        f"(cast(cast(a as decimal(16,0)) * cast(a as decimal(16,0)) as {exact}) * cast(1000000 as decimal(7,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    )
    cuts = cuts.withColumn("score", score)
    worst = F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "words").agg(worst).select(
        "lang", "phrase", "words", "cut.a", "cut.l", "cut.r", "cut.score"
    )


def held_by_longer(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the most occurrences of a longer candidate that holds the phrase."""
    longer = counts.filter("words >= 3")
    words = F.split("phrase", " ")
    inner = longer.select(
        "lang", "n", words.alias("w"), F.explode(F.expr("sequence(2, words - 1)")).alias("size"), "words"
    ).select("lang", "n", "w", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("at"))
    held = inner.select("lang", F.expr("array_join(slice(w, at, size), ' ')").alias("phrase"), "n")
    return held.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most_words: int = MOST_WORDS, least: int = LEAST,
    top: int = TOP, **sizes: int,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    counts = stage(phrase_counts(docs, text_col, lang_col, most_words, least, **sizes), "phrases")
    kept = (
        scored(counts)
        .join(held_by_longer(counts), ["lang", "phrase"], "left")
        .filter(F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a")))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The first of a slice are found apart, so that no task ranks all candidates of a language.
    piece = F.pmod(F.xxhash64("phrase"), F.lit(SLICES))
    first = kept.withColumn("nth", F.row_number().over(Window.partitionBy("lang", piece).orderBy(*order)))
    ranked = first.filter(F.col("nth") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    )
    totals = counts.filter("words = 0").select("lang", "n")
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


PHRASES_SQL = """
    WITH pieces AS (
        SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
        FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        )
    ),
    phrases AS (
        SELECT lang, k AS words, array_to_string(w[i : i + k - 1], ' ') AS phrase
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) v(k))
    ),
    counts AS (SELECT lang, words, phrase, count(*) AS f FROM phrases GROUP BY lang, words, phrase),
    totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE words = 1 GROUP BY lang),
    candidates AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE words >= 2 AND f >= 10),
    cuts AS (
        SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
               c.a::HUGEINT * c.a::HUGEINT * 1000000::HUGEINT // (x.f::HUGEINT * y.f::HUGEINT) AS score
        FROM (SELECT *, unnest(range(1, words)) AS k FROM candidates) c
        JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
        JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 :], ' ')
    ),
    worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    held AS (
        SELECT lang, phrase, max(a) AS longer
        FROM (SELECT lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase
              FROM candidates WHERE words = 3)
        GROUP BY lang, phrase
    ),
    ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
        FROM worst LEFT JOIN held USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a
    )
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
