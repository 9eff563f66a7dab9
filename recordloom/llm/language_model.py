"""Log probabilities of whole texts under a word bigram model by deleted interpolation.

Tokens are the words of a lower-cased text and one end.  A token's probability mixes three
estimates: uniform over the vocabulary and one unknown word, the token's share of all tokens, and
its share after the word before it.  The mixture weights depend on how often that word was
seen: contexts are bucketed by the logarithm of their count.  The weights are learned by
expectation-maximisation on training documents set apart for it, each scored with its own
counts deleted from the corpus counts (Jelinek and Mercer, 1980).  For the iteration the
tuning tokens are counted on a grid of context bucket and of the logarithms of the two estimates
(``GRID`` steps a decade), a table whose size the grid bounds.

Counts cover every training text.  They are gathered by the exchange of ``exchange``: n-grams
are 64-bit hashes, so two n-grams are taken for one with a chance of about n^2 / 2^65.

Defined cases: null and empty texts are one end; without training texts all counts are 0; without
tuning texts the weights are equal; repeated rows are counted and scored as often as they occur
(rows of one id and one text share a block); a null id counts as an id of its own; further
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import exchange as X

SEED = 42
GRID = 20
CLASSES = 64  # context buckets: binary digits of a count
ROUNDS = 60
TUNED = 1  # remainder mod 10 of the training documents that tune the weights

_END = X.scramble(np.array([1], np.uint64))[0]
_BEGIN = X.scramble(np.array([2], np.uint64))[0]


def remainder(id_col: str, n: int = 10) -> Column:
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n).cast("int")


class Grams:
    """Unigrams and bigrams of a block of texts, each numbered locally."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray):
        words = X.words_of(texts, lower=True)
        n_docs, n_words = len(words.ends), len(words.distinct)
        self.end, self.begin = n_words, n_words + 1
        # Tokens of all texts, an end after each; the context of a first word is the begin.
        self.sizes = words.ends - words.starts + 1
        last = np.cumsum(self.sizes) - 1
        token = np.empty(len(words.code) + n_docs, np.int32)
        is_end = np.zeros(len(token), bool)
        is_end[last] = True
        token[is_end], token[~is_end] = self.end, words.code
        context = np.empty_like(token)
        context[1:] = token[:-1]
        context[last - self.sizes + 1] = self.begin
        self.token, self.context = token, context
        self.doc = np.repeat(np.arange(n_docs, dtype=np.int32), self.sizes)
        del is_end, last
        pairs, which = np.unique(context.astype(np.int64) * (n_words + 2) + token, return_inverse=True)
        self.pair = which.astype(np.int32)
        del which
        hashes = np.append(words.hashes(SEED)[:, 0], [_END, _BEGIN])
        left, right = hashes[pairs // (n_words + 2)], hashes[pairs % (n_words + 2)]
        one = X.scramble(hashes) | np.uint64(1)
        two = X.scramble(X.scramble(left) * np.uint64(0x9E3779B97F4A7C15) + right) & ~np.uint64(1)
        # Keys in order; ``at`` leads from a local number (unigrams, then bigrams) to its key.
        self.keys, self.at = np.unique(np.concatenate([one, two]), return_inverse=True)
        self.n_one = len(one)

    def counts(self, docs: np.ndarray) -> np.ndarray:
        """Of every key, how often the chosen documents hold it (the begin: their number)."""
        chosen = docs[self.doc]
        one = np.bincount(self.token[chosen], minlength=self.n_one)
        one[self.begin] = np.count_nonzero(docs)
        two = np.bincount(self.pair[chosen], minlength=len(self.at) - self.n_one)
        return np.bincount(self.at, np.concatenate([one, two]), len(self.keys)).astype(np.int64)


REQUEST = "bucket int, block int, size int, keys binary, counts binary"
ANSWER = "bucket int, block int, size int, counts binary, tokens long, vocabulary long"


def _requests(buckets: int):
    bounds = X.bucket_bounds(buckets)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        grams = Grams(table.column("text"))
        counts = grams.counts(~table.column("held_out").to_numpy())
        cuts = [0, *np.searchsorted(grams.keys, bounds).tolist(), len(grams.keys)]
        rows = [
            (b, key[0].as_py(), hi - lo, X.pack_sorted(grams.keys[lo:hi]), X.pack(counts[lo:hi]))
            for b, (lo, hi) in enumerate(zip(cuts, cuts[1:]))
            if hi > lo
        ]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["bucket", "block", "size", "keys", "counts"])

    return run


def _answer(key: tuple, table: pa.Table) -> pa.Table:
    """Corpus counts of the keys of a bucket, for every block that asked."""
    sizes = table.column("size").to_pylist()
    keys = np.concatenate([X.unpack_sorted(k, n) for k, n in zip(table.column("keys").to_pylist(), sizes)])
    counts = np.concatenate([X.unpack(c, n) for c, n in zip(table.column("counts").to_pylist(), sizes)])
    distinct, which = np.unique(keys, return_inverse=True)
    total = np.bincount(which, counts.astype(np.float64), len(distinct)).astype(np.int64)
    begin = X.scramble(np.array([_BEGIN], np.uint64))[0] | np.uint64(1)
    word = (distinct & np.uint64(1) == 1) & (distinct != begin) & (total > 0)
    ends = np.cumsum(sizes)
    n = len(sizes)
    tokens, vocabulary = [0] * n, [0] * n
    tokens[0], vocabulary[0] = int(total[word].sum()), int(word.sum())
    return pa.table(
        {
            "bucket": table.column("bucket"),
            "block": table.column("block"),
            "size": table.column("size"),
            "counts": pa.array([X.pack(total[which[e - s : e]]) for s, e in zip(sizes, ends)], pa.binary()),
            "tokens": pa.array(tokens, pa.int64()),
            "vocabulary": pa.array(vocabulary, pa.int64()),
        }
    )


def _looked_up(grams: Grams, answers: pa.Table) -> np.ndarray:
    """Corpus counts of the block's local numbers."""
    answers = answers.sort_by("bucket")
    parts = [X.unpack(c, n) for c, n in zip(answers.column("counts").to_pylist(), answers.column("size").to_pylist())]
    return np.concatenate(parts).astype(np.int64)[grams.at]


def _share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    return np.where(np.asarray(total) > 0, count / np.maximum(total, 1), 0.0)


def context_class(count: np.ndarray) -> np.ndarray:
    """Number of binary digits of a count."""
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 0)


def _grid(tokens: int):
    """Count the tokens of tuning documents by context class and quantised estimates."""

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        grams = Grams(docs.column("text"))
        count = _looked_up(grams, answers)
        n_one = grams.n_one
        # A document's own counts: of its tokens, contexts and pairs.
        def own(number: np.ndarray) -> np.ndarray:
            _, which, times = np.unique(
                grams.doc.astype(np.int64) * (len(count) + 1) + number, return_inverse=True, return_counts=True
            )
            return times[which]

        one = count[grams.token] - own(grams.token)
        two = count[n_one + grams.pair] - own(grams.pair)
        seen = count[grams.context] - own(grams.context)
        p1 = _share(one, tokens - grams.sizes[grams.doc])
        p2 = _share(two, seen)
        step = [np.where(p > 0, np.round(GRID * np.log10(np.where(p > 0, p, 1))), -9999).astype(np.int64) for p in (p1, p2)]
        cells, times = np.unique(np.stack([context_class(seen), *step], 1), axis=0, return_counts=True)
        return pa.table(
            {"class": pa.array(cells[:, 0], pa.int32()), "q1": pa.array(cells[:, 1], pa.int32()),
             "q2": pa.array(cells[:, 2], pa.int32()), "n": pa.array(times, pa.int64())}
        )

    return run


def learned_weights(cells: np.ndarray, vocabulary: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (class, uniform / unigram / bigram) that make the grid's tokens likeliest.

    ``cells``: class, q1, q2, n.  A class without tokens takes the weights of all classes together.
    """
    p0 = np.full(len(cells), 1 / (vocabulary + 1))
    p1, p2 = (np.where(q == -9999, 0.0, 10.0 ** (q / GRID)) for q in (cells[:, 1], cells[:, 2]))
    parts, n = np.stack([p0, p1, p2], 1), cells[:, 3].astype(float)

    def expectation_maximisation(chosen: np.ndarray) -> np.ndarray:
        mix = np.full(3, 1 / 3)
        for _ in range(rounds if chosen.any() else 0):
            posterior = parts[chosen] * mix
            posterior /= posterior.sum(1, keepdims=True)
            mix = (posterior * n[chosen, None]).sum(0) / n[chosen].sum()
            mix = np.maximum(mix, [1e-6, 0, 0]) / np.maximum(mix, [1e-6, 0, 0]).sum()
        return mix

    pooled = expectation_maximisation(np.ones(len(cells), bool))
    weights = np.tile(pooled, (CLASSES + 1, 1))
    for c in set(cells[:, 0].tolist()):
        weights[c] = expectation_maximisation(cells[:, 0] == c)
    return weights


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scores(tokens: int, vocabulary: int, weights: np.ndarray):
    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        grams = Grams(docs.column("text"))
        count = _looked_up(grams, answers)
        one, two, seen = count[grams.token], count[grams.n_one + grams.pair], count[grams.context]
        base = np.log10((one + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
        w = weights[context_class(seen)]
        p2 = _share(two, seen)
        mixed = w[:, 0] / (vocabulary + 1) + w[:, 1] * _share(one, tokens) + w[:, 2] * p2
        n = docs.num_rows
        return pa.table(
            {
                "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"),
                "n_tokens": pa.array(grams.sizes, pa.int64()),
                "n_known": pa.array(np.bincount(grams.doc[one > 0], minlength=n), pa.int64()),
                "base_score": pa.array(np.bincount(grams.doc, base, n), pa.float64()),
                "score": pa.array(np.bincount(grams.doc, np.log10(mixed), n), pa.float64()),
            }
        )

    return run


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = X.BLOCK_BYTES, bucket_keys: int = X.BUCKET_KEYS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Learns from the rows whose id's crc32 is not 0 mod 10.
    """
    spark = docs.sparkSession
    size = X.text_bytes(docs, text_col)
    blocks, buckets = X.blocks_for(size, block_bytes), X.buckets_for(2 * size, bucket_keys)
    tuning_blocks = X.blocks_for(size // 10, block_bytes)
    # With the text, so that rows of one id lie in many blocks; their order does not matter.
    place = F.xxhash64(id_col, text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        (remainder(id_col) == 0).alias("held_out"),
        # Tuning documents have blocks of their own, so that they can be read alone.
        F.when(remainder(id_col) == TUNED, F.pmod(place, F.lit(tuning_blocks)) + blocks)
        .otherwise(F.pmod(place, F.lit(blocks)))
        .cast("int")
        .alias("block"),
    )
    requests = rows.select("block", "text", "held_out").groupBy("block").applyInArrow(_requests(buckets), REQUEST)
    answers = stage(requests.groupBy("bucket").applyInArrow(_answer, ANSWER), "ngram-counts")
    X.free_shuffles(spark)
    tokens, vocabulary = (x or 0 for x in answers.agg(F.sum("tokens"), F.sum("vocabulary")).first())
    counts = answers.select("block", "bucket", "size", "counts")
    tuning = rows.filter(F.col("block") >= blocks).select("block", "text").groupBy("block")
    tuning_counts = counts.filter(F.col("block") >= blocks).groupBy("block")
    cells = (
        tuning.cogroup(tuning_counts)
        .applyInArrow(_grid(tokens), "class int, q1 int, q2 int, n long")
        .groupBy("class", "q1", "q2")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    grid = np.array(sorted(tuple(c) for c in cells), np.int64).reshape(-1, 4)
    weights = learned_weights(grid, vocabulary)
    scored = rows.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_scores(tokens, vocabulary, weights), SCORES)
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long"))
