from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from recordloom.llm import phrases


def counts_of(rows, most_words=3):
    counts, words = Counter(), Counter()
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang or "und"] += len(w)
            for n in range(1, most_words + 1):
                for i in range(len(w) - n + 1):
                    counts[lang or "und", tuple(w[i : i + n])] += 1
    return counts, words


def plain(rows, least=10, top=2000, most_words=3):
    counts, words = counts_of(rows, most_words)
    candidates = {k: a for k, a in counts.items() if len(k[1]) >= 2 and a >= least}
    dropped = {
        (lang, w[i : i + n])
        for (lang, w), longer in candidates.items()
        for n in range(2, len(w))
        for i in range(len(w) - n + 1)
        if 100 * longer >= 50 * candidates.get((lang, w[i : i + n]), 0)
    }
    ranked = defaultdict(list)
    for (lang, w), a in candidates.items():
        if (lang, w) in dropped:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = counts[lang, w[:k]], counts[lang, w[k:]]
            cuts.append((10**6 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        ranked[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, i, phrase.decode(), -a, left, right, words[lang], -score)
        for lang, its in ranked.items()
        for i, (score, a, phrase, left, right) in enumerate(sorted(its)[:top], 1)
    )


def found(docs, **options):
    rows = phrases.collocations(docs, **options).collect()
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    some = ["the", "old", "MILL", "of", "north", "É", "日本", "x1", "a-b", "\x1c"]
    rows = []
    for i in range(240):
        n = rng.choice([0, 1, 3, 30, 60])
        text = "".join(rng.choice(some) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!"]) for _ in range(n))
        rows.append((i, text if rng.random() < 0.95 else None, rng.choice(["en", "en", "fr", None]), "x"))
    rows += [(None, "the old mill of north " * 40, "de", "x")] * 3 + [(900 + i, "hot words here", "en", "x") for i in range(80)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase string"), [(r[1], r[2]) for r in rows]


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 700, "partition_mass": 900}, {"block_bytes": 300, "partition_mass": 200, "slack": 1.0}])
def test_collocations_equal_the_definition(corpus, sizes):
    docs, rows = corpus
    want = plain(rows)
    assert found(docs, **sizes) == want and len({w[0] for w in want}) >= 3


@pytest.mark.parametrize("options", [{"least": 3, "top": 7}, {"least": 5, "most_words": 4}, {"most_words": 2}])
def test_other_limits(corpus, options):
    docs, rows = corpus
    assert found(docs, **options) == plain(rows, **options)


def test_messy_and_empty_tables(messy, nothing):
    rows = [(r.text, r.lang) for r in messy.select("text", "lang").collect()]
    assert found(messy, least=2) == plain(rows, least=2)
    assert found(nothing) == []


def test_sample(sample):
    rows = [(r.text, r.lang) for r in sample.select("text", "lang").collect()]
    assert found(sample, block_bytes=50_000) == plain(rows)


def test_summaries_keep_every_frequent_key_and_merge():
    rng = np.random.default_rng(1)
    for least, slack in ((10, 1), (10, 2), (4, 1)):
        keys = np.concatenate([rng.integers(0, 5000, 20_000), rng.zipf(1.3, 20_000) % 3000 + 10_000]).astype(np.uint64)
        rng.shuffle(keys)
        true = Counter(keys.tolist())
        capacity = int(slack * len(keys) / least) + 1
        parts = []
        for chunk in np.array_split(keys, 7):
            part = phrases.Summary(capacity // 3)
            for piece in np.array_split(chunk, 3):
                part.merge(*np.unique(piece, return_counts=True))
            parts.append(part)
        whole = phrases.Summary(capacity)
        for chunk in np.array_split(keys, 9):
            whole.merge(*np.unique(chunk, return_counts=True))
            assert len(whole.keys) <= capacity
        assert whole.taken < least
        kept = dict(zip(whole.keys.tolist(), whole.counts.tolist()))
        assert all(kept.get(k, 0) <= n <= kept.get(k, 0) + whole.taken for k, n in true.items())
        assert {k for k, n in true.items() if n >= least} <= set(whole.frequent(least).tolist())
        # Summaries of parts merge into one that bounds the same counts.
        merged = phrases.Summary(capacity)
        for part in parts:
            merged.merge(part.keys, part.counts, part.taken)
        kept = dict(zip(merged.keys.tolist(), merged.counts.tolist()))
        assert all(kept.get(k, 0) <= n <= kept.get(k, 0) + merged.taken for k, n in true.items())


def test_few_hash_bits_lose_nothing():
    """Colliding hashes add up: a phrase of a block is under its key with all that share it."""
    texts = pa.chunked_array([["a b c. a b", "b c, d", "", None, "x"]])
    langs = pa.chunked_array([["en", "fr", None, "en", None]])
    block = phrases.Phrases(texts, langs, 3, 3)
    assert block.key_counts.sum() == 5 + 3 + 1 + 3 + 1 + 1
    rows = block.texts(np.ones(len(block.keys), bool)).to_pylist()
    held = {(r["lang"], r["phrase"]): r["n"] for r in rows if r["words"]}
    want, _ = counts_of([("a b c. a b", "en"), ("b c, d", "fr"), ("x", None)])
    assert held == {(lang, " ".join(w)): n for (lang, w), n in want.items()}


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3 * 10**9 + 1, 4 * 10**9 + 3, 5 * 10**9 + 7
    counts = spark.createDataFrame(
        [("en", 2, "p q", a), ("en", 1, "p", left), ("en", 1, "q", right)], "lang string, words int, phrase string, n long"
    )
    row = phrases.scored(counts).first()
    assert row.score == int(Fraction(10**6 * a * a, left * right)) and (row.a, row.l, row.r) == (a, left, right)
