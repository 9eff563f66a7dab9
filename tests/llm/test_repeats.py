from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from recordloom.llm import exchange, repeats

from .conftest import words


def plain(rows, window=20):
    """Remove each word under a window that starts earlier too; equal ids in order of text hash."""
    seen, out = set(), []
    for doc_id, _, _, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2] or 0)):
        found = (text or "").encode().split()
        gone = [False] * len(found)
        for i in range(len(found) - window + 1):
            key = tuple(found[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(found, gone) if not g)
        out.append((doc_id, len(found), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def check(docs, **sizes):
    rows = [tuple(r) for r in docs.select("doc_id", F.lit(0), F.xxhash64("text"), "text").collect()]
    found = [tuple(r) for r in repeats.remove_repeats(docs, **sizes).collect()]
    assert sorted(map(str, found)) == sorted(map(str, plain(rows, sizes.get("window", 20))))
    return {r[0]: r for r in found}


@pytest.mark.parametrize("frame", ["messy", "sample", "nothing"])
@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 60_000, "bucket_keys": 9000}])
def test_equals_brute_force(frame, sizes, request):
    check(request.getfixturevalue(frame), **sizes)


def test_small_windows_branch_and_cycle(docs_of):
    rows = [(1, "a b a b a b a b a b", "s"), (2, "x a b a b a y", "s"), (3, "c d e f g h", "s"), (4, "z c d e q f g h", "s")]
    rows += [(5, "a " * 40, "s"), (6, "b a a a c d e f g h a b", "s")]
    for window in (2, 3, 5):
        check(docs_of(rows), window=window, block_bytes=12, bucket_keys=3)


def test_paths_are_compacted_with_their_source(docs_of):
    docs = docs_of([(1, words(100), "s"), (2, "own " + words(60, 20) + " own", "s"), (3, words(40, 30), "s")])
    found = repeats.repeated_spans(docs).filter("n_words IS NULL").orderBy("doc_id", "start").collect()
    assert [(r.doc_id, r.start, r.words, r.source_ordinal) for r in found] == [(2, 1, 60, 20), (3, 0, 40, 30)]


def test_collisions_are_found_and_avoided(docs_of):
    """With few key bits many windows share a key; passes go on until no span is refuted."""
    rows = [(i, words(90, 100 * i) + " " + words(30, 7000) + " " + words(5, 3 * i), "s") for i in range(12)]
    docs = docs_of(rows)
    wanted = sorted(tuple(r) for r in repeats.remove_repeats(docs).collect())
    assert sorted(r[2] for r in wanted) == [0] + [30] * 11
    for bits in (18, 14):
        found = repeats.remove_repeats(docs, key_bits=bits, block_bytes=2000, bucket_keys=300).collect()
        assert sorted(tuple(r) for r in found) == wanted


def test_a_refuted_span_names_its_keys(docs_of):
    import numpy as np
    import pyarrow as pa

    table = pa.table({"doc_id": range(6), "place": range(6), "text": [words(60, 100 * i) for i in range(6)], "text_hash": [0] * 6})
    key, few = (pa.scalar(0, pa.int32()),), repeats.Avoid(6)
    found = repeats._resolve(1, few, 20)(key, table, repeats._table([], repeats.ANSWER)).to_pylist()
    spans = [r for r in found if r["n_words"] is None]
    paths = pa.table({c: [r[c] for r in spans] for c in ("source_ordinal", "words", "check")})
    wrong = repeats._refuted(few, 20)(key, table, paths).column("wrong").to_numpy().view(np.uint64)
    assert len(wrong) and set(wrong.tolist()) <= set(repeats.Edges(table, few, 20).key.tolist())
    clean = repeats._resolve(1, repeats.Avoid(), 20)(key, table, repeats._table([], repeats.ANSWER)).to_pylist()
    assert not [r for r in clean if r["n_words"] is None]


def test_range_numbers(spark):
    bounds = [5, 9, 10, 40, 41, 70, 300]
    got = spark.range(0, 400).select("id", repeats.range_number(F.col("id"), bounds).alias("n")).collect()
    assert all(r.n == sum(b <= r.id for b in bounds) for r in got)


def test_planes_round_trip():
    import numpy as np

    rng = np.random.default_rng(0)
    for n in (0, 1, 1000):
        values = rng.integers(0, 1 << 63, n).astype(np.uint64) >> rng.integers(0, 60, n).astype(np.uint64)
        assert (exchange.unpack(exchange.pack(values), n) == values).all()
        values.sort()
        assert (exchange.unpack_sorted(exchange.pack_sorted(values), n) == values).all()
