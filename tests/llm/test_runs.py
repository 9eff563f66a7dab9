from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import runs

from .conftest import words


def plain(w, least=6, times=4):
    """Runs (start, length, smallest period) by comparing every word with the one a period later."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i if i < a else a + (i - a) % p] for i in range(n)]


@settings(deadline=None, max_examples=300)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4), st.sampled_from([(6, 4), (1, 2), (8, 3), (3, 4)]))
def test_runs_of_several_texts(texts, limits):
    code = np.array([x for t in texts for x in t], np.int64)
    ends = np.cumsum([len(t) for t in texts])
    want, begin = [], 0
    for t in texts:
        want += [(s + begin, length, q) for s, length, q in plain(t, *limits)]
        begin += len(t)
    assert runs.runs_of(code, ends, *limits) == want


def test_ranks_and_prefixes_of_suffixes():
    rng = random.Random(1)
    for k in (1, 2, 5):
        w = [rng.randrange(k) for _ in range(80)]
        ranks = runs.doubled_ranks(np.array(w))
        assert np.argsort(ranks[-1]).tolist() == sorted(range(80), key=lambda i: w[i:])
        a, b = np.array([rng.randrange(80) for _ in range(60)]), np.array([rng.randrange(80) for _ in range(60)])
        a, b = a[a != b], b[a != b]
        got = runs.common_prefix(ranks, a, b)
        for i, j, n in zip(a.tolist(), b.tolist(), got.tolist()):
            assert w[i : i + n] == w[j : j + n] and (i + n == 80 or j + n == 80 or w[i + n] != w[j + n])


def check(docs):
    # Bytes split at ASCII white space only.
    rows = [(i, (t or "").encode().split()) for i, t in docs.select("doc_id", "text").collect()]
    want = []
    for doc_id, w in rows:
        w = planted(doc_id, w)
        found = plain(w)
        dropped = {i for s, length, q in found for i in range(s + q, s + length)}
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        rest = b" ".join(x for i, x in enumerate(w) if i not in dropped)
        milli = best[1] * 1000 // best[2] if found else None
        want.append((doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest).hexdigest()))
    given_ = runs.with_planted_runs(docs)
    assert given_.columns == docs.columns
    got = runs.digests(runs.periodic_runs(given_, carry=["doc_id"])).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    return want


@pytest.mark.parametrize("frame", ["messy", "sample", "nothing"])
def test_digests_equal_the_definition(frame, request):
    check(request.getfixturevalue(frame))


def test_planted_and_awkward_texts(docs_of):
    rng = random.Random(9)
    texts = [words(rng.randint(0, 300)) for _ in range(120)]
    texts += ["a " * 3000, "a b " * 2000 + "c " + "a b " * 900, " ".join(rng.choice("ab") for _ in range(1500)), "x\u00a0x " * 12, "é " * 6, "y " * 5]
    want = check(docs_of([(i, t, "a") for i, t in enumerate(texts)]))
    assert sum(w[1] > 0 for w in want) > 10


def test_every_column_is_carried_and_slices_change_nothing(docs_of):
    docs = docs_of([(i, ("ab cd " * 9 + words(20, i)) * (i % 3), "a") for i in range(40)])
    whole = runs.periodic_runs(docs, name="runs_found").orderBy("doc_id").collect()
    assert whole == runs.periodic_runs(docs, name="runs_found", slice_bytes=200).orderBy("doc_id").collect()
    assert runs.periodic_runs(docs, name="runs_found").columns == [*docs.columns, "runs_found"]
    row = whole[1].runs_found
    assert [tuple(r) for r in row.runs] == [(0, 18, 2)] and row.n_words == 38
    assert row.collapsed == "ab cd " + words(20, 1)
