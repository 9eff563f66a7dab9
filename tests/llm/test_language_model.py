from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from recordloom.llm import language_model as L


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def plain(rows):
    """Counts, base scores and the model's mixture by definition."""
    remainder = {i: zlib.crc32(str(i if i is not None else "").encode()) % 10 for i, _ in rows}
    train = [tokens(t) for i, t in rows if remainder[i]]
    one = Counter(w for ws in train for w in ws)
    two = Counter(p for ws in train for p in zip([b"<s>", *ws], ws))
    context = Counter(h for ws in train for h in [b"<s>", *ws[:-1]])
    total = sum(one.values())
    out = []
    cells = Counter()
    for i, t in rows:
        ws = tokens(t)
        pairs = list(zip([b"<s>", *ws], ws))
        base = sum(math.log10((one[w] + 0.1) / (total + 0.1 * (len(one) + 1))) for w in ws)
        parts = [(context[h], one[w], two[h, w]) for h, w in pairs]
        out.append((i, remainder[i] == 0, len(ws), sum(one[w] > 0 for w in ws), total, base, parts))
        if remainder[i] == L.TUNED:
            own1, own2, ownc = Counter(ws), Counter(pairs), Counter(h for h, _ in pairs)
            for h, w in pairs:
                c = context[h] - ownc[h]
                p1, p2 = (one[w] - own1[w]) / (total - len(ws)), (two[h, w] - own2[h, w]) / c if c else 0
                q = [round(L.GRID * math.log10(p)) if p > 0 else -9999 for p in (p1, p2)]
                cells[(c.bit_length(), *q)] += 1
    grid = np.array(sorted((*k, n) for k, n in cells.items()), np.int64).reshape(-1, 4)
    weights = L.learned_weights(grid, len(one))
    scored = []
    for *head, parts in out:
        mixed = sum(
            math.log10(weights[c.bit_length()] @ [1 / (len(one) + 1), n1 / total if total else 0, n2 / c if c else 0])
            for c, n1, n2 in parts
        )
        scored.append((*head, mixed))
    return scored


@pytest.mark.parametrize("frame", ["messy", "sample", "nothing"])
@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 50_000, "bucket_keys": 5000}])
def test_equals_the_definitions(frame, sizes, request):
    docs = request.getfixturevalue(frame)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = [
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
        for r in L.score_texts(docs, **sizes).collect()
    ]
    expected = plain(rows)
    if frame == "messy":  # the tuning documents there are none or single, so only the counts are compared
        expected, found = [r[:6] for r in expected], [r[:6] for r in found]
    key = lambda r: (str(r[0]), r[2])
    for a, b in zip(sorted(expected, key=key), sorted(found, key=key), strict=True):
        assert a[:5] == b[:5] and b[5:] == pytest.approx(a[5:], rel=1e-6)


def test_weights_favour_what_predicts():
    # In class 5 bigrams foresee every token, in class 1 they foresee none.
    cells = np.array([[5, -60, -2, 100], [1, -40, -9999, 100]])
    weights = L.learned_weights(cells, 1000)
    assert weights[5][2] > 0.95 and weights[1][1] > 0.9 and weights[1][2] < 0.01
    assert weights[30] == pytest.approx(L.learned_weights(np.array([[7, -60, -2, 100], [7, -40, -9999, 100]]), 1000)[7])
    assert L.learned_weights(np.zeros((0, 4), np.int64), 0) == pytest.approx(np.full((L.CLASSES + 1, 3), 1 / 3))


def test_model_beats_the_base_on_held_out_texts(sample):
    found = [r for r in L.score_texts(sample).collect() if r.held_out]
    assert sum(r.score for r in found) > sum(r.base_score for r in found)
