import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.functions import similarity
from recordloom.functions.similarity import (
    SIGNATURE_COLUMNS,
    could_exceed,
    jaro_winkler,
    score_pairs,
    with_signature,
)

texts = st.text(alphabet="abcde éß😀 12", max_size=150)


def reference(left, right):
    con = duckdb.connect()
    con.register("t", pa.table({"i": range(len(left)), "l": left, "r": right}))
    rows = con.sql("SELECT jaro_winkler_similarity(l, r) FROM t ORDER BY i").fetchall()
    return np.array([r[0] for r in rows])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=30))
def test_scores_agree_with_an_independent_engine(pairs):
    left, right = map(list, zip(*pairs))
    np.testing.assert_allclose(
        score_pairs(pa.array(left), pa.array(right)), reference(left, right), atol=1e-12
    )


def test_edited_long_texts():
    rng = np.random.default_rng(3)
    left, right = [], []
    for size in (63, 64, 65, 127, 128, 129, 500, 3000):
        for _ in range(20):
            a = list(rng.choice(list("abcdefgh ü"), size))
            b = a.copy()
            for at in rng.integers(0, size - 1, 6):
                b[at], b[at + 1] = b[at + 1], b[at]
            left.append("".join(a))
            right.append("".join(b[int(rng.integers(0, 9)) :]))
    np.testing.assert_allclose(
        score_pairs(pa.array(left), pa.array(right)), reference(left, right), atol=1e-12
    )


def test_edge_scores():
    left = ["", "a", "a", "abcd", "same"]
    right = ["", "", "a", "abxyzw", "same"]
    assert score_pairs(pa.array(left), pa.array(right)) == pytest.approx(
        [0.0, 0.0, 1.0, 0.6111111111, 1.0]
    )


def test_null_scores(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("ab", "ab")], "l string, r string")
    assert [r[0] for r in df.select(jaro_winkler("l", "r")).collect()] == [None, None, 1.0]


@pytest.mark.parametrize("threshold", [0.95, 0.9, 0.85, 0.7, 0.5])
def test_bound_never_drops_a_hit(spark, threshold):
    rng = np.random.default_rng(int(threshold * 100))
    rows = []
    for _ in range(3000):
        a = "".join(rng.choice(list("abcdeé "), rng.integers(0, 25)))
        b = list(a)
        for _ in range(rng.integers(0, 5)):
            if b:
                b[rng.integers(0, len(b))] = str(rng.choice(list("abcdexyzé")))
        rows.append((a, "".join(b)[rng.integers(0, 3) :]))
    df = spark.createDataFrame(rows, "l string, r string")

    def sketched(frame, text, suffix):
        added = with_signature(frame, text)
        return added.withColumnsRenamed({c: f"{c}_{suffix}" for c in SIGNATURE_COLUMNS})

    df = sketched(sketched(df, "l", "a"), "r", "b")
    df = df.withColumn("score", jaro_winkler("l", "r"))
    hits = df.filter(F.col("score") > threshold)
    kept = could_exceed("a", "b", threshold)
    counts = hits.agg(F.count(F.lit(1)), F.count(F.when(kept, 1))).first()
    assert counts[0] == counts[1] > 0


def test_a_text_of_many_pairs_is_sorted_once(monkeypatch):
    sorted_rows, real = [], similarity._matrix
    monkeypatch.setattr(similarity, "_matrix", lambda raw, starts, lengths: sorted_rows.append(len(starts)) or real(raw, starts, lengths))
    words = [f"{'harbor mill ' * (i % 7)}{i:03d} old house {'x' * (i % 5)}" for i in range(40)]
    left, right = [w for w in words for _ in words], words * len(words)
    assert score_pairs(pa.array(left), pa.array(right)) == pytest.approx(reference(left, right), abs=1e-12)
    assert sum(sorted_rows) == len(words)


def test_matches_at_the_edge_of_the_window():
    """Bytes of one value whose first, second, ... occurrences lie too far apart, beside some that do not."""
    rng = np.random.default_rng(8)
    left, right = [], []
    for _ in range(400):
        body = list("etaoin" * 9)
        for side in (left, right):
            text = body.copy()
            for rare in "qqzzjv":
                text.insert(int(rng.integers(0, len(text))), rare)
            side.append("".join(text[int(rng.integers(0, 9)) :]))
    left, right = [*left, None, "", "a" * 300, "ab"], [*right, "a", "b", "a" * 7, "ba"]
    got = score_pairs(pa.array(left), pa.array(right))
    assert got[:400] == pytest.approx(reference(left[:400], right[:400]), abs=1e-12)
    assert got[402:] == pytest.approx(reference(left[402:], right[402:]), abs=1e-12) and list(got[400:402]) == [0, 0]


@pytest.mark.parametrize("cells", [1 << 21, 300])
def test_pairs_of_one_text_are_scored_together(monkeypatch, cells):
    """Near texts, rare bytes beyond the window, lengths that differ much, one text too long for a matrix."""
    rng = np.random.default_rng(5)
    singly, real = [], similarity._jaro_winkler_block
    monkeypatch.setattr(similarity, "_CELLS", cells)
    monkeypatch.setattr(similarity, "_jaro_winkler_block", lambda texts, a, b: singly.append(len(a)) or real(texts, a, b))
    alphabets = "etaoin shr", "etaoin shrdlu qzxjv", "abé😀 ü"
    words = ["".join(rng.choice(list(alphabets[i % 3]), rng.integers(1, 160))) for i in range(24)]
    words += [f"{w[: len(w) // 2]}{chr(97 + i)}{w[len(w) // 2 :]}q" for i, w in enumerate(words)]
    left, right = [w for w in words for _ in words], words * len(words)
    assert score_pairs(pa.array(left), pa.array(right)) == pytest.approx(reference(left, right), abs=1e-12)
    assert sum(singly) == 0
    long = "ab " * similarity._LONG
    left, right = [long, *words, None, "", words[0]], [*words, long, "a", "a", None]
    assert score_pairs(pa.array(left), pa.array(right))[:-3] == pytest.approx(reference(left[:-3], right[:-3]), abs=1e-12)
    assert sum(singly) == len(words) + 1
