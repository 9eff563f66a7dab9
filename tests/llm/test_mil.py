from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import mil

from .conftest import words


def test_every_passage_is_encoded():
    text = ("Alpha beta! " * 32 + "x " * 64 + "12 ").encode()
    found = mil.encode(text)
    assert found.shape == (3, mil.N_FEATURES) and np.isfinite(found).all()
    assert mil.encode(b"").shape == (1, mil.N_FEATURES) and not mil.encode(None).any()
    assert (mil.encode(b"  \n " + text) == found).all()


def test_slopes_equal_differences():
    rng = np.random.default_rng(1)
    bags = [rng.standard_normal((n, mil.N_FEATURES)) for n in (1, 4, 2)]
    labels = np.array([1.0, 0.0, 1.0])
    model = mil.Model.fit(bags, labels)
    x, first = (np.concatenate(bags) - model.mean) / model.scale, np.array([0, 1, 5])
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}

    def loss():
        s = model._forward(x, first)["score"]
        return -np.mean(labels * np.log(s) + (1 - labels) * np.log(1 - s))

    for name, slope in model._slopes(x, first, labels).items():
        weight = model.weights[name]
        at = tuple(rng.integers(0, n) for n in weight.shape)
        before = weight[at]
        weight[at] = before + 1e-6
        above = loss()
        weight[at] = before - 1e-6
        below = loss()
        weight[at] = before
        assert slope[at] == pytest.approx((above - below) / 2e-6, abs=1e-5)


def test_attention_finds_the_telling_passage(spark, docs_of):
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(240):
        passages = [" ".join(f"wort{rng.integers(9999)}" for _ in range(64)) for _ in range(5)]
        bad = i % 3 == 0
        if bad:
            passages[i % 5] = "### " * 64
        rows.append((i, " ".join(passages), "a"))
        labels.append((i, int(not bad), 0))
    docs = docs_of(rows)
    marks = spark.createDataFrame([*labels, (9999, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in mil.score(docs, mil.fit(docs, marks)).collect()}
    held = [i for i in found if found[i].held_out]
    assert 40 < len(held) < 120
    assert sum(found[i].predicted == labels[i][1] for i in held) >= 0.97 * len(held)
    bad = [i for i in held if i % 3 == 0]
    assert sum(found[i].top_passage == i % 5 for i in bad) >= 0.8 * len(bad)


def test_labels_of_held_out_documents_do_not_count(spark, sample):
    marks = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    other = marks.withColumn("quality", F.when(mil.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    found, again = (
        sorted(map(tuple, mil.score(sample, mil.fit(sample, m)).collect())) for m in (marks, other)
    )
    assert found == again and all(0 <= r[2] <= 1 for r in found)


def test_messy_and_empty_tables(spark, messy, nothing):
    marks = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (9, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    found = mil.score(messy, mil.fit(messy, marks)).collect()
    assert len(found) == messy.count() and all(0 <= r.score <= 1 for r in found)
    none = mil.fit(messy, marks.limit(0))
    assert {r.score for r in mil.score(messy, none).collect()} == {0.5}
    assert mil.score(nothing, none).collect() == []
