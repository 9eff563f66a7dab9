from __future__ import annotations

import itertools
import random

import pytest

from recordloom.llm import decontaminate as D

from .conftest import words


def plain(text, item):
    """Whether any diagonal has a run of item tokens that agrees well enough."""
    x, y = D.tokens(text), D.tokens(item)
    run = min(D.LEAST_RUN, len(y))
    if len(y) < D.LEAST_ITEM:  # as a whole
        return bool(y) and any(x[i : i + len(y)] == y for i in range(len(x)))
    for shift in range(-len(y), len(x)):
        equal = [0 <= i + shift < len(x) and x[i + shift] == w for i, w in enumerate(y)]
        inside = [0 <= i + shift < len(x) for i in range(len(y))]
        for i in range(len(y) - run + 1):
            if all(inside[i : i + run]) and sum(equal[i : i + run]) >= D.LEAST_SHARE * run:
                return True
    return False


@pytest.mark.parametrize("n", range(8, 21))
def test_no_allowed_replacement_hides_all_seeds(n):
    run = min(n, D.LEAST_RUN)
    gone = int(run * (1 - D.LEAST_SHARE) + 1e-9)
    masks = D.MASKS if n >= D.LEAST_RUN else (*D.MASKS, D.SHORT_MASK)
    for lost in map(set, itertools.combinations(range(run), gone)):
        assert any(
            all(p + i not in lost for i, c in enumerate(m) if c == "1")
            for m in masks
            for p in range(run - len(m) + 1)
        )


@pytest.fixture(scope="module")
def case(spark, docs_of):
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(40)]  # few words, so seeds meet by chance too
    items = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (5, 8, 9, 12, 13, 20, 40, 40)]
    assert len(items) == 8
    items += [items[5].upper().replace(" ", ", "), None, ""]
    texts = []
    for item in items[:8]:
        for replaced in range(6):
            found = item.split()
            for at in rng.sample(range(len(found)), min(replaced, len(found))):
                found[at] = "other"
            texts.append(f"{words(12)} {' '.join(found)}. {words(8, 30)}")
            texts.append(" ".join(found[:11]))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(200)) for _ in range(20)] + [None, "", items[6] * 3]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return docs_of([(i, t, "a") for i, t in enumerate(texts)]), texts, benchmark, items


@pytest.mark.parametrize("block_tokens", [1_000_000, 30])
def test_overlaps_equal_all_diagonals(case, block_tokens, monkeypatch):
    docs, texts, benchmark, items = case
    monkeypatch.setattr(D.blocks, "__defaults__", ("item_id", "text", block_tokens))
    found = {(r.doc_id, r.item_id) for r in D.overlaps(docs, benchmark).collect()}
    assert found == {
        (i, j) for i, t in enumerate(texts) for j, item in enumerate(items) if plain(t, item)
    }
    kept = D.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {i for i, _ in found}


def test_short_null_and_equal_items(spark, docs_of):
    items = [(1, "the exact answer"), (2, "The EXACT answer!"), (None, "another short item of seven tokens"), (3, "日本語の長い問題文"), (4, "yes"), (None, None), (5, "...")]
    texts = [
        "so the exact answer is", "the very exact answer", "it is another short item of seven tokens", "another short item of eight tokens",
        "x 日本語の長い問題文 y", "日本語", "yes", "yesterday", "the exact", "",
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of([(i, t, "a") for i, t in enumerate(texts)])
    found = {(r.doc_id, r.item_id) for r in D.overlaps(docs, benchmark).collect()}
    assert found == {(0, 1), (0, 2), (2, None), (4, 3), (6, 4)}
    assert {r.doc_id for r in D.drop_contaminated(docs, benchmark).collect()} == {1, 3, 5, 7, 8, 9}


def test_messy_and_empty_tables(messy, nothing, case):
    _, _, benchmark, _ = case
    assert D.overlaps(messy, benchmark).collect() == []
    assert D.drop_contaminated(messy, benchmark).count() == messy.count()
    assert D.overlaps(nothing, benchmark).collect() == []
    assert D.overlaps(messy, benchmark.limit(0)).collect() == []
    assert D.drop_contaminated(messy, benchmark.limit(0)).count() == messy.count()
