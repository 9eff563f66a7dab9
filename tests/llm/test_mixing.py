from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest

from recordloom.llm import mixing


def plain_targets(sizes):
    """Share and reshare until no target lies above three times its source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in held]
        rate = (total - sum(held.values())) / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if rate * weight[s] > 3 * sizes[s]]
        if not above:
            return {s: held.get(s, rate * weight[s]) for s in order}
        held |= {s: 3.0 * sizes[s] for s in above}


def rows(docs):
    return [r.asDict() for r in mixing.mix(docs).collect()]


@pytest.mark.parametrize("frame", ["messy", "sample"])
def test_targets_and_limits(frame, request):
    docs = request.getfixturevalue(frame)
    mixed = rows(docs)
    sizes = defaultdict(int)
    for r in mixed:
        sizes[r["source"]] += r["size"]
    targets = plain_targets(dict(sizes))
    assert len(mixed) == docs.count()
    taken = defaultdict(int)
    for r in mixed:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in targets.items():
        largest = max(r["size"] for r in mixed if r["source"] == source)
        assert abs(taken[source] - target) <= largest / 2 + 1e-6
    assert rows(docs) == mixed or sorted(map(str, rows(docs))) == sorted(map(str, mixed))


def test_sizes_count_words_of_whole_texts(messy):
    size = {r["doc_id"]: r["size"] for r in rows(messy)}
    assert (size[1], size[2], size[3], size[4], size[9], size[10]) == (0, 0, 0, 20_000, 1, 3)


def test_uneven_odds_inside_a_source(docs_of):
    docs = docs_of([(i, "x " * n, s) for i, (n, s) in enumerate([(2, "a"), (900, "a")] * 40 + [(500, "b")] * 400)])
    odds = defaultdict(set)
    for r in rows(docs):
        odds[r["source"]].add((r["size"], r["copies"]))
    small = [c for n, c in odds["a"] if n == 2]
    large = [c for n, c in odds["a"] if n == 900]
    assert min(small) >= min(large)


def test_documents_repeat_as_often_as_taken(messy):
    copies = defaultdict(int)
    for r in rows(messy):
        copies[r["doc_id"]] += r["copies"]
    found = defaultdict(int)
    mixed = mixing.mixed_documents(messy)
    assert mixed.columns == messy.columns
    for r in mixed.collect():
        found[r.doc_id] += 1
    assert {k: v for k, v in copies.items() if v and k != 9} == {k: v for k, v in found.items() if k != 9}


def test_empty_table(nothing):
    assert rows(nothing) == []
    assert mixing.mixed_documents(nothing).collect() == []


def test_sql_agrees(sample):
    con = duckdb.connect()
    con.register("documents", sample.toPandas())
    expected = con.sql(mixing.MIX_SQL.format(docs="documents") + "SELECT doc_id, target, copies FROM mixed").fetchall()
    assert sorted(expected) == sorted((r["doc_id"], r["target"], r["copies"]) for r in rows(sample))
