"""The text index, and links that only connect, against all pairs."""

from __future__ import annotations

import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from recordloom.operators import linkage as L
from recordloom.operators import text_index as X
from recordloom.operators.connect import Forest, connecting_texts
from recordloom.operators.graph import connected_components


def names(n, seed, alphabet="abcdefghij ", low=1, high=14):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(low, high))) for _ in range(n // 2)]
    bent = [x[: (at := rng.randint(0, len(x)))] + rng.choice("xyé") + x[at + 1 :] for x in base]
    return sorted({x for x in base + bent if x.strip()})


def all_pairs(texts_a, texts_b, threshold):
    con = duckdb.connect()
    con.execute("CREATE TABLE a AS SELECT unnest($t) AS x", {"t": texts_a})
    con.execute("CREATE TABLE b AS SELECT unnest($t) AS x", {"t": texts_b})
    sql = "SELECT a.x, b.x FROM a, b WHERE jaro_winkler_similarity(a.x, b.x) > $t"
    return set(con.execute(sql, {"t": threshold}).fetchall())


def frame(spark, texts, block="k"):
    return spark.createDataFrame([(block, x) for x in texts], "block string, name string")


@pytest.mark.parametrize("threshold", [0.5, 0.7, 0.85, 0.9, 0.97])
def test_the_index_finds_every_pair(spark, threshold):
    a, b = names(160, 1), names(120, 2) + names(80, 1)[::3] + ["a" * 700, "é" * 300 + "x"]
    a += ["a" * 690 + "b", "é" * 301]
    left, right = frame(spark, a), frame(spark, sorted(set(b)))
    want = all_pairs(a, sorted(set(b)), threshold)
    one, two = L._sketched(left, ["block"], "name"), L._sketched(right, ["block"], "name")
    posted = X.staged_postings(one, two, ["block"], threshold)
    met = L._met_by_index(one, two, posted, ["block"], threshold).collect()
    assert len(met) == len({(r._text_a, r._text_b) for r in met})
    assert want <= {(r._text_a, r._text_b) for r in met}
    for index_pairs in (0, 1 << 30):
        found = L.similar_texts(left, right, ["block"], "name", threshold, index_pairs=index_pairs).collect()
        assert {(r._text_a, r._text_b) for r in found} == want and len(found) == len(want)


def test_meetings_per_pair_fall_with_the_size_of_the_block(spark):
    """House names of one street: most pairs of a block never meet, and fewer the larger it is."""
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    shares = []
    for n in (100, 400, 1600):
        texts = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(8, 20))) for _ in range(n)})
        one = L._sketched(frame(spark, texts), ["block"], "name")
        posted = X.staged_postings(one, one, ["block"], 0.90)
        shares.append(X.meetings(*posted, ["block"]).first()._meetings / len(texts) ** 2)
        found = X.candidates(*posted, ["block"], 0.90).count()
        assert found < 0.05 * len(texts) ** 2
    assert shares[2] < 1 and shares[2] <= shares[1] * 1.02 <= shares[0] * 1.05


def test_a_block_is_indexed_only_if_that_is_less_work(spark):
    rng = random.Random(4)
    apart = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(16)) for _ in range(80)]
    alike = ["".join(rng.sample("aaabbbcccddd", 12)) for _ in range(80)]
    df = frame(spark, sorted(set(apart)), "apart").union(frame(spark, sorted(set(alike)), "alike"))
    one = L._sketched(df, ["block"], "name")
    posted = X.staged_postings(one, one, ["block"], 0.90)
    met = {r.block: r._meetings for r in X.meetings(*posted, ["block"]).collect()}
    assert met["apart"] < len(set(apart)) ** 2 and met["alike"] > len(set(alike)) ** 2
    found = L.similar_texts(df, df, ["block"], "name", 0.90, index_pairs=10).collect()
    want = {("apart", *p) for p in all_pairs(sorted(set(apart)), sorted(set(apart)), 0.90)}
    want |= {("alike", *p) for p in all_pairs(sorted(set(alike)), sorted(set(alike)), 0.90)}
    assert {(r.block, r._text_a, r._text_b) for r in found} == want


def test_a_frequent_item_is_split(spark):
    a = names(200, 8, "ab", 3, 9)
    one = L._sketched(frame(spark, a), ["block"], "name")
    posted = X.staged_postings(one, one, ["block"], 0.85)
    plain = {tuple(r) for r in X.candidates(*posted, ["block"], 0.85).collect()}
    assert plain == {tuple(r) for r in X.candidates(*posted, ["block"], 0.85, rows=7).collect()}


def parts(pairs, texts):
    root = {t: t for t in texts}
    for a, b in pairs:
        x, y = sorted((root[a], root[b]))
        if x != y:
            root = {t: x if r == y else r for t, r in root.items()}
    return root


@pytest.mark.parametrize("rows", [8, 30, 512])
def test_links_connect_what_all_pairs_connect(spark, rows):
    texts = {"k": names(150, 11), "m": names(90, 12, "abc", 4, 9), "one": ["solo"]}
    df = spark.createDataFrame([(k, t) for k, its in texts.items() for t in its * 2], "block string, name string")
    found = connecting_texts(df, ["block"], "name", 0.90, rows).collect()
    for k, its in texts.items():
        links = [(r._text_a, r._text_b) for r in found if r.block == k]
        assert parts(links, its) == parts(all_pairs(its, its, 0.90), its)
        chunks = -(-len(its) // rows)
        ends = [t for pair in links for t in pair]
        assert len(links) <= len(its) * chunks and (not ends or links)


def test_thousands_of_house_numbers_make_few_links(spark):
    """One city: nearly all pairs are similar, which would be millions of rows."""
    df = spark.range(3000).select(F.lit("town").alias("block"), F.concat(F.lit("main street east no "), F.col("id")).alias("name"))
    links = connecting_texts(df, ["block"], "name", 0.90).select("_text_a", "_text_b")
    assert links.count() <= 3000 * 6
    # All of them hang together, as single edits lead from each number to each other one.
    both = connected_components(links.select(F.col("_text_a").alias("u"), F.col("_text_b").alias("v")))
    assert both.select("component").distinct().count() == 1 and both.count() == 3000


def test_connected_texts_are_not_scored_again(spark, monkeypatch):
    from recordloom.operators import connect

    import numpy as np
    import pyarrow as pa

    from recordloom.functions.similarity import signatures

    texts = pa.array([f"main street east no {i}" for i in range(400)])
    sketch = pa.Table.from_struct_array(signatures(texts))
    scored = []
    real = connect.score_pairs
    monkeypatch.setattr(connect, "score_pairs", lambda a, b: scored.append(len(a)) or real(a, b))
    forest = connect._connected(texts, sketch, np.arange(400), None, 0.90)
    assert len(set(forest.root.tolist())) == 1
    assert sum(scored) < 400 * 399 / 2 / 4


def test_forest_names_components_by_their_least_node():
    import numpy as np

    for seed in range(30):
        rng = random.Random(seed)
        n = 20
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(12)]
        forest = Forest(np.arange(n))
        for chunk in (edges[:5], edges[5:]):
            forest.join(np.array([a for a, _ in chunk]), np.array([b for _, b in chunk]))
        want = parts(edges, range(n))
        assert forest.root.tolist() == [want[i] for i in range(n)]
    assert Forest(np.array([7, 3, 7, 3])).root.tolist() == [0, 1, 0, 1]
    assert list(itertools.islice(Forest(np.array([], int)).root, 1)) == []
