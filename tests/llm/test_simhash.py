from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from recordloom.llm import simhash


def plain_print(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
    shingles = shingles or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius):
    """Least id of each connected group of (id, print), by all pairs."""
    name = dict.fromkeys(range(len(prints)))
    least = {i: i for i in name}
    for a, b in itertools.combinations(name, 2):
        if (prints[a][1] ^ prints[b][1]).bit_count() <= radius and least[a] != least[b]:
            low, high = sorted((least[a], least[b]))
            least = {k: low if v == high else v for k, v in least.items()}
    ids = {}
    for k, v in least.items():
        if prints[k][0] is not None:
            ids[v] = min(prints[k][0], ids.get(v, prints[k][0]))
    return [ids.get(least[k]) for k in range(len(prints))]


def result(docs, **options):
    return [(r.id, r.fp % (1 << 64), r.component) for r in simhash.near_duplicates(docs, **options).collect()]


@pytest.mark.parametrize("frame", ["messy", "sample"])
def test_groups_equal_all_pairs(frame, request):
    docs = request.getfixturevalue(frame)
    rows = [(r.doc_id, plain_print(r.text)) for r in docs.select("doc_id", "text").collect()]
    expected = [(i, p, c) for (i, p), c in zip(rows, plain_groups(rows, 4))]
    assert sorted(result(docs), key=str) == sorted(expected, key=str)


def test_empty_table(nothing):
    assert result(nothing) == []
    assert simhash.drop_near_duplicates(nothing).collect() == []


def test_one_document_of_each_group_stays(messy):
    kept = simhash.drop_near_duplicates(messy)
    assert kept.columns == messy.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([None, 1, 4, 5, 8, 9, 10], key=str)  # 2, 3 with 1; 6, 7 with 5; one of both 9


def test_tiles_find_every_link(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(300)]
    for p in prints[:100]:  # chains of near prints
        for _ in range(rng.randint(1, 4)):
            p ^= 1 << rng.randrange(64)
            prints.append(p)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = simhash.similar_prints(frame, 4, tile=32).collect()
    assert len(links) < 40 * len(prints)
    number = {p: i for i, p in enumerate(signed)}
    name = list(range(len(signed)))
    for a, b in ((number[r.u], number[r.v]) for r in links):
        assert (prints[a] ^ prints[b]).bit_count() <= 64
        low, high = sorted((name[a], name[b]))
        name = [low if n == high else n for n in name]
    expected = plain_groups(list(enumerate(prints)), 4)
    assert name == expected


def test_links_of_a_dense_group_are_few():
    base = np.uint64(0x0123456789ABCDEF)
    group = np.unique(base ^ (np.uint64(1) << np.arange(64, dtype=np.uint64)))
    u, v = simhash.tile_links(group, group, 4)
    assert len(u) == len(group) - 1 and set(v.tolist()) == {int(group[0])}
