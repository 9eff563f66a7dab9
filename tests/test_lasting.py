"""Ids that last over runs."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from recordloom.operators import addresses as A
from recordloom.operators import history as H
from recordloom.operators.lasting import IdRegistry, assign_ids, resolved, roots
from recordloom.session import delete_path, new_path

DAY = dt.date(2024, 1, 1)


def members(spark, groups):
    return spark.createDataFrame([(k, g) for g, keys in groups.items() for k in keys], "key string, grp string")


@pytest.fixture
def registry(spark):
    return IdRegistry(spark, new_path(spark, "registry"))


def assign(spark, registry, groups):
    found = registry.assign(members(spark, groups), "key", "grp")
    return {r.grp: r.id for r in found.collect()}


def test_new_keys_never_move_old_ids(spark, registry):
    assert assign(spark, registry, {"m": ["m1", "m2"], "t": ["t1"]}) == {"m": 1, "t": 2}
    assert assign(spark, registry, {"a": ["a"], "m": ["m2", "m3"], "p": ["p"], "t": ["t1"]}) == {"m": 1, "t": 2, "a": 3, "p": 4}
    # A key that was away comes back to its id, whatever its group is called now.
    assert assign(spark, registry, {"x": ["m1"], "z": ["p"]}) == {"x": 1, "z": 4}


def test_merged_groups_keep_the_least_id_and_chains_lead_to_it(spark, registry):
    assert assign(spark, registry, {g: [g] for g in "abcd"}) == {"a": 1, "b": 2, "c": 3, "d": 4}
    assert assign(spark, registry, {"c": ["c", "d"], "a": ["a"], "b": ["b"]}) == {"a": 1, "b": 2, "c": 3}
    assert assign(spark, registry, {"b": ["b", "c", "d"], "a": ["a"]}) == {"a": 1, "b": 2}
    assert assign(spark, registry, {"a": ["a", "b"], "n": ["n"]}) == {"a": 1, "n": 5}
    assert {r.id: r.root for r in registry.roots().collect()} == {2: 1, 3: 1, 4: 1}
    seen = spark.createDataFrame([(4,), (1,), (9,), (None,)], "id long")
    assert [r.id for r in resolved(seen, registry.roots(), "id").orderBy("id").collect()] == [None, 1, 1, 9]


def test_a_group_that_falls_apart_keeps_its_id_where_most_keys_are(spark, registry):
    assign(spark, registry, {"g": ["k1", "k2", "k3"], "h": ["h"]})
    assert assign(spark, registry, {"x": ["k1"], "y": ["k2", "k3"], "h": ["h"]}) == {"y": 1, "h": 2, "x": 3}
    assert assign(spark, registry, {"x": ["k1"], "y": ["k2"], "h": ["h"]}) == {"y": 1, "h": 2, "x": 3}


def test_long_chains_and_no_rows(spark):
    chain = spark.createDataFrame([(i, i - 1, i) for i in range(1, 41)], "id long, target long, run long")
    assert {r.root for r in roots(chain).collect()} == {0}
    assert roots(chain.limit(0)).count() == 0
    none = assign_ids(members(spark, {"a": ["a"]}).limit(0), chain.limit(0).selectExpr("string(id) key", "id", "run"), chain.limit(0), 1, "key", "grp")
    assert none.ids.count() == none.keys.count() == none.aliases.count() == 0


def test_runs_append_only_what_is_new_and_compaction_changes_nothing(spark, registry):
    rng = random.Random(5)
    held = {}
    keys = [f"k{i}" for i in range(40)]
    label = {k: k for k in keys}
    for turn in range(4):
        for _ in range(5):  # groups only merge
            a, b = rng.sample(keys, 2)
            low, high = sorted((label[a], label[b]))
            label = {k: low if g == high else g for k, g in label.items()}
        shown = rng.sample(keys, 25)
        groups = {}
        for k in shown:
            groups.setdefault(label[k], []).append(k)
        ids = assign(spark, registry, groups)
        ends = {r.id: r.root for r in registry.roots().collect()}
        for group, its in groups.items():
            known = {ends.get(held[k], held[k]) for k in its if k in held}
            assert not known or known == {ids[group]}
        new = [k for k in shown if k not in held]
        added = registry.keys().filter(f"run = {turn + 1}")
        assert added.count() == len(new)
        held |= {k: ids[g] for g, its in groups.items() for k in its}
        if turn == 2:
            registry.compact()
            assert registry.runs.numbers() == [4]
            break
    ends = {r.id: r.root for r in registry.roots().collect()}
    stored = {r.key: r.id for r in registry.keys().collect()}
    assert stored == {k: ends.get(i, i) for k, i in held.items()}


def test_a_run_without_its_marker_does_not_count(spark, registry):
    assign(spark, registry, {"a": ["a"]})
    assign(spark, registry, {"b": ["b"]})
    delete_path(spark, f"{registry.runs.path}/run-000000002/_ACCEPTED")
    assert registry.runs.numbers() == [1] and registry.keys().count() == 1
    assert assign(spark, registry, {"c": ["c"], "a": ["a"]}) == {"a": 1, "c": 2}


def _addresses(spark, streets):
    rows = [("s", f"e{i}", s, "Town", "S", "10000", "US", None, None, DAY) for i, s in streets]
    schema = (
        "source_system string, source_id string, street_address string, city string, state_province string, "
        "postal_code string, country string, latitude decimal(10,6), longitude decimal(10,6), seen_on date"
    )
    return A.cluster_addresses(A.normalized(spark.createDataFrame(rows, schema)))


def test_entities_that_did_not_move_stay_open_when_addresses_are_added(spark, registry):
    streets = ["Alder", "Birchwood", "Chestnut", "Dogwood", "Elm", "Figtree", "Ginkgo", "Hawthorn"]
    more = ["Quince", "Yew", "Lime", "Poplar"]

    def at(rows):
        clustered = _addresses(spark, rows)
        dim = A.address_dim(clustered, ("s",), registry.assign(clustered, "address_hash", "cluster_id"))
        return A.address_members(clustered, dim).selectExpr(
            "source_id AS gold_id", "address_id", "source_system", "1.0D AS match_confidence"
        )

    old = list(enumerate(streets))
    history = H.scd2_initial(at(old), DAY)
    later = dt.date(2024, 2, 1)
    after = H.scd2_apply(history, at(old + list(enumerate(more, 20))), later, registry.roots()).collect()
    assert len(after) == 12 and all(r.is_current for r in after)
    assert {r.gold_id for r in after if r.valid_from == later} == {f"e{i}" for i in range(20, 24)}


def test_who_is_at_a_merged_address_has_not_moved(spark):
    was = spark.createDataFrame([("a", 5, "s", 1.0), ("b", 3, "s", 1.0), ("c", 7, "s", 1.0)], "gold_id string, address_id long, source_system string, match_confidence double")
    now = spark.createDataFrame([("a", 3, "s", 1.0), ("b", 3, "s", 1.0), ("c", 3, "s", 1.0)], was.schema)
    ends = spark.createDataFrame([(5, 3)], "id long, root long")
    rows = H.scd2_apply(H.scd2_initial(was, DAY), now, dt.date(2024, 2, 1), ends).collect()
    assert sorted((r.gold_id, r.address_id, r.is_current) for r in rows) == [("a", 3, True), ("b", 3, True), ("c", 3, True), ("c", 7, False)]
