"""Clusters that grow by batches, and the test whether any duplicates are left."""

from __future__ import annotations

import random

from recordloom.operators import addresses as A
from recordloom.operators.cluster_index import ClusterIndex
from recordloom.session import new_path

SCHEMA = (
    "source_id string, street_address string, city string, state_province string, postal_code string, country string, "
    "latitude decimal(10,6), longitude decimal(10,6)"
)


def some_addresses(spark, n, seed):
    from decimal import Decimal

    rng = random.Random(seed)
    rows = []
    for i in range(n):
        street = f"{rng.randrange(60)} {rng.choice(['Oak', 'Elm', 'Old Mill', 'Vine'])} {rng.choice(['Street', 'St', 'Ave'])}"
        spot = (Decimal(45000000 + 230 * rng.randrange(40)) / 10**6, Decimal(-120000000 + 330 * rng.randrange(40)) / 10**6)
        if rng.random() < 0.3:
            spot = (None, None)
        rows.append((str(i), street if rng.random() < 0.9 else "-", rng.choice(["Bend", "Salem", "Sisters"]), "OR", str(97000 + rng.randrange(30)), "US", *spot))
    return A.normalized(spark.createDataFrame(rows, SCHEMA))


def labels(df):
    return {(r.address_hash, r.cluster_id) for r in df.collect()}


def test_batches_give_the_clusters_of_a_full_run(spark):
    rows = some_addresses(spark, 120, 1)
    want = labels(A.cluster_addresses(rows))
    assert 1 < len({c for _, c in want}) < len({a for a, _ in want})
    index = ClusterIndex(spark, new_path(spark, "clusters"))
    parts = [rows.filter(f"source_id % 3 = {k}") for k in range(3)]
    assert index.add(parts[0]) > 0 and index.add(parts[1]) > 0
    index.compact()
    assert index.runs.numbers() == [3]
    index.add(parts[2])
    assert labels(index.clustered(rows)) == want
    before = index.runs.read("nodes", "node string, component string").count()
    assert index.add(rows) == 0
    assert index.runs.read("nodes", "node string, component string").count() == before
    assert labels(index.clustered(rows)) == want


def test_a_batch_leaves_rows_of_others_alone(spark):
    """Of a later batch only its own nodes and the aliases of joined components are written."""
    rows = spark.createDataFrame(
        [("1", "12 Oak Street", "Bend", "OR", "97000", "US", None, None), ("2", "99 Unlike Blvd", "Bend", "OR", "97000", "US", None, None),
         ("3", "12 Oak Strt", "Bend", "OR", "97000", "US", None, None), ("4", "1 Far Away", "Salem", "OR", "97000", "US", None, None)],
        SCHEMA,
    )
    rows = A.normalized(rows)
    index = ClusterIndex(spark, new_path(spark, "clusters"))
    index.add(rows.filter("source_id <> '3'"))
    index.add(rows.filter("source_id = '3'"))
    second = spark.read.parquet(f"{index.runs.path}/run-000000002/nodes").collect()
    assert {r.node[:6] for r in second if r.node.startswith("street")} == {"street"} and len(second) == 2
    assert labels(index.clustered(rows)) == labels(A.cluster_addresses(rows))


def test_empty_batches(spark):
    rows = some_addresses(spark, 5, 3)
    index = ClusterIndex(spark, new_path(spark, "clusters"))
    assert index.add(rows.limit(0)) == 0 and index.labels().count() == 0
    assert index.add(rows) > 0


def test_leftovers_are_found_without_clustering_the_rest(spark):
    rows = some_addresses(spark, 90, 7)
    clustered = A.cluster_addresses(rows)
    want = {}
    for r in clustered.select("source_id", "cluster_id").collect():
        want.setdefault(r.cluster_id, set()).add(r.source_id)
    dim = clustered.withColumnRenamed("source_id", "address_id")
    got = {}
    for r in A.near_duplicates(dim).collect():
        got.setdefault(r.cluster_id, set()).add(r.address_id)
    assert got == {c: ids for c, ids in want.items() if len(ids) > 1} and got
    # Linked addresses are just those of clusters with several digests.
    many = {}
    for a, c in labels(clustered):
        many.setdefault(c, set()).add(a)
    linked = {r.address_hash for r in A.linked_addresses(A.distinct_addresses(rows)).collect()}
    assert linked == {a for its in many.values() if len(its) > 1 for a in its}


def test_a_clean_dimension_has_no_leftovers(spark):
    rows = spark.createDataFrame(
        [(str(i), f"{s} Road", t, "OR", "97000", "US", None, None) for i, (s, t) in enumerate([("Oak", "Bend"), ("Zephyr", "Bend"), ("Oak", "Salem")])],
        SCHEMA,
    )
    dim = A.normalized(rows).withColumnRenamed("source_id", "address_id")
    found = A.near_duplicates(dim)
    assert found.columns == ["address_id", "cluster_id"] and found.count() == 0
