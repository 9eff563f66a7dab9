import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from recordloom.functions.geo import EARTH_RADIUS_M, METRES_PER_MILE, haversine_m
from recordloom.operators import addresses as A
from recordloom.operators import graph
from recordloom.operators.graph import connected_components
from recordloom.operators.joins import pairs_within, within_radius

DEGREE_M = EARTH_RADIUS_M * math.pi / 180


def metres(a, b):
    (y1, x1), (y2, x2) = a, b
    h = math.sin(math.radians(y2 - y1) / 2) ** 2 + math.cos(math.radians(y1)) * math.cos(
        math.radians(y2)
    ) * math.sin(math.radians(x2 - x1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(1, h)))


def cloud(centre, spread, n, seed):
    rng = random.Random(seed)
    points = []
    for _ in range(n):
        lat = max(-90.0, min(90.0, centre[0] + rng.uniform(-spread, spread)))
        wide = min(180.0, spread / max(math.cos(math.radians(lat)), 1e-6))
        lon = (centre[1] + rng.uniform(-wide, wide) + 180) % 360 - 180
        points.append((round(lat, 6), round(lon, 6)))
    return points


@pytest.mark.parametrize(
    "centre", [(45.5, -122.6), (0.0, 0.0), (10.0, 180.0), (-60.0, -180.0), (89.9995, 20.0), (-90.0, 0.0)]
)
def test_pairs_equal_brute_force(spark, centre):
    points = cloud(centre, 0.002, 150, 7) + [centre]
    schema = "id int, latitude double, longitude double"
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(999, None, 1.0)], schema)
    right = left.withColumnRenamed("id", "other")
    got = sorted((r.id, r.other) for r in pairs_within(left, right, 50, "id", "other").collect())
    want = sorted(
        (i, j) for i, a in enumerate(points) for j, b in enumerate(points) if metres(a, b) <= 50
    )
    assert got == want and len(want) >= len(points)


@pytest.mark.parametrize("centre", [(45.0, 179.99), (89.9, 0.0), (0.0, -180.0), (30.0, 30.0)])
def test_radius_equals_brute_force(spark, centre):
    points = cloud(centre, 0.5, 400, 11)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, latitude double, longitude double")
    got = sorted(r.id for r in within_radius(df, *centre, miles=10).collect())
    assert got == [i for i, p in enumerate(points) if metres(p, centre) <= 10 * METRES_PER_MILE]


def test_distance(spark):
    d = spark.range(1).select(haversine_m(F.lit(0), F.lit(0), F.lit(1), F.lit(0))).first()[0]
    assert d == pytest.approx(DEGREE_M)


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    chain = [(f"c{i:04}", f"c{i + 1:04}") for i in range(300)]
    star = [("hub", f"s{i}") for i in range(300)]
    noise = [(f"n{rng.randrange(400)}", f"n{rng.randrange(400)}") for _ in range(250)]
    edges = chain + star + [e for e in noise if e[0] != e[1]]
    rng.shuffle(edges)
    parent = {}

    def root(n):
        parent.setdefault(n, n)
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    want = {n: root(n) for n in parent}
    df = spark.createDataFrame(edges, "u string, v string")
    rows = connected_components(df).collect()
    assert len(rows) == len(want) and {r.node: r.component for r in rows} == want


def addresses(spark, rows):
    schema = (
        "source_system string, source_id string, street_address string, city string, state_province string, "
        "postal_code string, country string, latitude decimal(10,6), longitude decimal(10,6), seen_on date"
    )
    from decimal import Decimal

    full = []
    for i, (street, lat, lon) in enumerate(rows):
        spot = [None if v is None else Decimal(str(round(v, 6))) for v in (lat, lon)]
        full.append(("x", str(i), street, "Town", "ST", "97201", "US", *spot, dt.date(2024, 1, i + 1)))
    return A.normalized(spark.createDataFrame(full, schema))


def groups(df):
    clusters = {}
    for r in df.collect():
        clusters.setdefault(r.cluster_id, set()).add(int(r.source_id))
    return sorted(map(sorted, clusters.values()))


def test_three_tiers(spark):
    step = 1 / DEGREE_M
    rows = [
        ("1 Oak Street", None, None),
        ("1 OAK St.", None, None),  # 0: equal digest
        ("Quarry House", 10.0, 20.0),
        ("Zenith Works", 10.0 + 49 * step, 20.0),  # 2: 49 m
        ("Ivy Yard", 10.0 + 100.5 * step, 20.0),  # 51.5 m from 3: apart
        ("Mill", 30.0, 179.9999),
        ("Upper Farm", 30.0, -179.9999),  # 5: 19 m across the date line
        ("77 Harbour Boulevard", None, None),
        ("77 Harbor Boulevard", 50.0, 50.0),  # 7: similar text
        ("", None, None),
        ("", None, None),  # 9: equal digest
    ]
    got = groups(A.cluster_addresses(addresses(spark, rows)))
    assert got == [[0, 1], [2, 3], [4], [5, 6], [7, 8], [9, 10]]


def test_chain_is_one_cluster_and_the_dimension_has_no_near_duplicates(spark):
    step = 1 / DEGREE_M
    names = ["Quarry House", "Zenith Works", "Ivy Yard", "Mill"]
    rows = [(n, 10.0 + 45 * i * step, 20.0) for i, n in enumerate(names)] + [("Far Barn", 11.0, 20.0)]
    clustered = A.cluster_addresses(addresses(spark, rows))
    assert groups(clustered) == [[0, 1, 2, 3], [4]]
    dim = A.address_dim(clustered, ("x",))
    shown = {r.street_address: r for r in dim.collect()}
    assert set(shown) == {"Quarry House", "Far Barn"}
    assert shown["Quarry House"].last_seen == dt.date(2024, 1, 4)
    assert sorted(r.address_id for r in shown.values()) == [1, 2]
    assert A.near_duplicates(dim).count() == 0


def test_crowded_spot_needs_one_edge_per_address(spark):
    rows = [(f"Unit number {i} of the crowd {i * i}", 10.0, 20.0) for i in range(28)]
    df = addresses(spark, rows)
    edges = A._nearby_edges(df, 50)
    assert edges.count() == 28 + 1
    assert len(groups(A.cluster_addresses(df))) == 1


def test_clusters_broadcast_no_data(spark):
    """Files are far smaller than what a broadcast of them holds, so only lists of hot keys may be sent."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"

    def joins(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "_chunks" not in line and "LeftOuter" not in line]

    edges = spark.createDataFrame([("b", "a"), ("c", "b")], "u string, v string")
    points = A.placed_points(
        spark.createDataFrame([(45.0 + i / 5000, 7.0) for i in range(20)], "latitude double, longitude double"), 50
    )
    rows = spark.createDataFrame(
        [(f"{i:032x}", f"{i} main st", "x", "y", 45.0 + i / 5000, 7.0) for i in range(20)],
        "address_hash string, street_norm string, city_norm string, state_norm string, latitude double, longitude double",
    )
    clustered = A.cluster_addresses(rows)
    assert joins(graph._large_star(edges)) + joins(graph._small_star(edges)) == []
    assert joins(A._touching_cells(points, points, 50)) == []
    assert joins(A.named_components(edges.select(F.lpad("u", 32, "0").alias("u"), F.lpad("v", 32, "0").alias("v")))) == []
    plan = clustered._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert clustered.select("cluster_id").distinct().count() == 1
