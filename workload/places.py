"""Addresses: normalization, distances, deduplication, the dimension."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from recordloom.functions.addresses import address_hash, normalize_address, normalize_postal
from recordloom.functions.geo import METRES_PER_MILE
from recordloom.operators import addresses as A
from recordloom.operators import history as H
from recordloom.operators import joins as J
from recordloom.operators import linkage as L
from recordloom.operators.cluster_index import ClusterIndex
from recordloom.operators.lasting import IdRegistry, resolved
from recordloom.session import new_path, stage

from .frames import table
from .registry import query

# Parts stand for two address feeds: house number and street from size and name, spelt
# in several ways, with coordinates on a lattice of about 33 metres.
PLACE = {
    "part_id": "CAST(p_partkey AS STRING)",
    "street_address": (
        "CASE WHEN p_partkey % 23 <> 0 THEN concat(CAST(p_size AS STRING), ' ', p_name, "
        "CASE p_partkey % 5 WHEN 0 THEN ' Street' WHEN 1 THEN ' St.' WHEN 2 THEN '  STREET' "
        "WHEN 3 THEN ' st' ELSE ' Place' END) END"
    ),
    "city": "concat(CASE WHEN p_partkey % 2 = 0 THEN 'É' ELSE 'e' END, lower(p_type))",
    "state_province": "concat('S', CAST(p_size % 3 AS STRING))",
    "postal_code": (
        "CASE p_partkey % 3 WHEN 0 THEN '97201' WHEN 1 THEN '97201-1234' ELSE ' 972011234' END"
    ),
    "country": "'United States'",
    "latitude": (
        "CASE WHEN p_partkey % 7 <> 0 THEN CAST(40 + CAST(p_partkey * p_partkey * 37 % 1009 AS DOUBLE) * 3 / 10000 "
        "AS DECIMAL(10,6)) END"
    ),
    "longitude": (
        "CASE WHEN p_partkey % 11 <> 0 THEN CAST(CAST((p_partkey * p_partkey + p_partkey * 53) % 2003 AS DOUBLE) * 4 / 10000 - 100 "
        "AS DECIMAL(10,6)) END"
    ),
    "seen_on": "date_add(DATE '2024-01-01', CAST(p_partkey % 30 AS INT))",
}
_PLACE_SQL = ", ".join(f"{e} AS {n}" for n, e in PLACE.items()).replace(
    "date_add(DATE '2024-01-01', CAST(p_partkey % 30 AS INT))",
    "DATE '2024-01-01' + CAST(p_partkey % 30 AS INT)",
)
PLACES_SQL = f"""
places AS (
  SELECT CASE WHEN p_size <= 25 THEN 'first' ELSE 'second' END AS source_system, {_PLACE_SQL}
  FROM part),
staged AS (
  SELECT source_system, part_id AS source_id, street_address, city, state_province, postal_code,
         country, latitude, longitude, seen_on
  FROM places WHERE street_address IS NOT NULL)"""


def norm_sql(source: str) -> str:
    """Normalized addresses of a staged frame, as a common table expression ``addr``."""
    text = "trim(regexp_replace(strip_accents(lower({0})), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    words = (
        "array_to_string(list_transform(string_split(" + text + ", ' '), "
        "lambda w: CASE w WHEN 'street' THEN 'st' WHEN 'suite' THEN 'ste' WHEN 'east' THEN 'e' "
        "WHEN 'place' THEN 'pl' ELSE w END), ' ')"
    )
    return f"""
parts AS (
  SELECT *, {words.format("street_address")} AS street_norm, {words.format("city")} AS city_norm,
         {words.format("state_province")} AS state_norm,
         CASE WHEN regexp_full_match(trim(postal_code), '[0-9]{{5}}(-?[0-9]{{4}})?')
              THEN substr(trim(postal_code), 1, 5)
              ELSE regexp_replace(lower(trim(postal_code)), '[^\\p{{L}}\\p{{N}}]+', '', 'g') END AS postal_norm,
         {words.format("country")} AS country_norm
  FROM {source}),
addr AS (
  SELECT *, md5(coalesce(street_norm, '') || '|' || coalesce(city_norm, '') || '|' ||
                coalesce(state_norm, '') || '|' || coalesce(postal_norm, '') || '|' ||
                coalesce(country_norm, '')) AS address_hash,
         concat_ws(', ', nullif(street_norm, ''), nullif(city_norm, ''), nullif(state_norm, ''),
                   nullif(postal_norm, ''), nullif(country_norm, '')) AS normalized_address
  FROM parts)"""


def metres_sql(a: str, b: str) -> str:
    def rad(c: str) -> str:
        return f"radians(CAST({c} AS DOUBLE))"

    return (
        f"2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(({rad(b + '.latitude')} - {rad(a + '.latitude')}) / 2), 2) + "
        f"cos({rad(a + '.latitude')}) * cos({rad(b + '.latitude')}) * "
        f"pow(sin(({rad(b + '.longitude')} - {rad(a + '.longitude')}) / 2), 2))))"
    )


CLUSTERS_SQL = f"""
spots AS (
  SELECT DISTINCT address_hash, latitude, longitude FROM addr
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
streets AS (
  SELECT DISTINCT address_hash, street_norm, city_norm, state_norm FROM addr),
edges AS (
  SELECT DISTINCT a.address_hash AS u, b.address_hash AS v FROM spots a JOIN spots b
    ON b.latitude BETWEEN a.latitude - 0.002 AND a.latitude + 0.002
   AND {metres_sql("a", "b")} <= 50
  UNION
  SELECT a.address_hash, b.address_hash FROM streets a JOIN streets b
    ON a.city_norm = b.city_norm AND a.state_norm = b.state_norm
   AND jaro_winkler_similarity(a.street_norm, b.street_norm) > 0.90
  UNION
  SELECT address_hash, address_hash FROM addr),
reach AS (
  SELECT u AS node, v AS root FROM edges
  UNION
  SELECT r.node, e.v FROM reach r JOIN edges e ON r.root = e.u),
clusters AS (
  SELECT node AS address_hash, min(root) AS cluster_id FROM reach GROUP BY node)"""

DIM_SQL = """
clustered AS (SELECT * FROM addr JOIN clusters USING (address_hash)),
dim_rows AS (
  SELECT cluster_id,
         arg_min(struct_pack(street_address, city, state_province, postal_code, country, address_hash,
                             normalized_address), (source_system, source_id)) AS shown,
         arg_min(struct_pack(latitude, longitude, source_system), (source_system, source_id))
           FILTER (latitude IS NOT NULL AND longitude IS NOT NULL) AS spot,
         min(seen_on) AS first_seen, max(seen_on) AS last_seen,
         count(DISTINCT address_hash) AS variants
  FROM clustered GROUP BY cluster_id),
dim AS (
  SELECT row_number() OVER (ORDER BY cluster_id) AS address_id, cluster_id,
         shown.street_address AS street_address, shown.city AS city,
         shown.state_province AS state_province, shown.postal_code AS postal_code,
         shown.country AS country, shown.address_hash AS address_hash,
         shown.normalized_address AS normalized_address, spot.latitude AS latitude,
         spot.longitude AS longitude, spot.source_system AS coordinates_source,
         first_seen, last_seen, variants
  FROM dim_rows)"""


def recursive(body: str, *parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(p.strip() for p in parts) + "\n" + body.strip()


def places(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    columns = [f"{e} AS {n}" for n, e in PLACE.items()]
    return (
        part.filter("p_size <= 25").selectExpr(*columns),
        part.filter("p_size > 25").selectExpr(*columns),
    )


def staged_places(spark, sf_dir):
    first, second = places(spark, sf_dir)
    return A.stage_addresses(
        {"first": first, "second": second}, {"first": "part_id", "second": "part_id"}, "seen_on"
    )


@query(recursive("SELECT * FROM staged", PLACES_SQL))
def stage_addresses(spark, sf_dir):
    return staged_places(spark, sf_dir)


@query(
    recursive(
        """SELECT source_id, street_norm, city_norm, state_norm, postal_norm, normalized_address,
       address_hash FROM addr""",
        PLACES_SQL,
        norm_sql("staged"),
    )
)
def address_hashes(spark, sf_dir):
    return A.normalized(staged_places(spark, sf_dir)).select(
        "source_id",
        "street_norm",
        "city_norm",
        "state_norm",
        "postal_norm",
        "normalized_address",
        "address_hash",
    )


@query(
    """
SELECT doc_id,
       md5(array_to_string(list_transform(string_split(
         trim(regexp_replace(strip_accents(lower(text)), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' '),
         lambda w: CASE w WHEN 'east' THEN 'e' WHEN 'place' THEN 'pl' WHEN 'room' THEN 'rm' ELSE w END), ' ')
         || '|' || lang) AS digest
FROM documents"""
)
def text_digests(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", address_hash(normalize_address("text"), "lang").alias("digest")
    )


@query(
    recursive(
        f"""
SELECT a.part_id AS part_id, b.part_id AS other_id, round({metres_sql("a", "b")}, 3) AS metres
FROM places a JOIN places b ON {metres_sql("a", "b")} <= 200
WHERE a.source_system = 'first' AND b.source_system = 'second'""",
        PLACES_SQL,
    )
)
def proximity_join(spark, sf_dir):
    first, second = places(spark, sf_dir)
    pairs = J.pairs_within(
        first, second.withColumnRenamed("part_id", "other_id"), 200, "part_id", "other_id"
    )
    return pairs.select("part_id", "other_id", F.round("distance_m", 3).alias("metres"))


@query(
    recursive(
        f"""
SELECT a.part_id, a.latitude, a.longitude
FROM places a, (SELECT 40.15 AS latitude, -99.6 AS longitude) b
WHERE {metres_sql("b", "a")} <= 10 * {METRES_PER_MILE}""",
        PLACES_SQL,
    )
)
def radius_search(spark, sf_dir):
    first, second = places(spark, sf_dir)
    near = J.within_radius(first.union(second), 40.15, -99.6)
    return near.select("part_id", "latitude", "longitude")


@query(
    recursive(
        """
SELECT a.source_id AS part_id, b.source_id AS other_id FROM addr a JOIN addr b USING (address_hash)
WHERE a.source_system = 'first' AND b.source_system = 'second'""",
        PLACES_SQL.replace("p_size <= 25", "p_brand < 'Brand#18'"),
        norm_sql("staged"),
    )
)
def same_address_pairs(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    columns = ["p_brand", *[f"{e} AS {n}" for n, e in PLACE.items()]]
    digest = A.normalized(part.selectExpr(*columns).filter("street_address IS NOT NULL"))
    digest = digest.select("p_brand", "part_id", "address_hash")
    return L.exact_pairs(
        digest.filter("p_brand < 'Brand#18'"),
        digest.filter("p_brand >= 'Brand#18'").withColumnRenamed("part_id", "other_id"),
        ["address_hash"],
        "part_id",
        "other_id",
    )


def clustered_places(spark, sf_dir):
    return A.cluster_addresses(A.normalized(staged_places(spark, sf_dir)))


@query(
    recursive(
        "SELECT source_id, a.address_hash, cluster_id FROM addr a JOIN clusters USING (address_hash)",
        PLACES_SQL,
        norm_sql("staged"),
        CLUSTERS_SQL,
    )
)
def address_clusters(spark, sf_dir):
    return clustered_places(spark, sf_dir).select("source_id", "address_hash", "cluster_id")


@query(
    recursive("SELECT * FROM dim", PLACES_SQL, norm_sql("staged"), CLUSTERS_SQL, DIM_SQL)
)
def address_dim(spark, sf_dir):
    dim = A.address_dim(clustered_places(spark, sf_dir), ("first", "second"))
    return dim.drop("street_norm", "city_norm", "state_norm")


@query(
    recursive(
        """SELECT cluster_id, count(DISTINCT a.address_hash) AS digests, count(*) AS n
FROM addr a JOIN clusters USING (address_hash) GROUP BY cluster_id""",
        PLACES_SQL,
        norm_sql("staged"),
        CLUSTERS_SQL,
    )
)
def cluster_sizes(spark, sf_dir):
    return (
        clustered_places(spark, sf_dir)
        .groupBy("cluster_id")
        .agg(F.countDistinct("address_hash").alias("digests"), F.count(F.lit(1)).alias("n"))
    )


@query(
    """
SELECT s_suppkey,
       CASE WHEN regexp_full_match(code, '[0-9]{5}(-?[0-9]{4})?') THEN substr(code, 1, 5)
            ELSE regexp_replace(lower(code), '[^a-z0-9]+', '', 'g') END AS postal
FROM (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'SW1A ' || s_suppkey
        WHEN 1 THEN lpad(CAST(s_suppkey AS VARCHAR), 5, '0') ELSE lpad(CAST(s_suppkey AS VARCHAR), 9, '4') END AS code
      FROM supplier)"""
)
def postal_codes(spark, sf_dir):
    code = F.expr(
        "CASE s_suppkey % 3 WHEN 0 THEN concat('SW1A ', CAST(s_suppkey AS STRING)) "
        "WHEN 1 THEN lpad(CAST(s_suppkey AS STRING), 5, '0') "
        "ELSE lpad(CAST(s_suppkey AS STRING), 9, '4') END"
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", normalize_postal(code).alias("postal"))


# Two snapshots of the places.  The second one adds the parts of the month's last ten days, some
# parts have moved and some are gone.
MOVED = {
    "entity": "p_partkey",
    "kind": "p_size <= 25",
    "p_partkey": "CASE WHEN p_partkey % 13 = 5 THEN p_partkey + 1 ELSE p_partkey END",
    "p_size": "CASE WHEN p_partkey % 13 = 5 THEN p_size % 50 + 1 ELSE p_size END",
    "p_name": "p_name",
    "p_type": "p_type",
}
BEFORE, AFTER = dt.date(2024, 1, 21), dt.date(2024, 2, 1)
_THEN = {**PLACE, "part_id": "CAST(entity AS STRING)"}


def _suffixed(sql: str, suffix: str) -> str:
    """The expressions under names of their own."""
    for name in ("places", "staged", "parts", "addr", "spots", "streets", "edges", "reach", "clusters"):
        sql = re.sub(rf"\b{name}\b", f"{name}_{suffix}", sql)
    return sql


LASTING_SQL = ",\n".join(
    part.strip()
    for part in (
        f"""
staged_a AS (
  SELECT CASE WHEN p_size <= 25 THEN 'first' ELSE 'second' END AS source_system, part_id AS source_id, street_address,
         city, state_province, postal_code, country, latitude, longitude
  FROM (SELECT p_size, p_partkey, {_PLACE_SQL} FROM part)
  WHERE street_address IS NOT NULL AND p_partkey % 30 < 20)""",
        _suffixed(norm_sql("staged"), "a"),
        _suffixed(CLUSTERS_SQL, "a"),
        f"""
staged_now AS (
  SELECT CASE WHEN kind THEN 'first' ELSE 'second' END AS source_system, part_id AS source_id, street_address,
         city, state_province, postal_code, country, latitude, longitude
  FROM (SELECT kind, entity, {_PLACE_SQL.replace(PLACE["part_id"], _THEN["part_id"])}
        FROM (SELECT {", ".join(f"{e} AS {n}" for n, e in MOVED.items())} FROM part))
  WHERE street_address IS NOT NULL AND entity % 19 <> 7),
staged_b AS (SELECT *, true AS now FROM staged_now UNION ALL SELECT *, false FROM staged_a)""",
        _suffixed(norm_sql("staged"), "b"),
        _suffixed(CLUSTERS_SQL, "b"),
        f"""
ids_a AS (SELECT cluster_id, row_number() OVER (ORDER BY cluster_id) AS id FROM (SELECT DISTINCT cluster_id FROM clusters_a)),
keys_a AS (SELECT address_hash, id FROM clusters_a JOIN ids_a USING (cluster_id)),
held AS (SELECT cluster_id, min(id) AS id FROM clusters_b LEFT JOIN keys_a USING (address_hash) GROUP BY cluster_id),
ids_b AS (
  SELECT cluster_id, id FROM held WHERE id IS NOT NULL
  UNION ALL
  SELECT cluster_id, (SELECT max(id) FROM ids_a) + row_number() OVER (ORDER BY cluster_id) FROM held WHERE id IS NULL),
keys_b AS (SELECT address_hash, id FROM clusters_b JOIN ids_b USING (cluster_id)),
roots AS (SELECT DISTINCT a.id, b.id AS root FROM keys_a a JOIN keys_b b USING (address_hash)),
was AS (
  SELECT row_number() OVER (ORDER BY source_id) AS location_id, source_id AS gold_id, root AS address_id, source_system
  FROM addr_a JOIN keys_a USING (address_hash) JOIN roots USING (id)),
is_at AS (SELECT source_id AS gold_id, id AS address_id, source_system FROM addr_b JOIN keys_b USING (address_hash) WHERE now),
stays AS (SELECT gold_id FROM was JOIN is_at USING (gold_id, address_id)),
lasting AS (
  SELECT location_id, gold_id, address_id, DATE '{BEFORE}' AS valid_from,
         CASE WHEN gold_id NOT IN (FROM stays) THEN DATE '{AFTER}' - 1 END AS valid_to,
         gold_id IN (FROM stays) AS is_current, source_system
  FROM was
  UNION ALL
  SELECT (SELECT max(location_id) FROM was) + row_number() OVER (ORDER BY gold_id), gold_id, address_id,
         DATE '{AFTER}', NULL, true, source_system
  FROM is_at WHERE gold_id NOT IN (FROM stays))""",
    )
)


def _snapshots(spark, sf_dir):
    """Staged addresses of the two snapshots."""
    part = table(spark, sf_dir, "part")
    early = part.filter("p_partkey % 30 < 20").selectExpr(
        "p_size <= 25 AS kind", *[f"{e} AS {n}" for n, e in PLACE.items()]
    )
    late = part.selectExpr(*[f"{e} AS {n}" for n, e in MOVED.items()]).filter("entity % 19 <> 7")
    late = late.selectExpr("kind", *[f"{e} AS {n}" for n, e in _THEN.items()])
    return [
        A.stage_addresses(
            {"first": df.filter("kind"), "second": df.filter("NOT kind")},
            {"first": "part_id", "second": "part_id"},
            "seen_on",
        )
        for df in (early, late)
    ]


def _located(clustered, ids):
    """Where the entities of a snapshot are."""
    dim = A.address_dim(clustered, ("first", "second"), ids)
    return A.address_members(clustered, dim).select(
        F.col("source_id").alias("gold_id"), "address_id", "source_system", F.lit(1.0).alias("match_confidence")
    )


@query(recursive("SELECT * FROM lasting", LASTING_SQL))
def lasting_address_ids(spark, sf_dir):
    """Two runs, from addresses to dated locations: only who moved, went or came has a new row."""
    early, late = (A.normalized(df) for df in _snapshots(spark, sf_dir))
    registry = IdRegistry(spark, new_path(spark, "address-ids"))
    index = ClusterIndex(spark, new_path(spark, "address-clusters"))

    def located(addresses):
        index.add(addresses)
        clustered = stage(index.clustered(addresses), "clustered")
        return _located(clustered, registry.assign(index.families(clustered), "address_hash", "cluster_id"))

    history = H.scd2_initial(located(early), BEFORE)
    # Addresses that were known once keep connecting those of later runs.
    now, roots = located(late), registry.roots()
    state = resolved(H.scd2_apply(history, now, AFTER, roots), roots, "address_id")
    return state.drop("match_confidence")


@query(
    recursive(
        "SELECT source_id, a.address_hash, cluster_id FROM addr a JOIN clusters USING (address_hash)",
        PLACES_SQL,
        norm_sql("staged"),
        CLUSTERS_SQL,
    )
)
def address_clusters_by_batches(spark, sf_dir):
    """The clusters of all addresses, of which three batches came one after the other."""
    rows = stage(A.normalized(staged_places(spark, sf_dir)), "normalized")
    index = ClusterIndex(spark, new_path(spark, "address-clusters"))
    for batch in range(3):
        index.add(rows.filter(F.col("source_id").cast("long") % 3 == batch))
    return index.clustered(rows).select("source_id", "address_hash", "cluster_id")
