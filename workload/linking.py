"""Standardizing, linking and merging."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from recordloom.functions import columns as C
from recordloom.functions.addresses import address_hash, normalize_address
from recordloom.operators import linkage as L
from recordloom.operators import merge as M
from recordloom.operators.joins import anti_not_in, through_bridge
from recordloom.operators.shape import standardize
from recordloom.plans import models
from recordloom.plans import presets as P
from recordloom.session import stage

from .frames import SOURCES, raw_flat, raw_nested, table, with_feeds, with_links
from .registry import query

RUN_TIME = dt.datetime(2024, 2, 1)


def feeds(spark, sf_dir):
    return (
        models.standard_flat(raw_flat(spark, sf_dir)),
        models.standard_nested(raw_nested(spark, sf_dir)),
    )


def keyed(left, right):
    domestic = C.trimmed_equals("country", P.COUNTRY)
    return (
        L.match_frame(left, P.LEFT_ID, P.MATCH_KEYS, domestic),
        L.match_frame(right, P.RIGHT_ID, P.MATCH_KEYS, domestic),
    )


@query(with_feeds("SELECT * FROM lft"))
def standardize_flat(spark, sf_dir):
    return models.standard_flat(raw_flat(spark, sf_dir))


@query(
    with_feeds(
        """
SELECT id, name, brewery_type, address_1, address_2, address_3, city, state_province,
       postal_code, country, phone, website_url,
       CASE WHEN longitude >= -180 AND longitude <= 180 THEN CAST(longitude AS DECIMAL(10,6)) END AS longitude,
       CASE WHEN latitude >= -90 AND latitude <= 90 THEN CAST(latitude AS DECIMAL(10,6)) END AS latitude
FROM raw_flat"""
    )
)
def stage_flat(spark, sf_dir):
    return standardize(raw_flat(spark, sf_dir), P.FLAT_STAGED)


@query(with_feeds("SELECT * FROM rgt"))
def standardize_nested(spark, sf_dir):
    return models.standard_nested(raw_nested(spark, sf_dir))


@query(
    with_links("SELECT brewery_id, partner_brewery_id FROM proposed WHERE rule = 1")
)
def link_exact(spark, sf_dir):
    left, right = keyed(*feeds(spark, sf_dir))
    return L.exact_pairs(left, right, ["name", "state_province"], P.LEFT_ID, P.RIGHT_ID)


@query(
    with_links(
        """
SELECT brewery_id, partner_brewery_id, round(score, 9) AS score FROM proposed WHERE rule = 2"""
    )
)
def link_fuzzy(spark, sf_dir):
    left, right = keyed(*feeds(spark, sf_dir))
    pairs = L.fuzzy_pairs(
        left, right, ["state_province", "city"], "name", 0.90, P.LEFT_ID, P.RIGHT_ID
    )
    return pairs.withColumn("score", F.round("score", 9))


@query(
    with_links(
        """
SELECT brewery_id, partner_brewery_id, round(likeness.score, 9) AS score
FROM lkey l JOIN rkey r USING (state_province, city),
     LATERAL (SELECT jaro_winkler_similarity(l.name, r.name) AS score) likeness
WHERE likeness.score > 0.95"""
    )
)
def link_fuzzy_indexed(spark, sf_dir):
    """Blocks of some size have their postings counted, and are indexed where names meet less often there."""
    left, right = keyed(*feeds(spark, sf_dir))
    pairs = L.fuzzy_pairs(
        left, right, ["state_province", "city"], "name", 0.95, P.LEFT_ID, P.RIGHT_ID, index_pairs=1 << 14
    )
    return pairs.withColumn("score", F.round("score", 9))


@query(
    with_links(
        "SELECT brewery_id, partner_brewery_id, match_strategy, round(score, 9) AS score FROM links"
    )
)
def link_two_strategy(spark, sf_dir):
    links = models.linked(*feeds(spark, sf_dir))
    return links.withColumn("score", F.round("score", 9))


NAMED = "CASE WHEN {key} % 3 = 0 THEN 'Harbor House' WHEN {key} % 3 = 1 THEN 'Harbour House' ELSE {name} END"


@query(
    f"""
WITH l AS (SELECT c_custkey, {NAMED.format(key="c_custkey", name="c_name")} AS name, c_nationkey AS nation FROM customer),
r AS (SELECT s_suppkey, {NAMED.format(key="s_suppkey", name="s_name")} AS name, s_nationkey AS nation FROM supplier)
SELECT c_custkey, s_suppkey, round(jaro_winkler_similarity(l.name, r.name), 9) AS score
FROM l JOIN r USING (nation) WHERE jaro_winkler_similarity(l.name, r.name) > 0.90"""
)
def link_repeated_name(spark, sf_dir):
    """Two spellings of one name on two thirds of either side."""
    left = table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr(NAMED.format(key="c_custkey", name="c_name")).alias("name"), F.col("c_nationkey").alias("nation")
    )
    right = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.expr(NAMED.format(key="s_suppkey", name="s_name")).alias("name"), F.col("s_nationkey").alias("nation")
    )
    pairs = L.fuzzy_pairs(left, right, ["nation"], "name", 0.90, "c_custkey", "s_suppkey", text_rows=64, chunk_rows=16)
    return pairs.withColumn("score", F.round("score", 9))


_OWN = "name brewery_type street_address city state_province postal_code country longitude latitude".split()
# One full join over the bridge; the status says which sides are there.
MERGED_SQL = f"""
bridged AS (SELECT l, k FROM lft l LEFT JOIN links k USING (brewery_id)),
merged AS (
  SELECT ifnull(b.l.brewery_id, r.partner_brewery_id) AS brewery_id, r.partner_brewery_id,
         {", ".join(f"if(b.l IS NULL, r.{c}, b.l.{c}) AS {c}" for c in _OWN)},
         {", ".join(f"ifnull(b.l.{c}, r.{c}) AS {c}" for c in P.FILLED)},
         b.k.match_strategy AS match_strategy,
         CASE WHEN b.l IS NULL THEN 'second_only' WHEN r.partner_brewery_id IS NULL THEN 'first_only' ELSE 'matched' END AS source_status
  FROM bridged b FULL JOIN rgt r ON r.partner_brewery_id = b.k.partner_brewery_id)"""


def merged_feeds(spark, sf_dir):
    """Both rules, both remainders and the merge read the feeds, so they are written once."""
    left, right = (stage(df, "feed") for df in feeds(spark, sf_dir))
    return models.merged(left, right, models.linked(left, right), SOURCES)


@query(with_links("SELECT * FROM merged", MERGED_SQL))
def merge_two_sources(spark, sf_dir):
    return merged_feeds(spark, sf_dir)


@query(
    with_links(
        """
SELECT k.brewery_id, k.partner_brewery_id, l.name AS name, r.name AS partner_name
FROM lft l JOIN links k ON l.brewery_id = k.brewery_id
LEFT JOIN rgt r ON r.partner_brewery_id = k.partner_brewery_id"""
    )
)
def attach_through_bridge(spark, sf_dir):
    left, right = feeds(spark, sf_dir)
    bridge = models.linked(left, right).select(P.LEFT_ID, P.RIGHT_ID)
    return through_bridge(
        left.select(P.LEFT_ID, "name"),
        bridge,
        right.select(P.RIGHT_ID, F.col("name").alias("partner_name")),
        P.LEFT_ID,
        P.RIGHT_ID,
    ).select(P.LEFT_ID, P.RIGHT_ID, "name", "partner_name")


def _nullable_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("nullif(o_custkey, 7)").alias("custkey")
    )
    return orders, table(spark, sf_dir, "customer")


@query(
    """
SELECT o_orderkey, custkey FROM (SELECT o_orderkey, nullif(o_custkey, 7) AS custkey FROM orders)
WHERE custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 5000)"""
)
def anti_filled_list(spark, sf_dir):
    orders, customer = _nullable_keys(spark, sf_dir)
    listed = customer.filter("c_acctbal < 5000")
    return anti_not_in(orders, "custkey", listed, "c_custkey")


@query(
    """
SELECT o_orderkey, custkey FROM (SELECT o_orderkey, nullif(o_custkey, 7) AS custkey FROM orders)
WHERE custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 1e12)"""
)
def anti_empty_list(spark, sf_dir):
    orders, customer = _nullable_keys(spark, sf_dir)
    return anti_not_in(orders, "custkey", customer.filter("c_acctbal > 1e12"), "c_custkey")


@query(
    """
SELECT o_orderkey, custkey FROM (SELECT o_orderkey, nullif(o_custkey, 7) AS custkey FROM orders)
WHERE custkey NOT IN (SELECT nullif(c_custkey, 3) FROM customer)"""
)
def anti_null_in_list(spark, sf_dir):
    orders, customer = _nullable_keys(spark, sf_dir)
    listed = customer.select(F.expr("nullif(c_custkey, 3)").alias("c_custkey"))
    return anti_not_in(orders, "custkey", listed, "c_custkey")


@query(
    with_links(
        """
SELECT 'left' AS side, brewery_id AS id, count(DISTINCT partner_brewery_id) AS partners
FROM links GROUP BY brewery_id HAVING count(DISTINCT partner_brewery_id) > 1
UNION ALL
SELECT 'right', partner_brewery_id, count(DISTINCT brewery_id)
FROM links GROUP BY partner_brewery_id HAVING count(DISTINCT brewery_id) > 1"""
    )
)
def multi_match(spark, sf_dir):
    return L.multi_match(models.linked(*feeds(spark, sf_dir)), P.LEFT_ID, P.RIGHT_ID)


# An address here is a street with house number and its city, in short form.
PAIRS_SQL = """
ladr AS (
  SELECT lkey.*, md5(replace(lower(lft.street_address), 'street', 'st') || '|' || lkey.city) AS address_hash,
         street_address, latitude, longitude, lft.name AS full_name
  FROM lkey JOIN lft USING (brewery_id)),
radr AS (
  SELECT rkey.*, md5(replace(lower(rgt.street_address), 'street', 'st') || '|' || rkey.city) AS address_hash,
         street_address, latitude, longitude, rgt.name AS full_name
  FROM rkey JOIN rgt USING (partner_brewery_id)),
found AS (
  SELECT brewery_id, partner_brewery_id, CAST(1.0 AS DOUBLE) AS score, true AS exact,
         false AS same_place, false AS same_address
  FROM ladr JOIN radr USING (name, state_province)
  UNION ALL
  SELECT l.brewery_id, r.partner_brewery_id, jaro_winkler_similarity(l.name, r.name), false, true, false
  FROM ladr l JOIN radr r ON l.state_province = r.state_province AND l.city = r.city
  WHERE jaro_winkler_similarity(l.name, r.name) >= 0.85
  UNION ALL
  SELECT l.brewery_id, r.partner_brewery_id, jaro_winkler_similarity(l.name, r.name), false, false, true
  FROM ladr l JOIN radr r ON l.address_hash = r.address_hash
  WHERE jaro_winkler_similarity(l.name, r.name) > 0.70),
pairs AS (
  SELECT brewery_id, partner_brewery_id, max(score) AS score, bool_or(exact) AS exact,
         bool_or(same_place) AS same_place, bool_or(same_address) AS same_address
  FROM found GROUP BY brewery_id, partner_brewery_id),
tiered AS (
  SELECT * FROM (
    SELECT *, CASE WHEN exact OR (same_place AND score > 0.95) THEN 'high'
                   WHEN same_place AND score BETWEEN 0.85 AND 0.95 THEN 'medium'
                   WHEN same_address AND score > 0.70 THEN 'medium' END AS confidence
    FROM pairs) WHERE confidence IS NOT NULL),
flagged AS (
  SELECT * FROM (
    SELECT t.brewery_id, t.partner_brewery_id, t.score,
           CASE WHEN same_place AND score BETWEEN 0.85 AND 0.95 THEN 'borderline_name'
                WHEN same_address AND score > 0.70 AND score < 0.85 THEN 'same_address_diff_name'
                WHEN a.n > 1 OR b.n > 1 THEN 'multiple_matches' END AS match_reason
    FROM tiered t
    JOIN (SELECT brewery_id, count(DISTINCT partner_brewery_id) AS n FROM tiered GROUP BY 1) a
      ON a.brewery_id = t.brewery_id
    JOIN (SELECT partner_brewery_id, count(DISTINCT brewery_id) AS n FROM tiered GROUP BY 1) b
      ON b.partner_brewery_id = t.partner_brewery_id)
  WHERE match_reason IS NOT NULL)"""


def _addressed(spark, sf_dir, sides=None):
    """Match frames with an address digest, and the detail columns of a review.

    ``sides`` are the two standard feeds, if they were read already.
    """
    out = []
    left, right = sides or feeds(spark, sf_dir)
    for df, own_id in ((left, P.LEFT_ID), (right, P.RIGHT_ID)):
        df = df.filter(C.trimmed_equals("country", P.COUNTRY))
        out.append(
            df.select(
                own_id,
                *[C.match_key(k).alias(k) for k in P.MATCH_KEYS],
                address_hash(
                    normalize_address("street_address"), C.match_key("city")
                ).alias("address_hash"),
                "street_address",
                "latitude",
                "longitude",
                F.col("name").alias("full_name"),
            )
        )
    return out


@query(
    with_feeds(
        """
SELECT brewery_id, partner_brewery_id, round(score, 9) AS score, exact, same_place, same_address,
       confidence FROM tiered""",
        """lkey AS (SELECT brewery_id, lower(trim(name)) AS name, lower(trim(city)) AS city,
         lower(trim(state_province)) AS state_province FROM lft WHERE trim(country) = 'United States'),
rkey AS (SELECT partner_brewery_id, lower(trim(name)) AS name, lower(trim(city)) AS city,
         lower(trim(state_province)) AS state_province FROM rgt WHERE trim(country) = 'United States')""",
        PAIRS_SQL,
    )
)
def confidence_tiers(spark, sf_dir):
    left, right = _addressed(spark, sf_dir)
    tiered = L.tier(L.scored_pairs(left, right, P.LEFT_ID, P.RIGHT_ID))
    return tiered.withColumn("score", F.round("score", 9))
