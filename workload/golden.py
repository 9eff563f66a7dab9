"""Gold ids, identities, the review queue, and the published datasets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from recordloom.operators import addresses as A
from recordloom.operators import gold as G
from recordloom.operators import history as H
from recordloom.operators import linkage as L
from recordloom.operators import merge as M
from recordloom.operators import quality as Q
from recordloom.operators.decisions import APPROVED, PENDING, REJECTED, DecisionLog, decided_pairs, undecided
from recordloom.operators.numbering import seen_range as seen_by
from recordloom.plans import models
from recordloom.plans import presets as P
from recordloom.session import new_path, stage
from recordloom.sources.tables import flatten

from .frames import KEYS_SQL, LINKS_SQL, SOURCES, table, with_feeds, with_links
from .linking import PAIRS_SQL, RUN_TIME, _addressed, feeds
from .places import CLUSTERS_SQL, DIM_SQL, metres_sql, norm_sql
from .registry import query
from .timeline import DAILY_SQL, RUNS_SQL, located

AS_OF = dt.date(2024, 2, 1)

MAPPING_SQL = """
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY brewery_id
                   ORDER BY round(score, 9) DESC, partner_brewery_id) AS rn FROM links) WHERE rn = 1),
mapping AS (
  SELECT 'first_' || l.brewery_id AS gold_id, l.brewery_id, b.partner_brewery_id, b.match_strategy,
         b.score AS match_confidence
  FROM lft l LEFT JOIN best b USING (brewery_id)
  UNION ALL
  SELECT 'second_' || partner_brewery_id, NULL, partner_brewery_id, NULL, NULL
  FROM rgt WHERE partner_brewery_id NOT IN (SELECT partner_brewery_id FROM best))"""

IDENTITY_SQL = """
lseen AS (SELECT *, DATE '2024-01-01' + CAST(postal_code AS INT) % 28 AS seen_on FROM lft),
rseen AS (SELECT *, DATE '2024-01-01' + CAST(postal_code AS INT) % 28 AS seen_on FROM rgt),
identity AS (
  SELECT m.gold_id, m.brewery_id, m.partner_brewery_id, coalesce(l.name, r.name) AS name,
         coalesce(l.brewery_type, r.brewery_type) AS category, coalesce(r.phone, l.phone) AS phone,
         CASE WHEN r.phone IS NOT NULL THEN 'second' WHEN l.phone IS NOT NULL THEN 'first' END AS phone_source,
         coalesce(r.website_url, l.website_url) AS website_url,
         CASE WHEN r.website_url IS NOT NULL THEN 'second'
              WHEN l.website_url IS NOT NULL THEN 'first' END AS website_source,
         r.membership_status, true AS is_active, m.brewery_id IS NOT NULL AS is_public,
         CASE WHEN m.brewery_id IS NOT NULL THEN 'first' ELSE 'second_restricted' END AS data_license,
         CASE WHEN m.brewery_id IS NOT NULL AND m.partner_brewery_id IS NOT NULL
              THEN DATE '2024-02-01' END AS enrichment_date,
         CASE WHEN l.seen_on IS NULL OR r.seen_on < l.seen_on THEN r.seen_on ELSE l.seen_on END AS first_seen,
         CASE WHEN l.seen_on IS NULL OR r.seen_on > l.seen_on THEN r.seen_on ELSE l.seen_on END AS last_seen
  FROM mapping m LEFT JOIN lseen l ON m.brewery_id = l.brewery_id
  LEFT JOIN rseen r ON m.partner_brewery_id = r.partner_brewery_id)"""

FLAT_SQL = """
flat AS (
  SELECT i.*, m.match_confidence, coalesce(l.city, r.city) AS city,
         CASE WHEN l.brewery_id IS NOT NULL THEN l.state_province ELSE r.state_province END AS state_province,
         CASE WHEN l.brewery_id IS NOT NULL THEN l.country ELSE r.country END AS country,
         CASE WHEN l.brewery_id IS NOT NULL THEN l.latitude ELSE r.latitude END AS latitude,
         CASE WHEN l.brewery_id IS NOT NULL THEN l.longitude ELSE r.longitude END AS longitude,
         CASE WHEN i.brewery_id IS NULL THEN 'second' WHEN i.partner_brewery_id IS NULL THEN 'first'
              ELSE 'both' END AS source_system
  FROM identity i JOIN mapping m USING (gold_id)
  LEFT JOIN lft l ON i.brewery_id = l.brewery_id
  LEFT JOIN rgt r ON i.partner_brewery_id = r.partner_brewery_id)"""


def seen_feeds(spark, sf_dir):
    """Both feeds with a category, and the dates they were seen; written once, as a run would."""
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("postal_code").cast("int") % 28))
    return [
        stage(
            df.withColumnRenamed("brewery_type", "category").withColumns(
                {"seen_on": day, "first_seen": day, "last_seen": day}
            ),
            "feed",
        )
        for df in feeds(spark, sf_dir)
    ]


def mapped(spark, sf_dir):
    left, right = seen_feeds(spark, sf_dir)
    links = models.best_linked(left, right)
    mapping = M.id_mapping(left, right, links, P.LEFT_ID, P.RIGHT_ID, SOURCES, RUN_TIME)
    return left, right, stage(mapping, "mapping")


def identified(left, right, mapping):
    return M.identity_dim(
        mapping.select("gold_id", P.LEFT_ID, P.RIGHT_ID),
        left,
        right,
        P.LEFT_ID,
        P.RIGHT_ID,
        SOURCES,
        M.standard_priority(SOURCES),
        AS_OF,
        ["membership_status"],
    )


def flat_snapshot(spark, sf_dir):
    """Identities beside the place their own feed row gives."""
    left, right, mapping = mapped(spark, sf_dir)
    place = ("city", "state_province", "country", "latitude", "longitude")
    own = [
        mapping.filter(on)
        .join(df.select(key, *place), key)
        .select("gold_id", *place)
        for df, key, on in (
            (left, P.LEFT_ID, f"{P.LEFT_ID} IS NOT NULL"),
            (right, P.RIGHT_ID, f"{P.LEFT_ID} IS NULL"),
        )
    ]
    from recordloom.functions.columns import source_flag

    facts = mapping.select(
        "gold_id",
        "match_confidence",
        source_flag(P.LEFT_ID, P.RIGHT_ID, SOURCES.left, SOURCES.right).alias("source_system"),
    )
    return (
        identified(left, right, mapping).join(facts, "gold_id").join(own[0].union(own[1]), "gold_id")
    )


@query(
    with_links(
        """SELECT gold_id, brewery_id, partner_brewery_id, match_strategy,
       round(match_confidence, 9) AS match_confidence, TIMESTAMP '2024-02-01 00:00:00' AS created_at
FROM mapping""",
        MAPPING_SQL,
    )
)
def id_mapping(spark, sf_dir):
    mapping = mapped(spark, sf_dir)[2]
    return mapping.withColumn("match_confidence", F.round("match_confidence", 9)).withColumn(
        "created_at", F.col("created_at").cast("timestamp_ntz")
    )


@query(with_links("SELECT * FROM identity", MAPPING_SQL, IDENTITY_SQL))
def identity_dim(spark, sf_dir):
    return identified(*mapped(spark, sf_dir))


TALL_SQL = """
counts AS (
  SELECT count(*) AS entities, count(*) FILTER (is_active) AS active,
         count(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL) AS with_coordinates,
         count(phone) AS with_phone, count(website_url) AS with_website,
         count(*) FILTER (source_system <> 'first') AS enriched,
         count(*) FILTER (phone_source = 'first') AS phone_from_first,
         count(*) FILTER (phone_source = 'second') AS phone_from_second,
         count(*) FILTER (website_source = 'first') AS website_from_first,
         count(*) FILTER (website_source = 'second') AS website_from_second
  FROM flat),
countries AS (
  SELECT country, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, country) AS rn
  FROM flat GROUP BY country),
tall AS (
  SELECT 'total' AS section, key, n FROM (UNPIVOT counts ON COLUMNS(*) INTO NAME key VALUE n)
  UNION ALL SELECT 'by_source', source_system, count(*) FROM flat GROUP BY 2
  UNION ALL SELECT 'by_category', category, count(*) FROM flat GROUP BY 2
  UNION ALL SELECT 'by_country', country, n FROM countries WHERE rn <= 2
  UNION ALL SELECT 'by_country', 'Other', CAST(sum(n) AS BIGINT) FROM countries WHERE rn > 2 HAVING sum(n) > 0)"""


@query(with_links("SELECT section, key, n FROM tall", MAPPING_SQL, IDENTITY_SQL, FLAT_SQL, TALL_SQL))
def statistics(spark, sf_dir):
    return G.statistics(flat_snapshot(spark, sf_dir), SOURCES, top_countries=2)


@query(with_links("SELECT section, key, n FROM tall", MAPPING_SQL, IDENTITY_SQL, FLAT_SQL, TALL_SQL))
def statistics_by_loads(spark, sf_dir):
    """The same after two loads: entities were added, ended, and changed their category and phone."""
    flat = stage(flat_snapshot(spark, sf_dir), "flat")
    turn = F.pmod(F.xxhash64("gold_id"), F.lit(4))
    changed = flat.filter(turn == 1)
    before = changed.withColumns({"category": F.lit("planned"), "phone": F.lit(None).cast("string"), "country": F.lit("Elsewhere")})
    ended = flat.filter(turn == 2).withColumn("gold_id", F.concat(F.lit("old_"), "gold_id"))
    log = G.StatisticsLog(spark, new_path(spark, "statistics"), SOURCES)
    log.load(flat.filter(turn > 1).union(before).union(ended))
    log.load(flat.filter(turn == 0).union(changed), before.union(ended))
    return log.statistics(top_countries=2)


@query(
    with_links(
        """
SELECT entities AS total, active, with_coordinates, with_phone, with_website, enriched,
       phone_from_first, phone_from_second, website_from_first, website_from_second,
       (SELECT count(*) FROM flat WHERE source_system = 'both') AS matched,
       (SELECT count(*) FROM flat WHERE category = 'taproom') AS taproom,
       (SELECT count(*) FROM flat WHERE category NOT IN ('taproom', 'Unknown')) AS other_categories,
       (SELECT string_agg(key || '=' || n, ';' ORDER BY key) FROM tall WHERE section = 'by_country') AS countries
FROM counts""",
        MAPPING_SQL,
        IDENTITY_SQL,
        FLAT_SQL,
        TALL_SQL,
    )
)
def statistics_document(spark, sf_dir):
    tall = G.statistics(flat_snapshot(spark, sf_dir), SOURCES, top_countries=2)
    document = G.statistics_document(tall, SOURCES, ["taproom", "Unknown"])
    return document.select(
        "total",
        "active",
        "data_quality.*",
        "provenance.*",
        "by_source.matched",
        "by_category.taproom",
        F.col("by_category.Other").alias("other_categories"),
        F.array_join(
            F.transform("by_country", lambda c: F.concat_ws("=", c["key"], c["n"])), ";"
        ).alias("countries"),
    )


@query(
    with_links(
        """
SELECT source_system, sum(1)::BIGINT AS entity_count, count(*) FILTER (phone_source = 'second') AS phone_count,
       count(*) FILTER (website_source = 'second') AS website_count, count(*) FILTER (is_public) AS public_count
FROM flat GROUP BY ALL""",
        MAPPING_SQL,
        IDENTITY_SQL,
        FLAT_SQL,
    )
)
def provenance(spark, sf_dir):
    return G.provenance(flat_snapshot(spark, sf_dir), SOURCES.right)


@query(
    with_links(
        f"""
SELECT gold_id, name, city FROM flat, (SELECT 12.0 AS latitude, -30.0 AS longitude) p
WHERE (contains(lower(name), 'the') OR contains(lower(city), 'the') OR contains(lower(state_province), 'the'))
  AND {metres_sql("p", "flat")} <= 2500 * 1609.344
ORDER BY gold_id LIMIT 50 OFFSET 50""",
        MAPPING_SQL,
        IDENTITY_SQL,
        FLAT_SQL,
    )
)
def search(spark, sf_dir):
    found = G.search(
        flat_snapshot(spark, sf_dir), "gold_id", "The", (12.0, -30.0), miles=2500, page=2
    )
    return found.rows.select("gold_id", "name", "city")


GOLD_SQL = """
staged AS (
  SELECT 'first' AS source_system, brewery_id AS source_id, street_address, city, state_province,
         postal_code, country, latitude, longitude, seen_on FROM lseen WHERE street_address IS NOT NULL
  UNION ALL
  SELECT 'second', partner_brewery_id, street_address, city, state_province, postal_code, country,
         latitude, longitude, seen_on FROM rseen WHERE street_address IS NOT NULL)"""
CURRENT_SQL = """
members AS (
  SELECT c.source_system, c.source_id, d.address_id FROM clustered c JOIN dim d USING (cluster_id)),
places_of AS (
  SELECT m.gold_id, arg_min(x.address_id, x.rnk) AS address_id
  FROM mapping m JOIN (
    SELECT *, CASE source_system WHEN 'first' THEN 0 ELSE 1 END AS rnk FROM members) x
    ON (x.source_system = 'first' AND x.source_id = m.brewery_id)
    OR (x.source_system = 'second' AND x.source_id = m.partner_brewery_id)
  GROUP BY m.gold_id),
locations AS (
  SELECT row_number() OVER (ORDER BY gold_id) AS location_id, gold_id, address_id,
         CASE WHEN m.brewery_id IS NULL THEN 'second' WHEN m.partner_brewery_id IS NULL THEN 'first'
              ELSE 'both' END AS source_system,
         coalesce(match_confidence, 1.0) AS match_confidence
  FROM places_of JOIN mapping m USING (gold_id)),
gold_now AS (
  SELECT i.*, l.source_system, l.match_confidence, l.address_id, d.street_address, d.city,
         d.state_province, d.postal_code, d.country, d.latitude, d.longitude, d.coordinates_source
  FROM identity i JOIN locations l USING (gold_id) JOIN dim d USING (address_id))"""


def with_gold(body: str, *more: str) -> str:
    whole = with_links(
        body,
        MAPPING_SQL,
        IDENTITY_SQL,
        GOLD_SQL,
        norm_sql("staged"),
        CLUSTERS_SQL,
        DIM_SQL,
        CURRENT_SQL,
        *more,
    )
    return whole.replace("WITH ", "WITH RECURSIVE ", 1)


def with_twins(dim):
    """The dimension and, for every seventh address with coordinates, a twin still to merge."""
    twins = dim.filter("address_id % 7 = 0 AND latitude IS NOT NULL AND longitude IS NOT NULL").withColumns(
        {"address_id": F.col("address_id") + 10_000_000, "address_hash": F.md5(F.concat("address_hash", F.lit("twin")))}
    )
    return dim.unionByName(twins)


def gold_tables(spark, sf_dir, located=True):
    """Mapping, identities, address rows, address dimension and first locations of one run.

    The core tables are staged, as a run would write them; several models read each.
    Without ``located`` no locations are made.
    """
    left, right, mapping = mapped(spark, sf_dir)
    staged = A.stage_addresses(
        {SOURCES.left: left, SOURCES.right: right},
        {SOURCES.left: P.LEFT_ID, SOURCES.right: P.RIGHT_ID},
        "seen_on",
    )
    clustered = stage(A.cluster_addresses(A.normalized(staged)), "clustered")
    dim = A.address_dim(clustered, (SOURCES.left, SOURCES.right))
    locations = None
    if located:
        members = A.address_members(clustered, dim)
        now = H.current_locations(mapping, members, P.LEFT_ID, P.RIGHT_ID, SOURCES)
        locations = H.scd2_initial(now, AS_OF)
    return mapping, identified(left, right, mapping), clustered, dim, locations, (left, right)


@query(
    with_gold(
        """SELECT * EXCLUDE (match_confidence), round(match_confidence, 9) AS match_confidence FROM gold_now"""
    )
)
def gold_current(spark, sf_dir):
    _, identities, _, dim, locations, _ = gold_tables(spark, sf_dir)
    flat = G.current(identities, locations, dim)
    return flat.withColumn("match_confidence", F.round("match_confidence", 9))


@query(
    with_gold(
        """SELECT gold_id AS id, name, category, brewery_id AS identifiers_first_id,
       partner_brewery_id AS identifiers_second_id, street_address AS address_street, city AS address_city,
       state_province AS address_state, postal_code AS address_postal_code, country AS address_country,
       phone AS contact_phone, phone_source AS contact_phone_source, website_url AS contact_website,
       website_source AS contact_website_source, latitude AS location_latitude, longitude AS location_longitude,
       coordinates_source AS location_coordinates_source, membership_status AS enrichment_membership_status,
       round(match_confidence, 9) AS enrichment_match_confidence, source_system AS enrichment_source_system,
       enrichment_date AS enrichment_enrichment_date, is_active AS metadata_is_active,
       is_public AS metadata_is_public, data_license AS metadata_data_license,
       first_seen AS metadata_first_seen, last_seen AS metadata_last_seen
FROM gold_now"""
    )
)
def gold_documents_flattened(spark, sf_dir):
    _, identities, _, dim, locations, _ = gold_tables(spark, sf_dir)
    flat = G.current(identities, locations, dim)
    flat = flat.withColumn("match_confidence", F.round("match_confidence", 9))
    return flatten(G.nested_current(flat, P.LEFT_ID, P.RIGHT_ID, SOURCES))


def reviewed(spark, sf_dir, sides=None):
    left, right = (stage(df, "addressed") for df in _addressed(spark, sf_dir, sides))
    tiered = L.tier(L.scored_pairs(left, right, P.LEFT_ID, P.RIGHT_ID))
    flagged = L.review_flags(tiered, P.LEFT_ID, P.RIGHT_ID)
    return L.review_queue(
        flagged, left, right, P.LEFT_ID, P.RIGHT_ID, RUN_TIME, name="full_name"
    )


# A person went through the queue of a first run: some pairs are approved, some rejected.
DECIDED_SQL = """
decided AS (
  SELECT brewery_id, partner_brewery_id,
         CASE (length(l.name) + length(r.name)) % 4 WHEN 0 THEN 'approved' ELSE 'rejected' END AS review_status
  FROM flagged JOIN ladr l USING (brewery_id) JOIN radr r USING (partner_brewery_id)
  WHERE (length(l.name) + length(r.name)) % 4 < 2)"""
DECIDED_AT = dt.datetime(2024, 2, 2)


def decided(spark, sf_dir):
    """The two feeds of a run, their scored pairs, and the decisions on its queue, kept in a log."""
    left, right = (stage(df, "feed") for df in _addressed(spark, sf_dir))
    pairs = L.scored_pairs(left, right, P.LEFT_ID, P.RIGHT_ID)
    flagged = L.review_flags(L.tier(pairs), P.LEFT_ID, P.RIGHT_ID)
    names = [df.select(key, F.length("name").alias(n)) for df, key, n in ((left, P.LEFT_ID, "a"), (right, P.RIGHT_ID, "b"))]
    read = flagged.join(names[0], P.LEFT_ID).join(names[1], P.RIGHT_ID).withColumn("turn", (F.col("a") + F.col("b")) % 4)
    # Three steps of the log read it, and each would flag all pairs anew.
    read = stage(read.select(P.LEFT_ID, P.RIGHT_ID, "turn"), "read")

    def rows(df, status, at):
        return df.select(
            F.col(P.LEFT_ID).alias("left_id"), F.col(P.RIGHT_ID).alias("right_id"), F.lit(status).alias("review_status"),
            F.lit(at).alias("decided_at"), F.lit("reader").alias("decided_by"),
        )

    log = DecisionLog(spark, new_path(spark, "decisions"))
    # All are rejected at first; the next day some of these are approved and others reopened.
    log.append(rows(read, REJECTED, DECIDED_AT))
    later = DECIDED_AT + dt.timedelta(days=1)
    log.append(rows(read.filter("turn = 0"), APPROVED, later).union(rows(read.filter("turn > 1"), PENDING, later)))
    return left, right, pairs, stage(log.current(), "decided")


@query(
    with_links(
        """
SELECT brewery_id, partner_brewery_id, CASE WHEN t.approved THEN 'high' ELSE confidence END AS confidence,
       match_reason
FROM tiered_after t LEFT JOIN flagged_after USING (brewery_id, partner_brewery_id)""",
        PAIRS_SQL,
        DECIDED_SQL,
        """
tiered_after AS (
  SELECT t.*, coalesce(d.review_status = 'approved', false) AS approved
  FROM tiered t LEFT JOIN decided d USING (brewery_id, partner_brewery_id)
  WHERE d.review_status IS DISTINCT FROM 'rejected'),
flagged_after AS (
  SELECT brewery_id, partner_brewery_id,
         CASE WHEN same_place AND score BETWEEN 0.85 AND 0.95 THEN 'borderline_name'
              WHEN same_address AND score > 0.70 AND score < 0.85 THEN 'same_address_diff_name'
              WHEN count(*) OVER (PARTITION BY brewery_id) > 1
                OR count(*) OVER (PARTITION BY partner_brewery_id) > 1 THEN 'multiple_matches' END AS match_reason
  FROM tiered_after QUALIFY match_reason IS NOT NULL AND NOT approved)""",
    )
)
def review_after_decisions(spark, sf_dir):
    """Tiers of the next run, and what its queue still asks for."""
    left, right, pairs, decisions = decided(spark, sf_dir)
    tiered = stage(L.tier(decided_pairs(pairs, decisions, left, right, P.LEFT_ID, P.RIGHT_ID)), "tiers")
    flagged = undecided(L.review_flags(tiered, P.LEFT_ID, P.RIGHT_ID), decisions, P.LEFT_ID, P.RIGHT_ID)
    asked = flagged.select(P.LEFT_ID, P.RIGHT_ID, "match_reason")
    return tiered.select(P.LEFT_ID, P.RIGHT_ID, "confidence").join(asked, [P.LEFT_ID, P.RIGHT_ID], "left")


@query(
    with_feeds(
        "SELECT brewery_id, partner_brewery_id, match_strategy, round(match_confidence, 9) AS match_confidence FROM mapping",
        KEYS_SQL,
        PAIRS_SQL,
        DECIDED_SQL,
        LINKS_SQL.replace(
            "  SELECT 1 AS rule,",
            "  SELECT 0 AS rule, brewery_id, partner_brewery_id, 1.0::DOUBLE AS score FROM decided WHERE review_status = 'approved'\n"
            "  UNION ALL\n  SELECT 1 AS rule,",
        )
        .replace("proposed AS (", "offered AS (")
        .replace(
            "links AS (",
            "proposed AS (\n  FROM offered o WHERE NOT EXISTS (FROM decided d WHERE d.review_status = 'rejected'\n"
            "    AND d.brewery_id = o.brewery_id AND d.partner_brewery_id = o.partner_brewery_id)),\nlinks AS (",
        )
        .replace("['exact_name_state', 'fuzzy_name_city'][rule]", "['approved', 'exact_name_state', 'fuzzy_name_city'][rule + 1]"),
        MAPPING_SQL,
    )
)
def mapping_after_decisions(spark, sf_dir):
    """The mapping of the next run: approved pairs are in it, rejected ones are not."""
    *_, decisions = decided(spark, sf_dir)
    left, right = seen_feeds(spark, sf_dir)
    links = models.linked(left, right, decisions=decisions)
    mapping = M.id_mapping(left, right, links, P.LEFT_ID, P.RIGHT_ID, SOURCES, RUN_TIME)
    return mapping.select(P.LEFT_ID, P.RIGHT_ID, "match_strategy", F.round("match_confidence", 9).alias("match_confidence"))


@query(
    with_feeds(
        f"""
SELECT row_number() OVER (ORDER BY brewery_id, partner_brewery_id) AS review_id, brewery_id,
       partner_brewery_id, l.full_name AS left_name, r.full_name AS right_name,
       l.street_address AS left_address, r.street_address AS right_address, match_reason,
       round(f.score, 9) AS name_similarity,
       CASE WHEN l.address_hash = r.address_hash THEN 0.0
            ELSE round({metres_sql("l", "r")}, 2) END AS address_similarity,
       'pending' AS review_status, TIMESTAMP '2024-02-01 00:00:00' AS created_at
FROM flagged f JOIN ladr l USING (brewery_id) JOIN radr r USING (partner_brewery_id)""",
        KEYS_SQL,
        PAIRS_SQL,
    )
)
def review_queue(spark, sf_dir):
    return reviewed(spark, sf_dir).withColumns(
        {
            "name_similarity": F.round("name_similarity", 9),
            "address_similarity": F.round("address_similarity", 2),
            "created_at": F.col("created_at").cast("timestamp_ntz"),
        }
    )


@query(
    with_feeds(
        """
SELECT floor(score / 0.05 + 1e-9) * 5 / 100 AS bucket, count(*) AS n FROM (
  SELECT round(score, 9) AS score FROM tiered) GROUP BY 1""",
        KEYS_SQL,
        PAIRS_SQL,
    ).replace("floor(score / 0.05 + 1e-9) * 5 / 100", "round(floor(score / 0.05) * 0.05, 9)")
)
def score_histogram(spark, sf_dir):
    left, right = _addressed(spark, sf_dir)
    tiered = L.tier(L.scored_pairs(left, right, P.LEFT_ID, P.RIGHT_ID))
    return G.histogram(tiered.withColumn("score", F.round("score", 9)), "score", 0.05)


@query(
    """
SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY user_id"""
)
def seen_range(spark, sf_dir):
    return seen_by(table(spark, sf_dir, "events"), ["user_id"], "ts")


REVIEW_SQL = PAIRS_SQL  # reads lkey and rkey, which the linking expressions define


@query(
    with_gold(
        """
, coverage AS (
  SELECT (SELECT count(DISTINCT brewery_id) FROM mapping) + (SELECT count(DISTINCT partner_brewery_id) FROM mapping) AS ids,
         (SELECT count(*) FROM lft WHERE brewery_id NOT IN (SELECT brewery_id FROM mapping WHERE brewery_id IS NOT NULL))
         + (SELECT count(*) FROM rgt WHERE partner_brewery_id NOT IN
              (SELECT partner_brewery_id FROM mapping WHERE partner_brewery_id IS NOT NULL)) AS missing),
measured AS (
  -- Every seventh address with coordinates has a twin under another digest, which is still to merge.
  SELECT 'address_dedup_rate' AS metric, merged / (merged + twins) AS value,
         CAST(0.95 AS DOUBLE) AS target, true AS above
  FROM (SELECT (SELECT count(*) FROM clustered) - (SELECT count(*) FROM dim) AS merged,
               (SELECT count(*) FROM dim WHERE address_id % 7 = 0 AND latitude IS NOT NULL AND longitude IS NOT NULL) AS twins)
  UNION ALL
  SELECT 'match_rate', (SELECT count(DISTINCT partner_brewery_id) FROM mapping WHERE brewery_id IS NOT NULL)
         / (SELECT count(DISTINCT partner_brewery_id) FROM mapping), 0.8, true
  UNION ALL
  SELECT 'review_queue_size', (SELECT count(*) FROM flagged), 500.0, false
  UNION ALL
  SELECT 'coverage', ids / (ids + missing), 0.999999999, true FROM coverage)
SELECT metric, round(value, 9) AS value, target,
       CASE WHEN above THEN value > target ELSE value < target END AS met
FROM measured""",
        REVIEW_SQL,
    )
)
def pipeline_metrics(spark, sf_dir):
    mapping, _, clustered, dim, _, (left, right) = gold_tables(spark, sf_dir, located=False)
    missing = Q.mapping_complete({P.LEFT_ID: left, P.RIGHT_ID: right}, mapping)
    remaining = Q.no_near_duplicates(with_twins(dim))
    measured = Q.pipeline_metrics(
        clustered, dim, remaining, mapping, missing, reviewed(spark, sf_dir, (left, right)), P.LEFT_ID, P.RIGHT_ID
    )
    return measured.withColumn("value", F.round("value", 9))


@query(
    with_gold(
        """
SELECT 'confidence' AS section, format('{:.2f}', floor(match_confidence * 20) / 20) AS key,
       CAST(count(*) AS DOUBLE) AS value
FROM mapping WHERE match_confidence IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'review', match_reason, count(*) FROM flagged GROUP BY 2
UNION ALL
SELECT 'addresses', 'addresses', count(*) FROM dim
UNION ALL
SELECT 'addresses', 'variants', sum(variants) FROM dim
UNION ALL
SELECT 'lifecycle', unnest(['mean_days', 'closure_rate']), unnest([avg(days), avg(if(open, 0.0, 1.0))])
FROM (SELECT user_id, max(ifnull(valid_to, DATE '2024-03-01')) - min(valid_from) AS days, bool_or(is_current) AS open
      FROM located GROUP BY user_id)""",
        REVIEW_SQL,
        DAILY_SQL,
        RUNS_SQL,
    )
)
def quality_report(spark, sf_dir):
    """The lifecycle is that of the event stream's users, some of whom are closed."""
    mapping, _, _, dim, _, sides = gold_tables(spark, sf_dir, located=False)
    lives = located(spark, sf_dir).withColumnRenamed("user_id", "gold_id")
    return Q.quality_report(mapping, reviewed(spark, sf_dir, sides), lives, dim, dt.date(2024, 3, 1))


# Faults: some locations are listed twice, some point nowhere, some end before they start.
_FAULTY_SQL = f"""
faulty AS (
  SELECT location_id, gold_id, address_id, DATE '{AS_OF}' AS valid_from, CAST(NULL AS DATE) AS valid_to FROM locations
  UNION ALL
  SELECT location_id, gold_id, address_id, DATE '{AS_OF}', NULL FROM locations WHERE location_id % 10 = 0
  UNION ALL
  SELECT location_id + 1000000000, 'ghost_' || gold_id, -address_id, DATE '{AS_OF}', DATE '{AS_OF}' - 1 FROM locations
  WHERE location_id % 15 = 0)"""


@query(
    with_gold(
        """
SELECT test, failures::BIGINT AS failures, if(failures = 0, 'pass', 'fail') AS status
FROM (
  SELECT 'gold_id_unique' AS test, count(*) - count(DISTINCT gold_id) AS failures FROM identity
  UNION ALL SELECT 'location_id_unique', count(*) FROM (FROM faulty SELECT location_id GROUP BY ALL HAVING count(*) > 1)
  UNION ALL SELECT 'address_id_unique', count(*) - count(DISTINCT address_id) FROM dim
  UNION ALL SELECT 'location_has_identity', count(*) FROM faulty f WHERE NOT EXISTS (FROM identity i WHERE i.gold_id = f.gold_id)
  UNION ALL SELECT 'location_has_address', count(*) FROM faulty f WHERE NOT EXISTS (FROM dim d WHERE d.address_id = f.address_id)
  UNION ALL SELECT 'one_start_per_entity', count(*) FROM (FROM faulty SELECT gold_id, valid_from GROUP BY ALL HAVING count(*) > 1)
  UNION ALL SELECT 'dates_in_order', count(*) FILTER (valid_to < valid_from) FROM faulty
  UNION ALL SELECT 'one_current_location', count(*) FROM (FROM faulty SELECT gold_id GROUP BY gold_id HAVING count(*) > 1)
  UNION ALL SELECT 'no_near_duplicates', 2 * (SELECT count(*) FROM dim
    WHERE address_id % 7 = 0 AND latitude IS NOT NULL AND longitude IS NOT NULL))""",
        _FAULTY_SQL,
    )
)
def core_suite(spark, sf_dir):
    """The tests of the core tables, over tables with faults."""
    _, identities, _, dim, locations, _ = gold_tables(spark, sf_dir)
    known = stage(locations, "locations")
    ghosts = known.filter("location_id % 15 = 0").withColumns(
        {
            "location_id": F.col("location_id") + 1_000_000_000,
            "gold_id": F.concat(F.lit("ghost_"), "gold_id"),
            "address_id": -F.col("address_id"),
            "valid_to": F.date_sub("valid_from", 1),
            "is_current": F.lit(True),
        }
    )
    faulty = known.unionByName(known.filter("location_id % 10 = 0")).unionByName(ghosts)
    dim = stage(dim, "dim")
    suite = Q.run_suite(Q.core_tests(identities, faulty, with_twins(dim)))
    return suite


@query(
    with_feeds(
        "SELECT brewery_id, partner_brewery_id, round(score, 9) AS name_similarity FROM flagged ORDER BY score DESC",
        KEYS_SQL,
        PAIRS_SQL,
    )
)
def review_by_similarity(spark, sf_dir):
    """The pending queue, most alike first."""
    queue = L.by_similarity(reviewed(spark, sf_dir))
    return queue.select("brewery_id", "partner_brewery_id", F.round("name_similarity", 9).alias("name_similarity"))
