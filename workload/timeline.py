"""Dated locations from the event stream: each day's last event type is where a user is."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from recordloom.operators import gold as G
from recordloom.operators import history as H
from recordloom.operators.numbering import best_per, number_rows, with_neighbours

from .frames import table
from .registry import query

DAILY_SQL = """
daily AS (
  SELECT user_id, day, event_type FROM (
    SELECT user_id, CAST(ts AS DATE) AS day, event_type,
           row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) WHERE rn = 1)"""

RUNS_SQL = """
calendar AS (
  SELECT day, row_number() OVER (ORDER BY day) AS spot, lead(day) OVER (ORDER BY day) AS next_day
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)),
marked AS (
  SELECT d.*, c.spot, c.next_day,
         CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND lag(spot) OVER w = spot - 1
              THEN 0 ELSE 1 END AS starts
  FROM daily d JOIN calendar c USING (day) WINDOW w AS (PARTITION BY user_id ORDER BY day)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY day) AS run FROM marked),
runs AS (
  SELECT user_id, min(event_type) AS event_type, min(day) AS valid_from,
         CAST(arg_max(coalesce(next_day, DATE '9999-12-31'), day) AS DATE) AS next_day
  FROM numbered GROUP BY user_id, run),
located AS (
  SELECT user_id, event_type, valid_from,
         CASE WHEN next_day < DATE '9999-12-31' THEN CAST(next_day - INTERVAL 1 DAY AS DATE) END AS valid_to,
         next_day = DATE '9999-12-31' AS is_current
  FROM runs)"""

# Event types double as addresses.
PLACES_SQL = """
place AS (
  SELECT row_number() OVER (ORDER BY event_type) AS address_id, event_type,
         event_type || ' Street' AS street_address, upper(event_type) AS city, 'S' AS state_province
  FROM (SELECT DISTINCT event_type FROM events)),
history AS (
  SELECT 'u' || l.user_id AS gold_id, 'User ' || l.user_id AS name, p.address_id, p.street_address,
         p.city, p.state_province, l.valid_from, l.valid_to, l.is_current
  FROM located l JOIN place p USING (event_type))"""


def with_history(body: str, *more: str) -> str:
    parts = (DAILY_SQL, RUNS_SQL, PLACES_SQL, *more)
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + body.strip()


def located(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("moment", F.struct("ts", "event_id"))
    return H.intervals(events, "user_id", "event_type", "ts", "moment")


def history_rows(spark, sf_dir):
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()
    places = number_rows(kinds, ["event_type"], "address_id").select(
        "address_id",
        "event_type",
        F.concat("event_type", F.lit(" Street")).alias("street_address"),
        F.upper("event_type").alias("city"),
        F.lit("S").alias("state_province"),
        F.lit(None).cast("string").alias("postal_code"),
        F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("decimal(10,6)").alias("latitude"),
        F.lit(None).cast("decimal(10,6)").alias("longitude"),
    )
    rows = located(spark, sf_dir).join(places.select("event_type", "address_id"), "event_type")
    locations = rows.select(
        F.concat(F.lit("u"), "user_id").alias("gold_id"),
        "address_id",
        "valid_from",
        "valid_to",
        "is_current",
        F.lit("first").alias("source_system"),
    )
    names = (
        table(spark, sf_dir, "events")
        .select("user_id")
        .distinct()
        .select(
            F.concat(F.lit("u"), "user_id").alias("gold_id"),
            F.concat(F.lit("User "), "user_id").alias("name"),
        )
    )
    return G.location_history(locations, places, names)


@query(with_history("SELECT user_id, event_type, valid_from, valid_to, is_current FROM located"))
def snapshot_intervals(spark, sf_dir):
    return located(spark, sf_dir)


@query(
    with_history(
        """SELECT user_id, day, event_type,
       lag(event_type) OVER w AS previous_event_type, lead(event_type) OVER w AS next_event_type,
       lag(day) OVER w AS previous_day, lead(day) OVER w AS next_day
FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY day)"""
    )
)
def neighbours(spark, sf_dir):
    daily = best_per(
        table(spark, sf_dir, "events").select(
            "user_id",
            F.to_date("ts").alias("day"),
            "event_type",
            (-F.unix_micros(F.col("ts").cast("timestamp"))).alias("back"),
            (-F.col("event_id")).alias("id"),
        ),
        ["user_id", "day"],
        ["back", "id"],
    )
    return with_neighbours(
        daily.select("user_id", "day", "event_type"), "user_id", "day", ["event_type", "day"]
    )


@query(
    with_history(
        """SELECT gold_id, name, address_id, street_address, city, state_province, valid_from, valid_to,
       is_current FROM history"""
    )
)
def location_history(spark, sf_dir):
    return history_rows(spark, sf_dir).select(
        "gold_id",
        "name",
        "address_id",
        "street_address",
        "city",
        "state_province",
        "valid_from",
        "valid_to",
        "is_current",
    )


# Small parts, so that documents of more than one part are compared.
HISTORY_PART, SUCCESSION_PART, RELOCATION_PART, REUSE_PART = 3, 50, 2, 40

DASH = "-"


def _entry(*values):
    """One text of all fields of a nested entry."""
    return F.concat_ws("|", *[F.coalesce(v.cast("string"), F.lit(DASH)) for v in values])


def _texts(array: str, *paths: str):
    def text(x):
        fields = []
        for path in paths:
            value = x
            for name in path.split("."):
                value = value[name]
            fields.append(F.coalesce(value.cast("string"), F.lit(DASH)))
        return F.concat_ws("|", *fields)

    return F.array_join(F.transform(array, text), ",")


ORDERED_SQL = """
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY gold_id ORDER BY valid_from, address_id) AS location_order,
         count(*) OVER (PARTITION BY gold_id) AS location_count
  FROM history)"""


@query(
    with_history(
        f"""SELECT gold_id, name, CAST((location_order - 1) // {HISTORY_PART} AS INTEGER) AS part,
       any_value(location_count) AS location_count,
       string_agg(concat_ws('|', street_address, city, state_province, '-', '-', '-', '-', valid_from,
                            coalesce(CAST(valid_to AS VARCHAR), '-'), is_current, 'first'), ',' ORDER BY location_order) AS locations
FROM ordered GROUP BY gold_id, name, (location_order - 1) // {HISTORY_PART}""",
        ORDERED_SQL,
    )
)
def history_documents(spark, sf_dir):
    documents = G.history_documents(history_rows(spark, sf_dir), HISTORY_PART)
    address = [f"address.{f}" for f in ("street", "city", "state", "postal_code", "country")]
    rest = ["location.latitude", "location.longitude", "valid_from", "valid_to", "is_current", "source_system"]
    return documents.select(
        "gold_id",
        "name",
        F.col("part").cast("int").alias("part"),
        "location_count",
        _texts("locations", *address, *rest).alias("locations"),
    )


@query(with_history("SELECT gold_id, name, address_id, valid_from, location_order FROM ordered", ORDERED_SQL))
def history_order(spark, sf_dir):
    return G.ranked_history(history_rows(spark, sf_dir)).select(
        "gold_id", "name", "address_id", "valid_from", "location_order"
    )


SUCCESSION_SQL = """
succession AS (
  SELECT address_id, gold_id, name, valid_from, valid_to, is_current, street_address, city, state_province,
         row_number() OVER (PARTITION BY address_id ORDER BY valid_from, gold_id) AS succession_order
  FROM history)"""


@query(with_history("SELECT * FROM succession", SUCCESSION_SQL))
def succession(spark, sf_dir):
    return G.succession(history_rows(spark, sf_dir)).drop("postal_code", "country", "latitude", "longitude")


@query(
    with_history(
        f"""SELECT address_id, 'addr_' || address_id AS public_id,
       concat_ws('|', any_value(street_address), any_value(city), any_value(state_province), '-', '-', '-', '-') AS address,
       CAST((succession_order - 1) // {SUCCESSION_PART} AS INTEGER) AS part,
       any_value(entity_count) AS entity_count,
       string_agg(concat_ws('|', gold_id, name, valid_from, coalesce(CAST(valid_to AS VARCHAR), '-'), is_current,
                            succession_order), ',' ORDER BY succession_order) AS entities
FROM succession JOIN (SELECT address_id, count(*) AS entity_count FROM succession GROUP BY 1) USING (address_id)
GROUP BY address_id, (succession_order - 1) // {SUCCESSION_PART}""",
        SUCCESSION_SQL,
    )
)
def succession_documents(spark, sf_dir):
    documents = G.succession_documents(G.succession(history_rows(spark, sf_dir)), SUCCESSION_PART)
    place = [F.col(f"address.{f}") for f in ("street", "city", "state", "postal_code", "country")]
    return documents.select(
        "address_id",
        "public_id",
        _entry(*place, F.col("coordinates.latitude"), F.col("coordinates.longitude")).alias("address"),
        F.col("part").cast("int").alias("part"),
        "entity_count",
        _texts("entities", "id", "name", "valid_from", "valid_to", "is_current", "succession_order").alias("entities"),
    )


@query(
    with_history(
        f"""SELECT gold_id, name, CAST((location_order - 1) // {RELOCATION_PART} AS INTEGER) AS part,
       any_value(location_count) AS location_count,
       string_agg(city || ', ' || state_province, ' → ' ORDER BY location_order) AS location_history
FROM (SELECT * EXCLUDE (location_count) FROM ordered)
JOIN (SELECT gold_id, count(DISTINCT address_id) AS location_count FROM history GROUP BY gold_id) USING (gold_id)
WHERE location_count > 1 GROUP BY gold_id, name, (location_order - 1) // {RELOCATION_PART}""",
        ORDERED_SQL,
    )
)
def relocations(spark, sf_dir):
    moved = G.relocations(history_rows(spark, sf_dir), part_entries=RELOCATION_PART)
    return moved.withColumn("part", F.col("part").cast("int"))


@query(
    with_history(
        f"""SELECT address_id, any_value(street_address) AS street_address, any_value(city) AS city,
       any_value(state_province) AS state_province,
       CAST((succession_order - 1) // {REUSE_PART} AS INTEGER) AS part, any_value(n) AS entity_count,
       string_agg(name, ' → ' ORDER BY succession_order) AS entity_succession
FROM succession JOIN (SELECT address_id, count(DISTINCT gold_id) AS n FROM succession GROUP BY 1) USING (address_id)
WHERE n > 1 GROUP BY address_id, (succession_order - 1) // {REUSE_PART}""",
        SUCCESSION_SQL,
    )
)
def address_reuse(spark, sf_dir):
    reused = G.by_use(G.reuse(G.succession(history_rows(spark, sf_dir)), part_entries=REUSE_PART))
    return reused.withColumn("part", F.col("part").cast("int"))


# Three snapshots: where users were seen last by the 12th, in the ten days after it, and in the
# rest of the events.  A user last seen with an error is nowhere, and may come back.
FIRST_DAY, SECOND_DAY, THIRD_DAY = dt.date(2024, 1, 12), dt.date(2024, 1, 22), dt.date(2024, 2, 1)


def _applied_sql(before: str, period: int, day: dt.date, name: str) -> str:
    """The state after a snapshot: what it confirms, closes and opens."""
    return f"""
seen_{name} AS (
  SELECT b.*, s.address_id AS now FROM {before} b
  LEFT JOIN (SELECT gold_id, address_id FROM snap WHERE period = {period}) s USING (gold_id)),
{name} AS (
  SELECT location_id, gold_id, address_id, valid_from,
         CASE WHEN is_current AND now IS DISTINCT FROM address_id THEN DATE '{day}' - 1 ELSE valid_to END AS valid_to,
         is_current AND now IS NOT DISTINCT FROM address_id AS is_current, source_system, match_confidence
  FROM seen_{name}
  UNION ALL
  SELECT (SELECT max(location_id) FROM {before}) + row_number() OVER (ORDER BY gold_id), gold_id, address_id,
         DATE '{day}', NULL, true, 'first', 1.0
  FROM snap WHERE period = {period}
   AND NOT EXISTS (FROM {before} b WHERE b.is_current AND b.gold_id = snap.gold_id AND b.address_id = snap.address_id))"""


SCD2_SQL = f"""
snap AS (
  SELECT period, 'u' || user_id AS gold_id, ascii(event_type) AS address_id FROM (
    SELECT *, row_number() OVER (PARTITION BY period, user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM (SELECT *, CASE WHEN ts < TIMESTAMP '{FIRST_DAY}' THEN 1
                         WHEN ts < TIMESTAMP '{SECOND_DAY}' THEN 2 ELSE 3 END AS period FROM events))
  WHERE rn = 1 AND event_type <> 'error'),
opened AS (
  SELECT row_number() OVER (ORDER BY gold_id) AS location_id, gold_id, address_id,
         DATE '{FIRST_DAY}' AS valid_from, CAST(NULL AS DATE) AS valid_to, true AS is_current,
         'first' AS source_system, CAST(1.0 AS DOUBLE) AS match_confidence
  FROM snap WHERE period = 1),""" + ",".join(
    [_applied_sql("opened", 2, SECOND_DAY, "second"), _applied_sql("second", 3, THIRD_DAY, "third")]
)


def _snapshot(spark, sf_dir, low, high):
    events = table(spark, sf_dir, "events")
    if low is not None:
        events = events.filter(F.col("ts") >= F.lit(low).cast("timestamp_ntz"))
    if high is not None:
        events = events.filter(F.col("ts") < F.lit(high).cast("timestamp_ntz"))
    last = events.groupBy("user_id").agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type")
    )
    return last.filter("event_type <> 'error'").select(
        F.concat(F.lit("u"), "user_id").alias("gold_id"),
        F.ascii("event_type").alias("address_id"),
        F.lit("first").alias("source_system"),
        F.lit(1.0).alias("match_confidence"),
    )


def first_load(spark, sf_dir):
    return H.scd2_initial(_snapshot(spark, sf_dir, None, FIRST_DAY), FIRST_DAY)


@query("WITH " + SCD2_SQL.strip() + "\nSELECT * FROM opened")
def scd2_initial(spark, sf_dir):
    return first_load(spark, sf_dir)


@query("WITH " + SCD2_SQL.strip() + "\nSELECT * FROM third")
def scd2_update(spark, sf_dir):
    second = _snapshot(spark, sf_dir, FIRST_DAY, SECOND_DAY)
    state = H.scd2_apply(first_load(spark, sf_dir), second, SECOND_DAY)
    return H.scd2_apply(state, _snapshot(spark, sf_dir, SECOND_DAY, None), THIRD_DAY)
