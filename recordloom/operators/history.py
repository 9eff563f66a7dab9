"""Dated locations: first load, updates, and backfill from snapshots.

Intervals are inclusive: a location ends the day before the next one starts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import stage
from .lasting import resolved
from .merge import Sources
from .numbering import best_per, number_rows
from .shape import stack

LOCATION_COLUMNS = (
    "gold_id",
    "address_id",
    "valid_from",
    "valid_to",
    "is_current",
    "source_system",
    "match_confidence",
)


def current_locations(
    mapping: DataFrame, members: DataFrame, left_id: str, right_id: str, sources: Sources
) -> DataFrame:
    """(gold_id, address_id, source_system, match_confidence) of one run.

    An entity is at its left row's address, else at its right row's.
    """
    places = stack(
        *[
            mapping.select(
                "gold_id",
                F.lit(label).alias("source_system"),
                F.col(own).cast("string").alias("source_id"),
                F.lit(rank).alias("rank"),
            ).filter(C.present("source_id"))
            for rank, (label, own) in enumerate(
                ((sources.left, left_id), (sources.right, right_id))
            )
        ]
    )
    found = places.join(members, ["source_system", "source_id"])
    chosen = best_per(found.select("gold_id", "rank", "address_id"), ["gold_id"], ["rank", "address_id"])
    facts = mapping.select(
        "gold_id",
        C.source_flag(left_id, right_id, sources.left, sources.right).alias("source_system"),
        C.prefer("match_confidence", F.lit(1.0)).alias("match_confidence"),
    )
    return chosen.join(facts, "gold_id").select(
        "gold_id", "address_id", "source_system", "match_confidence"
    )


def scd2_initial(locations: DataFrame, as_of: dt.date) -> DataFrame:
    """Every location opens on ``as_of`` and is current; ids follow the gold id."""
    opened = locations.select(
        "gold_id",
        "address_id",
        F.lit(as_of).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        "source_system",
        "match_confidence",
    )
    return number_rows(opened, ["gold_id"], "location_id").select("location_id", *LOCATION_COLUMNS)


def scd2_apply(
    history: DataFrame, snapshot: DataFrame, as_of: dt.date, roots: DataFrame | None = None
) -> DataFrame:
    """History after a new snapshot of ``current_locations``.

    Address ids must last over runs.  ``roots`` holds (id, root) for ids that gave way to others
    since (``IdRegistry.roots``): who is at such an address has not moved, and its open
    row goes on under the id that is left.  Closed rows keep the ids they were written with.

    Gone entities close, moved ones close and open, new and returning ones open,
    the rest stays.  Closed rows pass through without a shuffle; the others meet in
    one full join.  A row opened on ``as_of`` itself is replaced rather than closed.
    A repeated entity in the snapshot counts once, at its lowest address id.
    """
    closed = history.filter(~F.col("is_current"))
    still_open = history.filter("is_current")
    if roots is not None:
        still_open = resolved(still_open, roots, "address_id")
        snapshot = resolved(snapshot, roots, "address_id")
    open_ = still_open.select(
        "gold_id", F.struct("location_id", *LOCATION_COLUMNS[1:]).alias("old")
    )
    incoming = best_per(
        snapshot.select("gold_id", "address_id", "source_system", "match_confidence"),
        ["gold_id"],
        ["address_id"],
    ).select("gold_id", F.struct("address_id", "source_system", "match_confidence").alias("new"))

    day = F.lit(as_of)
    stays = F.col("old.address_id") == F.col("new.address_id")
    kept = F.col("old").isNotNull() & F.coalesce(stays, F.lit(False))
    ended = F.col("old").isNotNull() & ~kept & (F.col("old.valid_from") < day)
    opened = F.col("new").isNotNull() & ~kept

    def row(condition, location_id, start, end, current, side):
        return F.when(
            condition,
            F.struct(
                location_id.cast("long").alias("location_id"),
                F.col(f"{side}.address_id").alias("address_id"),
                start.alias("valid_from"),
                end.cast("date").alias("valid_to"),
                F.lit(current).alias("is_current"),
                F.col(f"{side}.source_system").alias("source_system"),
                F.col(f"{side}.match_confidence").alias("match_confidence"),
            ),
        )

    none = F.lit(None)
    old_id, old_start = F.col("old.location_id"), F.col("old.valid_from")
    rows = F.array(
        row(kept, old_id, old_start, none, True, "old"),
        row(ended, old_id, old_start, F.date_sub(day, 1), False, "old"),
        row(opened, none, day, none, True, "new"),
    )
    changed = stage(
        open_.join(incoming, "gold_id", "full")
        .select("gold_id", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("_row"))
        .select("gold_id", "_row.*"),
        "scd2",
    )
    columns = ["location_id", *LOCATION_COLUMNS]
    fresh = number_rows(
        changed.filter("location_id IS NULL").drop("location_id"), ["gold_id"], "_number"
    )
    highest = history.agg(F.coalesce(F.max("location_id"), F.lit(0))).scalar()
    return stack(
        closed.select(*columns),
        changed.filter("location_id IS NOT NULL").select(*columns),
        fresh.withColumn("location_id", F.col("_number") + highest).select(*columns),
    )


def intervals(
    snapshots: DataFrame, key: str, value: str, date: str, order: str | None = None
) -> DataFrame:
    """(key, value, valid_from, valid_to, is_current) from dated snapshots.

    An interval is a run of consecutive snapshots that show the key at one value; it
    ends the day before the next snapshot, so closures, gaps, reopenings and moves
    all appear.  ``valid_to`` is NULL for a run that reaches the last snapshot.  If a
    snapshot shows a key twice, the last row by ``order`` (else the least value) counts.

    One row per key and date remains before the window, so a key's group is bounded
    by the number of snapshot dates.  So is the calendar, one row per distinct DATE,
    which is what permits the window over it.
    """
    day = F.to_date(date)
    pick = F.max_by(value, order) if order else F.min(value)
    seen = snapshots.groupBy(F.col(key), day.alias("_day")).agg(pick.alias(value))
    in_order = Window.orderBy("_day")
    calendar = (
        snapshots.select(day.alias("_day"))
        .distinct()
        .select(
            "_day",
            F.row_number().over(in_order).alias("_at"),
            F.lead("_day").over(in_order).alias("_next_day"),
        )
    )
    per_key = Window.partitionBy(key).orderBy("_day")
    before_value, before_at = F.lag(value).over(per_key), F.lag("_at").over(per_key)
    starts = ~(before_value.eqNullSafe(F.col(value)) & (before_at == F.col("_at") - 1))
    starts = F.coalesce(starts, F.lit(True))
    runs = (
        seen.join(calendar, "_day")
        .withColumn("_starts", starts.cast("int"))
        .withColumn("_run", F.sum("_starts").over(per_key))
    )
    ended = F.date_sub(F.max_by("_next_day", "_day"), 1)
    return (
        runs.groupBy(key, "_run")
        .agg(
            F.first(value).alias(value),
            F.min("_day").alias("valid_from"),
            ended.alias("valid_to"),
        )
        .withColumn("is_current", F.col("valid_to").isNull())
        .drop("_run")
    )
