"""Join shapes that need more than a plain equi-join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import METRES_PER_MILE, Grid, bounding_box, haversine_m
from ..session import stage

# Default of ``chunk_rows``: rows of one hot key that meet in one task, per side.
CHUNK_ROWS = 8192


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` for a join that never sends it to every task, whatever the size of its files.

    Spark takes the bytes of a table's files for its size.  Links repeat their ids, so millions of
    them are a few compressed megabytes, and a broadcast would build them up in the driver.
    """
    return df.hint("merge")


def anti_not_in(
    left: DataFrame,
    left_key: str,
    right: DataFrame,
    right_key: str | None = None,
    assume_non_null: bool = False,
) -> DataFrame:
    """``left WHERE left_key NOT IN (SELECT right_key FROM right)`` as a shuffled anti join.

    Spark's own plan for NOT IN broadcasts the list whatever its size.  Here the
    NULL rules come from two counts, read as scalar subqueries: an empty list keeps
    every row, a list holding NULL keeps none, any other list drops NULL keys.
    The list is shuffled once per key, however often it names it.
    """
    right_key = right_key or left_key
    listed = right.select(F.col(right_key).alias("_listed"))
    if not assume_non_null:
        rows = listed.agg(F.count(F.lit(1))).scalar()
        known = listed.agg(F.count("_listed")).scalar()
        left = left.filter(
            (rows == 0) | ((rows == known) & F.col(left_key).isNotNull())
        )
    return left.join(by_shuffle(listed.distinct()), left[left_key] == F.col("_listed"), "left_anti")


def spread_left_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: str
) -> DataFrame:
    """Left join on a key that is often NULL on the left and unique on the right.

    Rows without a key would all hash to one partition; a second key, constant for
    real keys, scatters them.  ``right_key`` is dropped from the result.
    """
    salt = F.when(F.col(left_key).isNull(), F.xxhash64(spread_by)).otherwise(F.lit(0))
    a = left.withColumn("_salt", salt)
    b = right.withColumnRenamed(right_key, "_right_key").withColumn(
        "_right_salt", F.lit(0).cast("long")
    )
    joined = a.join(
        b, (a[left_key] == b["_right_key"]) & (a["_salt"] == b["_right_salt"]), "left"
    )
    return joined.drop("_salt", "_right_key", "_right_salt")


def hot_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Keys with more than ``chunk_rows`` rows on a side: (keys, _left_chunks, _right_chunks).

    Staged, so Spark knows its size and broadcasts it only if it is small; a frame of
    N rows has at most N / ``chunk_rows`` hot keys.
    """
    keys = list(keys)
    sizes = (
        left.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_left_rows"))
        .join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_right_rows")), keys)
    )
    return stage(
        sizes.filter(
            (F.col("_left_rows") > chunk_rows) | (F.col("_right_rows") > chunk_rows)
        ).select(
            *keys,
            F.ceil(F.col("_left_rows") / chunk_rows).alias("_left_chunks"),
            F.ceil(F.col("_right_rows") / chunk_rows).alias("_right_chunks"),
        ),
        "hot-keys",
    )


def split_hot_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_left: Column,
    spread_right: Column,
    chunk_rows: int = CHUNK_ROWS,
    hot: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Prepare two frames for a join whose work per key is rows times rows.

    A key with more than ``chunk_rows`` rows on a side is cut into chunks, and each
    chunk meets every chunk of the other side in a task of its own.  Other keys keep
    one copy.  Returns both frames and the columns to join on.  ``chunk_rows`` shapes
    the plan only; the pairs are the same at any value.  ``hot`` is the result of
    ``hot_keys``, if the caller has it.
    """
    keys = list(keys)
    if hot is None:
        hot = hot_keys(left, right, keys, chunk_rows)

    def chunked(df: DataFrame, own: str, other: str, spread: Column) -> DataFrame:
        mine = F.coalesce(F.col(f"_{own}_chunks"), F.lit(1))
        theirs = F.coalesce(F.col(f"_{other}_chunks"), F.lit(1))
        return (
            df.join(hot, keys, "left")
            .withColumn(f"_{own}_chunk", F.pmod(F.xxhash64(spread), mine))
            .withColumn(f"_{other}_chunk", F.explode(F.sequence(F.lit(0).cast("long"), theirs - 1)))
            .drop("_left_chunks", "_right_chunks")
        )

    return (
        chunked(left, "left", "right", spread_left),
        chunked(right, "right", "left", spread_right),
        [*keys, "_left_chunk", "_right_chunk"],
    )


def through_bridge(
    left: DataFrame, bridge: DataFrame, right: DataFrame, left_id: str, right_id: str
) -> DataFrame:
    """Inner join to the bridge, then left join to the far side."""
    return left.join(by_shuffle(bridge), left_id).join(right, right_id, "left")


def pairs_within(
    left: DataFrame,
    right: DataFrame,
    metres: float,
    left_id: str,
    right_id: str,
    lat: str = "latitude",
    lon: str = "longitude",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Pairs at most ``metres`` apart: (left_id, right_id, distance_m).

    The right side sits in one grid cell, the left side visits the cells its circle
    can touch, so each pair meets once in an equi-join.
    """
    grid = Grid(metres)
    located = lambda df: df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    a = located(left).select(
        F.col(left_id).alias("_left"),
        F.col(lat).alias("_lat_a"),
        F.col(lon).alias("_lon_a"),
        F.explode(grid.cells_within(lat, lon, metres)).alias("_cell"),
    )
    b = located(right).select(
        F.col(right_id).alias("_right"),
        F.col(lat).alias("_lat_b"),
        F.col(lon).alias("_lon_b"),
        grid.cell(lat, lon).alias("_cell"),
    )
    flat = lambda df: df.select("*", "_cell.row", "_cell.column").drop("_cell")
    a, b, keys = split_hot_keys(
        flat(a), flat(b), ["row", "column"], F.col("_left"), F.col("_right"), chunk_rows
    )
    distance = haversine_m("_lat_a", "_lon_a", "_lat_b", "_lon_b")
    return (
        a.join(b, keys)
        .withColumn("distance_m", distance)
        .filter(F.col("distance_m") <= metres)
        .select(
            F.col("_left").alias(left_id), F.col("_right").alias(right_id), "distance_m"
        )
    )


def within_radius(
    df: DataFrame,
    latitude: float,
    longitude: float,
    miles: float = 10,
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Rows within ``miles`` of a point; plain bounds on the columns reach the scan first."""
    metres = miles * METRES_PER_MILE
    distance = haversine_m(lat, lon, F.lit(latitude), F.lit(longitude))
    return df.filter(bounding_box(lat, lon, (latitude, longitude), metres)).filter(
        distance <= metres
    )
