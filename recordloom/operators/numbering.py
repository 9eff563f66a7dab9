"""Row numbers, ranks within groups, and paging, without a one-partition window."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_column
from ..session import stage

_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these

MAX_PER_PAGE = 100


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str = "row_number") -> DataFrame:
    """Consecutive bigint numbers from 1 in ``order``, which should identify rows.

    Range partitioning puts the order across partitions, a sort puts it inside
    them.  The placed rows are staged, since sampled range bounds may differ when
    recomputed; then each partition adds the row count of those before it.  The
    offsets have one row per partition, which bounds both the window over them and
    their broadcast.  Every column of ``df`` is written with the number; where a unique
    key can fetch them afterwards, number the keys alone, as ``page`` does.
    """
    order = [as_column(o) for o in order]
    placed = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_part", F.shiftright("_place", _POSITION_BITS))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1).cast("long"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + position + 1)
        .drop("_part", "_place", "_before")
    )


def _ranked_runs(keys: int):
    """Number the rows of every run of equal keys in a sorted partition, batch after batch.

    The first ``keys`` columns are the keys.  Adds the rank in the run and whether the
    run is the partition's first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rank, first = None, 0, True
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            starts = np.zeros(n, bool)
            for column in batch.columns[:keys]:
                codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
                starts[1:] |= codes[1:] != codes[:-1]
            head = [c[0].as_py() for c in batch.columns[:keys]]
            starts[0] = head != last
            at = np.arange(n)
            begun = np.maximum.accumulate(np.where(starts, at, -1))
            ranks = np.where(begun >= 0, at - begun + 1, rank + at + 1)
            if last is not None and starts[0]:
                first = False
            seen = np.cumsum(starts) - int(starts[0])
            in_first = (seen == 0) & first
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ranks, pa.int64()), pa.array(in_first)],
                names=[*batch.schema.names, "_rank_in_run", "_first_run"],
            )
            last, rank = [c[n - 1].as_py() for c in batch.columns[:keys]], int(ranks[-1])
            first = bool(in_first[-1])

    return run


def rank_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str
) -> DataFrame:
    """``row_number`` per group of ``keys``; a group may span many tasks.

    Rows are range-partitioned and sorted by (keys, order), so a group is a run, and
    each partition numbers its runs on its own.  Only the run that comes over from
    earlier partitions needs their row count: one row per partition, which bounds the
    windows and the broadcast.  No row is shuffled by its group.
    """
    keys, columns = list(keys), df.columns
    by = [*[F.col(k) for k in keys], *[as_column(o) for o in order]]
    rest = [c for c in columns if c not in keys]
    sorted_rows = df.repartitionByRange(*by).sortWithinPartitions(*by).select(*keys, *rest)
    schema = T.StructType(
        [*sorted_rows.schema, T.StructField("_rank_in_run", T.LongType()), T.StructField("_first_run", T.BooleanType())]
    )
    placed = stage(
        sorted_rows.mapInArrow(_ranked_runs(len(keys)), schema).withColumn(
            "_place", F.monotonically_increasing_id()
        ),
        "ranked",
    ).withColumn("_part", F.shiftright("_place", _POSITION_BITS))
    group = F.struct(*keys)
    ends = placed.groupBy("_part").agg(
        F.min_by(group, "_place").alias("_first"),
        F.max_by(group, "_place").alias("_last"),
        F.max_by("_rank_in_run", "_place").alias("_rows"),
    )
    # A group that reaches a partition from earlier ones is the last run of each of those.
    ending = ends.select(F.col("_last").alias("_group"), "_part", "_rows", F.lit(True).alias("_ends"))
    beginning = ends.select(F.col("_first").alias("_group"), "_part", F.lit(0).alias("_rows"), F.lit(False).alias("_ends"))
    before = Window.partitionBy("_group").orderBy("_part").rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        ending.unionByName(beginning)
        .withColumn("_carried", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .filter(~F.col("_ends"))
        .select("_part", "_carried")
    )
    rank = F.col("_rank_in_run") + F.when(F.col("_first_run"), F.col("_carried")).otherwise(F.lit(0))
    return placed.join(F.broadcast(carried), "_part").select(*columns, rank.alias(name))


def succession_order(df: DataFrame, key: str, start: str, tie: str) -> DataFrame:
    return rank_within(df, [key], [start, tie], "succession_order")


def with_neighbours(
    df: DataFrame, key: str, order: str, columns: Sequence[str]
) -> DataFrame:
    """Add ``previous_*`` and ``next_*`` of each column along ``order`` per key.

    For groups the caller has bounded, such as one row per entity and snapshot date.
    """
    window = Window.partitionBy(key).orderBy(order)
    return df.withColumns(
        {f"previous_{c}": F.lag(c).over(window) for c in columns}
        | {f"next_{c}": F.lead(c).over(window) for c in columns}
    )


def best_per(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """The first row per group by ascending ``order`` (negate a number to descend).

    A minimum over structs, so tasks reduce their rows before the shuffle and a hot
    group is never gathered.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(
        *[as_column(o).alias(f"_o{i}") for i, o in enumerate(order)],
        F.struct(*rest).alias("_row"),
    )
    return (
        df.groupBy(*keys).agg(F.min(ranked).alias("_best")).select(*keys, "_best._row.*")
    )


def seen_range(df: DataFrame, keys: Sequence[str], timestamp: str) -> DataFrame:
    """First and last time each key was seen."""
    return df.groupBy(*keys).agg(
        F.min(timestamp).alias("first_seen"), F.max(timestamp).alias("last_seen")
    )


def newest(df: DataFrame, timestamp: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(timestamp)).limit(max(1, int(n)))


def top(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


@dataclass(frozen=True)
class Page:
    rows: DataFrame
    totals: DataFrame  # one row: page, per_page, total, total_pages


def page(df: DataFrame, key: str, page: int = 1, per_page: int = 50) -> Page:
    """One page in order of a unique key; past the end it is empty.

    Only the keys are numbered, wherever the page lies; the page's keys, at most
    ``MAX_PER_PAGE``, then pick their rows.
    """
    if not 1 <= per_page <= MAX_PER_PAGE:
        raise ValueError(f"per_page must be between 1 and {MAX_PER_PAGE}")
    if page < 1:
        raise ValueError("page must be at least 1")
    skip = (page - 1) * per_page
    numbered = number_rows(df.select(F.col(key).alias("_key")), ["_key"], "_number")
    wanted = numbered.filter(F.col("_number").between(skip + 1, skip + per_page)).select("_key")
    rows = df.join(F.broadcast(wanted), df[key].eqNullSafe(wanted["_key"])).drop("_key").orderBy(key)
    total = F.count(F.lit(1))
    totals = df.agg(
        F.lit(page).alias("page"),
        F.lit(per_page).alias("per_page"),
        total.alias("total"),
        F.ceil(total / per_page).alias("total_pages"),
    )
    return Page(rows, totals)


def page_after(df: DataFrame, key: str, cursor: object, n: int) -> DataFrame:
    """The ``n`` rows after ``cursor`` in key order; ``None`` starts from the beginning."""
    if cursor is not None:
        df = df.filter(F.col(key) > F.lit(cursor))
    return df.orderBy(key).limit(n)
