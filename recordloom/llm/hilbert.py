"""Shards cut from a Hilbert curve over document metadata.

Each dimension is quantised to ``bits`` bits: a text column by the rank of its value among
the distinct values, a number by its logarithm.  Rows are sorted by their place on the curve
(then by the tie columns), numbered, and cut in runs, so a shard holds a compact region of all
dimensions and min/max statistics prune files on any of them.

The law is ``rows``: counts of shards are at most one apart.

Defined cases: a null value is a value of its own (last for texts, below 0 for numbers);
repeated rows are rows like others; rows that tie in curve place and tie columns are
interchangeable; no rows give no rows; further columns are carried along.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..session import stage
from .common import free_names

BITS = 10


def curve_index(coordinates: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of points; ``coordinates`` has a row per dimension.

    J. Skilling, "Programming the Hilbert curve" (2004), on whole columns at a time.
    """
    x = coordinates.astype(np.int64).copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            swap = np.where(x[i] & q, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(x[i] & q, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


def _index_udf(bits: int):
    def run(*columns: pd.Series) -> pd.Series:
        return pd.Series(curve_index(np.stack([c.to_numpy(np.int64) for c in columns]), bits))

    return F.pandas_udf(run, "long")


def number_code(value: Column, bits: int) -> Column:
    """Logarithmic step of a number of at most 2**62; 0 for null and what is below 1."""
    steps = F.floor(F.log2(value.cast("double")) * F.lit((1 << bits) / 62.0)).cast("int") + 1
    return F.when(value >= 1, F.least(steps, F.lit((1 << bits) - 1))).otherwise(F.lit(0))


def with_rank_code(df: DataFrame, column: str, name: str, bits: int) -> DataFrame:
    """Add the rank of ``column`` among its distinct values, scaled to ``bits`` bits."""
    value, rank = free_names(df, "value", "rank")
    values = stage(df.select(F.col(column).cast("string").alias(value)).distinct(), "curve-values")
    ranked = stage(
        number_rows(values, [F.col(value).isNull(), F.coalesce(value, F.lit(""))], rank), "curve-ranks"
    )
    count = values.count()
    ranked = ranked.select(
        value, F.floor((F.col(rank) - 1) * F.lit(1 << bits) / F.lit(max(count, 1))).cast("int").alias(name)
    )
    return df.join(ranked, df[column].cast("string").eqNullSafe(ranked[value])).drop(value)


def curve_shards(
    df: DataFrame,
    texts: list[str],
    numbers: list[str],
    ties: list[str],
    shards: int = 16,
    bits: int = BITS,
) -> DataFrame:
    """``df`` with ``curve`` (place on the curve), ``shard`` and ``slot`` (place in the shard)."""
    codes = free_names(df, *[f"code{i}" for i in range(len(texts) + len(numbers))])
    placed = df
    for column, code in zip(texts, codes):
        placed = with_rank_code(placed, column, code, bits)
    for column, code in zip(numbers, codes[len(texts) :]):
        placed = placed.withColumn(code, number_code(F.col(column), bits))
    placed = placed.withColumn("curve", _index_udf(bits)(*codes)).drop(*codes)
    (number,) = free_names(placed, "number")
    numbered = number_rows(placed, ["curve", *ties], number)
    rows = max(df.count(), 1)
    # Shard s takes the numbers from ceil(s * rows / shards) on, in integers.
    shard = F.expr(f"({number} - 1) * {shards}L div {rows}L")
    start = F.expr(f"(shard * {rows}L + {shards - 1}L) div {shards}L")
    numbered = numbered.withColumn("shard", shard.cast("int"))
    slot = F.col(number) - 1 - start
    return numbered.withColumn("slot", slot).drop(number)


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Write ``curve_shards(df, ...)`` as one folder of Parquet files per shard, in curve order."""
    (
        curve_shards(df, **options)
        .repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
