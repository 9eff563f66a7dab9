"""What several operators share: words, free column names, row keys, the query registry."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of anything but ASCII white space, as a regular expression of Java and RE2.
WORD = r"[^\x20\x09-\x0D]+"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL to compare it with."""

    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if oracle is not None:
            ORACLES[run.__name__] = dedent(oracle).strip()
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores in front as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free


def n_words(text: Column | str) -> Column:
    """Number of words, 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(id_col: str, *columns: str) -> Column:
    """A hash that tells rows of one id apart by their content; equal rows share it."""
    return F.xxhash64(F.col(id_col), *[F.col(c) for c in columns])


def word_spans(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, and where they start and end in the words joined by one space."""
    words = data.split()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    return words, ends - lengths, ends
