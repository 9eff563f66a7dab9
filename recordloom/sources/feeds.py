"""Reading feeds: delimited text, JSON records, and landed snapshots."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import CheckError
from ..session import path_exists

# The words a feed uses for a missing value.
NA_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def _files_by_header(text: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """The files of a feed by their header line; one file needs no look at it.

    The line is the first of the block at the start of the file; what reaches the driver
    is one line per file.
    """
    first = (
        text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
        .filter("block = 0")
        .groupBy("file")
        .agg(F.min_by("value", "at").alias("header"))
    )
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in first.collect():
        names = next(csv.reader([row["header"].lstrip("\ufeff").rstrip("\r")]), [])
        groups.setdefault(tuple(names), []).append(unquote(row["file"]))
    return groups


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    na_values: Sequence[str] = NA_WORDS,
    embedded_newlines: bool = True,
    context: str = "delimited feed",
) -> DataFrame:
    """Header, quoted fields with doubled quotes; columns are matched by header name.

    The files of a folder may order their columns differently: files of one header are
    read together, and the groups are matched by name.  Values are read as text,
    missing-value words become NULL, and the rest is cast to the pinned type; text that
    is no number becomes NULL.  Quoted newlines keep a file in one task, so turn them
    off for large files without them.
    """
    reader = spark.read.options(
        header=True, multiLine=embedded_newlines, quote='"', escape='"', mode="FAILFAST", enforceSchema=False
    )

    def typed(field: T.StructField):
        text = F.col(f"`{field.name}`")
        known = F.when(~text.isin(list(na_values)), text)
        return known.try_cast(field.dataType).alias(field.name)

    def part(files) -> DataFrame:
        raw = reader.csv(files)
        missing = [f.name for f in schema if f.name not in raw.columns]
        if missing:
            raise CheckError(f"{context}: missing required columns {missing}")
        return raw.select(*[typed(f) for f in schema])

    lines = spark.read.text(path)
    if len(lines.inputFiles()) < 2:
        return part(path)
    groups = _files_by_header(lines)
    return reduce(DataFrame.unionByName, [part(groups[names]) for names in sorted(groups)])


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True
) -> DataFrame:
    """An array of records per file (or one record per line), nested objects as structs.

    Files that are one array cannot be split; rewrite a large one to a table once.
    """
    return spark.read.schema(schema).options(multiLine=multiline, mode="FAILFAST").json(path)


def read_or_land(
    spark: SparkSession, landed: str, schema: T.StructType, source: Callable[[], DataFrame]
) -> DataFrame:
    """The landed copy if there is one, else the source, landed first.

    A copy that cannot be read is an error, not a reason to load again.
    """
    if not path_exists(spark, landed):
        source().select(*schema.names).write.option("ignoreNullFields", False).json(landed)
    elif not path_exists(spark, f"{landed}/_SUCCESS"):
        raise CheckError(f"landed copy at {landed} is incomplete")
    return read_json_records(spark, landed, schema, multiline=False)
