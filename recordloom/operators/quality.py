"""Feed checks, profiles, and declarative data tests.

A data test is a frame of failing rows.  ``run_suite`` counts them all in one job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_column, is_true, open_end
from .addresses import near_duplicates
from .shape import stack


class CheckError(ValueError):
    """A feed or a data test did not pass."""


# --- feed checks ------------------------------------------------------------


# The messages of failed feed checks, as the run log has them.
NO_ROWS = "{context}: no rows returned"
NO_COLUMNS = "{context}: missing required columns {columns}"
ALL_NULL = "{context}: columns entirely null {columns}"


@dataclass(frozen=True)
class FeedChecks:
    """What must hold for a feed, and the null rates to record.

    Columns are looked at in the schema; everything else follows from one row of counts
    (``measures``), taken while the feed is written or, by ``run``, in a pass of its own.
    Columns that the feed lacks are not counted.
    """

    context: str
    required: Sequence[str] = ()
    some_known: Sequence[str] = ()
    rates: Sequence[str] = ()

    def _counted(self, df: DataFrame) -> list[str]:
        return [c for c in dict.fromkeys([*self.some_known, *self.rates]) if c in df.columns]

    def measures(self, df: DataFrame) -> dict[str, Column]:
        """The counts to take of ``df``; fails at once if required columns are absent."""
        absent = [c for c in self.required if c not in df.columns]
        if absent:
            raise CheckError(NO_COLUMNS.format(context=self.context, columns=absent))
        return {f"known_{c}": F.count(known_value(df, c)) for c in self._counted(df)}

    def judge(self, seen: Mapping[str, int]) -> None:
        if not seen["rows"]:
            raise CheckError(NO_ROWS.format(context=self.context))
        empty = [c for c in self.some_known if seen.get(f"known_{c}") == 0]
        if empty:
            raise CheckError(ALL_NULL.format(context=self.context, columns=empty))

    def summary(self, seen: Mapping[str, int]) -> dict[str, float]:
        """``{null_pct_<column>: rate}`` of the columns that were counted; 0.0 without rows."""
        rows = seen["rows"]
        counted = [c for c in self.rates if f"known_{c}" in seen]
        return {f"null_pct_{c}": rate(rows - seen[f"known_{c}"], rows) if rows else 0.0 for c in counted}

    def run(self, df: DataFrame) -> dict[str, float]:
        """All checks in one pass; returns the null rates."""
        seen = df.agg(F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in self.measures(df).items()]).first()
        self.judge(seen.asDict())
        return self.summary(seen.asDict())


def known_value(df: DataFrame, column: str) -> Column:
    """The column with NaN counted as missing."""
    if dict(df.dtypes).get(column) in ("double", "float"):
        return F.when(~F.isnan(column), F.col(column))
    return F.col(column)


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, nulls, total) in one pass; absent columns are left out."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column_name string, nulls long, total long")
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count(known_value(df, c)).alias(f"_known_{i}") for i, c in enumerate(present)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                (F.col("_total") - F.col(f"_known_{i}")).alias("nulls"),
                F.col("_total").alias("total"),
            )
            for i, c in enumerate(present)
        ]
    )
    return counted.select(F.inline(entries))


def null_rates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, null_pct) rounded half to even at four places."""
    rate = F.bround(F.col("nulls") / F.col("total"), 4)
    return null_counts(df, columns).select(
        "column_name", F.when(F.col("total") > 0, rate).otherwise(F.lit(0.0)).alias("null_pct")
    )


def rate(part: int, whole: int) -> float:
    """Share rounded to four places, ties to even."""
    return float(np.round(part / whole, 4))


def profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, non_null, total), one row per column."""
    types = dict(df.dtypes)
    names = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return null_counts(df, df.columns).select(
        "column_name",
        F.element_at(names, F.col("column_name")).alias("data_type"),
        (F.col("total") - F.col("nulls")).alias("non_null"),
        "total",
    )


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Some ``n`` rows as they come, to look at."""
    return df.limit(n)


def look(df: DataFrame, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """A feed's profile and its first rows."""
    return profile(df), first_rows(df, n)


# --- data tests: frames of failures ------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is no value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with their counts; NULL passes."""
    return (
        df.filter(~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    keys = parent.select(F.col(parent_column).alias("_parent"))
    known = child.filter(F.col(column).isNotNull())
    return known.join(keys, known[column] == F.col("_parent"), "left_anti")


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    """Rows where the expression is false; unknown passes."""
    condition = F.expr(expression) if isinstance(expression, str) else expression
    return df.filter(~condition)


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def ordered_dates(locations: DataFrame) -> DataFrame:
    return expression_is_true(locations, F.col("valid_from") <= open_end("valid_to"))


def single_current(locations: DataFrame, key: str = "gold_id") -> DataFrame:
    """Entities with more than one current location."""
    return unique(locations.filter(is_true("is_current")), key)


def no_near_duplicates(dim: DataFrame, metres: float = 50, threshold: float = 0.90) -> DataFrame:
    return near_duplicates(dim, metres, threshold)


def core_tests(identities: DataFrame, locations: DataFrame, addresses: DataFrame) -> list[DataTest]:
    """What must hold between the core tables: keys, references, one current place, no leftovers."""
    return [
        DataTest("gold_id_unique", unique(identities, "gold_id")),
        DataTest("location_id_unique", unique(locations, "location_id")),
        DataTest("address_id_unique", unique(addresses, "address_id")),
        DataTest("location_has_identity", relationships(locations, "gold_id", identities, "gold_id")),
        DataTest("location_has_address", relationships(locations, "address_id", addresses, "address_id")),
        DataTest("one_start_per_entity", unique_combination(locations, ["gold_id", "valid_from"])),
        DataTest("dates_in_order", ordered_dates(locations)),
        DataTest("one_current_location", single_current(locations)),
        DataTest("no_near_duplicates", no_near_duplicates(addresses)),
    ]


def mapping_complete(sources: Mapping[str, DataFrame], mapping: DataFrame) -> DataFrame:
    """Source ids (by id column) that the mapping lacks."""
    parts = [
        relationships(df.select(own), own, mapping, own).select(
            F.lit(own).alias("id_column"), F.col(own).cast("string").alias("id")
        )
        for own, df in sources.items()
    ]
    return stack(*parts)


def review_ids_valid(queue: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Queue ids (by id column) that their feed lacks."""
    parts = [
        relationships(queue.select(own), own, df, own).select(
            F.lit(own).alias("id_column"), F.col(own).cast("string").alias("id")
        )
        for own, df in sources.items()
    ]
    return stack(*parts)


def freshness(
    df: DataFrame,
    timestamp: str,
    now: dt.datetime,
    warn: dt.timedelta = dt.timedelta(days=2),
    error: dt.timedelta = dt.timedelta(days=3),
) -> DataFrame:
    """(newest, status): pass, warn or error by the age of the newest row; none is an error."""
    newest = F.col("newest")
    return df.agg(F.max(timestamp).alias("newest")).select(
        "newest",
        F.when(newest.isNull() | (newest < F.lit(now - error)), "error")
        .when(newest < F.lit(now - warn), "warn")
        .otherwise("pass")
        .alias("status"),
    )


# --- suites -----------------------------------------------------------------


@dataclass(frozen=True)
class RowRule:
    """A test each row passes or fails on its own."""

    name: str
    fails: Column


@dataclass(frozen=True)
class DataTest:
    """A test given by its failing rows."""

    name: str
    failures: DataFrame


@dataclass(frozen=True)
class TableRules:
    """Row rules of one table, counted together in one pass over it."""

    table: DataFrame
    rules: Sequence[RowRule]


def null_rule(name: str, column: str) -> RowRule:
    return RowRule(name, F.col(column).isNull())


def values_rule(name: str, column: str, values: Sequence[str]) -> RowRule:
    return RowRule(name, ~as_column(column).isin(list(values)))


def run_suite(tests: Sequence[DataTest | TableRules]) -> DataFrame:
    """(test, failures, status), one row per test."""
    parts = []
    for test in tests:
        if isinstance(test, DataTest):
            parts.append(
                test.failures.agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(test.name).alias("test"), "failures"
                )
            )
        else:
            counted = test.table.agg(
                *[
                    F.count(F.when(rule.fails, F.lit(1))).alias(f"_{i}")
                    for i, rule in enumerate(test.rules)
                ]
            )
            entries = F.array(
                *[
                    F.struct(F.lit(rule.name).alias("test"), F.col(f"_{i}").alias("failures"))
                    for i, rule in enumerate(test.rules)
                ]
            )
            parts.append(counted.select(F.inline(entries)))
    status = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    return stack(*parts).withColumn("status", status)


def ensure_passed(results: DataFrame) -> DataFrame:
    failed = [r["test"] for r in results.filter("status = 'fail'").select("test").collect()]
    if failed:
        raise CheckError(f"data tests failed: {failed}")
    return results


def pipeline_metrics(
    addresses: DataFrame,
    dim: DataFrame,
    remaining: DataFrame,
    mapping: DataFrame,
    missing: DataFrame,
    queue: DataFrame,
    left_id: str,
    right_id: str,
) -> DataFrame:
    """(metric, value, target, met) of one run.

    Deduplication: address rows merged away, of those and the ``no_near_duplicates``
    rows still to merge.  Matching: right ids with a left partner.  Coverage: source
    ids in the mapping, of those and the ``mapping_complete`` rows it lacks.
    """
    rows = F.count(F.lit(1))

    def metric(df: DataFrame, name: str, value: Column, target: float, above: bool) -> DataFrame:
        met = F.col("value") > target if above else F.col("value") < target
        return df.select(
            F.lit(name).alias("metric"),
            value.cast("double").alias("value"),
            F.lit(target).alias("target"),
        ).withColumn("met", met)

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(1.0))

    merged = F.col("address_rows") - F.col("kept")
    dedup = addresses.agg(rows.alias("address_rows")).select(
        "address_rows",
        dim.agg(rows).scalar().alias("kept"),
        remaining.agg(rows - F.countDistinct("cluster_id")).scalar().alias("left"),
    )
    ids = mapping.agg(
        F.countDistinct(left_id).alias("lefts"),
        F.countDistinct(right_id).alias("rights"),
        F.countDistinct(F.when(F.col(left_id).isNotNull(), F.col(right_id))).alias("matched"),
    ).select("*", missing.agg(rows).scalar().alias("missing"))
    mapped = F.col("lefts") + F.col("rights")
    return stack(
        metric(dedup, "address_dedup_rate", share(merged, merged + F.col("left")), 0.95, True),
        metric(ids, "match_rate", share(F.col("matched"), F.col("rights")), 0.80, True),
        metric(queue.agg(rows.alias("n")), "review_queue_size", F.col("n"), 500.0, False),
        metric(ids, "coverage", share(mapped, mapped + F.col("missing")), 0.999999999, True),
    )


def quality_report(
    mapping: DataFrame, queue: DataFrame, locations: DataFrame, dim: DataFrame, as_of: dt.date
) -> DataFrame:
    """(section, key, value): confidence bands, queue reasons, address variants, lifecycle."""
    count = F.count(F.lit(1)).cast("double").alias("value")
    band = F.floor(F.col("match_confidence") * 20) / 20

    def section(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("section"), F.col("key").cast("string"), "value")

    confidence = (
        mapping.filter("match_confidence IS NOT NULL")
        .groupBy(F.format_number(band, 2).alias("key"))
        .agg(count)
    )
    reasons = queue.groupBy(F.col("match_reason").alias("key")).agg(count)
    merged = dim.agg(
        F.count(F.lit(1)).cast("double").alias("addresses"),
        F.coalesce(F.sum("variants"), F.lit(0)).cast("double").alias("variants"),
    ).selectExpr("stack(2, 'addresses', addresses, 'variants', variants) AS (key, value)")
    ended = F.coalesce(F.col("valid_to"), F.lit(as_of))
    lives = locations.groupBy("gold_id").agg(
        F.datediff(F.max(ended), F.min("valid_from")).alias("days"),
        F.bool_or("is_current").alias("open"),
    )
    lifecycle = lives.agg(
        F.avg("days").alias("days"),
        F.avg(F.when(F.col("open"), 0.0).otherwise(1.0)).alias("closed"),
    ).selectExpr("stack(2, 'mean_days', days, 'closure_rate', closed) AS (key, value)")
    return stack(
        section(confidence, "confidence"),
        section(reasons, "review"),
        section(merged, "addresses"),
        section(lifecycle, "lifecycle"),
    )
