"""Load jobs and the ordered run of loads, models and tests."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality as Q
from ..sources.tables import RunRecord, log_run, materialize, read_table, recent_runs, replace_table


@dataclass(frozen=True)
class LoadJob:
    """One feed: how to read it, what must hold, where it goes."""

    source: str
    table: str
    read: Callable[[SparkSession], DataFrame]
    checks: Q.FeedChecks


def run_load(spark: SparkSession, job: LoadJob, root: str, log_path: str) -> int:
    """Read, check, replace the table, log.

    The feed is read once: the counts that the checks and the null rates need are
    taken while the new table is written, and a bad feed leaves the old table.  Any
    error is logged with its text and raised again.
    """
    started, rows = time.monotonic(), 0

    def record(status: str, **more) -> None:
        took = time.monotonic() - started
        log_run(spark, log_path, RunRecord(job.source, job.table, rows, status, duration_seconds=took, **more))

    try:
        df = job.read(spark)
        seen = replace_table(df, f"{root}/{job.table}", job.checks.measures(df), job.checks.judge)
        rows = seen["rows"]
        record("success", metrics={"row_count": rows, **job.checks.summary(seen)})
    except Exception as error:
        record("failed", note=str(error))
        raise
    return rows


def run_loads(
    spark: SparkSession, jobs: Sequence[LoadJob], root: str, log_path: str, limit: int = 10
) -> DataFrame:
    """Run the jobs in order and return the newest log rows."""
    for job in jobs:
        run_load(spark, job, root, log_path)
    return recent_runs(spark, log_path, limit)


Frames = Mapping[str, DataFrame]


def run_pipeline(
    spark: SparkSession,
    jobs: Sequence[LoadJob],
    models: Mapping[str, Callable[[Frames], DataFrame]],
    tests: Callable[[Frames], Sequence[Q.DataTest | Q.TableRules]],
    root: str,
    log_path: str,
    kinds: Mapping[str, str] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Loads, then models in the given order, then tests; the first failure stops the run.

    Each model sees the tables and the models before it and becomes a view, a table or
    an inlined frame as ``kinds`` says (``table`` by default, so that nothing is computed
    for every model that reads it).  Returns all frames and the test results.
    """
    run_loads(spark, jobs, root, log_path)
    frames = {job.table: read_table(spark, f"{root}/{job.table}") for job in jobs}
    for name, model in models.items():
        frames[name] = materialize(model(frames), name, (kinds or {}).get(name, "table"), root)
    results = Q.ensure_passed(Q.run_suite(tests(frames)))
    return frames, results
