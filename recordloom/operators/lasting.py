"""Ids that last over runs: a key keeps the id it was first given, merged groups keep their least id.

The registry holds (key, id, run), one row when a key is first seen and one more if its id
changes; the aliases hold (id, target, run), one row when an id gives way to another one.
Both only grow, so a run appends rows and rewrites none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..runs import RunFolder
from ..session import stage
from .numbering import best_per, number_rows
from .shape import stack

REGISTRY_SCHEMA = "key string, id bigint, run bigint"
ALIAS_SCHEMA = "id bigint, target bigint, run bigint"


@dataclass(frozen=True)
class Assigned:
    """Ids of a run's groups, and what the run adds to the registry and to the aliases."""

    ids: DataFrame  # (group, id)
    keys: DataFrame
    aliases: DataFrame


def current_ids(registry: DataFrame) -> DataFrame:
    """(key, id): the id each key was given last."""
    return registry.groupBy("key").agg(F.max_by("id", "run").alias("id"))


def roots(aliases: DataFrame) -> DataFrame:
    """(id, root): where every id that gave way leads in the end, by pointer jumping.

    An id gives way to a lower one, so there are no circles, and each jump halves what is left
    of the chains.
    """
    links = stage(aliases.groupBy("id").agg(F.min("target").alias("root")), "aliases")
    while True:
        onward = links.select(F.col("id").alias("_at"), F.col("root").alias("_to"))
        jumped = links.join(onward, links["root"] == onward["_at"], "left")
        seen = Observation()
        links = stage(
            jumped.select("id", F.coalesce("_to", "root").alias("root"), "_to").observe(
                seen, F.count("_to").alias("moved")
            ),
            "aliases",
        ).drop("_to")
        if not seen.get["moved"]:
            return links


def resolved(df: DataFrame, roots: DataFrame, column: str) -> DataFrame:
    """``df`` with the ids in ``column`` replaced by those they gave way to."""
    onward = roots.select(F.col("id").alias("_gone"), F.col("root").alias("_root"))
    found = df.join(onward, df[column] == onward["_gone"], "left")
    return found.withColumn(column, F.coalesce("_root", column)).select(*df.columns)


def assign_ids(
    members: DataFrame, registry: DataFrame, aliases: DataFrame, run: int, key: str, group: str
) -> Assigned:
    """Ids of the groups of ``members`` (``key``, ``group``), known keys bringing theirs along.

    An id belongs to the group that holds most of its keys, then to the lesser one.
    A group takes the least id it holds, and the others become its aliases; a group without an
    id gets the next free one, in order of the groups.  So of a group that fell apart only the smaller
    parts change their id.
    """
    seen = stage(
        members.select(F.col(key).cast("string").alias("key"), F.col(group).alias("group")).distinct(), "members"
    )
    known = resolved(current_ids(registry), roots(aliases), "id")
    placed = stage(seen.join(known, "key", "left"), "placed")
    votes = placed.filter("id IS NOT NULL").groupBy("id", "group").agg(F.count(F.lit(1)).alias("keys"))
    held = stage(best_per(votes, ["id"], [-F.col("keys"), "group"]).select("id", "group"), "held")
    kept = held.groupBy("group").agg(F.min("id").alias("id"))
    groups = seen.select("group").distinct()
    fresh = number_rows(groups.join(kept, "group", "left_anti"), ["group"], "_number")
    # Every id ever given counts, also one that no key has any more.
    given = stack(registry.select("id"), aliases.select("id")).agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    ids = stage(
        stack(kept.select("group", "id"), fresh.select("group", (F.col("_number") + given).alias("id"))), "ids"
    )
    run_no = F.lit(run).cast("bigint").alias("run")
    now = ids.select("group", F.col("id").alias("now"))
    gave_way = held.join(now, "group").filter("id <> now").select("id", F.col("now").alias("target"), run_no)
    # A key needs a row if it is new, or if the group that took its id is not its own.
    own = held.select("id", F.col("group").alias("_owner"))
    moved = placed.join(own, "id", "left").filter("_owner IS NULL OR _owner <> group").select("key", "group")
    keys = moved.join(now, "group").select("key", F.col("now").alias("id"), run_no)
    return Assigned(ids.withColumnRenamed("group", group), stage(keys, "new-keys"), stage(gave_way, "new-aliases"))


class IdRegistry:
    """The registry and its aliases in a folder of runs.

    ``compact`` writes the state as a base run, so that readers list few folders.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.runs = RunFolder(spark, path)

    def keys(self) -> DataFrame:
        return self.runs.read("keys", REGISTRY_SCHEMA)

    def aliases(self) -> DataFrame:
        return self.runs.read("aliases", ALIAS_SCHEMA)

    def assign(self, members: DataFrame, key: str, group: str) -> DataFrame:
        """(group, id) of the groups of this run; what is new about them is kept for the next one."""
        run = self.runs.next_number()
        found = assign_ids(members, self.keys(), self.aliases(), run, key, group)
        self.runs.write(run, {"keys": found.keys, "aliases": found.aliases})
        return found.ids

    def roots(self) -> DataFrame:
        return roots(self.aliases())

    def compact(self) -> None:
        """One run that holds each key once, with the id it leads to, and each alias with its end."""
        run = self.runs.next_number()
        ends = self.roots()
        at = F.lit(run).cast("bigint").alias("run")
        keys = resolved(current_ids(self.keys()), ends, "id").select("key", "id", at)
        self.runs.write(run, {"keys": keys, "aliases": ends.select("id", F.col("root").alias("target"), at)}, base=True)
