"""Address clusters that are kept, and grow by batches instead of being made anew.

Kept are the addresses, their placed points, and every node of the cluster graph (digests,
points, cells, streets) with its component, which is named by its least digest.  A batch adds only
addresses that are not known.  Its points meet the kept points of the cells around them, its
streets the kept streets of their city, and the edges that this gives lead from new nodes to old
components.  Only these are contracted.  An old component that was joined to a lesser one leaves
an alias row, so no label is rewritten; ``labels`` follows the aliases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runs import RunFolder
from ..session import stage
from . import addresses as A
from .lasting import resolved, roots
from .shape import stack

ADDRESS_SCHEMA = (
    "address_hash string, street_norm string, city_norm string, state_norm string, "
    "latitude decimal(10,6), longitude decimal(10,6)"
)
POINT_SCHEMA = "latitude decimal(10,6), longitude decimal(10,6), row bigint, column bigint"
NODE_SCHEMA = "node string, component string"
ALIAS_SCHEMA = "id string, target string"


class ClusterIndex:
    """Clusters of normalized addresses in a folder of runs, one run per batch."""

    def __init__(self, spark: SparkSession, path: str, metres: float = 50, threshold: float = 0.90):
        self.runs = RunFolder(spark, path)
        self.metres, self.threshold = metres, threshold

    def _nodes(self) -> DataFrame:
        """(node, component) with the components they belong to now."""
        ends = roots(self.runs.read("aliases", ALIAS_SCHEMA))
        return resolved(self.runs.read("nodes", NODE_SCHEMA), ends, "component")

    def labels(self) -> DataFrame:
        """(address_hash, cluster_id) of every address that is connected with anything."""
        digests = self._nodes().filter(F.regexp_like("node", F.lit(A.DIGEST)))
        return digests.select(F.col("node").alias("address_hash"), F.col("component").alias("cluster_id"))

    def _known_streets(self, fresh: DataFrame, nodes: DataFrame) -> DataFrame:
        """Kept streets of the batch's cities, each with the least one of its component there."""
        place = list(A._PLACE)
        cities = A._with_street(fresh).select(*place).distinct()
        kept = A._with_street(self.runs.read("addresses", ADDRESS_SCHEMA)).join(cities, place, "left_semi")
        kept = kept.select(*place, F.col("street_norm").alias("_text"), A._street("street_norm").alias("node")).distinct()
        labelled = stage(kept.join(nodes, "node").drop("node"), "known-streets")
        least = labelled.groupBy(*place, "component").agg(F.min("_text").alias("_root"))
        return labelled.join(least, [*place, "component"]).select(*place, "_text", "_root")

    def add(self, batch: DataFrame) -> int:
        """Take in normalized addresses; returns how many of them (distinct) were new."""
        rows = A.distinct_addresses(batch.select(*_typed(ADDRESS_SCHEMA)))
        known = self.runs.read("addresses", ADDRESS_SCHEMA)
        same = [rows[c].eqNullSafe(known[c]) for c in rows.columns]
        fresh = stage(rows.join(known, same, "left_anti"), "new-addresses")
        points = stage(
            A.placed_points(fresh, self.metres).join(
                self.runs.read("points", POINT_SCHEMA).select("latitude", "longitude"), ["latitude", "longitude"], "left_anti"
            ),
            "points",
        )
        nodes = stage(self._nodes(), "nodes")
        near = A._nearby_edges(fresh, self.metres, points, self.runs.read("points", POINT_SCHEMA))
        alike = A._similar_street_edges(fresh, self.threshold, self._known_streets(fresh, nodes))
        edges = stage(stack(near, alike), "edges")
        # Old nodes stand for their components, of which only these are looked at again.
        ends = stack(edges.select(F.col("u").alias("node")), edges.select(F.col("v").alias("node"))).distinct()
        met = stage(ends.join(nodes, "node", "left"), "ends")
        stands = met.select(F.col("node"), F.coalesce("component", "node").alias("stand"))
        contracted = (
            edges.join(stands.withColumnsRenamed({"node": "u", "stand": "_u"}), "u")
            .join(stands.withColumnsRenamed({"node": "v", "stand": "_v"}), "v")
            .select(F.col("_u").alias("u"), F.col("_v").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        parts = stage(A.named_components(contracted), "parts")
        new = met.filter("component IS NULL").select("node").join(parts, "node")
        joined = parts.join(met.select(F.col("component").alias("node")).dropna().distinct(), "node")
        run = self.runs.next_number()
        self.runs.write(
            run,
            {
                "addresses": fresh,
                "points": points.select(*_typed(POINT_SCHEMA)),
                "nodes": new.select("node", F.col("cluster_id").alias("component")),
                "aliases": joined.filter("node <> cluster_id").select(F.col("node").alias("id"), F.col("cluster_id").alias("target")),
            },
        )
        return fresh.select("address_hash").distinct().count()

    def clustered(self, df: DataFrame) -> DataFrame:
        """``df`` with the ``cluster_id`` of its addresses; an address alone is its own cluster."""
        found = df.join(self.labels(), "address_hash", "left")
        return found.withColumn("cluster_id", F.coalesce("cluster_id", "address_hash"))

    def families(self, clustered: DataFrame) -> DataFrame:
        """(address_hash, cluster_id) of every known address in the clusters of ``clustered``.

        Ids of clusters are to be assigned to these: an address that is shown no more still brings its id along.
        """
        shown = clustered.select("address_hash", "cluster_id").distinct()
        return stack(self.labels().join(shown, "cluster_id", "left_semi").select(*shown.columns), shown).distinct()

    def compact(self) -> None:
        """One run with what all runs hold, aliases followed."""
        self.runs.write(
            self.runs.next_number(),
            {
                "addresses": self.runs.read("addresses", ADDRESS_SCHEMA),
                "points": self.runs.read("points", POINT_SCHEMA),
                "nodes": self._nodes(),
                "aliases": self.runs.read("aliases", ALIAS_SCHEMA).limit(0),
            },
            base=True,
        )


def _typed(schema: str) -> list[Column]:
    return [F.col(name).cast(kind) for name, kind in (f.split(" ", 1) for f in schema.split(", "))]
