"""Connected components of an edge table, as rounds of joins; and of tables of edges that come in batches."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import discard, materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``id`` and ``component`` (the smallest id reachable) for every id on an edge.

    Each round takes the smallest label around every id and then the label of that label, so chains shorten by
    doubling. The labels of a round are a table in the shared folder, and the driver sees only whether any changed.
    Nulls, loops and repeated edges add nothing; an empty edge table gives an empty result.
    """
    one = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = materialise(one.select(ways.alias("w")).select("w.a", "w.b"), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near")).select("id", F.least("id", "near").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "id").select("id", F.col("component").alias("was"), F.least("component", "near").alias("to"))
        jump = labels.select(F.col("id").alias("to"), F.col("component").alias("far"))
        now = materialise(lower.join(jump, "to").select("id", "was", F.least("to", "far").alias("component")), "labels")
        if now.where("component <> was").isEmpty():
            discard(both)
            return now.select("id", "component")
        discard(labels)
        labels = now


@dataclass(frozen=True)
class Components:
    """Components that batches of edges add to: ``labels`` (``id``, ``component``: as it was when the id came) and ``merges`` (``component``, ``root``: what it is part of now)."""

    labels: DataFrame
    merges: DataFrame

    def resolved(self) -> DataFrame:
        """``id`` and ``component``, the smallest id that any edge so far reaches."""
        now = self.labels.join(self.merges, "component", "left")
        return now.select("id", F.coalesce("root", "component").alias("component"))


def no_components(spark: SparkSession, id_type: str = "long") -> Components:
    return Components(spark.createDataFrame([], f"id {id_type}, component {id_type}"), spark.createDataFrame([], f"component {id_type}, root {id_type}"))


def with_edges(before: Components, edges: DataFrame, a: str = "a", b: str = "b") -> Components:
    """What a batch of edges adds: rows of ``labels`` for ids that are new, and rows of ``merges`` that are new or changed.

    Known ids stand for their components, so the edges are contracted to those that connect two components or bring a new
    id, and only they are followed. Labels of old ids are never rewritten, however large the components that an edge joins;
    merges that led to a component which is now part of another one are led on. Batches in any order give the components
    of all edges together. Of ``before`` the labels of the batch's ids are enough (``RunStore.matching``).
    """
    one = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    one = materialise(one, "new-edges")
    ends = one.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    known = materialise(before.labels.join(ends, "id", "left_semi").join(before.merges, "component", "left").select("id", F.coalesce("root", "component").alias("root")), "known")
    at = lambda side: known.select(F.col("id").alias(side), F.col("root").alias(f"{side}_root"))
    contracted = one.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    found = materialise(connected_components(contracted), "contracted")
    fresh = ends.join(known, "id", "left_anti").join(found, "id")
    moved = found.where("id <> component").join(known.select(F.col("root").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("component"), F.col("component").alias("root"))
    led_on = before.merges.join(moved.select(F.col("component").alias("root"), F.col("root").alias("to")), "root").select("component", F.col("to").alias("root"))
    return Components(materialise(fresh, "new-labels"), materialise(moved.unionByName(led_on), "new-merges"))
