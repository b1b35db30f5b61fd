"""Connected components of a graph that is spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.llm.shared import folder, stored


def components(edges: DataFrame) -> DataFrame:
    """(id, root): each end of an edge (a long, b long) with the smallest id that it reaches.

    Rounds of contraction: each vertex steps to its smallest neighbour, twice, and the edges are drawn anew between the
    vertices reached. Every vertex but the local minima vanishes in a round, so rounds grow with the logarithm of the
    longest chain. Each round is written to the shared folder; the driver sees only whether edges are left. Loops, repeated
    edges and nulls in an end are dropped; no edges give no rows.
    """
    place = folder(edges.sparkSession)
    edges = stored(edges.select("a", "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{place}/edges-0")
    ends = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    labels = ends.select("id", F.col("id").alias("root"))
    step = 0
    while not edges.isEmpty():
        step += 1
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("v")).agg(F.least("v", F.min("b")).alias("up"))
        above = parent.select(F.col("v").alias("up"), F.col("up").alias("to"))
        parent = stored(parent.join(above, "up").select("v", "to"), f"{place}/parents-{step}")
        moved = (
            edges.join(parent, F.col("a") == F.col("v")).select(F.col("to").alias("x"), "b")
            .join(parent, F.col("b") == F.col("v")).select("x", F.col("to").alias("y")).where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
        labels = labels.join(parent, F.col("root") == F.col("v"), "left").select("id", F.coalesce("to", "root").alias("root"))
        labels = stored(labels, f"{place}/labels-{step}")
        edges = stored(moved, f"{place}/edges-{step}")
    return labels
