"""Connected components of a link table, by alternating stars; every step is a shuffle, nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import checkpoint_dir, materialize


def _star(links: DataFrame) -> DataFrame:
    """Each node's links moved to its least neighbour.  The least neighbours are combined map-side and stored, so the
    join back has two plain shuffles, of which AQE splits the partition of a node with very many links."""
    least = materialize(links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
    return links.join(least, "a").select("a", "b", "m")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``links`` (columns a and b, long, not null); the component is its least node.

    Direction, repeated links and loops don't matter; a table without links gives none.  Two stars a
    round (Kiveris et al. 2014): every node sends its larger neighbours to its least one, then its smaller ones.
    """
    checkpoint_dir(links.sparkSession)
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before, round_ = None, 0
    while True:
        seen = Observation()
        links = links.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).checkpoint(eager=True)
        state = (seen.get["n"], seen.get["h"])
        if state == before:
            break
        before = state
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        small = _star(large)  # a > b here: a node and its smaller neighbours
        links = (
            small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("l"))
            .select("l.a", "l.b")
            .filter("a <> b")
            .distinct()
        )
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
