"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeshred.session import stage


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """node, root: every node that has a link, with the smallest node reachable from it.

    ``links`` has columns a, b (long, not null, in either order, repeats and a = b allowed). A large
    star hangs every larger neighbour of a node on its smallest one, a small star every smaller one;
    alternating, chains shrink by halves. Nothing but counts leaves the cluster; every step is written to the
    shared folder, so lineage stays short. A hub's rows are split, as both sides of its join are written tables.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, seen, step = stage(ordered, f"{label}-links"), None, 0
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = stage(_hang(both, F.col("v") > F.col("u"), f"{label}-{step}-l").distinct(), f"{label}-{step}-large")
        down = _hang(edges, F.lit(True), f"{label}-{step}-s").unionAll(
            edges.groupBy("u").agg(F.min("v").alias("v")))
        edges = stage(down.where("u <> v").distinct(), f"{label}-{step}-small")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen, step = state, step + 1
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _hang(edges: DataFrame, which, label: str) -> DataFrame:
    """(v, smallest of u and its neighbours) for the chosen edges (u, v)."""
    least = stage(edges.groupBy(F.col("u").alias("m_u")).agg(F.least(F.col("m_u"), F.min("v")).alias("m")), label)
    return (edges.where(which).join(least, F.col("u") == F.col("m_u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))
