"""Small helpers on DataFrames: written intermediate tables, size checks, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.session import scratch_path, shipped

__all__ = ["BROADCAST_ROWS", "components", "shipped", "small", "written"]

# A side is broadcast below this many rows of a few numbers each (some tens of megabytes).
BROADCAST_ROWS = 500_000


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a table for broadcast if it has at most ``rows`` rows; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that links lead to, for every node of a link.

    Alternates large-star and small-star steps until the edges form stars. A node with very many
    links is an aggregate's key, reduced before the shuffle, and a join's key, which adaptive
    execution splits. Every step is written, so a lost executor costs one step.
    """
    edges = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u <> v")
        .distinct(),
        "edges",
    )
    while not _stars(edges):
        # large star: hang the larger neighbours of a node on its smallest neighbour
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.filter("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        large = written(large, "large-star")
        # small star: hang a node and its smaller neighbours on the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        edges = written(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct(),
            "small-star",
        )
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other that hangs on none, as it is at the end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"))
    )
    ups = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return ups.filter("ups > 1 or (ups = 1 and least = 0)").isEmpty()


def merged(parts: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The (node, component) table ``parts`` of all nodes after more links between them.

    Only the components that the links lead to are worked on, as nodes of a smaller graph.
    """
    for i in (a, b):
        side = parts.select(F.col("node").alias(i), F.col("component").alias(f"component_{i}"))
        links = links.join(side, i)
    into = components(links, f"component_{a}", f"component_{b}")
    into = into.select(F.col("node").alias("component"), F.col("component").alias("into"))
    done = parts.join(into, "component", "left")
    return written(done.select("node", F.coalesce("into", "component").alias("component")), "parts")
