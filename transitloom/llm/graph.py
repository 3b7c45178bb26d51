"""Connected components of a graph that lies in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitloom.session import shared_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read again: cuts the lineage and survives lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of edges (a, b) reaches."""
    hung = stars(edges)
    return hung.unionByName(hung.select(F.col("root").alias("node"), "root").distinct())


def stars(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of edges (a, b) reaches, without the rows of the roots themselves.

    Every node is hung onto the smallest of its neighbours, larger neighbours and smaller ones in turn, until every
    component is a star; a path of n nodes takes about log n turns. Edges are never gathered by node: the smallest
    neighbour is an aggregate, and joined back. Null ends and loops are ignored. A turn on stars changes nothing, so
    stars are looked for: one shuffle, where a turn takes five.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = stored(edges, "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        # an edge may come several times here: the smallest neighbour is the same, and the last step leaves one
        up = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        low = up.groupBy("a").agg(F.min("b").alias("low"))
        down = up.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b"))).filter("a <> b").distinct()
        edges = stored(down, "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether each larger end a of the distinct edges (a, b) hangs onto one node, on which hangs nothing larger: its root."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("end")).select("end.*")
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.count_if(F.expr("up > 1 or up = 1 and down = 1"))).first()[0]
