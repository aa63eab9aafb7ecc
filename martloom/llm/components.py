"""Connected components of a graph given as a table of edges, by contraction on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import written


def contracted(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the smallest node that it reaches.

    In a round every node points to its smallest neighbour or itself, pointers are followed to their ends, and edges
    move to those ends; edges inside one end vanish. The number of nodes falls at least by half in a round.
    """
    edges = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        points = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root"))
        points = _followed(written(points, "pointers"))
        roots = points if roots is None else written(_moved(roots, "root", points), "roots")
        edges = _moved(_moved(edges, "a", points), "b", points).where("a <> b").distinct()
        edges = written(edges, "edges")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def _moved(df: DataFrame, column: str, points: DataFrame) -> DataFrame:
    """`column` replaced by where it points to; nodes without a pointer stay."""
    to = points.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    moved = df.join(to, df[column] == to["_node"], "left")
    return moved.withColumn(column, F.coalesce("_root", column)).drop("_node", "_root")


def _followed(points: DataFrame) -> DataFrame:
    """Pointers doubled until each leads to a node that points to itself."""
    while True:
        further = written(_moved(points.withColumn("was", F.col("root")), "root", points), "pointers")
        if further.where("root <> was").isEmpty():
            return further.drop("was")
        points = further.drop("was")
