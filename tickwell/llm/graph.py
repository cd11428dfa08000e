"""Connected components of a graph whose edges are rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(v, component) for each vertex of edges (a, b), the component named by its smallest vertex.

    Each round maps every vertex to its smallest neighbour or itself and draws the edges
    again between what the vertices were mapped to. A component's smallest vertex always
    stays; all others that are not smaller than their neighbours go. Where names have no
    order along the edges, as with hashes, rounds grow with the logarithm of a component's
    size; a chain whose names rise from end to end takes as many rounds as it has edges.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("to")), "smallest")
        if labels is None:
            labels = smallest.select("v", F.col("to").alias("component"))
        else:
            step = smallest.select(F.col("v").alias("component"), "to")
            labels = stored(labels.join(step, "component", "left").select("v", F.coalesce("to", "component").alias("component")), "labels")
        left = edges.join(smallest.select(F.col("v").alias("a"), F.col("to").alias("x")), "a").join(smallest.select(F.col("v").alias("b"), F.col("to").alias("y")), "b")
        edges = stored(left.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
    return labels if labels is not None else edges.select(F.col("a").alias("v"), F.col("b").alias("component"))
