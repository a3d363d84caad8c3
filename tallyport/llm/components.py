"""Connected components of a link table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.common import Stage


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """(a, b) -> (node, root): the least node reachable, for every node that has a link.

    Each round hooks every node to the least of itself and its neighbours, moves the
    links to these, and drops those that became loops; names of all nodes follow. Least
    neighbours are summed on the map side, so a node with very many links is no hot task.
    Rounds end when no link is left; each is written, so a lost executor repeats one at most.
    """
    edges = stage.keep(links.select("a", "b"))
    names = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = stage.keep(both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("node"), F.least("a", "least").alias("root")))
        if names is None:
            moved = hook
        else:
            step = hook.select(F.col("node").alias("old"), F.col("root").alias("new"))
            moved = names.join(step, names.root == step.old, "left").select("node", F.coalesce("new", "root").alias("root"))
        kept_names = stage.keep(moved)
        left, right = hook.select(F.col("node").alias("a"), F.col("root").alias("x")), hook.select(F.col("node").alias("b"), F.col("root").alias("y"))
        kept_edges = stage.keep(
            edges.join(left, "a").join(right, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        for old in (edges, hook, names):
            if old is not None:
                stage.drop(old)
        edges, names = kept_edges, kept_names
    if names is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return names
