"""Connected components of a table of links, by hooking to the least neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import staged

#: Times that a parent is replaced by its parent in a round.
JUMPS = 3


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the least node of its component.

    Each round hooks every node to its least neighbour (an aggregate that combines in the tasks), shortens the paths,
    and keeps only links between different roots, so the links shrink by half or more in a round.
    """
    links = staged(links.select("a", "b").where(F.col("a") != F.col("b")), "links")
    labels = staged(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")), "labels")
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("up")), "labels")
        for _ in range(JUMPS):
            parents = staged(_through(parents, "up", parents), "labels")
        links = staged(
            _through(_through(links, "a", parents), "b", parents)
            .where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "links",
        )
        labels = staged(_through(labels, "root", parents), "labels")
    return labels


def _through(df: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``column`` replaced by its parent where it has one."""
    up = parents.select(F.col("node").alias("__node"), F.col("up").alias("__up"))
    joined = df.join(up, F.col(column) == F.col("__node"), "left")
    return joined.withColumn(column, F.coalesce("__up", column)).drop("__node", "__up")
