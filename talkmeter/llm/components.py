"""Connected components of an edge table, by contraction.

Every round points each node at its least neighbour, follows the pointers, and replaces the edges'
ends by where they lead; edges inside a component vanish, and the rounds end when none is left. A
round folds edges by node before the shuffle, so a node with many edges is no hot group; each
round's tables are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmeter.llm.common import staged


def lookup(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``column`` replaced by its parent where it has one."""
    known = parents.select(F.col("u").alias("__u"), F.col("p").alias("__p"))
    return (
        rows.join(known, rows[column] == F.col("__u"), "left")
        .withColumn(column, F.coalesce("__p", column)).drop("__u", "__p")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all ends of the edges (u, v); the root is one of the component's nodes."""
    edges = staged(
        edges.filter(F.col("u") != F.col("v")).select(
            F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
        ).distinct(),
        "edges",
    )
    roots = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    roots = staged(roots.withColumn("root", F.col("node")), "roots")
    while not edges.isEmpty():
        ends = edges.union(edges.select("v", "u"))
        parents = ends.groupBy("u").agg(F.min("v").alias("p")).select(
            "u", F.least("u", "p").alias("p")
        )
        parents = staged(parents, "parents")
        for _ in range(2):
            parents = staged(lookup(parents, "p", parents), "parents")
        roots = staged(lookup(roots, "root", parents), "roots")
        moved = lookup(lookup(edges, "u", parents), "v", parents).filter(F.col("u") != F.col("v"))
        edges = staged(
            moved.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
            "edges",
        )
    return roots
