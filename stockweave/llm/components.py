"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.session import materialize

MAX_ROUNDS = 60


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every child has one root and no root is a child."""
    ends = edges.select(F.col("child").alias("node"), "root").unionByName(
        edges.select(F.col("root").alias("node"), F.lit(None).cast("long").alias("root"))
    )
    roles = ends.groupBy("node").agg(
        F.min("root").alias("least"),
        F.max("root").alias("most"),
        F.count(F.lit(1)).alias("seen"),
        F.count("root").alias("as_child"),
    )
    wrong = roles.where(
        (F.col("least") != F.col("most"))
        | ((F.col("as_child") > 0) & (F.col("seen") > F.col("as_child")))
    )
    return wrong.isEmpty()


def _with_least(directed: DataFrame) -> DataFrame:
    """Each (node, other) with the least of the node and its others."""
    least = directed.groupBy("node").agg(F.min("other").alias("m"))
    return directed.join(least.select("node", F.least("node", "m").alias("m")), "node")


def stars(edges: DataFrame) -> DataFrame:
    """(child, root) with root the least node of the component, for all edges (child, root).

    Large-star and small-star steps in turn; each step is two keyed shuffles,
    minima are combined before the shuffle, and every round is written to the
    shared folder. Edges with equal or NULL ends are ignored; nodes without an
    edge do not appear. An empty table gives an empty table.
    """
    edges = materialize(
        edges.where("child <> root")
        .select(
            F.greatest("child", "root").alias("child"), F.least("child", "root").alias("root")
        )
        .distinct()
    )
    for _ in range(MAX_ROUNDS):
        if _is_star_forest(edges):
            return edges
        down = edges.select(F.col("child").alias("node"), F.col("root").alias("other"))
        up = edges.select(F.col("root").alias("node"), F.col("child").alias("other"))
        large = _with_least(down.unionByName(up)).where("other > node and other <> m")
        large = large.select(F.col("other").alias("child"), F.col("m").alias("root")).distinct()
        small = _with_least(large.select(F.col("child").alias("node"), F.col("root").alias("other")))
        small = small.select(F.explode(F.array("node", "other")).alias("child"), "m")
        edges = materialize(
            small.where("child <> m").select("child", F.col("m").alias("root")).distinct()
        )
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
