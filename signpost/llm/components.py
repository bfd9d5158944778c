"""Connected components of an edge table, without a step that sees a whole component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signpost.llm.tables import materialize


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that `edges` (a, b) connect each node to.

    Alternates between linking larger and smaller neighbours to a node's least one; every round
    is written as a table. Hot nodes cost map-side aggregated minima and one skew join.
    """
    current = materialize(
        edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(),
        "cc",
    )
    for _ in range(most_rounds):
        # Done when all edges lead to a node that leads nowhere, one from each node.
        ends = current.groupBy("hi").agg(F.count("*").alias("n"))
        inner = current.select(F.col("lo").alias("hi")).distinct().join(ends, "hi", "left_semi")
        if ends.where("n > 1").isEmpty() and inner.isEmpty():
            break
        both = current.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(current.select("hi", "lo"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = materialize(large.distinct(), "cc-large")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        small = small.select("m", F.col("lo").alias("x")).union(small.select("m", "hi")).where("m <> x")
        current = materialize(small.select(F.col("m").alias("lo"), F.col("x").alias("hi")).distinct(), "cc")
    else:
        raise RuntimeError("components did not settle")
    heads = current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(heads)
