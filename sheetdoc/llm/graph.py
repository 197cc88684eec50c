"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetdoc.llm.common import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``; a component is named by its least node.

    Each round points every node at its least neighbour (or itself), follows the pointers to
    their ends by doubling, and contracts the links to those ends. Minima are combined before the
    shuffle, so a node with very many links costs no more than they do; the links left shrink
    geometrically. All tables stay distributed. Links with a null end are ignored."""
    left = stage(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links")
    found = None
    while not left.isEmpty():
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = stage(both.groupBy("a").agg(F.min("b").alias("to")).select(F.col("a").alias("node"), F.least("a", "to").alias("to")), "pointers")
        while True:
            step = point.select(F.col("node").alias("to"), F.col("to").alias("then"))
            jumped = stage(point.join(step, "to").select("node", F.col("then").alias("to"), (F.col("then") < F.col("to")).alias("moved")), "pointers")
            point = jumped.select("node", "to")
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = point.select("node", F.col("to").alias("component"))
        else:
            ends = point.select(F.col("node").alias("component"), "to")
            found = found.join(ends, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        to_a, to_b = (point.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")) for c in "ab")
        left = stage(
            left.join(to_a, "a").join(to_b, "b").where("a_to <> b_to")
            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(),
            "links",
        )
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stage(found, "components")
