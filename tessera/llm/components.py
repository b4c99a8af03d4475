"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """``edges`` (a, b longs) -> (node, comp): the smallest node of each component.

    Labels fall to the smallest of a node's neighbourhood and then jump to the label of
    the label, so paths shorten by half each time; every round is a written table.  With
    ``rounds`` it ends early: nodes with equal labels are then connected, but not all
    connected nodes have equal labels yet."""
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .where("a != b"), "edges")
    labels = written(both.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.col("node"), F.min("b")).alias("comp")), "labels")
    done = 0
    while rounds is None or done < rounds:
        done += 1
        offered = (both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                   .select(F.col("a").alias("node"), "comp", F.lit(None).cast("long").alias("before"))
                   .unionByName(labels.select("node", "comp", F.col("comp").alias("before"))))
        lower = offered.groupBy("node").agg(F.min("comp").alias("to"), F.max("before").alias("before"))
        jumped = labels.select(F.col("node").alias("to"), F.col("comp").alias("further"))
        moved = written(lower.join(jumped, "to").select(
            "node", "before", F.least("to", "further").alias("comp")), "labels")
        labels = moved.select("node", "comp")
        if rounds is None and moved.where("before != comp").isEmpty():
            break
    return labels
