"""Connected components of a graph given as edges, as rounds of Spark joins.

Each round points every node at its smallest neighbour, follows those
pointers to their ends by doubling, and contracts the edges onto the ends;
self-loops and repeated edges go.  Every tree of pointers collapses to one
node, so the nodes at least halve in a round, and a chain of pointers takes
as many doublings as the logarithm of its length.  Every step is written to
the shared folder and read back, which also gives the next plan the true
sizes.  No node's neighbours are ever gathered: minima are taken with partial
aggregation and the joins carry two longs a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stage


def _to_ends(pointers: DataFrame) -> DataFrame:
    """Pointers ``(node, to)``, all followed to where nothing points on."""
    while True:
        onward = pointers.select(F.col("node").alias("target"), F.col("to").alias("onward"))
        held = pointers.select("node", F.col("to").alias("target")).join(onward, "target", "left")
        moved = stage(held.select("node", F.coalesce("onward", "target").alias("to"), F.col("onward").isNotNull().alias("moved")), "pointers")
        pointers = moved.select("node", "to")
        if moved.where("moved").isEmpty():
            return pointers


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every endpoint of ``edges(a, b)`` (longs); the
    root is the smallest node of the component.  Null ends and self-loops
    are ignored; edges may repeat and run either way."""
    larger_first = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    live = stage(edges.where("a <> b").select(*larger_first).distinct(), "edges")
    labels = live.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    while not live.isEmpty():
        ends = _to_ends(live.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")))
        moved = live.join(ends.withColumnRenamed("node", "a"), "a").select(F.col("to").alias("a"), "b").distinct()
        moved = moved.join(ends.select(F.col("node").alias("b"), "to"), "b", "left").select("a", F.coalesce("to", "b").alias("b"))
        live = stage(moved.where("a <> b").select(*larger_first).distinct(), "edges")
        labels = labels.join(ends.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return labels
