"""Connected components of an edge table by contraction.

Every round each node points to the least of itself and its neighbours,
pointers are followed to their ends (doubling their length each time), and
the edges are carried over to those ends; edges inside one group vanish and
equal ones merge, so the edge table shrinks quickly.  Everything stays in
tables cut to the shared folder; neither edges nor labels come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import cut


def _between(edges: DataFrame, a, b) -> DataFrame:
    """Distinct edges from the greater to the smaller end."""
    return (edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct())


def _ends(pointers: DataFrame) -> DataFrame:
    """``node, to`` with every pointer followed to its end."""
    while True:
        there = pointers.select(F.col("node").alias("at"), F.col("to").alias("next"))
        longer = cut(pointers.join(there, pointers["to"] == there["at"], "left")
                     .select("node", F.col("to").alias("old"), F.coalesce("next", "to").alias("to")))
        pointers = longer.select("node", "to")
        if longer.filter("to <> old").isEmpty():
            return pointers


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` (least node of the component) for the nodes of
    ``edges`` (``a, b``: long, not null).  Self-edges and repeated edges do
    not matter; nodes with self-edges only are left out."""
    edges = cut(_between(edges, F.col("a"), F.col("b")))
    labels = None
    while True:
        least = (edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
                 .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("to")))
                 .groupBy("node").agg(F.min("to").alias("to")))
        to = _ends(cut(least))
        if labels is None:
            labels = to.select("node", F.col("to").alias("label"))
        else:
            new = to.select(F.col("node").alias("at"), F.col("to").alias("new"))
            labels = cut(labels.join(new, labels["label"] == new["at"], "left")
                         .select("node", F.coalesce("new", "label").alias("label")))
        one, two = (to.select(F.col("node").alias(f"n{k}"), F.col("to").alias(f"t{k}")) for k in (1, 2))
        edges = cut(_between(edges.join(one, edges["a"] == one["n1"]).join(two, edges["b"] == two["n2"]),
                             F.col("t1"), F.col("t2")))
        if edges.isEmpty():
            return labels
