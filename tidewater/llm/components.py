"""Connected components of a link table, as joins and grouped minima.

Each round points every node at its least neighbour (or itself), follows the
pointers to their ends by doubling, and contracts the links to those ends; it
stops when no link is left between different ends. A star, the shape that
groups of copies have, takes one round. Minima combine before the shuffle, so a
node with very many links is no hot spot, and the joins have one row per node on
one side, so that adaptive execution can split the other. Every step is staged
in the shared folder; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import discard, stage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is the least
    node that links reach. Nulls and self-links are left out."""
    edges = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") < F.col("b")))
    edges = stage(edges.distinct(), "links", narrow=True)
    labels = None
    while labels is None or not edges.isEmpty():
        ends = _ends(edges)
        new = ends if labels is None else stage(
            labels.join(ends.withColumnsRenamed({"node": "component", "end": "final"}), "component", "left").select("node", F.coalesce("final", "component").alias("end")), "labels", narrow=True)
        left, right = ends.toDF("a", "ea"), ends.toDF("b", "eb")
        rest = edges.join(left, "a").join(right, "b").where("ea <> eb").select(F.least("ea", "eb").alias("a"), F.greatest("ea", "eb").alias("b")).distinct()
        rest = stage(rest, "links", narrow=True)
        discard(edges)
        if labels is not None:
            discard(labels)
            discard(ends)
        edges, labels = rest, new.withColumnRenamed("end", "component")
        labels._staged_path = new._staged_path
    discard(edges)
    return labels


def _ends(edges: DataFrame) -> DataFrame:
    """Follow each node's least neighbour to where the pointers end."""
    both = edges.union(edges.select("b", "a"))
    ends = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("end")), "ends", narrow=True)
    while True:
        onward = ends.toDF("end", "next")
        jumped = stage(ends.join(onward, "end").select("node", F.col("next").alias("end"), (F.col("next") < F.col("end")).alias("moved")), "ends", narrow=True)
        moved = not jumped.where("moved").isEmpty()
        discard(ends)
        path, ends = jumped._staged_path, jumped.select("node", "end")
        ends._staged_path = path
        if not moved:
            return ends
