"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node with an edge to another node; the root is the
    least node that the edges lead to.

    Alternates two steps until nothing changes: every edge's smaller end is replaced
    by the least neighbour of that end, then every node keeps its least neighbour and
    passes it to its other smaller neighbours.  Rounds grow with the logarithm of the
    longest path.  Each round is joins and aggregations with partial sums on the edges
    alone, and is written to the shared folder, so that neither the lineage nor a
    driver-side structure grows with the data.  Null ends and loops are ignored.
    """
    e = (
        edges.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )
    e, before = stored(e, "edges"), None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                e.select("lo", "lo").distinct()
            )
        before = now
        least = e.groupBy(F.col("hi").alias("lo")).agg(F.min("lo").alias("below"))
        e = e.join(least, "lo", "left").select("hi", F.coalesce("below", "lo").alias("lo")).distinct()
        least = e.groupBy("hi").agg(F.min("lo").alias("below"))
        pairs = F.array(
            F.struct(F.col("hi").alias("hi"), F.col("below").alias("lo")),
            F.struct(F.col("lo").alias("hi"), F.col("below").alias("lo")),
        )
        e = e.join(least, "hi").select(F.inline(pairs)).filter("hi != lo").distinct()
        e = stored(e, "edges")
