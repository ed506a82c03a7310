"""Connected components by alternating large-star and small-star rounds.

Each round is two shuffles over the edges and is written to the shared folder, so lineage
stays short and a lost executor repeats one step only. A hub's edges are aggregated before
the shuffle for its minimum, and the joins read stored tables on both sides, where Spark
splits a hot key's rows over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salarium.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)`` but the roots themselves.

    The root is the smallest node of the component. Edges may repeat, point either way or
    join a node with itself; nodes are of any orderable type and not null.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        # large star: every larger neighbour of a node moves to the smallest node around it
        both = now.select(F.col("v").alias("v2"), F.col("u").alias("w")).unionAll(now.select(F.col("u"), F.col("v")))
        low = stored(both.groupBy("v2").agg(F.min("w").alias("w")).select("v2", F.least("v2", "w").alias("low")), "star-low")
        large = stored(
            now.join(low, now["v"] == low["v2"]).select("u", F.col("low").alias("v")).distinct(), "edges-large")
        # small star: a node and its smaller neighbours move to the smallest of them
        low = stored(large.groupBy(F.col("u").alias("u2")).agg(F.min("v").alias("low")), "star-low")
        moved = large.join(low, large["u"] == low["u2"]).where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        now = stored(moved.unionAll(low.select(F.col("u2").alias("u"), F.col("low").alias("v"))).distinct(), "edges-small")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple[int, int]:
    n, digest = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return n, digest
