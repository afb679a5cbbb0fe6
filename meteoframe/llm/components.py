"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe.llm.common import stored


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``, long, any
    order, repeats allowed): root is the smallest node it is connected to.

    Each round hangs every node's neighbours on the smallest one; the edge list
    never grows, and a hub's neighbours are handled by a join on it, which
    adaptive execution may split, not by one group in memory.
    """
    plain = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(plain, "components-0")
    state = None
    for k in range(1, most_rounds + 1):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(smallest.select("a", F.col("m").alias("b"))))
        now = stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"components-{k}")
        was, state = state, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == was:
            break
    else:
        raise RuntimeError("components did not settle")
    # settled: every node hangs on its root
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
