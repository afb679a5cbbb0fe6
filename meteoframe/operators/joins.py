"""Fact-to-dimension joins.

Join strategies are left to the planner: it broadcasts a side whose size it
knows to be below ``spark.sql.autoBroadcastJoinThreshold``, and adaptive
execution does so at runtime from measured sizes and splits skewed
partitions.  Only tables fixed in the code (``bounded=True``) are marked.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str,
                   how: str = "inner", bounded: bool = False) -> DataFrame:
    """Join a (possibly huge) fact to a dimension on equal key columns.
    ``bounded=True``: the dimension is a table of fixed size."""
    return fact.join(F.broadcast(dim) if bounded else dim, on=on, how=how)
