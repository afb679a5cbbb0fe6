"""Keep one row per key.

Instead of ``row_number() over (partition by key order by ...)`` followed by
``rn = 1``, the winner is picked by ``max``/``min`` of a struct whose leading
fields are the order keys.  That is an ordinary aggregate: Spark combines it
map-side (partial aggregation) before the shuffle, so a key that holds a third
of all rows is reduced to one row per map task and never lands whole in one
task.  Struct comparison is field by field, so every later field is the
tie-break and the pick is deterministic.  With string fields in the struct
Spark plans a sort-based aggregate (the buffer is not fixed-width); it still
runs partially before the exchange, so the hot-key reduction holds, and its
sorts spill to disk instead of failing on memory.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[tuple],
             take: str = "max") -> DataFrame:
    """One row per ``keys``: the greatest (take='max') or least row by ``order``.

    ``order`` is a list of ``(column, nulls_first)`` pairs, each a name or an
    expression; comparison is
    ascending on the struct, so ``take='max'`` means "last by order" and
    ``take='min'`` "first by order".  Null handling per field is explicit:
    a flag column is put before each order key.  All remaining columns follow
    as tie-breaks, so exact ties resolve the same way on every run (struct
    order puts a null field below any value).
    """
    keys = list(keys)
    order_cols = [c for c, _ in order if isinstance(c, str)]
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    fields = []
    for i, (key, nulls_first) in enumerate(order):
        c = F.col(key) if isinstance(key, str) else key
        # For max(): a null must win when nulls_first -> flag = isNull.
        # For min(): a null must win when nulls_first -> flag = isNotNull (0 < 1).
        if take == "max":
            flag = c.isNull() if nulls_first else c.isNotNull()
        else:
            flag = c.isNotNull() if nulls_first else c.isNull()
        fields += [flag.cast("int").alias(f"_f{i}"), c.alias(key if isinstance(key, str) else f"_o{i}")]
    fields += [F.col(c) for c in rest]
    agg = F.max if take == "max" else F.min
    picked = df.groupBy(*keys).agg(agg(F.struct(*fields)).alias("_w"))
    return picked.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in df.columns if c not in keys]) \
        .select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """First row seen per key, by arrival columns (e.g. file, line position)."""
    return pick_one(df, keys, [(c, False) for c in arrival], take="min")

