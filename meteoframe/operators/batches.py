"""Whole-batch rejection and observed row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def drop_bad_batches(df: DataFrame, batch_col: str, bad: Column) -> DataFrame:
    """Drop every row of a batch (e.g. one landed file) in which any row is bad.

    The bad batches are found by an aggregate (combined map-side, so a batch
    holding a third of the rows is still spread over many tasks), then
    removed with a null-safe anti join on the batch id: rows without an id
    form one batch.  The list of bad ids is computed, so AQE picks the join
    from its measured size.
    """
    bad_ids = (df.groupBy(F.col(batch_col).alias("_bad_batch"))
               .agg(F.max(F.coalesce(bad, F.lit(True)).cast("int")).alias("_bad"))
               .filter(F.col("_bad") == 1).select("_bad_batch"))
    return df.join(bad_ids, F.col(batch_col).eqNullSafe(F.col("_bad_batch")), "left_anti")


def observe_counts(df: DataFrame, name: str, **conditions: Column):
    """Attach row counters that fill in when the frame is next executed.

    Returns (df, Observation); ``obs.get`` then holds ``rows`` plus one count
    per condition - without a second pass over the data.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.sum(F.when(c, 1).otherwise(0)).alias(k) for k, c in conditions.items()]
    return df.observe(obs, *metrics), obs


def union_all(frames) -> DataFrame:
    """Concatenate frames by column name; columns missing from a frame are
    null.  Empty frames add nothing, so no emptiness check is needed."""
    frames = list(frames)
    if not frames:
        raise ValueError("no frames to concatenate")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
