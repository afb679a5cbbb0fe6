"""Keyed upsert (MERGE), day replacement and retention as DataFrame algebra.

These return the new table contents; ``meteoframe.sinks`` writes them.

MERGE semantics kept: a matched target row is replaced by the source row
(every non-key column is SET, even to null); unmatched source rows are
inserted; a null key never matches, so it always inserts.  The source is
first reduced to one row per key by a stated order (a warehouse MERGE would
fail or double-insert on duplicate source keys).

Plan, built so that a key holding a third of the target never lands whole in
one task:

* updated = target LEFT OUTER JOIN deduped source.  The source has at most
  one row per key, so nothing multiplies; a skewed target partition is split
  by AQE's skew-join handling (supported for the streamed left side of a
  left outer join - not for a full outer join, which is why none is used).
* inserted = deduped source LEFT ANTI JOIN the target's distinct keys.  The
  distinct is an aggregate combined map-side, so a hot key is one row per
  map task before the shuffle.
* result = updated UNION ALL inserted.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteoframe.operators.dedupe import pick_one
from meteoframe.session import checkpoint_dir


def dedupe_source(source: DataFrame, keys: Sequence[str],
                  order: Sequence[tuple] = ()) -> DataFrame:
    """One source row per key: the last by ``order`` [(col, nulls_first)],
    remaining columns as tie-break.  Rows with a null key are all kept: each
    gets a number of its own, so that one aggregate serves both kinds."""
    keys = list(keys)
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    numbered = source.withColumn("_own", F.when(has_null, F.monotonically_increasing_id()))
    return pick_one(numbered, [*keys, "_own"], list(order), take="max").select(*source.columns)


def upsert_frame(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 order: Sequence[tuple] = ()) -> DataFrame:
    """New contents of ``target`` after MERGE ... USING ``source`` ON keys.

    The source must carry every target column (extra source columns are
    dropped).  A matched target row takes the source values (every target
    row of a repeated key is updated, as a MERGE updates each matched row),
    an unmatched target row stays as is, an unmatched source row is
    inserted.  Equality on null keys is never true, so null-key rows on
    either side pass through unmatched.
    """
    keys = list(keys)
    cols = list(target.columns)
    # read by both halves below: computed once (a reliable checkpoint)
    checkpoint_dir(source.sparkSession)
    src = dedupe_source(source.select(*cols), keys, order).checkpoint()
    return update_matched(target, src, keys).unionByName(insert_unmatched(target, src, keys))


def update_matched(target: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows, with the source's values where their key is in it.  ``src``
    has one row per key."""
    cols = list(target.columns)
    s = src.select(*[F.col(c).alias(f"_src_{c}") for c in cols], F.lit(True).alias("_src_hit"))
    hit = F.col("_src_hit").isNotNull()
    return (target.join(s, on=_equal(keys, "_src_"), how="left_outer")
            .select(*[F.when(hit, F.col(f"_src_{c}")).otherwise(F.col(c)).alias(c) for c in cols]))


def insert_unmatched(target: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the target."""
    held = target.select(*keys).filter(_all_not_null(keys)).distinct()
    return src.join(held.select(*[F.col(k).alias(f"_tgt_{k}") for k in keys]), on=_equal(keys, "_tgt_"), how="left_anti")


def _equal(keys: Sequence[str], prefix: str) -> Column:
    return reduce(Column.__and__, [F.col(k) == F.col(f"{prefix}{k}") for k in keys])


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def replace_range(target: DataFrame, new_rows: DataFrame, in_range: Column) -> DataFrame:
    """Delete the target rows matching ``in_range``, then add ``new_rows``.

    Re-running with the same ``new_rows`` gives the same table (idempotent);
    an empty ``new_rows`` leaves the range empty.  Rows whose predicate is
    null (unparsable time) are kept, as a DELETE would keep them.
    """
    kept = target.filter(~F.coalesce(in_range, F.lit(False)))
    return kept.unionByName(new_rows.select(*target.columns))


def retain(target: DataFrame, keep: Column) -> DataFrame:
    """DELETE ... WHERE NOT keep: rows with a null predicate are kept."""
    return target.filter(F.coalesce(keep, F.lit(True)))
