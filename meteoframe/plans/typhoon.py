"""Typhoon feed: cleaning of the fixed-width listing and the keyed upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe import constants as K
from meteoframe.functions import dates as D
from meteoframe.functions.text import bind
from meteoframe.functions.numeric import safe_double, safe_int, sentinel_to_null
from meteoframe.operators.batches import drop_bad_batches
from meteoframe.operators.merge import upsert_frame

KEYS = ["TYP_TM", "TYP"]
MONTH = "TYP_MONTH"


def latest_first() -> list[tuple]:
    """Among repeated keys the later forecast hour, then the later sequence
    number wins; both compared as numbers ('120' is after '96')."""
    return [(safe_int("FT"), False), (safe_int("SEQ"), False)]


def clean(raw: DataFrame, batch_col: str | None = "batch") -> DataFrame:
    """Raw listing rows -> RAW_TYPHOON rows.

    Missing-value codes -> null in every column; TYP_TM parsed strictly as
    'yyyyMMddHHmm' - a stamp that does not parse fails its whole fetch, so
    every row of that batch is dropped (other batches go on); seven numeric
    columns coerced (bad text -> null); the 13 kept columns selected.
    """
    needed = [c for c in raw.columns if c in {*K.TYPHOON_FINAL, "TYP_TM", batch_col}]
    read = bind(raw.select(*needed), "_r", F.struct(*needed)).select("_r.*")
    nulled = bind(read, "_r", F.struct(*[sentinel_to_null(c, K.TYPHOON_SENTINELS).alias(c)
                                         if c in K.TYPHOON_COLUMNS else F.col(c) for c in needed])).select("_r.*")
    ts = D.parse_ts("TYP_TM", D.STAMP_MINUTE)
    if batch_col is not None and batch_col in raw.columns:
        bad = F.col("TYP_TM").isNotNull() & ts.isNull()
        nulled = drop_bad_batches(nulled, batch_col, bad)
    out = nulled.withColumn("TYP_TM", ts)
    for c in K.TYPHOON_NUMERIC:
        out = out.withColumn(c, safe_double(c))
    return out.select(*K.TYPHOON_FINAL)


def with_month(rows: DataFrame) -> DataFrame:
    """Rows with the table's partition column, the month of TYP_TM.  It follows
    from a merge key, so a MERGE touches only the months of its source."""
    return rows.withColumn(MONTH, F.date_format("TYP_TM", "yyyyMM"))


def upsert(target: DataFrame, source: DataFrame) -> DataFrame:
    """MERGE ON (TYP_TM, TYP): matched rows take the source values, new keys
    are inserted.  Overlapping fetches repeat a key in the source; the row
    with the greatest (FT, SEQ, ...) is used."""
    return upsert_frame(target, source, KEYS, order=latest_first())
