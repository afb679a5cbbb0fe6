"""Earthquake feed: domestic / foreign views and the per-region tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe import constants as K
from meteoframe.functions import dates as D
from meteoframe.functions.numeric import safe_double
from meteoframe.functions.text import first_tokens
from meteoframe.operators.merge import replace_range


MONTH = "eq_month"


def with_month(raw: DataFrame) -> DataFrame:
    """Rows with the table's partition column: the month of the report's time
    (a day has too few reports for a partition of its own)."""
    return raw.withColumn(MONTH, F.substring("eqDate", 1, 6))


# the same two rules as SQL text, for views kept in the catalog
DOMESTIC_SQL = f"nkDiv = 'N' AND cntDiv = 'Y' AND msgCode = '{K.EQ_MSG_DOMESTIC}'"
FOREIGN_SQL = f"nkDiv = 'N' AND cntDiv = 'N' AND msgCode = '{K.EQ_MSG_FOREIGN}'"


def domestic(raw: DataFrame) -> DataFrame:
    """Domestic reports, North Korea excluded (a view: stays lazy, and the
    three equalities reach the scan as pushed filters)."""
    return raw.filter((F.col("nkDiv") == "N") & (F.col("cntDiv") == "Y")
                      & (F.col("msgCode") == K.EQ_MSG_DOMESTIC))


def foreign(raw: DataFrame) -> DataFrame:
    return raw.filter((F.col("nkDiv") == "N") & (F.col("cntDiv") == "N")
                      & (F.col("msgCode") == K.EQ_MSG_FOREIGN))


def region_of(place="eqPt"):
    """First two space-separated tokens of the place (a Column)."""
    return first_tokens(F.col(place), 2)


def region_latest(dom: DataFrame) -> DataFrame:
    """Per region: number of reports and the coordinates of the latest one.

    One aggregate replaces the rank-then-join of two CTEs: ``count(*)`` and
    ``max(struct(...))`` per region in the same pass, combined map-side, so a
    region holding a third of all reports is still spread over every task.
    The latest report is ``ORDER BY eqDate DESC`` with nulls first (as the
    warehouse sorts them), then eqlt, eqln descending as tie-break.  A null
    region never joins its counts, so it is dropped.
    """
    latest = F.max(F.struct(F.col("eqDate").isNull().cast("int").alias("n"),
                            F.col("eqDate").alias("d"), F.col("eqLt").alias("lt"),
                            F.col("eqLn").alias("ln")))
    g = (dom.filter(region_of().isNotNull()).groupBy(region_of().alias("region"))
         .agg(F.count(F.lit(1)).alias("eq_count"), latest.alias("w")))
    # no ORDER BY here: a table keeps no row order, so ordering happens on
    # read (``by_count``) instead of costing a range shuffle on every rebuild
    return g.select("region", "eq_count", F.col("w.lt").alias("eqlt"), F.col("w.ln").alias("eqln"))


def by_count(region_table: DataFrame) -> DataFrame:
    """Region table in report order: most reports first, then region."""
    return region_table.orderBy(F.col("eq_count").desc(), F.col("region"))


def region_max(fgn: DataFrame) -> DataFrame:
    """Per region: number of reports and the largest magnitude (as a number,
    not text order).  One aggregate instead of two joined ones."""
    return (fgn.filter(region_of().isNotNull()).groupBy(region_of().alias("region"))
            .agg(F.count(F.lit(1)).alias("eq_count"), F.max(safe_double("magMl")).alias("max_magml")))


def region_states(raw: DataFrame) -> DataFrame:
    """Per event month, view and region what the region tables need of those
    reports, in a form that merges: counts add up, the rest is a maximum."""
    both = (domestic(raw).withColumn("kind", F.lit("domestic"))
            .unionByName(foreign(raw).withColumn("kind", F.lit("foreign"))))
    newest = F.max(F.struct(F.col("eqDate").isNull().cast("int").alias("undated"), F.col("eqDate").alias("at"),
                            F.col("eqLt").alias("lt"), F.col("eqLn").alias("ln")))
    return (both.filter(region_of().isNotNull()).groupBy("kind", region_of().alias("region"), MONTH)
            .agg(F.count(F.lit(1)).alias("n"), newest.alias("newest"), F.max(safe_double("magMl")).alias("largest"))
            .select("kind", "region", "n", "newest", "largest", MONTH))


def regions_from_states(states: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two region tables (as ``region_latest`` and ``region_max`` make them)
    from stored states."""
    def merged(kind: str) -> DataFrame:
        return (states.filter(F.col("kind") == kind).groupBy("region")
                .agg(F.sum("n").alias("eq_count"), F.max("newest").alias("newest"), F.max("largest").alias("max_magml")))
    return (merged("domestic").select("region", "eq_count", F.col("newest.lt").alias("eqlt"), F.col("newest.ln").alias("eqln")),
            merged("foreign").select("region", "eq_count", "max_magml"))


def replace_day(raw: DataFrame, day_rows: DataFrame, day: str) -> DataFrame:
    """Delete the reports of ``day`` (eqDate in [day, day + 1 day - 1 s]) and
    load ``day_rows``; rerunning with the same rows changes nothing."""
    start, end = D.day_range_bounds(F.lit(day))
    ts = D.parse_ts("eqDate", D.STAMP_SECOND)
    return replace_range(raw, day_rows, ts.between(start, end))
