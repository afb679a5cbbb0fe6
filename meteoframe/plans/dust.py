"""Dust feed: current grades per station, keep-first dedupe, monthly means."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe.functions import dates as D
from meteoframe.functions.numeric import mean_half_up, safe_number
from meteoframe.functions.weather import dust_grade
from meteoframe.operators.dedupe import keep_first, pick_one
from meteoframe.operators.joins import join_dimension

RAW_COLUMNS = ["DATE", "ORG", "STN", "PM10"]
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"  # how a partition list shows a null


def latest_snapshot(raw: DataFrame, col: str = "DATE", newest=None) -> DataFrame:
    """Rows of the newest ``col`` value (``WHERE col = (SELECT MAX(col) ...)``).

    The maximum is computed first (one small job over a single column, or
    given as ``newest`` - see ``newest_partition``) and then applied as a
    literal, so the filter reaches the scan and prunes partitions instead of
    joining the whole table to a subquery.
    """
    if newest is None:
        newest = raw.agg(F.max(col).alias("m")).first()["m"]
    if newest is None:
        return raw.limit(0)
    return raw.filter(F.col(col) == F.lit(newest))


def newest_partition(spark: SparkSession, table: str, col: str):
    """Largest value of partition column ``col`` of a catalog table, read
    from the partition list (metadata only, no data file opened) and compared
    in the column's own type; rows without a value do not count.  None when
    ``col`` is not a partition column or the table has no such partition."""
    if col not in [c.name for c in spark.catalog.listColumns(table) if c.isPartition]:
        return None
    kind = spark.table(table).schema[col].dataType
    listing = spark.sql(f"SHOW PARTITIONS {table}")
    value = F.regexp_extract(F.col("partition"), rf"(?:^|/){col}=([^/]*)", 1)
    known = listing.select(value.alias("v")).filter(~F.col("v").isin("", HIVE_NULL))
    return known.agg(F.max(F.url_decode(F.regexp_replace("v", r"\+", "%2B")).cast(kind)).alias("m")).first()["m"]


def dedupe_snapshot(raw: DataFrame) -> DataFrame:
    """One row per (DATE, STN).  The feed's order key is itself a partition
    key, so any row may win; ORG then PM10 (greatest) make the pick fixed."""
    return pick_one(raw.select(*RAW_COLUMNS), ["DATE", "STN"], [], take="max")


def current_grades(raw: DataFrame, stations: DataFrame, newest=None) -> DataFrame:
    """HOURLY_DUST_ANALYTICS: newest snapshot, deduped, joined to the station
    master (unknown stations drop), PM10 as NUMBER and its grade."""
    snap = dedupe_snapshot(latest_snapshot(raw, newest=newest))
    st = stations.select(F.col("STN_ID").cast("string").alias("STN"), "STN_ID", "STN_KO", "LON", "LAT")
    j = join_dimension(snap, st, "STN")
    return j.select("DATE", "STN_ID", "STN_KO", "LON", "LAT",
                    safe_number("PM10").alias("PM10"),
                    dust_grade("PM10").alias("DUST_STATUS"))


def keep_first_rows(raw_with_arrival: DataFrame) -> DataFrame:
    """Within a fetch, the first row received per (DATE, STN) wins."""
    firsts = keep_first(raw_with_arrival.select(*RAW_COLUMNS, "arrival"),
                        ["DATE", "STN"], ["arrival"])
    return firsts.select(*RAW_COLUMNS)


def monthly_mean(daily: DataFrame) -> DataFrame:
    """MONTHLY_DUST_AVG_BY_STATION: mean of daily means per station and
    'yyyy-MM' month, exact and rounded half up to 6 decimals (null means skipped; rows whose time did not parse have
    no month and are left out, as a group-by on a missing key leaves them)."""
    return (daily.filter(F.col("kst").isNotNull())
            .withColumn("MONTH", D.month_text("kst"))
            .groupBy("STN_ID", "MONTH")
            .agg(mean_half_up("avg", 6).alias("MONTHLY_AVG")))


def monthly_analytics(monthly: DataFrame, stations: DataFrame) -> DataFrame:
    """MONTHLY_DUST_ANALYTICS: monthly means with station name, MONTH as date."""
    st = stations.select(F.col("STN_ID").cast("string").alias("STN_ID"), "STN_KO")
    j = join_dimension(monthly, st, "STN_ID")
    return j.select("STN_ID", "STN_KO", D.month_to_date("MONTH").alias("MONTH"), "MONTHLY_AVG")
