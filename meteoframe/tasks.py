"""The scheduled jobs, end to end: landed files in, tables out.

One function per job of the original project; each only composes readers
(``sources``), plans and ``sinks``.  Tables are named ``db.table``; landing
paths are folders of feed files.  Run parameters (run date, base date, run
time) are plain arguments - scheduling is left to the scheduler.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe import constants as K
from meteoframe import sinks
from meteoframe.functions import dates as D
from meteoframe.operators.quality import is_empty
from meteoframe.plans import dust, forecast, quake, score, typhoon
from meteoframe.session import configure
from meteoframe.sources import feeds, text

HOURLY_DUST_DDL = "DATE string, ORG string, STN string, PM10 string"
MONTHLY_DDL = "STN_ID string, MONTH string, MONTHLY_AVG double"


# -------------------------------------------------------------------- dust
def load_hourly_dust(spark: SparkSession, landing: str, table: str, encoding: str = "EUC-KR") -> int:
    """Parse landed hourly files, keep the first row per (DATE, STN) of this
    load, append to ``table`` (created if absent).  Returns rows appended
    (0 = empty input, nothing written)."""
    configure(spark)
    rows = dust.keep_first_rows(text.parse_dust(text.read_lines(spark, landing, encoding))
                                .withColumn("arrival", F.struct("file", "pos")))
    rows = rows.checkpoint()  # counted and written: compute once
    n = rows.count()
    if n:
        # partitioned by hour stamp: the hourly rebuild finds the newest one in
        # the partition list and reads that alone
        sinks.create_if_absent(spark, table, HOURLY_DUST_DDL, partitioned_by=["DATE"])
        sinks.append(rows, table)
    return n


def build_hourly_dust_analytics(spark: SparkSession, raw_table: str, station_table: str,
                                out_table: str) -> DataFrame:
    """CREATE OR REPLACE the current-grades table from the raw table (the
    newest snapshot comes from partition metadata when the raw table is
    partitioned by DATE)."""
    configure(spark)
    newest = dust.newest_partition(spark, raw_table, "DATE")
    out = dust.current_grades(spark.table(raw_table), spark.table(station_table), newest)
    sinks.overwrite(out, out_table)
    return spark.table(out_table)


def load_monthly_dust_avg(spark: SparkSession, landing: str, table: str,
                          encoding: str = "EUC-KR") -> int:
    """Daily means of last month -> monthly mean per station; the table is
    truncated and reloaded (only the last month survives)."""
    configure(spark)
    daily = text.parse_daily_mean(text.scan_lines(spark, landing, encoding))
    if is_empty(daily):
        return 0
    monthly = dust.monthly_mean(daily).checkpoint()
    sinks.create_if_absent(spark, table, MONTHLY_DDL)
    sinks.replace_rows(spark, table, monthly, F.lit(True))
    return monthly.count()


def build_monthly_dust_analytics(spark: SparkSession, monthly_table: str, station_table: str,
                                 out_table: str) -> DataFrame:
    configure(spark)
    sinks.overwrite(dust.monthly_analytics(spark.table(monthly_table), spark.table(station_table)),
                    out_table)
    return spark.table(out_table)


def seed_station_master(spark: SparkSession, station_list: str, table: str,
                        encoding: str = "EUC-KR") -> DataFrame:
    """Station list text -> the kept stations -> station master table."""
    configure(spark)
    st = text.parse_stations(text.read_lines(spark, station_list, encoding), keep_ids=K.STATION_KEEP_IDS)
    typed = st.select(*[(F.col(c).try_cast("double") if c in ("LON", "LAT", "HT") else F.col(c)).alias(c)
                        for c in K.STATION_COLUMNS])
    sinks.overwrite(typed, table)
    return spark.table(table)


# ------------------------------------------------------------- earthquakes
def load_earthquakes(spark: SparkSession, xml_landing: str, table: str, first_day: str,
                     last_day: str | None = None, run_ts: str | None = None) -> int:
    """Delete the reports of ``first_day``..``last_day`` (inclusive; one day by
    default, a backfill when longer) from ``table`` and load the landed XML,
    every report of it.  The table is partitioned by event month: other months
    are not read.  Returns the rows now held for the range."""
    configure(spark)
    run_ts = run_ts or dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    rows = quake.with_month(feeds.read_earthquake_xml(spark, xml_landing, run_ts))
    sinks.create_if_absent(spark, table, sinks.ddl(rows), partitioned_by=[quake.MONTH])
    start, _ = D.day_range_bounds(F.lit(first_day))
    _, end = D.day_range_bounds(F.lit(last_day or first_day))
    in_range = D.parse_ts("eqDate", D.STAMP_SECOND).between(start, end)
    day, last, months = dt.date.fromisoformat(first_day), dt.date.fromisoformat(last_day or first_day), set()
    while day <= last:
        months.add(day.strftime("%Y%m"))
        day += dt.timedelta(days=1)
    sinks.replace_rows(spark, table, rows, in_range, quake.MONTH, sorted(months))
    return spark.table(table).filter(F.col(quake.MONTH).isin(sorted(months)) & in_range).count()


def load_earthquakes_day(spark: SparkSession, xml_landing: str, table: str, day: str,
                         run_ts: str | None = None) -> int:
    """The daily load: replace one day's reports."""
    return load_earthquakes(spark, xml_landing, table, day, None, run_ts)


def build_eq_region_tables(spark: SparkSession, raw_table: str, domestic_out: str,
                           foreign_out: str, views: tuple[str, str] | None = None
                           ) -> tuple[DataFrame, DataFrame]:
    """Domestic / foreign source views (stored queries, re-evaluated on
    read) and the two per-region tables (full rebuilds)."""
    configure(spark)
    raw = spark.table(raw_table)
    if views:
        sinks.create_catalog_view(spark, views[0], raw_table, quake.DOMESTIC_SQL)
        sinks.create_catalog_view(spark, views[1], raw_table, quake.FOREIGN_SQL)
    sinks.overwrite(quake.region_latest(quake.domestic(raw)), domestic_out)
    sinks.overwrite(quake.region_max(quake.foreign(raw)), foreign_out)
    return spark.table(domestic_out), spark.table(foreign_out)


def refresh_eq_regions(spark: SparkSession, raw_table: str, state_table: str, domestic_out: str, foreign_out: str,
                       months: list[str | None] | None = None) -> None:
    """The region tables after a change to ``months`` ('yyyyMM' of the event; None
    for reports without a time): only those months of ``raw_table`` are read and
    only their states rewritten; the tables follow from the states of all months.
    Without ``months``, or without a state table, every month is counted."""
    configure(spark)
    raw = spark.table(raw_table)
    states = quake.region_states(raw)
    fresh = not spark.catalog.tableExists(state_table)
    sinks.create_if_absent(spark, state_table, sinks.ddl(states), partitioned_by=[quake.MONTH])
    if fresh or months is None:
        months = sinks.partition_values(raw, quake.MONTH)
        held = sinks.partition_values(spark.table(state_table), quake.MONTH)
    else:
        states = quake.region_states(raw.filter(sinks.in_partitions(quake.MONTH, months)))
        held = months
    version = sinks.new_version(spark, state_table)
    sinks.write_version(states, state_table, version)
    sinks.publish(spark, state_table, version, quake.MONTH, [*months, *held])
    for out, name in zip(quake.regions_from_states(spark.table(state_table)), (domestic_out, foreign_out)):
        sinks.overwrite(out, name)


# ------------------------------------------------------------------ typhoon
def load_typhoon(spark: SparkSession, landing: str, table: str) -> None:
    """Fixed-width listings (one file per fetch stamp) -> cleaned rows ->
    MERGE into ``table`` on (TYP_TM, TYP).  A fetch whose stamp does not
    parse is dropped whole.  The table is partitioned by the month of TYP_TM:
    only the months of the fetch are read and rewritten."""
    configure(spark)
    lines = text.scan_lines(spark, landing)
    raw = feeds.parse_fixed_width(lines, K.TYPHOON_COLUMNS, feeds.TYPHOON_WIDTHS)
    rows = typhoon.with_month(typhoon.clean(raw.withColumnRenamed("file", "batch")))
    sinks.create_if_absent(spark, table, sinks.ddl(rows), partitioned_by=[typhoon.MONTH])
    sinks.upsert_table(spark, table, rows, typhoon.KEYS, typhoon.latest_first(), typhoon.MONTH, ["TYP_TM"])


# ----------------------------------------------------------------- forecast
def load_forecast(spark: SparkSession, json_landing: str, coords_csv: str, table: str,
                  base_date: str, export_base: str | None = None, whole_file: bool = False) -> DataFrame:
    """Forecast responses (one per line, or one per file with ``whole_file``) -> located, pivoted, labelled rows -> retention
    (FCST_DATE < base_date deleted) -> MERGE; optional CSV export to a dated
    folder and a 'latest' copy, with a byte order mark for spreadsheets.

    The table is partitioned by BASE_DATE (part of the merge key): the MERGE
    rewrites only the run's base dates, and retention reads only partitions
    with BASE_DATE < base_date - a forecast date is never before its base
    date, so no other partition can hold an expired row.
    """
    configure(spark)
    items = feeds.read_forecast_json(spark, json_landing, whole_file)
    coords = feeds.read_coordinates(spark, coords_csv)
    wide = forecast.process(forecast.wide(forecast.locate(items, coords)), base_date, others=True).checkpoint()
    rows = wide.select(*forecast.WIDE_COLUMNS)
    sinks.create_if_absent(spark, table, sinks.ddl(rows), partitioned_by=["BASE_DATE"])
    sinks.retain_rows(spark, table, ~(F.col("FCST_DATE") < F.lit(base_date)), "BASE_DATE",
                      F.col("BASE_DATE") < F.lit(base_date))
    sinks.upsert_table(spark, table, rows, forecast.KEYS, order=[("BASE_TIME", False)],
                       partition_col="BASE_DATE")
    if export_base:
        sinks.write_dated_and_latest(wide, export_base, base_date, bom=True)
    return rows


# -------------------------------------------------------------------- score
def weekly_scores(spark: SparkSession, obs_landing: str, region_of_file, holidays: DataFrame,
                  table: str, run_date: str, covered: tuple[str, str],
                  regions: DataFrame | None = None) -> DataFrame:
    """Observation files of all regions -> the seven days before ``run_date``
    ('yyyy-MM-dd') -> weekend/holiday filter -> summary and score -> MERGE
    into ``table`` on (region_code, date = run date); returns the report
    message (one row).  ``covered``: first and last day that ``holidays``
    knows.  ``regions``: region_idx, region_name, region_code.

    ``region_of_file`` maps a landed file path to its region name (a Column
    expression over ``file``, e.g. the folder name)."""
    configure(spark)
    obs = text.parse_observations(text.scan_lines(spark, obs_landing))
    named = obs.withColumn("region_name", region_of_file(F.col("file")))
    regions = feeds.regions(spark) if regions is None else regions
    coded = score.region_codes(named, regions).join(
        regions.select("region_name", "region_idx"), "region_name")
    typed = coded.withColumn("ts", D.parse_ts("timestamp", D.STAMP_MINUTE))
    filtered = score.weekend_or_holiday(score.run_window(typed, run_date), holidays, covered)
    scored = score.scores(score.weekly_summary(filtered, with_days=True, run_date=run_date)).checkpoint()
    rows = score.score_table(scored)
    # partitioned by run date (part of the merge key): a weekly MERGE reads
    # and rewrites only the run dates it touches
    sinks.create_if_absent(spark, table, sinks.ddl(rows), partitioned_by=["date"])
    sinks.upsert_table(spark, table, rows, ["region_code", "date"], partition_col="date")
    top, bottom = score.ranked(scored)
    return score.weekly_message(top, bottom, score.report(scored))


# ---------------------------------------------------------------- streaming
def stream_hourly_dust(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                       encoding: str = "EUC-KR", delay: str = "2 hours") -> dict:
    """Hourly dust files as a stream: each landed file is read once; a
    (DATE, STN) reading delivered again within ``delay`` of its hour (a
    re-run fetch) is dropped, so re-runs no longer duplicate rows; new rows
    are appended to the parquet folder ``table_path``.  Run it on a schedule;
    it stops when the landed files are drained and returns how many rows it
    read, how many came after the watermark and were dropped (``late``), and
    how many keys its state holds."""
    configure(spark)
    from meteoframe.streaming import jobs
    lines = jobs.text_lines_stream(spark, landing, encoding)
    rows = text.parse_dust(lines).withColumn("event_time", D.parse_ts("DATE", D.STAMP_MINUTE))
    # a stamp that does not parse has no event time to wait for: such rows go
    # to a folder of their own
    jobs.run_available(rows.filter(F.col("event_time").isNull()).select(*dust.RAW_COLUMNS), f"{table_path}_rejects", f"{checkpoint}_rejects")
    rows = rows.filter(F.col("event_time").isNotNull())
    deduped = jobs.dedupe_within_watermark(rows, ["DATE", "STN"], "event_time", delay)
    return jobs.run_available(deduped.select(*dust.RAW_COLUMNS), table_path, checkpoint)


def stream_forecast(spark: SparkSession, json_landing: str, coords_csv: str, table: str,
                    base_date: str, checkpoint: str) -> None:
    """Forecast response files as a stream, each micro-batch located,
    pivoted, labelled and merged into ``table`` (the MERGE is idempotent by
    key, so a replayed batch changes nothing)."""
    configure(spark)
    from meteoframe.streaming import jobs
    coords = feeds.read_coordinates(spark, coords_csv)

    def handle(batch: DataFrame, batch_id: int) -> None:
        items = feeds.forecast_items(batch)
        rows = forecast.process(forecast.wide(forecast.locate(items, coords)), base_date).checkpoint()
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        sinks.create_if_absent(batch.sparkSession, table, ddl, partitioned_by=["BASE_DATE"])
        if not is_empty(rows):
            sinks.upsert_table(batch.sparkSession, table, rows, forecast.KEYS,
                               order=[("BASE_TIME", False)], partition_col="BASE_DATE")

    stream = (spark.readStream.schema("value string").option("recursiveFileLookup", True)
              .text(json_landing))
    jobs.run_foreach_batch(stream, handle, checkpoint)
