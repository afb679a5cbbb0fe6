"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each reads the driver's parquet tables through the stand-ins in
``meteoframe.sources.standins`` and runs one of the feed plans over the
whole tables.  ``meteoframe.oracle`` holds the DuckDB SQL twin of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe import constants as K
from meteoframe.functions import dates as D
from meteoframe.operators import grids as G
from meteoframe.operators import quality as Q
from meteoframe.functions.numeric import mean_half_up, sentinel_to_null
from meteoframe.operators.batches import drop_bad_batches, observe_counts, union_all
from meteoframe.operators.reshape import duplicate_keys
from meteoframe.plans import dust, forecast, holidays, quake, score, typhoon
from meteoframe.session import scratch_path
from meteoframe.sources import feeds, standins as S

# Run parameters (what a scheduled run would pass in).
FORECAST_BASE_DATE = "20240115"
QUAKE_REPLACE_DAY = "1998-08-02"
RUN_TS = "2024-02-01 00:00:00"


# ------------------------------------------------------------------- dust
def dust_current_grades(spark: SparkSession, d: str) -> DataFrame:
    return dust.current_grades(S.hourly_dust(spark, d), S.station_master(spark, d))


def dust_keep_first(spark, d):
    return dust.keep_first_rows(S.hourly_dust(spark, d, with_arrival=True))


def dust_monthly_mean(spark, d):
    return dust.monthly_mean(S.daily_dust_mean(spark, d))


def dust_monthly_dated(spark, d):
    return dust.monthly_analytics(dust.monthly_mean(S.daily_dust_mean(spark, d)),
                                  S.station_master(spark, d))


# ------------------------------------------------------------- earthquakes
def quake_domestic(spark, d):
    return quake.domestic(S.raw_eq_world(spark, d))


def quake_foreign(spark, d):
    return quake.foreign(S.raw_eq_world(spark, d))


def quake_region_latest(spark, d):
    return quake.region_latest(quake.domestic(S.raw_eq_world(spark, d)))


def quake_region_max(spark, d):
    return quake.region_max(quake.foreign(S.raw_eq_world(spark, d)))


def quake_day_replace(spark, d):
    raw = S.raw_eq_world(spark, d)
    start, end = D.day_range_bounds(F.lit(QUAKE_REPLACE_DAY))
    ts = D.parse_ts("eqDate", D.STAMP_SECOND)
    reload = (raw.filter(ts.between(start, end))
              .withColumn("reFer", F.lit("reloaded"))
              .withColumn("updated_at", F.to_timestamp(F.lit("2024-02-02 08:00:00")).cast("timestamp_ntz")))
    return quake.replace_day(raw, reload, QUAKE_REPLACE_DAY)


# ----------------------------------------------------------------- typhoon
def typhoon_clean(spark, d):
    return typhoon.clean(S.raw_typhoon(spark, d))


def _typhoon_target_source(spark, d):
    # the cleaned table is stored once (as RAW_TYPHOON would be) and both the
    # merge target and the new fetch are read from it
    c = typhoon.clean(S.raw_typhoon(spark, d)).checkpoint()
    target = c.filter(F.col("TYP_TM") < F.lit("1998-01-01").cast("timestamp_ntz"))
    source = (c.filter(F.col("TYP_TM") >= F.lit("1997-06-01").cast("timestamp_ntz"))
              .withColumn("WS", F.col("WS") + 1))
    return target, source


def typhoon_upsert(spark, d):
    target, source = _typhoon_target_source(spark, d)
    return typhoon.upsert(target, source)


def bad_batch_drop(spark, d):
    raw = S.raw_typhoon(spark, d)
    bad = F.col("TYP_TM").isNotNull() & D.parse_ts("TYP_TM", D.STAMP_MINUTE).isNull()
    return drop_bad_batches(raw, "batch", bad).select("TYP", "TYP_TM", "batch")


# ---------------------------------------------------------------- forecast
def _forecast_long(spark, d):
    return forecast.locate(S.forecast_items(spark, d), S.coordinates(spark, d))


def forecast_wide(spark, d):
    return forecast.wide(_forecast_long(spark, d))


def _processed(spark, d, base=FORECAST_BASE_DATE):
    return forecast.process(forecast.wide(_forecast_long(spark, d)), base)


def forecast_labels(spark, d):
    return _processed(spark, d).select("BASE_DATE", "BASE_TIME", "FCST_DATE", "FCST_TIME", "NX", "NY",
                                       "LOCATION", "BROAD_LOCATION", "WSD", "SKY", "PTY",
                                       "STRONG_WIND_ALERT")


def forecast_all_categories(spark, d):
    """The export's rows: every category of the feed."""
    return forecast.process(forecast.wide(_forecast_long(spark, d)), FORECAST_BASE_DATE, others=True)


def forecast_discomfort(spark, d):
    return _processed(spark, d).select("FCST_DATE", "FCST_TIME", "LOCATION", "TMP", "REH",
                                       "DI", "DISCOMFORT_ALERT")


def _forecast_target_source(spark, d):
    # stored once, as the forecast table would be; target and new run read it
    p = _processed(spark, d, "20240101").checkpoint()
    target = p.filter(F.col("FCST_DATE") <= "20240120")
    source = (p.filter(F.col("FCST_DATE") >= "20240115")
              .withColumn("BASE_TIME", F.lit("1100"))
              .withColumn("WSD", F.col("WSD") + 0.5))
    return target, source


def forecast_upsert(spark, d):
    target, source = _forecast_target_source(spark, d)
    return forecast.upsert(target, source)


def forecast_retention(spark, d):
    p = _processed(spark, d, "20240101")
    return forecast.retention(p, FORECAST_BASE_DATE)


# ------------------------------------------------------------------- score
def _obs(spark, d):
    return score.observations(S.observations_raw(spark, d), feeds.regions(spark))


def _filtered(spark, d):
    return score.weekend_or_holiday(_obs(spark, d), S.holidays(spark), K.HOLIDAY_RANGE)


def holiday_filter(spark, d):
    return _filtered(spark, d).select("region_code", "timestamp", "timestamp_readable", "weekday",
                                      "is_holiday", "day_tag")


def weekly_summary(spark, d):
    return score.weekly_summary(_filtered(spark, d)).drop("region_idx")


def _scored(spark, d):
    return score.scores(score.weekly_summary(_filtered(spark, d)))


def outdoor_score(spark, d):
    return _scored(spark, d).select("region_code", "week_start", "avg_temp", "humidity",
                                    "precipitation", "wind_speed", "ground_temp", "score")


def score_top3(spark, d):
    top, _ = score.ranked(_scored(spark, d))
    return top.select("week_start", "rank", "region_name", "region_code", "score")


def score_bottom3(spark, d):
    _, bottom = score.ranked(_scored(spark, d))
    return bottom.select("week_start", "rank", "region_name", "region_code", "score")


def score_report(spark, d):
    return score.report(score.scores(score.weekly_summary(_filtered(spark, d), with_days=True)))


def score_message(spark, d):
    # one row per region-week, used three times: materialize it once (reliable
    # checkpoint in the shared folder) instead of recomputing from the readings
    scored = score.scores(score.weekly_summary(_filtered(spark, d), with_days=True)).checkpoint()
    top, bottom = score.ranked(scored)
    return score.weekly_message(top, bottom, score.report(scored))


def score_upsert(spark, d):
    # the region-week table feeds both sides of the merge: materialize it once
    table = score.score_table(_scored(spark, d)).checkpoint()
    target = table.filter(F.col("date") <= F.lit("2024-01-22").cast("date"))
    source = table.withColumn("region_name", F.concat("region_name", F.lit("*")))
    return score.upsert(target, source)


# run dates: a Sunday, as the weekly schedule has it, and a Monday
WEEKLY_RUNS = ["2024-01-14", "2024-01-22"]


def weekly_scores_by_run(spark, d):
    """One run's seven days before its date, for each of the run dates."""
    out = None
    for run in WEEKLY_RUNS:
        rows = score.weekend_or_holiday(score.run_window(_obs(spark, d), run), S.holidays(spark), K.HOLIDAY_RANGE)
        one = score.score_table(score.scores(score.weekly_summary(rows, run_date=run)))
        out = one if out is None else out.unionByName(one)
    return out


def dq_empty(spark, d):
    """Q5 per region-week: weeks with no weekend/holiday rows are skipped."""
    obs = _obs(spark, d).withColumn("week_start", D.week_start("ts"))
    weeks = obs.select("region_code", "week_start").distinct()
    kept = (_filtered(spark, d).withColumn("week_start", D.week_start("ts"))
            .groupBy("region_code", "week_start").agg(F.count(F.lit(1)).alias("n_rows")))
    j = weeks.join(kept, ["region_code", "week_start"], "left")
    n = F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint")
    return j.select("region_code", "week_start", n.alias("n_rows"), (n == 0).alias("skipped"))


# ------------------------------------------------------------------- grids
def _run_dates(spark, d):
    return S.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()


def time_grid_6h(spark, d):
    r = _run_dates(spark, d)
    return G.expand_grid(r, F.date_sub("run_date", 3), "run_date", K.TYPHOON_HOURS, 1)


def time_grid_step(spark, d):
    r = _run_dates(spark, d)
    return G.expand_grid(r, F.date_sub("run_date", 3), "run_date", K.TYPHOON_HOURS, 3)


def month_days(spark, d):
    o = S.table(spark, d, "orders").select(F.trunc("o_orderdate", "MM").alias("run_month")).distinct()
    return o.select("run_month", F.explode(G.month_days("run_month")).alias("day"))


# --------------------------------------------------------------- time text
def ts_formats(spark, d):
    """Every order time written in each feed layout and parsed back (F22,
    F23, F24, F31); an unparsable text (hour 24) parses to null."""
    o = S.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    t = F.col("o_orderdate")
    minute = D.fmt_ts(t, D.STAMP_MINUTE)
    station = D.fmt_ts(t, D.STATION_STAMP)
    second = D.fmt_ts(t, D.STAMP_SECOND)
    bad = F.concat(F.date_format(t, "yyyyMMdd"), F.lit("2400"))
    return o.select(
        "o_orderkey", minute.alias("minute_text"), station.alias("station_text"),
        second.alias("second_text"), D.ts_text(t).alias("iso_text"),
        D.fmt_ts(t, D.READABLE).alias("readable"), D.hour_stamp(t).alias("hour_stamp"),
        D.month_text(t).alias("month_text"), F.date_format(t, "yyyyMMdd").alias("day_text"),
        D.parse_ts(minute, D.STAMP_MINUTE).alias("from_minute"),
        D.parse_ts(station, D.STATION_STAMP).alias("from_station"),
        D.parse_ts(second, D.STAMP_SECOND).alias("from_second"),
        D.parse_ts(bad, D.STAMP_MINUTE).alias("from_hour24"))


def week_window(spark, d):
    """Per run date (every event day): last week's request window text,
    the previous month's bounds and the day's [start, end] range (F26, F27)."""
    days = S.table(spark, d, "events").select(F.to_date("ts").alias("run_date")).distinct()
    tm1, tm2 = D.last_week_range(F.col("run_date"))
    first, last = D.previous_month_bounds(F.col("run_date"))
    start, end = D.day_range_bounds(F.col("run_date"))
    return days.select("run_date", tm1.alias("tm1"), tm2.alias("tm2"), first.alias("prev_month_first"),
                       last.alias("prev_month_last"), start.alias("day_start"), end.alias("day_end"))


# ------------------------------------------------------------------ quality
def dq_unique(spark, d):
    return Q.unique_violations(S.hourly_dust(spark, d), ["DATE", "STN"])


def dq_not_null(spark, d):
    return Q.not_null_violations(_obs(spark, d), "ground_temp").select("region_code", "timestamp")


def dq_pivot_key(spark, d):
    ev = S.table(spark, d, "events")
    # the raw long rows before the per-hour maximum: repeated keys expected
    long = ev.select(F.date_format("ts", "yyyyMMdd").alias("fcstDate"),
                     F.concat(F.date_format("ts", "HH"), F.lit("00")).alias("fcstTime"),
                     (F.col("user_id") % 5).cast("int").alias("nx"),
                     (F.col("user_id") % 3).cast("int").alias("ny"),
                     F.col("event_type").alias("category"))
    return duplicate_keys(long, ["fcstDate", "fcstTime", "nx", "ny", "category"])


def dq_freshness(spark, d):
    ev = S.table(spark, d, "events")
    return Q.freshness(ev, "ts", RUN_TS, 24.0, by=["event_type"])


# ------------------------------------------------------------- edge values
def newest_snapshot_null_day(spark, d):
    """The hourly table partitioned by day as an integer, a tenth of its rows
    without one: rows of the newest day, found from partition metadata."""
    base = scratch_path(spark, "null-day")
    raw = S.hourly_dust(spark, d, with_arrival=True)
    rows = raw.select(F.when(F.col("arrival") % 10 != 0, F.datediff("event_time", F.lit("2023-12-01").cast("date"))).alias("DAY"),
                      "ORG", "STN", "PM10")
    name = "dust_" + base.rsplit("-", 1)[-1]
    rows.write.partitionBy("DAY").option("path", base).saveAsTable(name)
    newest = dust.newest_partition(spark, name, "DAY")
    out = dust.latest_snapshot(spark.read.schema(rows.schema).parquet(base), "DAY", newest)
    spark.sql(f"DROP TABLE {name}")
    return out


def sentinel_forms(spark, d):
    """Every order with a missing-value code in one of its spellings."""
    o = S.table(spark, d, "orders")
    forms = F.array(*[F.lit(x) for x in ("-9", "-09", "-9.0", " -99 ", "-999.00", "-9e0", "9", "-90", "-9x", "")])
    text = F.element_at(forms, (F.col("o_orderkey") % 10 + 1).cast("int"))
    return o.select("o_orderkey", sentinel_to_null(text, K.TYPHOON_SENTINELS).alias("value"))


def mean_three_decimals(spark, d):
    """Means of values with three decimals (nothing is rounded on the way in),
    and of groups that hold one huge value."""
    li = S.table(spark, d, "lineitem")
    small = F.col("l_orderkey") % 1000 / 1000
    huge = F.when((F.col("l_suppkey") == 1) & (F.col("l_linenumber") == 1), F.lit(1e300)).otherwise(small)
    return li.groupBy("l_suppkey").agg(mean_half_up(small, 3).alias("mean_small"), (mean_half_up(huge, 3) > 1e290).alias("has_huge"))


def region_lookup(spark, d):
    """Station codes of region names, by the table that scores use."""
    obs = _obs(spark, d).select("region_name", "timestamp")
    return score.region_codes(obs, feeds.regions(spark)).groupBy("region_code", "region_name").agg(F.count(F.lit(1)).alias("n"))


def load_counts(spark, d):
    """Rows and rejected rows of a load, counted while it is written; and the
    load joined from two frames, one of them empty."""
    base = scratch_path(spark, "load-counts")
    raw = S.hourly_dust(spark, d)
    both = union_all([raw, raw.limit(0).withColumn("note", F.lit("x"))])
    counted, seen = observe_counts(both, "load", blank=F.col("PM10") == "", errors=F.col("ORG") == "error")
    counted.write.parquet(base)
    return feeds.inline_rows(spark, [(k, v) for k, v in sorted(seen.get.items())], "what string, n bigint")


# ------------------------------------------------------------- misc shapes
def null_union(spark, d):
    ids = S.table(spark, d, "customer").select(F.col("c_custkey").cast("int").alias("id"))
    nulls = feeds.inline_rows(spark, [(None,)], "id int")  # select null as id
    return ids.unionByName(nulls)


def null_union_filter(spark, d):
    return null_union(spark, d).filter(F.col("id") == 1)


def shape_columns(spark, d):
    dom = quake.domestic(S.raw_eq_world(spark, d))
    r = dom.select("*", quake.region_of().alias("region"))
    sel = r.select("region", F.col("eqDate").alias("eq_date"),
                   F.col("magMl").alias("mag_ml"),
                   F.to_timestamp(F.lit(RUN_TS)).cast("timestamp_ntz").alias("loaded_at"))
    return sel.toDF(*[c.upper() for c in sel.columns])


def preview(spark, d):
    return quake.by_count(quake.region_latest(quake.domestic(S.raw_eq_world(spark, d)))).limit(5)


def holiday_calendar(spark, d):
    """Every order given a day of the calendar's years; how many fall on each
    holiday."""
    first, last = holidays.covered()
    days = F.date_diff(F.lit(last).cast("date"), F.lit(first).cast("date")) + 1
    placed = S.table(spark, d, "orders").select(F.date_add(F.lit(first).cast("date"), (F.col("o_orderkey") * 31 % days).cast("int")).alias("holiday"))
    return holidays.calendar(spark).join(placed.groupBy("holiday").agg(F.count(F.lit(1)).alias("n")), "holiday", "left").select(
        "holiday", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def dq_suite(spark, d):
    """A table's whole suite in one scan: unique keys, nulls, newest day."""
    li = S.table(spark, d, "lineitem").withColumn("l_note", F.when(F.col("l_linenumber") % 3 > 0, F.col("l_returnflag")))
    return Q.suite(li, unique=["l_orderkey", "l_linenumber"], not_null=["l_note", "l_shipdate", "l_orderkey"], newest="l_shipdate")


QUERIES = {
    "dust_current_grades": dust_current_grades,
    "dust_keep_first": dust_keep_first,
    "dust_monthly_mean": dust_monthly_mean,
    "dust_monthly_dated": dust_monthly_dated,
    "quake_domestic": quake_domestic,
    "quake_foreign": quake_foreign,
    "quake_region_latest": quake_region_latest,
    "quake_region_max": quake_region_max,
    "quake_day_replace": quake_day_replace,
    "typhoon_clean": typhoon_clean,
    "typhoon_upsert": typhoon_upsert,
    "bad_batch_drop": bad_batch_drop,
    "forecast_wide": forecast_wide,
    "forecast_labels": forecast_labels,
    "forecast_discomfort": forecast_discomfort,
    "forecast_upsert": forecast_upsert,
    "forecast_retention": forecast_retention,
    "holiday_filter": holiday_filter,
    "weekly_summary": weekly_summary,
    "outdoor_score": outdoor_score,
    "score_top3": score_top3,
    "score_bottom3": score_bottom3,
    "score_report": score_report,
    "score_message": score_message,
    "score_upsert": score_upsert,
    "weekly_scores_by_run": weekly_scores_by_run,
    "forecast_all_categories": forecast_all_categories,
    "newest_snapshot_null_day": newest_snapshot_null_day,
    "sentinel_forms": sentinel_forms,
    "mean_three_decimals": mean_three_decimals,
    "region_lookup": region_lookup,
    "load_counts": load_counts,
    "dq_empty": dq_empty,
    "ts_formats": ts_formats,
    "week_window": week_window,
    "time_grid_6h": time_grid_6h,
    "time_grid_step": time_grid_step,
    "month_days": month_days,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_pivot_key": dq_pivot_key,
    "dq_freshness": dq_freshness,
    "null_union": null_union,
    "null_union_filter": null_union_filter,
    "shape_columns": shape_columns,
    "preview": preview,
    "holiday_calendar": holiday_calendar,
    "dq_suite": dq_suite,
}


def all_queries():
    from meteoframe.landing import ROUNDTRIP_QUERIES
    from meteoframe.streaming.queries import STREAM_QUERIES
    out = dict(QUERIES)
    out.update(ROUNDTRIP_QUERIES)
    out.update(STREAM_QUERIES)
    return out
