"""Weekly outdoor score: weekend/holiday observations -> per region-week
summary -> score -> top/bottom report.  All regions and weeks at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from meteoframe import constants as K
from meteoframe.functions import dates as D
from meteoframe.functions.numeric import mean_half_up, null_if_missing, zero_if_missing
from meteoframe.functions.weather import outdoor_score
from meteoframe.operators.joins import join_dimension
from meteoframe.operators.merge import upsert_frame

MEASURES = [("temp", "avg_temp"), ("wind_speed", "wind_speed"),
            ("precipitation", "precipitation"), ("humidity", "humidity"),
            ("ground_temp", "ground_temp"), ("wind_dir", "wind_dir")]
SCORE_COLUMNS = ["region_code", "region_name", "date", "avg_temp", "wind_speed",
                 "precipitation", "humidity", "ground_temp", "wind_dir", "score"]


def observations(raw: DataFrame, regions: DataFrame) -> DataFrame:
    """Feed rows with missing codes applied (-9 -> null, rain -9 -> 0.0) and
    tagged with region name and code (17-row table, broadcast)."""
    code = K.OBS_MISSING
    ts = D.parse_ts("timestamp", D.STAMP_MINUTE)
    obs = raw.select(
        "region_idx", "timestamp", ts.alias("ts"),
        D.fmt_ts(ts, D.READABLE).alias("timestamp_readable"),
        null_if_missing("wind_dir", code).alias("wind_dir"),
        null_if_missing("wind_speed", float(code)).alias("wind_speed"),
        null_if_missing("temp", float(code)).alias("temp"),
        null_if_missing("humidity", float(code)).alias("humidity"),
        zero_if_missing("precipitation", float(code)).alias("precipitation"),
        null_if_missing("ground_temp", float(code)).alias("ground_temp"))
    return join_dimension(obs, regions, "region_idx", bounded=True)


def region_codes(df: DataFrame, regions: DataFrame, name_col: str = "region_name") -> DataFrame:
    """Attach the station code for each region name (17-row table,
    broadcast).  An unknown name is an error, raised inside the same job
    (``raise_error``) instead of a separate anti-join pass."""
    codes = regions.select(F.col("region_name").alias(name_col), F.col("region_code").alias("_code"))
    j = join_dimension(df, codes, name_col, how="left", bounded=True)
    code = F.when(F.col("_code").isNull(),
                  F.raise_error(F.concat(F.lit("unsupported region: "), F.col(name_col).cast("string"))))
    return j.withColumn("region_code", code.otherwise(F.col("_code"))).drop("_code")


def day_flags(obs: DataFrame, holidays: DataFrame, covered: tuple[str, str] | None = None) -> DataFrame:
    """day, weekday (Mon = 0), is_holiday (calendar membership by a left join
    on the date) and the day tag.  ``covered`` states the first and last day
    that the calendar knows; a reading outside it fails the job, because its
    holidays are not known."""
    day = F.to_date("ts")
    if covered is not None:
        first, last = (F.lit(d).cast("date") for d in covered)
        day = F.when((day < first) | (day > last), F.raise_error(F.concat(
            F.lit("no holiday calendar for "), day.cast("string")))).otherwise(day)
    d = obs.withColumn("day", day)
    cal = holidays.select(F.col("holiday").alias("day"), F.lit(True).alias("is_holiday")).distinct()
    j = join_dimension(d, cal, "day", how="left")
    hol = F.coalesce(F.col("is_holiday"), F.lit(False))
    return (j.withColumn("is_holiday", hol)
            .withColumn("weekday", D.weekday("day"))
            .withColumn("day_tag", F.when(hol, K.DAY_TAG_HOLIDAY)
                        .when(F.col("weekday") >= 5, K.DAY_TAG_WEEKEND)
                        .otherwise(K.DAY_TAG_WEEKDAY)))


def weekend_or_holiday(obs: DataFrame, holidays: DataFrame, covered: tuple[str, str] | None = None) -> DataFrame:
    f = day_flags(obs, holidays, covered)
    return f.filter((F.col("weekday") >= 5) | F.col("is_holiday"))


def run_window(obs: DataFrame, run_date: str) -> DataFrame:
    """The readings a run on ``run_date`` ('yyyy-MM-dd') asks for: the seven
    days before it."""
    first, last = (D.parse_ts(t, D.STAMP_MINUTE) for t in D.last_week_range(F.lit(run_date).cast("date")))
    return obs.filter(F.col("ts").between(first, last + F.expr("INTERVAL 59 MINUTES")))


def weekly_summary(filtered: DataFrame, with_days: bool = False, run_date: str | None = None) -> DataFrame:
    """Per region and week: six null-skipping means rounded half up to 2
    decimals, newest reading time and the row count.  One hash aggregate with
    map-side combine (the newest time is kept as a timestamp and formatted
    afterwards).

    Without ``run_date`` every Monday-to-Sunday week is summed up; with it the
    rows are one run's window and ``week_start`` is its first day.

    ``with_days`` also gathers the week's distinct analysed days with their
    tags in the same aggregate (``_days``: at most 7 entries, deduplicated
    map-side), for the report lines - no second pass over the readings.
    """
    aggs = [mean_half_up(src).alias(out) for src, out in MEASURES]
    if with_days:
        aggs.append(F.collect_set(F.struct("day", "day_tag")).alias("_days"))
    start = D.week_start("ts") if run_date is None else F.date_sub(F.lit(run_date).cast("date"), 7)
    g = (filtered.withColumn("week_start", start)
         .groupBy("region_code", "region_name", "region_idx", "week_start")
         .agg(*aggs, F.max("ts").alias("_last_ts"),  # fixed-width: keeps the aggregate hash-based
              F.count(F.lit(1)).alias("n_records")))
    return g.select("region_code", "region_name", "region_idx", "week_start", *[o for _, o in MEASURES],
                    D.fmt_ts("_last_ts", D.READABLE).alias("last_updated"), "n_records",
                    *(["_days"] if with_days else []))


def scores(summary: DataFrame) -> DataFrame:
    """Outdoor score per region-week; ``date`` is the run date (the day after
    the week)."""
    return summary.withColumn(
        "score", outdoor_score("avg_temp", "humidity", "precipitation", "wind_speed", "ground_temp")
    ).withColumn("date", F.date_add("week_start", 7))


def ranked(scored: DataFrame, k: int = 3) -> tuple[DataFrame, DataFrame]:
    """Top-k and bottom-k regions of every week's run.

    Order: score descending, then region position (a stable sort keeps the
    region list order).  Bottom-k is the last k of that same order, numbered
    in it.  Regions without a score are left out.  Each week holds at most
    the 17 regions, so the per-week window is bounded.
    """
    s = scored.filter(F.col("score").isNotNull())
    fwd = Window.partitionBy("week_start").orderBy(F.col("score").desc(), F.col("region_idx").asc())
    back = Window.partitionBy("week_start").orderBy(F.col("score").asc(), F.col("region_idx").desc())
    s = s.withColumn("_pos", F.row_number().over(fwd)).withColumn("_back", F.row_number().over(back))
    top = s.filter(F.col("_pos") <= k).withColumn("rank", F.col("_pos"))
    bottom = s.filter(F.col("_back") <= k)
    bottom = bottom.withColumn("rank", F.row_number().over(
        Window.partitionBy("week_start").orderBy(F.col("score").desc(), F.col("region_idx").asc())))
    return top.drop("_pos", "_back"), bottom.drop("_pos", "_back")


def day_lines(days) -> "Column":
    """The analysed days ('_days' from ``weekly_summary(with_days=True)``) as
    'MM-dd (weekday) - tag' lines, sorted by day and joined with '\\n- '."""
    def line(x):
        return F.format_string("%s (%s) - %s", F.date_format(x["day"], "MM-dd"),
                               D.weekday_label(x["day"]), x["day_tag"])
    return F.array_join(F.transform(F.sort_array(F.col(days) if isinstance(days, str) else days), line),
                        "\n- ")


def _num_text(c):
    """Python-like text of a summary value: None when missing."""
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def report(scored: DataFrame) -> DataFrame:
    """The per-region message block of the weekly report (``scored`` built
    from ``weekly_summary(with_days=True)``)."""
    j = scored.withColumn("target_days", day_lines("_days"))
    period = F.concat(F.date_format("week_start", "yyyy-MM-dd"), F.lit(" ~ "),
                      F.date_format(F.date_add("week_start", 6), "yyyy-MM-dd"))
    msg = F.format_string(
        K.REPORT_BLOCK,
        F.col("region_name"), period, F.col("target_days"), _num_text("score"),
        _num_text("avg_temp"), _num_text("wind_speed"), _num_text("precipitation"),
        _num_text("humidity"), _num_text("ground_temp"), _num_text("wind_dir"))
    return j.select("region_code", "week_start", "target_days", msg.alias("message"))


def _period(week_start):
    return F.concat(F.date_format(week_start, "yyyy-MM-dd"), F.lit(" ~ "),
                    F.date_format(F.date_add(week_start, 6), "yyyy-MM-dd"))


def weekly_message(top: DataFrame, bottom: DataFrame, blocks: DataFrame) -> DataFrame:
    """One report per week: title, the top-k blocks and the bottom-k blocks,
    each numbered in score order and separated by a divider line.  Each
    section gathers at most k blocks per week."""
    def section(ranked: DataFrame, name: str) -> DataFrame:
        j = ranked.select("week_start", "rank", "region_code", "region_name").join(
            blocks.select("week_start", "region_code", "message"), ["week_start", "region_code"])
        piece = F.concat(F.lit("\n"), F.format_string(K.REPORT_RANK, F.col("rank"), F.col("region_name")),
                         F.lit("\n"), F.col("message"))
        return (j.groupBy("week_start")
                .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", piece.alias("p")))),
                                              lambda x: x["p"]), "\n" + K.REPORT_DIVIDER + "\n").alias(name)))
    rule = K.REPORT_RULE
    both = section(top, "top").join(section(bottom, "bottom"), "week_start")
    msg = F.concat(F.format_string(K.REPORT_TITLE, _period(F.col("week_start"))),
                   F.lit(f"\n\n{rule}\n{K.REPORT_TOP}\n{rule}\n"), F.col("top"),
                   F.lit(f"\n\n{rule}\n{K.REPORT_BOTTOM}\n{rule}\n"), F.col("bottom"))
    return both.select("week_start", msg.alias("message"))


def score_table(scored: DataFrame) -> DataFrame:
    return scored.select(*SCORE_COLUMNS)


def upsert(target: DataFrame, source: DataFrame) -> DataFrame:
    """MERGE ON (region_code, date)."""
    return upsert_frame(target, source, ["region_code", "date"])
