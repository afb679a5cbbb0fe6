"""End-to-end jobs: feeds landed as files (rendered from the sf0.001 tables),
loaded into tables, analytics rebuilt - compared with the registered queries."""

import uuid

from pyspark.sql import functions as F

from meteoframe import constants as K, registry, tasks
from meteoframe.plans import dust
from meteoframe.landing import _station_lines
from meteoframe.sources import feeds, render, standins as S

SF = "/root/testdata/sf0.001"


def _db(spark, tmp_dir):
    name = "jobs_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_dir}/{name}'")
    return name


def _rows(df):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in df.collect())


def test_dust_jobs(spark, tmp_dir):
    db = _db(spark, tmp_dir)
    raw = S.hourly_dust(spark, SF, with_arrival=True)
    lines = raw.select(F.concat_ws(" ", "DATE", "ORG", "STN", "PM10").alias("value"), "arrival")
    render.write_lines(lines, tmp_dir + "/dust", "EUC-KR", partitions=1, order="arrival")
    n = tasks.load_hourly_dust(spark, tmp_dir + "/dust", f"{db}.hourly_dust")
    assert n == raw.select("DATE", "STN").distinct().count()
    assert _rows(spark.table(f"{db}.hourly_dust").select(*dust.RAW_COLUMNS)) == _rows(registry.dust_keep_first(spark, SF))
    render.write_lines(_station_lines(spark, SF).select("value", "f", "o"), tmp_dir + "/stn", "EUC-KR",
                       by="f", order=["f", "o"], partitions=4)
    st = tasks.seed_station_master(spark, tmp_dir + "/stn", f"{db}.station_master")
    assert sorted(r.STN_ID for r in st.collect()) == sorted(
        r.STN_ID for r in S.station_master(spark, SF).filter(F.col("STN_ID").isin(K.STATION_KEEP_IDS)).collect())


def test_typhoon_and_earthquake_jobs(spark, tmp_dir):
    db = _db(spark, tmp_dir)
    raw = S.raw_typhoon(spark, SF)
    fetches = raw.select("batch", F.concat(*[
        F.lpad(F.coalesce(F.col(n).cast("string"), F.lit("")), w, " ")
        for n, w in zip(K.TYPHOON_COLUMNS, render.feeds.TYPHOON_WIDTHS)]).alias("value"))
    render.write_lines(fetches, tmp_dir + "/ty", by="batch")  # one file per fetch stamp
    tasks.load_typhoon(spark, tmp_dir + "/ty", f"{db}.raw_typhoon")
    once = _rows(spark.table(f"{db}.raw_typhoon"))
    tasks.load_typhoon(spark, tmp_dir + "/ty", f"{db}.raw_typhoon")  # rerun: same table
    assert _rows(spark.table(f"{db}.raw_typhoon")) == once
    # fetches holding an unparsable stamp are dropped whole; the rest merge by key
    clean = registry.typhoon_clean(spark, SF)
    assert len(once) == clean.select("TYP_TM", "TYP").distinct().count()
    eq = S.raw_eq_world(spark, SF)
    day = "1998-08-02"
    of_day = eq.filter(F.substring("eqDate", 1, 8) == day.replace("-", ""))
    undated = of_day.limit(1).withColumn("eqDate", F.lit(None).cast("string"))
    render.write_eq_xml(of_day.unionByName(undated), tmp_dir + "/eq-day")
    n = tasks.load_earthquakes_day(spark, tmp_dir + "/eq-day", f"{db}.raw_eq_world", day, "2024-02-01 08:00:00")
    want = of_day.count()
    assert n == want == spark.table(f"{db}.raw_eq_world").count() - 1   # the report without time is loaded too
    render.write_eq_xml(of_day, tmp_dir + "/eq-again")
    assert tasks.load_earthquakes_day(spark, tmp_dir + "/eq-again", f"{db}.raw_eq_world", day, "2024-02-01 08:00:00") == want
    dom, fgn = tasks.build_eq_region_tables(spark, f"{db}.raw_eq_world", f"{db}.eq_do", f"{db}.eq_fo",
                                            views=(f"{db}.src_eq_do", f"{db}.src_eq_fo"))
    assert dom.count() >= 0 and fgn.count() >= 0
    assert spark.table(f"{db}.src_eq_do").count() == spark.table(f"{db}.raw_eq_world").filter(
        "nkDiv = 'N' AND cntDiv = 'Y' AND msgCode = '지진정보'").count()
    render.write_eq_xml(eq.filter(F.substring("eqDate", 1, 6) == "199808"), tmp_dir + "/eq")
    # a backfill over a range, then the same range again: same table
    n = tasks.load_earthquakes(spark, tmp_dir + "/eq", f"{db}.raw_eq_world", "1998-08-01", "1998-08-31",
                               "2024-02-01 08:00:00")
    want = eq.filter(F.substring("eqDate", 1, 6) == "199808").count()
    assert n == want
    assert tasks.load_earthquakes(spark, tmp_dir + "/eq", f"{db}.raw_eq_world", "1998-08-01", "1998-08-31",
                                  "2024-02-01 08:00:00") == want
    assert spark.table(f"{db}.raw_eq_world").count() == want + 1


def test_forecast_and_score_jobs(spark, tmp_dir):
    db = _db(spark, tmp_dir)
    items = S.forecast_items(spark, SF)
    render.write_lines(render.forecast_responses(items), tmp_dir + "/fc")
    from meteoframe import sinks
    sinks.write_csv(S.coordinates(spark, SF), tmp_dir + "/coords")
    rows = tasks.load_forecast(spark, tmp_dir + "/fc", tmp_dir + "/coords", f"{db}.forecast", "20240115",
                               export_base=tmp_dir + "/export")
    table = spark.table(f"{db}.forecast")
    assert rows.count() == registry.forecast_labels(spark, SF).count()
    # MERGE keeps one row per key (two locations can share a name)
    assert table.count() == rows.select(*tasks.forecast.KEYS).distinct().count()
    # a later run: expired forecasts leave, only old base-date partitions are touched
    tasks.load_forecast(spark, tmp_dir + "/fc", tmp_dir + "/coords", f"{db}.forecast", "20240122")
    later = spark.table(f"{db}.forecast")
    assert later.filter("FCST_DATE < '20240122'").count() == 0
    assert later.count() == rows.filter("FCST_DATE >= '20240122'").select(*tasks.forecast.KEYS).distinct().count()
    # observation files, one folder per region
    obs = S.observations_raw(spark, SF).join(feeds.regions(spark), "region_idx")
    toks = ([F.col("timestamp"), F.col("region_code"), F.col("wind_dir").cast("string"),
             F.col("wind_speed").cast("string")] + [F.lit("0")] * 7 +
            [F.col("temp").cast("string"), F.lit("0"), F.col("humidity").cast("string"), F.lit("0"),
             F.col("precipitation").cast("string")] + [F.lit("0")] * 21 + [F.col("ground_temp").cast("string")])
    lines = obs.select(F.concat_ws(" ", *toks).alias("value"), "region_name")
    render.write_lines(lines, tmp_dir + "/obs", by="region_name", partitions=4)
    region_of = lambda f: F.regexp_extract(F.url_decode(f), "region_name=([^/]+)/", 1)
    for run in registry.WEEKLY_RUNS:
        msgs = tasks.weekly_scores(spark, tmp_dir + "/obs", region_of, S.holidays(spark), f"{db}.weather_score", run, K.HOLIDAY_RANGE)
        assert msgs.count() == 1
    cols = registry.score.SCORE_COLUMNS
    assert _rows(spark.table(f"{db}.weather_score").select(*cols)) == _rows(registry.weekly_scores_by_run(spark, SF))


def test_monthly_and_analytics_jobs(spark, tmp_dir):
    db = _db(spark, tmp_dir)
    m = S.daily_dust_mean(spark, SF)
    lines = m.select(F.concat_ws(" ", F.date_format("kst", "yyyy.MM.dd.HH:mm"), F.lit("ORG1"), "STN_ID",
                                 F.concat(F.col("avg").cast("decimal(12,2)").cast("string"), F.lit("(24)")),
                                 F.lit("0"), F.lit("0")).alias("value"))
    render.write_lines(lines, tmp_dir + "/avg", "EUC-KR")
    n = tasks.load_monthly_dust_avg(spark, tmp_dir + "/avg", f"{db}.monthly")
    assert n == registry.dust_monthly_mean(spark, SF).count()
    assert tasks.load_monthly_dust_avg(spark, tmp_dir + "/avg", f"{db}.monthly") == n  # truncate + load
    assert spark.table(f"{db}.monthly").count() == n
    st = f"{db}.stations"
    S.station_master(spark, SF).write.saveAsTable(st, path=tmp_dir + "/stations")
    out = tasks.build_monthly_dust_analytics(spark, f"{db}.monthly", st, f"{db}.monthly_analytics")
    assert _rows(out) == _rows(registry.dust_monthly_dated(spark, SF))
    raw = f"{db}.hourly"
    S.hourly_dust(spark, SF).write.saveAsTable(raw, path=tmp_dir + "/hourly")
    grades = tasks.build_hourly_dust_analytics(spark, raw, st, f"{db}.hourly_analytics")
    assert _rows(grades) == _rows(registry.dust_current_grades(spark, SF))


def test_streaming_jobs(spark, tmp_dir):
    import os
    os.makedirs(tmp_dir + "/land")
    def land(name, body):
        with open(f"{tmp_dir}/land/{name}", "wb") as f:
            f.write(body.encode("euc-kr"))
    land("h01.txt", "# 관측\n202406080100 o 108 35\n202406080100 o 109 40\n")
    tasks.stream_hourly_dust(spark, tmp_dir + "/land", tmp_dir + "/dust", tmp_dir + "/ck1")
    land("h01_rerun.txt", "202406080100 o 108 35\n202406080200 o 108 41\n")  # re-run + next hour
    tasks.stream_hourly_dust(spark, tmp_dir + "/land", tmp_dir + "/dust", tmp_dir + "/ck1")
    got = sorted((r.DATE, r.STN) for r in spark.read.parquet(tmp_dir + "/dust").collect())
    assert got == [("202406080100", "108"), ("202406080100", "109"), ("202406080200", "108")]

    db = _db(spark, tmp_dir)
    items = S.forecast_items(spark, SF)
    render.write_lines(render.forecast_responses(items), tmp_dir + "/fc/run0")
    from meteoframe import sinks
    sinks.write_csv(S.coordinates(spark, SF), tmp_dir + "/coords")
    tasks.stream_forecast(spark, tmp_dir + "/fc", tmp_dir + "/coords", f"{db}.fc", "20240115", tmp_dir + "/ck2")
    first = spark.table(f"{db}.fc").count()
    tasks.stream_forecast(spark, tmp_dir + "/fc", tmp_dir + "/coords", f"{db}.fc", "20240115", tmp_dir + "/ck2")
    assert spark.table(f"{db}.fc").count() == first > 0


def test_newest_snapshot_from_partition_metadata(spark, tmp_dir):
    from meteoframe.plans import dust
    db = _db(spark, tmp_dir)
    raw = f"{db}.hourly_p"
    S.hourly_dust(spark, SF).write.partitionBy("DATE").saveAsTable(raw, path=tmp_dir + "/hp")
    newest = dust.newest_partition(spark, raw, "DATE")
    assert newest == S.hourly_dust(spark, SF).agg({"DATE": "max"}).first()[0]
    assert dust.newest_partition(spark, raw, "STN") is None
    st = f"{db}.st"
    S.station_master(spark, SF).write.saveAsTable(st, path=tmp_dir + "/st")
    out = tasks.build_hourly_dust_analytics(spark, raw, st, f"{db}.grades")
    assert _rows(out) == _rows(registry.dust_current_grades(spark, SF))


def test_score_table_partitioned_merge(spark, tmp_dir):
    db = _db(spark, tmp_dir)
    obs = S.observations_raw(spark, SF).join(feeds.regions(spark), "region_idx")
    toks = ([F.col("timestamp"), F.col("region_code"), F.col("wind_dir").cast("string"),
             F.col("wind_speed").cast("string")] + [F.lit("0")] * 7 +
            [F.col("temp").cast("string"), F.lit("0"), F.col("humidity").cast("string"), F.lit("0"),
             F.col("precipitation").cast("string")] + [F.lit("0")] * 21 + [F.col("ground_temp").cast("string")])
    render.write_lines(obs.select(F.concat_ws(" ", *toks).alias("value"), "region_name"),
                       tmp_dir + "/obs", by="region_name", partitions=4)
    region_of = lambda f: F.regexp_extract(F.url_decode(f), "region_name=([^/]+)/", 1)
    t = f"{db}.weather_score"
    tasks.weekly_scores(spark, tmp_dir + "/obs", region_of, S.holidays(spark), t, "2024-01-14", K.HOLIDAY_RANGE)
    cols = registry.score.SCORE_COLUMNS
    once = _rows(spark.table(t).select(*cols))
    tasks.weekly_scores(spark, tmp_dir + "/obs", region_of, S.holidays(spark), t, "2024-01-14", K.HOLIDAY_RANGE)  # rerun: same table
    assert _rows(spark.table(t).select(*cols)) == once
    parts = [r.partition for r in spark.sql(f"SHOW PARTITIONS {t}").collect()]
    assert len(parts) == len({r[2] for r in once}) and all(p.startswith("date=") for p in parts)


def test_stream_dust_drops_late_rows(spark, tmp_dir):
    import os
    os.makedirs(tmp_dir + "/late")
    with open(tmp_dir + "/late/a.txt", "wb") as f:
        f.write("202406081000 o 108 35\n".encode("euc-kr"))
    tasks.stream_hourly_dust(spark, tmp_dir + "/late", tmp_dir + "/out", tmp_dir + "/ck")
    with open(tmp_dir + "/late/b.txt", "wb") as f:   # 05:00 is behind the 08:00 watermark
        f.write("202406080500 o 109 20\n202406081100 o 109 22\n".encode("euc-kr"))
    tasks.stream_hourly_dust(spark, tmp_dir + "/late", tmp_dir + "/out", tmp_dir + "/ck")
    got = sorted((r.DATE, r.STN) for r in spark.read.parquet(tmp_dir + "/out").collect())
    assert ("202406081000", "108") in got and ("202406081100", "109") in got
    assert ("202406080500", "109") not in got
