"""Operators on hand-written cases: ties, nulls, duplicates, properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meteoframe import constants as K
from meteoframe import operators as O
from meteoframe.operators import quality as Q
from meteoframe.plans import quake, score


def _key(row):
    return tuple((x is None, "" if x is None else str(x)) for x in row)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=_key)


def test_keep_first_by_arrival(spark):
    df = spark.createDataFrame([("d", "s1", "9", 2), ("d", "s1", "5", 1), ("d", "s2", "7", 3)],
                               "DATE string, STN string, PM10 string, arrival int")
    got = O.keep_first(df, ["DATE", "STN"], ["arrival"])
    assert rows(got, "STN", "PM10") == [("s1", "5"), ("s2", "7")]


def test_pick_one_nulls_first_expressions_and_ties(spark):
    df = spark.createDataFrame([("r", "20240101", "a"), ("r", None, "b"), ("q", "20240102", "x"),
                                ("q", "20240102", "y"), ("p", "96", "z"), ("p", "120", "w")],
                               "k string, d string, v string")
    got = O.pick_one(df, ["k"], [("d", True)], take="max")
    # null order key wins its group; exact ties broken by the greater value
    assert rows(got, "k", "v") == [("p", "z"), ("q", "y"), ("r", "b")]
    got2 = O.pick_one(df, ["k"], [(F.col("d").try_cast("int"), False)], take="max")
    assert rows(got2, "k", "v") == [("p", "w"), ("q", "y"), ("r", "a")]


def test_bad_batches_with_null_id(spark):
    df = spark.createDataFrame([(None, 1), (None, 999), ("a", 1), ("b", 999), ("b", 2)], "k string, v int")
    assert rows(O.drop_bad_batches(df, "k", F.col("v") == 999)) == [("a", 1)]


def test_pick_one_independent_of_partitions(spark):
    df = spark.range(0, 2000).select((F.col("id") % 7).alias("k"), (F.col("id") * 13 % 101).alias("v"))
    a = rows(O.pick_one(df.repartition(1), ["k"], [("v", False)], "max"))
    b = rows(O.pick_one(df.repartition(16), ["k"], [("v", False)], "max"))
    assert a == b and len(a) == 7


def test_pivot_checked_reports_duplicates_and_unlisted(spark):
    long = spark.createDataFrame([("i1", "TMP", "1"), ("i1", "REH", "2"), ("i2", "TMP", "4")], "i string, c string, v string")
    w = O.pivot_checked(long, ["i"], "c", "v", ["TMP", "REH", "VEC"])
    assert w.columns == ["i", "TMP", "REH", "VEC"]
    assert rows(w) == [("i1", "1", "2", None), ("i2", "4", None, None)]
    dup = long.unionByName(spark.createDataFrame([("i1", "TMP", "9")], "i string, c string, v string"))
    with pytest.raises(Exception, match="pivot key is not unique"):
        O.pivot_checked(dup, ["i"], "c", "v", ["TMP", "REH"]).collect()
    with pytest.raises(Exception, match="c not listed: REH"):
        O.pivot_checked(long, ["i"], "c", "v", ["TMP"]).collect()


TGT = [("k1", "x", 1.0), ("k2", "y", 2.0), (None, "n", 0.0), ("k3", "d1", 3.0), ("k3", "d2", 3.5)]
SRC = [("k2", "Y", None), ("k4", "z", 4.0), (None, "m", 9.0), ("k3", "e", 5.0), ("k4", "z2", 4.5)]
SCHEMA = "k string, name string, v double"


def test_upsert_semantics(spark):
    t = spark.createDataFrame(TGT, SCHEMA)
    s = spark.createDataFrame(SRC, SCHEMA)
    got = rows(O.upsert_frame(t, s, ["k"]))
    want = sorted([
        ("k1", "x", 1.0),            # untouched
        ("k2", "Y", None),           # matched: replaced, even by null
        (None, "n", 0.0),            # null key never matches
        ("k3", "e", 5.0), ("k3", "e", 5.0),  # every matched target row updated
        ("k4", "z2", 4.5),           # new key inserted once (source deduped)
        (None, "m", 9.0),            # null-key source row inserted
    ], key=_key)
    assert got == want


def test_upsert_twice_equals_once_and_empty_source(spark):
    # a null key never matches, so (as with MERGE) only keyed rows are idempotent
    t = spark.createDataFrame(TGT, SCHEMA)
    s = spark.createDataFrame([r for r in SRC if r[0] is not None], SCHEMA)
    once = O.upsert_frame(t, s, ["k"])
    twice = O.upsert_frame(once, s, ["k"])
    assert rows(once) == rows(twice)
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(O.upsert_frame(t, empty, ["k"])) == rows(t)


def test_replace_day_is_idempotent_and_keeps_other_days(spark):
    raw = spark.createDataFrame([("20240101120000", "a"), ("20240102000000", "b"), ("20240102235959", "c"),
                                 ("20240103000000", "d"), ("bad", "e")], "eqDate string, v string")
    new = spark.createDataFrame([("20240102101010", "n")], "eqDate string, v string")
    once = quake.replace_day(raw, new, "2024-01-02")
    assert rows(once) == [("20240101120000", "a"), ("20240102101010", "n"), ("20240103000000", "d"), ("bad", "e")]
    assert rows(quake.replace_day(once, new, "2024-01-02")) == rows(once)
    empty = quake.replace_day(raw, new.limit(0), "2024-01-02")
    assert [r.v for r in empty.collect() if r.eqDate.startswith("20240102")] == []


def test_retain(spark):
    t = spark.createDataFrame([("20240101",), ("20240115",), (None,)], "d string")
    got = O.retain(t, ~(F.col("d") < "20240110"))
    assert rows(got) == [("20240115",), (None,)]


def test_drop_bad_batches(spark):
    df = spark.createDataFrame([("f1", "ok"), ("f1", "bad"), ("f2", "ok"), ("f3", "ok")], "f string, s string")
    got = O.drop_bad_batches(df, "f", F.col("s") == "bad")
    assert rows(got) == [("f2", "ok"), ("f3", "ok")]


def test_grids(spark):
    df = spark.createDataFrame([(dt.date(2024, 8, 14),)], "run date")
    six = O.expand_grid(df, F.date_sub("run", 4), "run", (0, 6, 12, 18), 1)
    assert six.count() == 20
    step = O.expand_grid(df, F.date_sub("run", 3), "run", (0, 6, 12, 18), 3)
    stamps = sorted(r.stamp for r in step.collect())
    assert len(stamps) == 8 and stamps[0] == dt.datetime(2024, 8, 11) and stamps[-1] == dt.datetime(2024, 8, 14, 18)
    days = df.select(F.explode(O.month_days("run")).alias("d"))
    assert days.count() == 31


def test_quality_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id int")
    assert rows(Q.unique_violations(df, "id")) == [(1, 2)]
    assert Q.not_null_violations(df, "id").count() == 2
    assert Q.missing_columns(df, ["id", "level2"]) == ["level2"]
    with pytest.raises(ValueError):
        Q.require_columns(df, ["nx"])
    assert not Q.is_empty(df) and Q.is_empty(df.limit(0))
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0),)], "t timestamp")
    f = Q.freshness(ts, "t", "2024-01-02 06:00:00", 24).first()
    assert f.stale and f.age_hours == pytest.approx(30.0)


def test_observed_counts(spark):
    df = spark.range(10)
    obs_df, obs = O.observe_counts(df, "c", even=F.col("id") % 2 == 0)
    obs_df.collect()
    assert obs.get == {"rows": 10, "even": 5}


def test_score_ranking_partitioned_by_week(spark):
    rows_ = [(dt.date(2024, 1, 1), i, f"r{i}", str(i), s) for i, s in enumerate([80, 90, 80, None, 70])]
    df = spark.createDataFrame(rows_, "week_start date, region_idx int, region_name string, region_code string, score int")
    top, bottom = score.ranked(df)
    assert [r.region_name for r in top.orderBy("rank").collect()] == ["r1", "r0", "r2"]
    assert [r.region_name for r in bottom.orderBy("rank").collect()] == ["r0", "r2", "r4"]


def test_region_code_lookup(spark):
    from meteoframe.sources import feeds
    names = spark.createDataFrame([("서울",), ("목포",)], "region_name string")
    got = score.region_codes(names, feeds.regions(spark)).collect()
    assert sorted((r.region_name, r.region_code) for r in got) == [("목포", "165"), ("서울", "108")]
    bad = spark.createDataFrame([("평양",)], "region_name string")
    with pytest.raises(Exception, match="unsupported region"):
        score.region_codes(bad, feeds.regions(spark)).collect()


def test_forecast_wide_duplicate_policy(spark):
    from meteoframe.plans import forecast
    row = ("20240101", "0500", "20240101", "0600", 1, 2, "L", "B", "TMP", "3")
    schema = ("baseDate string, baseTime string, fcstDate string, fcstTime string, nx int, ny int, "
              "LOCATION string, BROAD_LOCATION string, category string, fcstValue string")
    ok = spark.createDataFrame([row], schema)
    assert forecast.wide(ok).first().TMP == 3.0
    dup = spark.createDataFrame([row, row[:-1] + ("4",)], schema)
    with pytest.raises(Exception, match="pivot key is not unique"):
        forecast.wide(dup).collect()


def test_union_all_missing_columns_and_empty(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2,)], "id int")
    e = spark.createDataFrame([], "id int, s string")
    got = rows(O.union_all([a, e, b]))
    assert got == [(1, "x"), (2, None)]


def test_weekend_and_holiday_tags(spark):
    from meteoframe.sources import standins as S
    days = [("2024-02-09 10:00", "공휴일", True), ("2024-02-10 10:00", "공휴일", True),
            ("2024-01-08 10:00", "평일", False), ("2024-02-11 10:00", "공휴일", True),
            ("2024-01-13 10:00", "주말", True)]
    df = spark.createDataFrame([(d,) for d, _, _ in days], "t string").selectExpr(
        "CAST(to_timestamp(t) AS timestamp_ntz) AS ts")
    flags = score.day_flags(df, S.holidays(spark)).orderBy("ts").collect()
    assert [r.day_tag for r in flags] == [t for _, t, _ in sorted(days)]
    kept = score.weekend_or_holiday(df, S.holidays(spark)).count()
    assert kept == sum(1 for _, _, k in days if k)


def test_days_outside_the_calendar_fail(spark):
    from meteoframe.sources import standins as S
    df = spark.createDataFrame([("2026-10-09 10:00",)], "t string").selectExpr("CAST(to_timestamp(t) AS timestamp_ntz) AS ts")
    with pytest.raises(Exception, match="no holiday calendar for 2026-10-09"):
        score.weekend_or_holiday(df, S.holidays(spark), K.HOLIDAY_RANGE).collect()
