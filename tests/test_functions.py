"""Column functions on hand-written edge cases (FIXTURES.md section D)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meteoframe import constants as K
from meteoframe import functions as M
from meteoframe.functions import dates as D


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def col_values(spark, expr, values, schema="v string"):
    rows = spark.createDataFrame([(v,) for v in values], schema).select(expr.alias("r")).collect()
    return [r["r"] for r in rows]


def test_tokens_collapse_runs_and_ends(spark):
    got = col_values(spark, M.tokens("v"), ["  a \t b  c ", "", "   ", None, "x"])
    assert got == [["a", "b", "c"], [], [], None, ["x"]]


def test_padded_token(spark):
    got = col_values(spark, M.padded_token(M.tokens("v"), 3), ["a b c", "a b c d e"])
    assert got == ["", "d"]


def test_before_marker_and_newlines(spark):
    assert one(spark, M.before("v", "("), "25(12)") == "25"
    assert one(spark, M.newline_to_space("v"), "a\nb\rc") == "a b c"
    assert one(spark, M.newline_to_space("v"), None) is None


@pytest.mark.parametrize("place,want", [("a b c", "a b"), ("a b", "a b"), ("a", "a"),
                                         ("", ""), (None, None), ("a  b", "a ")])
def test_first_two_tokens(spark, place, want):
    assert one(spark, M.first_tokens("v", 2), place) == want


def test_location_name(spark):
    df = spark.createDataFrame([("서울", "종로구"), ("서울", ""), ("서울", None)], "a string, b string")
    got = [r[0] for r in df.select(M.location_name("a", "b")).collect()]
    assert got == ["서울 종로구", "서울", "서울"]


@pytest.mark.parametrize("text,want", [("12", 12.0), (" 12.5 ", 12.5), ("-9", -9.0), ("1e3", 1000.0),
                                        ("", None), ("x", None), ("1d", None), ("nan", None),
                                        ("inf", None), (None, None), (".5", 0.5)])
def test_safe_double(spark, text, want):
    assert one(spark, M.safe_double("v"), text) == want


@pytest.mark.parametrize("text,want", [("3", 3), ("-9", -9), ("3.0", None), ("x", None), ("", None)])
def test_safe_int(spark, text, want):
    assert one(spark, M.safe_int("v"), text) == want


def test_safe_number_rounds_half_up(spark):
    import decimal
    assert one(spark, M.safe_number("v"), "12.5") == decimal.Decimal(13)
    assert one(spark, M.safe_number("v"), "12.4") == decimal.Decimal(12)
    assert one(spark, M.safe_number("v"), "") is None


@pytest.mark.parametrize("pm10,grade", [("30", "좋음"), ("30.01", "보통"), ("80", "보통"), ("80.5", "나쁨"),
                                        ("150", "나쁨"), ("150.1", "매우나쁨"), ("", "정보없음"),
                                        ("x", "정보없음"), (None, "정보없음"), ("12.5", "좋음")])
def test_dust_grade_thresholds(spark, pm10, grade):
    assert one(spark, M.dust_grade("v"), pm10) == grade


@pytest.mark.parametrize("v,want", [("-9", None), ("-99", None), ("-999", None), ("-9999", None),
                                     ("-9.0", None), ("-90", "-90"), ("12", "12"), ("F", "F"),
                                     (None, None), ("1d", "1d")])
def test_sentinels(spark, v, want):
    assert one(spark, M.sentinel_to_null("v", K.TYPHOON_SENTINELS), v) == want


def test_observation_missing_codes(spark):
    df = spark.createDataFrame([(-9.0, -9.0), (1.5, 0.0)], "t double, rain double")
    got = df.select(M.null_if_missing("t", -9.0).alias("t"), M.zero_if_missing("rain", -9.0).alias("r")).collect()
    assert [(r.t, r.r) for r in got] == [(None, 0.0), (1.5, 0.0)]


def test_mean_half_up_is_exact(spark):
    # 2.675 is below .675 in binary; the exact decimal mean rounds half up
    df = spark.createDataFrame([(2.67,), (2.68,)], "x double")
    got = df.agg(M.mean_half_up("x").alias("m")).first()["m"]
    assert got == 2.68
    neg = spark.createDataFrame([(-2.67,), (-2.68,)], "x double")
    assert neg.agg(M.mean_half_up("x")).first()[0] == -2.68
    empty = spark.createDataFrame([(None,)], "x double")
    assert empty.agg(M.mean_half_up("x")).first()[0] is None


def test_clamp_keeps_null(spark):
    assert col_values(spark, M.clamp("v"), [150, -5, 50, None], "v int") == [100, 0, 50, None]


@pytest.mark.parametrize("code,label", [("1", "맑음"), ("4", "흐림"), ("9", "9"), (None, None)])
def test_sky_label(spark, code, label):
    assert one(spark, M.sky_label("v"), code) == label


@pytest.mark.parametrize("code,label", [("0", "없음"), ("0.0", "없음"), ("3", "눈"), ("7", "7"), ("x", "x")])
def test_pty_label(spark, code, label):
    assert one(spark, M.pty_label("v"), code) == label


@pytest.mark.parametrize("wsd,alert", [(13.99, "No"), (14.0, "Yes"), (None, "No")])
def test_strong_wind(spark, wsd, alert):
    assert one(spark, M.strong_wind_alert("v"), wsd, "v double") == alert


@pytest.mark.parametrize("di,alert", [(74.99, "보통 🟨"), (75.0, "높음 🟧"), (80.0, "매우 높음 🟥"), (None, "보통 🟨")])
def test_discomfort_alert(spark, di, alert):
    assert one(spark, M.discomfort_alert("v"), di, "v double") == alert


def test_discomfort_index_formula(spark):
    df = spark.createDataFrame([(30.0, 80.0)], "t double, h double")
    got = df.select(M.discomfort_index("t", "h")).first()[0]
    assert got == pytest.approx(0.81 * 30 + 0.01 * 80 * (0.99 * 30 - 14.3) + 46.3)


def _py_score(t, h, rain, wind, ground):
    """The scalar rule, written out plainly for the test."""
    if t is None or h is None or rain is None or wind is None:
        return None
    s = 100
    di = 0.81 * t + 0.01 * h * (0.99 * t - 14.3) + 46.3
    s += -40 if di >= 80 else -20 if di >= 75 else 10 if di <= 60 else 0
    s += -40 if rain > 10 else -20 if rain > 0 else 0
    s += -30 if wind > 10 else -15 if wind > 5 else 0
    if ground is not None and (ground > 35 or ground < 5):
        s -= 20
    return max(min(s, 100), 0)


SCORE_CASES = [(10.0, 50.0, 0.0, 1.0, 20.0), (33.0, 90.0, 10.01, 11.0, 40.0), (25.0, 70.0, 10.0, 10.0, 35.0),
               (28.0, 80.0, 0.5, 5.0, 5.0), (0.0, 0.0, 0.0, 0.0, None), (None, 50.0, 0.0, 1.0, 20.0),
               (35.0, 100.0, 20.0, 20.0, 50.0), (18.0, 40.0, 0.0, 5.01, 4.99)]


def test_outdoor_score_matches_rule(spark):
    df = spark.createDataFrame(SCORE_CASES, "t double, h double, r double, w double, g double")
    got = [r[0] for r in df.select(M.outdoor_score("t", "h", "r", "w", "g")).collect()]
    assert got == [_py_score(*c) for c in SCORE_CASES]


def test_timestamp_parse_and_format(spark):
    ts = one(spark, D.parse_ts("v", D.STAMP_MINUTE), "202401011230")
    assert ts == dt.datetime(2024, 1, 1, 12, 30)
    assert one(spark, D.parse_ts("v", D.STAMP_MINUTE), "202401012430") is None
    assert one(spark, D.parse_ts("v", D.STAMP_MINUTE), "bad") is None
    assert one(spark, D.fmt_ts(D.parse_ts("v", D.STAMP_MINUTE), D.READABLE), "202401011230") == "2024-01-01 12:30"
    assert one(spark, D.month_to_date("v"), "2024-06") == dt.date(2024, 6, 1)
    assert one(spark, D.hour_stamp(D.parse_ts("v", D.STAMP_MINUTE)), "202401011230") == "202401011200"


def test_weekday_and_week_window(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 8),)], "d date")
    got = df.select(D.weekday("d"), D.weekday_label("d"), D.is_weekend("d"), D.week_start("d")).collect()
    assert [tuple(r) for r in got] == [(5, "토", True, dt.date(2024, 1, 1)), (0, "월", False, dt.date(2024, 1, 8))]
    start, end = D.last_week_range(F.lit(dt.date(2025, 1, 13)))
    r = spark.range(1).select(start, end).first()
    assert tuple(r) == ("202501060000", "202501122300")
    a, b = D.previous_month_bounds(F.lit(dt.date(2024, 7, 1)))
    assert tuple(spark.range(1).select(a, b).first()) == (dt.date(2024, 6, 1), dt.date(2024, 6, 30))


def test_ts_text(spark):
    assert one(spark, D.ts_text(D.parse_ts("v", D.STAMP_MINUTE)), "202401011230") == "2024-01-01 12:30:00"
    assert one(spark, D.ts_text(D.parse_ts("v", D.STAMP_MINUTE)), None) is None


def test_mean_half_up_negative_zero(spark):
    df = spark.createDataFrame([(-0.01,), (0.0,), (0.0,)], "x double")
    got = df.agg(M.mean_half_up("x")).first()[0]
    assert got == 0.0 and str(got) == "0.0"


@pytest.mark.parametrize("text", ["1e", "+", ".", "1-2", "--1", "e5", "1e+", ".e5", "1.5e", "+-1"])
def test_safe_double_rejects_malformed(spark, text):
    import re
    from meteoframe.functions.numeric import DECIMAL_RE
    assert re.match(DECIMAL_RE, text) is None
    assert one(spark, M.safe_double("v"), text) is None


@pytest.mark.parametrize("text,want", [("1.", 1.0), ("+.5", 0.5), ("1.e5", 100000.0), ("1E+5", 100000.0)])
def test_safe_double_accepts_what_the_pattern_accepts(spark, text, want):
    import re
    from meteoframe.functions.numeric import DECIMAL_RE
    assert re.match(DECIMAL_RE, text) is not None
    assert one(spark, M.safe_double("v"), text) == want
