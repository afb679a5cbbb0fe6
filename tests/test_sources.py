"""Feed readers on small hand-written landed files (edge cases of FIXTURES.md D)."""

import os

from meteoframe import constants as K
from meteoframe.sources import feeds, text


def write(path, name, content, encoding="utf-8"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "wb") as f:
        f.write(content.encode(encoding))
    return path


def test_dust_text_euc_kr(spark, tmp_dir):
    body = "# 날짜 기관 지점 PM10\n\n202406080100 관측소 108 35\n202406080100 관측소\t109\n   \n202406080100 a 110 12 extra\n"
    p = write(tmp_dir + "/dust", "f.txt", body, "euc-kr")
    got = text.parse_dust(text.read_lines(spark, p, "EUC-KR")).orderBy("pos").collect()
    assert [(r.DATE, r.ORG, r.STN, r.PM10) for r in got] == [
        ("202406080100", "관측소", "108", "35"), ("202406080100", "관측소", "109", ""),
        ("202406080100", "a", "110", "12")]


def test_daily_mean_text(spark, tmp_dir):
    body = ("# header\n-----------\n2024.06.01.00:00 ORG1 108 25(12) 1 2\n2024.06.02.00:00 ORG1 108 x(1) 1 2\n"
            "2024.06.03.00:00 ORG1 108 30(3) 1\n2024.06.04.24:00 ORG1 109 40(2) 1 2\n")
    p = write(tmp_dir + "/avg", "f.txt", body)
    got = text.parse_daily_mean(text.read_lines(spark, p)).collect()
    # bad number and short row dropped; an unparsable time keeps the row with a null time
    assert sorted((r.STN_ID, r.avg, r.kst is None) for r in got) == [("108", 25.0, False), ("109", 40.0, True)]


def test_station_list_after_first_rule(spark, tmp_dir):
    body = ("#  STN list\nnot data line\n" + K.STATION_RULE_MARKER + "----\n"
            "90 2100.12.31.00:00 2006.12.08.12:00 속초 Sokcho 1 128.56 38.25 18.06 105 11D20401\n"
            + K.STATION_RULE_MARKER + "\n# note\n\n"
            "100 2100.12.31.00:00 2005.04.28.12:00 대관령 Daegwallyeong\n"
            "999 a b c d e f g h i j\n")
    p = write(tmp_dir + "/stn", "f.txt", body, "euc-kr")
    got = text.parse_stations(text.read_lines(spark, p, "EUC-KR")).collect()
    assert [r.STN_ID for r in got] == ["90", "100", "999"]
    short = [r for r in got if r.STN_ID == "100"][0]
    assert short.STN_KO == "대관령" and short.LON == "" and short.FCT_ID == ""
    kept = text.parse_stations(text.read_lines(spark, p, "EUC-KR"), keep_ids=K.STATION_KEEP_IDS)
    assert sorted(r.STN_ID for r in kept.collect()) == ["100", "90"]


def test_observations_text(spark, tmp_dir):
    def line(tm, wd="5", ws="1.5", ta="20.0", hm="50", rn="-9", ts="-9"):
        toks = [tm, "108", wd, ws] + ["0"] * 7 + [ta, "0", hm, "0", rn] + ["0"] * 21 + [ts, "="]
        return " ".join(toks)
    body = "\n".join(["# YYMMDDHHMI STN", " STN header", line("202401060100"), line("202401060200", wd="1.5"),
                      line("202401062400"), line("202401060300", ta="-9", rn="2.5", ts="3.0"),
                      "202401060400 108 5"]) + "\n"
    p = write(tmp_dir + "/obs", "f.txt", body)
    got = text.parse_observations(text.read_lines(spark, p)).orderBy("pos").collect()
    assert [r.timestamp for r in got] == ["202401060100", "202401060300"]
    assert (got[0].precipitation, got[0].ground_temp, got[0].timestamp_readable) == (0.0, None, "2024-01-06 01:00")
    assert (got[1].temp, got[1].precipitation, got[1].ground_temp) == (None, 2.5, 3.0)


def test_fixed_width_blank_and_full_fields(spark, tmp_dir):
    df = spark.createDataFrame([("12", "2024", "9", None, "202408140000", "-9.5")],
                               "FT string, YY string, TYP string, SEQ string, TYP_TM string, LAT string")
    names, widths = ["FT", "YY", "TYP", "SEQ", "TYP_TM", "LAT"], [3, 5, 3, 4, 13, 5]
    lines = feeds.render_fixed_width(df, names, widths)
    got = feeds.parse_fixed_width(lines, names, widths).first()
    assert tuple(got) == ("12", "2024", "9", None, "202408140000", "-9.5")


def test_xml_missing_tags_marker_and_newlines(spark, tmp_dir):
    xml = ("<root><earthqueakNoti><info><msgCode>지진정보</msgCode><eqPt>경북 포항시 북구</eqPt>"
           "<ReFer>line1\nline2</ReFer></info><info><cntDiv>Y</cntDiv></info></earthqueakNoti></root>")
    write(tmp_dir + "/xml/a", "a.xml", xml)
    write(tmp_dir + "/xml/b", "b.xml",
          f"<root><earthqueakNoti><info>{K.EQ_NO_CONTENT}</info></earthqueakNoti></root>")
    got = feeds.read_earthquake_xml(spark, tmp_dir + "/xml/*", "2024-01-01 08:00:00").collect()
    assert len(got) == 2
    first = [r for r in got if r.msgCode][0]
    assert first.reFer == "line1 line2" and first.nkDiv is None and str(first.created_at) == "2024-01-01 08:00:00"


def test_forecast_json_missing_and_empty(spark, tmp_dir):
    item = ('{"baseDate":"20240101","baseTime":"0500","category":"TMP","fcstDate":"20240101",'
            '"fcstTime":"0600","fcstValue":"3","nx":60,"ny":127}')
    body = "\n".join(['{"response":{"body":{"items":{"item":[' + item + "]}}}}",
                      '{"response":{"body":{"items":{"item":[]}}}}',
                      '{"response":{"header":{"resultCode":"03"}}}']) + "\n"
    p = write(tmp_dir + "/json", "a.json", body)
    got = feeds.read_forecast_json(spark, p).collect()
    assert len(got) == 1 and got[0].fcstValue == "3" and got[0].nx == 60


def test_coordinates_csv_required_columns(spark, tmp_dir):
    p = write(tmp_dir + "/c1", "c.csv", "level1,level2,nx,ny\n서울특별시,,60,127\n서울특별시,종로구,60,127\n")
    got = feeds.read_coordinates(spark, p).collect()
    assert [(r.level1, r.level2, r.nx) for r in got] == [("서울특별시", "", 60), ("서울특별시", "종로구", 60)]
    bad = write(tmp_dir + "/c2", "c.csv", "level1,nx,ny\na,1,2\n")
    import pytest
    with pytest.raises(ValueError):
        feeds.read_coordinates(spark, bad)


def test_station_seed_with_bom(spark, tmp_dir):
    p = write(tmp_dir + "/seed", "s.csv", "﻿" + ",".join(K.STATION_COLUMNS) +
              "\n90,2100.12.31.00:00,2006.12.08.12:00,속초,Sokcho,1,128.56,38.25,18.06,105,11D20401\n")
    got = feeds.read_station_seed(spark, p).first()
    assert got.STN_ID == "90" and got.LON == 128.56 and got.STN_KO == "속초"


def test_rejected_lines_are_observed(spark, tmp_dir):
    from pyspark.sql import Observation
    body = ("2024.06.01.00:00 ORG1 108 25(12) 1 2\n2024.06.02.00:00 ORG1 108 x(1) 1 2\n"
            "2024.06.03.00:00 ORG1 109 30(3) 1 2\n")
    p = write(tmp_dir + "/avg2", "f.txt", body)
    obs = Observation("daily")
    assert text.parse_daily_mean(text.read_lines(spark, p), obs).count() == 2
    assert obs.get == {"lines": 3, "rejected": 1}


def test_compressed_xml_landing(spark, tmp_dir):
    from pyspark.sql import functions as F
    from meteoframe.sources import render
    df = spark.createDataFrame([("지진정보", "a b c", "x\ny")], "msgCode string, eqPt string, reFer string")
    for t in K.EQ_TAGS:
        if t not in ("msgCode", "eqPt", "ReFer"):
            df = df.withColumn(t, F.lit(None).cast("string"))
    render.write_eq_xml(df, tmp_dir + "/xmlgz", compression="gzip")
    got = feeds.read_earthquake_xml(spark, tmp_dir + "/xmlgz", "2024-01-01 00:00:00").first()
    assert got.msgCode == "지진정보" and got.reFer == "x y"


def test_fixed_width_field_filling_its_width(spark):
    lines = spark.createDataFrame([("12320245   x",), ("# c",)], "value string")
    got = feeds.parse_fixed_width(lines, ["FT", "YY", "R"], [3, 5, 4]).collect()
    assert [tuple(r) for r in got] == [("123", "20245", "x")]


def test_xml_feed_without_info(spark, tmp_dir):
    write(tmp_dir + "/xml0", "a.xml", "<root><earthqueakNoti></earthqueakNoti></root>")
    assert feeds.read_earthquake_xml(spark, tmp_dir + "/xml0", "2024-01-01 00:00:00").count() == 0


def test_xml_roundtrip_lands_a_compressed_feed(spark, tmp_dir):
    """Lines are dealt anew before they are joined and widened, and tags cost little."""
    from pyspark.sql import functions as F
    from meteoframe import landing
    from meteoframe.sources import standins as S
    n = 3000
    k = F.col("id")
    (spark.range(n).select(
        k.alias("l_orderkey"), F.when(k % 10 == 0, None).otherwise(k % 7).alias("l_partkey"), k.alias("l_suppkey"), (k % 3).cast("int").alias("l_linenumber"),
        (k % 50).cast("double").alias("l_quantity"), F.lit(0.05).alias("l_discount"), F.lit(0.08).alias("l_tax"), F.lit("R").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"), F.to_timestamp(F.lit("2024-01-02 03:04:05")).alias("l_shipdate")).write.parquet(tmp_dir + "/lineitem.parquet"))
    (spark.range(6).select(k.alias("p_partkey"), F.lit("a<b").alias("p_name"), F.lit("&t").alias("p_type"), F.lit("B#1").alias("p_brand"))
     .write.parquet(tmp_dir + "/part.parquet"))
    got = landing.xml_roundtrip(spark, tmp_dir)
    want = S.raw_eq_world(spark, tmp_dir)
    text_of = lambda df: sorted(map(str, df.select(*[c for c in df.columns if c != "reFer"], F.translate("reFer", "\n", " ").alias("reFer")).collect()))
    assert text_of(got) == text_of(want.select(*[c for c in got.columns])) and want.count() == sum(i % 10 > 0 and i % 7 < 6 for i in range(n))
    feed = [f for f in got.inputFiles() if "/feed/" in f]
    assert feed and all(f.endswith(".gz") for f in feed)
    assert sum(os.path.getsize(f.removeprefix("file://")) for f in feed) < n * 100      # 400 bytes a report as plain text
    plan = S.raw_eq_world(spark, tmp_dir, rebalance=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("RebalancePartitions")
