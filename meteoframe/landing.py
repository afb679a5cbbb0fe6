"""Registered round-trip and table queries.

Each lands a stand-in feed as files in the feed's layout (written by Spark
into a new folder under the shared checkpoint folder), reads it back with
the feed reader and returns the parsed rows - so the readers are checked on
the whole tables against the columns they came from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteoframe import constants as K
from meteoframe import sinks, tasks
from meteoframe.functions import dates as D
from meteoframe.plans import dust, forecast, quake, typhoon
from meteoframe.registry import _typhoon_target_source
from meteoframe.session import scratch_path
from meteoframe.sources import feeds, render, standins as S, text


def _dec(c, p=12, s=2):
    return F.col(c).cast(f"decimal({p},{s})").cast("string") if isinstance(c, str) \
        else c.cast(f"decimal({p},{s})").cast("string")


# ------------------------------------------------------------ S1 hourly dust
def text_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    raw = S.hourly_dust(spark, d, with_arrival=True).hint("rebalance")
    sep = F.when(F.col("arrival") % 2 == 0, F.lit("\t")).otherwise(F.lit("  "))
    body = raw.select("DATE", F.col("arrival").alias("o"),
                      F.concat(F.col("DATE"), F.lit(" "), F.col("ORG"), sep, F.col("STN"),
                               F.lit(" "), F.col("PM10")).alias("value"))
    days = raw.select("DATE").distinct()
    extra = (days.select("DATE", F.lit(-2).cast("bigint").alias("o"),
                         F.lit("# 날짜 기관 지점 PM10 (시간 평균)").alias("value"))
             .unionByName(days.select("DATE", F.lit(-1).cast("bigint").alias("o"),
                                      F.lit("   ").alias("value"))))
    path = scratch_path(spark, "dust-text")
    # no file-per-day split: a day holding a third of the rows must not land in one task
    render.write_lines(body.unionByName(extra).select("value"), path, "EUC-KR")
    return text.parse_dust(text.scan_lines(spark, path, "EUC-KR")).select(*dust.RAW_COLUMNS)


# -------------------------------------------------------- S2 daily means text
def avg_text_roundtrip(spark, d):
    m = S.daily_dust_mean(spark, d).hint("rebalance")
    avg = F.when(F.col("n") == 1, F.lit("x(1)")).otherwise(
        F.concat(_dec("avg"), F.lit("("), F.col("n").cast("string"), F.lit(")")))
    head = F.concat_ws(" ", F.date_format("kst", "yyyy.MM.dd.HH:mm"), F.lit("ORG1"), F.col("STN_ID"), avg)
    line = F.when(F.col("n") == 0, head).otherwise(F.concat(head, F.lit(" 0 0")))
    body = m.select(line.alias("value"))
    months = m.select(F.date_format("kst", "yyyy-MM").alias("mon")).distinct()
    rules = months.select(F.lit("-" * 40).alias("value")).unionByName(
        months.select(F.concat(F.lit("# KST ORG STN PM10(N) A B "), F.col("mon")).alias("value")))
    path = scratch_path(spark, "dust-avg-text")
    render.write_lines(body.unionByName(rules), path, "EUC-KR")
    out = text.parse_daily_mean(text.scan_lines(spark, path, "EUC-KR"))
    return out.select("kst", "STN_ID", "avg")


# -------------------------------------------------------- S7 observation text
def obs_roundtrip(spark, d):
    raw = S.observations_raw(spark, d).hint("rebalance")
    eid = F.col("event_id")
    ts = F.when(eid % 59 == 0, F.lit("202401329999")).otherwise(F.col("timestamp"))
    wd = F.when(eid % 53 == 0, F.lit("1.5")).otherwise(F.col("wind_dir").cast("string"))
    toks = ([ts, F.col("region_idx").cast("string"), wd, _dec("wind_speed", 8, 2)]
            + [F.lit("0")] * 7 + [_dec("temp", 8, 2), F.lit("0"), _dec("humidity", 8, 2), F.lit("0"),
                                  _dec("precipitation", 8, 2)]
            + [F.lit("0")] * 21 + [_dec("ground_temp", 8, 2), F.lit("=")])
    body = raw.select(F.concat_ws(" ", *toks).alias("value"))
    regions = raw.select("region_idx").distinct()
    hdr = regions.select(F.lit("# YYMMDDHHMI STN WD WS GST ...").alias("value")).unionByName(
        regions.select(F.concat(F.lit(" STN  관측소 "), F.col("region_idx")).alias("value")))
    path = scratch_path(spark, "obs-text")
    render.write_lines(body.unionByName(hdr), path, "EUC-KR")
    return text.parse_observations(text.scan_lines(spark, path, "EUC-KR")).drop("file")


# ------------------------------------------------------- S4 fixed-width text
def fixed_width_roundtrip(spark, d):
    raw = S.raw_typhoon(spark, d)
    path = scratch_path(spark, "typhoon-fwf")
    render.write_fixed_width(raw, path, header="# FT YY TYP SEQ TMD TYP_TM FT_TM LAT LON ...")
    lines = text.scan_lines(spark, path)
    return feeds.parse_fixed_width(lines, K.TYPHOON_COLUMNS, feeds.TYPHOON_WIDTHS).drop("file")


# ------------------------------------------------------------------ S5 XML
def xml_roundtrip(spark, d):
    raw = S.raw_eq_world(spark, d)
    path = scratch_path(spark, "eq-xml")
    # tags are most of a feed's bytes, and its rows are wider than the lines they come from
    render.write_eq_xml(S.raw_eq_world(spark, d, rebalance=True), path + "/feed", compression="gzip", rebalance=False)
    marker = raw.select("arDiv").distinct().withColumn(
        "value", F.lit(f"<earthqueakNoti><info>{K.EQ_NO_CONTENT}</info></earthqueakNoti>"))
    render.write_lines(marker, path + "/empty", by="arDiv")   # one response per file
    both = [feeds.read_earthquake_xml(spark, f"{path}/{part}", "2024-02-01 08:00:00") for part in ("feed", "empty/*")]
    return both[0].unionByName(both[1])


# ----------------------------------------------------------------- S6 JSON
def json_roundtrip(spark, d):
    items = S.forecast_items(spark, d)
    resp = render.forecast_responses(items)
    empties = items.select("nx").distinct().select(F.when(
        F.col("nx") % 2 == 0, F.lit('{"response":{"body":{"items":{"item":[]}}}}'))
        .otherwise(F.lit('{"response":{"header":{"resultCode":"03"}}}')).alias("value"))
    path = scratch_path(spark, "forecast-json")
    render.write_lines(resp.unionByName(empties), path)
    got = feeds.read_forecast_json(spark, path)
    return forecast.locate(got, S.coordinates(spark, d))


# --------------------------------------------------------- S3 station list
STATIONS_PER_FILE = 500  # each landed station list has its own preamble and rule line


def _station_lines(spark, d) -> DataFrame:
    st = S.station_master(spark, d)
    key = F.col("STN_ID").cast("bigint")
    f = F.floor(key / STATIONS_PER_FILE).alias("f")
    txt = [F.col(c).cast("string") if c in ("LON", "LAT", "HT") else F.col(c) for c in K.STATION_COLUMNS]
    body = st.select(f, (key * 2).alias("o"), F.concat_ws(" ", *txt).alias("value"))
    files = st.select(f).distinct()
    pre = [(-4, "# STATION LIST  관측지점"), (-3, "STN_ID TM_ED TM_ST STN_KO ..."),
           (-2, K.STATION_RULE_MARKER + "----------"), (-1, "   ")]
    extra = None
    for o, v in pre:
        part = files.select("f", F.lit(o).cast("bigint").alias("o"), F.lit(v).alias("value"))
        extra = part if extra is None else extra.unionByName(part)
    # a second rule line in the middle of each file's body, and a comment
    mid = files.select("f", (F.col("f") * 2 * STATIONS_PER_FILE + 101).cast("bigint").alias("o"),
                       F.lit(K.STATION_RULE_MARKER + "--").alias("value")).unionByName(
        files.select("f", (F.col("f") * 2 * STATIONS_PER_FILE + 103).cast("bigint").alias("o"), F.lit("#  mid comment").alias("value")))
    return body.unionByName(extra).unionByName(mid)


def station_scan(spark, d):
    path = scratch_path(spark, "stations")
    render.write_lines(_station_lines(spark, d), path, "EUC-KR", by="f", order=["f", "o"])
    return text.parse_stations(text.read_lines(spark, path, "EUC-KR"))


def station_keep(spark, d):
    path = scratch_path(spark, "stations-keep")
    render.write_lines(_station_lines(spark, d), path, "EUC-KR", by="f", order=["f", "o"])
    return text.parse_stations(text.read_lines(spark, path, "EUC-KR"), keep_ids=K.STATION_KEEP_IDS)


# ----------------------------------------------------------- S8 coordinates
def coords_csv(spark, d):
    """A location list (one row per customer: segment / name, with an empty
    second level for every seventh, quotes with commas and line feeds in others) written as CSV with a header and read
    back with the required-column check; '' comes back as ''."""
    c = S.table(spark, d, "customer")
    name = F.when(F.col("c_custkey") % 7 == 1, F.concat(F.lit('say "hi", '), F.col("c_name"))).when(F.col("c_custkey") % 7 == 2, F.concat(F.col("c_name"), F.lit("\nline"))).otherwise(F.col("c_name"))
    locs = c.select(F.col("c_mktsegment").alias("level1"),
                    F.when(F.col("c_custkey") % 7 == 0, F.lit("")).otherwise(name).alias("level2"),
                    F.col("c_nationkey").cast("int").alias("nx"),
                    (F.col("c_custkey") % 100).cast("int").alias("ny"))
    path = scratch_path(spark, "coords")
    sinks.write_csv(locs, path, bom=True)
    return feeds.read_coordinates(spark, path)


# --------------------------------------------------------------- K tables
def tables_roundtrip(spark, d):
    """K14 namespace, K3 create-if-absent, K4 append in two loads (U2), K11
    staging view, K1 full rebuild of the analytics table, S13 read by name."""
    base = scratch_path(spark, "warehouse")
    db = "raw_" + base.rsplit("-", 1)[-1]
    sinks.ensure_namespace(spark, db, base + "/db")
    raw_t = f"{db}.hourly_dust"
    sinks.create_if_absent(spark, raw_t, "DATE string, ORG string, STN string, PM10 string",
                           location=base + "/hourly_dust")
    sinks.create_if_absent(spark, raw_t, "DATE string, ORG string, STN string, PM10 string",
                           location=base + "/hourly_dust")  # second call: no-op
    raw = S.hourly_dust(spark, d, with_arrival=True)
    sinks.append(raw.filter(F.col("arrival") % 2 == 0).select(*dust.RAW_COLUMNS), raw_t)
    sinks.append(raw.filter(F.col("arrival") % 2 == 1).select(*dust.RAW_COLUMNS), raw_t)
    stage = "stage_" + db
    sinks.create_view(S.station_master(spark, d), stage)
    out_t = f"{db}.hourly_dust_analytics"
    sinks.overwrite(dust.current_grades(spark.table(raw_t), spark.table(stage)), out_t,
                    path=base + "/analytics")
    out = spark.read.parquet(base + "/analytics")
    spark.catalog.dropTempView(stage)
    spark.sql(f"DROP DATABASE {db} CASCADE")   # the tables' files stay in the scratch folder
    return out


def csv_roundtrip(spark, d):
    """K5 truncate + load, K12 CSV export, K13 dated + latest copies, S10/S11
    CSV bulk load with schema, header and quote options."""
    monthly = dust.monthly_mean(S.daily_dust_mean(spark, d))
    base = scratch_path(spark, "monthly-csv")
    _, latest = sinks.write_dated_and_latest(monthly, base, "2024-02")
    schema = T.StructType([T.StructField("STN_ID", T.StringType()),
                           T.StructField("MONTH", T.StringType()),
                           T.StructField("MONTHLY_AVG", T.DoubleType())])
    return feeds.load_csv(spark, latest, schema)


def csv_values_roundtrip(spark, d):
    """Values that a CSV file can bend: blanks, quotes, line feeds, back
    slashes, commas, empty text and nulls; dated and latest copy."""
    c = S.table(spark, d, "customer")
    forms = F.array(*[F.lit(x) for x in ("  pad  ", 'say "hi"', "two\nlines", "back\\slash", "a,b", "", '"', "\t")])
    rows = c.select("c_custkey", F.when(F.col("c_custkey") % 9 < 8, F.get(forms, (F.col("c_custkey") % 9).cast("int"))).alias("v"))
    dated, latest = sinks.write_dated_and_latest(rows, scratch_path(spark, "csv-values"), "2024-02")
    both = [feeds.load_csv(spark, p, rows.schema, multi_line=True).withColumn("copy", F.lit(n)) for n, p in (("dated", dated), ("latest", latest))]
    return both[0].unionByName(both[1])


def text_control_chars(spark, d):
    """Lines that hold or start with control characters, in both readers."""
    c = S.table(spark, d, "customer")
    forms = F.array(*[F.lit(x) for x in ("a\x01b", "\x02start", "plain", 'q"q', " lead", "한글\x01")])
    rows = c.select(F.concat_ws("|", F.col("c_custkey").cast("string"), F.get(forms, (F.col("c_custkey") % 6).cast("int"))).alias("value"))
    starts = c.select(F.concat(F.lit("\x02"), F.col("c_custkey").cast("string")).alias("value"))
    path = scratch_path(spark, "control-text")
    render.write_lines(rows.unionByName(starts), path, "EUC-KR")
    return (text.scan_lines(spark, path, "EUC-KR").select(F.lit("scan").alias("reader"), "value")
            .unionByName(text.read_lines(spark, path, "EUC-KR").select(F.lit("read").alias("reader"), "value")))


def xml_edge_tags(spark, d):
    """Reports with empty tags (null), blanks around text (kept) and absent
    tags (null)."""
    p = S.table(spark, d, "part")
    k = F.col("p_partkey")
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))
    place = F.when(k % 3 == 0, F.lit("<eqPt></eqPt>")).when(k % 3 == 1, F.lit("")).otherwise(tag("eqPt", F.concat(F.lit("  "), F.col("p_brand"), F.lit(" "))))
    lines = p.select(F.concat(F.lit("<info>"), tag("msgCode", k.cast("string")), place, F.lit("</info>")).alias("value"))
    path = scratch_path(spark, "xml-edges")
    doc = lines.select((F.crc32("value") % 64).alias("file"), F.lit(1).alias("o"), "value")
    files = doc.select("file").distinct()
    ends = [files.select("file", F.lit(o).alias("o"), F.lit(t).alias("value")) for o, t in ((0, "<earthqueakNoti>"), (2, "</earthqueakNoti>"))]
    render.write_lines(doc.unionByName(ends[0]).unionByName(ends[1]), path, by="file", order=["file", "o"])
    return feeds.read_earthquake_xml(spark, path + "/*", "2024-02-01 08:00:00").select("msgCode", "eqPt", "eqDate")


def station_seed(spark, d):
    """S9: the station list as a seed file with a byte order mark."""
    st = S.station_master(spark, d)
    path = scratch_path(spark, "seed")
    cell = lambda c: F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))
    lines = st.select(F.concat_ws(",", *[cell(c) for c in K.STATION_COLUMNS]).alias("value"))
    files = lines.withColumn("file", F.crc32("value") % 8)
    heads = files.select("file").distinct().select("file", F.lit("\ufeff" + ",".join(K.STATION_COLUMNS)).alias("value"), F.lit(0).alias("o"))
    render.write_lines(files.select("file", "value", F.lit(1).alias("o")).unionByName(heads), path, by="file", order=["file", "o"])
    return feeds.read_station_seed(spark, path).select(*K.STATION_COLUMNS)


def quake_table_day_replace(spark, d):
    """K6 on a table partitioned by event month (a day has few reports): one
    day's reports replaced by reloaded ones, a report without time among them."""
    base = scratch_path(spark, "eq-table")
    db = "eq_" + base.rsplit("-", 1)[-1]
    sinks.ensure_namespace(spark, db, base + "/db")
    raw = quake.with_month(S.raw_eq_world(spark, d))
    name = f"{db}.raw"
    sinks.create_if_absent(spark, name, sinks.ddl(raw), base + "/table", [quake.MONTH])
    sinks.append(raw, name)
    again = spark.table(name).filter((F.col(quake.MONTH) == "199808") & F.col("eqDate").startswith("19980802")).withColumn("reFer", F.lit("reloaded"))
    undated = again.withColumn("eqDate", F.lit(None).cast("string")).withColumn(quake.MONTH, F.lit(None).cast("string"))
    start, end = D.day_range_bounds(F.lit("1998-08-02"))
    sinks.replace_rows(spark, name, again.unionByName(undated), D.parse_ts("eqDate", D.STAMP_SECOND).between(start, end), quake.MONTH, ["199808"])
    out = spark.table(name).drop(quake.MONTH).withColumn("eq_day", F.substring("eqDate", 1, 8)).checkpoint()
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


def forecast_table_retention(spark, d):
    """K7 through the sink, on a table partitioned by a date; K5: the same
    table truncated and loaded first."""
    base = scratch_path(spark, "fc-table")
    db = "fr_" + base.rsplit("-", 1)[-1]
    sinks.ensure_namespace(spark, db, base + "/db")
    ev = S.table(spark, d, "events")
    rows = ev.select("event_id", F.date_format("ts", "yyyyMMdd").alias("FCST_DATE"), F.to_date(F.date_trunc("week", "ts")).alias("BASE"))
    name = f"{db}.forecast"
    sinks.create_if_absent(spark, name, "event_id bigint, FCST_DATE string, BASE date", base + "/table", ["BASE"])
    sinks.append(rows.limit(10), name)
    rows.write.insertInto(name, overwrite=True)
    sinks.retain_rows(spark, name, ~(F.col("FCST_DATE") < "20240117"), "BASE", F.col("BASE") <= F.lit("2024-01-17").cast("date"))
    out = spark.table(name).checkpoint()
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


def typhoon_table_upsert(spark, d):
    """K8 on a table partitioned by the month of the merge key's time: the first
    half of the fetches loaded, the second merged into it."""
    base = scratch_path(spark, "typhoon-table")
    db = "ty_" + base.rsplit("-", 1)[-1]
    sinks.ensure_namespace(spark, db, base + "/db")
    target, source = (typhoon.with_month(x) for x in _typhoon_target_source(spark, d))
    name = f"{db}.raw"
    sinks.create_if_absent(spark, name, sinks.ddl(target), base + "/table", [typhoon.MONTH])
    sinks.append(target, name)
    sinks.upsert_table(spark, name, source, typhoon.KEYS, typhoon.latest_first(), typhoon.MONTH, ["TYP_TM"])
    out = spark.table(name).drop(typhoon.MONTH).checkpoint()
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


def fixed_width_inferred(spark, d):
    """The typhoon listing read back without its layout: every column holds
    values somewhere, the edges are those that all lines share."""
    raw = S.raw_typhoon(spark, d)
    fill = [c for c in K.TYPHOON_COLUMNS if c in ("RAD", "ED15", "ER15", "LOC", "ED25", "ER25R")]
    raw = raw.withColumns({c: F.when(F.col("SEQ").cast("int") % (k + 2) == 0, F.col("SEQ")) for k, c in enumerate(fill)})
    path = scratch_path(spark, "typhoon-inferred")
    render.write_fixed_width(raw, path, header="# FT YY TYP SEQ TMD TYP_TM FT_TM LAT LON ...")
    return feeds.parse_inferred_width(text.scan_lines(spark, path), K.TYPHOON_COLUMNS).drop("file")


def load_once_table(spark, d):
    """S12 into a table: readings landed in two deliveries; a run after each and
    one more load every file once."""
    base = scratch_path(spark, "load-once")
    db = "lo_" + base.rsplit("-", 1)[-1]
    sinks.ensure_namespace(spark, db, base + "/db")
    raw = S.hourly_dust(spark, d, with_arrival=True)
    line = F.concat_ws(" ", "DATE", "ORG", "STN", "PM10")
    schema = T.StructType([T.StructField("value", T.StringType())])
    loads = []
    for k in (0, 1, None):
        if k is not None:
            render.write_lines(raw.filter(F.col("arrival") % 2 == k).hint("rebalance").select(line.alias("value")), f"{base}/landing/run={k}", "EUC-KR")
        loads.append(sinks.load_once(spark, base + "/landing", f"{db}.dust", f"{db}.ledger", lambda paths: text.parse_dust(
            spark.read.schema(schema).text(paths)), base + "/table"))
    if loads[2] or not loads[0] or not loads[1]:
        raise RuntimeError(f"files loaded by run: {loads}")
    out = spark.table(f"{db}.dust").select(*dust.RAW_COLUMNS).checkpoint()
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


def quake_region_incremental(spark, d):
    """Region tables kept from per-month states: all months once, then a day is
    replaced and its month alone is counted again."""
    base = scratch_path(spark, "eq-states")
    db = "es_" + base.rsplit("-", 1)[-1]
    sinks.ensure_namespace(spark, db, base + "/db")
    raw = quake.with_month(S.raw_eq_world(spark, d))
    names = [f"{db}.{n}" for n in ("raw", "states", "domestic", "foreign")]
    sinks.create_if_absent(spark, names[0], sinks.ddl(raw), base + "/table", [quake.MONTH])
    sinks.append(raw, names[0])
    tasks.refresh_eq_regions(spark, *names)
    day = spark.table(names[0]).filter((F.col(quake.MONTH) == "199808") & F.col("eqDate").startswith("19980802") & (F.col("eqLn") == "1"))
    start, end = D.day_range_bounds(F.lit("1998-08-02"))
    sinks.replace_rows(spark, names[0], day.withColumn("eqPt", F.concat(F.lit("Moved "), F.col("eqPt"))),
                       D.parse_ts("eqDate", D.STAMP_SECOND).between(start, end), quake.MONTH, ["199808"])
    tasks.refresh_eq_regions(spark, *names, months=["199808"])
    out = (spark.table(names[2]).withColumns({"kind": F.lit("domestic"), "max_magml": F.lit(None).cast("double")})
           .unionByName(spark.table(names[3]).withColumns({"kind": F.lit("foreign"), "eqlt": F.lit(None).cast("string"), "eqln": F.lit(None).cast("string")}))).checkpoint()
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


def forecast_open_pivot(spark, d):
    """Every category becomes a column, those unknown to the code too."""
    long = forecast.locate(S.forecast_items(spark, d), S.coordinates(spark, d))
    renamed = F.when(F.col("category") == "SNO", F.concat(F.lit("NEW"), (F.col("nx") % 3).cast("string"))).otherwise(F.col("category"))
    return forecast.wide_open(long.withColumn("category", renamed))


ROUNDTRIP_QUERIES = {
    "fixed_width_inferred": fixed_width_inferred,
    "load_once_table": load_once_table,
    "quake_region_incremental": quake_region_incremental,
    "forecast_open_pivot": forecast_open_pivot,
    "typhoon_table_upsert": typhoon_table_upsert,
    "csv_values_roundtrip": csv_values_roundtrip,
    "text_control_chars": text_control_chars,
    "xml_edge_tags": xml_edge_tags,
    "station_seed": station_seed,
    "quake_table_day_replace": quake_table_day_replace,
    "forecast_table_retention": forecast_table_retention,
    "text_roundtrip": text_roundtrip,
    "avg_text_roundtrip": avg_text_roundtrip,
    "obs_roundtrip": obs_roundtrip,
    "fixed_width_roundtrip": fixed_width_roundtrip,
    "xml_roundtrip": xml_roundtrip,
    "json_roundtrip": json_roundtrip,
    "station_scan": station_scan,
    "station_keep": station_keep,
    "coords_csv": coords_csv,
    "tables_roundtrip": tables_roundtrip,
    "csv_roundtrip": csv_roundtrip,
}
