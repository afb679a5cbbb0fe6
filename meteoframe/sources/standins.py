"""Feed-shaped inputs derived from the driver's test tables.

The reference feeds (dust text, station list, earthquake XML, typhoon
listing, forecast JSON, hourly observations) are not available offline, so
each is derived - by Spark, from the given parquet tables, so that its size
grows with them - in the feed's own schema.  Edge values (blank PM10,
missing-value codes, unparsable stamps) are injected by fixed rules on ids,
never by dropping rows.

Every builder has an SQL twin in ``SQL`` (DuckDB dialect) used by the
oracle queries; the two must describe the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe import constants as K


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec_text(c: Column, p: int = 12, s: int = 2) -> Column:
    """A double rendered as fixed-scale decimal text ('6.55', '12.50')."""
    return c.cast(f"decimal({p},{s})").cast("string")


def _dec_double(c: Column, p: int = 8, s: int = 2) -> Column:
    """A measurement with s decimals, as double."""
    return c.cast(f"decimal({p},{s})").cast("double")


# ------------------------------------------------------------- hourly dust
def hourly_dust(spark: SparkSession, sf_dir: str, with_arrival: bool = False) -> DataFrame:
    """RAW hourly dust (all text) from ``events``: DATE = day of ts, ORG =
    event_type, STN = user_id, PM10 = value (blank when event_id % 17 = 0).
    ``arrival`` = event_id gives the order rows were received in."""
    ev = table(spark, sf_dir, "events")
    cols = [F.date_format("ts", "yyyyMMdd").alias("DATE"),
            F.col("event_type").alias("ORG"),
            F.col("user_id").cast("string").alias("STN"),
            F.when(F.col("event_id") % 17 == 0, F.lit(""))
             .otherwise(_dec_text(F.col("value"))).alias("PM10")]
    if with_arrival:
        cols += [F.col("event_id").alias("arrival"), F.col("ts").alias("event_time")]
    return ev.select(*cols)


def station_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station master (11 columns) from ``customer``."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("STN_ID"),
        F.lit("2100.12.31.00:00").alias("TM_ED"),
        F.format_string("20%02d.01.01.09:00", (F.col("c_custkey") % 20).cast("int")).alias("TM_ST"),
        F.col("c_name").alias("STN_KO"),
        F.col("c_mktsegment").alias("STN_EN"),
        F.lit("1").alias("STN_SP"),
        F.col("c_acctbal").alias("LON"),
        F.col("c_nationkey").cast("double").alias("LAT"),
        (F.col("c_custkey") % 900).cast("double").alias("HT"),
        F.col("c_nationkey").cast("string").alias("STN_AD"),
        F.lit("").alias("FCT_ID"))


def daily_dust_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily station means from ``orders``: kst = o_orderdate, STN_ID =
    o_custkey, avg = o_totalprice, n = o_orderkey % 24 (hours counted)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderdate").alias("kst"),
                    F.col("o_custkey").cast("string").alias("STN_ID"),
                    F.col("o_totalprice").alias("avg"),
                    (F.col("o_orderkey") % 24).alias("n"))


# ------------------------------------------------------------- earthquakes
def raw_eq_world(spark: SparkSession, sf_dir: str,
                 run_ts: str = "2024-02-01 08:00:00", rebalance: bool = False) -> DataFrame:
    """Earthquake feed rows (19 text columns + load times) from lineitem and
    part: place = 'p_name p_type p_brand', time = l_shipdate, magnitude =
    l_quantity / 5, flags from l_returnflag / l_linestatus / l_tax.

    ``rebalance`` deals the lines anew before the join, while they are narrow:
    for callers that render the rows, which are several times as wide."""
    li = table(spark, sf_dir, "lineitem")
    if rebalance:
        li = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                       "l_returnflag", "l_linestatus", "l_shipdate").hint("rebalance")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    j = li.join(pa, li.l_partkey == pa.p_partkey)
    ts = F.to_timestamp(F.lit(run_ts)).cast("timestamp_ntz")
    msg = (F.when(F.col("l_tax") == 0.08, F.lit("지진해일정보"))
           .when(F.col("l_linestatus") == "O", F.lit(K.EQ_MSG_DOMESTIC))
           .otherwise(F.lit(K.EQ_MSG_FOREIGN)))
    return j.select(
        msg.alias("msgCode"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_discount") < 0.1), "Y")
         .otherwise("N").alias("cntDiv"),
        F.col("l_returnflag").alias("arDiv"),
        F.col("l_suppkey").cast("string").alias("eqArCdNm"),
        F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("eqPt"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("nkDiv"),
        F.lit(None).cast("string").alias("tmIssue"),
        F.date_format("l_shipdate", "yyyyMMddHHmmss").alias("eqDate"),
        _dec_text(F.col("l_quantity") / 5, 6, 1).alias("magMl"),
        F.lit(None).cast("string").alias("magDiff"),
        F.col("l_partkey").cast("string").alias("eqDt"),
        F.col("l_orderkey").cast("string").alias("eqLt"),
        F.col("l_linenumber").cast("string").alias("eqLn"),
        *[F.lit(None).cast("string").alias(c)
          for c in ("majorAxis", "minorAxis", "depthDiff", "jdLoc", "jdLocA")],
        F.when(F.col("l_linenumber") == 1, F.concat_ws("\n", "p_brand", "p_type"))
         .otherwise(F.col("p_brand")).alias("reFer"),
        ts.alias("created_at"), ts.alias("updated_at"))


# ---------------------------------------------------------------- typhoon
def raw_typhoon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typhoon listing rows (21 text columns, as cut from the fixed-width
    feed) from ``orders``; ``batch`` is the fetch stamp the row came in.
    Missing-value codes when o_orderkey % 10 = 0; a non-numeric radius and a
    direction code when % 10 = 5; an unparsable TYP_TM when % 97 = 0."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    miss = k % 10 == 0
    odd = k % 10 == 5

    def num(c: Column) -> Column:
        return c.cast("string")

    stamp = F.date_format("o_orderdate", "yyyyMMddHHmm")
    return o.select(
        num((k % 4) * 12).alias("FT"),
        F.date_format("o_orderdate", "yyyy").alias("YY"),
        num(F.col("o_custkey")).alias("TYP"),
        num(k % 50).alias("SEQ"),
        F.lit("0").alias("TMD"),
        F.when(k % 97 == 0, F.lit("2024BAD")).otherwise(stamp).alias("TYP_TM"),
        stamp.alias("FT_TM"),
        F.when(miss, F.lit("-9")).otherwise(_dec_text(F.col("o_totalprice") / 20000 + 10, 6, 1)).alias("LAT"),
        _dec_text(F.col("o_totalprice") / 10000 + 110, 6, 1).alias("LON"),
        F.when(odd, F.lit("-9")).otherwise(F.col("o_orderstatus")).alias("DIR"),
        F.when(miss, F.lit("-99")).otherwise(num(k % 40)).alias("SP"),
        F.when(miss, F.lit("-999")).otherwise(num(900 + k % 100)).alias("PS"),
        num(F.col("o_custkey") % 60).alias("WS"),
        F.when(miss, F.lit("-9999")).otherwise(num(k % 500)).alias("RAD15"),
        F.when(odd, F.lit("x")).otherwise(num(k % 200)).alias("RAD25"),
        *[F.lit(None).cast("string").alias(c) for c in ("RAD", "ED15", "ER15", "LOC", "ED25", "ER25R")],
        F.date_format("o_orderdate", "yyyyMMdd").alias("batch"))


# --------------------------------------------------------------- forecast
FORECAST_CATEGORY_OF = [("purchase", "WSD", "VEC", "UUU"), ("view", "TMP", "POP", "TMX"), ("click", "REH", "WAV", "VVV"),
                        ("signup", "SKY", "PCP", "TMN"), ("error", "PTY", "SNO", "SNO")]


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location grid from nation x region: level1 = region name, level2 =
    nation name ('' when n_nationkey % 4 = 0), cell = (n_regionkey,
    n_nationkey % 3); some cells hold two locations."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)  # 5-row region table
    return j.select(
        F.col("r_name").alias("level1"),
        F.when(F.col("n_nationkey") % 4 == 0, F.lit("")).otherwise(F.col("n_name")).alias("level2"),
        F.col("n_regionkey").cast("int").alias("nx"),
        (F.col("n_nationkey") % 3).cast("int").alias("ny"))


def forecast_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast API items (one per grid cell, time and category) from
    ``events``: cell = (user_id % 5, user_id % 3), the event type picks the
    category, the hour's largest value is the forecast value, rendered as
    the feed's text."""
    ev = table(spark, sf_dir, "events")
    cat = F.lit(None).cast("string")
    for et, first, second, third in FORECAST_CATEGORY_OF:
        kind = F.when(F.col("event_id") % 4 == 0, second).when(F.col("event_id") % 7 == 0, third).otherwise(first)
        cat = F.when(F.col("event_type") == et, kind).otherwise(cat)
    items = (ev.select(
        F.date_format(F.date_trunc("week", "ts"), "yyyyMMdd").alias("baseDate"),
        F.lit("0500").alias("baseTime"),
        F.date_format("ts", "yyyyMMdd").alias("fcstDate"),
        F.concat(F.date_format("ts", "HH"), F.lit("00")).alias("fcstTime"),
        (F.col("user_id") % 5).cast("int").alias("nx"),
        (F.col("user_id") % 3).cast("int").alias("ny"),
        cat.alias("category"), "value")
        .groupBy("baseDate", "baseTime", "fcstDate", "fcstTime", "nx", "ny", "category")
        .agg(F.max("value").alias("v")))
    v = F.col("v")
    whole = F.floor(v).cast("bigint")
    text = (F.when(F.col("category") == "TMP", _dec_text(v % 40 - 5, 8, 2))
            .when(F.col("category") == "REH", _dec_text(v % 100, 8, 2))
            .when(F.col("category") == "WSD", _dec_text(v % 20, 8, 2))
            .when(F.col("category") == "SKY", (whole % 5).cast("string"))
            .when(F.col("category") == "PTY", (whole % 6).cast("decimal(3,1)").cast("string"))
            .when(F.col("category") == "VEC", (whole % 360).cast("string"))
            .when(F.col("category") == "POP", (whole % 11 * 10).cast("string"))
            .otherwise(F.concat(F.lit("x"), (whole % 9).cast("string"))))
    return items.select("baseDate", "baseTime", "category", "fcstDate", "fcstTime",
                        text.alias("fcstValue"), "nx", "ny")


# ------------------------------------------------------------ observations
def observations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly observations as the feed reports them (-9 = missing) from
    ``events``: region = user_id % 17, time = ts to the minute."""
    ev = table(spark, sf_dir, "events")
    v, eid = F.col("value"), F.col("event_id")
    return ev.select(
        (F.col("user_id") % 17).cast("int").alias("region_idx"),
        F.date_format("ts", "yyyyMMddHHmm").alias("timestamp"),
        F.when(eid % 19 == 0, F.lit(-9)).otherwise((F.floor(v * 7) % 360).cast("int")).alias("wind_dir"),
        _dec_double(v % 12).alias("wind_speed"),
        _dec_double(v % 40 - 5).alias("temp"),
        _dec_double(v % 100).alias("humidity"),
        F.when(F.col("event_type") == "error", _dec_double(v % 15))
         .when((F.col("event_type") == "click") & (eid % 3 == 0), F.lit(-9.0))
         .otherwise(F.lit(0.0)).alias("precipitation"),
        F.when(eid % 11 == 0, F.lit(-9.0)).otherwise(_dec_double(v % 45 - 3)).alias("ground_temp"),
        eid.alias("event_id"))


def holidays(spark: SparkSession) -> DataFrame:
    """The holiday calendar (a local relation: no job to broadcast it)."""
    from meteoframe.sources.feeds import inline_rows
    return inline_rows(spark, [(d,) for d in K.HOLIDAYS], "holiday date")


# ======================================================================
# SQL twins (DuckDB).  Each is a SELECT over the pre-registered views.
# ======================================================================
def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(x) if isinstance(x, str) else str(x) for x in r) + ")"
                     for r in rows)


CASE_CATEGORY = "CASE " + " ".join(
    f"WHEN event_type = '{et}' THEN CASE WHEN event_id % 4 = 0 THEN '{b}' WHEN event_id % 7 = 0 THEN '{c}' ELSE '{a}' END"
    for et, a, b, c in FORECAST_CATEGORY_OF) + " END"

SQL = {
    "hourly_dust": """
        SELECT strftime(ts, '%Y%m%d') AS DATE, event_type AS ORG, CAST(user_id AS VARCHAR) AS STN,
               CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) END AS PM10,
               event_id AS arrival, ts AS event_time
        FROM events""",
    "station_master": """
        SELECT CAST(c_custkey AS VARCHAR) AS STN_ID, '2100.12.31.00:00' AS TM_ED,
               printf('20%02d.01.01.09:00', CAST(c_custkey % 20 AS INTEGER)) AS TM_ST,
               c_name AS STN_KO, c_mktsegment AS STN_EN, '1' AS STN_SP, c_acctbal AS LON,
               CAST(c_nationkey AS DOUBLE) AS LAT, CAST(c_custkey % 900 AS DOUBLE) AS HT,
               CAST(c_nationkey AS VARCHAR) AS STN_AD, '' AS FCT_ID
        FROM customer""",
    "daily_dust_mean": """
        SELECT o_orderdate AS kst, CAST(o_custkey AS VARCHAR) AS STN_ID, o_totalprice AS avg,
               o_orderkey % 24 AS n
        FROM orders""",
    "raw_eq_world": f"""
        SELECT CASE WHEN l_tax = 0.08 THEN '지진해일정보' WHEN l_linestatus = 'O' THEN '{K.EQ_MSG_DOMESTIC}'
                    ELSE '{K.EQ_MSG_FOREIGN}' END AS msgCode,
               CASE WHEN l_linestatus = 'O' AND l_discount < 0.1 THEN 'Y' ELSE 'N' END AS cntDiv,
               l_returnflag AS arDiv, CAST(l_suppkey AS VARCHAR) AS eqArCdNm,
               concat_ws(' ', p_name, p_type, p_brand) AS eqPt,
               CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS nkDiv,
               CAST(NULL AS VARCHAR) AS tmIssue, strftime(l_shipdate, '%Y%m%d%H%M%S') AS eqDate,
               CAST(CAST(l_quantity / 5 AS DECIMAL(6,1)) AS VARCHAR) AS magMl,
               CAST(NULL AS VARCHAR) AS magDiff, CAST(l_partkey AS VARCHAR) AS eqDt,
               CAST(l_orderkey AS VARCHAR) AS eqLt, CAST(l_linenumber AS VARCHAR) AS eqLn,
               CAST(NULL AS VARCHAR) AS majorAxis, CAST(NULL AS VARCHAR) AS minorAxis,
               CAST(NULL AS VARCHAR) AS depthDiff, CAST(NULL AS VARCHAR) AS jdLoc,
               CAST(NULL AS VARCHAR) AS jdLocA,
               CASE WHEN l_linenumber = 1 THEN p_brand || chr(10) || p_type ELSE p_brand END AS reFer,
               TIMESTAMP '2024-02-01 08:00:00' AS created_at, TIMESTAMP '2024-02-01 08:00:00' AS updated_at
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "raw_typhoon": """
        SELECT CAST((o_orderkey % 4) * 12 AS VARCHAR) AS FT, strftime(o_orderdate, '%Y') AS YY,
               CAST(o_custkey AS VARCHAR) AS TYP, CAST(o_orderkey % 50 AS VARCHAR) AS SEQ, '0' AS TMD,
               CASE WHEN o_orderkey % 97 = 0 THEN '2024BAD' ELSE strftime(o_orderdate, '%Y%m%d%H%M') END AS TYP_TM,
               strftime(o_orderdate, '%Y%m%d%H%M') AS FT_TM,
               CASE WHEN o_orderkey % 10 = 0 THEN '-9'
                    ELSE CAST(CAST(o_totalprice / 20000 + 10 AS DECIMAL(6,1)) AS VARCHAR) END AS LAT,
               CAST(CAST(o_totalprice / 10000 + 110 AS DECIMAL(6,1)) AS VARCHAR) AS LON,
               CASE WHEN o_orderkey % 10 = 5 THEN '-9' ELSE o_orderstatus END AS DIR,
               CASE WHEN o_orderkey % 10 = 0 THEN '-99' ELSE CAST(o_orderkey % 40 AS VARCHAR) END AS SP,
               CASE WHEN o_orderkey % 10 = 0 THEN '-999' ELSE CAST(900 + o_orderkey % 100 AS VARCHAR) END AS PS,
               CAST(o_custkey % 60 AS VARCHAR) AS WS,
               CASE WHEN o_orderkey % 10 = 0 THEN '-9999' ELSE CAST(o_orderkey % 500 AS VARCHAR) END AS RAD15,
               CASE WHEN o_orderkey % 10 = 5 THEN 'x' ELSE CAST(o_orderkey % 200 AS VARCHAR) END AS RAD25,
               CAST(NULL AS VARCHAR) AS RAD, CAST(NULL AS VARCHAR) AS ED15, CAST(NULL AS VARCHAR) AS ER15,
               CAST(NULL AS VARCHAR) AS LOC, CAST(NULL AS VARCHAR) AS ED25, CAST(NULL AS VARCHAR) AS ER25R,
               strftime(o_orderdate, '%Y%m%d') AS batch
        FROM orders""",
    "coordinates": """
        SELECT r_name AS level1, CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE n_name END AS level2,
               CAST(n_regionkey AS INTEGER) AS nx, CAST(n_nationkey % 3 AS INTEGER) AS ny
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "forecast_items": f"""
        SELECT baseDate, baseTime, category, fcstDate, fcstTime,
               CASE WHEN category = 'TMP' THEN CAST(CAST(v % 40 - 5 AS DECIMAL(8,2)) AS VARCHAR)
                    WHEN category = 'REH' THEN CAST(CAST(v % 100 AS DECIMAL(8,2)) AS VARCHAR)
                    WHEN category = 'WSD' THEN CAST(CAST(v % 20 AS DECIMAL(8,2)) AS VARCHAR)
                    WHEN category = 'SKY' THEN CAST(CAST(floor(v) AS BIGINT) % 5 AS VARCHAR)
                    WHEN category = 'PTY' THEN CAST(CAST(CAST(floor(v) AS BIGINT) % 6 AS DECIMAL(3,1)) AS VARCHAR)
                    WHEN category = 'VEC' THEN CAST(CAST(floor(v) AS BIGINT) % 360 AS VARCHAR)
                    WHEN category = 'POP' THEN CAST(CAST(floor(v) AS BIGINT) % 11 * 10 AS VARCHAR)
                    ELSE 'x' || CAST(CAST(floor(v) AS BIGINT) % 9 AS VARCHAR) END AS fcstValue,
               nx, ny
        FROM (SELECT strftime(date_trunc('week', ts), '%Y%m%d') AS baseDate, '0500' AS baseTime,
                     strftime(ts, '%Y%m%d') AS fcstDate, strftime(ts, '%H') || '00' AS fcstTime,
                     CAST(user_id % 5 AS INTEGER) AS nx, CAST(user_id % 3 AS INTEGER) AS ny,
                     {CASE_CATEGORY} AS category, max(value) AS v
              FROM events GROUP BY ALL) t""",
    "observations_raw": """
        SELECT CAST(user_id % 17 AS INTEGER) AS region_idx, strftime(ts, '%Y%m%d%H%M') AS timestamp,
               CASE WHEN event_id % 19 = 0 THEN -9 ELSE CAST(floor(value * 7) % 360 AS INTEGER) END AS wind_dir,
               CAST(CAST(value % 12 AS DECIMAL(8,2)) AS DOUBLE) AS wind_speed,
               CAST(CAST(value % 40 - 5 AS DECIMAL(8,2)) AS DOUBLE) AS temp,
               CAST(CAST(value % 100 AS DECIMAL(8,2)) AS DOUBLE) AS humidity,
               CASE WHEN event_type = 'error' THEN CAST(CAST(value % 15 AS DECIMAL(8,2)) AS DOUBLE)
                    WHEN event_type = 'click' AND event_id % 3 = 0 THEN -9.0 ELSE 0.0 END AS precipitation,
               CASE WHEN event_id % 11 = 0 THEN -9.0
                    ELSE CAST(CAST(value % 45 - 3 AS DECIMAL(8,2)) AS DOUBLE) END AS ground_temp,
               event_id
        FROM events""",
    "regions": "SELECT * FROM (VALUES " + _values(
        [(i, n, c) for i, (n, c) in enumerate(K.REGION_CODES)]) + ") AS r(region_idx, region_name, region_code)",
    "holidays": "SELECT CAST(d AS DATE) AS holiday FROM (VALUES " + ", ".join(
        f"('{d}')" for d in K.HOLIDAYS) + ") AS h(d)",
}
