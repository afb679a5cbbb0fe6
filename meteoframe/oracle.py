"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code path: window functions, joins and
CASE expressions, in the shape of the original warehouse SQL, over the
pre-registered views of the driver tables.
"""

from __future__ import annotations

from meteoframe import constants as K
from meteoframe.sources.standins import SQL as S
from meteoframe import registry as R


DECIMAL_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def safe_double(x: str) -> str:
    return f"(CASE WHEN regexp_full_match(trim({x}), '{DECIMAL_RE}') THEN TRY_CAST(trim({x}) AS DOUBLE) END)"


def safe_number(x: str) -> str:
    return (f"(CASE WHEN regexp_full_match(trim({x}), '{DECIMAL_RE}') "
            f"THEN TRY_CAST(trim({x}) AS DECIMAL(38,0)) END)")


def region_by(x: str) -> str:
    return f"array_to_string(string_split({x}, ' ')[1:2], ' ')"


def dust_grade(x: str) -> str:
    v = safe_double(x)
    return (f"(CASE WHEN {v} IS NULL OR isnan({v}) THEN '정보없음' WHEN {v} > 150 THEN '매우나쁨' WHEN {v} > 80 THEN '나쁨' "
            f"WHEN {v} > 30 THEN '보통' ELSE '좋음' END)")


def di(t: str, h: str) -> str:
    return f"(0.81::DOUBLE * {t} + 0.01::DOUBLE * {h} * (0.99::DOUBLE * {t} - 14.3::DOUBLE) + 46.3::DOUBLE)"


def mean_half_up(x: str, decimals: int = 2) -> str:
    """Mean of decimals of ten places, rounded half up in whole numbers."""
    s = f"CAST(sum(CAST({x} AS DECIMAL(20,10))) * 10000000000 AS HUGEINT)"
    n = f"CAST(count({x}) AS HUGEINT)"
    return (f"(CASE WHEN count({x}) > 0 THEN sign({s}) * CAST((abs({s}) * {2 * 10 ** decimals} + {n} * 10000000000) // ({n} * 20000000000) AS DOUBLE)"
            f" / {float(10 ** decimals)}::DOUBLE END)")


def sentinel_null(c: str) -> str:
    return f"(CASE WHEN {safe_double(c)} IN (-9, -99, -999, -9999) THEN NULL ELSE {c} END)"


# ----------------------------------------------------------------- dust
DUST_CURRENT = f"""
SELECT f.DATE, f.STN AS STN_ID, any_value(s.STN_KO) AS STN_KO, any_value(s.LON) AS LON, any_value(s.LAT) AS LAT,
       {safe_number('string_split(max(ORG || chr(1) || PM10), chr(1))[2]')} AS PM10,
       {dust_grade('string_split(max(ORG || chr(1) || PM10), chr(1))[2]')} AS DUST_STATUS
FROM ({S['hourly_dust']}) f, ({S['station_master']}) s
WHERE f.STN = s.STN_ID AND f.event_time::DATE = (SELECT max(ts)::DATE FROM events)
GROUP BY f.DATE, f.STN
"""

DUST_KEEP_FIRST = f"""
WITH raw AS ({S['hourly_dust']})
SELECT DATE, ORG, STN, PM10 FROM (
  SELECT *, row_number() OVER (PARTITION BY DATE, STN ORDER BY arrival) AS rn FROM raw) t
WHERE rn = 1
"""

MONTHLY = f"""SELECT STN_ID, strftime(kst, '%Y-%m') AS MONTH, {mean_half_up('avg', 6)} AS MONTHLY_AVG
FROM ({S['daily_dust_mean']}) d GROUP BY STN_ID, strftime(kst, '%Y-%m')"""

DUST_MONTHLY_DATED = f"""
SELECT CAST(o_custkey AS VARCHAR) AS STN_ID, any_value(c_name) AS STN_KO, CAST(date_trunc('month', o_orderdate) AS DATE) AS MONTH,
       {mean_half_up('o_totalprice', 6)} AS MONTHLY_AVG
FROM orders, customer WHERE o_custkey = c_custkey GROUP BY o_custkey, date_trunc('month', o_orderdate)
"""

# ---------------------------------------------------------- earthquakes
DOM = f"SELECT * FROM ({S['raw_eq_world']}) r WHERE nkDiv = 'N' AND cntDiv = 'Y' AND msgCode = '{K.EQ_MSG_DOMESTIC}'"
FGN = f"SELECT * FROM ({S['raw_eq_world']}) r WHERE nkDiv = 'N' AND cntDiv = 'N' AND msgCode = '{K.EQ_MSG_FOREIGN}'"

QUAKE_REGION_LATEST = f"""
WITH places AS (SELECT {region_by('eqPt')} AS region, eqDate, eqLt, eqLn FROM ({DOM}) d)
SELECT region, count(*) OVER (PARTITION BY region) AS eq_count, eqLt AS eqlt, eqLn AS eqln
FROM places WHERE region IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY region
                           ORDER BY eqDate DESC NULLS FIRST, eqLt DESC NULLS LAST, eqLn DESC NULLS LAST) = 1
"""

QUAKE_REGION_MAX = f"""
SELECT {region_by('eqPt')} AS region, count(*) AS eq_count, max({safe_double('magMl')}) AS max_magml
FROM ({FGN}) f WHERE {region_by('eqPt')} IS NOT NULL
GROUP BY {region_by('eqPt')}
"""

# by walking day after day: what each day is called, and whether a day owes a
# substitute that no free weekday since has paid
HOLIDAY_CALENDAR = f"""
WITH RECURSIVE moon(n, b, a) AS (VALUES {', '.join(f"(DATE '{x}', DATE '{y}', DATE '{z}')" for x, y, z in K.HOLIDAY_LUNAR)}),
day AS (SELECT CAST(d AS DATE) AS d, year(d) AS y, strftime(d, '%m-%d') AS md, isodow(d) AS w FROM range(DATE '2000-01-01', DATE '2031-01-01', INTERVAL 1 DAY) r(d)),
named AS (SELECT d, w, y,
  [x FOR x IN [CASE WHEN md IN ('01-01', '03-01', '05-05', '06-06', '08-15', '10-03', '12-25') OR (md = '04-05' AND y <= 2005) OR (md = '07-17' AND y <= 2007) OR (md = '10-09' AND y >= 2013) THEN md END,
    CASE WHEN d IN (SELECT b FROM moon) THEN 'buddha' END,
    CASE WHEN d IN (SELECT unnest([n - 1, n, n + 1]) FROM moon) THEN 'seollal' END,
    CASE WHEN d IN (SELECT unnest([a - 1, a, a + 1]) FROM moon) THEN 'chuseok' END] IF x IS NOT NULL] AS names FROM day),
owing AS (SELECT d, w, len(names) > 0 OR d IN ({', '.join(f"DATE '{x}'" for x in K.HOLIDAY_EXTRA)}) AS off,
  len(list_filter(names, lambda x: CASE WHEN x IN ('seollal', 'chuseok') THEN y >= 2014 AND (w = 7 OR len(names) > 1)
    WHEN x = '05-05' THEN y >= 2014 AND (w >= 6 OR len(names) > 1) WHEN x = '03-01' THEN y >= 2022 AND (w >= 6 OR len(names) > 1)
    WHEN x IN ('08-15', '10-03', '10-09') THEN y >= 2021 AND (w >= 6 OR len(names) > 1)
    WHEN x IN ('buddha', '12-25') THEN y >= 2023 AND (w >= 6 OR len(names) > 1) ELSE false END)) > 0 AS owes FROM named),
walk AS (SELECT d, off, owes AS due, false AS pays FROM owing WHERE d = DATE '2000-01-01'
  UNION ALL SELECT o.d, o.off, o.owes OR (walk.due AND NOT (NOT o.off AND o.w < 6)), walk.due AND NOT o.off AND o.w < 6 FROM walk JOIN owing o ON o.d = walk.d + 1),
orders_on AS (SELECT DATE '2000-01-01' + CAST(o_orderkey * 31 % 11323 AS INTEGER) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT walk.d AS holiday, coalesce(n, 0) AS n FROM walk LEFT JOIN orders_on USING (d) WHERE off OR pays
"""

_FILLED = ["RAD", "ED15", "ER15", "LOC", "ED25", "ER25R"]
_FILLED = [c for c in K.TYPHOON_COLUMNS if c in _FILLED]
_MOVED = f"""SELECT * REPLACE (CASE WHEN eqDate LIKE '19980802%' THEN 'Moved ' || eqPt ELSE eqPt END AS eqPt)
FROM ({S['raw_eq_world']}) r WHERE eqDate IS NULL OR eqDate NOT LIKE '19980802%' OR eqLn = '1'"""
QUAKE_REGION_INCREMENTAL = f"""
WITH raw AS ({_MOVED}), place AS (SELECT *, {region_by('eqPt')} AS region FROM raw)
SELECT region, count(*) AS eq_count, arg_max(eqLt, (eqDate IS NULL, eqDate, eqLt, eqLn)) AS eqlt, arg_max(eqLn, (eqDate IS NULL, eqDate, eqLt, eqLn)) AS eqln,
       'domestic' AS kind, CAST(NULL AS DOUBLE) AS max_magml
FROM place WHERE region IS NOT NULL AND nkDiv = 'N' AND cntDiv = 'Y' AND msgCode = '{K.EQ_MSG_DOMESTIC}' GROUP BY region
UNION ALL
SELECT region, count(*), NULL, NULL, 'foreign', max({safe_double('magMl')})
FROM place WHERE region IS NOT NULL AND nkDiv = 'N' AND cntDiv = 'N' AND msgCode = '{K.EQ_MSG_FOREIGN}' GROUP BY region
"""

_DAY = R.QUAKE_REPLACE_DAY
_IN_DAY = (f"try_strptime(eqDate, '%Y%m%d%H%M%S') BETWEEN TIMESTAMP '{_DAY} 00:00:00' "
           f"AND TIMESTAMP '{_DAY} 00:00:00' + INTERVAL 1 DAY - INTERVAL 1 SECOND")
QUAKE_DAY_REPLACE = f"""
WITH raw AS ({S['raw_eq_world']})
SELECT * FROM raw WHERE NOT coalesce({_IN_DAY}, false)
UNION ALL
SELECT * REPLACE ('reloaded' AS reFer, TIMESTAMP '2024-02-02 08:00:00' AS updated_at)
FROM raw WHERE {_IN_DAY}
"""

# -------------------------------------------------------------- typhoon
_TY_COLS = K.TYPHOON_COLUMNS
_NULLED = ", ".join(f"{sentinel_null(c)} AS {c}" for c in _TY_COLS)
_TS = "try_strptime(TYP_TM, '%Y%m%d%H%M')"
TYPHOON_CLEAN = f"""
WITH n AS (SELECT {_NULLED}, batch FROM ({S['raw_typhoon']}) r),
bad AS (SELECT DISTINCT batch FROM n WHERE TYP_TM IS NOT NULL AND {_TS} IS NULL)
SELECT YY, TYP, SEQ, FT, {_TS} AS TYP_TM, {safe_double('LAT')} AS LAT, {safe_double('LON')} AS LON, DIR,
       {safe_double('SP')} AS SP, {safe_double('PS')} AS PS, {safe_double('WS')} AS WS,
       {safe_double('RAD15')} AS RAD15, {safe_double('RAD25')} AS RAD25
FROM n WHERE batch NOT IN (SELECT batch FROM bad)
"""

_TY_FINAL = K.TYPHOON_FINAL
_TY_REST = [c for c in _TY_FINAL if c not in ("TYP_TM", "TYP")]
_TY_ORDER = ", ".join([f"TRY_CAST({c} AS INTEGER) DESC NULLS LAST" for c in ("FT", "SEQ")] + [f"{c} DESC NULLS LAST" for c in _TY_REST])
TYPHOON_UPSERT = f"""
WITH c AS ({TYPHOON_CLEAN}),
t AS (SELECT * FROM c WHERE TYP_TM < TIMESTAMP '1998-01-01'),
s0 AS (SELECT * REPLACE (WS + 1 AS WS) FROM c WHERE TYP_TM >= TIMESTAMP '1997-06-01'),
s AS (SELECT {', '.join(_TY_FINAL)} FROM (
        SELECT *, row_number() OVER (PARTITION BY TYP_TM, TYP ORDER BY {_TY_ORDER}) AS rn
        FROM s0 WHERE TYP_TM IS NOT NULL AND TYP IS NOT NULL) x WHERE rn = 1
      UNION ALL SELECT * FROM s0 WHERE TYP_TM IS NULL OR TYP IS NULL),
sh AS (SELECT *, true AS hit FROM s)
SELECT {', '.join(f'CASE WHEN sh.hit THEN sh.{c} ELSE t.{c} END AS {c}' for c in _TY_FINAL)}
FROM t FULL OUTER JOIN sh ON t.TYP_TM = sh.TYP_TM AND t.TYP = sh.TYP
"""

BAD_BATCH_DROP = f"""
WITH raw AS ({S['raw_typhoon']}),
bad AS (SELECT DISTINCT batch FROM raw WHERE TYP_TM IS NOT NULL AND {_TS} IS NULL)
SELECT TYP, TYP_TM, batch FROM raw WHERE batch NOT IN (SELECT batch FROM bad)
"""

# ------------------------------------------------------------- forecast
_LOC = """SELECT nx, ny, CASE WHEN coalesce(level2, '') = '' THEN level1 ELSE trim(level1 || ' ' || level2) END AS LOCATION,
       level1 AS BROAD_LOCATION FROM coords"""


def _pick(cat: str) -> str:
    return f"max(fcstValue) FILTER (WHERE category = '{cat}')"


_OTHERS = ["PCP", "SNO", "TMN", "TMX", "UUU", "VVV", "WAV"]
FORECAST_OPEN_PIVOT = f"""
WITH items AS (SELECT * REPLACE (CASE WHEN category = 'SNO' THEN 'NEW' || (nx % 3) ELSE category END AS category) FROM ({S['forecast_items']}) i),
coords AS ({S['coordinates']}), loc AS ({_LOC}),
long AS (SELECT i.*, loc.LOCATION, loc.BROAD_LOCATION FROM items i JOIN loc ON i.nx = loc.nx AND i.ny = loc.ny)
SELECT baseDate, baseTime, fcstDate, fcstTime, nx, ny, LOCATION, BROAD_LOCATION,
       {', '.join(f"{safe_double(_pick(c))} AS {c}" for c in ("WSD", "VEC", "TMP", "POP", "REH"))},
       {', '.join(f"{_pick(c)} AS {c}" for c in ("SKY", "PTY", "PCP", "TMN", "TMX", "UUU", "VVV", "WAV", "NEW0", "NEW1", "NEW2"))}
FROM long GROUP BY ALL
"""

FORECAST_WIDE = f"""
WITH items AS ({S['forecast_items']}), coords AS ({S['coordinates']}), loc AS ({_LOC}),
long AS (SELECT i.*, loc.LOCATION, loc.BROAD_LOCATION FROM items i JOIN loc ON i.nx = loc.nx AND i.ny = loc.ny)
SELECT baseDate, baseTime, fcstDate, fcstTime, nx, ny, LOCATION, BROAD_LOCATION,
       {', '.join(f"{safe_double(_pick(c))} AS {c}" for c in ("WSD", "VEC", "TMP", "POP", "REH"))},
       {_pick('SKY')} AS SKY, {_pick('PTY')} AS PTY,
       {', '.join(f"{_pick(c)} AS {c}" for c in _OTHERS)}
FROM long GROUP BY baseDate, baseTime, fcstDate, fcstTime, nx, ny, LOCATION, BROAD_LOCATION
"""

_SKY = "coalesce(CASE SKY WHEN '1' THEN '맑음' WHEN '2' THEN '구름조금' WHEN '3' THEN '구름많음' WHEN '4' THEN '흐림' END, SKY)"
_PTY = f"coalesce(CASE {safe_double('PTY')} WHEN 0 THEN '없음' WHEN 1 THEN '비' WHEN 2 THEN '비/눈' WHEN 3 THEN '눈' WHEN 4 THEN '눈/비' END, PTY)"
_DI = di("TMP", "REH")
_ALERT = f"CASE WHEN {_DI} >= 80 THEN '매우 높음 🟥' WHEN {_DI} >= 75 THEN '높음 🟧' ELSE '보통 🟨' END"


def processed(base: str, others: str = "") -> str:
    return f"""SELECT baseDate AS BASE_DATE, baseTime AS BASE_TIME, fcstDate AS FCST_DATE, fcstTime AS FCST_TIME,
       nx AS NX, ny AS NY, LOCATION, BROAD_LOCATION, WSD, VEC, TMP, POP, REH, {_SKY} AS SKY, {_PTY} AS PTY,
       CASE WHEN WSD >= 14 THEN 'Yes' ELSE 'No' END AS STRONG_WIND_ALERT,
       {_DI} AS DI, {_ALERT} AS DISCOMFORT_ALERT{others}
FROM ({FORECAST_WIDE}) w WHERE fcstDate >= '{base}'"""


FORECAST_LABELS = f"""SELECT BASE_DATE, BASE_TIME, FCST_DATE, FCST_TIME, NX, NY, LOCATION, BROAD_LOCATION,
       WSD, SKY, PTY, STRONG_WIND_ALERT FROM ({processed(R.FORECAST_BASE_DATE)}) p"""

FORECAST_DISCOMFORT = f"""SELECT FCST_DATE, FCST_TIME, LOCATION, TMP, REH, DI, DISCOMFORT_ALERT
FROM ({processed(R.FORECAST_BASE_DATE)}) p"""

_FC_COLS = ["BASE_DATE", "BASE_TIME", "FCST_DATE", "FCST_TIME", "NX", "NY", "LOCATION", "BROAD_LOCATION",
            "WSD", "VEC", "TMP", "POP", "REH", "SKY", "PTY", "STRONG_WIND_ALERT", "DI", "DISCOMFORT_ALERT"]
_FC_KEYS = ["BASE_DATE", "FCST_DATE", "FCST_TIME", "LOCATION"]
_FC_REST = [c for c in _FC_COLS if c not in _FC_KEYS and c != "BASE_TIME"]
def merge_sql(target: str, source: str, cols, keys, order) -> str:
    """MERGE as SQL: source deduped per key (order, then every other column
    descending), then a full outer join taking the source side when matched."""
    rest = [c for c in cols if c not in keys and c not in order]
    order_by = ", ".join(c + " DESC NULLS LAST" for c in list(order) + rest)
    return f"""
WITH t AS ({target}), s0 AS ({source}),
s AS (SELECT {', '.join(cols)} FROM (
        SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order_by}) AS rn
        FROM s0 WHERE {' AND '.join(k + ' IS NOT NULL' for k in keys)}) x WHERE rn = 1
      UNION ALL SELECT {', '.join(cols)} FROM s0 WHERE {' OR '.join(k + ' IS NULL' for k in keys)}),
sh AS (SELECT *, true AS hit FROM s)
SELECT {', '.join(f'CASE WHEN sh.hit THEN sh.{c} ELSE t.{c} END AS {c}' for c in cols)}
FROM t FULL OUTER JOIN sh ON {' AND '.join(f't.{k} = sh.{k}' for k in keys)}
"""


_FC_P = processed('20240101')
_FC_T = f"SELECT * FROM ({_FC_P}) p WHERE FCST_DATE <= '20240120'"
_FC_S = f"SELECT * REPLACE ('1100' AS BASE_TIME, WSD + 0.5 AS WSD) FROM ({_FC_P}) p WHERE FCST_DATE >= '20240115'"
_FC_MERGE = merge_sql(_FC_T, _FC_S, _FC_COLS, _FC_KEYS, ["BASE_TIME"])
FORECAST_UPSERT = _FC_MERGE
# streaming: the first run merges into an empty table (its own repeats deduped)
_EMPTY = f"SELECT * FROM ({_FC_T}) e WHERE false"
_FC_STREAM = merge_sql(merge_sql(_EMPTY, _FC_T, _FC_COLS, _FC_KEYS, ["BASE_TIME"]), _FC_S,
                       _FC_COLS, _FC_KEYS, ["BASE_TIME"])
STREAM_UPSERT = _FC_STREAM

FORECAST_RETENTION = f"""
SELECT * FROM ({processed('20240101')}) p
WHERE NOT coalesce(FCST_DATE < '{R.FORECAST_BASE_DATE}', false)
"""

# ---------------------------------------------------------------- score
OBS = f"""
SELECT o.region_idx, o.timestamp, strptime(o.timestamp, '%Y%m%d%H%M') AS ts,
       strftime(strptime(o.timestamp, '%Y%m%d%H%M'), '%Y-%m-%d %H:%M') AS timestamp_readable,
       CASE WHEN wind_dir = -9 THEN NULL ELSE wind_dir END AS wind_dir,
       CASE WHEN wind_speed = -9 THEN NULL ELSE wind_speed END AS wind_speed,
       CASE WHEN temp = -9 THEN NULL ELSE temp END AS temp,
       CASE WHEN humidity = -9 THEN NULL ELSE humidity END AS humidity,
       CASE WHEN precipitation = -9 THEN 0.0 ELSE precipitation END AS precipitation,
       CASE WHEN ground_temp = -9 THEN NULL ELSE ground_temp END AS ground_temp,
       r.region_name, r.region_code
FROM ({S['observations_raw']}) o JOIN ({S['regions']}) r ON o.region_idx = r.region_idx
"""

FLAGS = f"""
SELECT o.*, CAST(o.ts AS DATE) AS day, h.holiday IS NOT NULL AS is_holiday,
       CAST(isodow(o.ts) - 1 AS INTEGER) AS weekday,
       CASE WHEN h.holiday IS NOT NULL THEN '{K.DAY_TAG_HOLIDAY}' WHEN isodow(o.ts) >= 6 THEN '{K.DAY_TAG_WEEKEND}'
            ELSE '{K.DAY_TAG_WEEKDAY}' END AS day_tag
FROM ({OBS}) o LEFT JOIN (SELECT DISTINCT holiday FROM ({S['holidays']}) hh) h ON CAST(o.ts AS DATE) = h.holiday
"""

FILTERED = f"SELECT * FROM ({FLAGS}) f WHERE weekday >= 5 OR is_holiday"

HOLIDAY_FILTER = f"""SELECT region_code, timestamp, timestamp_readable, weekday, is_holiday, day_tag
FROM ({FILTERED}) x"""

_MEASURES = [("temp", "avg_temp"), ("wind_speed", "wind_speed"), ("precipitation", "precipitation"),
             ("humidity", "humidity"), ("ground_temp", "ground_temp"), ("wind_dir", "wind_dir")]
SUMMARY = f"""
SELECT region_code, region_name, region_idx, CAST(date_trunc('week', ts) AS DATE) AS week_start,
       {', '.join(f'{mean_half_up(src)} AS {out}' for src, out in _MEASURES)},
       max(timestamp_readable) AS last_updated, count(*) AS n_records
FROM ({FILTERED}) f GROUP BY region_code, region_name, region_idx, CAST(date_trunc('week', ts) AS DATE)
"""

WEEKLY_SUMMARY = f"SELECT * EXCLUDE (region_idx) FROM ({SUMMARY}) s"

_DI_AVG = di("avg_temp", "humidity")


def scored(summary: str) -> str:
    return f"""
SELECT *, CAST(greatest(0, least(100, 100
    - CASE WHEN {_DI_AVG} >= 80 THEN 40 WHEN {_DI_AVG} >= 75 THEN 20 WHEN {_DI_AVG} <= 60 THEN -10 ELSE 0 END
    - CASE WHEN precipitation > 10 THEN 40 WHEN precipitation > 0 THEN 20 ELSE 0 END
    - CASE WHEN wind_speed > 10 THEN 30 WHEN wind_speed > 5 THEN 15 ELSE 0 END
    - CASE WHEN ground_temp > 35 OR ground_temp < 5 THEN 20 ELSE 0 END
    + CASE WHEN avg_temp + humidity + precipitation + wind_speed IS NULL THEN NULL ELSE 0 END)) AS INTEGER) AS score0,
    CASE WHEN avg_temp + humidity + precipitation + wind_speed IS NULL THEN NULL ELSE score0 END AS score,
       CAST(week_start + INTERVAL 7 DAY AS DATE) AS date
FROM ({summary}) s
"""


SCORED = f"SELECT * EXCLUDE (score0) FROM ({scored(SUMMARY)}) z"


def _run(day: str) -> str:
    """One run's scores: the seven days before it."""
    return f"""
SELECT region_code, region_name, date, avg_temp, wind_speed, precipitation, humidity, ground_temp, wind_dir, score FROM ({scored(f"""
SELECT region_code, region_name, DATE '{day}' - 7 AS week_start, {', '.join(f'{mean_half_up(src)} AS {out}' for src, out in _MEASURES)}
FROM ({FILTERED}) f WHERE ts >= TIMESTAMP '{day}' - INTERVAL 7 DAY AND ts < TIMESTAMP '{day}' GROUP BY region_code, region_name""")}) z"""


WEEKLY_BY_RUN = _run("2024-01-14") + " UNION ALL " + _run("2024-01-22")

OUTDOOR_SCORE = f"""SELECT region_code, week_start, avg_temp, humidity, precipitation, wind_speed, ground_temp, score
FROM ({SCORED}) x"""

SCORE_TOP3 = f"""
SELECT week_start, rank, region_name, region_code, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY week_start ORDER BY score DESC, region_idx ASC) AS INTEGER) AS rank
  FROM ({SCORED}) x WHERE score IS NOT NULL) y WHERE rank <= 3
"""

SCORE_BOTTOM3 = f"""
SELECT week_start, CAST(row_number() OVER (PARTITION BY week_start ORDER BY score DESC, region_idx ASC) AS INTEGER) AS rank,
       region_name, region_code, score FROM (
  SELECT *, row_number() OVER (PARTITION BY week_start ORDER BY score ASC, region_idx DESC) AS back
  FROM ({SCORED}) x WHERE score IS NOT NULL) y WHERE back <= 3
"""

_LINES = f"""
SELECT region_code, week_start,
       string_agg(line, chr(10) || '- ' ORDER BY day) AS target_days
FROM (SELECT DISTINCT region_code, CAST(date_trunc('week', ts) AS DATE) AS week_start, day, day_tag,
             strftime(day, '%m-%d') || ' (' || substr('{K.WEEKDAY_LABELS}', isodow(day), 1) || ') - ' || day_tag AS line
      FROM ({FILTERED}) f) d
GROUP BY region_code, week_start
"""


def _txt(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), 'None')"


SCORE_REPORT = f"""
SELECT s.region_code, s.week_start, l.target_days,
       '📆 ' || s.region_name || ' 공휴일/주말 날씨 만족도 분석 결과 (' || strftime(s.week_start, '%Y-%m-%d') || ' ~ '
       || strftime(s.week_start + INTERVAL 6 DAY, '%Y-%m-%d') || ')' || chr(10) || chr(10) || '🌤️ 분석 대상일:' || chr(10)
       || '- ' || l.target_days || chr(10) || chr(10) || '📊 종합 점수: ' || {_txt('s.score')} || '점' || chr(10) || chr(10)
       || '📌 요약 지표:' || chr(10) || '- 평균 기온: ' || {_txt('s.avg_temp')} || '°C' || chr(10)
       || '- 풍속: ' || {_txt('s.wind_speed')} || ' m/s' || chr(10) || '- 강수량: ' || {_txt('s.precipitation')} || ' mm'
       || chr(10) || '- 습도: ' || {_txt('s.humidity')} || '%' || chr(10) || '- 지면온도: ' || {_txt('s.ground_temp')}
       || '°C' || chr(10) || '- 풍향: ' || {_txt('s.wind_dir')} || '°' || chr(10) AS message
FROM ({SCORED}) s JOIN ({_LINES}) l ON s.region_code = l.region_code AND s.week_start = l.week_start
"""

_SC_COLS = ["region_code", "region_name", "date", "avg_temp", "wind_speed", "precipitation", "humidity",
            "ground_temp", "wind_dir", "score"]
_SC_REST = [c for c in _SC_COLS if c not in ("region_code", "date")]
SCORE_UPSERT = f"""
WITH tab AS (SELECT {', '.join(_SC_COLS)} FROM ({SCORED}) x),
t AS (SELECT * FROM tab WHERE date <= DATE '2024-01-22'),
s0 AS (SELECT * REPLACE (region_name || '*' AS region_name) FROM tab),
s AS (SELECT {', '.join(_SC_COLS)} FROM (
        SELECT *, row_number() OVER (PARTITION BY region_code, date
               ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in _SC_REST)}) AS rn
        FROM s0 WHERE region_code IS NOT NULL AND date IS NOT NULL) x WHERE rn = 1
      UNION ALL SELECT * FROM s0 WHERE region_code IS NULL OR date IS NULL),
sh AS (SELECT *, true AS hit FROM s)
SELECT {', '.join(f'CASE WHEN sh.hit THEN sh.{c} ELSE t.{c} END AS {c}' for c in _SC_COLS)}
FROM t FULL OUTER JOIN sh ON t.region_code = sh.region_code AND t.date = sh.date
"""

DQ_EMPTY = f"""
WITH w AS (SELECT DISTINCT region_code, CAST(date_trunc('week', ts) AS DATE) AS week_start FROM ({OBS}) o),
k AS (SELECT region_code, CAST(date_trunc('week', ts) AS DATE) AS week_start, count(*) AS n_rows
      FROM ({FILTERED}) f GROUP BY ALL)
SELECT w.region_code, w.week_start, CAST(coalesce(k.n_rows, 0) AS BIGINT) AS n_rows, coalesce(k.n_rows, 0) = 0 AS skipped
FROM w LEFT JOIN k ON w.region_code = k.region_code AND w.week_start = k.week_start
"""

# ---------------------------------------------------------------- grids
_HOURS = "[" + ", ".join(str(h) for h in K.TYPHOON_HOURS) + "]"


def _grid(step: int) -> str:
    return f"""
WITH r AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders),
d AS (SELECT run_date, unnest(generate_series(CAST(run_date AS TIMESTAMP) - INTERVAL 3 DAY,
                                              CAST(run_date AS TIMESTAMP), INTERVAL {step} DAY)) AS day FROM r)
SELECT run_date, unnest(list_transform({_HOURS}, lambda h: day + to_hours(h))) AS stamp FROM d
"""


TIME_GRID_6H = _grid(1)
TIME_GRID_STEP = _grid(3)

MONTH_DAYS = """
WITH r AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS run_month FROM orders)
SELECT run_month, CAST(unnest(generate_series(CAST(run_month - INTERVAL 1 MONTH AS TIMESTAMP),
                                            CAST(run_month - INTERVAL 1 DAY AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
FROM r
"""

# -------------------------------------------------------------- quality
DQ_UNIQUE = f"""SELECT DATE, STN, count(*) AS n FROM ({S['hourly_dust']}) r
WHERE DATE IS NOT NULL AND STN IS NOT NULL GROUP BY DATE, STN HAVING count(*) > 1"""

DQ_NOT_NULL = f"SELECT region_code, timestamp FROM ({OBS}) o WHERE ground_temp IS NULL"

DQ_PIVOT_KEY = """
SELECT strftime(ts, '%Y%m%d') AS fcstDate, strftime(ts, '%H') || '00' AS fcstTime,
       CAST(user_id % 5 AS INTEGER) AS nx, CAST(user_id % 3 AS INTEGER) AS ny, event_type AS category,
       count(*) AS n
FROM events GROUP BY ALL HAVING count(*) > 1
"""

DQ_FRESHNESS = f"""
SELECT event_type, max(ts) AS newest,
       (epoch_us(TIMESTAMP '{R.RUN_TS}') - epoch_us(max(ts))) / 3.6e9 AS age_hours,
       (epoch_us(TIMESTAMP '{R.RUN_TS}') - epoch_us(max(ts))) / 3.6e9 > 24.0 AS stale
FROM events GROUP BY event_type
"""

# ----------------------------------------------------------- misc shapes
NULL_UNION = "SELECT CAST(c_custkey AS INTEGER) AS id FROM customer UNION ALL SELECT CAST(NULL AS INTEGER) AS id"
NULL_UNION_FILTER = f"SELECT * FROM ({NULL_UNION}) u WHERE id = 1"

SHAPE_COLUMNS = f"""
SELECT {region_by('eqPt')} AS REGION, eqDate AS EQ_DATE, magMl AS MAG_ML, TIMESTAMP '{R.RUN_TS}' AS LOADED_AT
FROM ({DOM}) d
"""

PREVIEW = f"SELECT * FROM ({QUAKE_REGION_LATEST}) q ORDER BY eq_count DESC, region LIMIT 5"


ORACLE = {
    "dust_current_grades": DUST_CURRENT,
    "dust_keep_first": DUST_KEEP_FIRST,
    "dust_monthly_mean": MONTHLY,
    "dust_monthly_dated": DUST_MONTHLY_DATED,
    "quake_domestic": DOM,
    "quake_foreign": FGN,
    "quake_region_latest": QUAKE_REGION_LATEST,
    "quake_region_max": QUAKE_REGION_MAX,
    "quake_day_replace": QUAKE_DAY_REPLACE,
    "typhoon_clean": TYPHOON_CLEAN,
    "typhoon_upsert": TYPHOON_UPSERT,
    "typhoon_table_upsert": TYPHOON_UPSERT,
    "holiday_calendar": HOLIDAY_CALENDAR,
    "dq_suite": """
WITH l AS (SELECT *, CASE WHEN l_linenumber % 3 > 0 THEN l_returnflag END AS l_note FROM lineitem),
k AS (SELECT count(*) AS n FROM l WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber)
SELECT 'rows' AS "check", CAST(count(*) = 0 AS BIGINT) AS failing, CAST(count(*) AS VARCHAR) AS value FROM l
UNION ALL SELECT 'unique l_orderkey, l_linenumber', count(*), NULL FROM k WHERE n > 1
UNION ALL SELECT 'newest l_shipdate', CAST(max(l_shipdate) IS NULL AS BIGINT), CAST(max(l_shipdate) AS VARCHAR) FROM l
UNION ALL SELECT 'not null l_note', count(*) FILTER (l_note IS NULL), NULL FROM l
UNION ALL SELECT 'not null l_shipdate', count(*) FILTER (l_shipdate IS NULL), NULL FROM l
UNION ALL SELECT 'not null l_orderkey', count(*) FILTER (l_orderkey IS NULL), NULL FROM l""",
    "fixed_width_inferred": f"""SELECT {', '.join(c if c not in _FILLED else f"CASE WHEN CAST(SEQ AS INTEGER) % {_FILLED.index(c) + 2} = 0 THEN SEQ END AS {c}" for c in K.TYPHOON_COLUMNS)}
                                FROM ({S['raw_typhoon']}) r""",
    "load_once_table": f"SELECT DATE, ORG, STN, PM10 FROM ({S['hourly_dust']}) r",
    "quake_region_incremental": QUAKE_REGION_INCREMENTAL,
    "forecast_open_pivot": FORECAST_OPEN_PIVOT,
    "bad_batch_drop": BAD_BATCH_DROP,
    "forecast_wide": FORECAST_WIDE,
    "forecast_labels": FORECAST_LABELS,
    "forecast_discomfort": FORECAST_DISCOMFORT,
    "forecast_upsert": FORECAST_UPSERT,
    "forecast_retention": FORECAST_RETENTION,
    "holiday_filter": HOLIDAY_FILTER,
    "weekly_summary": WEEKLY_SUMMARY,
    "outdoor_score": OUTDOOR_SCORE,
    "score_top3": SCORE_TOP3,
    "score_bottom3": SCORE_BOTTOM3,
    "score_report": SCORE_REPORT,
    "score_upsert": SCORE_UPSERT,
    "dq_empty": DQ_EMPTY,
    "time_grid_6h": TIME_GRID_6H,
    "time_grid_step": TIME_GRID_STEP,
    "month_days": MONTH_DAYS,
    "dq_unique": DQ_UNIQUE,
    "dq_not_null": DQ_NOT_NULL,
    "dq_pivot_key": DQ_PIVOT_KEY,
    "dq_freshness": DQ_FRESHNESS,
    "null_union": NULL_UNION,
    "null_union_filter": NULL_UNION_FILTER,
    "shape_columns": SHAPE_COLUMNS,
    "preview": PREVIEW,
}


# --------------------------------------------------- round trips / tables
_OBS_CONV = """
SELECT timestamp, strftime(strptime(timestamp, '%Y%m%d%H%M'), '%Y-%m-%d %H:%M') AS timestamp_readable,
       CASE WHEN wind_dir = -9 THEN NULL ELSE wind_dir END AS wind_dir,
       CASE WHEN wind_speed = -9 THEN NULL ELSE wind_speed END AS wind_speed,
       CASE WHEN temp = -9 THEN NULL ELSE temp END AS temp,
       CASE WHEN humidity = -9 THEN NULL ELSE humidity END AS humidity,
       CASE WHEN precipitation = -9 THEN 0.0 ELSE precipitation END AS precipitation,
       CASE WHEN ground_temp = -9 THEN NULL ELSE ground_temp END AS ground_temp
"""

_STATION_TEXT = f"""
SELECT STN_ID, TM_ED, TM_ST, STN_KO, STN_EN, STN_SP, CAST(LON AS VARCHAR) AS LON, CAST(LAT AS VARCHAR) AS LAT,
       CAST(HT AS VARCHAR) AS HT, STN_AD, FCT_ID FROM ({S['station_master']}) s
"""

_KEEP = ", ".join(f"'{x}'" for x in K.STATION_KEEP_IDS)

ORACLE.update({
    "text_roundtrip": f"SELECT DATE, ORG, STN, PM10 FROM ({S['hourly_dust']}) r",
    "avg_text_roundtrip": f"SELECT kst, STN_ID, avg FROM ({S['daily_dust_mean']}) m WHERE n NOT IN (0, 1)",
    "obs_roundtrip": f"{_OBS_CONV} FROM ({S['observations_raw']}) o WHERE event_id % 59 <> 0 AND event_id % 53 <> 0",
    "fixed_width_roundtrip": f"SELECT {', '.join(K.TYPHOON_COLUMNS)} FROM ({S['raw_typhoon']}) r",
    "xml_roundtrip": f"""SELECT * REPLACE (replace(replace(reFer, chr(10), ' '), chr(13), ' ') AS reFer)
                         FROM ({S['raw_eq_world']}) r""",
    "json_roundtrip": f"""WITH items AS ({S['forecast_items']}), coords AS ({S['coordinates']}), loc AS ({_LOC})
                          SELECT i.*, loc.LOCATION, loc.BROAD_LOCATION FROM items i
                          JOIN loc ON i.nx = loc.nx AND i.ny = loc.ny""",
    "station_scan": _STATION_TEXT,
    "station_keep": f"SELECT * FROM ({_STATION_TEXT}) s WHERE STN_ID IN ({_KEEP})",
    "coords_csv": """SELECT c_mktsegment AS level1, CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'say "hi", ' || c_name WHEN 2 THEN c_name || chr(10) || 'line' ELSE c_name END AS level2,
                            CAST(c_nationkey AS INTEGER) AS nx, CAST(c_custkey % 100 AS INTEGER) AS ny FROM customer""",
    "tables_roundtrip": DUST_CURRENT,
    "csv_roundtrip": MONTHLY,
})

# ------------------------------------------------------------- streaming
ORACLE.update({
    "stream_ingest": f"SELECT DATE, ORG, STN, PM10 FROM ({S['hourly_dust']}) r",
    "stream_dedupe": "SELECT DISTINCT strftime(ts, '%Y%m%d') AS DATE, CAST(user_id AS VARCHAR) AS STN, date_trunc('day', ts)::TIMESTAMP AS event_time FROM events",
    "stream_upsert": STREAM_UPSERT,
})

# ------------------------------------------------------- weekly message
_RULE = K.REPORT_RULE


def _section(ranked_sql: str) -> str:
    return f"""
SELECT r.week_start, string_agg(chr(10) || CAST(r.rank AS VARCHAR) || '위: ' || r.region_name || chr(10) || b.message,
                                chr(10) || '{K.REPORT_DIVIDER}' || chr(10) ORDER BY r.rank) AS sec
FROM ({ranked_sql}) r JOIN ({SCORE_REPORT}) b ON r.region_code = b.region_code AND r.week_start = b.week_start
GROUP BY r.week_start"""


SCORE_MESSAGE = f"""
SELECT t.week_start,
       '📊 주간 날씨 만족도 분석 결과 (' || strftime(t.week_start, '%Y-%m-%d') || ' ~ '
       || strftime(t.week_start + INTERVAL 6 DAY, '%Y-%m-%d') || ')'
       || chr(10) || chr(10) || '{_RULE}' || chr(10) || '{K.REPORT_TOP}' || chr(10) || '{_RULE}' || chr(10) || t.sec
       || chr(10) || chr(10) || '{_RULE}' || chr(10) || '{K.REPORT_BOTTOM}' || chr(10) || '{_RULE}' || chr(10) || b.sec
       AS message
FROM ({_section(SCORE_TOP3)}) t JOIN ({_section(SCORE_BOTTOM3)}) b ON t.week_start = b.week_start
"""
ORACLE["score_message"] = SCORE_MESSAGE

# ------------------------------------------------------------ time text
TS_FORMATS = """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d%H%M') AS minute_text,
       strftime(o_orderdate, '%Y.%m.%d.%H:%M') AS station_text,
       strftime(o_orderdate, '%Y%m%d%H%M%S') AS second_text,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS iso_text,
       strftime(o_orderdate, '%Y-%m-%d %H:%M') AS readable,
       strftime(date_trunc('hour', o_orderdate), '%Y%m%d%H') || '00' AS hour_stamp,
       strftime(o_orderdate, '%Y-%m') AS month_text, strftime(o_orderdate, '%Y%m%d') AS day_text,
       try_strptime(strftime(o_orderdate, '%Y%m%d%H%M'), '%Y%m%d%H%M') AS from_minute,
       try_strptime(strftime(o_orderdate, '%Y.%m.%d.%H:%M'), '%Y.%m.%d.%H:%M') AS from_station,
       try_strptime(strftime(o_orderdate, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S') AS from_second,
       try_strptime(strftime(o_orderdate, '%Y%m%d') || '2400', '%Y%m%d%H%M') AS from_hour24
FROM orders
"""

WEEK_WINDOW = """
SELECT run_date,
       strftime(run_date - INTERVAL 7 DAY, '%Y%m%d') || '0000' AS tm1,
       strftime(run_date - INTERVAL 1 DAY, '%Y%m%d') || '2300' AS tm2,
       CAST(date_trunc('month', run_date) - INTERVAL 1 MONTH AS DATE) AS prev_month_first,
       CAST(date_trunc('month', run_date) - INTERVAL 1 DAY AS DATE) AS prev_month_last,
       CAST(run_date AS TIMESTAMP) AS day_start,
       CAST(run_date AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND AS day_end
FROM (SELECT DISTINCT CAST(ts AS DATE) AS run_date FROM events) d
"""
ORACLE["ts_formats"] = TS_FORMATS
ORACLE["week_window"] = WEEK_WINDOW

# ------------------------------------------------------------ edge values
ORACLE |= {
    "weekly_scores_by_run": WEEKLY_BY_RUN,
    "forecast_all_categories": processed("20240115", ", " + ", ".join(_OTHERS)),
    "newest_snapshot_null_day": f"""
SELECT CAST(event_time::DATE - DATE '2023-12-01' AS INTEGER) AS DAY, ORG, STN, PM10 FROM ({S['hourly_dust']}) r
WHERE arrival % 10 <> 0 AND event_time::DATE = (SELECT max(ts)::DATE FROM events WHERE event_id % 10 <> 0)""",
    "sentinel_forms": """
SELECT o_orderkey, CASE o_orderkey % 10 WHEN 6 THEN '9' WHEN 7 THEN '-90' WHEN 8 THEN '-9x' WHEN 9 THEN '' END AS value FROM orders""",
    "mean_three_decimals": f"""
SELECT l_suppkey, {mean_half_up('(l_orderkey % 1000 / 1000)', 3)} AS mean_small,
       coalesce(bool_or(l_suppkey = 1 AND l_linenumber = 1), false) AS has_huge FROM lineitem GROUP BY l_suppkey""",
    "region_lookup": f"SELECT region_code, region_name, count(*) AS n FROM ({OBS}) o GROUP BY region_code, region_name",
    "load_counts": """
SELECT 'rows' AS what, count(*) AS n FROM events UNION ALL SELECT 'blank', count(*) FROM events WHERE event_id % 17 = 0
UNION ALL SELECT 'errors', count(*) FROM events WHERE event_type = 'error'""",
    "csv_values_roundtrip": r"""
SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN '  pad  ' WHEN 1 THEN 'say "hi"' WHEN 2 THEN 'two' || chr(10) || 'lines' WHEN 3 THEN 'back\slash'
       WHEN 4 THEN 'a,b' WHEN 5 THEN '' WHEN 6 THEN '"' WHEN 7 THEN chr(9) END AS v, copy
FROM customer, (VALUES ('dated'), ('latest')) c(copy)""",
    "text_control_chars": """
WITH l AS (SELECT c_custkey || '|' || CASE c_custkey % 6 WHEN 0 THEN 'a' || chr(1) || 'b' WHEN 1 THEN chr(2) || 'start' WHEN 2 THEN 'plain'
                  WHEN 3 THEN 'q"q' WHEN 4 THEN ' lead' ELSE '한글' || chr(1) END AS value FROM customer
           UNION ALL SELECT chr(2) || c_custkey FROM customer)
SELECT reader, value FROM l, (VALUES ('scan'), ('read')) r(reader)""",
    "xml_edge_tags": """
SELECT CAST(p_partkey AS VARCHAR) AS msgCode, CASE WHEN p_partkey % 3 = 2 THEN '  ' || p_brand || ' ' END AS eqPt, CAST(NULL AS VARCHAR) AS eqDate FROM part""",
    "station_seed": f"SELECT {', '.join(K.STATION_COLUMNS[:-1])}, NULLIF(FCT_ID, '') AS FCT_ID FROM ({S['station_master']}) s",
    "quake_table_day_replace": f"""
WITH raw AS (SELECT *, substr(eqDate, 1, 8) AS eq_day FROM ({S['raw_eq_world']}) r),
again AS (SELECT * REPLACE ('reloaded' AS reFer) FROM raw WHERE eq_day = '19980802')
SELECT * FROM raw WHERE eq_day IS DISTINCT FROM '19980802' UNION ALL SELECT * FROM again
UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS eqDate, CAST(NULL AS VARCHAR) AS eq_day) FROM again""",
    "forecast_table_retention": """
SELECT event_id, strftime(ts, '%Y%m%d') AS FCST_DATE, CAST(date_trunc('week', ts) AS DATE) AS BASE FROM events WHERE ts >= TIMESTAMP '2024-01-17'""",
}
