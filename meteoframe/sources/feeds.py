"""Structured feeds: fixed-width typhoon text (S4), earthquake XML (S5),
forecast JSON (S6), CSV inputs (S8-S11), catalog tables and inline rows
(S13, S14)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteoframe import constants as K
from meteoframe.functions.numeric import safe_double
from meteoframe.functions.text import is_blank, is_comment_or_blank, newline_to_space, strip
from meteoframe.operators.quality import require_columns

# ------------------------------------------------------------ S4 fixed width
# Column widths of the typhoon listing, in TYPHOON_COLUMNS order.  The feed
# publishes no layout (the edges are inferred from the data), so this is a
# parameter; these widths hold every value the feed documents.
TYPHOON_WIDTHS = [3, 5, 12, 4, 4, 13, 13, 7, 7, 5, 4, 6, 4, 6, 6, 5, 5, 5, 12, 5, 6]


def parse_fixed_width(lines: DataFrame, names: Sequence[str], widths: Sequence[int],
                      comment_prefixes=("#",)) -> DataFrame:
    """Cut each data line at declared widths; fields trimmed, '' -> null.

    Comment and blank lines are dropped first.  ``file``/``pos`` pass through.
    """
    keep = [c for c in ("file", "pos") if c in lines.columns]
    body = lines.filter(~is_comment_or_blank(F.col("value"), comment_prefixes))
    cols, start = [], 1
    for name, w in zip(names, widths):
        field = strip(F.substring("value", start, w))
        cols.append(F.when(field != "", field).alias(name))
        start += w
    return body.select(*cols, *keep)


PIECE = 60          # places of a line that one whole number stands for


def infer_edges(lines: DataFrame, comment_prefixes=("#",)) -> list[tuple[int, int]]:
    """Column edges of a listing without a layout: (start, width), from 1.

    A place is part of a column if any line holds something other than a blank
    there; columns are the runs of such places.  Each line is a bitmap, 60
    places to a number; the numbers are combined by OR in one aggregate over
    all lines, before and after the shuffle, and the driver gets one number
    per 60 places.  Comment and blank lines are left out.
    """
    body = lines.filter(~is_comment_or_blank(F.col("value"), comment_prefixes))
    line = F.regexp_replace(F.regexp_replace(F.rtrim(F.col("value")), r"[^ \t]", "1"), r"[ \t]", "0")
    numbers = F.sequence(F.lit(0), F.floor((F.length("marks") - 1) / PIECE).cast("int"))
    pieces = F.transform(numbers, lambda k: F.conv(F.rpad(F.substr(F.col("marks"), k * PIECE + 1, F.lit(PIECE)), PIECE, "0"), 2, 10).cast("long"))
    found = (body.select(line.alias("marks")).select(F.posexplode(pieces).alias("piece", "bits"))
             .groupBy("piece").agg(F.bit_or("bits").alias("bits")).collect())
    used = sorted(r.piece * PIECE + i for r in found for i in range(PIECE) if r.bits >> (PIECE - 1 - i) & 1)
    starts = [p for k, p in enumerate(used) if k == 0 or used[k - 1] != p - 1]
    ends = [p for k, p in enumerate(used) if k == len(used) - 1 or used[k + 1] != p + 1]
    return [(s + 1, e - s + 1) for s, e in zip(starts, ends)]


def parse_inferred_width(lines: DataFrame, names: Sequence[str], comment_prefixes=("#",)) -> DataFrame:
    """As ``parse_fixed_width``, with the edges inferred from all data lines.  A
    listing with another number of columns than ``names`` is refused: which
    column is missing cannot be told.  No data lines give no rows."""
    edges = infer_edges(lines, comment_prefixes)
    if edges and len(edges) != len(names):
        raise ValueError(f"{len(edges)} columns found, {len(names)} named: {edges}")
    keep = [c for c in ("file", "pos") if c in lines.columns]
    body = lines.filter(~is_comment_or_blank(F.col("value"), comment_prefixes))
    fields = [strip(F.substring("value", s, w)) for s, w in edges or [(1, 0)] * len(names)]
    return body.select(*[F.when(f != "", f).alias(n) for n, f in zip(names, fields)], *keep)


def render_fixed_width(df: DataFrame, names: Sequence[str], widths: Sequence[int]) -> DataFrame:
    """Inverse of parse_fixed_width: right-aligned fields, nulls blank.  A
    value that does not fit its width (with one leading blank as separator)
    fails the job instead of being cut."""
    parts = []
    for n, w in zip(names, widths):
        v = F.coalesce(F.col(n).cast("string"), F.lit(""))
        too_long = F.length(v) >= w
        msg = F.concat(F.lit(f"value too wide for {n} ({w - 1} chars): "), v)
        parts.append(F.when(too_long, F.raise_error(msg)).otherwise(F.lpad(v, w, " ")))
    return df.select(F.concat(*parts).alias("value"))


# ------------------------------------------------------------------ S5 XML
EQ_XML_SCHEMA = T.StructType([T.StructField(t, T.StringType()) for t in K.EQ_TAGS])
EQ_COLUMNS = [t if t != "ReFer" else "reFer" for t in K.EQ_TAGS]


def read_earthquake_xml(spark: SparkSession, path: str, run_ts: str) -> DataFrame:
    """Every <info> record: 19 optional tags (absent -> null), ReFer -> reFer
    with newlines as spaces, plus created_at = updated_at = run time.
    Text keeps its blanks; an empty tag is null; a malformed record fails.

    A feed whose first info only holds the "no content" marker reads as an
    all-null record; all-null records are dropped, so it yields no rows.
    """
    raw = (spark.read.format("xml").option("rowTag", "info").option("mode", "FAILFAST")
           .option("nullValue", "").option("ignoreSurroundingSpaces", False)
           .schema(EQ_XML_SCHEMA).load(path))
    return eq_records(raw, run_ts)


def eq_records(raw: DataFrame, run_ts: str) -> DataFrame:
    any_set = F.lit(False)
    for t in K.EQ_TAGS:
        any_set = any_set | F.col(t).isNotNull()
    ts = F.to_timestamp(F.lit(run_ts)).cast("timestamp_ntz")
    return raw.filter(any_set).select(
        *[F.col(t) for t in K.EQ_TAGS if t != "ReFer"],
        newline_to_space(F.col("ReFer")).alias("reFer"),
        ts.alias("created_at"), ts.alias("updated_at"))


# ----------------------------------------------------------------- S6 JSON
FORECAST_ITEM = T.StructType([
    T.StructField("baseDate", T.StringType()), T.StructField("baseTime", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("fcstDate", T.StringType()),
    T.StructField("fcstTime", T.StringType()), T.StructField("fcstValue", T.StringType()),
    T.StructField("nx", T.StringType()), T.StructField("ny", T.StringType()),
])
FORECAST_RESPONSE = T.StructType([T.StructField("response", T.StructType([
    T.StructField("body", T.StructType([T.StructField("items", T.StructType([
        T.StructField("item", T.ArrayType(FORECAST_ITEM))]))]))]))])


def forecast_items(responses: DataFrame, json_col: str = "value") -> DataFrame:
    """Explode response.body.items.item; a missing body/items or an empty list
    gives no rows (explode drops null and empty arrays).  Cell numbers may be
    numbers or text; text that is not JSON fails the job."""
    parsed = responses.filter(~is_blank(F.col(json_col))).select(
        F.from_json(F.col(json_col), FORECAST_RESPONSE, {"mode": "FAILFAST"}).alias("r"))
    items = parsed.select(F.explode("r.response.body.items.item").alias("i")).select("i.*")
    return items.withColumns({c: grid_number(c) for c in ("nx", "ny")})


def grid_number(c: str):
    """A grid cell number written as '60' or '60.0'; other text fails the job
    (it would silently match no cell)."""
    v = safe_double(c)
    good = v.isNull() & is_blank(F.col(c)) | (v == F.floor(v))
    return F.when(F.col(c).isNull() | good, v.cast("int")).otherwise(F.raise_error(F.concat(
        F.lit(f"{c} is not a grid cell number: "), F.col(c))))


def read_forecast_json(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Forecast responses: one per line, or - with ``whole_file`` - one per
    file, over as many lines as it likes."""
    return forecast_items(spark.read.option("wholetext", whole_file).text(path))


# ------------------------------------------------------------------ S8-S11 CSV
COORD_SCHEMA = T.StructType([
    T.StructField("level1", T.StringType()), T.StructField("level2", T.StringType()),
    T.StructField("nx", T.IntegerType()), T.StructField("ny", T.IntegerType()),
])

STATION_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType() if c in ("LON", "LAT", "HT") else T.StringType())
     for c in K.STATION_COLUMNS])


def read_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """Coordinates CSV with header; level1, level2, nx, ny required; a null
    level2 becomes ''.  Reads what ``sinks.write_csv`` writes: quotes inside
    values doubled, line feeds inside quotes; a byte order mark is skipped."""
    df = _small_csv(spark).csv(path)
    require_columns(df, ["level1", "level2", "nx", "ny"])
    return df.select(
        "level1", F.coalesce(F.col("level2"), F.lit("")).alias("level2"),
        grid_number("nx").alias("nx"), grid_number("ny").alias("ny"))


def read_station_seed(spark: SparkSession, path: str) -> DataFrame:
    """Station seed CSV (UTF-8, BOM allowed, header; quotes and line feeds as in
    ``read_coordinates``)."""
    return _small_csv(spark).schema(STATION_SCHEMA).csv(path)


def _small_csv(spark: SparkSession):
    """Reader of lists: files small enough to be read by a task each."""
    return (spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"').option("multiLine", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def load_csv(spark: SparkSession, path: str, schema: T.StructType,
             header: bool = True, quote: str = '"', null_value: str | None = None,
             multi_line: bool = False) -> DataFrame:
    """Bulk CSV load of staged files with an explicit schema (no inference).
    A batch read always loads every named file ("forced" load).  Quotes inside
    values are doubled.  Large files are split; if values hold line feeds,
    ``multi_line`` must be on, and each file is read by one task.  Nothing between two
    separators is null and "" is empty text, or null is ``null_value``."""
    return (spark.read.option("header", header).option("quote", quote).option("escape", quote)
            .option("multiLine", multi_line).option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("nullValue", "\u0000" if null_value is None else null_value)
            .option("emptyValue", "").schema(schema).csv(path))


# ------------------------------------------------------------ S13 / S14
def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def inline_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small fixed table as a local relation (``VALUES``): it lives in the
    plan itself, so broadcasting or joining it needs no Python worker and no
    job.  ``schema`` is DDL ('id int, name string'); values are cast to it."""
    cols = [c.strip().split()[0] for c in schema.split(",")]
    types = [" ".join(c.strip().split()[1:]) for c in schema.split(",")]
    if not rows:
        return spark.createDataFrame([], schema)
    body = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    names = ", ".join(f"c{i}" for i in range(len(cols)))
    sel = ", ".join(f"CAST(c{i} AS {t}) AS `{n}`" for i, (n, t) in enumerate(zip(cols, types)))
    return spark.sql(f"SELECT {sel} FROM VALUES {body} AS t({names})")


def regions(spark: SparkSession) -> DataFrame:
    """The 17 score regions with their position (report tie-break order)."""
    rows = [(i, name, code) for i, (name, code) in enumerate(K.REGION_CODES)]
    return inline_rows(spark, rows, "region_idx int, region_name string, region_code string")
