"""Landed text feeds: line reader and the per-feed line parsers (S1-S3, S7).

Lines come from Spark's text source, so that files of any size are read in
splits.  ``read_lines`` also keeps each line's file and position, which the
keep-first dedupe and the station "body after the first rule line" rule need.

Parsers take a DataFrame with a string column ``value`` (plus ``file`` and
``pos`` when present) and return typed rows; they use built-in expressions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteoframe import constants as K
from meteoframe.functions import dates as D
from meteoframe.functions.numeric import (safe_double, safe_int, null_if_missing,
                                          zero_if_missing)
from meteoframe.operators.joins import join_dimension
from meteoframe.functions.text import (before, bind, is_comment_or_blank, padded_token,
                                       starts_with_digit, token, tokens, is_blank)


def _count_rejects(df: DataFrame, valid: Column, observation: Observation | None) -> DataFrame:
    """Attach 'lines' and 'rejected' counters (no extra pass) when asked."""
    if observation is None:
        return df
    return df.observe(observation, F.count(F.lit(1)).alias("lines"),
                      F.sum(F.when(valid, 0).otherwise(1)).alias("rejected"))


def decoded(value: Column, encoding: str) -> Column:
    """A line's bytes in its charset (EUC-KR needs
    ``spark.sql.legacy.javaCharsets``)."""
    return value if encoding.upper() == "UTF-8" else F.decode(value.cast("binary"), encoding)


def scan_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, value) for every line, in any charset whose bytes below 0x80 are
    ASCII.  Large files are read in splits; no character is special."""
    raw = spark.read.text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), decoded(F.col("value"), encoding).alias("value"))


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, pos, value) for every line.  ``pos`` orders a file's lines: the
    start of the split that holds the line, then the line's place in it."""
    raw = spark.read.text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"),
                      F.struct(F.col("_metadata.file_block_start").alias("split"),
                               F.monotonically_increasing_id().alias("line")).alias("pos"),
                      decoded(F.col("value"), encoding).alias("value"))


# --------------------------------------------------------------- S1 hourly dust
def parse_dust(lines: DataFrame) -> DataFrame:
    """DATE, ORG, STN, PM10 (strings): comment/blank lines dropped, short rows
    padded with '', extra tokens cut."""
    keep = [c for c in ("file", "pos") if c in lines.columns]
    body = bind(lines.filter(~is_comment_or_blank(F.col("value"))), "_p", tokens("value"))
    return body.select(*[padded_token("_p", i).alias(n)
                         for i, n in enumerate(["DATE", "ORG", "STN", "PM10"])], *keep)


# ----------------------------------------------------------- S2 daily dust mean
def parse_daily_mean(lines: DataFrame, observation: Observation | None = None) -> DataFrame:
    """kst (timestamp), STN_ID, avg: '#'/'-' lines skipped, < 6 tokens dropped,
    avg = number before '(' ('25(12)' -> 25.0); rows that fail are dropped
    (counted in ``observation`` when one is given)."""
    body = (bind(lines.filter(~is_comment_or_blank(F.col("value"), ("#", "-"))), "_p", tokens("value"))
            .filter(F.size("_p") >= 6))
    out = bind(body, "_r", F.struct(
        token("_p", 0).alias("kst_text"),
        token("_p", 2).alias("STN_ID"),
        safe_double(before(token("_p", 3), "("), stripped=True).alias("avg"))).select("_r.*")
    out = _count_rejects(out, F.col("avg").isNotNull(), observation)
    return (out.filter(F.col("avg").isNotNull())
            .withColumn("kst", D.parse_ts("kst_text", D.STATION_STAMP))
            .drop("kst_text"))


# ------------------------------------------------------------- S3 station list
def parse_stations(lines: DataFrame, keep_ids=None) -> DataFrame:
    """11 station columns from the lines after the first dashed rule line of
    each file; later rule lines, '#' and blank lines skipped; short rows
    padded with ''.  ``keep_ids`` (list) keeps only those STN_IDs (R3)."""
    is_rule = F.col("value").contains(K.STATION_RULE_MARKER)
    first_rule = (lines.filter(is_rule).groupBy("file")
                  .agg(F.min("pos").alias("_rule_pos")))
    # one row per file, computed: AQE sizes it at runtime
    body = bind(join_dimension(lines, first_rule, "file")
                .filter((F.col("pos") > F.col("_rule_pos")) & ~is_rule
                        & ~is_comment_or_blank(F.col("value"))), "_p", tokens("value"))
    out = body.select(*[padded_token("_p", i).alias(c) for i, c in enumerate(K.STATION_COLUMNS)])
    if keep_ids is not None:
        out = out.filter(F.col("STN_ID").isin(list(keep_ids)))
    return out


# ------------------------------------------------------- S7 hourly observations
OBS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("timestamp_readable", T.StringType()),
    T.StructField("wind_dir", T.IntegerType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("temp", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("ground_temp", T.DoubleType()),
])


def parse_observations(lines: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Hourly observation rows from lines whose first character is a digit.

    A row is dropped when any of the seven tokens is missing or not numeric
    (wind_dir must be an integer) or the time does not parse; only then are
    the -9 codes turned into null (precipitation -9 into 0.0).  With an
    ``Observation``, the data lines seen and rejected are counted in the same
    pass (``observation.get`` after the first action).
    """
    keep = [c for c in ("file", "pos") if c in lines.columns]
    t = K.OBS_TOKENS
    body = bind(lines.filter(starts_with_digit("value") & ~is_blank(F.col("value"))), "_p", tokens("value"))
    raw = bind(body, "_r", F.struct(
        token("_p", t["timestamp"]).alias("timestamp"),
        D.parse_ts(token("_p", t["timestamp"]), D.STAMP_MINUTE).alias("ts"),
        safe_int(token("_p", t["wind_dir"]), stripped=True).alias("wind_dir"),
        *[safe_double(token("_p", t[c]), stripped=True).alias(c)
          for c in ("wind_speed", "temp", "humidity", "precipitation", "ground_temp")])).select("_r.*", *keep)
    ts = F.col("ts")
    valid = ts.isNotNull()
    for c in ("wind_dir", "wind_speed", "temp", "humidity", "precipitation", "ground_temp"):
        valid = valid & F.col(c).isNotNull()
    code = K.OBS_MISSING
    raw = _count_rejects(raw, valid, observation)
    return raw.filter(valid).select(
        "timestamp",
        D.fmt_ts(ts, D.READABLE).alias("timestamp_readable"),
        null_if_missing("wind_dir", code).alias("wind_dir"),
        null_if_missing("wind_speed", float(code)).alias("wind_speed"),
        null_if_missing("temp", float(code)).alias("temp"),
        null_if_missing("humidity", float(code)).alias("humidity"),
        zero_if_missing("precipitation", float(code)).alias("precipitation"),
        null_if_missing("ground_temp", float(code)).alias("ground_temp"),
        *keep)
