"""Registered streaming queries: land files, run the stream, read its sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe import sinks
from meteoframe.plans import dust, forecast
from meteoframe.registry import _forecast_target_source
from meteoframe.session import scratch_path
from meteoframe.sources import render, standins as S, text
from meteoframe.streaming import jobs


def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """T1/S12: two scheduled runs over a landing folder; the second run
    finds no new file and adds nothing."""
    base = scratch_path(spark, "stream-ingest")
    raw = S.hourly_dust(spark, d, with_arrival=True)
    lines = raw.select(F.concat_ws(" ", "DATE", "ORG", "STN", "PM10").alias("value"))
    render.write_lines(lines, base + "/landing", "EUC-KR")
    for _ in range(2):
        parsed = text.parse_dust(jobs.text_lines_stream(spark, base + "/landing", "EUC-KR"))
        jobs.run_available(parsed, base + "/sink", base + "/ckpt")
    return spark.read.parquet(base + "/sink").select(*dust.RAW_COLUMNS)


def stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """T2: the load's own rule - one row per (DATE, STN) - over readings that
    are all delivered twice."""
    base = scratch_path(spark, "stream-dedupe")
    raw = S.hourly_dust(spark, d, with_arrival=True).select("DATE", "STN", F.to_date("DATE", "yyyyMMdd").cast("timestamp_ntz").alias("event_time"))
    raw.write.mode("append").parquet(base + "/landing")
    raw.write.mode("append").parquet(base + "/landing")  # the re-delivery
    src = spark.readStream.schema(raw.schema).parquet(base + "/landing")
    deduped = jobs.dedupe_within_watermark(src, ["DATE", "STN"], "event_time", "4000 days")
    jobs.run_available(deduped, base + "/sink", base + "/ckpt")
    return spark.read.parquet(base + "/sink").select("DATE", "STN", "event_time")


def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """T3: the forecast table fed by two runs' files, merged per micro-batch
    (the second run lands after the first has been merged)."""
    base = scratch_path(spark, "stream-upsert")
    target, source = _forecast_target_source(spark, d)
    db = "fc_" + base.rsplit("-", 1)[-1]
    sinks.ensure_namespace(spark, db, base + "/db")
    table = f"{db}.forecast"
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in target.schema.fields)
    sinks.create_if_absent(spark, table, ddl, location=base + "/table")
    handler = jobs.upsert_batches(table, forecast.KEYS, order=[("BASE_TIME", False)])
    for i, run in enumerate([target, source]):
        run.write.mode("append").parquet(f"{base}/landing/run={i}")
        stream = (spark.readStream.schema(target.schema).option("recursiveFileLookup", True)
                  .parquet(base + "/landing"))
        jobs.run_foreach_batch(stream, handler, base + "/ckpt")
    out = spark.table(table).checkpoint()
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


STREAM_QUERIES = {
    "stream_ingest": stream_ingest,
    "stream_dedupe": stream_dedupe,
    "stream_upsert": stream_upsert,
}
