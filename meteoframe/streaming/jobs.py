"""Structured Streaming forms of the batch loads.

T1  load-once ingest of landing files: a file source with a checkpoint only
    ever reads a file once; ``trigger(availableNow=True)`` drains what has
    landed and stops, so a scheduled run picks up exactly the new files.
T2  cross-batch dedupe of re-delivered rows, with state bounded by a
    watermark (rows later than the watermark are dropped by design).
T3  keyed upsert per micro-batch: ``foreachBatch`` runs the batch MERGE;
    MERGE of the same rows twice equals once, so a replayed batch after a
    failure leaves the table unchanged (at-least-once delivery is enough).
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe import sinks
from meteoframe.sources.text import decoded


def text_lines_stream(spark: SparkSession, landing: str, encoding: str = "UTF-8",
                      max_files: int | None = None) -> DataFrame:
    """Stream of raw lines (column ``value``) from landed text files in any
    charset whose bytes below 0x80 are ASCII."""
    r = spark.readStream.option("recursiveFileLookup", True)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.text(landing).select(decoded(F.col("value"), encoding).alias("value"))


#: Keeps state on the executors' disks instead of in their heaps.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                  state_partitions: int | None = None) -> dict:
    """Append the stream's new rows to ``sink_path`` and stop when drained;
    returns ``progress_counts`` of the run.

    A stateful stream fixes its number of state partitions and its kind of state
    store at its first start (kept in the checkpoint).  ``state_partitions``
    (default: the cluster's cores) and RocksDB, whose state may outgrow memory,
    are used for that first start only; the session's settings are restored
    afterwards.
    """
    spark = df.sparkSession
    wanted = {"spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism),
              "spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        q = (df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(sink_path))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    q.awaitTermination()
    return progress_counts(q)


def progress_counts(query) -> dict:
    """``rows`` read, ``late`` rows that the watermark dropped and keys left in the
    ``state``, over the run's reported batches (``spark.sql.streaming.
    numRecentProgressUpdates`` of them)."""
    batches = query.recentProgress
    operators = [op for b in batches for op in b["stateOperators"]]
    return {"rows": sum(b["numInputRows"] for b in batches),
            "late": sum(op["numRowsDroppedByWatermark"] for op in operators),
            "state": sum(op["numRowsTotal"] for op in (batches[-1]["stateOperators"] if batches else []))}


def dedupe_within_watermark(df: DataFrame, keys: Sequence[str], event_time: str,
                            delay: str = "2 hours") -> DataFrame:
    """Drop re-delivered copies of a key seen within ``delay`` of event time.

    Watermarks need a session-zone TIMESTAMP; a TIMESTAMP_NTZ event time is
    watermarked through a cast copy and keeps its own type in the output.
    """
    wm = "_watermark_ts"
    out = (df.withColumn(wm, F.col(event_time).cast("timestamp"))
           .withWatermark(wm, delay).dropDuplicatesWithinWatermark(list(keys)))
    return out.drop(wm)


def upsert_batches(table: str, keys: Sequence[str], order: Sequence[tuple] = (),
                   partition_col: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch handler merging each micro-batch into ``table``."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read several times below
        try:
            if not batch.isEmpty():
                sinks.upsert_table(batch.sparkSession, table, batch, keys, order, partition_col)
        finally:
            batch.unpersist()
    return handle


def run_foreach_batch(df: DataFrame, handler, checkpoint: str) -> None:
    q = (df.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
