"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe.session import scratch_path

#: Words everywhere in this subpackage: maximal runs of anything but the six
#: ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"

#: Bytes of text that a Python worker handles at once; a longer single text
#: is still handled whole, alone.
SLICE_BYTES = 5 << 20
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read
    back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside go as soon as it has ended, not when the
    driver happens to collect garbage: nothing reads them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def removed(spark: SparkSession, path: str) -> None:
    """A scratch folder of the running job goes, on any file system that Spark
    reaches: nothing reads it again.  None there is no error."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def lean(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches in this session bounded by bytes, not by rows
    alone: two tasks' buffers of long texts must fit beside a small heap."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(conf.get(key)).rstrip("b")) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def slices(batches: Iterator[pa.RecordBatch], column: int | str = 0,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds at most ``limit`` bytes in
    each (or one row)."""
    try:
        yield from _sliced(batches, column, limit)
    finally:
        give_back()


def give_back() -> None:
    """Free memory returned to the machine: an idle worker keeps little beside
    the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):        # another C library
        pass


def _sliced(batches: Iterator[pa.RecordBatch], column: int | str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held + size > limit and i > start:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def words_of(text: str) -> list[str]:
    """Python's view of ``WORD``."""
    for c in GAP_CHARS[1:]:
        if c in text:
            text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def remainder(doc_id: Column, modulus: int = 5) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def distinct_runs(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct byte strings among the runs ``b[starts:ends]``, and the index
    of each run's string.

    Runs of up to 16 bytes are compared as two integers, others as strings.
    """
    size = ends - starts
    padded = np.concatenate([b, np.zeros(16, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (len(b) + 9, 8), (1, 1))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    one = eight[starts].view("<u8").ravel() & masks[np.minimum(size, 8)]
    two = eight[np.minimum(starts + 8, len(b) + 8)].view("<u8").ravel() & masks[np.clip(size - 8, 0, 8)]
    key = (one ^ (one >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + (two ^ (two >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F) + size.astype(np.uint64)
    key ^= key >> np.uint64(31)
    long = np.flatnonzero(size > 16)
    raw = b.tobytes()
    if len(long):                                        # by their own strings: numbers that no short key takes part in
        names: dict[bytes, int] = {}
        own = np.array([names.setdefault(raw[i:j], len(names)) for i, j in zip(starts[long].tolist(), ends[long].tolist())], np.uint64)
        one[long], two[long], key[long] = own, 0, own * np.uint64(0xD6E8FEB86659FD93) + np.uint64(17)
        size = np.minimum(size, 17)
    order = np.argsort(key)
    ranked = key[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    first = order[new]
    index = np.empty(len(key), np.int64)
    index[order] = np.cumsum(new) - 1
    if not ((one == one[first][index]) & (two == two[first][index]) & (size == size[first][index])).all():   # keys met by chance
        names = {}
        index = np.array([names.setdefault(raw[i:j], len(names)) for i, j in zip(starts.tolist(), ends.tolist())], np.int64)
        return list(names), index
    return [raw[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())], index


def word_runs(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words of many texts at once: the distinct ones, the index of each word in
    text order, and where each text's words start (one more at the end)."""
    texts = pc.fill_null(texts, "")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = memoryview(data)[ends[0]:ends[-1]] if data is not None else b""
    b, ends = np.frombuffer(raw, np.uint8), ends - ends[0]
    blank = np.append((b == 0x20) | ((b >= 0x09) & (b <= 0x0D)), True)
    start = np.zeros(len(b) + 1, bool)
    start[ends] = True
    start[1:] |= blank[:-1]
    start &= ~blank                                   # a word's first byte
    first = np.flatnonzero(start)
    places = np.searchsorted(first, ends)
    if not len(first):
        return [], np.zeros(0, np.int64), places
    begun = np.append(True, blank[:-1])               # blank, or a text's start, in front
    begun[ends] = True
    last = np.flatnonzero(~blank[:-1] & (blank[1:] | begun[1:])) + 1
    words, index = distinct_runs(b, first, last)
    return words, index, places
