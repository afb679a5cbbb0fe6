"""Web archives (WARC) with a two-level capture index.

Archives: one gzip member per record, as crawlers write them.  Rows are
written with Spark's text sink, whose line separator is set to an empty gzip
member: the files are plain multi-member gzip, split anywhere, on any file
system that Spark reaches.

Index: captures sorted by reversed-host URL key and cut into compressed
blocks (level two), and a sparse directory with one row per block (level one).
A lookup binary-searches the index files' first keys, then that file's
directory, then the block, and range-reads only the block and the record.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meteoframe.llm.common import lean, slices

#: An empty gzip member with a comment, written between two members.  Its
#: second byte cannot follow its first in UTF-8, so no stored payload holds it.
BETWEEN = b"\x1f\x8b\x08\x10\x00\x00\x00\x00\x00\x03between records\x00\x03\x00" + bytes(8)
SEPARATOR = {"lineSep": BETWEEN.decode("latin-1"), "encoding": "ISO-8859-1"}

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to long, payload binary")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query: ``com,example,blog)/a?b=1``.
    A null or unreadable URL has the key ``-``."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").rstrip(".")
    except ValueError:
        return "-"
    if not host:
        return "-"
    key = ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + ("?" + parts.query if parts.query else "")
    return re.sub(r"\s", "%20", key)


def record_member(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC record as a gzip member.  A revisit holds the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
              ("WARC-Date", date),
              ("WARC-Payload-Digest", "sha1:" + digest),
              ("Content-Type", "application/http; msgtype=response"),
              ("Content-Length", str(len(block)))]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(text.encode() + block + b"\r\n\r\n", 5, mtime=0)


def parse_member(member: bytes) -> dict:
    """A record's fields and payload; checks lengths and digest."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda v: int(v[len("<urn:page:"):-1]) if v and v != "<urn:page:>" else None
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"),
            "record_type": fields["WARC-Type"], "payload_bytes": size, "payload_digest": digest,
            "refers_to": number(fields.get("WARC-Refers-To")), "payload": None if revisit else payload}


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Writes one record per row under ``path``; the payload is the html in UTF-8
    (null: empty).

    Of records with equal payloads of at least ``least_bytes`` bytes, the one
    with the largest id is a response and the others revisit it; shorter ones
    are all responses.  Repeated rows that tie for the largest id are all
    responses.  A row without id revisits a row with one; among rows without
    ids all are responses.  An empty table writes no record.
    """
    own = lean(pages).select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
                       F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "UTF-8").alias("payload"))
    own = own.withColumn("digest", F.unhex(F.sha1("payload")))
    leaders = (own.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
               .agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("copies"))
               .where("copies > 1 AND leader IS NOT NULL").select("digest", "leader"))
    rows = own.join(leaders, "digest", "left").withColumn("revisit", F.expr("leader IS NOT NULL AND NOT (page_id <=> leader)"))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "payload"):
            made = [record_member(p, u, x, base64.b32encode(d).decode(), r, v, date)
                    for p, u, x, d, r, v in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "leader", "revisit")))]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["member"])

    write_members(rows.mapInArrow(members, "member binary"), path)


def write_members(df: DataFrame, path: str) -> None:
    """A frame of gzip members (column ``member``) as multi-member gzip files."""
    df.select(F.col("member").cast("string").alias("value")).write.options(**SEPARATOR).text(path)


def read_members(spark: SparkSession, path: str, parse, schema: str) -> DataFrame:
    """Every gzip member under ``path``: what ``parse(member)`` gives for it (a
    dict of ``schema``), with ``file``, ``offset`` and ``length``.

    A split knows its members' places only from its own start; the sizes of
    the splits before it in the same file are added afterwards.
    """
    raw = (spark.read.options(**SEPARATOR).text(path)
           .select(F.col("value").cast("binary").alias("member"), F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.file_block_start").alias("split")))
    target = pa_schema(spark, schema + ", file string, split long, place long, length long")

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, place = None, 0
        for b in slices(batches, "member"):
            out = []
            for member, file, split in zip(*(b.column(c).to_pylist() for c in ("member", "file", "split"))):
                if at != (file, split):
                    at, place = (file, split), 0
                out.append(parse(member) | {"file": file, "split": split, "place": place, "length": len(member)})
                place += len(member) + len(BETWEEN)
            yield pa.RecordBatch.from_pylist(out, target)

    found = raw.mapInArrow(parsed, schema + ", file string, split long, place long, length long")
    sizes = (raw.groupBy("file", "split").agg(F.sum(F.octet_length("member") + len(BETWEEN)).alias("size"))
             .withColumn("before", F.coalesce(F.sum("size").over(
                 Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .select("file", "split", "before"))
    return (found.join(sizes, ["file", "split"]).withColumn("offset", F.col("before") + F.col("place"))
            .drop("before", "place", "split"))


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records: ``RECORD`` columns with ``file, offset, length``."""
    return read_members(spark, path, parse_member, RECORD)


# ------------------------------------------------------------------ index

CAPTURE = "key string, page_id long, url string, record_type string, payload_digest string, file string, offset long, length long"


def write_index(records: DataFrame, path: str, block_entries: int = 1000) -> None:
    """Sorted, compressed blocks under ``path/blocks`` and the directory under
    ``path/directory``.  A key with many captures spreads over several blocks,
    and over several files, since ids and places sort behind it."""
    spark = records.sparkSession
    captures = records.select("page_id", "url", "record_type", "payload_digest", "file", "offset", "length")

    def keyed(batches):
        for b in batches:
            yield b.append_column("key", pa.array([url_key(u) for u in b.column("url").to_pylist()], pa.string()))

    fields = "page_id long, url string, record_type string, payload_digest string, file string, offset long, length long, key string"
    captures = captures.mapInArrow(keyed, fields)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[str] = []
        member = lambda: pa.RecordBatch.from_arrays([pa.array([gzip.compress("\n".join(lines).encode(), 5, mtime=0)], pa.binary())], names=["member"])
        for b in batches:
            for row in b.to_pylist():
                lines.append(row.pop("key") + " " + json.dumps(row))
                if len(lines) == block_entries:
                    yield member()
                    lines = []
        if lines:
            yield member()

    order = ["key", "page_id", "file", "offset"]
    write_members(captures.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(blocks, "member binary"), f"{path}/blocks")
    directory = read_members(spark, f"{path}/blocks", first_entry, "first_key string, entries long")
    directory.sort("first_key", "file", "offset").write.parquet(f"{path}/directory")


def block_lines(member: bytes) -> list[str]:
    return zlib.decompress(member, 31).decode().split("\n")


def first_entry(member: bytes) -> dict:
    lines = block_lines(member)
    return {"first_key": lines[0].partition(" ")[0], "entries": len(lines)}


def capture(line: str) -> dict:
    key, _, rest = line.partition(" ")
    return {"key": key} | json.loads(rest)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Every index entry, from the blocks that the directory lists."""
    listed = spark.read.parquet(f"{path}/directory").select(F.col("file").alias("block_file"), F.col("offset").alias("block_offset"))
    blocks = read_members(spark, f"{path}/blocks", lambda m: {"lines": block_lines(m)}, "lines array<string>")
    blocks = blocks.select("lines", F.col("file").alias("block_file"), F.col("offset").alias("block_offset"))
    line = blocks.join(listed, ["block_file", "block_offset"], "left_semi").select(F.explode("lines").alias("line"))
    entry = F.from_json(F.substring_index("line", " ", -1), CAPTURE)
    return line.select(F.from_json(F.expr("substring(line, instr(line, ' ') + 1)"), CAPTURE).alias("e"),
                       F.substring_index("line", " ", 1).alias("key")).select("key", *[f"e.{c}" for c in (
                           "page_id", "url", "record_type", "payload_digest", "file", "offset", "length")])


class CaptureIndex:
    """Point lookups.  Holds the index files' first keys (one per file) and the
    directory of the file last searched."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.directory = spark, spark.read.parquet(f"{path}/directory")
        firsts = self.directory.groupBy("file").agg(F.min("first_key").alias("k")).sort("k", "file").collect()
        self.files, self.firsts = [r.file for r in firsts], [r.k for r in firsts]
        self.own: dict[str, list] = {}

    def _span(self, keys: list[str], key: str) -> range:
        """Of sorted first keys, the runs that can hold ``key``."""
        return range(max(bisect.bisect_left(keys, key) - 1, 0), bisect.bisect_right(keys, key))

    def _entries(self, file: str) -> list:
        if file not in self.own:
            rows = self.directory.where(F.col("file") == file).sort("offset").collect()
            self.own = {file: [(r.first_key, r.offset, r.length) for r in rows]}
        return self.own[file]

    def captures(self, url: str) -> list[dict]:
        """All captures of a URL, by page id."""
        key, out = url_key(url), []
        for i in self._span(self.firsts, key):
            entries = self._entries(self.files[i])
            for j in self._span([e[0] for e in entries], key):
                lines = block_lines(read_range(self.spark, self.files[i], *entries[j][1:]))
                keys = [line.partition(" ")[0] for line in lines]
                out += [capture(x) for x in lines[bisect.bisect_left(keys, key):bisect.bisect_right(keys, key)]]
        return sorted((c for c in out if c["url"] == url), key=lambda c: (c["page_id"] is not None, c["page_id"]))

    def record(self, found: dict) -> dict:
        """The archived record of a capture."""
        return parse_member(read_range(self.spark, found["file"], found["offset"], found["length"]))


def read_range(spark: SparkSession, file: str, offset: int, length: int) -> bytes:
    """Bytes of a file on any file system that Spark reaches."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        stream.seek(offset)
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length))
    finally:
        stream.close()
