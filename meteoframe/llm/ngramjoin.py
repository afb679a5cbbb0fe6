"""N-gram Jaccard self-join by MinHash banding.

Texts of equal word sequence form one class.  Each class has a MinHash
signature; bands of it are buckets, with band and row counts chosen for a
target recall at the threshold.  Classes that share a bucket are candidates,
and candidates connected through buckets form a pool.  A pool's full n-gram
sets meet in tiles of bounded size, where all pairs are compared exactly.
Tiles give links per class and a spanning forest of the links, never pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteoframe.llm import tiles as tiles_
from meteoframe.llm.common import lean, slices, stored, word_runs
from meteoframe.llm.components import connected

TILE_ROWS = 512                  # classes in a block of a pool; two blocks meet in a tile
TILE_GRAMS = 2_000_000           # n-grams in a block, beyond its first class
U = np.uint64


def choose_bands(threshold: float, recall: float = 0.9999, most_hashes: int = 128) -> tuple[int, int]:
    """Bands and rows: the most selective rows for which enough bands to find a
    pair at the threshold with the target recall need at most ``most_hashes``."""
    best = None
    for rows in range(1, 17):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)) if threshold < 1 else 1
        if bands * rows <= most_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no banding within most_hashes")
    return best


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def grams(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """64-bit n-gram values of all texts in order, where each text's start (one
    more at the end), and each text's digest of its word sequence (empty: no
    words).  A text of fewer than ``n`` words is one gram of all its words."""
    distinct, index, places = word_runs(texts)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), U, len(distinct))
    words = hashes[index] if len(distinct) else np.zeros(0, U)
    keys = [hashlib.md5(words[a:b].tobytes()).digest() if b > a else b"" for a, b in zip(places, places[1:])]
    total = len(words)
    rolled = np.zeros(max(total - n + 1, 0), U)
    for k in range(n):
        rolled = mixed(rolled + words[k:total - n + 1 + k] + U(k))
    counts = np.diff(places)
    own = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(own)])
    out = np.zeros(starts[-1], U)
    long = counts >= n
    if long.any():
        reps = own[long]
        source = np.repeat(places[:-1][long], reps) + (np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps))
        target = np.repeat(starts[:-1][long], reps) + (np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps))
        out[target] = rolled[source]
    for i in np.flatnonzero((counts > 0) & ~long):
        out[starts[i]] = xxhash.xxh3_64_intdigest(keys[i])
    return out, starts, keys


def band_keys(values: np.ndarray, starts: np.ndarray, bands: int, rows: int, seed: int = 7) -> np.ndarray:
    """Bucket of each (text with grams, band): MinHash values of a band, hashed."""
    draw = np.random.default_rng(seed)
    a = draw.integers(1, 2 ** 63, bands * rows, dtype=U) * U(2) + U(1)
    b = draw.integers(0, 2 ** 63, bands * rows, dtype=U)
    out = np.zeros((len(starts) - 1, bands), U)
    for band in range(bands):
        key = np.full(len(starts) - 1, band, U)
        for i in range(band * rows, (band + 1) * rows):
            v = values * a[i]
            v += b[i]
            key = mixed(key + np.minimum.reduceat(v, starts[:-1]))
        out[:, band] = key
    return out


def signatures(df: DataFrame, doc_id: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """Per row: ``doc_id``, ``seq`` (digest of the words; null without words) and
    ``bands`` (bucket values)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            values, starts, keys = grams(b.column(1), n)
            some = np.flatnonzero(np.diff(starts))
            held: list = [None] * b.num_rows
            if len(some):
                for i, row in zip(some.tolist(), band_keys(values, np.append(starts[:-1][some], starts[-1]), bands, rows).view(np.int64)):
                    held[i] = row
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([k or None for k in keys], pa.binary()), pa.array(held, pa.list_(pa.int64()))], names=["doc_id", "seq", "bands"])

    source = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return source.mapInArrow(run, "doc_id long, seq binary, bands array<long>")


def gram_sets(rows: DataFrame, n: int) -> DataFrame:
    """``node, seq, text`` to ``node``, ``size`` and ``grams`` (the sorted distinct
    64-bit values), where the text has the word sequence ``seq``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            values, starts, keys = grams(b.column(2), n)
            out: list[tuple] = []
            for node, seq, key, i, j in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), keys, starts, starts[1:]):
                if seq == key:
                    own = np.unique(values[i:j])
                    out.append((node, len(own), own.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                                             names=["node", "size", "grams"])

    return rows.select("node", "seq", "text").mapInArrow(run, "node long, size long, grams binary")


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (one from each side) of sets with Jaccard similarity at the
    threshold or above; exact."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.append(True, flat[1:] != flat[:-1])
    gram = np.cumsum(new) - 1
    times = np.bincount(gram)
    shared = times[gram] > 1                               # a gram of one set meets nothing
    gram, owner = gram[shared], owner[shared]
    gram = np.cumsum(np.append(True, gram[1:] != gram[:-1])) - 1 if len(gram) else gram
    common = np.zeros((len(left), len(right)), np.float32)
    at_left, at_right = np.full(len(sets), -1), np.full(len(sets), -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    width = 4096
    cuts = np.searchsorted(gram, np.arange(0, gram[-1] + 1 + width, width)) if len(gram) else []
    for i, j in zip(cuts, cuts[1:]):
        g, o = gram[i:j] % width, owner[i:j]
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        in_left, in_right = at_left[o] >= 0, at_right[o] >= 0
        x[at_left[o[in_left]], g[in_left]] = 1
        y[at_right[o[in_right]], g[in_right]] = 1
        common += x @ y.T                                  # whole numbers below 2**24: exact
    union = sizes[left][:, None] + sizes[right][None, :] - common
    x, y = np.nonzero(common.astype(np.float64) >= threshold * union)
    return left[x], right[y]


def jaccard_join(df: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8,
                 recall: float = 0.9999, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per row of ``df``: ``doc_id``; ``copy_id``, the smallest id of the
    documents with the same words; ``n_links``, how many other rows have an
    n-gram set of Jaccard similarity ``threshold`` or more with this one's;
    ``class_id``, the smallest id that links lead to.

    A pair at the threshold is found with probability ``recall`` at least, a
    closer one with more; no pair below it counts (n-grams are compared as
    64-bit values).  Null and empty texts link with nothing.  Rows without id
    link with nothing and have a null class.  Repeated rows count as rows each.
    An empty table gives an empty table.
    """
    bands, rows = choose_bands(threshold, recall)
    rows_of = stored(signatures(lean(df), doc_id, text, n, bands, rows), "join-signatures")
    named = rows_of.where("seq IS NOT NULL AND doc_id IS NOT NULL")
    classes = stored(named.groupBy("seq").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("weight")), "join-classes")
    # one number per class: distinct sequences may share a repeated id
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "join-nodes")

    one_each = named.join(classes, [named.seq == classes.seq, named.doc_id == classes.rep], "inner").select("node", "bands")
    buckets = one_each.dropDuplicates(["node"]).select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("bucket", "low")
    member = stored(buckets.join(shared, "bucket").select("node", "low").distinct(), "join-members")

    pool = connected(member.select(F.col("node").alias("a"), F.col("low").alias("b"))).withColumnRenamed("root", "component")
    pool = pool.join(classes, "node").select("node", "component", "seq", "rep", "weight")
    texts = df.select(F.col(f"`{doc_id}`").cast("long").alias("rep"), F.col(f"`{text}`").alias("text"))
    sets = gram_sets(texts.join(pool.select("node", "seq", "rep"), "rep"), n).dropDuplicates(["node"])
    sets = stored(sets, "join-sets")

    # near classes share their lowest bucket partner, and so come to lie in one block
    first = member.groupBy("node").agg(F.min("low").alias("first"))
    placed = sets.select("node", "size").join(pool.select("node", "component", "weight"), "node").join(first, "node")
    # neighbours by their first partner lie side by side; a partner's own crowd is dealt out by hash
    crowd = placed.groupBy("component", "first").agg(F.greatest(F.count(F.lit(1)) / tile_rows, F.sum("size") / TILE_GRAMS).alias("blocks"))
    before = Window.partitionBy("component").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    crowd = crowd.withColumn("before", F.coalesce(F.sum("blocks").over(before), F.lit(0.0)))
    dealt = F.pmod(F.xxhash64("node"), F.lit(1 << 20)) / (1 << 20)
    placed = stored(placed.join(crowd, ["component", "first"]).withColumn(
        "block", F.floor(F.col("before") + F.col("blocks") * dealt).cast("int")), "join-blocks")
    # only blocks that a bucket has in common can hold a link
    spans = member.join(placed.select("node", "component", "block"), "node").select("low", "component", "block").distinct()
    tiles = (spans.select("low", "component", F.col("block").alias("i")).join(spans.select("low", F.col("block").alias("j")), "low")
             .where("i <= j").select("component", "i", "j").distinct())
    payloads = sets.select("node", F.col("grams").alias("payload"))
    found = stored(tiles_.compare(placed, tiles, payloads, lambda own, left, right: similar(
        [np.frombuffer(x, U) for x in own], left, right, threshold)), "join-links")

    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("others"))
    roots = connected(found.where("b IS NOT NULL").select("a", "b"))
    groups = roots.join(classes.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("class_rep"))
    by_class = (classes.join(links, "node", "left").join(roots.join(groups, "root").select("node", "class_rep"), "node", "left")
                .select("seq", F.col("rep").alias("copy_id"), (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                        F.coalesce("class_rep", "rep").alias("class_id")))
    linked = named.select("doc_id", "seq").join(by_class, "seq").select("doc_id", "copy_id", "n_links", "class_id")
    alone = rows_of.where("seq IS NULL OR doc_id IS NULL").select(
        "doc_id", F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"))
    return linked.unionByName(alone)
