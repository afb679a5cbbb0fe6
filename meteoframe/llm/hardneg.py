"""Hard-negative mining by coordinate pruning of inner-product search.

Rows lie in length buckets: sorted by label and length, cut every ``BUCKET``
rows, each bucket with a sorted list per coordinate of its unit vectors.  An
anchor with least useful score t, and a bucket of length l, need a cosine of
t / (|anchor| * l) at least; from that each of the anchor's largest (focus)
coordinates bounds the same coordinate of a partner.  The narrowest range is
read off its sorted list, the others intersect it, and what is left is scored
exactly.  t rises as better partners are found.  Anchors whose ranges hold
most of a bucket are scored against it in one matrix product.

Blocks of anchors meet groups of buckets in tiles of bounded size: pairs of
block numbers are routed (by label in the search for positives, by length in
the search for negatives), and the blocks follow them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meteoframe.llm.common import lean, stored
from meteoframe.llm.whitening import numbered, quantised

BUCKET = 1024                 # rows of a length bucket
GROUP = 8                     # buckets of a tile
ANCHORS = 256                 # anchors of a tile
FOCUS = 4                     # focus coordinates
SLACK = 1e-9                  # of cosines, for rounding


def _matrix(lists: pa.Array, kind: type) -> np.ndarray:
    """Equally long lists as rows of a matrix."""
    return np.asarray(lists.flatten()).astype(kind).reshape(len(lists), -1)


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(1))


def feasible(q: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of unit vectors' coordinates that a cosine of ``bound`` with a unit
    vector of coordinates ``q`` (one row per bound) leaves open."""
    at = np.arccos(np.clip(q, -1, 1))
    apart = np.arccos(np.clip(bound, -1, 1))[:, None]
    return np.cos(np.minimum(at + apart, np.pi)) - SLACK, np.cos(np.maximum(at - apart, 0)) + SLACK


def exact_scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Integer inner products, rows x anchors: by doubles where every partial
    sum is below 2^53, else by whole numbers of any size."""
    if _norms(rows).max(initial=0) * _norms(anchors).max(initial=0) < 2.0 ** 52:
        return np.rint(rows.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    return rows.astype(object) @ anchors.astype(object).T


class Best:
    """The first ``k`` of one anchor's partners with scores in [low, high], by
    falling score and rising id."""

    def __init__(self, k: int, low: float, high: float):
        self.k, self.least, self.high = k, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = np.flatnonzero((scores >= self.least) & (scores <= self.high))
        if not len(fit):
            return
        scores, ids = np.concatenate([self.scores, scores[fit]]), np.concatenate([self.ids, ids[fit]])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = self.scores[-1]


def prune(unit: np.ndarray, lists: np.ndarray, norms: np.ndarray, q: np.ndarray, q_norms: np.ndarray,
          least: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """For anchors ``q`` with least scores, on one bucket: those that can be
    scored only against all rows, those that reach nothing, and the candidate
    rows of each other."""
    longest, shortest = norms.max(), norms.min()
    scale = q_norms * np.where(least > 0, longest, shortest)
    with np.errstate(divide="ignore", invalid="ignore"):
        bound = np.where(scale > 0, least / scale, np.where(least > 0, np.inf, -np.inf))
        u = np.where(q_norms[:, None] > 0, q / q_norms[:, None], 0.0)
    dead = bound > 1 + SLACK
    open_ = ~dead & (bound <= -1)
    some = np.flatnonzero(~dead & ~open_)
    if not len(some):
        return np.flatnonzero(open_), np.flatnonzero(dead), []
    focus = np.argsort(-np.abs(u[some]), axis=1, kind="stable")[:, :FOCUS]
    low, high = feasible(np.take_along_axis(u[some], focus, 1), bound[some])
    first, last = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
    for f in np.unique(focus):
        column = unit[lists[f], f]
        i, j = np.nonzero(focus == f)
        first[i, j] = np.searchsorted(column, low[i, j], "left")
        last[i, j] = np.searchsorted(column, high[i, j], "right")
    width = last - first
    narrow = width.argmin(1)
    found, wide = [], []
    for n, i in enumerate(some):
        j = narrow[n]
        if 2 * width[n, j] > len(unit):
            wide.append(i)
            continue
        rows = lists[focus[n, j], first[n, j]:last[n, j]]
        values = unit[rows][:, focus[n]]
        found.append((int(i), rows[((values >= low[n]) & (values <= high[n])).all(1)]))
    return np.concatenate([np.flatnonzero(open_), np.array(wide, np.int64)]), np.flatnonzero(dead), found


def search(ids: np.ndarray, labels: np.ndarray, q: np.ndarray, best: list[list[Best]], buckets: list[dict], same: bool) -> None:
    """Fills each anchor's lists from buckets, longest first.  Partners are rows of
    the anchor's label (``same``) or of others; rows with the anchor's id never are."""
    q_norms = _norms(q)
    for b in sorted(buckets, key=lambda b: -b["norms"].max()):
        least = np.array([min((float(w.least) for w in lists), default=np.inf) for lists in best])
        whole, _, found = prune(b["unit"], b["lists"], b["norms"], q, q_norms, least)

        def take(i: int, rows: np.ndarray, scores: np.ndarray) -> None:
            fit = ((b["labels"][rows] == labels[i]) == same) & (b["ids"][rows] != ids[i])
            for w in best[i]:
                w.add(scores[fit], b["ids"][rows][fit])

        if len(whole):
            scores = exact_scores(b["x"], q[whole])
            every = np.arange(len(b["x"]))
            for n, i in enumerate(whole):
                take(int(i), every, scores[:, n])
        for i, rows in found:
            if len(rows):
                take(i, rows, exact_scores(b["x"][rows], q[i:i + 1])[:, 0])


def _read_bucket(row: dict) -> dict:
    ids = np.frombuffer(row["ids"], np.int64)
    x = np.frombuffer(row["x"], np.int64).reshape(len(ids), -1)
    norms = _norms(x)
    return {"ids": ids, "x": x, "norms": norms, "unit": x / np.where(norms > 0, norms, 1)[:, None],
            "labels": np.array(row["labels"], object), "lists": np.frombuffer(row["lists"], np.uint16).reshape(x.shape[1], -1)}


def _to_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order to buckets: ids and vectors, labels, and per coordinate the
    places of the rows by rising value of their unit vectors."""
    held: list[pa.RecordBatch] = []

    def bucket(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        x = _matrix(rows["_x"].combine_chunks(), np.int64)
        norms = _norms(x)
        unit = x / np.where(norms > 0, norms, 1)[:, None]
        lists = np.argsort(unit, axis=0, kind="stable").T.astype(np.uint16)
        return pa.RecordBatch.from_arrays([pa.array([np.asarray(rows["_id"]).astype(np.int64).tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()),
                                           pa.array([rows["_label"].to_pylist()], pa.list_(pa.string())),
                                           pa.array([np.ascontiguousarray(lists).tobytes()], pa.binary()), pa.array([float(norms.max())])],
                                          names=["ids", "x", "labels", "lists", "longest"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BUCKET:
            rows = pa.Table.from_batches(held)
            full = rows.num_rows // BUCKET * BUCKET
            for i in range(0, full, BUCKET):
                yield bucket(rows.slice(i, BUCKET))
            held = rows.slice(full).to_batches()
    if sum(b.num_rows for b in held):
        yield bucket(pa.Table.from_batches(held))


def make_buckets(rows: DataFrame, held: int) -> DataFrame:
    """Length buckets of rows (``_id``, ``_label``, ``_x``), numbered by label and
    length, ``GROUP`` to a group ``_g``."""
    length = F.aggregate("_x", F.lit(0.0), lambda a, c: a + c.cast("double") * c)
    dealt = (rows.withColumn("_length", length).withColumn("_mix", F.xxhash64("_id"))
             .repartitionByRange(max(1, math.ceil(held / (BUCKET * GROUP))), "_label", F.desc("_length"), "_mix")
             .sortWithinPartitions("_label", F.desc("_length"), "_mix").select("_id", "_label", "_x"))
    packed = lean(dealt).mapInArrow(_to_buckets, "ids binary, x binary, labels array<string>, lists binary, longest double")
    return numbered(packed, "lemp-buckets").withColumn("_g", F.floor(F.col("_index") / GROUP).cast("long"))


def searched(pairs: DataFrame, anchors: DataFrame, buckets: DataFrame, k: int, same: bool) -> DataFrame:
    """What each tile (``_a``, ``_g``) of ``pairs`` finds: anchor, lower end of the
    window, partner, score.  At most ``k`` rows per anchor, window and tile."""
    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        held = [_read_bucket(b) for b in right.to_pylist()]
        for block in left["_block"].to_pylist():
            q = np.array([r["_x"] for r in block], np.int64)
            best = [[Best(k, -np.inf if w["low"] is None else w["low"], np.inf if w["high"] is None else w["high"]) for w in r["_windows"]] for r in block]
            search(np.array([r["_id"] for r in block], np.int64), np.array([r["_label"] for r in block], object), q, best, held, same)
            for r, lists in zip(block, best):
                for w, b in zip(r["_windows"], lists):
                    out += [(r["_id"], w["of"], int(i), int(s)) for s, i in zip(b.scores, b.ids)]
        columns = list(zip(*out)) or [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["_anchor", "_of", "_id", "_score"])

    def apart() -> DataFrame:                              # columns of its own for each side
        return pairs.select(F.col("_a").alias("_a"), F.col("_g").alias("_g"))

    left = apart().join(anchors.select("_a", "_block"), "_a").select(F.col("_a").alias("_a"), F.col("_g").alias("_g"), "_block").groupBy("_a", "_g")
    right = apart().join(buckets.drop("_index", "longest"), "_g")
    right = right.select(F.col("_a").alias("_a"), F.col("_g").alias("_g"), "ids", "x", "labels", "lists").groupBy("_a", "_g")
    return left.cogroup(right).applyInArrow(tile, "_anchor long, _of long, _id long, _score long")


def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("_score"), "_id")
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)


def blocks_of(anchors: DataFrame) -> DataFrame:
    """Anchor rows of ``_index`` gathered ``ANCHORS`` to a block ``_a``."""
    return (anchors.withColumn("_a", F.floor(F.col("_index") / ANCHORS).cast("long"))
            .groupBy("_a").agg(F.collect_list(F.struct("_id", "_label", "_x", "_windows")).alias("_block"),
                               F.max("_longest").alias("_longest"), F.min("_least").alias("_least")))


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", label: str = "label", vector: str = "embedding",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """Hard negatives of each anchor (a row of ``is_anchor``) and positive:
    ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``.

    Components become floor(scale * c); a score is an integer inner product.
    Positives: the anchor's first rows of its label by falling score, then
    rising id.  Negatives: the first rows of other labels with ``low`` % to
    ``high`` % of the positive's score, so none if that is negative.

    Rows with a null id, label or vector or a null or non-finite component take
    no part, nor do vectors of another length than the most frequent one (of
    equal ones the longest).  Rows sharing the anchor's id are no partners of
    it; an anchor id that repeats is one anchor (its smallest label and
    vector); other repeated rows each count.  Empty vectors or no rows: an
    empty result.  Clashing further columns are ignored.  Scores beyond the
    range of a long fail.
    """
    spark = df.sparkSession
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    given = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{label}`").cast("string").alias("_label"), F.col(f"`{vector}`").alias("_v"),
                      F.coalesce(is_anchor, F.lit(False)).alias("_is"))
    sound = quantised(given.where("_id IS NOT NULL AND _label IS NOT NULL"), "_v", scale).drop("_v")
    lengths = sound.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths or not lengths[0].d:
        return spark.createDataFrame([], kind)
    d, held = lengths[0]
    rows = sound.where(F.size("_x") == d)
    buckets = make_buckets(rows.drop("_is"), held)
    groups = buckets.agg(F.max("_g")).first()[0] + 1

    chosen = rows.where("_is").groupBy("_id").agg(F.min(F.struct("_label", "_x")).alias("_r")).select("_id", "_r.*")
    length = F.sqrt(F.aggregate("_x", F.lit(0.0), lambda a, c: a + c.cast("double") * c))
    anchors = numbered(chosen.orderBy("_label", "_id").withColumn("_longest", length), "lemp-anchors")

    window = "array<struct<of:long,low:long,high:long>>"
    anywhere = F.array(F.struct(F.lit(0).alias("of"), F.lit(None).alias("low"), F.lit(None).alias("high"))).cast(window)
    blocks = blocks_of(anchors.withColumn("_windows", anywhere).withColumn("_least", F.lit(0.0)))
    spans = buckets.select("_g", F.explode(F.array_distinct("labels")).alias("_label")).groupBy("_label").agg(F.min("_g").alias("_from"), F.max("_g").alias("_to"))
    pairs = (anchors.select(F.floor(F.col("_index") / ANCHORS).cast("long").alias("_a"), "_label").distinct().join(spans, "_label")
             .select("_a", F.explode(F.sequence("_from", "_to")).alias("_g")).distinct())
    near = stored(first(searched(pairs, blocks, buckets, positives, True), ["_anchor"], positives)
                  .select("_anchor", F.col("_id").alias("_positive"), F.col("_score").alias("_of")), "lemp-positives")

    # 100 * score between low and high times the positive's score
    wanted = (near.where("_of >= 0").select("_anchor", "_of").distinct().groupBy(F.col("_anchor").alias("_id")).agg(F.collect_list(F.struct(
        F.col("_of").alias("of"), F.ceil(F.lit(low) * F.col("_of").cast("decimal(30,0)") / 100).cast("long").alias("low"),
        F.floor(F.lit(high) * F.col("_of").cast("decimal(30,0)") / 100).cast("long").alias("high"))).cast(window).alias("_windows")))
    blocks = blocks_of(anchors.join(wanted, "_id").withColumn("_least", F.array_min(F.transform("_windows", lambda w: w.low)).cast("double")))
    reach = buckets.groupBy("_g").agg(F.max("longest").alias("_far"))
    pairs = (blocks.select("_a", "_longest", "_least", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("_g"))
             .join(reach, "_g").where(F.col("_longest") * F.col("_far") * (1 + SLACK) >= F.col("_least")).select("_a", "_g"))
    far = first(searched(pairs, blocks, buckets, negatives, False), ["_anchor", "_of"], negatives)
    return (near.join(far.select("_anchor", "_of", "_rank", "_id", "_score"), ["_anchor", "_of"])
            .select(F.col("_anchor").alias("anchor_id"), F.col("_positive").alias("positive_id"), F.col("_rank").cast("int").alias("rank"),
                    F.col("_id").alias("negative_id"), F.col("_of").alias("positive_score"), F.col("_score").alias("negative_score")))
