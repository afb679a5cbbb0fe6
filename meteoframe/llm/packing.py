"""Sequence packing as cutting stock, solved by column generation.

Every document is cut into full pieces of ``seq_len`` tokens and one shorter
rest.  Full pieces are sequences of their own.  The rests are the stock
orders: their length histogram (a bounded number of length classes, whatever
the corpus) goes to the driver, where a linear program over patterns - sets
of classes that fit a sequence - is solved by column generation, with an
unbounded-knapsack dynamic program pricing new patterns.  Rounded patterns
are then handed out to the rests by their rank within their class.

Only the histogram, per-class offsets and the pattern list pass through the
driver; all are bounded by the number of classes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteoframe.llm.bpe import FragmentEncoder, byte_alphabet, packed
from meteoframe.llm.common import lean, slices, stored

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


#: Small letters of ASCII and Latin-1 in UTF-8: letters that neither case nor
#: composition changes.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch


class WordEncoder(FragmentEncoder):
    """Ids of whole texts under a vocabulary that lowers case and drops white
    space: cut where ASCII blanks begin and end, and behind every run of ASCII
    letters that another ASCII character ends."""

    def __init__(self, path: str, **bounds):
        super().__init__(path, **bounds)
        # words of plain small letters need neither normalizer nor splitting:
        # the merges alone, over the stand-ins of their bytes
        self.merges = type(self.tokenizer).from_file(path)
        self.merges.normalizer = self.merges.pre_tokenizer = None
        self.stand_in = {b: c for c, b in byte_alphabet().items()}

    def encode_new(self, fragments: list[bytes]) -> list[list[int]]:
        alone = [PLAIN(f) is not None for f in fragments]
        quick = [f.decode("latin-1").translate(self.stand_in) for f, a in zip(fragments, alone) if a]
        rest = [f for f, a in zip(fragments, alone) if not a]
        by_merges = iter(self.merges.encode_batch_fast(quick, add_special_tokens=False))
        whole = iter(super().encode_new(rest))
        return [next(by_merges).ids if a else next(whole) for a in alone]

    def folded(self, b: np.ndarray) -> np.ndarray:
        # a letter in front of a non-ASCII byte may be composed with it first
        return np.where((b >= 0x41) & (b <= 0x5A) & (np.append(b[1:], 0) < 0x80), b | 0x20, b)

    def kept(self, b: np.ndarray) -> np.ndarray:
        return (b != 0x20) & (b != 0x0A) & (b != 0x09) & (b != 0x0D)

    def cut_flags(self, b: np.ndarray) -> np.ndarray:
        blank = ~self.kept(b)
        letter = ((b | 0x20) >= 0x61) & ((b | 0x20) <= 0x7A)
        return (blank[:-1] != blank[1:]) | (letter[:-1] & ~letter[1:] & (b[1:] < 0x80))


def token_pieces(df: DataFrame, doc_id: str, text: str, path: str, seq_len: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of every row's ids: full ones of ``seq_len`` and one rest.

    Columns ``doc_id, start, length, doc_tokens, ids`` (ids: little-endian
    unsigned 32-bit).  A null text counts as empty and has the end id alone;
    a null id stays null; repeated rows give repeated pieces.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in slices(batches, 1):
            encoder = encoder or WordEncoder(path)
            ids, places = encoder.encode(batch.column(1))
            ids = np.insert(ids, places[1:], end_id)               # one end id behind each text
            places = places + np.arange(len(places))
            total = np.diff(places)
            n = -(-total // seq_len)
            row = np.repeat(np.arange(len(total)), n)
            start = seq_len * (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
            length = np.minimum(total[row] - start, seq_len)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(total[row]),
                 packed(ids, np.concatenate([[0], np.cumsum(length)]))],
                names=["doc_id", "start", "length", "doc_tokens", "ids"])

    return lean(df).select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, PIECES)


# ---------------------------------------------------------------- the plan

UNIT = 8         # sequences are planned in units of eight tokens
SHORT = 32       # rests up to this length are planned in bundles of 64 tokens


def length_classes(seq_len: int) -> tuple[np.ndarray, np.ndarray]:
    """Size in units, and rests per item, of each length class.  Class t - 1 has
    the rests of t <= SHORT tokens, 64 // t to an item; the others follow in
    steps of UNIT tokens, planned at their upper length."""
    short = [(64 // UNIT, 64 // t) for t in range(1, SHORT + 1)]
    long = [(u, 1) for u in range(SHORT // UNIT + 1, seq_len // UNIT + 1)]
    sizes, per = zip(*short, *long)
    return np.array(sizes), np.array(per)


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable multiset of sizes within the
    capacity."""
    order = np.argsort(sizes, kind="stable")
    sizes, values = sizes[order], values[order]
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(int(sizes[0]), capacity + 1):
        n = fits[c]
        gain = best[c - sizes[:n]] + values[:n]
        k = int(gain.argmax())
        if gain[k] > best[c - 1]:
            best[c], choice[c] = gain[k], k
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(len(sizes), int), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            pattern[order[choice[c]]] += 1
            c -= int(sizes[choice[c]])
    return float(best[capacity]), pattern


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int,
                   gap: float = 2e-3, most_rounds: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Column generation for the cutting-stock LP: (patterns as columns, amounts).

    Revised simplex over the current basis; ends when the Farley bound, or the
    plain bound of demand over capacity, proves the amount within ``gap`` of
    the optimum.
    """
    least = (sizes * demand).sum() / capacity
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / (capacity // sizes))
    x = inverse @ demand
    for _ in range(most_rounds):
        duals = inverse.sum(0)
        value, pattern = best_pattern(sizes, np.maximum(duals, 0), capacity)
        total = x.sum()
        if value <= 1 + 1e-9 or total - max(total / value, least) <= gap * total:
            break
        d = inverse @ pattern
        up = d > 1e-9
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, d, 1), np.inf)
        row = int(ratio.argmin())
        step = ratio[row]
        x = np.maximum(x - step * d, 0)
        x[row] = step
        columns[:, row] = pattern
        pivot = inverse[row] / d[row]
        inverse -= np.outer(d, pivot)
        inverse[row] = pivot
    return columns.astype(int), x


def plan_sequences(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole patterns and how often to use each; together they use exactly the
    demand.

    LP amounts are rounded down; patterns that still fit what is left are
    added by falling fraction; the last few rests (bounded by the number of
    classes, not by the corpus) are placed best-fit, longest first.
    """
    left = demand.astype(int).copy()
    out: list[tuple[np.ndarray, int]] = []
    if not left.sum():
        return out
    columns, x = solve_patterns(sizes, demand.astype(float), capacity)
    whole = np.floor(x + 1e-9).astype(int)
    for j in np.flatnonzero(whole):
        need = columns[:, j] > 0
        times = min(whole[j], int((left[need] // columns[need, j]).min()))
        if times > 0:
            out.append((columns[:, j].copy(), int(times)))
            left -= columns[:, j] * times
    for j in np.argsort(-(x - whole), kind="stable"):
        if columns[:, j].any() and (columns[:, j] <= left).all() and (columns[:, j] @ sizes) > 0.98 * capacity:
            out.append((columns[:, j].copy(), 1))
            left -= columns[:, j]
    while left.any():
        room, bin_ = capacity, np.zeros(len(sizes), int)
        for k in np.argsort(-sizes, kind="stable"):
            n = min(int(left[k]), room // int(sizes[k]))
            if n:
                bin_[k], room = n, room - n * int(sizes[k])
                left[k] -= n
        out.append((bin_, 1))
    return out


def lookup_arrays(plan: list[tuple[np.ndarray, int]], demand: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per class, the run of ranks that each pattern takes: run starts (over all
    classes), rests per sequence, first sequence of the run; and class starts."""
    offset = np.concatenate([[0], np.cumsum(demand)[:-1]]).astype(np.int64)
    base = np.concatenate([[0], np.cumsum([n for _, n in plan])]).astype(np.int64)
    starts, each, first = [], [], []
    for k in range(len(demand)):
        at = int(offset[k])
        for j, (pattern, n) in enumerate(plan):
            if pattern[k]:
                starts.append(at)
                each.append(int(pattern[k]))
                first.append(int(base[j]))
                at += int(pattern[k]) * n
    return np.array(starts, np.int64), np.array(each, np.int64), np.array(first, np.int64), offset


def assign(pieces: DataFrame, seq_len: int = 2048) -> DataFrame:
    """``pieces`` (a stored table with at least ``doc_id, start, length``) plus
    ``sequence_id`` and ``offset``.

    Every piece lands in exactly one sequence; offsets in a sequence are
    gapless from 0; other columns pass through.  An empty table gives an empty
    table.  Ranks within a class are taken per hash bucket and shifted by the
    buckets before it, so that a class holding most rows is shared by many
    tasks.
    """
    if seq_len % 64:
        raise ValueError("seq_len must be a multiple of 64")
    sizes, per = length_classes(seq_len)
    its_class = F.when(F.col("length") <= SHORT, F.col("length") - 1).otherwise(
        F.lit(SHORT - SHORT // UNIT - 1) + F.ceil(F.col("length") / UNIT))
    full = pieces.where(F.col("length") == seq_len)
    rest = pieces.where(F.col("length") < seq_len).withColumn("_class", its_class.cast("int"))

    counts = dict(rest.groupBy("_class").count().collect())      # at most as many rows as classes
    demand = -(-np.array([counts.get(k, 0) for k in range(len(sizes))], np.int64) // per)
    used = np.flatnonzero(demand)
    plan = plan_sequences(sizes[used], demand[used], seq_len // UNIT)
    starts, each, first, offset_used = lookup_arrays(plan, demand[used])
    offset = np.zeros(len(sizes), np.int64)
    offset[used] = offset_used
    sequences = sum(n for _, n in plan)

    buckets = 256
    rest = rest.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(buckets)).cast("int"))
    rest = stored(rest, "packing-rests")
    before = (rest.groupBy("_class", "_bucket").count()             # at most classes x buckets rows
              .withColumn("_before", F.sum("count").over(Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
              .select("_class", "_bucket", F.coalesce("_before", F.lit(0)).alias("_before")))
    ranked = (rest.join(before, ["_class", "_bucket"])
              .withColumn("_rank", F.col("_before") + F.row_number().over(Window.partitionBy("_class", "_bucket").orderBy("doc_id", "start")) - 1))
    names = [f.name for f in pieces.schema.fields]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields), "sequence_id long", "_slot long", "_rank long"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kind, rank = b.column("_class").to_numpy(), b.column("_rank").to_numpy()
            key = offset[kind] + rank // per[kind]
            run = np.searchsorted(starts, key, "right") - 1
            within = key - starts[run]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), pa.array(first[run] + within // each[run]), pa.array(key), pa.array(rank)],
                names=[*names, "sequence_id", "_slot", "_rank"])

    placed = ranked.mapInArrow(place, schema)
    line = Window.partitionBy("sequence_id").orderBy("_slot", "_rank").rowsBetween(Window.unboundedPreceding, -1)  # at most seq_len rows
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(line), F.lit(0)).cast("long")).drop("_slot", "_rank")
    whole = (full.withColumn("sequence_id", F.lit(sequences) + F.monotonically_increasing_id())
             .withColumn("offset", F.lit(0).cast("long")))
    return placed.unionByName(whole)


def pack(df: DataFrame, doc_id: str, text: str, path: str, seq_len: int = 2048, end_id: int = 1) -> DataFrame:
    """Documents to training sequences: one row per piece with its ``ids``, its
    place in its document (``start, length, doc_tokens``) and in its sequence
    (``sequence_id, offset``)."""
    return assign(stored(token_pieces(df, doc_id, text, path, seq_len, end_id), "packing-pieces"), seq_len)
