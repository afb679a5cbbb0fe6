"""Katz backoff language model of any order: Good-Turing discounted n-gram counts
with exactly normalised backoff weights.

    p(w | h) = d(c(h w)) c(h w) / c(h)      if h w was seen,
             = alpha(h) p(w | h')           if only h was seen,
             = p(w | h')                    otherwise; h' is h without its first token,
    p(w)     = d(c(w)) c(w) / N             if the word was seen,
             = the mass so left             for all unknown words together.

A text is preceded by one start, so its first tokens have shorter histories.

Tokens never travel one by one.  Each slice of documents asks the count
tables, which are partitioned by key, for the keys it has: sorted 64-bit
hashes, delta-coded, in one block per table part.  A table part adds the
slices' training counts up and answers every slice in the order asked.  The
slice then scores its tokens from the longest n-gram seen; what the longer ones
need on the way down, alpha of each history, is summed where that order's
context table is made.

What lies on disk at once is kept below four times the input: texts meet the
answers in rounds, each with a share of the slices; reports meet their contexts
in rounds, each with a share of the table parts; and what only a later step
reads is removed after that step.

The model gathers every training n-gram; nothing is pruned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteoframe.llm.common import lean, released, removed, slices, word_runs
from meteoframe.llm.ngramjoin import mixed
from meteoframe.session import scratch_path

U = np.uint64
WORDS, PAIRS = 0, 1              # kinds of tables: the length of their n-grams less one
SLICE = 6 << 20                  # bytes of text asked for at once
PART_BYTES = 16 << 20            # bytes of text per table part: few parts keep a slice's blocks long
DOCS = -1                        # where judgements on documents are written, beside the shares of the reports
ROUNDS = 4                       # shares of the slices, and of the table parts, that are shuffled one after the other
TOP = 5                          # counts up to this are Good-Turing discounted
#: Words hold no blanks, so these collide with none.
END, START = U(xxhash.xxh3_64_intdigest(b"\n")), U(xxhash.xxh3_64_intdigest(b"\t"))


def squeeze(a: np.ndarray) -> bytes:
    """An array as compressed byte planes."""
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"")


def spread(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def coded(a: np.ndarray) -> bytes:
    """Numbers of which many are alike: the distinct ones and their indexes."""
    values, index = np.unique(a, return_inverse=True)
    packed = squeeze(values)
    return len(packed).to_bytes(4, "little") + packed + squeeze(index.astype(np.uint32))


def decoded(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    return spread(data[4:4 + n], np.float64)[spread(data[4 + n:], np.uint32)]


def deltas(keys: np.ndarray) -> bytes:
    """Ascending keys."""
    return squeeze(np.diff(keys, prepend=U(0)))


def from_deltas(data: bytes) -> np.ndarray:
    return np.cumsum(spread(data, U), dtype=U)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The table part of each key: equal ranges of the key space."""
    return ((keys >> U(32)) * U(parts) >> U(32)).astype(np.int64)


def cuts(part: np.ndarray, parts: int) -> np.ndarray:
    """Where each part starts among ascending parts (one more at the end)."""
    return np.searchsorted(part, np.arange(parts + 1))


def steps(places: np.ndarray) -> bytes:
    """Ascending places in a table part."""
    return squeeze(np.diff(places, prepend=0).astype(np.uint32))


def from_steps(data: bytes) -> np.ndarray:
    return np.cumsum(spread(data, np.uint32), dtype=np.int64)


def discounts(counts_of_counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Good-Turing factors for counts 1 to TOP (index 0 unused) and the constant
    taken off larger counts, so that every history leaves some mass.

    Falls back to that constant where the counts of counts give no usable
    factor, as in small corpora.
    """
    n = counts_of_counts.astype(float)                     # n[r - 1]: types seen r times
    flat = float(np.clip(n[0] / max(n[0] + 2 * n[1], 1.0), 0.1, 0.9))
    r = np.arange(1, TOP + 1)
    plain = 1 - flat / r
    with np.errstate(divide="ignore", invalid="ignore"):
        big = (TOP + 1) * n[TOP] / n[0]
        turing = ((r + 1) * n[1:TOP + 1] / (r * n[:TOP]) - big) / (1 - big)
    usable = np.isfinite(turing) & (turing > 0) & (turing < 1)
    return np.concatenate([[0.0], np.where(usable, turing, plain)]), flat


def discounted(c: np.ndarray, factors: np.ndarray, flat: float) -> np.ndarray:
    """d(c) c; 0 for 0."""
    c = c.astype(np.int64)
    return np.where(c > TOP, c - flat, factors[np.minimum(c, TOP)] * c)


class Grams:
    """A slice's distinct n-grams of one length: ascending ``keys``, the token that
    the first occurrence of each ends at, and which one ends at every token (-1:
    the text has not as many tokens before)."""

    def __init__(self, keys: np.ndarray, held: np.ndarray):
        self.which = np.full(len(keys), -1)
        at = np.flatnonzero(held)
        self.keys, first, self.which[at] = np.unique(keys[at], return_index=True, return_inverse=True)
        self.first = at[first]

    def each(self, counts: np.ndarray) -> np.ndarray:
        """The n-gram's count at every token, 0 where there is none."""
        return np.where(self.which >= 0, np.append(counts, 0)[self.which], 0)


class Slice:
    """A slice's tokens under local numbers: its words, then end, then start."""

    def __init__(self, texts: pa.Array, kinds: range):
        lower = pc_ascii_lower(texts)
        words, index, places = word_runs(lower)
        self.docs = len(texts)
        hashes = np.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, len(words)), [END, START])
        end, start = len(words), len(words) + 1
        size = np.diff(places)
        self.tokens = np.insert(index, places[1:], end)
        self.doc = np.repeat(np.arange(self.docs), size + 1)
        begins = np.concatenate([[0], np.cumsum(size + 1)[:-1]]).astype(int)
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[begins] = start
        self.end, self.start, self.hashes = end, start, hashes
        self.size = size + 1
        self.order = np.argsort(hashes[:-1], kind="stable")        # words and end by key
        place = np.arange(len(self.tokens)) - begins[self.doc]     # in the text
        keys, self.grams = mixed(hashes[self.before]), {}
        for kind in range(PAIRS, kinds.stop):
            keys = mixed(keys + hashes[self.tokens])
            if kind in kinds:
                self.grams[kind] = Grams(keys, place >= kind - 1)
            keys = np.concatenate([keys[:1], keys[:-1]])           # histories of the next length

    def histories(self, kind: int, at: np.ndarray) -> np.ndarray:
        """Local numbers of the histories of the n-grams that end at tokens ``at``."""
        return self.before[at] if kind == PAIRS else self.grams[kind - 1].which[at - 1]


def pc_ascii_lower(texts: pa.Array) -> pa.Array:
    return pc.ascii_lower(pc.fill_null(texts, ""))


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices with numbers that depend on the scan's partition alone."""
    part = TaskContext.get().partitionId()
    for k, b in enumerate(slices(merged(batches), "text", SLICE + SLICE // 4)):
        yield part << 24 | k, b


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive batches together, up to a slice's bytes."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if held and sum(x.nbytes for x in held) + b.nbytes > 1.1 * SLICE:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        held.append(b)
    if held and sum(x.num_rows for x in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


ASK = "kind int, part int, slice long, keys binary, counts binary"
ANSWER = "what string, kind int, part int, slice long, keys binary, counts binary, stats array<long>"


def ask(source: DataFrame, parts: int, kinds: range) -> DataFrame:
    """Every slice's distinct n-grams of these kinds, with their training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, b in numbered(batches):
            s = Slice(b.column("text"), kinds)
            train = b.column("train").to_numpy(zero_copy_only=False)[s.doc]
            out = []
            asked = [(WORDS, s.hashes[s.order], np.bincount(s.tokens[train], minlength=s.end + 1)[s.order])] if WORDS in kinds else []
            asked += [(kind, g.keys, np.bincount(g.which[train & (g.which >= 0)], minlength=len(g.keys))) for kind, g in s.grams.items()]
            for kind, keys, counts in asked:
                at, counts = cuts(part_of(keys, parts), parts), counts.astype(np.uint32)
                out += [(kind, p, number, deltas(keys[i:j]), squeeze(counts[i:j])) for p, (i, j) in enumerate(zip(at, at[1:])) if j > i]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(
                (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["kind", "part", "slice", "keys", "counts"])

    return source.mapInArrow(run, ASK)


def by_part(batches: Iterator[pa.RecordBatch], keys: list[str], rest: list[str]) -> Iterator[tuple[tuple, list[list]]]:
    """Rows of one part at a time, from batches sorted by ``keys``."""
    at, held = None, []
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in [*keys, *rest])):
            if row[:len(keys)] != at:
                if held:
                    yield at, held
                at, held = row[:len(keys)], []
            held.append(row[len(keys):])
    if held:
        yield at, held


def answer(asked: DataFrame, order: int) -> DataFrame:
    """The count tables (``what = 'table'``), and for every slice and part the
    totals in the order asked (``what = 'answer'``).

    In an answer to longer n-grams than words, the sign of the count marks, once
    per n-gram among all slices, the one that is to report it to its history's
    context.  ``keys`` of an answer are the places of the counted n-grams among
    the part's: contexts are addressed by them, at a fraction of a key's bytes.
    N-grams of the highest order begin no longer ones and get none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (kind, part), rows in by_part(batches, ["kind", "part"], ["slice", "keys", "counts"]):
            keys = [from_deltas(r[1]) for r in rows]
            counts = np.concatenate([spread(r[2], np.uint32) for r in rows]).astype(np.int64)
            size = np.array([len(k) for k in keys])
            distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(which, counts, len(distinct)).astype(np.int64)
            mine = np.zeros(len(which), bool)
            seen = np.flatnonzero(counts)
            mine[seen[np.unique(which[seen], return_index=True)[1]]] = True
            told = np.where(mine & (kind >= PAIRS), -total[which], total[which])
            ends = np.cumsum(size)
            some = total > 0
            place = np.cumsum(some) - 1
            places = [steps(place[w[some[w]]]) if kind < order - 1 else None for w in np.split(which, ends[:-1])]
            stats = [int(total.sum()), int(some.sum()), *(int((total == r).sum()) for r in range(1, TOP + 2))]
            out = [("answer", kind, part, r[0], at, squeeze_int(told[e - n:e]), None)
                   for r, n, e, at in zip(rows, size, ends, places)]
            out.append(("table", kind, part, None, deltas(distinct[some]), squeeze(total[some]), stats))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(
                (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())))],
                names=["what", "kind", "part", "slice", "keys", "counts", "stats"])

    return asked.repartition("kind", "part").sortWithinPartitions("kind", "part", "slice").mapInArrow(run, ANSWER)


@dataclass
class Totals:
    """Figures of the whole training text."""

    tokens: int
    types: int
    factors: list[tuple[np.ndarray, float]]      # discounts by kind
    unknown: float               # probability of all unknown words together

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, discounted(c, *self.factors[WORDS]) / max(self.tokens, 1), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


def totals(table: DataFrame, order: int) -> Totals:
    found = {r.kind: r for r in table.groupBy("kind").agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(TOP + 3)]).collect()}
    stats = [np.array([int(found[k][f"s{i}"] or 0) if k in found else 0 for i in range(TOP + 3)]) for k in range(order)]
    tokens, types = int(stats[WORDS][0]), int(stats[WORDS][1])
    factors = [discounts(x[2:]) for x in stats]
    first, flat = factors[WORDS]
    small = np.arange(1, TOP + 1)
    seen = stats[WORDS][2:TOP + 2]
    left = float(((1 - first[1:]) * small * seen).sum() + flat * (types - seen.sum()))
    return Totals(tokens, types, factors, left / tokens if tokens else 1.0)


OUT = ("what string, slice long, row int, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
       "kind int, part int, keys binary, one binary, two binary, three binary, four binary")


def reports(number: int, kind: int, parts: int, history: np.ndarray, part: np.ndarray, place: np.ndarray, mass: np.ndarray,
            shorter: np.ndarray, behind: np.ndarray, divisor: np.ndarray) -> list[tuple]:
    """What one slice reports to the contexts, added up by history."""
    if not len(history):
        return []
    told, first, which = np.unique(history, return_index=True, return_inverse=True)
    rank = np.lexsort((place[told], part[told]))
    told, first = told[rank], first[rank]
    add = lambda v: np.bincount(which, v)[rank]
    mass, shorter, behind, divisor = add(mass), add(shorter), behind[first], divisor[first]
    at = cuts(part[told], parts)
    return [("report", number, kind, p, steps(place[told[i:j]]), coded(mass[i:j]), coded(shorter[i:j]), squeeze(behind[i:j]), squeeze(divisor[i:j]))
            for p, (i, j) in enumerate(zip(at, at[1:])) if j > i]


def unseen(number: int, kind: int, parts: int, history: np.ndarray, part: np.ndarray, place: np.ndarray, doc: np.ndarray, docs: int) -> list[tuple]:
    """One slice's histories whose alpha its documents need, and how often."""
    event, times = np.unique(history * docs + doc, return_counts=True)
    history, doc = event // docs, event % docs
    rank = np.lexsort((place[history], part[history]))
    history, doc, times = history[rank], doc[rank], times[rank]
    first = np.flatnonzero(np.diff(history, prepend=-1))
    told, first = history[first], np.append(first, len(history))
    at = cuts(part[told], parts)
    small = lambda v: squeeze(v.astype(np.uint32))
    return [("unseen", number, kind, p, steps(place[told[i:j]]), small(np.diff(first[i:j + 1])), small(doc[first[i]:first[j]]), small(times[first[i]:first[j]]), None)
            for p, (i, j) in enumerate(zip(at, at[1:])) if j > i]


def judge(source: DataFrame, answers: DataFrame, t: Totals, parts: int, order: int, share: int) -> DataFrame:
    """For one share of the slices (those of every ``ROUNDS``-th scan partition): per document all but the backoff weights (``what = 'doc'``); per slice, kind
    and context part the reports on histories (``'report'``: places, discounted
    counts of their n-grams, those without the first token, both histories'
    counts) and the histories of unseen n-grams (``'unseen'``: places, how many,
    rows, times)."""
    def slim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, b in numbered(batches):
            texts = pc_ascii_lower(b.column("text"))
            raw = pa.RecordBatch.from_arrays([texts, b.column("doc_id"), b.column("train")], names=["text", "doc_id", "train"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, raw.schema) as w:
                w.write_batch(raw)
            data = zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([-1], pa.int32()), pa.array([-1], pa.int32()), pa.array([data], pa.binary())],
                                             names=["slice", "kind", "part", "counts"])

    own = source.where(F.spark_partition_id() % ROUNDS == share).mapInArrow(slim, "slice long, kind int, part int, counts binary").withColumn("keys", F.lit(None).cast("binary"))
    told = answers.where(F.shiftright("slice", 24) % ROUNDS == share).select("slice", "kind", "part", "counts", "keys")
    both = own.unionByName(told).repartition("slice").sortWithinPartitions("slice", "kind", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (number,), rows in by_part(batches, ["slice"], ["kind", "part", "counts", "keys"]):
            if rows[0][0] != -1:
                raise ValueError(f"slice {number} changed between two scans")
            b = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(rows[0][2])).read_next_batch()
            s = Slice(b.column("text"), range(order))
            told, spot = {}, {}
            for kind in range(order):
                own = [r for r in rows if r[0] == kind]
                told[kind] = np.concatenate([spread_int(r[2]) for r in own] or [np.zeros(0, np.int64)])
                if kind < order - 1:                                # the n-grams' places in their parts
                    spot[kind] = np.zeros(len(told[kind]), np.int64)
                    spot[kind][told[kind] != 0] = np.concatenate([from_steps(r[3]) for r in own] or [np.zeros(0, np.int64)])
            if any(len(told[k]) != len(g.keys) for k, g in s.grams.items()):
                raise ValueError(f"slice {number} changed between two scans")
            count = np.zeros(s.end + 2, np.int64)
            count[s.order] = told[WORDS]
            count[s.start] = count[s.end]                           # as many starts as ends
            where = {k: (part_of(g.keys, parts), spot.get(k)) for k, g in s.grams.items()}
            if WORDS in spot:
                place = np.zeros(s.end + 2, np.int64)
                place[s.order] = spot[WORDS]
                where[WORDS] = part_of(s.hashes, parts), place
                for v in where[WORDS]:
                    v[s.start] = v[s.end]                           # an end is no history: the start stands there
            p = t.p(count)
            log = np.log10(p)[s.tokens]
            behind, shorter, divisor = count[s.before], p[s.tokens], np.ones(len(s.tokens), np.int64)
            made = []
            for kind, g in s.grams.items():
                c = g.each(np.abs(told[kind]))                      # behind: how often the history was seen
                mass, seen = discounted(c, *t.factors[kind]), c > 0
                log[seen] = np.log10(mass[seen] / behind[seen])
                first = g.first[told[kind] < 0]
                made += reports(number, kind, parts, s.histories(kind, first), *where[kind - 1], *(v[first] for v in (mass, shorter, behind, divisor)))
                lost = np.flatnonzero(~seen & (behind > 0) & (g.which >= 0))
                made += unseen(number, kind, parts, s.histories(kind, lost), *where[kind - 1], s.doc[lost], s.docs)
                shorter, divisor = mass, behind
                behind = np.concatenate([[0], c[:-1]])              # a text's first token has no longer history
            known = count[s.tokens] > 0
            per_doc = lambda v: np.bincount(s.doc, v, s.docs)
            out = pa.RecordBatch.from_pydict({
                "what": ["doc"] * s.docs, "slice": [number] * s.docs, "row": pa.array(np.arange(s.docs), pa.int32()),
                "doc_id": b.column("doc_id"), "held_out": pa.array(~b.column("train").to_numpy(zero_copy_only=False)),
                "n_tokens": pa.array(s.size, pa.int64()), "n_known": pa.array(per_doc(known).astype(np.int64)),
                "base_score": per_doc(t.base(count)[s.tokens]), "score": per_doc(log)})
            yield full_batch(out)
            if made:
                yield full_batch(pa.RecordBatch.from_pydict({
                    name: pa.array([m[k] for m in made], kind) for k, (name, kind) in enumerate((
                        ("what", pa.string()), ("slice", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()),
                        ("one", pa.binary()), ("two", pa.binary()), ("three", pa.binary()), ("four", pa.binary())))}))

    return both.mapInArrow(run, OUT)


def spread_int(data: bytes) -> np.ndarray:
    """Answers are 32-bit where they fit; told apart by a marker byte."""
    return spread(data[1:], np.int32 if data[:1] == b"4" else np.int64).astype(np.int64)


def squeeze_int(a: np.ndarray) -> bytes:
    small = not len(a) or np.abs(a).max() < 2 ** 31
    return (b"4" if small else b"8") + squeeze(a.astype(np.int32 if small else np.int64))


TYPES = {"what": pa.string(), "slice": pa.int64(), "row": pa.int32(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(),
         "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64(), "kind": pa.int32(), "part": pa.int32(),
         "keys": pa.binary(), "one": pa.binary(), "two": pa.binary(), "three": pa.binary(), "four": pa.binary()}


def full_batch(b: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([b.column(n).cast(t) if n in b.schema.names else pa.nulls(b.num_rows, t) for n, t in TYPES.items()], names=list(TYPES))


CONTEXT_COLUMNS = ["what", "kind", "part", "slice", "keys", "one"]
CONTEXT = "what string, kind int, part int, slice long, keys binary, one binary"


def contexts(judged: DataFrame) -> DataFrame:
    """Of reports and unseen n-grams: a context table per order (``what = 'table'``:
    places, alpha in ``one``) and, per slice, the logarithms of alpha that its
    documents' unseen n-grams need, added up by document (``what = 'sum'``: rows
    in ``keys``, sums in ``one``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (kind, part), rows in by_part(batches, ["kind", "part"], ["what", "slice", "keys", "one", "two", "three", "four"]):
            told = [r for r in rows if r[0] == "report"]
            distinct, which = np.unique(np.concatenate([from_steps(r[2]) for r in told] or [np.zeros(0, np.int64)]), return_inverse=True)
            column = lambda k, read: np.concatenate([read(r[k]) for r in told] or [np.zeros(0)])
            whole = lambda data: spread(data, np.int64)
            count, divisor = np.ones(len(distinct)), np.ones(len(distinct))
            count[which], divisor[which] = column(5, whole), column(6, whole)      # alike in all reports
            mass, shorter = (np.bincount(which, column(k, decoded), len(distinct)) for k in (3, 4))
            alpha = (1 - mass / count) / (1 - shorter / divisor)
            log = np.log10(np.maximum(alpha, 1e-300))
            out = [("table", kind, part, None, steps(distinct), squeeze(alpha))]
            for _, number, key, n, row, times, _ in (r for r in rows if r[0] == "unseen"):
                at = np.searchsorted(distinct, from_steps(key))
                value = np.repeat(log[at], spread(n, np.uint32)) * spread(times, np.uint32)
                row, which = np.unique(spread(row, np.uint32), return_inverse=True)
                out.append(("sum", kind, part, number, squeeze(row), squeeze(np.bincount(which, value, len(row)))))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], TYPES[name]) for k, name in enumerate(CONTEXT_COLUMNS)], names=CONTEXT_COLUMNS)

    own = judged.select("kind", "part", "what", "slice", "keys", "one", "two", "three", "four").repartition("kind", "part")
    return own.sortWithinPartitions("kind", "part", "what", "slice").mapInArrow(run, CONTEXT)


def backoff_sums(context: DataFrame) -> DataFrame:
    """``slice, row, value``: what the context parts found for each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (number,), rows in by_part(batches, ["slice"], ["keys", "one"]):
            row = np.concatenate([spread(r[0], np.uint32) for r in rows])
            total = np.bincount(row, np.concatenate([spread(r[1], np.float64) for r in rows]))
            row = np.unique(row)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), number), pa.int64()), pa.array(row.astype(np.int32)), pa.array(total[row])],
                                             names=["slice", "row", "value"])

    own = context.where("what = 'sum'").select("slice", "kind", "part", "keys", "one")
    return own.repartition("slice").sortWithinPartitions("slice", "kind", "part").mapInArrow(run, "slice long, row int, value double")


@dataclass
class KatzScores:
    """``rows``: the scores.  ``counts`` and ``histories``: the model's stored
    tables, one row of packed keys and values per kind (the n-grams' length less
    one) and part.  A history's kind is that of the n-grams it begins, its key the
    place among the counted n-grams of its own kind and part (the start's: that
    of the end, which is no history)."""

    rows: DataFrame
    counts: DataFrame
    histories: DataFrame
    totals: Totals

    def of(self, length: int) -> DataFrame:
        """The count table of n-grams of one length."""
        return self.counts.where(F.col("kind") == length - 1)


def score_corpus(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", order: int = 2) -> KatzScores:
    """Learns from the rows where ``train`` holds and scores all rows, with
    n-grams of up to ``order`` tokens.

    A-Z are lower-cased; tokens are the words and one end per text, also for
    null and empty texts.  ``rows``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score (base-10 logarithms of the text's
    probability).  One row per row; null ids pass through; without training
    rows every token is the one unknown word, of probability 1.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    source = lean(docs).select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
                         F.coalesce(train, F.lit(False)).alias("train"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(min(max(8, size // PART_BYTES), 50_000))
    groups = [range(min(order, PAIRS + 1)), *(range(k, k + 1) for k in range(PAIRS + 1, order))]
    spark = docs.sparkSession
    counts, judgements, histories = (scratch_path(spark, f"katz-{x}") for x in ("counts", "judged", "contexts"))

    def told(what: str) -> DataFrame:
        return spark.read.schema(ANSWER).parquet(counts).where(F.col("what") == what)

    def judged(bucket: int) -> DataFrame:
        return spark.read.schema(f"{OUT}, bucket int").parquet(judgements).where(F.col("bucket") == bucket)

    # one write after the other: each one's shuffle files are gone before the next, the answers
    # before the contexts, the reports on a share of the table parts as soon as their contexts are made
    for kinds in groups:
        with released(spark):
            answer(ask(source, parts, kinds), order).write.mode("append").partitionBy("what").parquet(counts)
    t = totals(told("table"), order)
    bucket = F.when(F.col("what") == "doc", DOCS).otherwise(F.col("part") % ROUNDS).alias("bucket")
    for share in range(ROUNDS):
        with released(spark):
            judge(source, told("answer"), t, parts, order, share).select("*", bucket).write.mode("append").partitionBy("bucket").parquet(judgements)
    removed(spark, f"{counts}/what=answer")
    for share in range(ROUNDS):
        with released(spark):
            contexts(judged(share)).write.mode("append").parquet(histories)
        removed(spark, f"{judgements}/bucket={share}")
    context = spark.read.schema(CONTEXT).parquet(histories)
    rows = (judged(DOCS).select("slice", "row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")
            .join(backoff_sums(context), ["slice", "row"], "left")
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(t.tokens).cast("long").alias("train_tokens"), "base_score",
                    (F.col("score") + F.coalesce("value", F.lit(0.0))).alias("score")))
    return KatzScores(rows, told("table"), context.where("what = 'table'").select("kind", "part", "keys", "one"), t)
