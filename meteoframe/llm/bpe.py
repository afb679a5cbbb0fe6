"""BPE encoding and decoding by forced boundaries.

Byte pairs that occur inside no vocabulary token mark cuts that every
encoding must have.  A text is cut there, each fragment is encoded on its
own and the ids are concatenated; most fragments are words that come again
and again, so their ids are kept in a bounded table.

A cut is taken only where the splitting pattern in front of the merges cannot
notice it either: between two characters, never after white space (the
pattern looks ahead there) and never in front of an apostrophe (contractions).
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe.llm.common import distinct_runs, lean, slices

SCHEMA = "ids binary, decoded string"

#: Last two UTF-8 bytes of the white-space characters outside
#: ASCII (next line, no-break, ogham, general punctuation, ideographic).
SPACE_LAST = [0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]
SPACE_BEFORE_LAST = [0xC2, 0x9A, 0x80, 0x81]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class FragmentEncoder:
    """Ids of many texts at once: their bytes are cut into fragments, every
    distinct fragment is encoded once, and the ids are gathered in text order.

    Subclasses say where to cut.  ``entries`` bounds each of the two tables
    of fragments that a worker keeps; fragments of over ``most_bytes`` are not kept.
    """

    def __init__(self, path: str, entries: int = 250_000, most_bytes: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.added = [t["content"].encode() for t in self.spec["added_tokens"]]
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.entries, self.most_bytes = entries, most_bytes

    def cut_flags(self, b: np.ndarray) -> np.ndarray:
        """Flag for each byte but the first: a fragment starts there."""
        raise NotImplementedError

    def folded(self, b: np.ndarray) -> np.ndarray:
        """The bytes with differences undone that the vocabulary ignores."""
        return b

    def kept(self, b: np.ndarray) -> np.ndarray | None:
        """Flag per byte that matters at all; None: all do."""
        return None

    def encode_new(self, fragments: list[bytes]) -> list[list[int]]:
        """Ids of fragments not met before."""
        return [e.ids for e in self.tokenizer.encode_batch_fast([f.decode() for f in fragments], add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string array in order, and each text's first id's place
        (one more at the end).  Null texts have no ids."""
        texts = pc.fill_null(texts, "")
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        raw = memoryview(data)[ends[0]:ends[-1]] if data is not None else b""
        b, ends = np.frombuffer(raw, np.uint8), ends - ends[0]
        cut = np.zeros(len(b) + 1, bool)
        if len(b) > 1:
            cut[1:-1] = self.cut_flags(b)
        for token in self.added:                       # matched before any splitting
            for m in re.finditer(re.escape(token), raw):
                cut[m.start():m.end() + 1] = False
                cut[[m.start(), m.end()]] = True
        cut[ends] = True
        at = np.flatnonzero(cut)
        keep = self.kept(b)
        b = self.folded(b)
        if keep is not None:
            left = np.concatenate([[0], np.cumsum(keep)])
            at, ends, b = left[at], left[ends], b[keep]
            at = at[np.append(True, at[1:] != at[:-1])]
        if len(at) < 2:
            return np.zeros(0, np.uint32), np.zeros(len(ends), np.int64)
        distinct, which = distinct_runs(b, at[:-1], at[1:])
        if len(self.known) > self.entries:             # what comes again moves on, the rest is forgotten
            self.known, self.older = {}, self.known
        ids = list(map(self.known.get, distinct))
        new = []
        for i in [i for i, x in enumerate(ids) if x is None]:
            met = self.older.get(distinct[i])
            if met is None:
                new.append(i)
            else:
                ids[i] = self.known[distinct[i]] = met
        for i, own in zip(new, self.encode_new([distinct[i] for i in new])):
            ids[i] = array("I", own).tobytes()
            if len(distinct[i]) <= self.most_bytes:
                self.known[distinct[i]] = ids[i]
        flat, places = gather(np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4, which)
        return flat, places[np.searchsorted(at, ends)]


def gather(values: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values`` (run i has ``lengths[i]``) chosen by ``which``, laid end
    to end; and where each chosen run starts (one more at the end)."""
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    n = lengths[which]
    places = np.concatenate([[0], np.cumsum(n)])
    return values[np.repeat(starts[which] - places[:-1], n) + np.arange(places[-1])], places


class ForcedBoundaryCodec(FragmentEncoder):
    """Encoder and decoder for one byte-level vocabulary file."""

    def __init__(self, path: str, **bounds):
        super().__init__(path, **bounds)
        spec = self.spec
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
            raise ValueError("forced boundaries need a byte-level vocabulary without normalizer or added prefix")
        alphabet = byte_alphabet()
        table = {i: bytes(alphabet[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        self.cuts = self.never_inside(table.values())
        table |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        rows = [table.get(i, b"") for i in range(max(table) + 1)]
        self.id_bytes = np.frombuffer(b"".join(rows), np.uint8)
        self.id_sizes = np.array([len(r) for r in rows], np.int64)

    @staticmethod
    def never_inside(tokens) -> np.ndarray:
        """Flag per byte pair (left * 256 + right): a certain cut."""
        never = np.ones((256, 256), bool)
        for t in tokens:
            for a, b in zip(t, t[1:]):
                never[a, b] = False
        never[:0x21] = False                     # white space and controls on the left
        never[0x7F] = False
        never[:, 0x80:0xC0] = False              # inside a character
        never[:, ord("'")] = False
        return never.ravel()

    def cut_flags(self, b: np.ndarray) -> np.ndarray:
        cut = self.cuts[b[:-1].astype(np.uint16) << 8 | b[1:]]
        high = np.flatnonzero(cut[1:] & (b[1:-1] >= 0x80)) + 1
        blank = np.isin(b[high], SPACE_LAST) & np.isin(b[high - 1], SPACE_BEFORE_LAST)
        cut[high[blank]] = False
        return cut

    def decode(self, ids: np.ndarray, places: np.ndarray) -> pa.Array:
        """The texts whose ids lie between the places."""
        raw, starts = gather(self.id_bytes, self.id_sizes, ids)
        out = pa.Array.from_buffers(pa.string(), len(places) - 1, [None, pa.py_buffer(starts[places].astype(np.int32)), pa.py_buffer(raw)])
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:                  # ids that end inside a character
            out = pa.array([x.decode("utf-8", "replace") for x in out.cast(pa.binary()).to_pylist()], pa.string())
        return out


def packed(ids: np.ndarray, places: np.ndarray) -> pa.Array:
    """Each text's ids as little-endian unsigned 32-bit integers."""
    return pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer((4 * places).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])


def encode_decode(df: DataFrame, text: str, path: str) -> DataFrame:
    """``df`` without ``text``, plus ``ids`` (binary: little-endian unsigned
    32-bit ids of the whole text) and ``decoded`` (the ids decoded again).

    One row out per row in, repeated rows included, in no particular order.
    A null text counts as empty: no ids, empty decoded text.  All other columns
    pass through; columns named ``ids`` or ``decoded`` are replaced.  An empty
    table gives an empty table.  Rows need no shuffle; a worker holds
    ``SLICE_BYTES`` of text (or one text) and its bounded fragment table.
    """
    keep = [c for c in df.columns if c not in (text, "ids", "decoded")]
    source = df.select(F.col(f"`{text}`").alias("text"), *[F.col(f"`{c}`").alias(f"keep{i}") for i, c in enumerate(keep)])
    fields = source.schema.fields[1:]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in fields), SCHEMA])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in slices(batches):
            codec = codec or ForcedBoundaryCodec(path)
            ids, places = codec.encode(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], packed(ids, places), codec.decode(ids, places)],
                names=[*(f.name for f in fields), "ids", "decoded"])

    out = lean(source).mapInArrow(run, schema)
    return out.select(*[F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)], "ids", "decoded")
