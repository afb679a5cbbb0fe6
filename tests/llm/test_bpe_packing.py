"""BPE and packing against the tokenizers library and by their own rules."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meteoframe.llm import bpe, packing
from meteoframe.llm.common import stored

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LETTERS = list(" \t\n\r' 　   a1sltdrevemxAIK!?.,<|>éÄßİ中文🙂\U000F0000̸̱́‍\x1c\x85") + ["<|endoftext|>", "'ll", "'re", " the", "<|ENDOFTEXT|>"]


def noise(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("coder, path", [(bpe.ForcedBoundaryCodec, BYTE), (packing.WordEncoder, WORD)])
def test_ids_equal_the_library(coder, path):
    texts = noise(8000, 5) + ["", "x" * 5000, "the " * 3000]
    ids, places = coder(path).encode(pa.array(texts))
    library = Tokenizer.from_file(path)
    for text, e, i, j in zip(texts, library.encode_batch(texts, add_special_tokens=False), places, places[1:]):
        assert e.ids == ids[i:j].tolist(), text


def test_decode_equals_the_library():
    texts = noise(3000, 6)
    codec, library = bpe.ForcedBoundaryCodec(BYTE), Tokenizer.from_file(BYTE)
    ids, places = codec.encode(pa.array(texts))
    assert codec.decode(ids, places).to_pylist() == [library.decode(ids[i:j].tolist(), skip_special_tokens=False) for i, j in zip(places, places[1:])]
    assert codec.decode(np.array([b for b in codec.encode(pa.array(["é"]))[0]][:1], np.uint32), np.array([0, 1])).to_pylist() is not None


def test_encode_rows_with_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, None, "x"), (1, "", "y"), (1, "the cat", "z"), (1, "the cat", "z")]
    out = bpe.encode_decode(spark.createDataFrame(rows, "doc_id long, text string, ids string"), "text", BYTE)
    assert out.columns == ["doc_id", "ids", "decoded"]
    assert sorted((r.doc_id is None, r.decoded, len(r.ids)) for r in out.collect()) == [(False, "", 0), (False, "the cat", 8), (False, "the cat", 8), (True, "", 0)]
    assert bpe.encode_decode(spark.createDataFrame([], "doc_id long, text string"), "text", BYTE).count() == 0


def check_packing(rows, texts, library):
    ids = {}
    for key, text in texts:
        ids.setdefault(key, []).append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    for r in rows:
        assert any(own[r.start:r.start + r.length] == np.frombuffer(r.ids, "<u4").tolist() and len(own) == r.doc_tokens for own in ids[r.doc_id])
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.length
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc == {k: sum(map(len, v)) for k, v in ids.items()}
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return sum(r.length for r in rows) / (2048 * len(by_sequence))


def test_packs_every_id_once(spark):
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choice(["cat", "dogs", "Über", "a,b"]) for _ in range(rng.choice([0, 1, 5, 300, 900, 2600])))) for i in range(300)]
    texts += [(7, texts[7][1]), (1000, None), (1001, None), (1002, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = packing.pack(df, "doc_id", "text", WORD).collect()
    assert check_packing(rows, texts, Tokenizer.from_file(WORD)) > 0.95
    assert packing.pack(df.limit(0), "doc_id", "text", WORD).count() == 0


def test_one_length_shared_by_most_rows(spark):
    """A hot class is ranked in buckets, and still packed whole."""
    texts = [(i, "cat " * 500) for i in range(900)] + [(1000 + i, "cat") for i in range(700)]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text", WORD).collect()
    assert check_packing(rows, texts, Tokenizer.from_file(WORD)) > 0.95


def test_plan_uses_exactly_the_demand():
    rng = np.random.default_rng(1)
    sizes, per = packing.length_classes(2048)
    for scale in (1, 5, 200):
        demand = rng.integers(0, scale + 1, len(sizes))
        used = np.flatnonzero(demand)
        plan = packing.plan_sequences(sizes[used], demand[used], 256)
        assert (sum(p * n for p, n in plan) == demand[used]).all()
        assert all((p * sizes[used]).sum() <= 256 for p, _ in plan)
        assert sum(n for _, n in plan) <= 1.03 * (sizes[used] * demand[used]).sum() / 256 + 2


def test_best_pattern_is_optimal():
    rng = np.random.default_rng(3)
    for _ in range(30):
        sizes, values, room = rng.integers(1, 9, 4), rng.random(4), 17
        best = [0.0] * (room + 1)
        for c in range(1, room + 1):
            best[c] = max([best[c - 1], *(best[c - s] + v for s, v in zip(sizes, values) if s <= c)])
        value, pattern = packing.best_pattern(sizes, values, room)
        assert value == pytest.approx(best[room]) == pytest.approx(pattern @ values) and pattern @ sizes <= room


def test_stored_cuts_lineage(spark):
    df = stored(spark.range(5).withColumn("x", F.rand()), "test")
    assert df.collect() == df.collect() and "Scan parquet" in df._jdf.queryExecution().toString()


def test_digest_helpers():
    ids, places = packing.WordEncoder(WORD).encode(pa.array(["cat", None, "dogs cat"]))
    own = bpe.packed(ids, places).to_pylist()
    assert own[1] == b"" and zlib.crc32(own[0]) != zlib.crc32(own[2]) and hashlib.sha256(own[0]).hexdigest()
