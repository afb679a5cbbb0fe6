"""The registered corpus queries and the pipeline on the smallest tables."""

import itertools

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from meteoframe.llm import linededup, outliers, toxicity
from meteoframe.llm.common import stored
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op2_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op3_line_dedup": ["doc_id", "text", "n_lines", "n_dropped"],
    "op4_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_ngram_join": ["doc_id", "class_id", "n_links"],
    "op6_katz": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op7_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op9_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op10_html": ["page_id", "url", "text", "n_chars"],
    "op11_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op12_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13_hard_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
}
TABLE = {"op1_warc": "pages", "op10_html": "pages", "op8_embedding_dedup": "embeddings", "op12_whitening": "embeddings", "op13_hard_negatives": "embeddings"}
PER_ROW = {"op12_whitening": 4, "op13_hard_negatives": 50 / 100}      # rows out per row in


def test_all_are_registered():
    names = [n for n in E.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(names) == sorted([*COLUMNS, "pipeline"])
    assert {n for n in E.oracle_sql() if n.startswith("op")} == {
        "op1_warc", "op3_line_dedup", "op5_ngram_join", "op8_embedding_dedup", "op11_secrets", "op13_hard_negatives"}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query_covers_its_whole_table(spark, name):
    out = E.queries()[name](spark, SF).cache()
    assert set(COLUMNS[name]) <= set(out.columns)
    given = spark.read.parquet(f"{SF}/{TABLE.get(name, 'documents')}.parquet").count()
    key = out.columns[0] if name in TABLE else "doc_id"
    assert (out.select(key).distinct().count() if name == "op2_packing" else out.count()) == given * PER_ROW.get(name, 1)


@pytest.mark.parametrize("name", [n for n in E.oracle_sql() if n.startswith("op")])
def test_query_equals_its_sql(spark, name):
    r = compare(spark, duck(SF), name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["ok"], r


def grams(text):
    words = (text or "").split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outs, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stored(stage(spark, now, SF), "test-stage")
        outs[name] = before, now
        if name != "packing":
            assert now.columns == docs.columns
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}

    before, after = outs["toxicity"]
    scores = toxicity.score(before, toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))).collect()
    assert texts(after) == {k: v for k, v in texts(before).items() if k in {r.doc_id for r in scores if r.score < 0.5}}

    before, after = outs["quality rules"]
    kept = {r.doc_id for r in outliers.judge_documents(before).collect() if r.kept}
    assert texts(after) == {k: v for k, v in texts(before).items() if k in kept}

    before, after = outs["line dedup"]
    assert texts(after) == texts(linededup.drop_boilerplate(before)) and after.where("n_chars <> length(text)").count() == 0

    before, after = outs["n-gram Jaccard join"]
    sets = {k: grams(v) for k, v in texts(before).items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert set(texts(after)) == {k for k in sets if find(k) == k}

    before, after = outs["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {k: len(library.encode(v or "", add_special_tokens=False).ids) + 1 for k, v in texts(before).items()}
    assert {r.doc_id: r.n for r in after.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == sizes
    fill = after.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 2048 for r in fill) and np.mean([r.n for r in fill]) > 0.85 * 2048
    assert corpus_pipeline.run(spark, SF).count() == after.count()
