"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; all but the last return the columns of ``documents``, so
further columns of the input go.  An empty table gives an empty result in every
stage.  Null and empty texts pass the toxicity stage by their score and fail the
quality rules; rows without id, language or source are rows like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from meteoframe.llm import linededup, ngramjoin, outliers, packing, toxicity
from meteoframe.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier holds toxic go.  Texts
    that are null or empty have a score too; repeated rows share theirs."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep_text=True).where("score < 0.5").select(*COLUMNS)


def drop_outliers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules (null, empty and very short texts among
    them), or lie far from their language's and source's other documents, go.
    A null language or source is one of its own.  Repeated rows stay repeated."""
    counts = stored(outliers.with_counts(docs), "pipeline-counts")
    return outliers.RobustQuality().fit(counts.drop("text")).judge(counts).where("kept").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; ``n_chars`` follows the text.  All rows stay; a null
    source is one host."""
    cleaned = linededup.drop_boilerplate(docs)
    return cleaned.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.
    Rows without id stay; repeated rows are one document."""
    first = ngramjoin.jaccard_join(docs).where("doc_id = class_id").select("doc_id").distinct()
    return (docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
            .unionByName(docs.where("doc_id IS NULL")).select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 tokens: one row per piece; a
    null text is empty, repeated rows are packed each."""
    pieces = packing.token_pieces(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.assign(stored(pieces, "pipeline-pieces"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_outliers),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_copies),
    ("packing", pack),
]

#: Trained models, iterated estimates and tokenizers: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
