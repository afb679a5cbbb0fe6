"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers

from meteoframe.llm import bpe, hardneg, htmlcut, katz, linededup, ngramjoin, nndescent, outliers, packing, secrets, toxicity, warc, whitening
from meteoframe.llm.common import remainder, stored, table
from meteoframe.session import scratch_path


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived, indexed, and read back through the index."""
    root = scratch_path(spark, "op1-warc")
    warc.write_archives(table(spark, sf_dir, "pages"), f"{root}/archives")
    records = stored(warc.read_archives(spark, f"{root}/archives").drop("payload"), "op1-records")
    warc.write_index(records, f"{root}/index")
    captures = warc.read_captures(spark, f"{root}/index").select("key", "file", "offset", "length")
    return (records.join(captures, ["file", "offset", "length"])
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "key"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.assign(stored(pieces, "op2-pieces"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat across their source."""
    return linededup.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of the labelled rows outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their near-duplicate class and number of links."""
    return ngramjoin.jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of four fifths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return katz.score_corpus(docs, remainder(F.col("doc_id")) != 1, order=3).rows


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode_decode(docs, "text", public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors with their links of cosine 0.9 or more."""
    return nndescent.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).rows


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' base counts and verdicts."""
    return outliers.judge_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")).drop("lang", "source")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmlcut.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' secrets, by the fixed rules and by models of this corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, secrets.learn(docs)).drop("text")

    def count(kind: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("secrets", lambda s: s["kind"] < secrets.KINDS.index("markov"))
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secrets.as_text(base).cast("binary"), 256).alias("base_sha256"), secrets.as_text(F.col("secrets")).alias("spans"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on their first four whitened components."""
    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, some labels moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {"op1_warc": op1_warc, "op2_packing": op2_packing, "op3_line_dedup": op3_line_dedup,
           "op4_toxicity": op4_toxicity, "op5_ngram_join": op5_ngram_join, "op6_katz": op6_katz, "op7_bpe": op7_bpe, "op8_embedding_dedup": op8_embedding_dedup,
           "op9_quality": op9_quality, "op10_html": op10_html,
           "op11_secrets": op11_secrets, "op12_whitening": op12_whitening, "op13_hard_negatives": op13_hard_negatives,
           "pipeline": corpus_pipeline.run}

ORACLE = {
    "op1_warc": r"""
WITH page AS (SELECT page_id, url, encode(coalesce(html, '')) AS body FROM pages),
own AS (SELECT page_id, octet_length(body) AS payload_bytes, rpad(sha1(body), 41, '0') AS h, body,
        regexp_extract(url, '^[a-z]+://([^/?#:]*)[^/?#]*([^?#]*)(\?[^#]*)?', ['host', 'path', 'query']) AS u FROM page),
first AS (SELECT body, max(page_id) AS leader FROM own GROUP BY body)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + (('0x' || h[1 + (5 * i) // 4:2 + (5 * i) // 4])::INTEGER >> (3 - (5 * i) % 4)) % 32]), '') AS payload_digest,
       CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> leader THEN leader END AS refers_to,
       CASE WHEN coalesce(u.host, '') = '' THEN '-' ELSE array_to_string(list_reverse(string_split(lower(u.host), '.')), ',') || ')' || CASE u.path WHEN '' THEN '/' ELSE u.path END || u.query END AS key
FROM own JOIN first USING (body)""",
    "op3_line_dedup": r"""
WITH page AS (SELECT row_number() OVER () AS rid, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
line AS (SELECT rid, source, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM page),
keyed AS (SELECT rid, source, pos, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM line),
total AS (SELECT source, count(*) AS t FROM page GROUP BY source),
freq AS (SELECT source, k, count(DISTINCT rid) AS n FROM keyed WHERE k <> '' GROUP BY source, k),
boiler AS (SELECT f.source, k FROM freq f JOIN total USING (source) WHERE n >= 5 AND n > CASE WHEN length(k) >= 20 THEN 0.01 ELSE 0.1 END * t),
flagged AS (SELECT keyed.*, boiler.k IS NOT NULL AS gone FROM keyed LEFT JOIN boiler ON keyed.source = boiler.source AND keyed.k = boiler.k),
doc AS (SELECT rid, count(*) FILTER (WHERE k <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_gone,
        coalesce(sum(length(k)) FILTER (WHERE NOT gone), 0) >= 0.25 * sum(length(k)) AS kept,
        string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS rest FROM flagged GROUP BY rid)
SELECT doc_id, source, CASE WHEN n_gone > 0 AND kept THEN rest ELSE text END AS text,
       coalesce(n_lines, 0) AS n_lines, CASE WHEN kept THEN n_gone ELSE 0 END AS n_dropped
FROM page LEFT JOIN doc USING (rid)""",
    "op5_ngram_join": r"""
WITH RECURSIVE page AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
gram AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 4 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM page),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
meet AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM gram x JOIN gram y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
pair AS (SELECT a, b FROM meet JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 5 * meet.n >= 4 * (p.n + q.n - meet.n)),
link AS MATERIALIZED (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach AS (SELECT a, a AS root FROM link UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.a WHERE reach.root < link.b),
top AS (SELECT a AS doc_id, min(root) AS class_id FROM reach GROUP BY a),
many AS (SELECT a AS doc_id, count(*) AS n FROM link GROUP BY a)
SELECT doc_id, CASE WHEN len(w) > 0 THEN min(doc_id) OVER (PARTITION BY array_to_string(w, ' ')) ELSE doc_id END AS copy_id,
       coalesce(n, 0) AS n_links, coalesce(class_id, doc_id) AS class_id FROM page LEFT JOIN top USING (doc_id) LEFT JOIN many USING (doc_id)""",
    "op8_embedding_dedup": r"""
WITH RECURSIVE good AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT a, a AS root FROM link UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.a WHERE reach.root < link.b),
top AS (SELECT a AS vec_id, min(root) AS component_id FROM reach GROUP BY a),
many AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN top USING (vec_id) LEFT JOIN many USING (vec_id)""",
    "op11_secrets": r"""
WITH rule(kind, name, pattern, hint) AS (VALUES
  (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 12),
  (1, 'access', 'AKIA[A-Z0-9]+', 18), (2, 'hex', '[0-9a-f]+', 16)),
page AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT rid, kind, hint, regexp_extract_all(text, pattern) AS hits, string_split_regex(text, pattern) AS gaps,
        CASE WHEN kind = 0 THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern) END AS parts FROM page, rule),
hit AS (SELECT rid, kind, hint, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap, unnest(parts) AS part, generate_subscripts(hits, 1) AS pos FROM cut WHERE len(hits) > 0),
base AS (SELECT rid, kind, e - length(hit) AS s, e, part FROM (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY rid, kind ORDER BY pos) AS e FROM hit) WHERE length(part) >= hint),
word AS (SELECT rid, regexp_extract_all(text, '[A-Za-z0-9+/_=-]{12,}') AS words FROM page),
sample AS (SELECT DISTINCT part AS token, true AS random FROM base
  UNION ALL SELECT token, false FROM (SELECT DISTINCT unnest(words) AS token FROM word) w
  WHERE NOT regexp_matches(token, 'AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}|(?i:(password|passwd|secret|token|api_?key)=*[:=]([A-Za-z0-9+/_.=-]+))') AND token NOT IN (SELECT part FROM base)
  UNION ALL SELECT unnest([d[:40], p, translate(p, '+/', '-_'), upper(translate(p, '+/', '')), translate(p, '+/', '')]), true
  FROM (SELECT sha256(i::VARCHAR) AS d, translate(base64(unhex(sha256(i::VARCHAR))), '=', '') AS p FROM range(2000) r(i))),
pair AS (SELECT random, CASE WHEN i = 1 THEN 0 ELSE ascii(token[i - 1]) END AS a, ascii(token[i]) AS b, count(*) AS n
  FROM (SELECT random, token, unnest(range(1, length(token) + 1)) AS i FROM sample) GROUP BY ALL),
total AS (SELECT random, a, sum(n) AS n FROM pair GROUP BY ALL),
letter AS (SELECT random, b, sum(n) AS n FROM pair GROUP BY ALL),
whole AS (SELECT coalesce(sum(n) FILTER (random), 0) AS x, coalesce(sum(n) FILTER (NOT random), 0) AS y FROM pair),
token AS (SELECT rid, hit, s, s + length(hit) AS e FROM (SELECT rid, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY rid ORDER BY pos) - length(hit) AS s
  FROM (SELECT rid, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap, generate_subscripts(hits, 1) AS pos
    FROM (SELECT rid, regexp_extract_all(text, '[A-Za-z0-9+/_=-]{16,}') AS hits, string_split_regex(text, '[A-Za-z0-9+/_=-]{16,}') AS gaps FROM page) WHERE len(hits) > 0))),
step AS (SELECT t, CASE WHEN i = 1 THEN 0 ELSE ascii(t[i - 1]) END AS a, ascii(t[i]) AS b FROM (SELECT t, unnest(range(1, length(t) + 1)) AS i FROM (SELECT DISTINCT hit AS t FROM token))),
score AS (SELECT t, sum(round(1000 * (ln((coalesce(p.n, 0) + 33 * ((coalesce(pl.n, 0) + 0.5::DOUBLE) / (x + 33))) / (coalesce(pt.n, 0) + 33))
                                    - ln((coalesce(q.n, 0) + 33 * ((coalesce(ql.n, 0) + 0.5::DOUBLE) / (y + 33))) / (coalesce(qt.n, 0) + 33))))) AS llr
  FROM step CROSS JOIN whole LEFT JOIN pair p ON p.random AND p.a = step.a AND p.b = step.b LEFT JOIN total pt ON pt.random AND pt.a = step.a LEFT JOIN letter pl ON pl.random AND pl.b = step.b
  LEFT JOIN pair q ON NOT q.random AND q.a = step.a AND q.b = step.b LEFT JOIN total qt ON NOT qt.random AND qt.a = step.a LEFT JOIN letter ql ON NOT ql.random AND ql.b = step.b GROUP BY t),
added AS (SELECT rid, 3 AS kind, s, e FROM token JOIN score ON hit = t WHERE llr > 6908
  AND NOT EXISTS (SELECT 1 FROM base WHERE base.rid = token.rid AND base.s < token.e AND base.e > token.s)),
span AS (SELECT rid, kind, s, ['assign', 'access', 'hex', 'markov'][kind + 1] || ':' || s::BIGINT || ':' || e::BIGINT AS w FROM (SELECT rid, kind, s, e FROM base UNION ALL FROM added)),
doc AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg(w, ',' ORDER BY s, kind) FILTER (kind < 3) AS b, string_agg(w, ',' ORDER BY s, kind) AS spans FROM span GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans FROM page LEFT JOIN doc USING (rid)""",
    "op13_hard_negatives": r"""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, r.vec_id AS b, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM r a JOIN r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b)::INTEGER AS rank,
       s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10""",
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
