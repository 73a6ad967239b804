"""Registered queries of the operators, with production parameters over
whole tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.ship import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document left after passages of 35 words that start
    anywhere else are removed."""
    from quire.llm.substring_dedup import dedup_substrings

    return dedup_substrings(spark, _table(spark, sf_dir, "documents"), kept_as="sha256").withColumnRenamed("kept", "kept_sha256")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by regularised quadratic discriminants."""
    from quire.llm import quality_classifier as Q

    docs = _table(spark, sf_dir, "documents")
    measured = Q.measure(docs, carry=["doc_id"])
    model = Q.learn(spark, measured, _table(spark, sf_dir, "labels"), stats_col="stats")
    got = Q.quality_scores(spark, measured, model, carry=["doc_id"], stats_col="stats")
    return got.select("doc_id", Q.held_out().alias("held_out"), "score", (F.col("score") >= Q.THRESHOLD).cast("int").alias("predicted"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-log-likelihood of every document."""
    from quire.llm.lm_score import lm_scores

    return lm_scores(spark, _table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the 32k piece model."""
    from quire.llm.token_count import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    from quire.llm import pii

    got = pii.find_spans(spark, _table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter(F.col("base")["k"], pii.is_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return got.select("doc_id", *counts, F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every embedding at a cosine of 0.95."""
    from quire.llm.embedding_dedup import near_duplicates

    return near_duplicates(spark, _table(spark, sf_dir, "embeddings"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the 49k word vocabulary and decoded again."""
    from quire.llm.bpe_codec import encode

    path = public_tokenizers.path("word_bpe_49k.json")
    return encode(spark, _table(spark, sf_dir, "documents"), path, carry=["doc_id"], outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a 1:2:3 weighted mix takes from every document."""
    from quire.llm.source_mix import mix

    return mix(spark, _table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document at a five-word shingle
    similarity of 0.8."""
    from quire.llm.ngram_join import similar_documents

    return similar_documents(spark, _table(spark, sf_dir, "documents")).drop("leads")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rule counts and the calibrated n-gram verdict of every document."""
    from quire.llm.quality_rules import quality_rules

    return quality_rules(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("probability")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document under ten-word windows of benchmark texts."""
    from quire.llm.decontamination import contamination

    got = contamination(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join("items", ","), 256)
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding by exact integer products."""
    from quire.llm.hard_negatives import mine

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return mine(spark, rows, F.col("vec_id") % 50 == 0)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, a tenth of which repeats its tail."""
    from quire.llm.periodic_runs import periodic_runs, repeated_tail

    got = periodic_runs(spark, _table(spark, sf_dir, "documents"), text=repeated_tail(), kept_as="sha256")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return got.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period",
        F.expr("(1000 * length) div period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.col("kept").alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_quality_classifier, op3_lm_score, op4_token_counts, op5_pii, op6_embedding_dedup,
        op7_bpe_codec, op8_source_mix, op9_ngram_join, op10_quality_rules,
        op11_decontamination, op12_hard_negatives, op13_periodic_runs,
    )
}

_ITEM_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS no, doc_id, {_ITEM_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item, m, array_to_string(w[s:s + m - 1], ' ') AS x
       FROM (SELECT item, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0) q),
m AS (SELECT DISTINCT m FROM iw),
dw AS (SELECT no, m, s, array_to_string(w[s:s + m - 1], ' ') AS x
       FROM (SELECT no, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, m) q),
hits AS (SELECT no, s, iw.m AS m, item FROM dw JOIN iw ON dw.m = iw.m AND dw.x = iw.x),
words AS (SELECT no, count(DISTINCT p) AS n_hit FROM (SELECT no, unnest(range(s, s + m)) AS p FROM hits) q GROUP BY no),
items AS (SELECT no, list_sort(list(DISTINCT item)) AS items FROM hits WHERE item IS NOT NULL GROUP BY no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (no) LEFT JOIN items USING (no)
"""

OP12_SQL = """
WITH e AS (SELECT row_number() OVER () AS no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.no, a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
             CASE WHEN len(a.v) = 0 THEN 0 ELSE CAST(list_dot_product(a.v, c.v) AS BIGINT) END AS score
      FROM e a JOIN e c ON a.no <> c.no AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
pos AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, other_id) AS r FROM p WHERE same) q WHERE r <= 5),
neg AS (SELECT pos.anchor_id, pos.other_id AS positive_id, p.other_id AS negative_id, pos.score AS positive_score, p.score AS negative_score,
               row_number() OVER (PARTITION BY pos.no, pos.r ORDER BY p.score DESC, p.other_id) AS rank
        FROM pos JOIN p ON pos.no = p.no AND NOT p.same AND 50 * pos.score <= 100 * p.score AND 100 * p.score <= 95 * pos.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS no, doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT no, s, array_to_string(w[s:s + 34], ' ') AS x FROM (SELECT no, w, unnest(range(1, len(w) - 33)) AS s FROM d) q),
again AS (SELECT no, s FROM (SELECT no, s, count(*) OVER (PARTITION BY x) AS c FROM win) q WHERE c > 1),
gone AS (SELECT DISTINCT no, unnest(range(s, s + 35)) AS p FROM again),
kept AS (SELECT no, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
         FROM (SELECT no, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) q ANTI JOIN gone USING (no, p) GROUP BY no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (no)
"""

OP6_SQL = """
WITH RECURSIVE
e AS (SELECT row_number() OVER () AS no, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
u AS (SELECT no, vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM e
      WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0),
near AS MATERIALIZED (SELECT a.no AS a, b.no AS b FROM u a JOIN u b ON a.no < b.no AND len(a.v) = len(b.v)
                      WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.95),
link AS MATERIALIZED (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
n AS (SELECT a AS no, count(*) AS n_links FROM link GROUP BY a),
least AS (SELECT reach.a AS no, min(o.vec_id) AS vec_id FROM reach JOIN e o ON o.no = reach.b GROUP BY reach.a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, least(e.vec_id, coalesce(l.vec_id, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.vec_id, e.vec_id)) AS kept
FROM e LEFT JOIN n USING (no) LEFT JOIN least l USING (no)
"""

# documents of one shingle set are a class; links of classes, then of their rows
OP9_SQL = f"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS no, doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT no, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS x FROM d),
c AS MATERIALIZED (SELECT row_number() OVER () AS k, x, len(x) AS n, count(*) AS copies, min(doc_id) AS low FROM s WHERE len(x) > 0 GROUP BY x),
g AS MATERIALIZED (SELECT k, n, unnest(x) AS h FROM c),
near AS MATERIALIZED (SELECT a.k AS a, b.k AS b FROM g a JOIN g b ON a.h = b.h AND a.k < b.k AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
                      GROUP BY a.k, b.k, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))),
link AS MATERIALIZED (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
n AS (SELECT a AS k, sum(copies) AS others FROM link JOIN c ON c.k = link.b GROUP BY a),
least AS (SELECT a AS k, min(low) AS low FROM reach JOIN c ON c.k = reach.b GROUP BY a)
SELECT s.doc_id, CASE WHEN c.k IS NULL THEN s.doc_id ELSE least(c.low, coalesce(l.low, c.low)) END AS class_id,
       CAST(coalesce(c.copies - 1 + coalesce(n.others, 0), 0) AS BIGINT) AS n_links
FROM s LEFT JOIN c ON c.x = s.x LEFT JOIN n ON n.k = c.k LEFT JOIN least l ON l.k = c.k
"""

ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op6_embedding_dedup": OP6_SQL,
    "op9_ngram_join": OP9_SQL,
    "op11_decontamination": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}
