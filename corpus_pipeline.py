"""Corpus preparation: documents to token ids, in five stages.

1. quality    the quality classifier rejects documents under its threshold;
2. distinct   of each class of near duplicates one document stays;
3. private    spans of personal data are replaced by their kind;
4. mix        sources are mixed to 1:2:3 weights: a document is left out,
              kept or repeated up to three times;
5. encode     every text becomes token ids, which are decoded again.

Each stage takes and, but for the last, returns the columns of documents
(whatever they are, beyond doc_id, text and source), and is written as Parquet
before the next reads it; what a stage wrote on its way is deleted when the next
one starts, so the job needs the disk of one stage. Null ids and texts, empty texts, repeated rows and
empty tables go through; see the operators for what each gives them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe_codec, ngram_join, pii, quality_classifier, source_mix
from quire.llm.ship import ship
from quire.session import configure, drop_scratch, remove_path, scratch_folders, write_scratch

VOCABULARY = "word_bpe_49k.json"


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Whole rows travel to the Python workers: small batches keep these small.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
_LEFT: dict[str, list[str]] = {}  # per application: scratch folders of the stage before


def staged(stage: Stage) -> Stage:
    """Delete the scratch of the stage before, but for folders that ``docs``
    itself still reads: a stage's result is to be written before the next is called."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        configure(spark)
        for name, value in BATCHES.items():
            spark.conf.set(name, value)
        app = spark.sparkContext.applicationId
        left = drop_scratch(spark, _LEFT.pop(app, []), docs)
        before = set(scratch_folders(spark))
        out = stage(spark, docs, sf_dir)
        _LEFT[app] = left + [p for p in scratch_folders(spark) if p not in before]
        return out

    return run_stage


@staged
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's threshold."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = quality_classifier.learn(spark, docs, labels)
    scored = quality_classifier.quality_scores(spark, docs, model, score_col="quality score")
    return scored.where(F.col("quality score") >= quality_classifier.THRESHOLD).drop("quality score")


@staged
def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of near duplicates."""
    ship(spark)
    return ngram_join.similar_documents(spark, docs, carry=True).where("leads").select("row.*")


@staged
def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced; n_chars, if there, is counted anew."""
    found = pii.find_spans(spark, docs, carry=True)
    text = pii.redacted(F.col("row.text"), F.col("spans"))
    cols = [F.col(f"row.`{c}`").alias(c) if c not in ("text", "n_chars") else (text if c == "text" else F.length(text).cast(docs.schema[c].dataType)).alias(c) for c in docs.columns]
    return found.select(*cols)


@staged
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words, to the nearest whole."""
    mixed = source_mix.mix(spark, docs, carry=True)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), times))).select("row.*")


@staged
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids (packed 32-bit integers), their number and digests."""
    ship(spark)
    outputs = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    return bpe_codec.encode(spark, docs, public_tokenizers.path(VOCABULARY), carry=["doc_id"], outputs=outputs)


STAGES = [("quality", quality), ("distinct", distinct), ("private", private), ("mix", mix), ("encode", encode)]

ORACLE_SQL = None  # SQL can't express the trained stages; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    path = None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            before, path = path, write_scratch(docs, f"pipeline-{name}")
            if before:
                remove_path(spark, before)
            docs = spark.read.parquet(path)
    return docs
