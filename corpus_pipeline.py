"""The corpus pipeline: from raw documents to packed training sequences.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.

1. ``language_id`` drops documents in which no language is recognised: no
   letters, or a score under one half.
2. ``ngram_jaccard_join`` keeps one row, the one of the smallest doc_id (null last),
   of each group of near duplicates, whatever their ids.  Texts without words are
   like nothing and stay.
3. ``suffix_dedup`` takes out passages of 100 bytes or more that appeared
   before; a document of which nothing but white space stays goes.
4. ``secret_scan`` masks secrets in the texts.
5. ``best_fit_packing`` packs the tokens of what is left into sequences.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgepole.llm import lang_id, ngram_join, packing, secret_scan, suffix_dedup
from lodgepole.llm.common import free_name, shared_dir, small_batches, written

MIN_SCORE = 0.5
ORACLE_SQL = None  # models, MinHash and tokens are not expressible in SQL: tested against brute force


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    predict = lang_id.predictor(docs, lang_id.fit(docs))
    found = free_name(docs, "found")
    told = docs.withColumn(found, predict(F.col("text").cast("string")))
    return told.filter((F.col(found)["lang_pred"] != lang_id.UNKNOWN) & (F.col(found)["score"] >= MIN_SCORE)).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows are told apart by a number of their own: ids may repeat or be null
    row = free_name(docs, "row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered", codec="zstd")
    classes = ngram_join.near_duplicates(numbered, id_col=row).select(F.col("doc_id").alias(row), "class_id")
    own = numbered.select(row, F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.col(row).alias("row")).alias("place"))
    stay = classes.join(own, row).groupBy("class_id").agg(F.min("place").alias("place")).select(F.col("place.row").alias(row))
    return numbered.join(stay, row, "left_semi").select(*docs.columns)


def suffix_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    removed = free_name(docs, "removed")
    left = suffix_dedup.without_repeats(docs, removed=removed)
    changed = F.col(removed) > 0
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.filter(~changed | F.col("text").rlike(r"\S")).select(*docs.columns)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_dedup", suffix_removal),
    ("secret_scan", secret_masking),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents``; stages are written to the shared folder in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
