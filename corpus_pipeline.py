"""Corpus pipeline: language ID, near-dedup, repeated passages, benchmark
decontamination, packing. Each stage is written and reread; a stage works on
all that its predecessor kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.llm import decontaminate, language, minhash, packing, repeats
from ingot.llm.common import corpus_table, ship_package, written
from ingot.llm.tokens import WORD_LEVEL
from ingot.session import partitions_for

WORD_BPE = "word_bpe_49k.json"
#: A document goes if it has no letters or its words are spread over the languages.
LEAST_LANGUAGE_SCORE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identifiable language; ``lang`` becomes the predicted one."""
    ship_package(spark)
    model = language.train(docs)
    if model is None:
        return docs
    lang, score = (f"{n}_{uuid.uuid4().hex}" for n in ("lang", "score"))
    return language.predict(docs, model, (lang, score)) \
        .filter((F.col(lang) != language.UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE_SCORE)) \
        .withColumn("lang", F.col(lang)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one of the
    smallest doc_id. Rows under one doc_id with different texts are documents
    of their own; of rows with one doc_id and text one stays."""
    ship_package(spark)
    if not docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1").isEmpty():
        return _drop_by_row(docs)
    found = written(minhash.near_duplicates(docs, k=5, percent=80), "near-duplicates")
    going = found.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(going, "doc_id", "left_anti").select(*docs.columns)


def _drop_by_row(docs: DataFrame) -> DataFrame:
    """The same where a doc_id does not name a row: rows are numbered in order
    of doc_id and text, written down, and deduplicated by their numbers."""
    row = f"row_{uuid.uuid4().hex}"
    rows = docs.dropDuplicates(["doc_id", "text"])
    by = ["doc_id", F.xxhash64("text")]
    numbered = written(rows.repartitionByRange(partitions_for(docs), *by).sortWithinPartitions(*by)
                       .withColumn(row, F.monotonically_increasing_id()), "numbered-rows")
    found = written(minhash.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), k=5, percent=80),
                    "near-duplicates")
    going = found.filter(~F.col("kept")).select(F.col("doc_id").alias(row)).distinct()
    return numbered.join(going, row, "left_anti").select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every passage of 100 bytes or more that occurred earlier is cut out.
    Documents stay, even with nothing left but an empty text."""
    ship_package(spark)
    return repeats.remove_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    ship_package(spark)
    return decontaminate.remove_leaks(docs, corpus_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of at most 4096 tokens."""
    ship_package(spark)
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path(WORD_BPE), WORD_LEVEL))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

# The language model, the latent space and the tokenizer have no SQL form;
# tests/llm/test_pipeline.py compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
