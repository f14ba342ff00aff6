"""A corpus from documents: language ID, near copies, repeated passages, benchmark leaks, token ids.

Every stage but the last returns the columns of its input, extra ones included, whatever their names. doc_id is a
distinct integer; where rows compete, the least doc_id stays, so no tie arises. Empty tables give empty tables. Null and
empty texts have no language and go in the first stage; run on its own, each other stage keeps them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from umbra.llm import decontaminate, jaccard, langid, pieces, suffix
from umbra.llm.queries import TOKENIZERS
from umbra.llm.shared import shared_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is known: texts that are null, empty or without a letter go, as do those whose
    best language is not clearly the best (a score under 0.4). Without any label in docs all go."""
    return langid.keep(docs, langid.fit(docs), least=0.4)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each group of near copies; documents that differ in id only are one. A text without a
    word is alone in its group."""
    first = jaccard.link_components(docs).where("component_id = doc_id").select("doc_id")
    return docs.join(first, "doc_id", "left_semi").select(docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the bytes that an earlier string of 100 bytes covers; documents of which nothing remains go. Shorter
    texts, empty and null ones stay as they are."""
    return suffix.strip(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item, re-parameterised ones included. Null items and an empty benchmark
    drop nothing."""
    return decontaminate.keep(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the SentencePiece ids of the documents; a null text has null ids, an empty one none."""
    return pieces.encode(docs, pieces.load(f"{TOKENIZERS}/piece_bpe_32k.model"), keep=["lang", "source"])


STAGES = [("language", language), ("near_copies", near_copies), ("passages", passages), ("benchmark_leaks", benchmark_leaks), ("token_ids", token_ids)]
ORACLE_SQL = None  # trained weights, suffix runs and token ids are beyond SQL; tests/llm compare each stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each read again from what the one before wrote to the shared folder; what a stage has
    read goes once the stage is written."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            store.delete(path(f"{folder}/{k - 1}"), True)
    return docs
