"""From raw documents to a tokenised training mix: five stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run()
writes as Parquet and reads again as the next stage's documents.  All stages
but the last return the columns of `documents`; n_chars is kept in step with
the text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.bpe import bpe_encode
from concord.llm.common import shared_folder
from concord.llm.language_id import UNKNOWN, fit_language_model, identify_languages
from concord.llm.line_dedup import dedup_lines
from concord.llm.minhash import near_dedup
from concord.llm.mixing import mixed_documents
from concord.llm.queries import tokenizer

#: A document is rejected if no language reaches this mean probability over its bytes: no language is then likely.
LEAST_LANGUAGE_SCORE = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; those without a letter, and those that fit none, go."""
    told = identify_languages(docs, fit_language_model(docs))
    return told.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that recur across documents; a document of which nothing is left goes."""
    out = dedup_lines(docs)
    left = out.filter((F.col("n_dropped") == 0) | (F.trim("text") != ""))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates; null ids, texts without words and repeated rows stay."""
    return near_dedup(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and in the order, that the source weights and the curriculum ask for.

    A null source is a source of its own; texts without words are not taken; each of several equal rows has its own turns.
    """
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, token_ids of every document of the mix, one row for each of its turns (null and empty texts: no tokens)."""
    out = bpe_encode(docs, tokenizer("byte_bpe_50k.json"))
    return out.select("doc_id", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [("language ID", language), ("line dedup", lines), ("MinHash near-dedup", near_duplicates), ("mixing", mixture), ("BPE", tokens)]

#: SQL can express neither the network nor the signatures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is written to the folder in spark.checkpoint.dir."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
