"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the public tokenizers' files are; None takes the installed package's.
TOKENIZERS: str | None = None


def tokenizer(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import fit_language_model, held_out, identify_languages

    docs = table(spark, sf_dir, "documents")
    out = identify_languages(docs.select("doc_id", "text"), fit_language_model(docs), keep=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_personal_data

    return _span_columns(find_personal_data(table(spark, sf_dir, "documents")), ["email", "ip", "card", "phone"])


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import embedding_classes

    return embedding_classes(table(spark, sf_dir, "embeddings"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def _span_columns(found: DataFrame, counted: list[str]) -> DataFrame:
    """The digest columns of spans that are ordered by start, then kind."""

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in counted]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import find_secrets

    return _span_columns(find_secrets(table(spark, sf_dir, "documents")), ["assign", "access", "hex"])


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import bpe_digests

    return bpe_digests(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_count import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicate_classes

    return near_duplicate_classes(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .byte_bpe import ranked_digests

    import public_tokenizers

    return ranked_digests(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import centroid_clusters

    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resampling import resampled

    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from .centroids import clusters_sql
    from .embedding_dedup import EMBEDDINGS_SQL
    from .line_dedup import LINES_SQL
    from .minhash import CLASSES_SQL
    from .mixing import MIX_SQL
    from .resampling import RESAMPLING_SQL

    return {"op3_embeddings": EMBEDDINGS_SQL, "op4_line_dedup": LINES_SQL, "op9_minhash": CLASSES_SQL, "op10_mixing": MIX_SQL, "op12_centroids": clusters_sql(), "op13_resampling": RESAMPLING_SQL}
