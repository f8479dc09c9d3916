"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    idcoder,
    lines,
    maintext,
    minhash,
    negatives,
    phrases,
    pieces,
    spans,
    tokencache,
    toxicity,
    url_graph,
    whitening,
)
from tidemark.llm.common import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.repeated_lines_removed(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "text")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/ids"
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    idcoder.write_ids(_table(spark, sf_dir, "documents"), tokenizer, END_ID, path)
    return idcoder.read_checksums(spark, path)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.contaminated(documents, benchmark)


# (verdict, host, path)
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
TOKEN_LIMIT = 2048
END_ID = 2
ANCHOR_STEP = 50


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_and_back(_table(spark, sf_dir, "documents"))


def pieces_and_back(documents: DataFrame) -> DataFrame:
    """The ids of every text, and the length and SHA-256 of what they spell."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    spelled = pieces.decoded(pieces.encoded(documents, path), path)
    return spelled.select(
        "doc_id",
        "n_pieces",
        "ids",
        F.length("text").cast("long").alias("decoded_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return phrases.edited_fingerprints(_table(spark, sf_dir, "documents"), parts)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spans.repeated_spans_removed(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_sentences", "n_removed", "repeats_of", "text")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = toxicity.scored(documents, toxicity.fit(documents, labels))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    cache = f"{shared_folder(spark)}/token-counts"
    counted = tokencache.token_counts(_table(spark, sf_dir, "documents"), path, cache)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return maintext.main_texts(pages, maintext.fit(pages))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    anchors = vectors.where(F.col("vec_id") % ANCHOR_STEP == 0).select("vec_id")
    return negatives.hard_negatives(vectors.withColumn("label", shifted), anchors)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_url_filters": op1_url_filters,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_token_output": op8_token_output,
    "op9_decontamination": op9_decontamination,
    "op10_token_counts": op10_token_counts,
    "op11_html_extraction": op11_html_extraction,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op6_line_dedup": lines.oracle_sql()}
