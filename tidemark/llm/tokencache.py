"""Token counts with a cache by digests of content and tokenizer."""

from __future__ import annotations

import hashlib
import os
from pathlib import Path

import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, of_worker, slices, stored

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"
_REMEMBERED = 300_000
_BYTES_AT_ONCE = 8_000_000


def token_counts(documents: DataFrame, tokenizer_path: str, cache_path: str) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, n_bytes, n_tokens``.

    ``tokenizer_path`` is a file of the ``tokenizers`` library that every executor can read; its
    normalizer must make a space of every run of white space and its pre-tokenizer must end
    tokens there. Counts are those of the library without added special tokens.

    The cache is a Parquet folder of ``content, tokenizer, n_tokens``: a SHA-256 of the text in
    which runs of ASCII white space are one space, one of the tokenizer's file, and the count.
    Texts that are in it are not encoded. Of the others one row of each digest is encoded (of rows
    that repeat, id and all, one a batch), and what that gives, if anything, is appended as one
    row a digest before it is read. Several rows of one digest (two runs that appended at once)
    agree; one is used.

    Null texts are empty: no bytes and no tokens. Ids may be null and may repeat. No documents
    give no rows and leave the cache as it is; other columns are ignored.
    """
    spark = documents.sparkSession
    version = hashlib.sha256(Path(tokenizer_path).read_bytes()).hexdigest()
    text = F.coalesce(F.col("text"), F.lit(""))
    content = F.unhex(F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ").cast("binary"), 256))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    digested = stored(
        rows.select(
            "doc_id",
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.xxhash64("text").alias("row"),
            content.alias("content"),
        )
    )
    cached = _cache(spark, cache_path).where(F.col("tokenizer") == version)
    known = cached.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    place = F.min(F.struct("doc_id", "row")).alias("place")
    misses = (
        digested.groupBy("content")
        .agg(place)
        .join(known, "content", "left_anti")
        .select("content", F.col("place.doc_id").alias("miss_id"), F.col("place.row").alias("miss_row"))
    )
    same = rows.doc_id.eqNullSafe(misses.miss_id) & (F.xxhash64(rows.text) == misses.miss_row)
    texts = rows.join(misses, same).select("content", F.col("text").cast("binary").alias("text"))
    counted = map_batches(texts, "content binary, n_tokens long", _counted(tokenizer_path), "tokenizers")
    # Rows that repeat, id and all, may come to several tasks.
    new = stored(counted.dropDuplicates(["content"]))
    if not new.isEmpty():
        new.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    cached = _cache(spark, cache_path).where(F.col("tokenizer") == version)
    known = cached.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    return digested.join(known, "content").select("doc_id", "n_bytes", "n_tokens")


def _cache(spark: SparkSession, path: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def _counted(tokenizer_path: str):
    def rows(batch: pa.RecordBatch) -> dict:
        tokenizer, known = _loaded(tokenizer_path)
        found: dict[bytes, int] = {}
        for part in slices(batch, "text", _BYTES_AT_ONCE):
            for content, text in zip(part.column("content").to_pylist(), part.column("text").to_pylist()):
                if content not in found:
                    found[content] = count(text, tokenizer, known)
        return {"content": pa.array(found, pa.binary()), "n_tokens": pa.array(found.values(), pa.int64())}

    return rows


def count(text: bytes, tokenizer, known: dict[bytes, int]) -> int:
    """Tokens of a UTF-8 text; ``known`` are the counts of words that were met before.

    White space always ends a token and gives none, so the count is the sum over the words.
    """
    words = text.split()
    if len(known) > _REMEMBERED:
        known.clear()
    new = list({w for w in words if w not in known})
    if new:
        encoded = tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        known.update(zip(new, map(len, encoded)))
    return sum(map(known.__getitem__, words))


def _loaded(path: str) -> tuple[tokenizers.Tokenizer, dict[bytes, int]]:
    """The tokenizer and the counts of words that this Python worker has met."""
    made = of_worker("tokenizers")
    # Spark runs a task on each core already.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in made:
        tokenizer = tokenizers.Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        made[path] = tokenizer, {}
    return made[path]
