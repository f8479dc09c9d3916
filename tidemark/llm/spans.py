"""Substring dedup: runs of consecutive sentences that occur again are removed."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, mixed, stored
from tidemark.llm.runs import later_keys, unpacked, with_row

SENTENCES = 3
LEAST_WORDS = 12
# A sentence ends behind white space after one of these marks, and behind a line end. Commas
# and the like count, so that a passage pasted into the middle of a sentence has inner ends.
_END = re.compile(r"[.!?;:,][ \t\r]|\n")
# Behind so many words without an end, one word in CUT_ONE_IN, chosen by its hash, ends a piece, so
# that passages of long sentences, too, have inner ends wherever they are pasted.
LONG_WORDS, CUT_ONE_IN = 8, 5
_WORD = re.compile(r"[ \t\r]*[^ \t\r]+[ \t\r]*")
_BLANK = " \t\n\r\x0b\x0c"


def repeated_spans_removed(
    documents: DataFrame, sentences: int = SENTENCES, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``documents`` with ``n_sentences, n_removed, repeats_of``, and ``text`` without repeats.

    Every run of ``sentences`` consecutive sentences with at least ``least_words`` words is
    looked up over all documents, in lower case and without white space around sentences. Long
    sentences are cut into several at words that their hashes choose. Of
    equal runs the one with the smallest ``doc_id`` and position stays; the sentences that any
    other covers are removed, so a passage goes as a whole with all runs inside it.
    ``repeats_of`` lists the documents that have the first occurrences.

    Texts are cut once, into 128-bit keys of runs that are written; only texts that lose
    something are cut again. Both passes hold one batch of texts at a time.

    A null text stays null, with no sentences; an empty one has one. Rows without id are not
    looked at. Rows that repeat both id and text count as one document and change alike.
    No documents give no rows; further columns are passed on, but for any of the added names.
    """
    rows = with_row(documents)
    cut = stored(_runs(rows.where("text is not null"), sentences, least_words))
    runs = later_keys(cut.where("doc_id is not null").select("doc_id", "_row", F.inline(F.arrays_zip("at", "k1", "k2"))))
    found = runs.groupBy("doc_id", "_row").agg(
        F.collect_set("at").alias("_at"), F.sort_array(F.collect_set("first.doc_id")).alias("_first")
    )
    counts = cut.groupBy("doc_id", "_row").agg(F.min("n_parts").alias("_parts"))
    decided = counts.join(found, ["doc_id", "_row"], "left").select(
        F.col("doc_id").alias("_id"), F.col("_row").alias("_hash"), "_parts", "_at", "_first"
    )
    same = [rows["doc_id"].eqNullSafe(decided["_id"]), rows["_row"] == decided["_hash"]]
    left = rows.join(decided, same, "left")
    changed = F.col("_at").isNotNull()
    kept = _without(sentences)(F.when(changed, F.col("text").cast("binary")), "_at")
    left = left.withColumn("_kept", kept).withColumn(
        "text", F.when(changed, F.col("_kept.text").cast("string")).otherwise(F.col("text"))
    )
    return unpacked(
        left,
        documents,
        n_sentences=F.coalesce("_parts", F.lit(0)),
        n_removed=F.coalesce("_kept.n_removed", F.lit(0)),
        repeats_of=F.coalesce("_first", F.array().cast("array<long>")),
    )


def pieces(text: str) -> list[str]:
    """The sentences of ``text`` in order, long ones cut; joined they are the text."""
    ends = [0, *(m.end() for m in _END.finditer(text)), len(text)]
    found = []
    for i, j in zip(ends[:-1], ends[1:]):
        sentence = text[i:j]
        if sentence.count(" ") < LONG_WORDS:
            found.append(sentence)
        else:
            found += _cut(sentence)
    return found


def _cut(sentence: str) -> list[str]:
    words = _WORD.findall(sentence)
    found, at = [], 0
    for i in range(LONG_WORDS, len(words)):
        if not zlib.crc32(_bytes(words[i].strip(_BLANK).lower())) % CUT_ONE_IN:
            found.append("".join(words[at : i + 1]))
            at = i + 1
    if at < len(words):
        found.append("".join(words[at:]))
    return found or [sentence]


def _runs(rows: DataFrame, size: int, least_words: int) -> DataFrame:
    weights = np.random.default_rng(41).integers(1, 2**63, (2, size), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def cut(batch: pa.RecordBatch) -> dict:
        counts, places, keys = [], [], []
        for text in batch.column("text").to_pylist():
            bare = [p.strip(_BLANK).lower() for p in pieces(_text(text))]
            counts.append(len(bare))
            n = max(0, len(bare) - size + 1)
            hashed = b"".join([xxhash.xxh3_128_digest(_bytes(p)) for p in bare])
            hashes = np.frombuffer(hashed, np.uint64).reshape(-1, 2)
            words = np.fromiter((p.count(" ") + 1 for p in bare), np.int64, len(bare))
            total = np.zeros(n, np.int64)
            both = np.zeros((2, n), np.uint64)
            for i in range(size):
                total += words[i : i + n]
                both += hashes[i : i + n].T * weights[:, i : i + 1]
            places.append(np.flatnonzero(total >= least_words).astype(np.int32))
            keys.append(mixed(both[:, places[-1]]))
        ends = pa.array(np.cumsum([0, *map(len, places)], dtype=np.int32))
        first, second = np.concatenate(keys, axis=1).view(np.int64)
        lists = {"at": np.concatenate(places), "k1": first, "k2": second}
        return {
            "doc_id": batch.column("doc_id"),
            "_row": batch.column("_row"),
            "n_parts": pa.array(counts, pa.int64()),
            **{k: pa.ListArray.from_arrays(ends, pa.array(v)) for k, v in lists.items()},
        }

    schema = "doc_id long, _row long, n_parts long, at array<int>, k1 array<long>, k2 array<long>"
    whole = rows.select(F.col("doc_id").cast("long"), "_row", F.col("text").cast("binary").alias("text"))
    return map_batches(whole, schema, cut)


def _without(size: int):
    @F.pandas_udf("text binary, n_removed long")
    def without(text: pd.Series, at: pd.Series) -> pd.DataFrame:
        texts, removed = [], []
        for whole, places in zip(text, at):
            if whole is None:
                texts.append(None)
                removed.append(0)
                continue
            parts = pieces(_text(whole))
            gone = np.zeros(len(parts), bool)
            for i in range(size):
                gone[np.asarray(places) + i] = True
            texts.append(_bytes("".join([p for p, g in zip(parts, gone) if not g])))
            removed.append(int(gone.sum()))
        return pd.DataFrame({"text": texts, "n_removed": removed})

    return without


def _text(text: bytes) -> str:
    # Bytes that are no UTF-8 come back as they were.
    return text.decode("utf-8", "surrogateescape")


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")
