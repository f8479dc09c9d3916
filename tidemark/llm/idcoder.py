"""Token ids in files: an adaptive context-mixing range coder over independent blocks."""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import texts

BLOCK_IDS = 2048
SEGMENT_IDS = 2_000_000
# Contexts of each order in a block, hashed into so many rows.
_ROWS = (1024, 1024, 1024)
# Sixteen times this and sixteen more is what mixed shares add up to: it fits into 16 bits.
_TOTAL = 4080
_REMEMBERED = 300_000
SEGMENT_SCHEMA = (
    "part int, segment int, n_ids long, doc_ids array<long>, sizes array<long>,"
    " digits int, lengths array<int>, blocks array<binary>, checksums array<long>"
)

# How far a row moves towards what it has just seen, by how often it was seen before.
_RATE = np.array([1, 2, 2, 3, 3, 3, 4, 4, 4, 4, 4, 4, 4, 4, 4, 5], np.int16)
# Sixteenths that the orders 2 and 1 get by how often their rows were seen; order 0 has the rest.
_TRUST_2 = np.array([0, 6, 8, 9, 10, 10, 11, 11, 11, 11, 11, 12, 12, 12, 12, 12], np.int16)
_TRUST_1 = np.array([0, 4, 6, 7, 8, 9, 9, 10, 10, 10, 10, 11, 11, 11, 11, 11], np.int16)
_SEEN = np.array([[_TOTAL if j > s else 0 for j in range(16)] for s in range(16)], np.int16)
_PLACE = np.arange(16, dtype=np.int16)
_LOW32 = np.uint64(0xFFFFFFFF)


def write_ids(documents: DataFrame, tokenizer_path: str, end_id: int, path: str) -> None:
    """Encode whole texts and write their ids, each followed by ``end_id``, below ``path``.

    Documents are in ascending order of ``doc_id`` (nulls first, equal ids by text): files and
    segments of about ``SEGMENT_IDS`` ids in a file follow each other, documents do not reach
    over segments. A segment is a Parquet row with its documents and its blocks of ``BLOCK_IDS``
    ids. Every block is coded from a fresh model and has a checksum, so that it can be read
    alone and a damaged one is noticed. Ids are those of the ``tokenizers`` library without
    added special tokens. Null texts are empty: the end id alone. No documents give no rows.
    """
    ids = documents.withColumn("doc_id", F.col("doc_id").cast("long"))
    ordered = texts(ids, "doc_id").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        part, segment = TaskContext.get().partitionId(), 0
        tokenizer, known = _tokenizer(tokenizer_path), {}
        end = np.array([end_id], "<u4").tobytes()
        doc_ids, found, total = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                doc_ids.append(doc_id)
                found.append(token_bytes(text.decode(), tokenizer, known) + end)
                total += len(found[-1]) // 4
                if total >= SEGMENT_IDS:
                    yield _segment(part, segment, doc_ids, found)
                    doc_ids, found, total, segment = [], [], 0, segment + 1
        if doc_ids:
            yield _segment(part, segment, doc_ids, found)

    ordered.mapInArrow(run, SEGMENT_SCHEMA).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document that :func:`write_ids` has written.

    ``start`` counts the ids of all documents before it. A block whose checksum differs is an error.
    """
    return _read(spark, path, "ids array<int>", lambda data: np.frombuffer(data, np.int32))


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: as :func:`read_ids`, with a CRC-32 of the ids
    as little-endian 32-bit integers in their place."""
    return _read(spark, path, "ids_crc32 long", zlib.crc32)


def _read(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    # One row for each file, and then sums inside of it.
    files = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
    inner = W.partitionBy("part").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    starts = segments.select(
        "part", "segment", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)).alias("inner_start")
    ).join(files, "part")
    placed = segments.join(starts, ["part", "segment"]).select(
        (F.col("file_start") + F.col("inner_start")).alias("start"),
        "doc_ids", "sizes", "digits", "lengths", "blocks", "checksums",
    )
    name, kind = column.split(" ", 1)
    kinds = {"long": pa.int64(), "array<int>": pa.list_(pa.int32())}

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                blocks = decode_blocks(row["blocks"], np.array(row["lengths"]), row["digits"])
                for block, checksum in zip(blocks, row["checksums"]):
                    if zlib.crc32(block.tobytes()) != checksum:
                        raise ValueError("a block of token ids is damaged")
                data = b"".join(b.tobytes() for b in blocks)
                sizes = np.array(row["sizes"])
                ends = np.cumsum(sizes)
                found = [value(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["start"] + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(found, kinds[kind]),
                    ],
                    names=["doc_id", "start", "n_tokens", name],
                )

    return placed.mapInArrow(run, f"doc_id long, start long, n_tokens long, {column}")


def token_bytes(text: str, tokenizer, known: dict[str, bytes]) -> bytes:
    """The ids of a text as little-endian 32-bit integers; ``known`` are earlier words.

    A byte-level pre-tokenizer cuts in front of a single space between two characters that are
    not white space, so the parts between such spaces are encoded on their own.
    """
    if len(known) > _REMEMBERED:
        known.clear()
    parts = text.split(" ") if not _WIDE.search(text) else None
    if parts is None:
        found = _CUT.split(text)
    else:
        found = [parts[0], *(" " + p for p in parts[1:])] if text else []
    new = list({w for w in found if w not in known})
    if new:
        encoded = tokenizer.encode_batch_fast(new, add_special_tokens=False)
        known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(new, encoded))
    return b"".join(map(known.__getitem__, found))


_WIDE = re.compile(r"^\s|\s$|\s\s")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def encode_blocks(ids: np.ndarray, lengths: np.ndarray, digits: int) -> list[bytes]:
    """Code the consecutive blocks of ``ids``, all of them step by step side by side."""
    coder = _Lanes(len(lengths), digits)
    starts = np.cumsum(lengths) - lengths
    low, wide = np.zeros(len(lengths), np.uint64), np.full(len(lengths), 2**64 - 1, np.uint64)
    owners, emitted = [], []
    for step in range(int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > step)
        coder.begin(live, step)
        now = ids[starts[live] + step].astype(np.int64)
        for digit in range(digits):
            symbol = (now >> 4 * (digits - 1 - digit)) & 15
            mixed, total = coder.predict(digit)
            below, above = _share(mixed, symbol, total)
            unit = wide[live] // np.uint64(total)
            low[live] += unit * below
            wide[live] = unit * (above - below)
            coder.learn(symbol)
            _narrow(low, wide, live, owners, emitted)
        coder.end(now)
    for shift in (32, 0):
        owners.append(np.arange(len(lengths)))
        emitted.append(((low >> np.uint64(shift)) & _LOW32).astype(np.uint32))
    owner, words = np.concatenate(owners), np.concatenate(emitted)
    order = np.argsort(owner, kind="stable")
    cuts = np.cumsum(np.bincount(owner, minlength=len(lengths))) * 4
    packed = words[order].astype("<u4").tobytes()
    return [packed[i:j] for i, j in zip([0, *cuts[:-1].tolist()], cuts.tolist())]


def decode_blocks(blocks: list[bytes], lengths: np.ndarray, digits: int) -> list[np.ndarray]:
    coder = _Lanes(len(lengths), digits)
    words = np.frombuffer(b"".join(blocks) + bytes(8), "<u4").astype(np.uint64)
    sizes = np.array([len(b) // 4 for b in blocks])
    place = np.cumsum(sizes) - sizes
    out = np.zeros(int(lengths.sum()), np.uint32)
    starts = np.cumsum(lengths) - lengths
    low, wide = np.zeros(len(lengths), np.uint64), np.full(len(lengths), 2**64 - 1, np.uint64)
    code = words[place] << np.uint64(32) | words[place + 1]
    place += 2
    for step in range(int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > step)
        coder.begin(live, step)
        now = np.zeros(len(live), np.int64)
        for digit in range(digits):
            mixed, total = coder.predict(digit)
            unit = wide[live] // np.uint64(total)
            asked = np.minimum((code[live] - low[live]) // unit, np.uint64(total - 1)).astype(np.uint16)
            symbol = (mixed <= asked[:, None]).sum(axis=1) - 1
            below, above = _share(mixed, symbol, total)
            low[live] += unit * below
            wide[live] = unit * (above - below)
            coder.learn(symbol)
            now = now << 4 | symbol
            moved = _narrow(low, wide, live, None, None)
            code[moved] = code[moved] << np.uint64(32) | words[np.minimum(place[moved], len(words) - 1)]
            place[moved] += 1
        coder.end(now)
        out[starts[live] + step] = now
    return np.split(out, np.cumsum(lengths)[:-1]) if len(lengths) else []


def _share(mixed: np.ndarray, symbol: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    flat, at = mixed.ravel(), np.arange(0, mixed.size, 16) + symbol
    below = flat.take(at).astype(np.uint64)
    above = flat.take(np.minimum(at + 1, mixed.size - 1)).astype(np.uint64)
    return below, np.where(symbol < 15, above, np.uint64(total))


def _narrow(low, wide, live, owners, emitted) -> np.ndarray:
    """Shift out 32 bits where the range has become narrow; returns the lanes that did.

    A range that spans a carry is cut at it, so that what is shifted out never changes.
    """
    lanes = live[wide[live] <= _LOW32]
    if len(lanes):
        at, span = low[lanes], wide[lanes]
        spans = (at >> np.uint64(32)) != ((at + span - np.uint64(1)) >> np.uint64(32))
        span = np.where(spans, (~at + np.uint64(1)) & _LOW32, span)
        if owners is not None:
            owners.append(lanes)
            emitted.append((at >> np.uint64(32)).astype(np.uint32))
        low[lanes], wide[lanes] = at << np.uint64(32), span << np.uint64(32)
    return lanes


class _Lanes:
    """Models of many blocks: for each order, rows of cumulative shares of sixteen digits."""

    def __init__(self, lanes: int, digits: int):
        self.digits = digits
        even = (np.arange(16) * (_TOTAL // 16)).astype(np.int16)
        self.rows = [np.tile(even, (lanes * n, 1)) for n in _ROWS]
        # The same rows as single values, which are quicker to put back.
        self.whole = [r.view("V32").ravel() for r in self.rows]
        self.seen = [np.zeros(lanes * n, np.uint8) for n in _ROWS]
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def begin(self, live: np.ndarray, step: int) -> None:
        self.live = live
        one = self.last[live] * 0x9E3779B1 + 1
        two = (one ^ (self.before[live] * 0x85EBCA77)) * 0xC2B2AE3D + 2
        self.context = (np.zeros(len(live), np.int64), one, two)
        self.prefix = np.ones(len(live), np.int64)

    def predict(self, digit: int) -> tuple[np.ndarray, int]:
        """The first digit's share, the first two's, ... of a mixture, and what all add up to."""
        self.at, rows, seen = [], [], []
        for order, n in enumerate(_ROWS):
            mix = (self.context[order] + self.prefix) * 0x2545F491
            row = self.live * n + (((mix ^ (mix >> 29)) * 0x165667B1 >> 13) & (n - 1))
            self.at.append(row)
            rows.append(self.rows[order].take(row, axis=0))
            seen.append(self.seen[order].take(row))
        two = _TRUST_2[seen[2]]
        one = ((16 - two) * _TRUST_1[seen[1]]) >> 4
        mixed = rows[0] * (16 - two - one)[:, None]
        mixed += rows[1] * one[:, None]
        mixed += rows[2] * two[:, None]
        # No digit is impossible.
        mixed += _PLACE
        self.now, self.counts = rows, seen
        return mixed.view(np.uint16), _TOTAL * 16 + 16

    def learn(self, symbol: np.ndarray) -> None:
        target = _SEEN.take(symbol, axis=0)
        for order, row in enumerate(self.at):
            now, count = self.now[order], self.counts[order]
            moved = target - now
            moved >>= _RATE.take(count)[:, None]
            moved += now
            self.whole[order][row] = moved.view("V32").ravel()
            self.seen[order][row] = np.minimum(count + 1, 15)
        self.prefix = self.prefix << 4 | symbol

    def end(self, ids: np.ndarray) -> None:
        self.before[self.live] = self.last[self.live]
        self.last[self.live] = ids + 1


def _segment(part: int, segment: int, doc_ids: list, found: list[bytes]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(found), "<u4")
    n = len(ids)
    lengths = np.full(-(-n // BLOCK_IDS), BLOCK_IDS, np.int64)
    lengths[-1] = n - BLOCK_IDS * (len(lengths) - 1)
    digits = max(1, -(-int(ids.max()).bit_length() // 4))
    blocks = encode_blocks(ids, lengths, digits)
    checksums = [zlib.crc32(ids[i : i + BLOCK_IDS].tobytes()) for i in range(0, n, BLOCK_IDS)]
    row = {
        "part": pa.array([part], pa.int32()),
        "segment": pa.array([segment], pa.int32()),
        "n_ids": pa.array([n], pa.int64()),
        "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
        "sizes": pa.array([[len(f) // 4 for f in found]], pa.list_(pa.int64())),
        "digits": pa.array([digits], pa.int32()),
        "lengths": pa.array([lengths.tolist()], pa.list_(pa.int32())),
        "blocks": pa.array([blocks], pa.list_(pa.binary())),
        "checksums": pa.array([checksums], pa.list_(pa.int64())),
    }
    return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))


def _tokenizer(path: str) -> tokenizers.Tokenizer:
    # Spark runs a task on each core already.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return tokenizers.Tokenizer.from_file(path)
