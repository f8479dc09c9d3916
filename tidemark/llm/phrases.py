"""Document fingerprints from Lempel-Ziv phrases."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, texts

MINIMA = 64
_EMPTY = np.full(MINIMA, 0xFFFFFFFF, np.uint32)


def fingerprints(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, fingerprint``.

    A fingerprint is the hexadecimal form of ``MINIMA`` minimum hashes of the set of phrases into
    which the whole text falls: Lempel-Ziv parsing takes the longest phrase met before and one
    more character. :func:`likeness` of two fingerprints estimates which share of their phrases
    two texts have in common, as one would compress with the other's dictionary. Equal texts
    have equal fingerprints; null and empty ones have no phrases and a fingerprint of their own.
    No documents give no rows; ids may be null or repeat, other columns are ignored.
    """

    def rows(batch: pa.RecordBatch) -> dict:
        found = [fingerprint(Parser().read(t.decode())) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "fingerprint": pa.array(found, pa.string())}

    ids = documents.withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_batches(texts(ids, "doc_id"), "doc_id long, fingerprint string", rows)


class Parser:
    """Phrases of a text that is read piece by piece."""

    def __init__(self, phrases: set[str] | None = None, open_phrase: str = ""):
        self.phrases, self.open = phrases or set(), open_phrase

    def read(self, text: str) -> Parser:
        known, add, phrase = self.phrases, self.phrases.add, self.open
        for character in text:
            phrase += character
            if phrase not in known:
                add(phrase)
                phrase = ""
        self.open = phrase
        return self

    def fork(self) -> Parser:
        return Parser(set(self.phrases), self.open)

    def hashes(self) -> np.ndarray:
        # What is open at the end is a phrase met before.
        encoded = [p.encode("utf-8", "surrogatepass") for p in self.phrases]
        return np.fromiter(map(xxhash.xxh3_64_intdigest, encoded), np.uint64, len(encoded))


def minima(hashes: np.ndarray) -> np.ndarray:
    """One minimum for each of ``MINIMA`` parts of the hashes.

    A part without hashes borrows from the next one that has some, so that small sets of equal
    phrases still agree everywhere.
    """
    part = (hashes >> np.uint64(58)).astype(np.int64)
    value = ((hashes >> np.uint64(16)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out = _EMPTY.copy()
    np.minimum.at(out, part, value)
    filled = np.flatnonzero(np.bincount(part, minlength=MINIMA)) if len(part) else []
    if len(filled):
        nearest = filled[np.searchsorted(filled, np.arange(MINIMA)) % len(filled)]
        gap = ((nearest - np.arange(MINIMA)) % MINIMA).astype(np.uint32)
        out = out[nearest] + gap * np.uint32(0x9E3779B1)
    return out


def fingerprint(parsed: Parser) -> str:
    return minima(parsed.hashes()).astype(">u4").tobytes().hex()


def likeness(x: str, y: str) -> float:
    """Share of equal minima of two fingerprints, 0 to 1."""
    a, b = (np.frombuffer(bytes.fromhex(f), ">u4") for f in (x, y))
    return float((a == b).mean())


def edited_fingerprints(documents: DataFrame, parts: int) -> DataFrame:
    """Fingerprints of texts, of edited ones and of their neighbours.

    The next document has the next smaller ``doc_id``, after the smallest the largest. The
    edited text has the first as many characters of it (or all, if it is shorter) in place of
    its own last ``floor(n_chars / 3)``. Rows without id come after all others; rows that
    share an id are ordered by their text.

    Texts are dealt once, into ``parts`` ranges of ids; the first row of each range is sent to
    the range before it, too. Which rows those are is one small row per range.
    """
    ids = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    # Descending ids, nulls last, as ascending ranks of one column without nulls.
    ranked = ids.withColumn("_null", F.col("doc_id").isNull())
    shares = [i / parts for i in range(1, parts)]
    quantiles = F.percentile_approx("doc_id", shares, max(10_000, 20 * parts)) if shares else F.lit(None)
    low = sorted(set(ids.agg(quantiles).first()[0] or []))
    bounds = F.array(*map(F.lit, low)) if low else F.array().cast("array<bigint>")
    # Range 0 has the largest ids; nulls come last.
    part = F.when(F.col("_null"), F.lit(len(low))).otherwise(
        F.size(F.filter(bounds, lambda b: b > F.col("doc_id")))
    )
    dealt = ranked.withColumn("_part", part)
    first = dealt.groupBy("_part").agg(
        F.max("doc_id").alias("top"), F.max(F.col("_null").cast("int")).alias("null_top")
    )
    tops = sorted((r._part, r.top, r.null_top) for r in first.collect())
    if not tops:
        return _neighbours(dealt.withColumn("_ghost", F.lit(False)))
    # The range before each one, and before the first the last, gets its first row as well.
    before = {part: tops[i - 1][0] for i, (part, _, _) in enumerate(tops)}
    to = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    starts = F.create_map(*(F.lit(x) for p, top, _ in tops for x in (p, top if top is not None else -1)))
    is_first = F.when(starts[F.col("_part")] == F.col("doc_id"), True).otherwise(
        F.col("_null") & F.lit(tops[-1][1] is None)
    )
    both = F.when(
        is_first,
        F.array(F.struct(F.col("_part").alias("p"), F.lit(False).alias("g")), F.struct(to[F.col("_part")].alias("p"), F.lit(True).alias("g"))),
    ).otherwise(F.array(F.struct(F.col("_part").alias("p"), F.lit(False).alias("g"))))
    copies = dealt.withColumn("_copy", F.explode(both)).select(
        "doc_id", "text", "_null", F.col("_copy.p").alias("_part"), F.col("_copy.g").alias("_ghost")
    )
    return _neighbours(copies.repartition(parts, "_part"))


def _neighbours(rows: DataFrame) -> DataFrame:
    # Ghosts stand after a range's own rows; only the first of them is looked at.
    ordered = rows.sortWithinPartitions(
        "_part", "_ghost", "_null", F.desc("doc_id"), "text"
    ).select("_part", "_ghost", "doc_id", F.col("text").cast("binary").alias("text"))
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        held = None
        for batch in batches:
            out = []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for part, ghost, doc_id, data in zip(*columns):
                if held and held[0] == part and held[1]:
                    continue
                now = (part, ghost, doc_id, data.decode(), *_read(data.decode()))
                if held and held[0] == part:
                    out.append(_row(held, now))
                held = now
            if out:
                kinds = (pa.int64(), pa.int64(), *(pa.string(),) * 3, pa.float64(), pa.float64())
                columns = [pa.array(v, k) for v, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return ordered.mapInArrow(run, schema)


def _read(text: str) -> tuple[Parser, str]:
    """The parser where the edited text leaves the text, and the text's fingerprint."""
    kept = Parser().read(text[: len(text) - len(text) // 3])
    return kept, fingerprint(kept.fork().read(text[len(text) - len(text) // 3 :]))


def _row(own, following) -> tuple:
    _, _, doc_id, text, kept, mark = own
    n = len(text) // 3
    tail = following[3][:n]
    edited = text[: len(text) - n] + tail
    other = fingerprint(kept.read(tail))
    digest = hashlib.sha256(edited.encode()).hexdigest()
    return doc_id, len(text), digest, mark, other, likeness(mark, other), likeness(mark, following[5])
