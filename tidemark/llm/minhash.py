"""Near-duplicate groups: MinHash bands, signatures, full sets, connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hash_words, map_batches, mixed, shingles, stored, texts, words
from tidemark.llm.components import components

WORDS = 5
SIMILARITY = 0.75
# A pair at the threshold shares no band with probability (1 - 0.75^6)^60, under 1e-5.
BANDS, ROWS = 60, 6
# Standard error of the estimate at 0.75 is 0.023: six and a half of them are left as a margin.
SIGNATURE_SIMILARITY = 0.6
_BLOCK = 256
# Which of so many parts of the hash space a set has shingles in bounds what it shares with others.
_PARTS = 1024
# Each round looks at so many times as many leaders of a bucket as the one before.
_LEADERS = 32

_RNG = np.random.default_rng(7)
_A = _RNG.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_BAND = _RNG.integers(1, 2**63, (BANDS, ROWS + 1), dtype=np.uint64)


def near_duplicates(
    documents: DataFrame, words_per_shingle: int = WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when the Jaccard similarity of their full shingle sets reaches
    ``similarity``; ``component_id`` is the smallest ``doc_id`` that links reach.

    Equal sets are one class from the start, named by its smallest id, so copies are never
    paired. Classes that share a band of minima form a bucket. Shingles that no other class of
    a bucket has bound the similarity of a class to any other, so classes and pairs that can't
    reach the threshold are left out without looking at them. In a first round each bucket
    proposes the member with the smallest share of such shingles against all others. In later
    rounds a bucket's leaders are its members outside its largest component where these are few
    enough, else members chosen by hash, more of them each round; they propose only pairs whose
    ends are still in different components, until no bucket has such a pair. Of these, pairs
    are left out where one set has shingles in too many parts of the hash space in which the
    other has none. Every pair of a bucket is therefore verified, out of reach or in one
    component, and a large group of near copies costs about one pair per member and band.
    Signatures first and then the full sets confirm each pair.

    A null or wordless text has an empty set and is linked with nothing. A row without id is
    linked with nothing either; its component is null and it is kept. Rows that share an id
    count as one document. No documents give no rows; other columns are ignored.
    """
    signed = stored(_signed(documents, words_per_shingle))
    with_words = signed.where("digest is not null and doc_id is not null")
    classes = with_words.groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    own = [signed.digest == classes.digest, signed.doc_id == classes.class_id]
    chosen = signed.join(classes, own).select("class_id", "bands", "signature")

    banded = chosen.select("class_id", F.explode("bands").alias("bucket"))
    shared = (
        banded.groupBy("bucket")
        .agg(F.min("class_id").alias("first"), F.max("class_id").alias("last"))
        .where("first < last")
        .select("bucket")
    )
    members = stored(banded.join(shared, "bucket"))
    paired = members.select("class_id").distinct()
    signatures = stored(
        signed.join(paired, signed.doc_id == paired.class_id).select("class_id", "signature")
    )
    rows = documents.join(paired, documents.doc_id == paired.class_id, "left_semi")
    sets = stored(_sets(rows, words_per_shingle))

    bounds = stored(_bounds(sets, similarity))
    found = _linked(members, bounds, signatures, sets, similarity)
    named = classes.join(found, classes.class_id == found.node, "left").select(
        "digest", F.coalesce("component", "class_id").alias("component_id")
    )
    linked = with_words.join(named, "digest").select("doc_id", "n_shingles", "component_id")
    alone = signed.where("digest is null or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    same = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return linked.unionByName(alone).withColumn("kept", same)


def without_near_duplicates(documents: DataFrame, **settings) -> DataFrame:
    """The documents that :func:`near_duplicates` keeps, one id of each group, all columns."""
    copies = near_duplicates(documents, **settings).where("not kept").select("doc_id").distinct()
    return documents.join(copies, "doc_id", "left_anti").select(*documents.columns)


def minima(shingle_set: np.ndarray) -> np.ndarray:
    """Of each universal hash ``a * x + b mod 2^32``, the smallest value over the set."""
    x = (shingle_set >> np.uint64(32)).astype(np.uint32)
    lowest = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), _BLOCK):
        hashed = x[i : i + _BLOCK, None] * _A
        hashed += _B
        np.minimum(lowest, hashed.min(axis=0), out=lowest)
    return lowest


def band_keys(lowest: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of minima; the band's number is part of it."""
    rows = lowest.reshape(-1, BANDS, ROWS).astype(np.uint64)
    return mixed((rows * _BAND[:, :ROWS]).sum(axis=2, dtype=np.uint64) + _BAND[:, ROWS])


def _signed(documents: DataFrame, size: int) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> dict:
        counts, digests, lows = [], [], []
        for text in batch.column("text").to_pylist():
            found = shingles(hash_words(words(text)), size)
            counts.append(len(found))
            digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            lows.append(minima(found))
        lowest = np.stack(lows)
        keys = band_keys(lowest).view(np.int64)
        # One byte of each minimum is enough to tell equal minima from different ones.
        parts = ((lowest * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
        empty = np.array([d is None for d in digests])
        return {
            "doc_id": batch.column("doc_id"),
            "n_shingles": pa.array(counts, pa.int64()),
            "digest": pa.array(digests, pa.binary()),
            "bands": pa.ListArray.from_arrays(
                pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel())
            ),
            "signature": pa.array([p.tobytes() for p in parts], pa.binary(), mask=empty),
        }

    schema = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"
    return map_batches(_numbered(documents), schema, rows)


def _numbered(documents: DataFrame) -> DataFrame:
    return texts(documents.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")


def _sets(documents: DataFrame, size: int) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> dict:
        found = [shingles(hash_words(words(t)), size) for t in batch.column("text").to_pylist()]
        ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
        return {
            "class_id": batch.column("doc_id"),
            "shingles": pa.ListArray.from_arrays(
                pa.array(ends), pa.array(np.concatenate(found).view(np.int64))
            ),
            "parts": pa.array([occupied(f) for f in found], pa.list_(pa.int64())),
        }

    return map_batches(_numbered(documents), "class_id long, shingles array<long>, parts array<long>", rows)


def occupied(shingle_set: np.ndarray) -> np.ndarray:
    """A bit for each part of the hash space that has a shingle of the set."""
    bits = np.zeros(_PARTS, np.uint8)
    bits[(shingle_set % np.uint64(_PARTS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _bounds(sets: DataFrame, similarity: float) -> DataFrame:
    """``class_id, size, total, common, lone, parts`` of classes that another can be similar to.

    ``common`` counts the shingles that other classes have, too, and bounds every
    intersection; ``lone`` is the share of the rest. Rows that share an id may have several
    sets: ``total`` and ``parts`` hold for all of them, ``size`` is that of the smallest.
    """
    owners = (
        sets.select("class_id", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("class_id").alias("class_id"), F.max("class_id").alias("last"))
    )
    lone = owners.where("class_id = last").groupBy("class_id").agg(F.count("*").alias("n"))
    each_part = [F.bit_or(F.col("parts")[i]) for i in range(_PARTS // 64)]
    sizes = sets.groupBy("class_id").agg(
        F.min(F.size("shingles")).alias("size"),
        F.sum(F.size("shingles")).alias("total"),
        F.array(*each_part).alias("parts"),
    )
    bounds = sizes.join(lone, "class_id", "left").select(
        "class_id",
        F.col("size").cast("long").alias("size"),
        "total",
        (F.col("total") - F.coalesce("n", F.lit(0))).alias("common"),
        (F.coalesce("n", F.lit(0)) / F.col("total")).alias("lone"),
        "parts",
    )
    return bounds.where(F.col("common") * 100 >= F.col("size") * round(similarity * 100))


def _linked(members, bounds, signatures, sets, similarity: float) -> DataFrame:
    """``(node, component)`` of the classes that verified pairs connect."""
    percent = round(similarity * 100)

    def reach(shared: str) -> Column:
        return F.expr(f"{100 + percent} * ({shared}) >= {percent} * (a.size + b.size)")

    def outside(one: str, other: str) -> str:
        counts = (f"bit_count({one}.parts[{i}] & ~{other}.parts[{i}])" for i in range(_PARTS // 64))
        return f"{one}.total - ({' + '.join(counts)})"

    possible = reach("least(a.common, b.common)")
    near = reach(f"least({outside('a', 'b')}, {outside('b', 'a')})")
    numbers = bounds.select("class_id", "size", "common", "lone")
    members = stored(members.join(numbers, "class_id"))
    leader = F.min(F.struct("lone", "class_id", "size", "common")).alias("first")
    firsts = members.groupBy("bucket").agg(leader).select("bucket", "first.*")
    first = [F.col("a.bucket") == F.col("b.bucket"), F.col("a.class_id") != F.col("b.class_id"), possible]
    pairs = _ordered(firsts.alias("a").join(members.alias("b"), first))
    found = components(_verified(pairs, signatures, sets, similarity))
    led, leaders = firsts.select("bucket", "class_id"), 1
    active = members
    while True:
        active = active.join(led, ["bucket", "class_id"], "left_anti").select(members.columns)
        active = stored(_undecided(active, found))
        if active.isEmpty():
            return found
        leaders *= _LEADERS
        share = F.pmod(F.xxhash64("bucket", "class_id"), F.lit(1 << 20)) / float(1 << 20)
        few = F.col("n_others") <= leaders
        leads = (few & (F.col("component") != F.col("largest"))) | (~few & (share < F.lit(leaders) / F.col("n_members")))
        shown = active.join(bounds.select("class_id", "total", "parts"), "class_id")
        apart = [F.col("a.bucket") == F.col("b.bucket"), F.col("a.component") != F.col("b.component"), possible, near]
        pairs = _ordered(shown.where(leads).alias("a").join(shown.alias("b"), apart))
        links = _verified(pairs, signatures, sets, similarity)
        if not links.isEmpty():
            stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
            found = components(stars.union(links))
        led = active.where(leads).select("bucket", "class_id")


def _ordered(pairs: DataFrame) -> DataFrame:
    ends = [F.col("a.class_id"), F.col("b.class_id")]
    return pairs.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()


def _undecided(members: DataFrame, found: DataFrame) -> DataFrame:
    """The buckets whose members are in several components, with the component, the largest one of
    the bucket, the number of members and of those outside the largest."""
    at = members.join(found, members.class_id == found.node, "left").select(
        *members.columns, F.coalesce("component", "class_id").alias("component")
    )
    most = F.max(F.struct("n", "component")).alias("most")
    mixed_buckets = (
        at.groupBy("bucket", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("bucket")
        .agg(F.sum("n").alias("n_members"), most)
        .select("bucket", "n_members", (F.col("n_members") - F.col("most.n")).alias("n_others"), F.col("most.component").alias("largest"))
        .where("n_others > 0")
    )
    return at.join(mixed_buckets, "bucket")


def _verified(pairs: DataFrame, signatures: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose signatures and then full sets are similar enough."""
    likely = stored(_with(pairs, signatures, "signature").mapInArrow(_similar_signatures, "a long, b long"))
    return stored(_with(likely, sets, "shingles").mapInArrow(_similar_sets(similarity), "a long, b long"))


def _with(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    for end in ("a", "b"):
        side = table.select(F.col("class_id").alias(end), F.col(column).alias(f"{column}_{end}"))
        pairs = pairs.join(side, end)
    return pairs.select("a", "b", f"{column}_a", f"{column}_b")


def _similar_signatures(batches):
    for batch in batches:
        left, right = (
            np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
            for k in (2, 3)
        )
        near = (left == right).mean(axis=1) >= SIGNATURE_SIMILARITY
        yield batch.select([0, 1]).filter(pa.array(near))


def _similar_sets(similarity: float):
    percent = round(similarity * 100)

    def run(batches):
        for batch in batches:
            near = []
            for left, right in zip(_lists(batch.column(2)), _lists(batch.column(3))):
                both = np.intersect1d(left, right, assume_unique=True).size
                near.append(100 * both >= percent * (left.size + right.size - both))
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    return run


def _lists(column: pa.ListArray):
    values = column.values.to_numpy(zero_copy_only=False)
    ends = column.offsets.to_numpy()
    return (values[i:j] for i, j in zip(ends[:-1], ends[1:]))
