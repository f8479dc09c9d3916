"""Toxicity by compression distance: dictionaries of toxic and of ordinary text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, stored, texts

# Every window stands in the same frame, which ends both dictionaries: the frame always matches
# and the bytes of the window alone make the difference.
_LEFT, _RIGHT = b"#0123456789abcdef", b"fedcba9876543210#"
_REMEMBERED = 500_000
# The bounded sample of labelled texts that the model is fitted on, and what it takes of a text.
TOXIC_TEXTS, ORDINARY_TEXTS, WINDOWS_PER_TEXT = 2_000, 6_000, 60
HARD_WINDOWS = 600
DICTIONARY_BYTES, TOXIC_WORDS = 8_192, 800
# A stem (how a word begins, of so many letters) is toxic text if it is that much likelier in the
# toxic sample and chance alone would hardly show so of any of the stems looked at.
STEM_LETTERS, STEM_RATIO = (1, 9), 20.0
_WHITE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Model:
    """Two raw dictionaries and a logistic function of what a text's windows say."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        # Both end in the ordinary text, so that other windows come out equally long.
        frame = _LEFT + _RIGHT
        return _compressor(self.ordinary + frame), _compressor(self.toxic + self.ordinary + frame)


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, score, predicted``.

    The whole text, in lower case, is cut into windows of one word. Each is compressed in a
    constant frame with either dictionary, and what the toxic one saves is counted in bytes. The
    score is a logistic function of the largest saving, the mean one and the share of windows
    that save anything. Null and empty texts have no windows and get the score of
    texts without any saving. No documents give no rows; ``text`` is the only input.
    """

    def rows(batch: pa.RecordBatch) -> dict:
        pair, known = model.compressors(), {}
        found = np.array([features(savings(t, pair, known)) for t in batch.column("text").to_pylist()])
        score = _logistic(found, np.array(model.weights))
        return {
            "doc_id": batch.column("doc_id"),
            "score": pa.array(score, pa.float64()),
            "predicted": pa.array((score >= 0.5).astype(np.int32)),
        }

    ids = documents.withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_batches(texts(ids, "doc_id"), "doc_id long, score double, predicted int", rows)


def without_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted to be toxic, all columns. Equal ids go together."""
    toxic = scored(documents, model).where("predicted = 1").select("doc_id").distinct()
    same = documents.doc_id.cast("long").eqNullSafe(toxic.doc_id)
    return documents.join(toxic, same, "left_anti").select(*documents.columns)


def held_out(doc_id: str = "doc_id"):
    """Whether a row is kept from training: ``crc32`` of the id as text, modulo five, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Train on labelled documents that are not :func:`held_out`.

    At most ``TOXIC_TEXTS`` and ``ORDINARY_TEXTS`` different texts, chosen by a hash of the text,
    are looked at; the driver gets windows, word counts and features of those only.
    Ids or labels that are null are skipped. Without toxic texts every score is 0, without
    ordinary ones 1.

    The toxic dictionary holds the words of toxic texts whose stems ordinary text hardly has,
    most frequent last. The ordinary one is trained on windows of ordinary texts, and the
    ordinary windows that the toxic one still compresses better are added to it.
    """
    sample, totals = _sample(documents, labels)
    if not totals.get(1) or not totals.get(0):
        return Model(b"", b"", (30.0 if totals.get(1) else -30.0, 0.0, 0.0, 0.0))
    toxic = _toxic_words(sample)
    windows = [r.window for r in _windows(sample.where("toxic = 0"), WINDOWS_PER_TEXT).toLocalIterator()]
    ordinary = _dictionary(windows)
    model = Model(toxic, ordinary, (0.0,) * 4)
    hard = _windows(sample.where("toxic = 0"), None, model).distinct().orderBy(F.xxhash64("window"), "window")
    model = Model(toxic, b"".join(r.window for r in hard.limit(HARD_WINDOWS).collect()) + ordinary, (0.0,) * 4)
    rows = _sampled_features(sample, model).collect()
    return Model(model.toxic, model.ordinary, _fitted(rows, totals))


def cut_windows(text: bytes) -> list[bytes]:
    """The words of a text in lower case, each with a space on either side."""
    return [b" " + w + b" " for w in text.decode("utf-8", "replace").lower().encode().split()]


def savings(text: bytes, pair, known: dict[bytes, int]) -> np.ndarray:
    """Bytes that the toxic dictionary saves, for each window; ``known`` are earlier ones."""
    found = cut_windows(text)
    ordinary, toxic = (c.compress for c in pair)
    if len(known) > _REMEMBERED:
        known.clear()
    for w in found:
        if w not in known:
            framed = _LEFT + w + _RIGHT
            known[w] = len(ordinary(framed)) - len(toxic(framed))
    return np.fromiter(map(known.__getitem__, found), np.int64, len(found))


def features(saved: np.ndarray) -> tuple[float, float, float]:
    if not len(saved):
        return 0.0, 0.0, 0.0
    return float(saved.max()), float(saved.mean()), float((saved >= 1).mean())


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=17, chain_log=17, search_log=6, min_match=4, target_length=16,
        strategy=zstandard.STRATEGY_LAZY2,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    if len(content) < 8:
        return zstandard.ZstdCompressor(compression_params=parameters)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


def _dictionary(windows: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, windows, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        # Too little text to train on: the text itself.
        return b"".join(windows)[-DICTIONARY_BYTES:]


def _sample(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """``toxic, text`` of the sampled texts, and how many different texts either label has."""
    known = (
        labels.where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where(~held_out())
    )
    rows = documents.select("doc_id", "text").where("doc_id is not null and text is not null")
    hashed = rows.select("doc_id", F.xxhash64("text").alias("hash"))
    different = stored(
        hashed.join(known, "doc_id").groupBy("hash", "toxic").agg(F.min("doc_id").alias("doc_id"))
    )
    totals = {r.toxic: r["count"] for r in different.groupBy("toxic").count().collect()}
    chosen = [
        different.where(F.col("toxic") == label).orderBy("hash", "doc_id").limit(n)
        for label, n in ((1, TOXIC_TEXTS), (0, ORDINARY_TEXTS))
    ]
    # Bounded by the two limits.
    few = F.broadcast(chosen[0].union(chosen[1]))
    same = (rows.doc_id == few.doc_id) & (F.xxhash64("text") == few.hash)
    return stored(rows.join(few, same).select("toxic", "text")), totals


def _toxic_words(sample: DataFrame) -> bytes:
    words = F.array_distinct(F.split(F.lower("text"), _WHITE))
    each = sample.select("toxic", F.explode(words).alias("word")).where("word != ''")
    counts = each.groupBy("word").agg(F.count(F.when(F.col("toxic") == 1, 1)).alias("n"))
    stems = sample.select("toxic", F.explode(F.array_distinct(F.flatten(F.transform(words, _stems)))).alias("stem"))
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    kinds = stored(
        stems.groupBy("stem").agg(*(F.count(F.when(F.col("toxic") == k, 1)).alias(f"n{k}") for k in (0, 1)))
    )
    likelier = ((F.col("n1") + 0.5) / (n[1] + 1)) / ((F.col("n0") + 0.5) / (n[0] + 1))
    chance = 2 * float(np.log(max(1, kinds.count())))
    toxic = kinds.where((_evidence(n[1], n[0]) >= chance) & (likelier >= STEM_RATIO)).select("stem")
    best = (
        counts.where("n > 0")
        .select("word", "n", F.explode(_stems(F.col("word"))).alias("stem"))
        .join(toxic, "stem")
        .groupBy("word")
        .agg(F.max("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(TOXIC_WORDS)
        .collect()
    )
    return (" " + " ".join(r.word for r in reversed(best)) + " ").encode() if best else b""


def _evidence(toxic: int, ordinary: int):
    """The log likelihood ratio (G) of ``n1`` of the toxic and ``n0`` of the ordinary texts."""
    total, both, g = toxic + ordinary, F.col("n1") + F.col("n0"), F.lit(0.0)
    for n, column in ((toxic, "n1"), (ordinary, "n0")):
        for seen, share in ((F.col(column), both / total), (n - F.col(column), 1 - both / total)):
            g += F.when(seen > 0, 2 * seen * F.log(seen / (n * share))).otherwise(0.0)
    return g


def _stems(word):
    few, many = STEM_LETTERS
    lengths = F.filter(F.sequence(F.lit(few), F.lit(many)), lambda n: n <= F.length(word))
    return F.transform(lengths, lambda n: F.substring(word, F.lit(1), n))


def _windows(sample: DataFrame, most: int | None, model: Model | None = None) -> DataFrame:
    """Windows of the sampled texts: ``most`` of each, evenly spaced, or all that ``model`` gets wrong."""

    def run(batches):
        pair, known = model.compressors() if model else None, {}
        for batch in batches:
            out: list[bytes] = []
            for text in batch.column("text").to_pylist():
                found = cut_windows(text)
                if pair:
                    out += [w for w, s in zip(found, savings(text, pair, known)) if s >= 1]
                else:
                    out += found[:: max(1, -(-len(found) // most))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["window"])

    return texts(sample).mapInArrow(run, "window binary")


def _sampled_features(sample: DataFrame, model: Model) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> dict:
        pair, known = model.compressors(), {}
        found = np.array([features(savings(t, pair, known)) for t in batch.column("text").to_pylist()])
        return {"toxic": batch.column("toxic")} | {f"f{i}": pa.array(found[:, i]) for i in range(3)}

    return map_batches(texts(sample, "toxic"), "toxic int, f0 double, f1 double, f2 double", rows)


def _logistic(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + found @ weights[1:], -500, 500)))


def _fitted(rows, totals: dict[int, int]) -> tuple[float, ...]:
    """Logistic regression by Newton's method; either label counts as often as it really occurs."""
    rows = sorted(tuple(r) for r in rows)
    x = np.array([[1.0, *r[1:]] for r in rows])
    y = np.array([float(r[0]) for r in rows])
    counts = {k: max(1, int((y == k).sum())) for k in (0, 1)}
    weight = np.where(y == 1, totals[1] / counts[1], totals[0] / counts[0])
    penalty = np.diag([1e-6, 0.1, 0.1, 0.1])
    w = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty @ w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(bend, slope)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)
