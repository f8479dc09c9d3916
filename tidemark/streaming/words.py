"""Running word counts on a stream, one change a word."""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.functions.text import has_words, joined_words
from tidemark.operators.words import numbered_words
from tidemark.streaming.pieces import LANES, Apply, Fold

LINES_PER_PIECE = 10_000
BUCKETS = 64
CHUNKS = 128


def word_running_count_stream(
    lines: DataFrame,
    line: str,
    text_col: str = "text",
    lines_per_piece: int = LINES_PER_PIECE,
    buckets: int = BUCKETS,
) -> DataFrame:
    """A row per word of the stream: ``line``, ``pos``, ``word`` and ``cnt``, the word's count so far.

    Words are taken in the order of the micro-batches, in each by ``line``, a whole number, and
    position. Where batches hold consecutive lines this is `word_running_count`. Write it in
    append mode, started inside `keyed_processors` and outside `strict_lateness`. Words without
    line are left out. The number of ``buckets`` must stay the same when a stream is restarted.

    The lines of a batch are cut into pieces of ``lines_per_piece`` consecutive ones and go
    through all steps as whole lines, a frequent word being counted by many tasks. The different
    words of a piece and how many there are of each are dealt to buckets by hash. One step carries
    on how often a word was met before each piece: the words of a bucket as one row a piece, and a
    count per word as state, of which a batch touches those near its own words. The words of a
    piece are counted from that.
    """
    rows = lines.where(F.col(line).isNotNull() & has_words(F.col(text_col))).select(
        F.expr(f"(`{line}` - pmod(`{line}`, {lines_per_piece}L)) div {lines_per_piece}L").alias("piece"),
        F.col(line).cast("long").alias("line"),
        joined_words(F.col(text_col)).alias("words"),
    )
    schema = "bucket int, piece bigint, lane int, line bigint, words string, counts array<bigint>"
    met = rows.groupBy("piece").transformWithStateInPandas(
        Fold(["piece"], ["line", "words"], partial(_met, buckets), None), schema, "append", "None"
    )
    carried = met.groupBy("bucket", "lane").transformWithStateInPandas(_Counts(buckets), schema, "append", "None")
    counted = carried.groupBy("piece").transformWithStateInPandas(
        Apply(_counted), "line bigint, words string, counts array<bigint>", "append", "None"
    )
    each = counted.select("line", F.posexplode(F.arrays_zip(F.split("words", " "), "counts")).alias("pos", "found"))
    line_value = F.col("line").cast(lines.schema[line].dataType).alias(line)
    return each.select(line_value, "pos", F.col("found")["0"].alias("word"), F.col("found.counts").alias("cnt"))


def _met(buckets: int, piece: int, line: np.ndarray, words: np.ndarray) -> pd.DataFrame:
    """The lines of a piece, in lane 1 + n; how many there are of its words, in lane 0."""
    counted = pc.split_pattern(pa.array(words, pa.string()), " ").flatten().value_counts()
    different, n = counted.field("values"), counted.field("counts").to_numpy()
    bucket = np.array([zlib.crc32(w.encode()) % buckets for w in different.to_pylist()])
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    used = [(b, order[i:j]) for b, (i, j) in enumerate(zip([0, *ends], ends)) if i < j]
    totals = pd.DataFrame(
        {
            "bucket": [b for b, _ in used],
            "lane": 0,
            "line": 0,
            "words": [" ".join(different.take(pa.array(at)).to_pylist()) for _, at in used],
            "counts": [n[at] for _, at in used],
        }
    )
    lines = pd.DataFrame({"bucket": 0, "lane": 1 + piece % LANES, "line": line, "words": words, "counts": None})
    return pd.concat([lines, totals], ignore_index=True)


class _Counts(StatefulProcessor):
    """Replaces how often a piece has a word by how often it came before.

    The counts of a bucket are kept in chunks of words, again by hash: reading and writing one
    costs about the same for a few words as for a single one.
    """

    def __init__(self, buckets: int):
        self.buckets = buckets

    def init(self, handle) -> None:
        self.counts = handle.getMapState("counts", "chunk int", "words array<string>, counts array<bigint>")

    def handleInputRows(self, key, rows, timerValues):
        if key[-1] != 0:
            yield from rows
            return
        found = pd.concat(list(rows)).sort_values("piece", ignore_index=True)
        lists = pc.split_pattern(pa.array(found["words"], pa.large_string()), " ")
        encoded = lists.flatten().dictionary_encode()
        n, code = np.concatenate(found["counts"].to_list()), encoded.indices.to_numpy()
        # Word by word, piece after piece.
        order = np.argsort(code, kind="stable")
        ends = np.cumsum(n[order])
        last = np.cumsum(np.bincount(code)) - 1
        totals = np.diff(ends[last], prepend=0)
        known = self._raised(encoded.dictionary.to_pylist(), totals)
        before = np.empty(len(code), np.int64)
        before[order] = ends - n[order] + np.repeat(known - (ends[last] - totals), np.diff(last, prepend=-1))
        cuts = np.cumsum(lists.value_lengths().to_numpy())[:-1]
        yield found.assign(counts=np.split(before, cuts))

    def _raised(self, words: list[str], totals: np.ndarray) -> np.ndarray:
        """What was known of each word, whose count is raised by its total."""
        known = np.zeros(len(words), np.int64)
        by_chunk: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_chunk.setdefault(zlib.crc32(word.encode()) // self.buckets % CHUNKS, []).append(i)
        for chunk, members in by_chunk.items():
            before = self.counts.getValue((chunk,))
            held = dict(zip(*before)) if before else {}
            for i in members:
                known[i] = held.get(words[i], 0)
                held[words[i]] = int(known[i] + totals[i])
            self.counts.updateValue((chunk,), (list(held), list(held.values())))
        return known

    def close(self) -> None:
        pass


def _counted(rows: pd.DataFrame) -> pd.DataFrame:
    """The lines of a piece with the count of each word."""
    totals = rows["lane"] == 0
    met = pc.split_pattern(pa.array(rows["words"][totals], pa.string()), " ").flatten()
    before = np.concatenate([np.zeros(0, np.int64), *rows["counts"][totals]])
    lines = rows[~totals].sort_values("line", ignore_index=True)
    found, counts = numbered_words(pa.array(lines["words"], pa.string()), lines["line"].to_numpy(), met, before)
    cuts = np.cumsum(found.value_lengths().to_numpy())[:-1]
    return lines[["line", "words"]].assign(counts=np.split(counts, cuts))
