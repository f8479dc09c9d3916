"""Benchmark decontamination by CGK embedding, bit sampling and edit verification."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hash_words, map_batches, mixed, of_worker, stored, texts

EDITS = 0.2
SHORTEST_ITEM = 8
# Each table samples four coordinates of a walk. An exact leak meets its item in all tables. Walks
# drift apart with every edit, so that of longer items more walks are needed: so many a word.
LEAST_WALKS, WALKS_PER_WORD, TABLES_PER_WALK, SAMPLED = 8, 0.3, 8, 4
_CLASS_GROWTH = 1.1
# Bits of the two filters; their size does not follow the benchmark's.
_RUN_BITS, _KEY_BITS = 23, 23
_RUN = 3
_TOP_BIT = np.uint64(63)
_WORDS_AT_ONCE, _KEYS_AT_ONCE = 1_000_000, 1_600_000
_RUN_WEIGHTS = np.random.default_rng(3).integers(1, 2**63, _RUN, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PUNCTUATION = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def contaminated(documents: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """``doc_id, item_id, start, distance``: the benchmark items that documents contain.

    Words are runs of letters and digits in lower case. An item of ``n`` words is contained where
    a window of ``n`` consecutive words of the document (fewer at its end) is within
    ``floor(edits * n)`` word insertions, deletions and replacements of it. One row per document
    and item: the least distance and the first word at which a window found has it.

    Windows of an item's length start at every word. Within ``d`` edits of ``n`` words at least
    ``n - 2 - 3 * d`` runs of three words stay; windows with fewer that occur anywhere in the
    benchmark are passed over. The others are walked: the CGK embedding
    reads a word, appends it and moves on or stays by a random bit of step and word, so that few
    edits give few differing coordinates. Tables of sampled coordinates join windows with items,
    and the exact edit distance decides. Only two bitmaps of fixed size are sent to the tasks.

    Items of fewer than ``SHORTEST_ITEM`` words are too common to tell a leak and are skipped,
    as are items without id. Null or empty texts and tables contain nothing; rows without
    ``doc_id`` are reported with a null id. Rows that share an id are reported together.
    """
    items = stored(_indexed(benchmark))
    run_bits_of_items, key_bits, classes = _filters(items)
    found = stored(_windows(documents, run_bits_of_items, key_bits, classes, edits))
    hits = found.select("doc_id", "_row", "start", F.explode("keys").alias("key"))
    keys = items.select("item_id", "item_row", F.explode("keys").alias("key"))
    pairs = hits.join(keys, "key").select("doc_id", "_row", "start", "item_id", "item_row").distinct()
    place = [pairs[c].eqNullSafe(found[c]) for c in ("doc_id", "_row", "start")]
    both = (
        pairs.join(found, place)
        .select(pairs.doc_id, pairs.start, "item_id", "item_row", "window")
        .join(items.select("item_id", "item_row", "words"), ["item_id", "item_row"])
        .select("doc_id", "item_id", "start", "words", "window")
    )
    exact = both.mapInArrow(_verify(edits), "doc_id long, item_id long, start long, distance long")
    best = exact.groupBy("doc_id", "item_id").agg(F.min(F.struct("distance", "start")).alias("best"))
    return best.select("doc_id", "item_id", "best.start", "best.distance")


def without_contamination(documents: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents that contain no benchmark item, all columns."""
    leaks = contaminated(documents, benchmark, **settings).select("doc_id").distinct()
    same = documents.doc_id.eqNullSafe(leaks.doc_id)
    return documents.join(leaks, same, "left_anti")


def item_words(text: bytes) -> np.ndarray:
    """Hashes of the words of a UTF-8 text; 0 stands for no word."""
    lowered = text.decode("utf-8", "replace").lower().encode()
    return hash_words(lowered.translate(_PUNCTUATION).split()) | np.uint64(1)


def run_bits(hashes: np.ndarray) -> np.ndarray:
    """The bit of each run of three words, at the place of its first word."""
    total = hashes[:-2] * _RUN_WEIGHTS[0] + hashes[1:-1] * _RUN_WEIGHTS[1] + hashes[2:] * _RUN_WEIGHTS[2]
    return mixed(total) >> np.uint64(64 - _RUN_BITS)


def runs_left(c: int, edits: float) -> int:
    """How many runs of three words are left at least, of an item of class ``c``."""
    low, high = class_lengths(c)
    return max(0, min(n - _RUN + 1 - _RUN * most_edits(n, edits) for n in range(low, high + 1)))


def most_edits(n: int, edits: float) -> int:
    return math.floor(edits * n + 1e-9)


def length_class(n: int) -> int:
    return int(math.log(n / SHORTEST_ITEM) / math.log(_CLASS_GROWTH) + 1e-9)


def class_lengths(c: int) -> tuple[int, int]:
    """The smallest and the largest number of words of class ``c``."""
    low = next(n for n in range(int(SHORTEST_ITEM * _CLASS_GROWTH**c), 1 << 62) if length_class(n) >= c)
    high = next(n for n in range(low, 1 << 62) if length_class(n + 1) > c)
    return low, high


def walks_of(c: int) -> int:
    return max(LEAST_WALKS, math.ceil(WALKS_PER_WORD * class_lengths(c)[1]))


def lsh_keys(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, c: int) -> np.ndarray:
    """Keys (windows x tables) of the windows ``starts`` to ``ends`` for items of class ``c``."""
    keys = np.zeros((walks_of(c) * TABLES_PER_WALK, len(starts)), np.uint64)
    symbol, part, inside = (np.empty(len(starts), kind) for kind in (np.uint64, np.uint64, bool))
    for bits, sampled in _walks(c):
        at = starts.copy()
        for bit, columns in zip(bits, sampled):
            np.take(hashes, at, out=symbol, mode="clip")
            np.multiply(symbol, np.less(at, ends, out=inside), out=symbol)
            for column, weight in columns:
                keys[column] += np.multiply(symbol, weight, out=part)
            at += np.right_shift(np.multiply(symbol, bit, out=part), _TOP_BIT, out=part).view(np.int64)
    for column, own in enumerate(keys):
        own[:] = mixed(own + np.uint64(column + (c << 32) + 1))
    return keys.T


def _walks(c: int) -> list[tuple[np.ndarray, list[list[tuple[int, np.uint64]]]]]:
    """Of each walk, a random factor for each step and the tables that sample the step, each with
    a weight: the key of a table is the weighted sum of what it samples.

    A walk takes about two steps a word, so the sampled steps reach over the shortest item.
    """
    made = of_worker("walks")
    if c in made:
        return made[c]
    steps, rng, walks = 2 * class_lengths(c)[0], np.random.default_rng(1000 + c), []
    weights = np.random.default_rng(500_000 + c)
    for walk in range(walks_of(c)):
        sampled: list[list[tuple[int, np.uint64]]] = [[] for _ in range(steps)]
        for table in range(TABLES_PER_WALK):
            for step in rng.choice(steps, SAMPLED, replace=False):
                weight = weights.integers(1, 2**63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                sampled[step].append((walk * TABLES_PER_WALK + table, weight))
        bits = rng.integers(1, 2**63, steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        walks.append((bits, sampled))
    made[c] = walks
    return walks


def distance(x: np.ndarray, y: np.ndarray) -> int:
    """Edit distance of two sequences, a column of the table at a time.

    A column is held as two numbers whose bits tell where it goes up and down (Myers, Hyyroe).
    """
    places: dict[int, int] = {}
    for i, symbol in enumerate(x.tolist()):
        places[symbol] = places.get(symbol, 0) | 1 << i
    full, last = (1 << len(x)) - 1, 1 << len(x) >> 1
    up, down, found = full, 0, len(x)
    if not found:
        return len(y)
    for symbol in y.tolist():
        same = places.get(symbol, 0)
        level = same | down
        flat = (((same & up) + up) ^ up) | same
        more, less = down | full & ~(flat | up), up & flat
        found += bool(more & last) - bool(less & last)
        more, less = more << 1 | 1, less << 1
        up, down = full & (less | ~(level | more)), full & more & level
    return found


def _indexed(benchmark: DataFrame) -> DataFrame:
    """``item_id, item_row, words, keys, length_class`` of the items that are long enough."""

    def rows(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("item_id", "item_row", "words", "keys", "length_class")}
        alike: dict[int, list] = {}
        for item, row, text in zip(*(batch.column(k).to_pylist() for k in ("item_id", "item_row", "text"))):
            found = item_words(text)
            if len(found) >= SHORTEST_ITEM and item is not None:
                alike.setdefault(length_class(len(found)), []).append((item, row, found))
        for c, members in alike.items():
            at_once = max(1, _KEYS_AT_ONCE // (walks_of(c) * TABLES_PER_WALK))
            for i in range(0, len(members), at_once):
                some = members[i : i + at_once]
                ends = np.cumsum([len(found) for *_, found in some])
                starts = ends - [len(found) for *_, found in some]
                keys = lsh_keys(np.concatenate([found for *_, found in some]), starts, ends, c).copy()
                for (item, row, found), own in zip(some, keys):
                    for k, v in zip(out, (item, row, found.tobytes(), own.view(np.int64).tolist(), c)):
                        out[k].append(v)
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int32())
        return {k: pa.array(v, kind) for (k, v), kind in zip(out.items(), kinds)}

    schema = "item_id long, item_row long, words binary, keys array<long>, length_class int"
    numbered = benchmark.withColumns({"item_id": F.col("item_id").cast("long"), "item_row": F.xxhash64("text")})
    return map_batches(texts(numbered, "item_id", "item_row"), schema, rows, "walks")


def _filters(items: DataFrame) -> tuple[bytes, bytes, list[int]]:
    """Bitmaps of the items' runs and keys, and the length classes that occur."""

    def run(batches):
        run_map, key_map = np.zeros(1 << _RUN_BITS, bool), np.zeros(1 << _KEY_BITS, bool)
        classes: set[int] = set()
        for batch in batches:
            words, keys, kinds = (batch.column(i).to_pylist() for i in range(3))
            for found, own in zip(words, keys):
                run_map[run_bits(np.frombuffer(found, np.uint64))] = True
                key_map[np.array(own, np.int64).view(np.uint64) >> np.uint64(64 - _KEY_BITS)] = True
            classes |= set(kinds)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([np.packbits(run_map).tobytes()]),
                pa.array([np.packbits(key_map).tobytes()]),
                pa.array([sorted(classes)], pa.list_(pa.int32())),
            ],
            names=["w", "k", "c"],
        )

    # Eight parts at most: about 16 MB, whatever the size of the benchmark.
    parts = items.select("words", "keys", "length_class").coalesce(8)
    run_map = key_map = 0
    classes: set[int] = set()
    for row in parts.mapInArrow(run, "w binary, k binary, c array<int>").toLocalIterator():
        run_map |= int.from_bytes(row.w, "big")
        key_map |= int.from_bytes(row.k, "big")
        classes |= set(row.c)
    return run_map.to_bytes(1 << _RUN_BITS - 3, "big"), key_map.to_bytes(1 << _KEY_BITS - 3, "big"), sorted(classes)


def _windows(documents, run_bits_of_items: bytes, key_bits: bytes, classes: list[int], edits: float) -> DataFrame:
    """``doc_id, _row, start, window, keys``: windows with a key that some item has, too."""

    def run(batches):
        run_map = np.unpackbits(np.frombuffer(run_bits_of_items, np.uint8)).view(bool)
        key_map = np.unpackbits(np.frombuffer(key_bits, np.uint8)).view(bool)
        for batch in batches:
            for part in _parts(batch):
                yield from _near(part, run_map, key_map, classes, edits)

    numbered = documents.withColumns({"doc_id": F.col("doc_id").cast("long"), "_row": F.xxhash64("text")})
    schema = "doc_id long, _row long, start long, window binary, keys array<long>"
    return texts(numbered, "doc_id", "_row").mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch):
    """``(ids, rows, hashes of the words)`` of whole documents, a million words or little more at a time."""
    ids, rows, found, total = [], [], [], 0
    for doc_id, row, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
        ids.append(doc_id)
        rows.append(row)
        found.append(item_words(text))
        total += len(found[-1])
        if total >= _WORDS_AT_ONCE:
            yield ids, rows, found
            ids, rows, found, total = [], [], [], 0
    if total:
        yield ids, rows, found


def _near(part, run_map, key_map, classes, edits):
    """The windows of some documents that meet an item in a table."""
    ids, rows, found = part
    hashes, sizes = np.concatenate(found), np.array([len(f) for f in found])
    n, ended = len(hashes), np.cumsum(sizes)
    document = np.repeat(np.arange(len(sizes)), sizes)
    if n < _RUN:
        return
    known = np.zeros(n + 1, np.int32)
    np.cumsum(run_map[run_bits(hashes)], out=known[1 : n - 1])
    known[n - 1 :] = known[n - 2]
    # What is enough for some class in its window is enough for the widest window.
    least = min((runs_left(c, edits) for c in classes), default=0)
    widest = max((class_lengths(c)[1] for c in classes), default=0)
    own_end = ended[document]
    reach = known[np.minimum(np.arange(widest, n + widest), own_end)] - known[:n]
    place = np.flatnonzero(reach >= least)
    own_end = own_end[place]
    for c in classes:
        ends = np.minimum(place + class_lengths(c)[1], own_end)
        enough = known[ends] - known[place] >= runs_left(c, edits)
        starts, ends = place[enough], ends[enough]
        at_once = max(1, _KEYS_AT_ONCE // (walks_of(c) * TABLES_PER_WALK))
        for i in range(0, len(starts), at_once):
            first, last = starts[i : i + at_once], ends[i : i + at_once]
            keys = lsh_keys(hashes, first, last, c)
            hit = key_map[keys >> np.uint64(64 - _KEY_BITS)]
            met = np.flatnonzero(hit.any(axis=1))
            if not len(met):
                continue
            at, to = first[met], last[met]
            owner = document[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[d] for d in owner], pa.int64()),
                    pa.array([rows[d] for d in owner], pa.int64()),
                    pa.array(at - ended[owner] + sizes[owner]),
                    pa.array([hashes[x:y].tobytes() for x, y in zip(at, to)], pa.binary()),
                    pa.array([keys[m][hit[m]].view(np.int64).tolist() for m in met], pa.list_(pa.int64())),
                ],
                names=["doc_id", "_row", "start", "window", "keys"],
            )


def _verify(edits: float):
    def run(batches):
        for batch in batches:
            near, keep = [], []
            for own, window in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                item = np.frombuffer(own, np.uint64)
                seen = np.frombuffer(window, np.uint64)[: len(item)]
                most = most_edits(len(item), edits)
                there = set(seen.tolist())
                # Every word of the item that the window lacks is an edit.
                if sum(w not in there for w in item.tolist()) > most:
                    least = most + 1
                else:
                    least = 0 if np.array_equal(item, seen) else distance(item, seen)
                near.append(least)
                keep.append(least <= most)
            rows = [batch.column(i) for i in range(3)] + [pa.array(near, pa.int64())]
            names = ["doc_id", "item_id", "start", "distance"]
            yield pa.RecordBatch.from_arrays(rows, names=names).filter(pa.array(keep, pa.bool_()))

    return run
