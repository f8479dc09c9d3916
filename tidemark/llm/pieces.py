"""SentencePiece encoding by suffix arrays, and decoding."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import of_worker, slices, texts

_SPACE = "▁"
_WORD = re.compile("▁*[^▁]+|▁+")
_REMEMBERED = 350_000
# So much of a batch is worked on at once: bytes of text, ids.
_BYTES_AT_ONCE, _IDS_AT_ONCE = 2_000_000, 400_000
_WORDS_AT_ONCE = 40_000
_SLOTS = 1 << 20


def encoded(documents: DataFrame, model_path: str) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, n_pieces, ids``, whole texts encoded.

    ``model_path`` is a BPE model with byte fallback and the identity normalizer that every
    executor can read. The ids are those of the ``sentencepiece`` library without begin and end.

    The texts of a batch fall into words (a piece never reaches over the space that begins
    one); the different ones that were not met before are joined to one text, whose suffixes
    are sorted. A binary search of every piece gives the range of suffixes that begin with it,
    which are the places where it occurs: the edges of a lattice. Sorted by the place where
    they end, they are relaxed from left to right: of the edges into a place the one is taken
    that may stand behind the last piece before it. That is the one that merging would leave.

    Null and empty texts have no ids. No documents give no rows; ids may be null or repeat.
    """

    names = ["doc_id", "n_pieces", "ids"]

    def run(batches):
        lattice = _kept("lattice", model_path, Lattice)
        for batch in batches:
            for part in slices(batch, "text", _BYTES_AT_ONCE):
                found, ends = lattice.encode([t.decode() for t in part.column("text").to_pylist()])
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(found))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(ends)), ids], names)

    ids = documents.withColumn("doc_id", F.col("doc_id").cast("long"))
    return texts(ids, "doc_id").mapInArrow(run, "doc_id long, n_pieces long, ids array<int>")


def decoded(encoded_rows: DataFrame, model_path: str) -> DataFrame:
    """``encoded_rows`` with ``text``, which ``ids`` spell. Null ids spell nothing.

    Bytes that are not UTF-8 become U+FFFD, one each. Ids that the model lacks are an error.
    """
    others = [c for c in encoded_rows.columns if c != "text"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded_rows.select(others).schema)

    def run(batches):
        speller = _kept("speller", model_path, Speller)
        for batch in batches:
            for part in slices(batch, "ids", _IDS_AT_ONCE):
                found = speller.decode_all(part.column("ids"))
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*others, "text"])

    return encoded_rows.select(others).mapInArrow(run, f"{fields}, text string")


class Speller:
    """What the pieces of a model spell."""

    def __init__(self, model_path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.unknown = model.unk_id()
        self.bytes = {int(model.id_to_piece(i)[3:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in range(size) if model.is_control(i)}
        special = self.silent | set(self.byte_of) | {self.unknown}
        self.piece = {i: model.id_to_piece(i) for i in range(size) if i not in special}
        self.scores = {i: model.get_score(i) for i in self.piece}
        self.plain = self.piece | dict.fromkeys(self.silent, "")
        spelled = {i: p.encode() for i, p in self.plain.items()} | {i: bytes([b]) for i, b in self.byte_of.items()}
        self.spelled = pa.array([spelled.get(i) for i in range(size)], pa.large_binary())
        self.bare = np.array([i in self.byte_of for i in range(size)])

    def decode_all(self, lists: pa.ListArray) -> pa.Array:
        """What each list of ids spells: the spellings stand one behind the other as they are taken."""
        flat = lists.flatten()
        taken = self.spelled.take(flat)
        ends = np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False))
        _, offsets, data = taken.buffers()
        cuts = np.frombuffer(offsets, np.int64)[np.concatenate([[0], ends])]
        odd = self.bare[pc.fill_null(flat, self.unknown).to_numpy(zero_copy_only=False)]
        odd |= taken.is_null().to_numpy(zero_copy_only=False)
        hard = {}
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(odd), side="right")).tolist():
            if not _is_utf8(data[cuts[i] : cuts[i + 1]]) or taken[int(ends[i - 1]) if i else 0 : int(ends[i])].null_count:
                hard[i] = self.decode(lists[i].as_py())
        texts = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(cuts), data])
        if hard:
            texts = pa.array([hard[i].encode() if i in hard else t.as_py() for i, t in enumerate(texts)], pa.large_binary())
        marked = texts.cast(pa.large_string())
        begun = pc.if_else(pc.starts_with(marked, _SPACE), pc.utf8_slice_codeunits(marked, 1), marked)
        return pc.replace_substring(begun, _SPACE, " ").cast(pa.string())

    def decode(self, ids: list[int]) -> str:
        found = list(map(self.plain.get, ids))
        if None not in found:
            text = "".join(found)
            return text.replace(_SPACE, " ")[text.startswith(_SPACE) :]
        out, held = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(_utf8(bytes(held)))
                held.clear()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.silent:
                out.append(self.piece[i])
        if held:
            out.append(_utf8(bytes(held)))
        text = "".join(out)
        return text.replace(_SPACE, " ")[text.startswith(_SPACE) :]

class Lattice(Speller):
    """The pieces of a model, and the words encoded so far."""

    def __init__(self, model_path: str):
        super().__init__(model_path)
        self.rank = {p: (-self.scores[i], i) for i, p in self.piece.items()}
        if any(_SPACE in p.lstrip(_SPACE) for p in self.rank):
            raise ValueError("a piece reaches over the begin of a word")
        # Pieces that merging never leaves as they are can't stand in a result.
        self.whole = np.array([i for i, p in self.piece.items() if self.merge(p) == [p]])
        self.longest = max(map(len, self.rank))
        self.lengths = np.array([len(self.piece[i]) for i in self.whole])
        padded = "".join(self.piece[i].ljust(self.longest, "\0") for i in self.whole)
        self.letters = np.frombuffer(padded.encode("utf-32-le"), np.uint32).reshape(-1, self.longest)
        self._forget()
        # Whether a piece may stand behind another: answers by a hash of the pair, the last one each.
        self.pairs, self.answers = np.full(_SLOTS, -1, np.int64), np.zeros(_SLOTS, bool)

    def _forget(self) -> None:
        # A word's number tells where its ids stand among those of all words so far.
        self.words: dict[str, int] = {}
        self.known, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text begins and the last ends."""
        split = [_words(_SPACE + t.replace(" ", _SPACE)) if t else [] for t in found]
        if len(self.words) > _REMEMBERED:
            self._forget()
        new = list(set().union(*split).difference(self.words))
        for i in range(0, len(new), _WORDS_AT_ONCE):
            some = new[i : i + _WORDS_AT_ONCE]
            ids, sizes = self.encode_words(some)
            self.words.update(zip(some, range(len(self.words), len(self.words) + len(some))))
            self.known, self.sizes = np.concatenate([self.known, ids]), np.concatenate([self.sizes, sizes])
        counts = np.array([len(words) for words in split], np.int64)
        number = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, counts.sum())
        sizes, first = self.sizes[number], (np.cumsum(self.sizes) - self.sizes)[number]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.known[np.repeat(first - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words, one after the other, and how many each has."""
        sizes = np.array([len(w) for w in words])
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(sizes)
        starts, piece, length = self._edges(text, np.repeat(ends, sizes))
        last, came = self._relax(text, ends - sizes, starts, piece, length)
        return self._trace(last, came, ends - sizes, ends)

    def _edges(self, text: np.ndarray, word_end: np.ndarray):
        """Start, piece and length of every occurrence of a piece inside a word."""
        letters, codes = np.unique(text, return_inverse=True)
        order, keys = _suffixes(codes + 1, len(letters), self.longest)
        at = np.minimum(np.searchsorted(letters, self.letters), len(letters) - 1)
        spelled = np.where(self.letters > 0, at + 1, 0)
        known = ((letters[at] == self.letters) | (self.letters == 0)).all(axis=1)
        lengths = self.lengths[known]
        low, high = _ranges(spelled[known], lengths, keys, len(letters))
        counts = high - low
        piece = np.repeat(self.whole[known], counts)
        length = np.repeat(lengths, counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start = order[np.repeat(low, counts) + offset]
        inside = start + length <= word_end[start]
        return start[inside], piece[inside], length[inside]

    def _relax(self, text, word_start, start, piece, length):
        """Of each place, the piece that ends there in the encoding up to it, and its start.

        Places are counted from 1, so that 0 is in front of the text. A character that no piece
        spells is an edge of its own, with a number below zero.
        """
        n = len(text)
        lone = np.arange(n)
        single = {ord(p): i for i, p in self.piece.items() if len(p) == 1}
        letters, codes = np.unique(text, return_inverse=True)
        missing = np.array([c not in single for c in letters])[codes]
        lone = lone[missing]
        start = np.concatenate([start, lone])
        piece = np.concatenate([piece, -text[lone].astype(np.int64) - 1])
        length = np.concatenate([length, np.ones(len(lone), np.int64)])
        inner = np.zeros(n, np.int64)
        inner[word_start] = word_start
        inner = np.maximum.accumulate(inner)
        depth = start + length - inner[start]
        order = np.argsort(depth, kind="stable")
        start, piece, length, depth = start[order], piece[order], length[order], depth[order]
        cut = np.flatnonzero(np.diff(depth, prepend=-1))
        last, came = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        for i, j in zip(cut, [*cut[1:], len(depth)]):
            s, p = start[i:j], piece[i:j]
            first = s == inner[s]
            fits = first | self._fits(last[s], p, ~first)
            e = s[fits] + length[i:j][fits]
            last[e], came[e] = p[fits], s[fits]
        return last, came

    def _fits(self, left: np.ndarray, right: np.ndarray, asked: np.ndarray) -> np.ndarray:
        out = np.zeros(len(left), bool)
        keys = left[asked] * (1 << 32) + right[asked]
        slots = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        new = np.flatnonzero(self.pairs[slots] != keys)
        answer = self.answers[slots]
        if len(new):
            different, at = np.unique(keys[new], return_inverse=True)
            found = np.zeros(len(different), bool)
            for k, key in enumerate(different.tolist()):
                x, y = (self._spelling(i) for i in (_low(key, 32), _low(key, 0)))
                found[k] = self.stay_apart(x, y)
            answer[new] = found[at]
            self.pairs[slots[new]], self.answers[slots[new]] = keys[new], answer[new]
        out[asked] = answer
        return out

    def _trace(self, last, came, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words and their numbers, from the end of each back to its start and turned around."""
        owners, pieces = [], []
        owner, at = np.arange(len(starts)), ends.copy()
        while len(owner):
            owners.append(owner)
            pieces.append(last[at])
            at = came[at]
            more = at > starts[owner]
            owner, at = owner[more], at[more]
        owner, piece = np.concatenate(owners[::-1]), np.concatenate(pieces[::-1])
        order = np.argsort(owner, kind="stable")
        piece = piece[order]
        # A character that no piece spells becomes its bytes.
        bare = np.flatnonzero(piece < 0)
        spelled = [self._spelling(p).encode("utf-8", "surrogatepass") for p in piece[bare].tolist()]
        wide = np.ones(len(piece), np.int64)
        wide[bare] = [len(x) for x in spelled]
        ids = np.repeat(piece, wide).astype(np.int32)
        ids[np.repeat(piece < 0, wide)] = [self.bytes.get(b, self.unknown) for x in spelled for b in x]
        return ids, np.bincount(owner[order], weights=wide, minlength=len(starts)).astype(np.int64)

    def _spelling(self, piece: int) -> str:
        return self.piece[piece] if piece >= 0 else chr(-piece - 1)

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether merging leaves two pieces as they are: no best pair ever reaches over both."""
        parts, border = list(left + right), len(left)
        while True:
            ranked = [(self.rank.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best = min((r for r in ranked if r[0]), default=None)
            if best is None:
                return border == 1 and len(parts) == 2
            i = best[1]
            if i == border - 1:
                return False
            border -= i < border - 1
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def merge(self, text: str) -> list[str]:
        """What merging leaves of a short text: always the best pair, of equal ones the first."""
        parts = list(text)
        while True:
            ranked = [(self.rank.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best = min((r for r in ranked if r[0]), default=None)
            if best is None:
                return parts
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]


def _is_utf8(data: pa.Buffer) -> bool:
    try:
        data.to_pybytes().decode()
    except UnicodeDecodeError:
        return False
    return True


def _utf8(data: bytes) -> str:
    out, i = [], 0
    while i < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[i : i + n].decode())
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


def _words(text: str) -> list[str]:
    """The parts of a text that begin with a run of spaces."""
    return _WORD.findall(text)


def _suffixes(codes: np.ndarray, letters: int, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in the order of their first ``longest`` letters, and their sorted keys.

    Keys hold as many letters as 63 bits take; further ones rank what follows in the same way,
    so that two or three sorts do for the longest piece.
    """
    width = max(1, int(letters).bit_length())
    per_key = 63 // width
    keys, n = [], len(codes)
    for first in range(0, longest, per_key):
        key = np.zeros(n, np.int64)
        for i in range(first, min(first + per_key, longest)):
            key <<= width
            if i < n:
                key[: n - i] |= codes[i:]
        keys.append(key << width * max(0, first + per_key - longest))
    order = np.lexsort(keys[::-1])
    return order, [k[order] for k in keys]


def _ranges(spelled: np.ndarray, lengths: np.ndarray, keys: list[np.ndarray], letters: int):
    """Where the suffixes that begin with each piece stand: a binary search, key by key."""
    width = max(1, int(letters).bit_length())
    per_key = 63 // width
    low = np.zeros(len(spelled), np.int64)
    high = np.full(len(spelled), len(keys[0]), np.int64)
    for k, key in enumerate(keys):
        at = np.flatnonzero(lengths > k * per_key)
        least = np.zeros(len(at), np.int64)
        for i in range(k * per_key, (k + 1) * per_key):
            least <<= width
            if i < spelled.shape[1]:
                least |= spelled[at, i]
        # Letters of the key that the piece leaves open.
        rest = width * np.maximum(0, (k + 1) * per_key - lengths[at])
        most = least + ((np.int64(1) << rest) - 1)
        if k == 0:
            low[at], high[at] = np.searchsorted(key, least, "left"), np.searchsorted(key, most, "right")
            continue
        for i, x, y in zip(at, least, most):
            part = key[low[i] : high[i]]
            low[i], high[i] = low[i] + np.searchsorted(part, x, "left"), low[i] + np.searchsorted(part, y, "right")
    return low, high


def _low(key: int, shift: int) -> int:
    """A signed 32-bit half of a pair's key: both halves may be below zero."""
    right = (key & 0xFFFFFFFF) - ((key & 0x80000000) << 1)
    return right if not shift else (key - right) >> 32


def _kept(kind: str, path: str, make):
    """What was made of a model, once per Python worker."""
    made = of_worker("pieces")
    if (kind, path) not in made:
        made[kind, path] = make(path)
    return made[kind, path]
