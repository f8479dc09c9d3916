"""Word counts over lines of text."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import has_words, joined_words, words
from tidemark.operators.hot_keys import ROWS_PER_PIECE, Running, cut_in_pieces, find_hot_keys, ordered

# What counts in a piece travels with its query, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KB_PER_PIECE = 8_000
_LONGEST_KB = 50


def word_count(lines: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, cnt`` over all lines.

    On a stream the counts are running totals: write it with output mode
    ``update`` to get each changed word once per micro-batch.
    """
    return (
        lines.select(F.explode(words(F.col(text_col))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def tokens(lines: DataFrame, line_cols: list[str], text_col: str = "text") -> DataFrame:
    """One row per word with its line and its position ``pos`` in that line, from 0."""
    return lines.select(*line_cols, F.posexplode(words(F.col(text_col))).alias("pos", "word"))


def word_running_count(
    lines: DataFrame,
    line_cols: list[str],
    text_col: str = "text",
    rows_per_piece: int = ROWS_PER_PIECE,
    kb_per_piece: int = KB_PER_PIECE,
) -> DataFrame:
    """One row per word occurrence: the n-th occurrence of a word has ``cnt`` n.

    Occurrences are in the order of ``line_cols``, then of their position.

    Lines of more than ``kb_per_piece`` thousand characters are cut into consecutive pieces of
    about that size, so that lines are shuffled and not words. How often each word was met before
    a piece is added up from a row per word and piece; the words of a piece are counted in one
    task. Where too many lines agree in ``line_cols`` to be cut apart, and for less text, each
    word is a sequence of its own, cut every ``rows_per_piece`` occurrences.
    """
    order = [*line_cols, "pos"]
    given = lines.select(*line_cols, text_col)
    cut = find_hot_keys(given, [], line_cols, kb_per_piece, lambda sample: _by_kb(sample, text_col))
    if cut and not cut.copies:
        return _counted_in_pieces(cut_in_pieces(given, line_cols, cut), line_cols, text_col)
    hot = find_hot_keys(
        given,
        ["word"],
        order,
        rows_per_piece,
        expand=lambda sample: tokens(sample, line_cols, text_col),
    )
    rows = ordered(tokens(lines, line_cols, text_col), ["word"], order, hot)
    return rows.with_running(Running("cnt", "sum", F.lit(1).cast("long"))).rows()


def _by_kb(lines: DataFrame, text_col: str) -> DataFrame:
    """A row per line and thousand characters; few very long lines are not to look like copies."""
    kb = F.least(F.coalesce(F.length(text_col), F.lit(0)) / 1000, F.lit(_LONGEST_KB - 1)).cast("int")
    return lines.withColumn("__kb", F.explode(F.sequence(F.lit(0), kb))).drop("__kb")


def _counted_in_pieces(lines: DataFrame, line_cols: list[str], text_col: str) -> DataFrame:
    spoken = lines.where(has_words(F.col(text_col)))
    found = spoken.select("__piece", *line_cols, joined_words(F.col(text_col)).alias("__words"))
    met = (
        found.select("__piece", F.explode(F.split("__words", " ")).alias("word"))
        .groupBy("__piece", "word")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    earlier = Window.partitionBy("word").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    before = met.select("__piece", "word", F.sum("__n").over(earlier).alias("__before")).where("__before > 0")
    # Lines that agree in their columns share a place.
    place = F.dense_rank().over(Window.partitionBy("__piece").orderBy(*line_cols))
    placed = found.withColumn("__place", place)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.select(line_cols).schema)

    def count(lines: pa.Table, before: pa.Table) -> pa.Table:
        texts, known = (_whole(t.column(c)) for t, c in ((lines, "__words"), (before, "word")))
        place, n = lines.column("__place").to_numpy(), before.column("__before").to_numpy()
        found, counts = numbered_words(texts, place, known, n)
        counts = pa.ListArray.from_arrays(found.offsets, pa.array(counts))
        columns = [*(lines.column(c) for c in line_cols), found, counts]
        return pa.Table.from_arrays(columns, [*line_cols, "__words", "__cnts"])

    pairs = placed.groupBy("__piece").cogroup(before.groupBy("__piece"))
    counted = pairs.applyInArrow(count, f"{fields}, __words array<string>, __cnts array<bigint>")
    each = counted.select(*line_cols, F.posexplode(F.arrays_zip("__words", "__cnts")).alias("pos", "__found"))
    word, cnt = F.col("__found.__words"), F.coalesce(F.col("__found.__cnts"), F.lit(0))
    return each.select(*line_cols, "pos", word.alias("word"), cnt.alias("cnt"))


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.array([], pa.string()) if not len(column) else pa.concat_arrays(column.chunks).cast(pa.string())


def numbered_words(
    lines: pa.Array, place: np.ndarray, known: pa.Array, before: np.ndarray
) -> tuple[pa.ListArray, np.ndarray]:
    """The words of each line of a piece, and of every word which occurrence it is.

    ``place`` orders the lines; words of lines with equal places come by their position in them.
    ``known`` are words that were met ``before`` the piece so many times.
    """
    found = pc.split_pattern(lines, " ")
    encoded = found.flatten().dictionary_encode()
    code = encoded.indices.to_numpy()
    if (np.diff(place) > 0).all():
        order = np.argsort(code, kind="stable")
    else:
        sizes = found.value_lengths().to_numpy()
        pos = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order = np.lexsort((pos, np.repeat(place, sizes), code))
    sizes = np.bincount(code, minlength=len(encoded.dictionary))
    at = pc.fill_null(pc.index_in(encoded.dictionary, value_set=known), len(known)).to_numpy()
    first = np.append(before, 0)[at] - (np.cumsum(sizes) - sizes)
    counts = np.empty(len(code), np.int64)
    counts[order] = np.arange(1, len(code) + 1)
    return found, counts + first[code]
