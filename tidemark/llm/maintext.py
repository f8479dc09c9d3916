"""The main text of HTML pages, block by block."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import blocklstm
from tidemark.llm.blocklstm import Weights
from tidemark.llm.common import map_batches, stored
from tidemark.llm.htmlblocks import Block, blocks, element_buckets
from tidemark.llm.layouts import MARK, Layouts

# The bounded sample that the classifier is fitted on.
SAMPLE_PAGES = 240
LONGEST_SAMPLE = 200_000
LAYOUTS, EPOCHS, SEED = 1_500, 6, 5
_TURNS = 3
_SAMPLE_BLOCKS, _SAMPLE_TEXTS = 200, 2_000
_CHARS_AT_ONCE = 4_000_000
_MAIN = [element_buckets(name, "") for name in ("article", "main")]
_ASIDE = [element_buckets(name, "") for name in ("nav", "aside", "footer", "form", "header", "comment", "ad")]


def main_texts(pages: DataFrame, weights: bytes) -> DataFrame:
    """A row per row of ``pages``: ``page_id, url, text, n_chars``.

    The whole html is cut into blocks; `blocklstm` reads all blocks of a page in both directions
    and says of each whether it is main text. Those that are make up ``text``, one a line, in page
    order. Character references are decoded and white space is single.

    A null or empty html, or one without main text, gives an empty text. Ids and urls may be null
    and repeat. No pages give no rows; other columns are ignored.
    """
    words: dict[str, int] = {}
    w: Weights = {}

    def rows(batch: pa.RecordBatch) -> dict:
        if not w:
            w.update(unpacked(weights))
        html = batch.column("html").to_pylist()
        found: list[str] = []
        at = 0
        while at < len(html):
            end, chars = at, 0
            while end < len(html) and (end == at or chars + len(html[end]) <= _CHARS_AT_ONCE):
                chars += len(html[end])
                end += 1
            cut = [blocks(h) for h in html[at:end]]
            chosen = blocklstm.probabilities(w, cut, words)
            found += ["\n".join(b.text for b, p in zip(c, ps) if p >= 0.5) for c, ps in zip(cut, chosen)]
            at = end
        return {
            "page_id": batch.column("page_id"),
            "url": batch.column("url"),
            "text": pa.array(found, pa.string()),
            "n_chars": pa.array([len(t) for t in found], pa.int64()),
        }

    html = F.coalesce(F.col("html"), F.lit("")).alias("html")
    taken = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html)
    return map_batches(taken, "page_id long, url string, text string, n_chars long", rows)


def fit(pages: DataFrame) -> bytes:
    """Weights of the classifier, fitted in one task on at most `SAMPLE_PAGES` pages of at most
    `LONGEST_SAMPLE` characters, those with the least hash.

    Nothing in the table says what main text is. Two kinds of pages are learned from: the sampled
    ones that have an article or main element, with what lies in it, outside of menus and the
    like, as main text; and texts of the sample put into invented layouts (`layouts`), where it is
    known. A table without pages still gives weights, from invented texts alone.
    """
    key = F.xxhash64(F.col("page_id").cast("long"), "html")
    usable = pages.where(F.col("html").isNotNull() & (F.length("html") <= LONGEST_SAMPLE))
    sample = usable.select(key.alias("hash"), "html").orderBy("hash", "html").limit(SAMPLE_PAGES)

    def train(batches):
        html = [h for batch in batches for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([packed(trained(html))], pa.binary())], ["weights"])

    # Computed once and kept, so that all readers have the same weights.
    return stored(sample.select("html").coalesce(1).mapInArrow(train, "weights binary")).first()["weights"]


def trained(html: list[str]) -> Weights:
    """Weights fitted to the pages and to invented layouts of their texts."""
    rng = np.random.default_rng(SEED)
    given = [blocks(h) for h in html]
    marked = [(page, [in_landmark(b) for b in page]) for page in given]
    # Given pages say more than invented ones and are shown several times.
    marked = [(p[:_SAMPLE_BLOCKS], y[:_SAMPLE_BLOCKS]) for p, y in marked if any(y)] * _TURNS
    texts = [b.text for page in given for b in page if len(b.text) > 40]
    texts = [texts[i] for i in rng.permutation(len(texts))[:_SAMPLE_TEXTS]]
    layouts = Layouts(texts, rng)
    for _ in range(LAYOUTS):
        page = blocks(layouts.page())
        marked.append(([unmarked(b) for b in page], [b.text.startswith(MARK) for b in page]))
    pages, labels = zip(*marked)
    return blocklstm.trained(list(pages), list(labels), SEED, EPOCHS)


def in_landmark(block: Block) -> bool:
    around = block.path[0]
    return any(m <= around for m in _MAIN) and not any(a <= around for a in _ASIDE)


def unmarked(block: Block) -> Block:
    return Block(block.text.replace(MARK, ""), block.path, block.linked)


def packed(weights: Weights) -> bytes:
    out = io.BytesIO()
    np.savez(out, **weights)
    return out.getvalue()


def unpacked(data: bytes) -> Weights:
    with np.load(io.BytesIO(data)) as found:
        return {k: found[k] for k in found.files}
