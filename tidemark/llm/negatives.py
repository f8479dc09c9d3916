"""Hard negatives by inner product, mined with cover trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.covertree import NONE, CoverTree
from tidemark.llm.vectors import matrix, whole_vectors

SCALE = 256
ROWS_PER_TREE = 4_096
POSITIVES, NEGATIVES = 5, 3
# The window of a negative's score, in percent of the positive's.
LEAST_PERCENT, MOST_PERCENT = 50, 95
_SLOTS = 16
_ANCHORS_AT_ONCE = 512
_LIMIT = 2**62 - 1
_TREE = "tree long, least long, most long, within array<long>, ids binary, labels binary, points binary, counts binary, fields binary"
_FOUND = "anchor_id long, positive_id long, positive_score long, id long, score long"


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    column: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """Hard negatives of every anchor and positive: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``.

    ``vectors`` has ``vec_id``, ``label`` and an array; ``anchors`` holds the ``vec_id`` of those
    rows that are asked about. Entries become ``floor(256 * x)``; a score is an exact inner
    product. Positives are the ``positives`` best other rows of the anchor's label, negatives the
    ``negatives`` best rows of other labels whose score is 50 to 95 percent of the positive's;
    ties go to the smaller id.

    Rows with a null id or label take no part, nor do unusable vectors (see `whole_vectors`) and
    those whose squared length is 2**62 or more. Of rows that repeat an id the one with the least
    label and entries counts. Anchors without positives, and positives without negatives, give
    no rows; neither does an empty table. Other columns are ignored.

    Rows are sorted by label and id, cut into blocks of 4,096, and each block becomes a cover
    tree. Anchors meet the trees of their label in one pass and those with other labels in
    another; a task goes through its trees one by one with the anchors sorted behind each, and
    hands on a few rows for each anchor and tree. Work grows with anchors times trees where the
    bounds prune nothing, as in vectors without clusters.
    """
    whole = whole_vectors(
        vectors, column, SCALE, 0, F.col("vec_id").cast("long").alias("id"), F.col(label).cast("long").alias("label")
    )
    length = F.aggregate("x", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    usable = whole.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (length < F.lit(2.0**62)))
    one = usable.groupBy("id").agg(F.min(F.struct("label", "x")).alias("row")).select("id", "row.*")
    rows = stored(one.repartitionByRange("label", "id").sortWithinPartitions("label", "id"))
    trees = stored(rows.mapInArrow(_trees, _TREE))
    asked = stored(rows.join(anchors.select(F.col("vec_id").alias("id")).distinct(), "id", "left_semi"))

    everything = F.array(F.lit(-_LIMIT)), F.array(F.lit(_LIMIT))
    unlimited = asked.select(
        "*", F.array(F.lit(0).cast("long")).alias("mark"), everything[0].alias("low"), everything[1].alias("high")
    )
    spans = trees.select("tree", "least", "most")
    own = trees.select("tree", F.explode("within").alias("label"))
    near = _searched(trees, unlimited.join(own, "label"), same=True, k=positives)
    by_anchor = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    chosen = stored(
        near.withColumn("rank", F.row_number().over(by_anchor))
        .where(F.col("rank") <= positives)
        .groupBy("anchor_id")
        .agg(F.collect_list("id").alias("mark"), F.collect_list("score").alias("p"))
    )
    low = F.transform("p", lambda p: F.ceil(p.cast("decimal(38,0)") * LEAST_PERCENT / 100).cast("long"))
    high = F.transform("p", lambda p: F.floor(p.cast("decimal(38,0)") * MOST_PERCENT / 100).cast("long"))
    windows = asked.join(chosen.withColumnRenamed("anchor_id", "id"), "id").withColumns({"low": low, "high": high})
    slotted = spans.withColumn("slot", F.pmod(F.xxhash64("tree"), F.lit(_SLOTS)))
    to_trees = windows.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(_SLOTS - 1)).cast("array<long>")))
    other = (F.col("least") != F.col("most")) | (F.col("least") != F.col("label"))
    to_trees = to_trees.join(slotted, "slot").where(other)
    far = _searched(trees, to_trees.drop("p", "slot", "least", "most"), same=False, k=negatives)
    # Positives of one score have one window; the marks tell them apart.
    scores = chosen.select("anchor_id", F.explode(F.arrays_zip("mark", "p")).alias("z"))
    scores = scores.select("anchor_id", F.col("z.mark").alias("positive_id"), F.col("z.p").alias("positive_score"))
    by_positive = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    return (
        far.drop("positive_score")
        .withColumn("rank", F.row_number().over(by_positive))
        .where(F.col("rank") <= negatives)
        .join(scores, ["anchor_id", "positive_id"])
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


def _trees(batches):
    """Cover trees of consecutive rows; a task makes as many as its rows fill."""
    task, made = TaskContext.get().partitionId(), 0
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS_PER_TREE):
            part = batch.slice(i, ROWS_PER_TREE)
            ids, labels = (part.column(c).to_numpy() for c in ("id", "label"))
            tree = CoverTree(matrix(part.column("x")), ids, labels)
            packed = [tree.ids.tobytes(), tree.labels.tobytes(), tree.points.tobytes(), *tree.packed()]
            number = (task << 32) + made
            made += 1
            columns = [pa.array([v], pa.int64()) for v in (number, int(labels.min()), int(labels.max()))]
            columns.append(pa.array([np.unique(labels).tolist()], pa.list_(pa.int64())))
            columns += [pa.array([v], pa.binary()) for v in packed]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _TREE.split(", ")])


def _searched(trees: DataFrame, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """What each anchor finds in each tree that it is sent to, at most ``k`` rows a window."""
    asked = asked.select(
        "tree", F.lit(1).alias("kind"), "id", "label", "x", "mark", "low", "high",
        *[F.lit(None).cast("binary").alias(c) for c in ("ids", "labels", "points", "counts", "fields")],
    )
    heads = trees.select("tree", F.lit(0).alias("kind"), "ids", "labels", "points", "counts", "fields")
    both = heads.unionByName(asked, allowMissingColumns=True)
    dealt = both.repartition("tree").sortWithinPartitions("tree", "kind", "id")
    return dealt.mapInArrow(_search(same, k), _FOUND)


def _search(same: bool, k: int):
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def run(batches):
        tree = None
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            heads = np.flatnonzero(kinds == 0).tolist()
            for i, j in zip([None, *heads], [*heads, batch.num_rows]):
                if i is not None:
                    tree = _tree(batch, i)
                first = 0 if i is None else i + 1
                for at in range(first, j, _ANCHORS_AT_ONCE):
                    found = _found(tree, batch.slice(at, min(_ANCHORS_AT_ONCE, j - at)), same, k)
                    yield pa.RecordBatch.from_arrays(found, names=names)

    return run


def _tree(batch: pa.RecordBatch, i: int) -> CoverTree:
    ids, labels, points, counts, fields = (
        batch.column(c)[i].as_py() for c in ("ids", "labels", "points", "counts", "fields")
    )
    ids, labels, points = (np.frombuffer(v, np.int64) for v in (ids, labels, points))
    return CoverTree.unpacked(points.reshape(len(ids), -1), ids, labels, counts, fields)


def _found(tree: CoverTree, asked: pa.RecordBatch, same: bool, k: int) -> list[pa.Array]:
    q, marks = matrix(asked.column("x")), asked.column("mark").to_pylist()
    ids, labels = (asked.column(c).to_numpy() for c in ("id", "label"))
    widths = np.array([len(m) for m in marks])
    low = np.full((len(q), widths.max()), _LIMIT)
    # Windows that are not there are empty.
    high = np.full(low.shape, -_LIMIT)
    there = np.arange(low.shape[1]) < widths[:, None]
    mark = np.zeros(low.shape, np.int64)
    for into, name in ((low, "low"), (high, "high"), (mark, "mark")):
        into[there] = asked.column(name).flatten().to_numpy()
    score, found = tree.best(q, ids, labels, low, high, same, k)
    a, w, r = np.nonzero(score != NONE)
    score = score[a, w, r]
    return [pa.array(v) for v in (ids[a], mark[a, w], np.zeros_like(score), found[a, w, r], score)]
