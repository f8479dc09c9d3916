"""Hard negatives and whitening against brute force."""

import math

import numpy as np
import pytest

from tidemark.llm import negatives, queries, whitening
from tidemark.llm.covertree import NONE, CoverTree

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank string, x int, tree long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "r", 1, 2) for r in rows], SCHEMA)


def odd_vectors(dim=6):
    """Clusters, copies of one vector under many ids, repeated rows, and rows that take no part."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((4, dim))
    rows = []
    for i in range(260):
        v = centres[i % 4] + rng.standard_normal(dim) * 0.3
        rows.append((i, np.float32(v).tolist(), int(rng.integers(0, 4))))
    rows += [(1000 + i, rows[0][1], 1 + i % 2) for i in range(130)]
    rows += [rows[50], rows[50], (50, rows[51][1], 3)]
    rows += [
        (2000, None, 1),
        (2050, [], 1),
        (2051, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
        (2052, [math.inf] * dim, 1),
        (2053, [math.nan] * dim, 1),
        (2054, [1.0, 2.0], 1),
        (2100, rows[7][1], None),
        (None, rows[8][1], 2),
        (2150, [0.0] * dim, 2),
    ]
    return rows


def usable(rows, dim):
    return [r for r in rows if r[1] is not None and len(r[1]) == dim and None not in r[1] and np.isfinite(r[1]).all()]


def mined(rows, dim):
    kept = {}
    for i, v, label in usable(rows, dim):
        if i is not None and label is not None:
            label = (label + 1) % 10 if i % 7 == 0 else label
            x = np.floor(256 * np.array(v, np.float64)).astype(int).tolist()
            kept[i] = min(kept.get(i, (label, x)), (label, x))
    out = []
    for a, (label, x) in kept.items():
        if a % 50:
            continue
        scored = sorted((-int(np.dot(x, y)), i, l) for i, (l, y) in kept.items() if i != a)
        own = [(i, -s) for s, i, l in scored if l == label][:5]
        for p, score in own:
            hard = [(i, -s) for s, i, l in scored if l != label and 50 * score <= -100 * s <= 95 * score]
            out += [(a, p, rank, i, score, s) for rank, (i, s) in enumerate(hard[:3], 1)]
    return sorted(out)


@pytest.mark.parametrize("per_tree", [4096, 23])
def test_negatives_equal_brute_force(spark, monkeypatch, per_tree):
    monkeypatch.setattr(negatives, "ROWS_PER_TREE", per_tree)
    rows = odd_vectors()
    monkeypatch.setattr(queries, "_table", lambda *_: table(spark, rows))
    got = queries.op12_hard_negatives(spark, "")
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = mined(rows, 6)
    assert len(expected) > 100
    assert sorted(map(tuple, got.collect())) == expected


def test_negatives_of_table(spark, sf_dir):
    got = queries.op12_hard_negatives(spark, sf_dir)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    dim = len(rows[0][1])
    assert sorted(map(tuple, got.collect())) == mined(rows, dim)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], 1)], [(0, None, 1)], [(0, [1.0], 1), (50, [2.0], 2)]])
def test_negatives_of_almost_nothing(spark, rows):
    vectors = table(spark, rows)
    assert negatives.hard_negatives(vectors, vectors.select("vec_id")).collect() == []


def test_tree_of_large_entries():
    rng = np.random.default_rng(5)
    points = rng.integers(-(2**29), 2**29, (200, 3))
    ids, labels = rng.permutation(200), np.zeros(200, np.int64)
    tree = CoverTree(points.copy(), ids.copy(), labels.copy())
    widest = np.full((5, 1), 2**62 - 1)
    score, found = tree.best(points[:5], ids[:5], labels[:5], -widest, widest, True, 4)
    for a in range(5):
        exact = sorted((-int(sum(int(u) * int(v) for u, v in zip(points[a], points[b]))), int(ids[b])) for b in range(200) if b != a)
        assert [(-int(s), int(i)) for s, i in zip(score[a, 0], found[a, 0])] == exact[:4]
    assert NONE < 0


def test_tree_covers_its_points_and_keeps_centres_apart():
    rng = np.random.default_rng(6)
    points = np.floor(rng.standard_normal((3, 4))[rng.integers(0, 3, 500)] * 300 + rng.standard_normal((500, 4)) * 9)
    tree = CoverTree(points.astype(np.int64), np.arange(500), np.zeros(500, np.int64))
    unit = tree._lifted()
    for level in tree.levels:
        for centre, angle, i, j in zip(level.centre, level.angle, level.start, level.end):
            assert i <= centre < j
            assert np.arccos(np.clip(unit[i:j] @ unit[centre], -1, 1)).max() <= angle + 1e-7
    leaves = sorted(
        (int(i), int(j)) for v in tree.levels for i, j, leaf in zip(v.start, v.end, v.leaf) if leaf
    )
    assert [i for i, _ in leaves] == [0, *[j for _, j in leaves[:-1]]] and leaves[-1][1] == 500


def check_whitened(got, rows, dim, most=32):
    kept = usable(rows, dim)
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v, _ in kept])
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    k = int((values > values.sum() * 1e-12).sum())
    frame = got.toPandas()
    assert len(frame) == n * k and set(frame["n"]) == {n}
    assert set(frame["component"]) == set(range(1, k + 1))
    assert frame["identity_error"].nunique() == 1 and frame["identity_error"].max() < 1e-9
    shares = frame.groupby("component")["explained"].first().to_numpy()
    np.testing.assert_allclose(shares, values[:k] / np.trace(centred.T @ centred / n), rtol=1e-9)
    exact = sorted(((n * x.astype(object) - total) ** 2).sum(axis=1))
    assert sorted(frame[frame["component"] == 1]["deviation"]) == exact
    expected = centred @ axes[:, :k] / np.sqrt(values[:k])
    for c in range(1, k + 1):
        one = np.sort(frame[frame["component"] == c]["whitened"].to_numpy())
        signs = [np.sort(s * expected[:, c - 1]) for s in (1, -1)]
        assert min(np.abs(one - s).max() for s in signs) < 1e-7
    return frame


def test_whitening_equals_brute_force(spark):
    rows = odd_vectors()
    frame = check_whitened(whitening.whitened(table(spark, rows)), rows, 6)
    assert frame["vec_id"].isna().sum() == 6


def test_whitening_of_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = queries.op13_whitening(spark, sf_dir)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    frame = check_whitened(got, rows, len(rows[0][1]))
    # Signs are the same for all rows: components are uncorrelated.
    wide = frame.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(wide.T @ wide / len(wide) - np.eye(wide.shape[1])).max() < 1e-9


@pytest.mark.parametrize("rows", [[], [(0, None, 1)], [(0, [1.0, 2.0], 1)], [(i, [1.0, 2.0], 1) for i in range(3)]])
def test_whitening_of_almost_nothing(spark, rows):
    assert whitening.whitened(table(spark, rows)).collect() == []


def test_whitening_of_large_entries(spark):
    rng = np.random.default_rng(9)
    rows = [(i, np.float32(rng.standard_normal(3) * 1e12).tolist(), 0) for i in range(20)]
    frame = whitening.whitened(table(spark, rows)).toPandas()
    assert frame["deviation"].isna().all() and frame["identity_error"].max() < 1e-6


@pytest.mark.parametrize(("size", "count"), [(90, 4), (40, 40), (3, 32)])
def test_eigenpairs_reach_double_precision(size, count):
    rng = np.random.default_rng(size)
    half = rng.standard_normal((size, 500))
    matrix = half @ half.T / 500
    values, axes = whitening.eigenpairs(lambda block: matrix @ block, size, count)
    np.testing.assert_allclose(values, np.linalg.eigvalsh(matrix)[::-1][:count], rtol=1e-13)
    assert np.abs(matrix @ axes - axes * values).max() < 1e-12
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13
