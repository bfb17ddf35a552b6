"""Hard negatives and whitening against plain versions."""

import itertools

import numpy as np
import pytest

from __spark_entry__ import queries
from sightline.llm import hard_negatives, whitening
from sightline.llm.whitening import Spectrum, rank_one
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, row int, node string, g int"
NAN, INF = float("nan"), float("inf")


def rows_of(spark, vectors):
    """Rows (vec_id, embedding, label); further columns clash with names used inside."""
    return spark.createDataFrame([(*v, 1, "n", 2) for v in vectors], SCHEMA)


@pytest.fixture(scope="module")
def embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    return [(r.vec_id, r.embedding, r.label) for r in rows]


# ---- hard negatives -----------------------------------------------------------------------------


def plain_negatives(vectors, scale=256):
    """Anchors are ids divisible by 50."""
    sound = [
        (i, np.floor(np.array(e, np.float32).astype(float) * scale).astype(int), y)
        for i, e, y in vectors
        if i is not None and y is not None and e and all(v is not None and np.isfinite(v) for v in e)
    ]
    out = []
    for at, (a, x, y) in enumerate(sound):
        if a % 50:
            continue
        others = [
            (-int(x @ v), i, z) for n, (i, v, z) in enumerate(sound) if n != at and len(v) == len(x)
        ]
        others.sort()
        for s, p, _ in [o for o in others if o[2] == y][:5]:
            fits = [o for o in others if o[2] != y and 50 * -s <= 100 * -o[0] <= 95 * -s][:3]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fits)]
    return sorted(out)


def mined(df):
    names = "anchor_id positive_id rank negative_id positive_score negative_score".split()
    return sorted(tuple(r) for r in df.select(*names).collect())


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 2), (4, 2), (6, 1), (1, 3)])
def test_curve_steps_to_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hard_negatives.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_all_scores():
    rng = np.random.default_rng(1)
    a, x = rng.integers(-300, 300, (20, 9)), rng.integers(-300, 300, (50, 9))
    low, high = hard_negatives.score_bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    scores = a @ x.T
    assert (low[:, 0] <= scores.min(axis=1)).all() and (high[:, 0] >= scores.max(axis=1)).all()
    one_low, one_high = hard_negatives.score_bounds(a, x, x)
    assert (one_low == scores).all() and (one_high == scores).all()


def test_products_are_exact_at_every_size():
    rng = np.random.default_rng(2)
    for top in (100, 1 << 20, 1 << 27):
        a, b = rng.integers(-top, top, (5, 64)), rng.integers(-top, top, (7, 64))
        exact = a.astype(object) @ b.astype(object).T
        assert (hard_negatives.product(a, b) == exact).all()


def test_op11(spark, embeddings):
    moved = [(i, e, (y + 1) % 10 if i % 7 == 0 else y) for i, e, y in embeddings]
    assert mined(queries()["op11_hard_negatives"](spark, SF)) == plain_negatives(moved)


def clustered():
    """Tight clusters whose labels disagree in part, with copies and ties."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 8)) * 4
    out = []
    for i in range(400):
        e = centres[i % 6] + rng.standard_normal(8) * (0 if i % 10 == 0 else 0.2)
        out.append((i, e.astype(np.float32).tolist(), int(i % 6 if i % 4 else (i // 4) % 6)))
    return out


def test_small_zones_give_the_same_and_leave_blocks_out(spark, monkeypatch):
    for name, n in (("BLOCK", 8), ("GROUP", 3), ("FAN", 3), ("LANE", 2)):
        monkeypatch.setattr(hard_negatives, name, n)
    vectors = clustered()
    asked = []
    whole = hard_negatives.needed_blocks

    def counted(anchors, levels, same):
        assert len(levels) > 2
        found = whole(anchors, levels, same)
        asked.append((found.count(), anchors.select("g").distinct().count() * levels[0].count()))
        return found

    monkeypatch.setattr(hard_negatives, "needed_blocks", counted)
    got = hard_negatives.mine(rows_of(spark, vectors), F.col("vec_id") % 50 == 0)
    assert mined(got) == plain_negatives(vectors)
    assert all(read < 0.6 * every for read, every in asked)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(4)
    near = lambda: (np.ones(4) + rng.standard_normal(4) * 0.4).astype(np.float32).tolist()
    vectors = [(i, near(), i % 2) for i in range(60)]
    vectors += [(100, near(), 0), (100, near(), 0), (150, [0.0] * 4, 1), (200, near(), None)]
    vectors += [(250, None, 0), (300, [1.0, None, 1.0, 1.0], 0), (350, [1.0, NAN, 1.0, 1.0], 1)]
    vectors += [(400, [1.0, INF, 1.0, 1.0], 1), (None, near(), 0), (450, [], 0), (500, [1.0, 2.0], 0)]
    vectors += [(501, [1.0, 1.5], 0), (502, [0.9, 1.0], 1), (-50, near(), 1), (7, vectors[7][1], 1)]
    vectors += [(60 + k, vectors[3][1], 0) for k in range(5)]
    got = hard_negatives.mine(rows_of(spark, vectors), F.col("vec_id") % 50 == 0)
    assert mined(got) == plain_negatives(vectors)


@pytest.mark.parametrize("vectors", [[], [(1, [1.0], 0)], [(50, [1.0], 0)], [(50, None, 0)]])
def test_tables_without_answers(spark, vectors):
    assert mined(hard_negatives.mine(rows_of(spark, vectors), F.col("vec_id") % 50 == 0)) == []


# ---- whitening ----------------------------------------------------------------------------------


def plain_whitening(vectors):
    """vec_ids, deviation, whitened (up to signs), explained."""
    sound = [v for v in vectors if v[1] and all(x is not None and np.isfinite(x) for x in v[1])]
    x = np.floor(1024 * np.array([v[1] for v in sound], np.float32).astype(float)).astype(int) + 100_000
    n = len(x)
    exact = ((n * x.astype(object) - x.astype(object).sum(axis=0)) ** 2).sum(axis=1)
    deviation = [d if d < 1 << 63 else None for d in exact]
    centred = x - x.mean(axis=0)
    values, components = np.linalg.eigh(centred.T @ centred / n)
    order = [k for k in np.argsort(-values) if values[k] > 1e-12 * values.sum()][:8]
    white = centred @ components[:, order] / np.sqrt(values[order])
    return [v[0] for v in sound], deviation, white, values[order] / values.sum()


def assert_whitened(df, vectors, tolerance=1e-8):
    ids, deviation, white, explained = plain_whitening(vectors)
    k = white.shape[1]
    rows = df.collect()
    assert len(rows) == len(ids) * k
    by_component = {c: {} for c in range(1, k + 1)}
    for r in rows:
        assert r.n == len(ids) and r.identity_error <= 1e-4
        assert abs(r.explained - explained[r.component - 1]) <= 1e-10
        by_component[r.component].setdefault(r.vec_id, []).append((r.deviation, r.whitened))
    for c in range(k):
        found = by_component[c + 1]
        side = np.sign(sum(w * found[i][0][1] for i, w in zip(ids, white[:, c])))
        want = {}
        for i, d, w in zip(ids, deviation, white[:, c]):
            want.setdefault(i, []).append((d, side * w))
        for i, pairs in want.items():
            for (d, w), (d2, w2) in zip(sorted(pairs), sorted(found[i]), strict=True):
                assert d == d2 and abs(w - w2) <= tolerance


def test_op13(spark, embeddings):
    assert_whitened(queries()["op13_whitening"](spark, SF), embeddings)


@pytest.mark.parametrize("kind", ["plain", "copies", "flat", "few", "scaled"])
def test_updates_follow_the_covariance(kind):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 12)) * 50 + 1e5
    if kind == "copies":
        x = np.repeat(x[:5], 60, axis=0)
    if kind == "flat":
        x = 1e5 + rng.standard_normal((300, 3)) @ rng.standard_normal((3, 12)) * 50
    if kind == "few":
        x = x[:4]
    if kind == "scaled":
        x = x * 10.0 ** np.arange(-6, 6)
    parts = []
    for part in np.array_split(x, 3):
        seen = Spectrum.empty(12)
        for row in part:
            seen.add(row)
        parts.append(seen)
    whole = parts[0].combine(parts[1]).combine(parts[2])
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    top = np.linalg.eigvalsh(scatter)
    assert whole.n == len(x) and np.allclose(whole.mean, x.mean(axis=0), rtol=1e-12)
    assert np.abs(whole.values - top).max() <= 1e-11 * top.max()
    assert np.abs(whole.vectors.T @ whole.vectors - np.eye(12)).max() < 1e-12
    assert np.abs(scatter @ whole.vectors - whole.vectors * whole.values).max() <= 1e-11 * top.max()


def test_deflation_leaves_what_the_update_does_not_touch():
    values, vectors = rank_one(np.array([1.0, 1.0, 2.0, 5.0]), np.eye(4), np.array([3.0, 4.0, 0.0, 0.0]))
    assert np.allclose(values, [1, 2, 5, 26])
    assert np.allclose(np.abs(vectors[:, 3]), [0.6, 0.8, 0, 0])
    same, _ = rank_one(values, vectors, np.zeros(4))
    assert (same == values).all()


def test_awkward_vectors_are_dropped_or_counted(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, (rng.standard_normal(5) * 3).astype(np.float32).tolist(), i % 3) for i in range(40)]
    vectors += [(3, vectors[5][1], None), (3, vectors[3][1], 0), (None, vectors[9][1], 1)]
    odd = [(50, None, 0), (51, [1.0, None, 1.0, 1.0, 1.0], 0), (52, [NAN] * 5, 0), (53, [INF] * 5, 0)]
    odd += [(54, [], 0), (55, [1.0, 2.0], 0)]
    assert_whitened(whitening.whiten(rows_of(spark, vectors + odd)), vectors)


def test_fewer_components_than_asked(spark):
    line = [(i, [float(i), 2.0 * i, 0.0], 0) for i in range(9)]
    assert_whitened(whitening.whiten(rows_of(spark, line)), line)
    for vectors in ([], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(5)], [(1, None, 0)]):
        assert whitening.whiten(rows_of(spark, vectors)).collect() == []


def test_large_components(spark):
    rng = np.random.default_rng(7)
    vectors = [(i, (rng.standard_normal(3) * 1e4).astype(np.float32).tolist(), 0) for i in range(20)]
    assert_whitened(whitening.whiten(rows_of(spark, vectors)), vectors, 1e-7)
    beyond = [(i, [v * 1e20 for v in e], y) for i, e, y in vectors]
    assert all(r.deviation is None for r in whitening.whiten(rows_of(spark, beyond)).collect())
