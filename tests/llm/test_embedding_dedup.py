import numpy as np
import pytest

from tapemill.llm import embedding_dedup
from tapemill.llm.embedding_dedup import CoverTree, linked_pairs, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id string, node string"


def brute_force(rows, least=0.98):
    sound = {}
    for i, vector, label in rows:
        if i is not None and vector is not None and label is not None and all(x is not None for x in vector):
            v = np.array(vector, np.float32).astype(float)
            if np.isfinite(v).all() and v.any():
                sound[i] = (label, v / np.abs(v).max())
    ids = {i for i, _, _ in rows if i is not None}
    links = {i: set() for i in ids}
    for a, (label, x) in sound.items():
        for b, (other, y) in sound.items():
            if a != b and label == other and len(x) == len(y):
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    links[a].add(b)
    of = {i: i for i in ids}
    for _ in range(len(ids)):
        before = dict(of)
        for a in ids:
            of[a] = min([of[a], *(of[b] for b in links[a])])
        if of == before:
            break
    return {i: (len(links[i]), of[i], of[i] == i) for i in ids}


def result(spark, rows):
    frame = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)
    found = near_vectors(frame).collect()
    made = {row["vec_id"]: (row["n_links"], row["component_id"], row["kept"]) for row in found}
    assert len(made) == len(found)
    return made


def cloud(seed, n, dims=16, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 8, dims))
    points = centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, dims))
    return [(i, p.astype(float).tolist(), int(rng.integers(0, 3))) for i, p in enumerate(points)]


@pytest.mark.parametrize(("block", "spread"), [(1024, 0.05), (16, 0.05), (16, 0.2)])
def test_against_brute_force(spark, monkeypatch, block, spread):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = cloud(block, 240, spread=spread)
    assert result(spark, rows) == brute_force(rows)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, None], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [1.0, 0.0], None)]
    rows += [(7, [1.0, 0.0], 1), (8, [1e30, 1e20], 1), (9, [1e-30, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2)]
    rows += [(12, [-1.0, 0.0], 1), (13, [], 1)]
    assert result(spark, [*rows, (7, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]) == brute_force(rows)
    assert result(spark, []) == {}


def test_one_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 32)
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(200)]
    assert result(spark, rows) == {i: (199, 0, i == 0) for i in range(200)}


def test_traversal_drops_no_pair():
    rng = np.random.default_rng(1)
    for spread in (0.02, 0.1, 1.0):
        base = rng.normal(size=(10, 6))
        points = base[rng.integers(0, 10, 90)] + spread * rng.normal(size=(90, 6))
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        a, b = points[:50], points[50:]
        found = set(zip(*(x.tolist() for x in linked_pairs(CoverTree(a), CoverTree(b), 0.9)), strict=True))
        assert found == set(zip(*(x.tolist() for x in np.nonzero(a @ b.T >= 0.9)), strict=True))
