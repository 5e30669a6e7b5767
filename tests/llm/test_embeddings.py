import numpy as np
import pytest

from tests.llm.helpers import clashing
from veil.llm import crosspolytope as cp


def brute(rows):
    sound = {k: np.array(v, float) for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {k: set() for k in range(len(rows))}
    for a, x in sound.items():
        for b, y in sound.items():
            if a != b and len(x) == len(y) and (x / np.linalg.norm(x)) @ (y / np.linalg.norm(y)) >= 0.9:
                links[a].add(b)
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, others in links.items():
        for b in others:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(links[k]), least.get(find(k)), i == least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def clusters(rng, count, size, dim, spread):
    out = []
    for _ in range(count):
        c = rng.normal(size=dim)
        c /= np.linalg.norm(c)
        out += [(c + spread * rng.normal(size=dim) / np.sqrt(dim)).tolist() for _ in range(size)]
    return out


@pytest.mark.parametrize("block", [4096, 7])
def test_matches_brute_force(spark, block):
    rng = np.random.default_rng(2)
    vectors = clusters(rng, 30, 12, 24, 0.3) + clusters(rng, 1, 60, 24, 0.05) + clusters(rng, 100, 1, 24, 1)
    rows = list(enumerate(vectors)) + [(5000 + k, vectors[3]) for k in range(40)]
    rows += [(6000, None), (6001, []), (6002, [0.0] * 24), (6003, [None] + [1.0] * 23), (6004, [float("nan")] * 24), (6005, [float("inf")] + [1.0] * 23), (6006, vectors[5][:12]), (6006, vectors[5][:12]), (6007, (np.array(vectors[9]) * 1e-30).tolist()), (None, vectors[7])]
    df = clashing(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = cp.near_vectors(df, block=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    n = 2000
    x = cp.unit(rng.normal(size=(n, 64)))
    z = rng.normal(size=(n, 64))
    z = cp.unit(z - (z * x).sum(1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    k = cp.hashes_for(50_000, 64)
    signs = cp.rotations(64, cp.TABLES * k)
    a, b = cp.hash_codes(x, signs, k), cp.hash_codes(y, signs, k)
    hit = ((a[:, :, :1] == b).any(-1) | (b[:, :, :1] == a).any(-1)).any(1)
    assert k == 2 and hit.mean() > 0.98


def test_rotations_keep_lengths():
    x = np.random.default_rng(0).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(cp.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(cp.hadamard(cp.hadamard(x)), x)
    assert np.isfinite(cp.unit(np.array([[1e300, 1e300], [1e-320, 0]]))).all()


def test_empty_table(spark):
    assert cp.near_vectors(clashing(spark.createDataFrame([], "vec_id bigint, embedding array<float>"))).count() == 0


@pytest.mark.parametrize(("dim", "k"), [(16, 3), (16, 4), (32, 3), (32, 4), (64, 3), (64, 4), (128, 3), (128, 4)])
def test_recall_stays_as_hashes_grow(dim, k):
    x, y = cp.pairs_at(0.9, dim, 2000, 77)
    signs = cp.rotations(dim, cp.tables_for(k, dim) * k)
    a, b = cp.hash_codes(x, signs, k), cp.hash_codes(y, signs, k)
    hit = ((a[:, :, :1] == b).any(-1) | (b[:, :, :1] == a).any(-1)).any(1)
    assert hit.mean() > 0.98
