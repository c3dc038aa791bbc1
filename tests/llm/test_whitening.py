import math
import random

import numpy as np
import pytest

from tidepanel.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x long, split string, matrix double"


@pytest.fixture
def embeddings(frame):
    def make(vectors, ids=None, parts=3):
        ids = range(len(vectors)) if ids is None else ids
        return frame([(i, v, 1, 2, "a", 0.5) for i, v in zip(ids, vectors)], SCHEMA, parts)
    return make


def plain(vectors):
    """x, n, deviations, eigenvalues and whitened coordinates by plain linear algebra, in whole numbers as long as possible."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    fit = [list(r) for r in {tuple(r) for r in x}]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(r, sums)) for r in x]
    centred = np.array([[(n * a - b) / n for a, b in zip(r, sums)] for r in fit])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    rows = np.array([[(n * a - b) / n for a, b in zip(r, sums)] for r in x])
    return n, deviation, e, rows @ v / np.sqrt(np.maximum(e, 1e-300))


def collected(out, k):
    rows = sorted(out.collect(), key=lambda r: (r.vec_id, r.component))
    return {r.vec_id: rows[i * k:(i + 1) * k] for i, r in enumerate(rows[::k])}


def test_against_plain_algebra(embeddings, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_CELLS", 20 * 7)  # many blocks, and blocks of unequal length
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(20, 20))
    vectors = (rng.normal(size=(150, 20)) @ mix).astype("f4").tolist()
    vectors += vectors[:10] * 3 + [vectors[5]] * 200  # copies, and one vector that most rows have
    out, model = whitening.whiten(embeddings(vectors, parts=5))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    n, deviation, e, white = plain(vectors)
    got = collected(out, 16)
    assert len(got) == len(vectors) and n == 150 == model["n"]
    mine = np.array([[r.whitened for r in got[i]] for i in range(len(vectors))])
    sign = np.sign((mine * white[:, :16]).sum(axis=0))
    assert np.abs(mine * sign - white[:, :16]).max() < 1e-9
    for i, rows in got.items():
        assert [r.component for r in rows] == list(range(1, 17)) and {r.n for r in rows} == {150}
        assert {r.deviation for r in rows} == {deviation[i]}
        assert all(abs(r.explained - e[j] / e.sum()) < 1e-12 and 0 <= r.identity_error < 1e-9 for j, r in enumerate(rows))
    back = model["vectors"][:, :16] * np.sqrt(model["values"][:16])
    assert np.abs(back.T @ model["whitening"] - np.eye(16)).max() < 1e-9


def test_odd_vectors(embeddings):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0, None, 2.0], [nan, 1.0, 2.0], [1.0, inf, 2.0], [1.0, -inf, 0.0], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0], [1e38, 0.0, 0.0]]
    rng = random.Random(1)
    good = [[rng.gauss(0, 3), rng.gauss(0, 1), 0.25] for _ in range(40)]
    got = collected(whitening.whiten(embeddings(odd + good, ids=[*range(1000, 1000 + len(odd)), *range(len(good))]))[0], 3)
    assert sorted(got) == list(range(len(good)))
    assert all(r[2].whitened is None and r[2].explained < 1e-12 and r[0].whitened is not None for r in got.values())  # the last component has no variance
    big = collected(whitening.whiten(embeddings([[1e12, 0.0], [-1e12, 5.0], [3.0, -5.0]]))[0], 2)
    n, deviation, _, _ = plain([[1e12, 0.0], [-1e12, 5.0], [3.0, -5.0]])
    assert [big[i][0].deviation for i in range(3)] == [d if d < 1 << 63 else None for d in deviation]


def test_few_rows(embeddings):
    assert whitening.whiten(embeddings([]))[0].count() == 0
    assert whitening.whiten(embeddings([None, []]))[0].count() == 0
    out = whitening.whiten(embeddings([[1.0, 2.0]] * 4, ids=[None, 1, 1, 2]))[0].collect()
    assert len(out) == 8 and all(r.whitened is None and r.deviation == 0 and r.n == 1 and r.identity_error == 0 for r in out)
