import math

import numpy as np
import pytest

from shopscope.llm import whitening
from tests.conftest import SF_SMALL


def force(vectors, components=32):
    x = np.array([[math.floor(64 * float(c)) + 1000000 for c in v] for v in vectors], dtype=object)
    n = len(x)
    s = x.sum(axis=0)
    dev = [int(sum((n * a - b) ** 2 for a, b in zip(row, s))) for row in x]
    c = ((n * x - s) / n).astype(float)
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return n, dev, c @ u / np.sqrt(e), e / np.trace(v)


def held(rows, ids, vectors, components=32):
    n, dev, white, share = force(vectors, components)
    got = {(r.vec_id, r.component): r for r in rows}
    k = min(components, white.shape[1])
    assert len(rows) == n * k
    for c in range(1, k + 1):
        mine = np.array([got[i, c].whitened for i in ids])
        sign = np.sign(mine @ white[:, c - 1])
        assert np.allclose(mine, sign * white[:, c - 1], atol=1e-7)
        assert abs(got[ids[0], c].explained / share[c - 1] - 1) < 1e-6
    assert [got[i, 1].deviation for i in ids] == dev
    assert {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-6


@pytest.mark.parametrize("stripe", [whitening.STRIPE, 70])
def test_equals_force_on_a_table(spark, monkeypatch, stripe):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 64 * 8 * 16)  # many blocks
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = whitening.report(table, stripe=stripe).collect()
    given = [r for r in table.collect() if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    held(rows, [r.vec_id for r in given], [r.embedding for r in given])


def test_wide_vectors_take_several_block_columns(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 5)
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 5 * 8 * 7)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(60, 12)) * np.arange(1, 13)
    table = spark.createDataFrame([(i, [float(c) for c in v], "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, `index` string")
    held(whitening.report(table, components=6).collect(), list(range(60)), vectors.tolist(), 6)


def test_odd_input(spark):
    nan, inf = float("nan"), float("inf")
    schema = "vec_id long, embedding array<float>, row string"
    odd = [(1, None, "a"), (2, [], "a"), (3, [None, 1.0], "a"), (4, [nan, 1.0], "a"), (5, [1.0, -inf], "a"), (6, [1.0, 2.0, 3.0], "a")]
    good = [(7, [1.0, 2.0], None), (7, [1.5, -2.0], "b"), (None, [0.25, 0.5], "c"), (8, [3e38, 1.0], "d")]
    assert whitening.report(spark.createDataFrame(odd[:5], schema)).collect() == []
    assert whitening.report(spark.createDataFrame([], schema)).collect() == []
    assert whitening.report(spark.createDataFrame([(1, [1.0, 2.0], "a")] * 3, schema)).collect() == []  # no variance
    rows = whitening.report(spark.createDataFrame(odd + good[:3], schema)).collect()
    assert sorted({(r.vec_id is None, r.vec_id) for r in rows}, key=str) == [(False, 7), (True, None)] and len(rows) == 6
    assert {r.n for r in rows} == {3}
    huge = whitening.report(spark.createDataFrame(good, schema)).collect()
    assert {r.vec_id for r in huge} == {7, None, 8} and any(r.deviation is None for r in huge)
