import math
import random

import numpy as np
import pytest

from ruleweave.llm import qd
from ruleweave.llm import queries as Q
from ruleweave.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<float>, x string, component int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "n") for i, v in rows], SCHEMA)


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def check(rows, got, k=16):
    """Compare with eigenvectors of the covariance; eigenvalues must be apart."""
    kept = [(i, v) for i, v in rows if usable(v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(c * n - s) / n for c, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, int((values > values[0] * 1e-12).sum()))
    assert len(got) == len(kept) * k
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    error = got[0].identity_error
    assert 0 <= error <= 1e-4
    for (i, _), v in zip(kept, x):
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        white = np.array([(c * n - s) / n for c, s in zip(v, sums)]) @ vectors[:, :k] / np.sqrt(values[:k])
        for j in range(k):
            mine = min(by[i, j + 1], key=lambda r: abs(abs(r.whitened) - abs(white[j])))
            assert (mine.n, mine.deviation, mine.identity_error) == (n, deviation, error)
            assert mine.explained == pytest.approx(values[j] / values.sum(), rel=1e-4)
            if abs(white[j]) > 1e-3:
                sign = signs.setdefault(j, np.sign(white[j] * mine.whitened))
                assert mine.whitened == pytest.approx(sign * white[j], rel=1e-6, abs=1e-9)


def vectors(rnd, n, dim):
    return [[rnd.gauss(0, 3 / (j + 1)) for j in range(dim)] for _ in range(n)]


def test_whitening_equals_eigenvectors(spark):
    rnd = random.Random(4)
    rows = list(enumerate(vectors(rnd, 300, 20)))
    rows += [(i + 500, v) for i, v in rows[:40]] + [rows[3], rows[3], (None, rows[4][1])]
    rows += [(900, None), (901, []), (902, [None] * 20), (903, [float("nan")] * 20), (904, [float("inf")] + [0.0] * 19)]
    got = W.whiten(frame(spark, rows).repartition(7)).collect()
    check(rows, got)


def test_query(spark, tmp_path):
    rows = list(enumerate(vectors(random.Random(6), 80, 18)))
    frame(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    out = Q.op12_embedding_whitening(spark, str(tmp_path))
    assert out.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
                          ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    check(rows, out.collect())


def test_few_dimensions_and_few_rows(spark):
    rnd = random.Random(5)
    check(rows := list(enumerate(vectors(rnd, 50, 3))), W.whiten(frame(spark, rows)).collect())
    check(rows := list(enumerate(vectors(rnd, 5, 30))), W.whiten(frame(spark, rows)).collect())


def test_no_variance_empty_table_other_dimensions(spark):
    assert W.whiten(frame(spark, [])).collect() == []
    assert W.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    assert W.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    rows = list(enumerate(vectors(random.Random(8), 20, 4)))
    assert W.whiten(frame(spark, rows + [(99, [1.0])])).where("vec_id = 99").count() == 0


def test_equal_eigenvalues(spark):
    """Two dimensions of equal variance: any directions of their plane, but orthogonal and of unit variance."""
    rows = [(8 * i + j, [float(2 * (j & 1)), float(j & 2), float(i)]) for i in range(5) for j in range(4)]
    got = W.whiten(frame(spark, rows)).collect()
    assert got[0].identity_error < 1e-12 and {r.component for r in got} == {1, 2, 3}


def test_factors_are_merged_in_a_tree(spark, monkeypatch):
    rows = list(enumerate(vectors(random.Random(9), 200, 5)))
    monkeypatch.setattr(W, "_MERGE", 2)
    monkeypatch.setattr(W, "_BLOCK", 20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(rows, W.whiten(frame(spark, rows)).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_deviations_are_exact_beyond_a_long():
    n = 10 ** 8
    centre = W.Centre(n, [3 * n + 1, -5])
    x = np.array([[4, 0], [10 ** 6, 2], [3, -1]])
    want = [sum((n * int(c) - s) ** 2 for c, s in zip(v, [3 * n + 1, -5])) for v in x]
    assert centre.deviations(x) == [w if w < 1 << 63 else None for w in want] and None in centre.deviations(x)


@pytest.mark.parametrize("name,matrix", [
    ("graded", np.random.default_rng(1).standard_normal((60, 30)) * 10.0 ** -np.arange(30)),
    ("wide", np.random.default_rng(2).standard_normal((200, 90))),
    ("low rank", np.random.default_rng(3).standard_normal((60, 5)) @ np.random.default_rng(4).standard_normal((5, 25))),
    ("repeated columns", np.repeat(np.random.default_rng(5).standard_normal((50, 6)), 2, axis=1)),
    ("identity", np.eye(12)),
    ("one column", np.arange(4.0)[:, None]),
])
def test_singular_values_and_vectors(name, matrix):
    r = np.linalg.qr(matrix, mode="r")
    squared, vectors, total = qd.right_singular(r, 16)
    k = len(squared)
    want = np.linalg.svd(matrix, compute_uv=False)
    assert k == min(16, int((want > want[0] * matrix.shape[1] * 8 * qd.EPS).sum()))
    assert np.allclose(squared, want[:k] ** 2, rtol=1e-11)
    assert np.isclose(total, (want ** 2).sum())
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    white = matrix @ vectors / np.sqrt(squared)
    assert np.abs(white.T @ white - np.eye(k)).max() < 1e-7


def test_glued_tridiagonal_pairs_of_close_values():
    n = 21
    t = np.diag(np.abs(np.arange(n) - n // 2) + 3.0) + np.diag(np.ones(n - 1), 1) + np.diag(np.ones(n - 1), -1)
    upper = np.linalg.cholesky(t).T
    values, vectors, _ = qd.right_singular(upper, 16)
    assert np.allclose(values, np.linalg.eigvalsh(t)[::-1][:16], rtol=1e-13)
    assert np.abs(t @ vectors - vectors * values).max() < 1e-12
