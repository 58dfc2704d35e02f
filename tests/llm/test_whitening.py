import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening
from tidemark.llm.whitening import below, eigen, tridiagonal, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, components=16):
    """{(vec_id, x): (n, deviation, {component: (|whitened|, explained)})} with numpy's own eigenvectors."""
    xs = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted(set(x for _, x in xs))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    centred = np.array([[c - s / n for c, s in zip(x, sums, strict=True)] for x in distinct])
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    out = []
    for i, x in xs:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        z = np.array([c - s / n for c, s in zip(x, sums, strict=True)]) @ q / np.sqrt(np.maximum(e, 1e-30))
        out += [(i, k + 1, n, deviation, z[k], e[k] / np.trace(v)) for k in range(len(e)) if e[k] > 1e-9 * e[0]]
    return sorted(out, key=lambda r: (r[0] is None, r[:4]))


def compare(spark, rows, components=16):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    df = df.withColumns({x: F.lit("x") for x in ("x", "vector", "n", "component", "whitened", "rest")})
    got = sorted((tuple(r) for r in whiten(df, components=components).collect()), key=lambda r: (r[0] is None, r[:4]))
    expected = brute(rows, components)
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    signs = {}
    for g, x in zip(got, expected, strict=True):
        if abs(x[4]) > 1e-3:
            signs.setdefault(x[1], np.sign(g[4] * x[4]))
        assert g[4] * signs.get(x[1], 1) == pytest.approx(x[4], abs=1e-7)
        assert g[5] == pytest.approx(x[5], rel=1e-6) and g[6] < 1e-9
    assert len({r[6] for r in got}) <= 1
    return got


def points(seed, n, dims):
    r = np.random.default_rng(seed)
    mix = r.normal(size=(dims, dims)) * np.linspace(3, 0.2, dims)
    return [(int(i), [float(c) for c in r.normal(size=dims) @ mix + 5]) for i in range(n)]


def test_equals_numpy(spark):
    compare(spark, points(1, 400, 24))


def test_repeated_vectors_count_once_and_rows_stay(spark):
    rows = points(2, 60, 5)
    rows = rows + [(i + 1000, v) for i, v in rows[:20]] + [rows[0], rows[0], (None, rows[3][1])]
    assert len(compare(spark, rows)) == len(rows) * 5


def test_unsound_vectors_are_left_out(spark):
    rows = points(3, 50, 4)
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0]), (903, [float("nan"), 1.0, 1.0, 1.0]), (904, [float("inf")] * 4), (905, [3e38] * 4)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + odd + [(906, [1.0] * 7)]], SCHEMA)
    assert {r["vec_id"] for r in whiten(df).select("vec_id").collect()} == {i for i, _ in rows}


def test_few_vectors_have_few_components(spark):
    assert {r[1] for r in compare(spark, points(4, 3, 8))} == {1, 2}
    one = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)
    assert whiten(one).collect() == []
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert len(compare(spark, [(1, [0.5]), (2, [-4.0]), (3, [9.0])])) == 3


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 0.0])]
    got = whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    assert {r["deviation"] for r in got} == {None} and all(abs(abs(r["whitened"]) - 1) < 1e-9 for r in got)


def test_real_vectors(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    random.Random(1).shuffle(rows)
    compare(spark, rows)


def sturm(v, k):
    d, e, _ = tridiagonal(v)
    return whitening.leading(d, e, k)


@pytest.mark.parametrize("values", [[5, 5, 5, 2, 2, 1], [9, 3, 3 + 1e-9, 3 - 1e-9, 0, 0, 0], [1e8, 1, 1e-6], [7] * 8, list(range(40)), [4, 0]])
def test_eigen(values):
    r = np.random.default_rng(len(values))
    q, _ = np.linalg.qr(r.normal(size=(len(values), len(values))))
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    e, x = eigen(v, len(values))
    top = max(values)
    assert np.allclose(e, sorted(values, reverse=True), atol=1e-13 * top * len(values))
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-10
    assert np.abs(v @ x - x * e).max() < 1e-12 * top * len(values)


def test_block_and_diagonal_matrices():
    for v in (np.diag([3.0, 1.0, 2.0, 2.0]), np.kron(np.eye(4), [[2.0, 1.0], [1.0, 2.0]]), np.zeros((3, 3)), np.ones((5, 5))):
        e, x = eigen(v, len(v))
        assert np.abs(v @ x - x * e).max() < 1e-12 and np.allclose(x.T @ x, np.eye(len(v)), atol=1e-10)


def test_sturm_counts():
    r = np.random.default_rng(0)
    d, e = r.normal(size=30), r.normal(size=29)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.concatenate([values - 1e-9, values + 1e-9])
    assert (below(d, e, at) == [(values < x).sum() for x in at]).all()
