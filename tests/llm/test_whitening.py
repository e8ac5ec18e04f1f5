"""Whitening against a dense eigendecomposition with exact sums."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebeacon.llm import whitening
from casebeacon.llm.queries import QUERIES

SMALL = os.environ.get("TEST_SMALL_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, k=4):
    """{(vec_id, component): [n, deviation, whitened, explained]} of (vec_id, vector), and the covariance."""
    kept = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, float) - mean
    covariance = centred.T @ centred / n
    e, v = np.linalg.eigh(covariance)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    out = {}
    for i, x in kept:
        z = (np.array(x, float) - mean) @ v / np.sqrt(e)
        for c in range(len(e)):
            out.setdefault((i, c + 1), []).append((n, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), z[c], e[c] / np.trace(covariance)))
    return out


def same(got, want, k=4):
    assert len(got) == sum(map(len, want.values()))
    turn = {}
    for c in range(1, k + 1):
        a, b = (np.array([r.whitened for r in sorted((r for r in got if r.component == c), key=lambda r: (r.vec_id or -1, r.deviation))]), None)
        b = np.array([z for _, z in sorted(((i or -1, x[1]), x[2]) for (i, d), xs in want.items() if d == c for x in xs)])
        turn[c] = 1 if abs(a - b).max() < abs(a + b).max() else -1
        assert np.abs(a * turn[c] - b).max() < 1e-9
    for r in got:
        x = want[r.vec_id, r.component][0]
        assert r.n == x[0] and r.identity_error < 1e-9 and abs(r.explained / x[3] - 1) < 1e-9
    assert sorted((r.vec_id or -1, r.component, r.deviation) for r in got) == sorted((i or -1, c, x[1]) for (i, c), xs in want.items() for x in xs)


def test_equals_a_dense_decomposition(spark):
    rng = np.random.default_rng(3)
    spread = np.concatenate([[3, 2.5, 2, 1.5, 1.4], np.linspace(1.2, 0.1, 35)])
    vectors = ((rng.standard_normal((800, 40)) * spread) @ np.linalg.qr(rng.standard_normal((40, 40)))[0]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(900 + i, rows[0][1]) for i in range(300)]  # copies count once in the fit
    rows += [(None, rows[5][1]), (7, rows[7][1])]
    odd = [(2000, None), (2001, []), (2002, [None] * 40), (2003, [float("nan")] + [0.0] * 39), (2004, [float("-inf")] + [0.0] * 39)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows + odd], SCHEMA).withColumn("x", F.lit("clash")).withColumn("component", F.lit(1)).repartition(3)
    got = whitening.whiten(frame)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    same(got.collect(), by_hand(rows))


def test_hard_spectra():
    """Close and equal eigenvalues, and a leading vector that the first block can hardly see."""
    rng = np.random.default_rng(4)
    turn = np.linalg.qr(rng.standard_normal((120, 120)))[0]
    for values in (np.linspace(1, 0.9, 120), np.concatenate([np.ones(60), np.full(60, 0.1)]), np.concatenate([[5, 4, 3.0000001, 3], np.linspace(2.9, 0, 116)]), np.concatenate([[1], np.zeros(119)])):
        values = np.sort(values)[::-1]
        matrix = (turn * values) @ turn.T
        e, v, size = whitening.leading(lambda q, m=matrix: m @ q, 120, 4, float(values.sum()))
        assert np.abs(e - values[:4]).max() < 1e-12 * max(1, values[0]) and size.max() <= whitening.SETTLED
        assert np.abs(v @ v.T - np.eye(4)).max() < 1e-12


def test_a_missed_vector_is_found_by_the_probe():
    rng = np.random.default_rng(5)
    values = np.concatenate([[10.0], np.linspace(5, 0.1, 59)])
    matrix = np.diag(values)
    q = np.eye(60)[:, 1:17]
    residual = matrix @ q - q * values[1:17]
    assert not whitening._certified(lambda b: matrix @ b, values[1:17], q, residual, 4, rng)
    q = np.eye(60)[:, :16]
    assert whitening._certified(lambda b: matrix @ b, values[:16], q, matrix @ q - q * values[:16], 4, rng)


def test_few_vectors_and_dimensions(spark):
    make = lambda rows: spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert whitening.whiten(make([])).collect() == []
    assert whitening.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []  # no spread, no component
    line = [(i, [i / 7, 2 * i / 7]) for i in range(9)]
    assert {r.component for r in whitening.whiten(make([(1, [0.0, 0.0]), (2, [1.0, 1.0])])).collect()} == {1}
    same(whitening.whiten(make(line + [(20, [1.0, -1.0])])).collect(), by_hand(line + [(20, [1.0, -1.0])]), 2)
    with pytest.raises(ValueError):
        whitening.whiten(make([(1, [1.0]), (2, [1.0, 2.0])])).collect()


def test_exact_deviations_of_large_entries(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-3e6, 3e6) for _ in range(3)]) for i in range(50)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = {i: [int(np.floor(256 * c)) for c in v] for i, v in rows}
    sums = [sum(v[d] for v in x.values()) for d in range(3)]
    exact = {i: sum((50 * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in x.items()}
    assert any(v > 2**62 for v in exact.values()) and all(r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 2**63 else None) for r in got)
    huge = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])]
    assert {r.deviation for r in whitening.whiten(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()} == {None, 1024**2 + (3 * 512 - 768) ** 2}


def test_the_query_on_a_whole_table(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    same(QUERIES["op13_whitening"](spark, SMALL).collect(), by_hand(rows))
