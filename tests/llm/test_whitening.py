"""Whitening against NumPy's eigenvalues, on given, odd and degenerate vectors."""

import math

import numpy as np
import pytest

from runtrail.llm import whitening
from runtrail.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain(rows, k=16):
    """Of (id, vector): the usable rows, and per row what each component gives, up to its sign."""
    fine = [(i, [math.floor(64 * float(c)) + 1000000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in fine})
    n, s = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[n * a - b for a, b in zip(x, s)] for x in distinct], float) / n
    v = centred.T @ centred / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:k], axes[:, ::-1][:, :k]
    out = {}
    for i, x in fine:
        d = [n * a - b for a, b in zip(x, s)]
        out.setdefault(i, []).append((n, sum(t * t for t in d), (np.array(d, float) / n) @ axes / np.sqrt(e)))
    return out, e / np.trace(v)


def compare(found, rows, k=16):
    want, explained = plain(rows, k)
    mine = {}
    for r in found:
        mine.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert set(mine) == set(want)
    sign = {}
    for i, own in want.items():
        assert sorted(mine[i]) == list(range(1, len(explained) + 1))
        for j in range(len(explained)):
            got = mine[i][j + 1]
            assert len(got) == len(own)
            assert sorted(r.deviation for r in got) == sorted(d for _, d, _ in own)
            for r, (n, _, w) in zip(sorted(got, key=lambda r: r.deviation), sorted(own, key=lambda o: o[1])):
                assert r.n == n and abs(r.explained - explained[j]) < 1e-9 * explained[j] and r.identity_error < 1e-8
                if abs(w[j]) > 1e-3:
                    sign.setdefault(j, np.sign(r.whitened * w[j]))
                    assert abs(r.whitened * sign[j] - w[j]) < 1e-6 * max(1, abs(w[j]))


def test_query_equals_numpy(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(QUERIES["op13_whitening"](spark, SMALL).collect(), rows)


@pytest.fixture(scope="module")
def odd():
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=20) * np.arange(1, 21) + 500).tolist()) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(400, 520)] + [rows[3], rows[3]]  # a hot vector, repeated rows
    bad = [(600, None), (601, []), (602, [None] * 20), (603, [float("nan")] * 20), (604, [float("-inf")] * 20), (605, [1e300] * 20),
           (606, [1.0, 2.0])]
    return rows, bad


def test_odd_rows(spark, odd):
    rows, bad = odd
    frame = spark.createDataFrame([(i, v, i) for i, v in rows + bad], "vec_id long, embedding array<double>, component long").repartition(5)
    found = whitening.whiten(frame).collect()
    compare(found, rows)
    assert not {r.vec_id for r in found} & {i for i, _ in bad}
    nameless = frame.where("vec_id < 40").selectExpr("CAST(NULL AS LONG) AS vec_id", "embedding")
    assert {r.vec_id for r in whitening.whiten(nameless, k=2).collect()} == {None}


def test_degenerate_tables(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten(frame([])).count() == 0
    assert whitening.whiten(frame([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    line = whitening.whiten(frame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)])).collect()
    assert {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 for r in line)
    assert abs(sum(r.whitened**2 for r in line) / 9 - 1) < 1e-9


def test_sums_beyond_long_stay_exact():
    x = np.array([[2**41, -5], [7, 2**41]])
    fit = whitening.Fit(1 << 40, (3, 4))
    assert fit.numerators(x).tolist() == [[int(v) * fit.n - s for v, s in zip(r, fit.sums)] for r in x.tolist()]
    assert fit.deviations(x) == [None, None]
    assert whitening.Fit(2, (1, 2)).deviations(np.array([[3, 4]])) == [25 + 36]


@pytest.mark.parametrize("kind", ["random", "clustered", "equal", "diagonal", "banded", "tiny"])
def test_components_are_eigenvectors(kind):
    rng = np.random.default_rng(11)
    n = 40
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    values = {
        "random": np.sort(rng.uniform(0.1, 9, n)), "clustered": np.r_[np.linspace(0.1, 1, n - 12), 5 + 1e-9 * np.arange(12)],
        "equal": np.r_[np.ones(n - 6), np.full(6, 3.0)], "diagonal": np.arange(1.0, n + 1), "banded": None, "tiny": np.geomspace(1e-30, 1e-20, n),
    }[kind]
    if kind == "diagonal":
        matrix = np.diag(values)
    elif kind == "banded":
        matrix = np.diag(np.full(n, 2.0)) - np.diag(np.ones(n - 1), 1) - np.diag(np.ones(n - 1), -1)
        values = np.linalg.eigvalsh(matrix)
    else:
        matrix = q @ np.diag(values) @ q.T
        matrix = (matrix + matrix.T) / 2
    found = whitening.principal_components(matrix, 16)
    k = len(found.values)
    top = np.sort(values)[::-1][:k]
    assert k == 16 or kind == "tiny"
    assert np.allclose(found.values, top, rtol=0, atol=1e-13 * top[0])
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(k), atol=1e-12)
    assert np.abs(matrix @ found.vectors - found.vectors * found.values).max() < 1e-13 * 40 * top[0]
