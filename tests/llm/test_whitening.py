import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.queries import QUERIES
from tidemark.llm.topk import scaled
from tidemark.llm.whitening import leading_components, leading_eigenvalues, sturm_counts, tridiagonal, whiten


def _symmetric(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * values) @ q.T


SPECTRA = [
    [9, 7, 4, 2, 1, 0.5], [5, 5, 5, 1, 1, 0], [3, 3 - 1e-9, 3 - 2e-9, 3 - 1e-4, 1, 1], [1] * 6, [1e12, 1e3, 1, 1, 1e-3, 0],
    [2], [2, 1], [1, 1, 0], list(np.linspace(1, 50, 40)),
]


@pytest.mark.parametrize("values", SPECTRA)
def test_components(values):
    a = _symmetric(np.random.default_rng(len(values)), np.array(values, float))
    found, vectors = leading_components((a + a.T) / 2, 4)
    want = np.sort(values)[::-1][:4]
    want = want[want > 1e-12 * sum(values)]
    assert found == pytest.approx(want, rel=1e-12, abs=1e-13 * max(values))
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * found).max() < 1e-12 * max(values) * len(values)


def test_tridiagonal_matrices():
    for a in (np.diag([3.0, 1, 2, 2]), np.zeros((4, 4)), np.ones((5, 5)), np.eye(3)):
        found, vectors = leading_components(a, 4)
        want = np.linalg.eigvalsh(a)[::-1][:4]
        assert found == pytest.approx(want[want > 1e-9])
        assert np.abs(a @ vectors - vectors * found).max(initial=0) < 1e-12
    diagonal, off, _ = tridiagonal(_symmetric(np.random.default_rng(1), np.arange(1.0, 9)))
    assert sturm_counts(diagonal, off, np.array([0.5, 3.5, 9])).tolist() == [0, 3, 8]
    assert leading_eigenvalues(diagonal, off, 8) == pytest.approx(np.arange(8, 0, -1))


def _check(rows, found, k=4):
    """Against numpy's own solver; components of equal eigenvalues are not compared entry by entry."""
    x = {i: np.array(v, dtype=object) for i, v in rows if v is not None}
    fit = np.array(sorted({tuple(v) for v in x.values()}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit.astype(float) - (sums / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    white = {}
    for r in found:
        away = n * x[r["vec_id"]] - sums
        assert (r["n"], r["deviation"]) == (n, int((away * away).sum()))
        assert r["identity_error"] <= 1e-4
        j = r["component"] - 1
        assert r["explained"] == pytest.approx(values[j] / np.trace(centred.T @ centred / n), rel=1e-9)
        white.setdefault(j, {})[r["vec_id"]] = r["whitened"]
    for j, by_id in white.items():
        want = {i: float((v - sums / n).astype(float) @ vectors[:, j]) / np.sqrt(values[j]) for i, v in x.items()}
        same = max(abs(by_id[i] - want[i]) for i in want)
        turned = max(abs(by_id[i] + want[i]) for i in want)
        assert set(by_id) == set(want) and min(same, turned) < 1e-7
    return white


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    spread = rng.standard_normal((300, 6)) * [90, 50, 30, 10, 5, 1] @ rng.standard_normal((6, 6))
    rows = [(i, [int(e) for e in v]) for i, v in enumerate(spread)] + [(400 + i, [5, 4, 3, 2, 1, 0]) for i in range(150)] + [(900, None)]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, vector array<long>, x double").repartition(5)
    found = whiten(df).collect()
    assert len(found) == 4 * 450 and len(_check(rows, found)) == 4


def test_large_entries(spark):
    rows = [(i, [(1 << 40) + i * i, -(1 << 40) * i, 7]) for i in range(20)]
    found = whiten(spark.createDataFrame(rows, "vec_id long, vector array<long>")).collect()
    n, s = 20, np.array([v for _, v in rows], dtype=object).sum(axis=0)
    for r in found:
        exact = int(((n * np.array(rows[r["vec_id"]][1], dtype=object) - s) ** 2).sum())
        assert r["deviation"] == (exact if exact < 1 << 63 else None)
    assert {r["component"] for r in found} == {1}  # the other direction is below a trillionth


def test_defined_cases(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, vector array<long>")
    assert whiten(make([])).collect() == []
    assert whiten(make([(1, [3, 4]), (2, [3, 4]), (3, None), (4, [])])).collect() == []  # no variance
    found = whiten(make([(1, [0, 0]), (1, [0, 0]), (None, [2, 0]), (4, [1]), (5, [1, 0])])).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["n"], r["deviation"], abs(round(r["whitened"], 6))) for r in found) == [
        (0, 1, 3, 9, 1.224745), (1, 1, 3, 9, 1.224745), (1, 1, 3, 9, 1.224745), (5, 1, 3, 0, 0.0)]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", scaled(F.col("embedding")).alias("v")).collect()
    found = QUERIES["op13_whitening"](spark, folder).collect()
    assert len(found) == 4 * len(rows)
    _check([tuple(r) for r in rows], found)
