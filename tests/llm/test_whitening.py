import math
from fractions import Fraction

import numpy as np
import pytest

from wattloom.llm.queries import op12_whitening
from wattloom.llm.spectrum import count_above, leading
from wattloom.llm.whitening import whiten

SF_DIR = "/root/testdata/sf0.01"


def symmetric(eigenvalues, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(eigenvalues),) * 2))
    return (q * np.array(eigenvalues)) @ q.T


@pytest.mark.parametrize("values", [
    [5, 4, 3, 2, 1], [5, 5, 5, 1, 0.5], [3, 3 - 1e-9, 1, 0], [1, 1e-3, 1e-6, 1e-9, 1e-12], [2, 2], [7], [4, 0, 0], [1e12, 1, 1, 1], list(range(40, 0, -1)),
])
def test_leading_eigenpairs(values):
    matrix = symmetric([float(v) for v in values], len(values))
    found, vectors = leading(matrix, 4)
    wanted = sorted((v for v in values if v > len(values) * 2**-50 * sum(values)), reverse=True)[:4]
    assert len(found) == len(wanted) and np.abs(found - wanted).max() < 1e-13 * max(values) * len(values)
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-13
    assert np.abs(matrix @ vectors.T - vectors.T * found).max() < 1e-13 * max(values)


def test_counts_follow_the_law_of_inertia():
    draw = np.random.default_rng(3)
    for n in (1, 2, 7, 30):
        a = draw.standard_normal((n, n))
        a = a + a.T
        np.fill_diagonal(a, 0.0)  # pivots of two rows are needed
        values = np.linalg.eigvalsh(a)
        for shift in draw.uniform(values[0] - 1, values[-1] + 1, 20):
            assert count_above(a, shift) == (values > shift).sum()
    assert count_above(np.zeros((3, 3)), 0.0) == 0 and leading(np.zeros((3, 3)), 2)[0].tolist() == []


def brute(rows, k=4):
    """The contract with numpy's own eigenvectors: per row the exact deviation and the whitened values up to sign."""
    usable = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in usable}))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    y = fit - np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[: min(k, int((values > 1e-9).sum()))]
    out = {}
    for i, x in usable:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        centred = np.array([float(a - Fraction(s, n)) for a, s in zip(x, sums)])
        out.setdefault(i, []).append((n, deviation, [float(centred @ vectors[:, j] / np.sqrt(values[j])) for j in order]))
    return out, [float(values[j] / values.sum()) for j in order]


def check(frame, rows):
    wanted, explained = brute(rows)
    found = frame.collect()
    assert len(found) == len(explained) * sum(map(len, wanted.values()))
    signs = {}
    for component in range(1, len(explained) + 1):
        mine = [r for r in found if r.component == component]
        largest = max(mine, key=lambda r: abs(r.whitened))
        signs[component] = math.copysign(1, largest.whitened) * math.copysign(1, wanted[largest.vec_id][0][2][component - 1])
    for r in found:
        n, deviation, white = wanted[r.vec_id][0]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.whitened * signs[r.component] == pytest.approx(white[r.component - 1], abs=1e-9)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-10) and r.identity_error < 1e-9


def test_query_equals_brute_force(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(op12_whitening(spark, SF_DIR), [tuple(r) for r in vectors])


def test_odd_rows(spark):
    draw = np.random.default_rng(5)
    good = [(i, [float(c) for c in draw.normal(0, 1 + np.arange(3))]) for i in range(60)]
    copies = [(i, good[0][1]) for i in range(100, 140)] + [(7, good[7][1]), (None, good[1][1])]
    bad = [(200, None), (201, [1.0, None, 2.0]), (202, [1.0, math.nan, 2.0]), (203, [math.inf, 0.0, 0.0]), (204, []), (205, [1.0, 2.0]), (206, [1e300, 0.0, 0.0])]
    docs = spark.createDataFrame(good + copies + bad, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS x", "2 AS n", "3 AS component").repartition(7)
    check(whiten(docs), good + copies)


def test_entries_that_need_long_arithmetic(spark):
    rows = [(i, [float(2**40 * (i % 5)), float(i)]) for i in range(30)]
    found = whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    wanted, _ = brute(rows)
    assert {r.deviation for r in found} == {None if d >= 2**63 else d for x in wanted.values() for _, d, _ in x}


def test_no_variance_and_empty_tables(spark):
    same = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(9)], "vec_id bigint, embedding array<float>")
    assert whiten(same).collect() == [] and whiten(same.limit(0)).collect() == []
    line = whiten(spark.createDataFrame([(i, [float(i), 0.0]) for i in range(9)], "vec_id bigint, embedding array<float>")).collect()
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1)
