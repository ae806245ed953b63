"""Whitening against double and extended precision solvers, and on awkward vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridegauge.llm import whitening
from ridegauge.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def whole(rows):
    return {
        i: [math.floor(1024 * float(c)) + 100_000 for c in v]
        for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)
    }


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    xs = whole(rows)
    n, sums = len(xs), [sum(column) for column in zip(*xs.values())]
    centred = {i: np.array([float(n * x - s) / n for x, s in zip(v, sums)]) for i, v in xs.items()}
    matrix = np.array(list(centred.values()))
    values, axes = np.linalg.eigh(matrix.T @ matrix / n)
    got = QUERIES["op13_mixed_precision_whitening"](spark, SF).collect()
    assert len(got) == 8 * n
    signs = {}
    for r in got:
        k = len(values) - r.component
        assert r.n == n and r.deviation == sum((n * x - s) ** 2 for x, s in zip(xs[r.vec_id], sums))
        assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert 0 <= r.identity_error < 1e-9
        plain = centred[r.vec_id] @ axes[:, k] / math.sqrt(values[k])
        if abs(plain) > 0.1:
            sign = signs.setdefault(r.component, math.copysign(1, plain * r.whitened))
            assert r.whitened * sign == pytest.approx(plain, rel=1e-7)
    assert set(signs) == set(range(1, 9))


def spectrum(values, seed=4):
    axes = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0].astype(np.longdouble)
    for _ in range(4):
        axes = axes + axes @ (np.eye(len(values)) - axes.T @ axes) / 2
    return np.asarray((axes * np.array(values, np.longdouble)) @ axes.T, np.float64), axes


@pytest.mark.parametrize("values", [
    [5.0, 3.0, 2.0, 1.0, 0.5],
    [9.0, 1 + 1e-7, 1.0, 1 - 1e-7, 0.1, 1e-6],
    [4.0, 4.0, 4.0, 2.0, 2.0, 1.0, 0.0],
    [1e6, 1.0, 1.0 - 1e-9, 1e-5, 1e-5 + 1e-13],
    [3.0] * 6,
    list(np.linspace(1, 2, 40)) + [1.5 + 1e-8 * i for i in range(1, 9)],
])
def test_refinement(values):
    matrix, axes = spectrum(values)
    got, found = whitening.eigen(matrix)
    ordered = np.sort(values)[::-1]
    assert got == pytest.approx(ordered, abs=4e-15 * max(values))
    assert np.abs(found.T @ found - np.eye(len(values))).max() < 1e-15 * 8
    assert np.abs(matrix @ found - found * got).max() < 1e-15 * 20 * max(values)
    for i, value in enumerate(ordered):  # the axis of a lone value, however near the others are
        gap = min(abs(value - other) for j, other in enumerate(ordered) if j != i)
        if gap > 1e-10 * max(values):
            own = np.asarray(axes[:, int(np.argmax(np.array(values) == value))], np.float64)
            assert 1 - abs(own @ found[:, i]) < (4e-15 * max(values) / gap) ** 2 + 1e-14


@pytest.mark.parametrize("shape", [(3, 5, 4), (40, 64, 7), (1, 1, 1), (20, 1000, 20)])
def test_product_is_that_of_whole_numbers(shape):
    draw = np.random.default_rng(2)
    a = draw.integers(-(2**30), 2**30, shape[:2]).astype(np.longdouble) * 2.0 ** draw.integers(-20, 20, (shape[0], 1))
    b = draw.integers(-(2**30), 2**30, shape[1:]).astype(np.longdouble)
    exact = np.array(a * 2.0**20, object) @ np.array(b, object)
    got = whitening.product(a, b) * 2.0**20
    small = np.abs(a * 2.0**20) @ np.abs(b)
    assert (np.abs(got - exact.astype(np.longdouble)) <= small * 2.0**-58).all()
    assert (whitening.product(np.zeros_like(a), b) == 0).all()


def test_refinement_improves_on_its_start():
    matrix, _ = spectrum([7.0, 3.0, 2.9999, 1.0])
    low = np.linalg.eigh(matrix.astype(np.float32))[1].astype(np.float64)
    rough = np.abs(low.T @ matrix @ low - np.diag(np.diag(low.T @ matrix @ low))).max()
    _, fine = whitening.refined(matrix, low)
    fine = np.asarray(fine, np.float64)
    left = fine.T @ matrix @ fine
    assert np.abs(left - np.diag(np.diag(left))).max() < 1e-6 * rough


def test_awkward(spark):
    good = [(i, [float(a) for a in v]) for i, v in enumerate(np.random.default_rng(1).normal(size=(30, 3)))]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [math.nan, 1.0, 1.0]), (104, [math.inf, 0.0, 0.0]),
           (105, [1.0, 2.0]), (None, good[0][1]), (3, good[3][1]), (3, good[3][1])]
    rows = spark.createDataFrame(good + bad, SCHEMA)
    for name in ("component", "n", "place", "key", "whitened", "deviation", "line", "entries", "length"):
        rows = rows.withColumn(name, F.lit("x"))
    got = whitening.components_of(rows, 8).collect()
    assert len(got) == 33 * 3 and {r.vec_id for r in got} == {None, *range(30)}
    assert {r.n for r in got} == {33} and max(r.identity_error for r in got) < 1e-9
    again = {r.whitened for r in got if r.vec_id == 3 and r.component == 1}
    assert len(again) == 1 and len([r for r in got if r.vec_id == 3]) == 9
    assert whitening.components_of(rows, 2).count() == 33 * 2


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [0.5, -1.0]) for i in range(5)]])
def test_nothing_to_whiten(spark, rows):
    got = whitening.components_of(spark.createDataFrame(rows, SCHEMA), 8)
    assert got.collect() == []
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_huge_entries_and_flat_dimensions(spark):
    rows = [(i, [1e30 if i % 2 else -1e30, 1.0, float(i)]) for i in range(8)]
    got = whitening.components_of(spark.createDataFrame(rows, SCHEMA), 8).collect()
    assert {r.component for r in got} == {1} and {r.deviation for r in got} == {None}
    flat = [(i, [float(i), 7.0, float(i % 3)]) for i in range(9)]
    got = whitening.components_of(spark.createDataFrame(flat, SCHEMA), 8).collect()
    assert {r.component for r in got} == {1, 2} and max(r.identity_error for r in got) < 1e-9


def test_sums_beyond_64_bits(spark):
    rows = spark.range(40_000).selectExpr("id AS vec_id", "array(3e11D, 1D) AS embedding")
    n, sums = whitening.sums(rows)
    assert n == 40_000 and sums == [n * ((1 << 48) + 100_000), n * 101_024]
