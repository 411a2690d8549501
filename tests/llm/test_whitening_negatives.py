"""Whitening against dense linear algebra, and hard negatives against all pairs, on small and odd tables."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsflow.llm import jacobi_davidson, negatives, strassen, topk, whitening
from opsflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ROWS = "vec_id long, label int, embedding array<float>"


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 70, 129), (64, 64, 64), (100, 97, 35), (200, 7, 300), (4, 0, 5), (0, 40, 50)])
def test_strassen_equals_the_plain_product(shape):
    random = np.random.default_rng(shape)
    m, k, n = shape
    for top in (3, 300, 1 << 28):
        a, b = random.integers(-top, top, (m, k)), random.integers(-top, top, (k, n))
        assert np.array_equal(strassen.product(a, b, leaf=8), a @ b)


def test_strassen_wraps_inside_but_not_outside():
    a = np.full((40, 40), 300_000_000)
    assert np.array_equal(strassen.product(a, a, leaf=4), a @ a)
    with pytest.raises(OverflowError):
        strassen.product(a * 4, a, leaf=4)


def brute(rows):
    """rows: (id, label, vector of floats); by the contract, one pair at a time."""
    fine = {(i, (lab + 1) % 10 if i % 7 == 0 else lab, tuple(math.floor(256 * float(np.float32(x))) for x in vec)) for i, lab, vec in rows
            if None not in (i, lab, vec) and None not in vec and all(map(math.isfinite, vec))}
    out = []
    for i, lab, vec in (r for r in fine if r[0] % 50 == 0):
        scored = sorted((-sum(x * y for x, y in zip(vec, v)), j, m) for j, m, v in fine if j != i and len(v) == len(vec))
        for s, j, _ in [x for x in scored if x[2] == lab][:5]:
            inside = [x for x in scored if x[2] != lab and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame(rows, ROWS).withColumn("score", F.lit("x")).withColumn("rank", F.lit(None))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    df = df.withColumn("label", label).withColumn("vector", topk.quantised(F.col("embedding"), 256))
    return sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % 50 == 0, block=2).collect())


def test_negatives_with_ties_and_a_hot_label(spark):
    random = np.random.default_rng(13)
    rows = [(i, 3 if i % 3 else int(random.integers(0, 4)), [float(x) for x in random.integers(-3, 4, 6) / 8]) for i in range(260)]
    rows += [(i, 5, [0.5] * 6) for i in range(300, 340)] + [rows[50], rows[100], (100, 2, rows[0][2]), (50, 3, [0.0] * 6)]
    assert mined(spark, rows) == brute(rows)


def test_negatives_leave_out_odd_rows(spark):
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.4]), (2, 2, [0.6, 0.5]), (3, None, [1.0, 1.0]), (None, 2, [0.6, 0.5]), (4, 2, None), (5, 2, [None, 1.0]),
            (6, 2, [float("nan"), 1.0]), (8, 2, [float("inf"), 1.0]), (9, 2, [0.6, 0.5, 0.1]), (50, 9, [1.0]), (10, 2, []), (100, 2, []), (11, 3, [])]
    assert mined(spark, rows) == brute(rows) != []
    assert mined(spark, []) == []


def test_large_components_fail_instead_of_wrapping(spark):
    huge = spark.createDataFrame([(0, 1, [1e20]), (1, 1, [1.0])], ROWS)
    with pytest.raises(Exception, match="too large"):
        huge.select(topk.quantised(F.col("embedding"), 256)).collect()
    wide = huge.select("vec_id", "label", F.array(F.lit(1 << 40)).alias("vector"))
    with pytest.raises(Exception, match="64 bits"):
        negatives.mine(wide, F.lit(True)).collect()
    with pytest.raises(Exception, match="64 bits"):
        topk.search(wide, F.lit(True), 1).collect()


def test_largest_pairs_reach_double_precision():
    random = np.random.default_rng(5)
    for size, rows, count in ((1, 5, 16), (5, 30, 16), (40, 10, 16), (64, 3000, 16), (200, 900, 12), (300, 4000, 16)):
        x = random.integers(-20, 20, (rows, size)).astype(float)
        x[:, : size // 3] *= 3
        v = (x - x.mean(0)).T @ (x - x.mean(0)) / rows
        values, axes = jacobi_davidson.largest_pairs(lambda b: v @ b, size, count)
        wanted = np.linalg.eigvalsh(v)[::-1][: len(values)]
        assert len(values) == min(size, count) and np.abs(values - wanted).max() < 1e-12 * wanted[0]
        assert np.linalg.norm(v @ axes - axes * values, axis=0).max() < 1e-13 * wanted[0]
        assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13


def test_equal_eigenvalues_are_all_found():
    values, _ = jacobi_davidson.largest_pairs(lambda b: b * np.r_[np.full(8, 2.0), np.full(92, 1.0)][:, None], 100, 10)
    assert np.allclose(values, [2] * 8 + [1] * 2, atol=1e-13)


def dense(ints, components=16):
    """n, exact deviations and whitened values of integer rows, by dense algebra on the distinct ones."""
    fit = np.unique(ints, axis=0)
    n, sums = len(fit), fit.sum(0)
    away = np.array([[float(Fraction(int(x) * n - int(s), n)) for x, s in zip(row, sums)] for row in fit])
    values, axes = np.linalg.eigh(away.T @ away / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    deviations = [sum((n * int(x) - int(s)) ** 2 for x, s in zip(row, sums)) for row in ints]
    return n, deviations, ((ints * n - sums) / n) @ axes / np.sqrt(values), values / (away**2).sum() * n


def check(got, ints, ids):
    n, deviations, whole, explained = dense(ints)
    table = {}
    for r in got:
        table.setdefault(r.vec_id, {})[r.component] = r
    assert set(table) == set(ids) and all(sorted(t) == list(range(1, whole.shape[1] + 1)) for t in table.values())
    for component in range(whole.shape[1]):
        mine = np.array([table[i][component + 1].whitened for i in ids])
        sign = 1 if mine @ whole[:, component] > 0 else -1
        assert np.abs(sign * mine - whole[:, component]).max() < 1e-8
    for i, deviation in zip(ids, deviations):
        for component, r in table[i].items():
            assert (r.n, r.deviation) == (n, deviation)
            assert r.explained == pytest.approx(explained[component - 1], rel=1e-9) and r.identity_error < 1e-9


def test_whitening_equals_dense_algebra(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    ints = np.floor(64 * np.stack(frame.embedding.tolist()).astype(float)).astype(np.int64) + 1_000_000
    check(QUERIES["op12_embedding_whitening"](spark, SF).collect(), ints, frame.vec_id.tolist())


def whitened(spark, rows, **options):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"n": F.lit("x"), "component": F.lit(None)})
    x = F.transform(topk.quantised(F.col("embedding"), 64), lambda v: v + 1_000_000)
    return whitening.whiten(vectors.withColumn("vector", x), **options).collect()


def test_whitening_of_repeated_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "VECTORS_DIRECT", 10)
    random = np.random.default_rng(3)
    rows = [(i, [float(x) for x in random.integers(-900, 900, 4) / 64]) for i in range(60)]
    good = rows + [(100 + i, rows[0][1]) for i in range(40)]
    odd = [(500, None), (501, [None, 1.0, 1.0, 1.0]), (502, [float("nan"), 1.0, 1.0, 1.0]), (503, [1.0, float("-inf"), 0.0, 0.0]), (504, [1.0]), (505, [])]
    ints = np.array([[math.floor(64 * x) + 1_000_000 for x in vec] for _, vec in good])
    check(whitened(spark, good + odd), ints, [i for i, _ in good])


def test_whitening_without_variance(spark):
    assert whitened(spark, []) == []
    assert whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)]) == []
    flat = whitened(spark, [(None, [1.0, 5.0]), (2, [2.0, 5.0]), (3, [4.0, 5.0])])
    assert {(r.vec_id, r.component, r.n) for r in flat} == {(None, 1, 3), (2, 1, 3), (3, 1, 3)}
    assert flat[0].explained == pytest.approx(1)


def test_whitening_refuses_what_does_not_fit(spark):
    wide = spark.range(9).select(F.col("id").alias("vec_id"), F.array(F.col("id") * (1 << 40), F.lit(0)).alias("vector"))
    with pytest.raises(Exception, match="64 bits"):
        whitening.whiten(wide).collect()
