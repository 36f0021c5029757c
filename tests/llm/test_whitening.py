"""Whitening against numpy's eigenvectors."""

import math
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import types as T

from weft.llm import whitening
from weft.llm.common import stored

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("x", T.StringType()),
    T.StructField("component", T.StringType()), T.StructField("a.b", T.StringType()),
])


def table(spark, rows):
    return stored(spark.createDataFrame([(*r, "p", "q", "r") for r in rows], SCHEMA).repartition(3), "test-embeddings")


def check(rows, got, top=4, scale=256, distinct_values=True):
    """All columns against dense algebra over the fit list; component signs are free."""
    clean = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in clean})
    n, x = len(fit), np.array(fit, np.float64)
    sums = [sum(c) for c in zip(*fit)]
    centred = x - x.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1].T
    k = min(top, int((values > 1e-14 * values[0]).sum()))
    per = defaultdict(list)
    for r in got:
        per[r["component"]].append(r)
    assert sorted(per) == list(range(1, k + 1)) and len(got) == k * len(clean)
    ids = [i for i, _ in clean]
    want_deviation = sorted(((i is None, i or 0), Decimal(sum((n * c - s) ** 2 for c, s in zip(v, sums)))) for i, v in clean)
    for j in range(1, k + 1):
        assert sorted(((r["vec_id"] is None, r["vec_id"] or 0), r["deviation"]) for r in per[j]) == want_deviation
        assert all(r["n"] == n and r["identity_error"] <= 1e-4 for r in per[j])
        assert per[j][0]["explained"] == pytest.approx(values[j - 1] / values.sum(), rel=1e-9)
        if distinct_values and len(set(ids)) == len(ids):
            w = {r["vec_id"]: r["whitened"] for r in per[j]}
            have = np.array([w[i] for i in ids])
            want = (np.array([v for _, v in clean], np.float64) - x.mean(0)) @ vectors[j - 1] / np.sqrt(values[j - 1])
            want *= np.sign(have[np.abs(want).argmax()] * want[np.abs(want).argmax()])
            assert np.allclose(have, want, atol=1e-7)


def test_random_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 16)) @ rng.standard_normal((16, 16)) * 0.2
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(1000 + i, [float(c) for c in x[0]]) for i in range(150)]
    check(rows, whitening.whiten(table(spark, rows)).collect())


def test_flat_spectrum_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((400, 24)) * 0.1)]
    odd = [(None, rows[3][1]), (7, rows[7][1]), (900, None), (901, []), (902, [None] + rows[0][1][1:]), (903, [math.inf] + rows[0][1][1:]), (904, [math.nan] * 24)]
    check(rows + odd, whitening.whiten(table(spark, rows + odd + [(905, [1.0, 2.0])])).collect())


def test_equal_eigenvalues_and_few_dimensions(spark):
    corners = [[(a, b, c)[j] / 2 for j in range(3)] for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)]
    rows = list(enumerate(corners))
    check(rows, whitening.whiten(table(spark, rows)).collect(), distinct_values=False)


def test_low_rank(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(a), float(a), 0.0, float(b), float(-b)]) for i, (a, b) in enumerate(rng.integers(-5, 6, (60, 2)))]
    check(rows, whitening.whiten(table(spark, rows)).collect())


def test_an_early_end_is_exact(spark):
    """A steep spectrum needs far fewer steps than dimensions."""
    rng, passes = np.random.default_rng(6), []
    x = rng.standard_normal((500, 60)) * 0.6 ** np.arange(60) * 40
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    keep = whitening._Centred.sums
    try:
        whitening._Centred.sums = lambda self, f: passes.append(1) or keep(self, f)
        check(rows, whitening.whiten(table(spark, rows)).collect())
    finally:
        whitening._Centred.sums = keep
    assert len(passes) < 45


def test_deviation_beyond_64_bits(spark):
    rows = [(i, [float(3e8 * (i - 2)), float(i * i), 1.0]) for i in range(6)]
    check(rows, whitening.whiten(table(spark, rows), scale=4096).collect(), scale=4096)


def test_no_variance(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, None)])).count() == 0
