"""Whitened components against numpy's eigenvectors of the covariance."""

import math

import numpy as np
import pytest

from terrace.llm import whitening
from terrace.llm.queries import QUERIES


def plain(rows, components=16):
    """rows: (key, vector). Fit list, exact deviations, whitened values up to sign, explained."""
    kept = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    whole = [tuple(math.floor(64 * c) + 1_000_000 for c in v) for _, v in kept]
    once = sorted(set(whole))
    n, sums = len(once), [sum(c) for c in zip(*once)]
    x = np.array([[n * a - s for a, s in zip(v, sums)] for v in once], dtype=float) / n
    values, vectors = np.linalg.eigh(x.T @ x / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for (key, _), v in zip(kept, whole):
        far = [n * a - s for a, s in zip(v, sums)]
        white = (np.array(far, dtype=float) / n) @ vectors / np.sqrt(values)
        out += [(key, c + 1, n, sum(f * f for f in far), white[c], values[c] / np.trace(x.T @ x / n)) for c in range(len(values))]
    return out


def same(found, want):
    by = lambda r: (str(r[0]), r[1], r[3])
    found, want = sorted(found, key=by), sorted(want, key=by)
    assert [r[:4] for r in found] == [r[:4] for r in want]
    signs: dict = {}
    for f, w in zip(found, want):
        if abs(w[4]) > 1e-6:
            assert signs.setdefault(f[1], math.copysign(1, f[4] * w[4])) == math.copysign(1, f[4] * w[4])
        assert abs(abs(f[4]) - abs(w[4])) < 1e-7 and f[5] == pytest.approx(w[5], rel=1e-9)
        assert f[6] <= 1e-9


def vectors(n=400, d=24, seed=1):
    draw = np.random.default_rng(seed)
    return draw.standard_normal((n, d)) @ np.diag(np.linspace(3, 0.3, d)) + draw.standard_normal(d)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_against_eigh(spark):
    base = [(k, [float(c) for c in np.float32(v)], 1) for k, v in enumerate(vectors())]
    odd = [(900, None, 1), (901, [*base[0][1][:-1], None], 1), (902, [*base[0][1][:-1], math.nan], 1), (903, [*base[0][1][:-1], math.inf], None), (904, [], 1), (905, [1.0], 1)]
    rows = base + odd + base[:5] + [(None, base[7][1], 2)]
    found = [tuple(r) for r in whitening.whiten(frame(spark, rows)).collect()]
    same(found, plain([(k, v) for k, v, _ in rows if k not in (904, 905)]))


@pytest.mark.parametrize("d", [1, 3, 16, 40, 100])
def test_dimensions(spark, d):
    base = [(k, [float(c) for c in np.float32(v)], 1) for k, v in enumerate(vectors(150, d, d))]
    same([tuple(r) for r in whitening.whiten(frame(spark, base)).collect()], plain([(k, v) for k, v, _ in base]))


def test_more_dimensions_than_vectors(spark):
    base = [(k, [float(c) for c in np.float32(v)], 1) for k, v in enumerate(vectors(6, 40))]
    found = [tuple(r) for r in whitening.whiten(frame(spark, base)).collect()]
    assert {r[1] for r in found} == {1, 2, 3, 4, 5}
    same(found, plain([(k, v) for k, v, _ in base], 5))


def test_no_spread(spark):
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None, 1)])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None, 1)]).limit(0)).count() == 0


def test_clashing_columns_and_large_entries(spark):
    base = [(k, [float(c) for c in v], k) for k, v in enumerate(vectors(50, 4))] + [(99, [1e30, 0.0, 0.0, 0.0], 1)]
    docs = spark.createDataFrame(base, "vec_id long, embedding array<double>, x int").selectExpr("*", "vec_id AS key", "x AS n", "x AS component")
    found = whitening.whiten(docs)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert found.count() == 50 * 4


def test_whole_numbers_beyond_64_bits():
    import pyarrow as pa

    x = pa.array([[1 << 40, 5], [0, 7]], pa.list_(pa.int64()))
    whole = whitening.differences(x, 1 << 30, [1 << 60, 12])
    assert whole.tolist() == [[(1 << 70) - (1 << 60), (5 << 30) - 12], [-(1 << 60), (7 << 30) - 12]]
    assert whitening.squares(whole).to_pylist() == [None, None]


def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    same([tuple(r) for r in QUERIES["op13_whitening"](spark, sf).collect()], plain(rows))
