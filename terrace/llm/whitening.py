"""Whitened principal components of integer vectors by Chebyshev-filtered subspace iteration.

The covariance is never formed. A block of directions Q goes through passes XᵀXQ over the centred
vectors: each task multiplies its rows, Spark adds the products up entry by entry, and the driver holds
``dimensions x block`` numbers whatever the table's size. A filter of degree k is the Chebyshev
polynomial of the covariance by its three-term recurrence, scaled so that the unwanted part of the
spectrum stays below one while the wanted directions grow. QR and a Rayleigh-Ritz step follow each
filter, until the residuals of the wanted pairs certify them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.arrays import SLICE_BYTES
from terrace.session import discard, scratch_path, write_table

COMPONENTS, DEGREE, MAX_FILTERS = 16, 10, 60
#: The block has so many directions for each component asked for.
BLOCK_FACTOR = 3
#: Residuals relative to the largest eigenvalue: below the first a pair is certified at once, above the second never.
CERTIFIED, ACCEPTED = 1e-14, 1e-9
#: Entries from this size on are taken for non-finite: their whole numbers would not fit 64 bits.
LARGEST = 2.0**50
#: Eigenvalues below this share of the trace are none: the vectors do not span so many directions.
RANK = 1e-12
SCALE, SHIFT = 64, 1_000_000
SEED = 42


def integer_vectors(rows: DataFrame, vector: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``rows`` with ``x``, the entries as whole numbers; rows of null vectors, or with null or non-finite entries, are left out.

    Empty vectors and those of another length than the most frequent one (of equally frequent ones the
    longest) are left out as well.
    """
    entries = F.col(vector).cast("array<double>")
    sound = F.forall(entries, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < LARGEST), F.lit(False)))
    kept = rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0)).filter(sound)
    lengths = kept.groupBy(F.size(vector).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    usual = lengths.agg(F.max_by("n", F.struct("rows", "n"))).first()[0]
    if usual is not None:
        kept = kept.filter(F.size(vector) == usual)
    return kept.withColumn("x", F.transform(entries, lambda e: F.floor(e * scale).cast("long") + shift))


class Fit:
    """The distinct vectors of a table in the shared folder, with their number and sums."""

    def __init__(self, vectors: DataFrame):
        spark = vectors.sparkSession
        self.path = scratch_path(spark, "whiten-fit")
        self.rows = write_table(vectors.select("x").distinct(), self.path)
        self.n = self.rows.count()
        sums = self.rows.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
        self.sums = [int(r.s) for r in sums.orderBy("d").collect()]

    def product(self, q: np.ndarray) -> np.ndarray:
        """The covariance times ``q``."""
        n = self.n
        return self.gathered(lambda x: x.T @ (x @ q) / n, q.shape)

    def trace(self) -> float:
        n = self.n
        return float(self.gathered(lambda x: np.full((1, 1), (x * x).sum() / n), (1, 1))[0, 0])

    def gathered(self, of, shape: tuple[int, int]) -> np.ndarray:
        """The sum over all vectors of ``of(rows)``, an array of ``shape``, added up by entry on the executors."""
        n, sums = self.n, self.sums

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for x in centred(batches, n, sums):
                total += of(x)
            values = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["entry", "value"])

        added = self.rows.mapInArrow(run, "entry int, value double").groupBy("entry").agg(F.sum("value").alias("value"))
        out = np.zeros(shape[0] * shape[1])
        for r in added.collect():
            out[r.entry] = r.value
        return out.reshape(shape)


def centred(batches: Iterator[pa.RecordBatch], n: int, sums: list[int]) -> Iterator[np.ndarray]:
    """The vectors of each batch less their mean, in blocks of bounded size; the difference is taken in whole numbers."""
    rows = max(1, SLICE_BYTES // (8 * max(len(sums), 1)))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield (differences(batch.slice(at, rows).column("x"), n, sums) / n).astype(np.float64)


def differences(vectors: pa.ListArray, n: int, sums: list[int]) -> np.ndarray:
    """``n`` times each vector less the sums, exact; as Python's whole numbers where 64 bits would not hold them."""
    x = np.asarray(vectors.flatten(), dtype=np.int64).reshape(len(vectors), len(sums))
    most = max([abs(s) for s in sums], default=0) + n * int(np.abs(x).max(initial=0))
    if most < 1 << 62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def squares(whole: np.ndarray) -> pa.Array:
    """The exact sum of squares of each row; null where 64 bits do not hold it."""
    if int(np.abs(whole).max(initial=0)) ** 2 * whole.shape[1] < 1 << 63:
        return pa.array((whole * whole).sum(axis=1).astype(np.int64))
    sums = [sum(int(v) * int(v) for v in row) for row in whole]
    return pa.array([v if v < 1 << 63 else None for v in sums], pa.int64())


def filtered(fit: Fit, q: np.ndarray, high: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of the covariance applied to ``q``: below one on [0, high], scaled to one at ``top``."""
    middle = half = high / 2
    sigma = first = half / (middle - top)
    before, now = q, (fit.product(q) - middle * q) * (sigma / half)
    for _ in range(DEGREE - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, 2 * (after / half) * (fit.product(now) - middle * now) - sigma * after * before
        sigma = after
    return now


def principal(fit: Fit, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of the covariance, falling, and their unit vectors as columns.

    As many as ``wanted``, or as the vectors span if that is less. Raises if a residual stays above ``ACCEPTED``.
    """
    d = len(fit.sums)
    total = fit.trace() if fit.n > 1 else 0.0
    if total <= 0:
        return np.zeros(0), np.zeros((d, 0))
    k = min(wanted, d)
    block = min(d, BLOCK_FACTOR * k)
    q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, block)))[0]
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    for _ in range(MAX_FILTERS):
        image = fit.product(q)
        small = q.T @ image
        values, turned = np.linalg.eigh((small + small.T) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        q, image = q @ turned, image @ turned
        worst = float(np.linalg.norm(image[:, :k] - q[:, :k] * values[:k], axis=0).max() / values[0])
        stalled = best is not None and worst > best[0] / 2 and best[0] <= ACCEPTED
        if best is None or worst < best[0]:
            best = worst, values[:k], q[:, :k]
        if worst <= CERTIFIED or stalled:
            break
        # a block of all directions spans everything: the next step only rounds
        low = values[-1] if block < d else values[-1] / 2
        q = np.linalg.qr(filtered(fit, q, max(low, values[0] * 1e-12), values[0]) if block < d else q)[0]
    if best is None or best[0] > ACCEPTED:
        raise RuntimeError(f"the components are not certified: residual {best and best[0]:.2g}")
    spanned = int((best[1] > RANK * total).sum())
    return best[1][:spanned], best[2][:, :spanned]


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``key``, ``component`` from 1, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``, a row for each vector and component.

    Fitted on the distinct integer vectors, applied to every row with a sound vector. ``deviation`` is null
    where 64 bits do not hold it. Components that the vectors do not span are left out, so a table without
    two different vectors has no rows. Null keys and repeated rows are kept, extra columns left out.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    out = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    vectors = integer_vectors(rows.select(F.col(key).alias("key"), F.col(vector).alias("__vector")), "__vector").select("key", "x")
    fit = Fit(vectors)
    values, directions = principal(fit, components) if fit.n else (np.zeros(0), np.zeros((0, 0)))
    if not len(values):
        discard(spark, fit.path)
        return spark.createDataFrame([], out).withColumnRenamed("key", key)
    onto = directions / np.sqrt(values)
    n, sums, k = fit.n, fit.sums, len(values)
    error = float(np.abs(fit.gathered(lambda x: (x @ onto).T @ (x @ onto) / n, (k, k)) - np.eye(k)).max())
    explained = values / fit.trace()
    discard(spark, fit.path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(1, SLICE_BYTES // (8 * max(len(sums), k * 4)))
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                m = part.num_rows
                whole = differences(part.column("x"), n, sums)
                deviation = squares(whole)
                white = (whole / n).astype(np.float64) @ onto
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key").take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, dtype=np.int64)),
                        deviation.take(pa.array(each)),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.mapInArrow(run, out).withColumnRenamed("key", key)
