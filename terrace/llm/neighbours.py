"""Quality by nearest labelled neighbours in a latent-semantic space.

Terms are pairs of neighbouring characters in 48 classes, weighted by log count and rarity, with a few
terms for words that repeat. A bounded sample of labelled texts gives the term matrix; its leading
singular vectors span the latent space. Each text is projected, its cosines to all sample vectors are
exact blocked matrix products, and the labels of the nearest are averaged by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.arrays import slices, utf8, words

#: Labelled rows that are fitted on, latent dimensions, neighbours that vote, texts in a block of products.
SAMPLE, DIMENSIONS, NEIGHBOURS, BLOCK = 2_000, 32, 9, 512
CLASSES = 48
#: Steps in which the shares of repeated and of doubled words become terms, and the weight of such a term.
STEPS, STEP_WEIGHT = 10, 12.0


def class_table() -> np.ndarray:
    """Byte to class: 26 letters, capitals, digits, space, line end, 15 marks of their own, other ASCII, two for other bytes."""
    table = np.full(256, 45)
    table[0x61:0x7B] = np.arange(26)
    table[0x41:0x5B] = 26
    table[0x30:0x3A] = 27
    table[[0x20, 0x09]] = 28
    table[[0x0A, 0x0D]] = 29
    table[list(b".,!?|#$%&*\"'-=<")] = np.arange(30, 45)
    table[0x80:0xC0] = 46
    table[0xC0:] = 47
    return table.astype(np.int64)


CLASS = class_table()
TERMS = CLASSES * CLASSES + 2 * STEPS


def term_counts(texts: pa.Array) -> np.ndarray:
    """Weighted term counts, a row a text: 1 + log of the count of each pair, and the repetition terms."""
    data, offsets = utf8(texts)
    n, sizes = len(texts), np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    kinds = CLASS[data]
    pairs = kinds[:-1] * CLASSES + kinds[1:]
    inside = owner[:-1] == owner[1:]
    flat = np.bincount((owner[:-1] * TERMS + pairs)[inside], minlength=n * TERMS)
    out = np.log1p(flat.reshape(n, TERMS)).astype(np.float32)
    flat_words, counts = words(texts)
    has = np.flatnonzero(counts > 0)
    if len(has):
        codes = flat_words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        of = np.repeat(np.arange(n), counts)
        distinct = np.bincount(np.unique(of * (codes.max() + 1) + codes) // (codes.max() + 1), minlength=n)
        doubled = np.bincount(of[1:][(of[1:] == of[:-1]) & (codes[1:] == codes[:-1])], minlength=n)
        again = 1 - distinct[has] / counts[has]
        for k, share in enumerate((again, doubled[has] / counts[has])):
            step = np.minimum((share * STEPS).astype(np.int64), STEPS - 1)
            out[has, CLASSES * CLASSES + k * STEPS + step] = STEP_WEIGHT
    return out


@dataclass
class Model:
    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        return unit(unit(counts * self.rarity) @ self.axes)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """From 0 to 1; a text without terms gets the mean label."""
        mean = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(len(counts), mean)
        k = min(neighbours, len(self.labels))
        for at in range(0, len(counts) if k else 0, BLOCK):
            near = self.project(counts[at : at + BLOCK]) @ self.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, best, axis=1), 0.0).astype(np.float64)
            total = weight.sum(axis=1)
            votes = (weight * self.labels[best]).sum(axis=1)
            some = total > 1e-9
            out[at : at + BLOCK][some] = votes[some] / total[some]
        return np.clip(out, 0.0, 1.0)


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def fit(counts: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    """Latent axes of the weighted term matrix, by the eigenvectors of its rows' products."""
    if not len(counts):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    held = (counts > 0).sum(axis=0)
    # squared, since pairs that every text has would outweigh the telling ones
    rarity = ((np.log((1 + len(counts)) / (1 + held)) + 1) ** 2).astype(np.float32)
    weighted = unit(counts * rarity)
    values, sides = np.linalg.eigh((weighted @ weighted.T).astype(np.float64))
    top = np.argsort(-values)[:dimensions]
    top = top[values[top] > 1e-9]
    axes = (weighted.T @ sides[:, top] / np.sqrt(values[top])).astype(np.float32)
    return Model(rarity, axes, unit(weighted @ axes), labels.astype(np.float64))


def sample_rows(docs: DataFrame, labels: DataFrame, key: str, label: str, text: str, size: int) -> DataFrame:
    """``key``, ``label`` and ``text`` of ``size`` labelled documents at most, drawn by a hash of the key.

    A document with several labels takes the smallest; those without a label, or of a key that is null, are not drawn.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.min(label).alias("__label"))
    drawn = known.orderBy(F.xxhash64(F.lit("sample"), key), key).limit(size)
    # at most ``size`` rows, so they may be sent to all tasks
    return docs.select(F.col(key), F.col(text).cast("string").alias("text")).join(F.broadcast(drawn), key)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text", size: int = SAMPLE) -> Model:
    """A model of ``size`` labelled rows at most; only their term counts reach the driver.

    Of several texts under one key the smallest is learned; a null text counts as empty.
    """
    rows = sample_rows(docs, labels, key, label, text, size)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = term_counts(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array([c.tobytes() for c in counts], pa.binary())], ["key", "label", "counts"]
            )

    # one text a key, so that no more than ``size`` rows reach the driver
    drawn = F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), F.col("__label").cast("double").alias("label"))).alias("one")
    got = rows.groupBy(F.col(key).alias("key")).agg(drawn).select("key", "one.label", "one.text")
    found = sorted(got.mapInArrow(run, f"key {kind}, label double, counts binary").collect(), key=lambda r: r["key"])
    counts = np.array([np.frombuffer(r["counts"], dtype=np.float32) for r in found]).reshape(len(found), TERMS)
    return fit(counts, np.array([r["label"] for r in found]))


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", neighbours: int = NEIGHBOURS) -> DataFrame:
    """``key`` and ``score`` of every document; null and empty texts get the mean label. Extra columns are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            # bounded rows too: short texts have a wide row each
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                score = shared.value.score(term_counts(part.column("text")), neighbours)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(score)], ["key", "score"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
