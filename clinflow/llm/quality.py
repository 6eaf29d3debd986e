"""Quality classifier: a vote of the nearest labelled documents in a latent-semantic space.

A document is a bag of hashed features of its words (the word, its shape, its ending) and of how much it
repeats itself. On a bounded sample of labelled rows the bags are weighted by inverse document frequency
and cut down to ``dimensions`` by a singular value decomposition; the sample's vectors and the projection
are broadcast. Every document is projected, its cosine with every labelled vector is computed exactly, block by
block, and the ``neighbours`` nearest vote with weights that grow with the cosine. One narrow pass over the
documents, no shuffle of texts.

Defined results: a NULL or empty text has no direction, so all labelled vectors vote alike and its score is their
share of label 1; without any labelled row every score is 0.5. Repeated rows get the same score each, as do rows without doc_id,
of which none is learnt from or held out. Of labelled rows that repeat a doc_id the sample takes one, the same in every run. Among
labelled vectors equally near as the last neighbour any may vote. Texts of any length are counted whole. An empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clinflow.llm.labelled import labelled_sample
from clinflow.llm.text import held_out, in_slices

_CACHED_WORDS = 200_000
_BLOCK = 256


@dataclass(frozen=True)
class QualitySettings:
    """``sample``: labelled rows learnt from, at most. The model's size follows from these numbers alone."""

    sample: int = 4096
    features: int = 4096
    dimensions: int = 64
    neighbours: int = 25
    sharpness: int = 4
    threshold: float = 0.7


class WordFeatures(dict):
    """word -> ids of its hashed features; forgets all when it grows too large."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        bare = word.strip("\"'().,;:!?").lower()
        shape = re.sub(r"(.)\1+", r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word))
        names = ("w" + bare, "s" + shape, "e" + word[-2:])
        ids = self[word] = tuple(crc32(name.encode()) % self.size for name in names)
        return ids


def _level(share: float) -> int:
    return int(share * 10)


def bags(texts: Iterable[str | None], size: int, words: WordFeatures) -> np.ndarray:
    """One row of damped feature counts per text."""
    texts = list(texts)
    rows: list[int] = []
    weights: list[int] = []
    for i, text in enumerate(texts):
        counts = Counter((text or "").split())
        total = sum(counts.values())
        if not total:
            continue
        base = i * size
        for word, n in counts.items():
            for feature in words[word]:
                rows.append(base + feature)
                weights.append(n)
        # How much the document repeats itself, and how much of it is its most frequent word.
        for name in (f"=distinct{_level(len(counts) / total)}", f"=top{_level(max(counts.values()) / total)}"):
            rows.append(base + crc32(name.encode()) % size)
            weights.append(total)
    filled = np.bincount(np.array(rows, np.int64), np.array(weights, float), len(texts) * size)
    return np.log1p(filled.astype(np.float32)).reshape(len(texts), size)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


@dataclass
class QualityModel:
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    settings: QualitySettings

    def project(self, filled: np.ndarray) -> np.ndarray:
        return unit(unit(filled * self.idf) @ self.projection)

    def scores(self, filled: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(filled), 0.5)
        out = np.empty(len(filled))
        k = min(self.settings.neighbours, len(self.labels))
        for start in range(0, len(filled), _BLOCK):
            vectors = self.project(filled[start : start + _BLOCK])
            cosines = vectors @ self.vectors.T
            nearest = np.argpartition(cosines, -k, axis=1)[:, -k:]
            weights = np.clip(np.take_along_axis(cosines, nearest, 1), 0, None).astype(float) ** self.settings.sharpness
            total = weights.sum(axis=1)
            votes = (weights * self.labels[nearest]).sum(axis=1)
            share = np.divide(votes, total, out=np.full(len(total), self.labels.mean()), where=total > 1e-12)
            out[start : start + _BLOCK] = np.clip(share, 0, 1)
        return out


def fit(docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings(), label: str = "quality") -> QualityModel:
    """Learn from the sample only: bags are made by tasks, the decomposition of at most ``sample`` rows on the driver."""
    size = settings.features

    def bagged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordFeatures(size)
        for batch in in_slices(batches):
            filled = bags(batch.column("text").to_pylist(), size, words)
            ids = [np.flatnonzero(row) for row in filled]
            columns = [batch.column("doc_id"), batch.column("y"), pa.array(ids, pa.list_(pa.int32())), pa.array([row[i] for row, i in zip(filled, ids)], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "y", "ids", "counts"])

    sample = labelled_sample(docs, labels, label, settings.sample)
    id_type = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(bagged, f"doc_id {id_type}, y int, ids array<int>, counts array<float>").toArrow().sort_by("doc_id")
    filled = np.zeros((rows.num_rows, size), np.float32)
    for i, (ids, counts) in enumerate(zip(rows["ids"].to_pylist(), rows["counts"].to_pylist())):
        filled[i, ids] = counts
    y = np.array(rows["y"].to_pylist(), float)
    idf = np.log((1 + len(y)) / (1 + (filled > 0).sum(axis=0))).astype(np.float32) + 1
    projection = _components(unit(filled * idf), settings.dimensions)
    model = QualityModel(idf, projection, np.zeros((0, projection.shape[1]), np.float32), y, settings)
    if len(y):
        model.vectors = model.project(filled)
    return model


def _components(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    k = max(1, min(dimensions, *rows.shape)) if len(rows) else 1
    basis = np.random.default_rng(7).standard_normal((rows.shape[1], min(k + 16, rows.shape[1]))).astype(np.float32)
    for _ in range(6 if len(rows) else 0):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    if len(rows):
        _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
        basis = basis @ turn.T
    return np.ascontiguousarray(basis[:, :k])


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words = WordFeatures(model.settings.features)
        for batch in in_slices(batches):
            scores = model.scores(bags(batch.column("text").to_pylist(), model.settings.features, words))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {id_type}, score double")
    predicted = (F.col("score") >= model.settings.threshold).cast("int")
    return found.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))
