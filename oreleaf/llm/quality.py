"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes counts of its byte pairs (hashed) and of its repeated words, word pairs and
lines. A bounded sample of labelled texts (`SAMPLE`, in the order of a hash of the id) gives
weights of the terms and, by a truncated decomposition, a basis of `DIMENSIONS` latent dimensions. The
basis and the labelled vectors are at most a few MB and are broadcast. Every document is
projected and compared with all labelled vectors in blocks of exact cosine products; its `NEIGHBOURS`
nearest vote with their labels, weighted by similarity.

Only the text enters a score. Rows whose crc32 of the id is 0 modulo `folds` never train.
Defined results: a null text is the empty one; texts that resemble no labelled one at all
(empty ones too) get the share of label 1 in the sample, 0.5 if nothing is labelled;
several labels of one id are averaged; of several texts of one labelled id the smallest trains; null ids
count as held out; repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreleaf.llm.common import slices, text_or_empty

SAMPLE = 4096
DIMENSIONS = 32
NEIGHBOURS = 15
SHARPNESS = 8  # power of the similarity as a vote's weight
FOLDS = 5
CUTOFF = 0.3
TERMS = 4096
PAIR_TERMS = 4088  # the others count words and lines
BLOCK = 256


def counted(text: bytes) -> np.ndarray:
    """Term counts of a text."""
    counts = np.zeros(TERMS, np.float32)
    lower = text.lower()
    codes = np.frombuffer(lower, np.uint8).astype(np.uint32)
    for at in range(0, len(codes) - 1, 1 << 20):
        part = codes[at : at + (1 << 20) + 1]
        pairs = ((part[:-1] << 8 | part[1:]) * np.uint32(2654435761)) >> np.uint32(16)
        counts[:PAIR_TERMS] += np.bincount(pairs % PAIR_TERMS, minlength=PAIR_TERMS)
    words = lower.split()
    following = list(zip(words, words[1:]))
    lines = [line for line in text.split(b"\n") if line.strip()]
    distinct = len(set(words))
    counts[PAIR_TERMS:] = (
        sum(a == b for a, b in following), len(words) - distinct, distinct, len(following) - len(set(following)),
        len(lower) / 3, len(words), len(lines) - len(set(lines)), len(lines),
    )
    return counts


@dataclass
class Model:
    """Weighted basis (terms x dimensions), labelled unit vectors and their labels."""

    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def scores(self, counts: np.ndarray) -> np.ndarray:
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(len(counts), prior)
        if not len(self.labels):
            return out
        near = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(counts), BLOCK):
            latent = _unit(np.sqrt(counts[at : at + BLOCK]) @ self.basis)
            cosine = np.clip(latent @ self.vectors.T, 0, 1)
            best = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
            votes = np.take_along_axis(cosine, best, 1).astype(np.float64) ** SHARPNESS
            total = votes.sum(axis=1)
            out[at : at + BLOCK] = np.where(total > 0, (votes * self.labels[best]).sum(axis=1) / np.maximum(total, 1e-300), prior)
        return out.clip(0, 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fitted(counts: np.ndarray, labels: np.ndarray) -> Model:
    """Basis by a randomised truncated decomposition of the weighted sample."""
    if not len(counts):
        return Model(np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    weights = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    rows = _unit(np.sqrt(counts) * weights)
    width = min(DIMENSIONS + 16, *rows.shape)
    range_ = rows @ np.random.default_rng(0).standard_normal((TERMS, width)).astype(np.float32)
    for _ in range(4):
        range_ = rows @ (rows.T @ np.linalg.qr(range_)[0])
    _, _, axes = np.linalg.svd(np.linalg.qr(range_)[0].T @ rows, full_matrices=False)
    basis = (axes[:DIMENSIONS].T * weights[:, None]).astype(np.float32)
    return Model(basis, _unit(np.sqrt(counts) @ basis).astype(np.float32), labels)


def held_out(id_col: str, folds: int = FOLDS):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Model from at most `sample` labelled ids; their term counts, sparse, are all that reaches the driver."""
    chosen = (
        labels.where(~held_out(id_col) & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.avg(label_col).alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(sample)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                rows = [counted(text) for text in batch.column("_text").cast(pa.binary()).to_pylist()]
                terms = [np.flatnonzero(row).astype("<u2") for row in rows]
                values = [row[at].tobytes() for row, at in zip(rows, terms)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t.tobytes() for t in terms]), pa.array(values)], ["label", "terms", "values"])

    texts = (
        docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
        .join(F.broadcast(chosen), F.col(id_col) == F.col("_id"))  # at most `sample` ids
        .groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    )
    found = texts.select("_label", "_text").mapInArrow(run, "label double, terms binary, values binary").collect()
    counts = np.zeros((len(found), TERMS), np.float32)
    for row, sparse in zip(counts, found):
        row[np.frombuffer(sparse["terms"], "<u2")] = np.frombuffer(sparse["values"], np.float32)
    names = np.array([row["label"] for row in found], np.float64)
    order = np.lexsort((*counts[:, -8:].T, names)) if len(found) else []
    return fitted(counts[order], names[order])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs` and `score` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text", 2 << 20):
                texts = batch.column("_text").cast(pa.binary()).to_pylist()
                found = [sent.value.scores(np.array([counted(text) for text in texts[at : at + BLOCK]])) for at in range(0, len(texts), BLOCK)]
                kept = batch.drop_columns(["_text"])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(np.concatenate(found))], [*kept.schema.names, "_score"])

    names = docs.columns
    given = docs.select(*(F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate(names)), text_or_empty(text_col).alias("_text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema if f.name != "_text")
    scored = given.mapInArrow(run, f"{fields}, _score double")
    return scored.select(*(F.col(f"c{k}").alias(n) for k, n in enumerate(names) if n != "score"), F.col("_score").alias("score"))
