"""Quality classifier: similarity-weighted votes of the nearest labelled documents in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueloom.llm.common import as_bytes, as_list, hash_sample, pieces_of

# Terms of a document: trigrams of byte classes folded to _SHAPES buckets, its
# lower-cased words hashed to _WORDS buckets, and one of _REPEATS levels of how
# many of its words are new to it.
_LETTER, _CAPITAL, _DIGIT, _SPACE, _BREAK, _HIGH, _OTHER = range(7)
_MARKS = b".,;:!?'\"-()[]{}<>|#$%&*/=_@+~^`\\"
_CLASSES = 64
_SHAPES = 4096
_WORDS = 4096
_REPEATS = 16
TERMS = _SHAPES + _WORDS + _REPEATS

#: Labelled documents that are fitted and broadcast.
TRAINING_ROWS = 2000
LATENT = 48
NEIGHBOURS = 25
EVEN = 0.5

# Rows that are widened to single precision at a time.
_BLOCK = 256


def _class_table() -> np.ndarray:
    classes = np.full(256, _OTHER, np.int64)
    classes[ord("a") : ord("z") + 1] = _LETTER
    classes[ord("A") : ord("Z") + 1] = _CAPITAL
    classes[ord("0") : ord("9") + 1] = _DIGIT
    classes[128:] = _HIGH
    classes[[9, 11, 12, 32]] = _SPACE
    classes[[10, 13]] = _BREAK
    classes[list(_MARKS)] = _OTHER + 1 + np.arange(len(_MARKS))
    return classes


_CLASS_OF = _class_table()
_FOLD = np.arange(_CLASSES**3, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(52)
_SHAPE_OF = _FOLD.astype(np.int64) % _SHAPES


def terms(text: bytes | None) -> np.ndarray:
    """Term weights of a whole text: square roots of frequencies. All zero but the repeat level if it has no words."""
    text = text or b""
    weights = np.zeros(TERMS, np.float32)
    classes = _CLASS_OF[np.frombuffer(text, np.uint8)]
    if len(classes) > 2:
        shapes = _SHAPE_OF[(classes[:-2] * _CLASSES + classes[1:-1]) * _CLASSES + classes[2:]]
        weights[:_SHAPES] = np.sqrt(np.bincount(shapes, minlength=_SHAPES) / len(shapes))
    words = text.lower().split()
    if words:
        buckets = np.fromiter(map(crc32, words), np.int64, len(words)) % _WORDS
        weights[_SHAPES : _SHAPES + _WORDS] = np.sqrt(np.bincount(buckets, minlength=_WORDS) / len(words)) / 2
    new = len(set(words)) / len(words) if words else 0.0
    weights[_SHAPES + _WORDS + min(_REPEATS - 1, int(new * _REPEATS))] = 1
    return weights


@dataclass
class QualityModel:
    """What scoring needs: at most TRAINING_ROWS latent vectors with labels, and the projection."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, rows: np.ndarray) -> np.ndarray:
        return _unit(rows @ self.projection)

    def score(self, rows: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 in the votes of each row's nearest vectors.

        One exact matrix product of the block with all labelled vectors. Neighbours
        are the vectors whose cosine is at least the ``neighbours``-th largest, so
        ties vote together. A vote weighs the cosine's fourth power, and nothing
        if the cosine is negative. Without a vote the score is the labels' mean.
        """
        if not len(self.labels):
            return np.full(len(rows), self.prior)
        cosines = np.round(self.latent(rows) @ self.vectors.T, 6)
        last = max(0, len(self.labels) - neighbours)
        least = np.partition(cosines, last, axis=1)[:, last : last + 1]
        votes = np.where(cosines >= least, np.clip(cosines, 0, 1), 0) ** 4
        total = votes.sum(axis=1)
        won = votes @ self.labels
        return np.where(total > 0, won / np.where(total > 0, total, 1), self.prior)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.where(norms > 0, norms, 1)).astype(np.float32)


def fit_model(weights: np.ndarray, labels: np.ndarray, latent: int = LATENT) -> QualityModel:
    """Latent-semantic space of labelled term vectors: inverse document frequencies, then truncated SVD.

    The right singular vectors come from the eigenvectors of the rows' Gram
    matrix, whose size is the (bounded) number of rows. Weights may come in half
    precision; only blocks of rows are ever widened, so that what the driver holds
    beside them is that matrix and the projection.
    """
    if not len(labels):
        return QualityModel(np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, EVEN)
    count, blocks = len(labels), [slice(at, at + _BLOCK) for at in range(0, len(labels), _BLOCK)]
    present = sum((weights[rows] > 0).sum(axis=0) for rows in blocks)
    idf = (np.log((1 + count) / (1 + present)) + 0.1).astype(np.float32)
    gram = np.empty((count, count))
    for i, rows in enumerate(blocks):
        scaled = weights[rows] * idf
        for other in blocks[: i + 1]:
            gram[rows, other] = scaled @ (weights[other] * idf).T
            gram[other, rows] = gram[rows, other].T
    values, left = np.linalg.eigh(gram)
    keep = [i for i in np.argsort(-values)[:latent] if values[i] > 1e-9] or [int(np.argmax(values))]
    left = left[:, keep] / np.sqrt(np.maximum(values[keep], 1e-9))
    del gram
    projection = sum((weights[rows] * idf).T @ left[rows] for rows in blocks)
    projection = (idf[:, None] * projection).astype(np.float32)
    vectors = np.concatenate([_unit(weights[rows].astype(np.float32) @ projection) for rows in blocks])
    return QualityModel(projection, vectors, labels.astype(np.float32), float(labels.mean()))


def _term_rows(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            packed = [terms(text).astype(np.float16).tobytes() for text in as_bytes(batch, "text")]
            columns = [as_list(batch, "doc_id"), as_list(batch, "label"), packed]
            types = [pa.int64(), pa.int32(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "label", "terms"])

    return docs.mapInArrow(run, "doc_id long, label int, terms binary")


def train_quality(
    docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, latent: int = LATENT
) -> QualityModel:
    """Fit on at most about ``rows`` labelled documents, chosen by a hash of their id.

    ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0/1). Both labels keep
    their shares. A document with contradicting labels, a null label or a null
    id teaches nothing; repeated equal rows count once. Without labelled
    documents every score is one half.
    """
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id")
    known = known.agg(F.min("label").alias("label"), F.max("label").alias("_high")).where("label = _high")
    chosen = hash_sample(known.select("doc_id", F.col("label").cast("int").alias("label")), rows, "doc_id")
    # The sample holds about `rows` small rows, so it may be broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = sorted({(r["doc_id"], r["label"], bytes(r["terms"])) for r in _term_rows(texts).toLocalIterator()})
    known = np.array([r[1] for r in found], np.float32)
    weights = np.empty((len(found), TERMS), np.float16)
    for i in range(len(found)):
        weights[i], found[i] = np.frombuffer(found[i][2], np.float16), None
    return fit_model(weights, known, latent)


def score_quality(docs: DataFrame, model: QualityModel, neighbours: int = NEIGHBOURS) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 if score >= 0.5).

    Every text is scored whole. Null and empty texts are scored alike, by the
    terms of an empty text. Columns of ``docs`` named like the two are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score", "predicted")
    at = kept.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 256):
            texts = batch.column(at).cast(pa.large_binary()).to_pylist()
            scores = model.value.score(np.array([terms(t) for t in texts], np.float32).reshape(-1, TERMS), neighbours)
            scores = np.clip(scores.astype(np.float64), 0, 1)
            columns = [*batch.columns, pa.array(scores), pa.array((scores >= EVEN).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{schema}, score double, predicted int")
