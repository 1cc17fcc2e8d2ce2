"""Quality by the votes of labelled neighbours in a latent-semantic space.

A text is a bag of hashed character runs (three bytes, as they stand), weighed by inverse document frequency over all
documents, which the tasks count in one pass and add up in partial sums, next to four shares that runs do not show: words that repeat the word before, words used again, words in capitals and
signs.  A truncated singular value decomposition of a bounded sample of labelled texts gives the space, and the
sample's vectors in it, two classes of at most PER_CLASS rows, are what is sent to the tasks.  Every document
is then compared with all of them, a block of documents at a time, as one product of matrices; the nearest
vote with a power of their cosine.

Defined cases: null and empty texts are the zero vector, get no votes and the score 0; repeated rows get the
same score; without labelled rows every score is 0; an empty table gives no rows; columns other than the id and the text are
left behind.  Texts of any length are counted whole, piece by piece.  Of neighbours equally near, which of them vote is the
choice of the partial sort, the same for equal texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martlens.llm.common import labelled_sample, where_texts, whole_texts

#: Hashed runs, dimensions of the space and labelled texts of each class at most: 4000 x 48 numbers are sent.
BUCKETS_LOG, DIMENSIONS, PER_CLASS = 12, 48, 2000
#: Weight of the shares beside the unit vector of runs; voters, and the power of the cosine they vote with.
SHARES, VOTERS, POWER = 0.5, 15, 4
SHORT_WORDS = 50
CHUNK = 1 << 20

_SIGN = np.array([b < 128 and not chr(b).isalnum() and not chr(b).isspace() for b in range(256)])


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    space: np.ndarray  # buckets + shares x dimensions
    vectors: np.ndarray  # labelled texts x dimensions, unit length
    votes: np.ndarray


def counts(text: str) -> np.ndarray:
    data, found = text.encode(), np.zeros(1 << BUCKETS_LOG, np.float32)
    for at in range(0, max(len(data) - 2, 0), CHUNK):
        b = np.frombuffer(data[at : at + CHUNK + 2], np.uint8).astype(np.uint32)
        runs = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(2654435761)
        found += np.bincount(runs >> np.uint32(32 - BUCKETS_LOG), minlength=len(found))
    return found


def shares(text: str) -> np.ndarray:
    """Roots of the shares of words like the one before, words used again (in texts long enough), capitals, signs."""
    words = text.split()
    n = max(len(words), 1)
    data = np.frombuffer(text.encode(), np.uint8)
    again = sum(map(str.__eq__, words, words[1:])) / n
    used = (1 - len(set(words)) / n) ** 2 if n >= SHORT_WORDS else 0.0
    capitals = sum(map(str.isupper, words)) / n
    return np.sqrt(np.array([again, used, capitals, _SIGN[data].mean() if len(data) else 0.0], np.float32))


def _filled(logs: Sequence[np.ndarray], side: Sequence[np.ndarray]) -> np.ndarray:
    """Logarithms of counts and shares as rows, texts x (buckets + shares), each written to its place at once."""
    x = np.empty((len(logs), len(logs[0]) + len(side[0])), np.float32)
    for row, runs, shared in zip(x, logs, side, strict=True):
        row[: len(runs)], row[len(runs) :] = runs, shared
    return x


def _weighed(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The rows of `x`, weighed in place."""
    runs = x[:, : len(idf)]
    runs *= idf
    runs /= np.maximum(np.sqrt(np.einsum("ij,ij->i", runs, runs)), 1e-9)[:, None]
    x[:, len(idf) :] *= SHARES
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _decomposed(x: np.ndarray, dimensions: int) -> np.ndarray:
    """The leading right singular vectors, by power iteration on a random start."""
    basis = np.random.default_rng(1).standard_normal((x.shape[1], min(dimensions + 16, *x.shape))).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
    return (basis @ right.T)[:, :dimensions].astype(np.float32)


def rarity(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of every bucket over all documents; each task sends one row for each bucket."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(1 << BUCKETS_LOG, np.int64), 0
        for b in batches:
            for text in b["text"].to_pylist():
                held += counts(text) > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(held))), pa.array(np.concatenate([[n], held]))], ["bucket", "held"])

    parts = whole_texts(docs).select("text").mapInArrow(rows, "bucket long, held long")
    held = np.zeros((1 << BUCKETS_LOG) + 1)
    for r in parts.groupBy("bucket").agg(F.sum("held").alias("held")).collect():
        held[r.bucket + 1] = r.held
    return (np.log((1 + held[0]) / (1 + held[1:])) + 0.1).astype(np.float32)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Fit on a bounded sample of labelled rows; logarithms of their counts are sent in half precision.

    One task fits, so that the driver gets the model only: the sample would stay in its process long after the fit.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].to_pylist()
            runs = [np.log1p(counts(t)).astype(np.float16).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].cast(pa.string()), b["label"], pa.array(runs, pa.binary()), pa.array([shares(t).tobytes() for t in texts], pa.binary())],
                ["id", "label", "runs", "shares"],
            )

    idf = rarity(docs)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        drawn = pa.Table.from_batches(held)
        of, ids = drawn["label"].to_pylist(), drawn["id"].to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (of[k], ids[k]))  # the same model whatever the order of tasks
        logs = [np.frombuffer(drawn["runs"][k].as_buffer(), np.float16) for k in order]
        x = _filled(logs, [np.frombuffer(drawn["shares"][k].as_buffer(), np.float32) for k in order])
        del held, drawn, logs
        space = _decomposed(_weighed(x, idf), DIMENSIONS)
        parts = space, _unit(x @ space), np.array([of[k] for k in order], np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], ["space", "vectors", "votes"])

    sample = labelled_sample(docs, labels, label, {0: per_class, 1: per_class})
    drawn = sample.mapInArrow(rows, "id string, label int, runs binary, shares binary")
    made = drawn.repartition(1).mapInArrow(fitted, "space binary, vectors binary, votes binary").collect()
    if not made:
        empty = np.zeros((0, 0), np.float32)
        return Model(empty, empty, empty, empty)
    space, vectors, voted = (np.frombuffer(part, np.float32) for part in made[0])
    vectors = vectors.reshape(len(voted), -1)
    return Model(idf, space.reshape(-1, vectors.shape[1]), vectors, voted)


def votes(model: Model, texts: list[str]) -> np.ndarray:
    """Scores of a block of texts."""
    if not len(model.votes) or not texts:
        return np.zeros(len(texts))
    x = _weighed(_filled([np.log1p(counts(t)) for t in texts], [shares(t) for t in texts]), model.idf)
    cosine = _unit(x @ model.space) @ model.vectors.T
    voters = min(VOTERS, cosine.shape[1])
    near = np.argpartition(-cosine, voters - 1, axis=1)[:, :voters]
    weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** POWER
    total = weight.sum(axis=1)
    return np.clip((weight * model.votes[near]).sum(axis=1) / np.where(total > 0, total, 1), 0, 1)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): the weighted share of good neighbours."""
    texts = whole_texts(docs)
    sent = texts.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(votes(sent.value, b["text"].to_pylist()))], ["doc_id", "score"])

    return texts.mapInArrow(rows, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, score double")


def good(docs: DataFrame, model: Model, limit: float = 0.3) -> DataFrame:
    """The documents, with all their columns, that score at least `limit`; all of them if nothing was labelled."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return where_texts(docs, lambda texts: votes(sent.value, texts) >= limit) if len(model.votes) else docs
