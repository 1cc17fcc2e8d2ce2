"""Language identification with error-correcting output codes.

Every language has a codeword of +1 and -1; one binary classifier for each bit is fitted to the character runs of texts
(three bytes, lower-cased, everything but letters taken as one blank, hashed).  A text gets the language whose
codeword has the least loss, each bit weighing by how well it is told apart on the training texts, so one weak
bit does not decide.  A text whose two best codewords are almost equally near is flagged as ambiguous.

Up to six languages use all distinct splits of the languages in two (2^(k-1) - 1 bits); more use random
codes of 10 log2 k bits, the best of several draws by the least distance between codewords.

No language is left out: the rows learned from are shared out among all of them, at least one each, so their number
is bounded by ROWS or the number of languages.  The weights come from the smaller of the two systems of equations, texts x
texts or runs x runs.

Defined cases: a text that is null or without a letter is `und` with score 0; without training rows all
are; with one language all others are that language with score 1; repeated rows get the same answer; an empty table gives no
rows; texts of any length count whole, piece by piece; of languages equally near the first by name counts.  Columns
other than id and text are left behind.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from martlens.llm.common import durable, thinned, whole_texts

#: Hashed character runs, and the texts learned from: so many of each language and of all together at most.
BUCKETS_LOG, PER_LANGUAGE, ROWS = 12, 500, 4000
RIDGE, SHARPNESS, AMBIGUOUS = 1.0, 4.0, 0.1
CHUNK = 1 << 20


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets + 1 x bits
    trust: np.ndarray  # bits


@functools.lru_cache(maxsize=1)
def _letters() -> bytes:
    """Bytes of letters stay (all of UTF-8's longer forms among them), others become blanks."""
    return bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def profile(text: str) -> np.ndarray:
    """Square roots of the counts of hashed runs, as a unit vector."""
    data = b" " + b" ".join(text.lower().encode().translate(_letters()).split()) + b" "
    counts = np.zeros(1 << BUCKETS_LOG, np.float32)
    for at in range(0, max(len(data) - 2, 0), CHUNK):
        b = np.frombuffer(data[at : at + CHUNK + 2], np.uint8).astype(np.uint32)
        runs = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(2654435761)
        counts += np.bincount(runs >> np.uint32(32 - BUCKETS_LOG), minlength=len(counts))
    counts = np.sqrt(counts)
    return counts / max(float(np.linalg.norm(counts)), 1e-9)


def codewords(count: int) -> np.ndarray:
    """One row of +1 and -1 for each of `count` languages; no two rows are equal."""
    if count <= 6:
        splits = [s for s in itertools.product((1, -1), repeat=count) if s[0] == 1 and -1 in s]
        return np.array(splits, np.float32).reshape(-1, count).T
    rng = np.random.default_rng(5)
    bits = math.ceil(10 * math.log2(count))
    drawn = [rng.choice(np.array([-1, 1], np.float32), (count, bits)) for _ in range(30)]
    # of two rows, bits less twice their distance is the product
    return min(drawn, key=lambda c: (c @ c.T - 2 * bits * np.eye(count)).max())


def _sample(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text): a bounded number of texts of each language, in the order of a hash of ids."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col("doc_id").isNotNull())
    ids = known.select("doc_id", F.col(lang_col).alias("learned"))
    held = durable(ids.groupBy("learned").agg(F.count("*").alias("held")))
    each = min(PER_LANGUAGE, max(1, ROWS // max(1, held.count())))
    # a small share may miss some languages in a thinned choice, so few rows are all looked at
    wanted = thinned("doc_id", F.lit(each), F.col("held")) | (F.col("held") < 64 * each)
    ids = ids.join(held, "learned").where(wanted).drop("held")
    order = W.partitionBy("learned").orderBy(F.xxhash64("doc_id"), "doc_id")
    picks = ids.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= each).drop("n").dropDuplicates(["doc_id"])
    texts = known.select("doc_id", F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(picks), "doc_id").select("doc_id", F.col("learned").alias("lang"), "text").dropDuplicates(["doc_id"])


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on at most PER_LANGUAGE texts of each language, and at most ROWS in all or one of each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [profile(t).astype(np.float16).tobytes() for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.string()), b["lang"], pa.array(found, pa.binary())], ["id", "lang", "x"])

    drawn = _sample(docs, text_col, lang_col).mapInArrow(rows, "id string, lang string, x binary").toArrow()
    drawn = drawn.sort_by([("lang", "ascending"), ("id", "ascending")])  # the same model whatever the order of tasks
    names = drawn["lang"].to_pylist()
    languages = tuple(sorted(set(names)))
    if len(languages) < 2:
        none = np.zeros((0, 0), np.float32)
        return Model(languages, none, none, none)
    codes = codewords(len(languages))
    x = np.stack([np.frombuffer(b, np.float16) for b in drawn["x"].to_pylist()]).astype(np.float32)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    of = np.searchsorted(languages, names)
    y = codes[of]
    # every language counts alike, however few texts it has
    weight = np.sqrt(1.0 / np.bincount(of)[of] * len(of) / len(languages))[:, None].astype(np.float32)
    xw = x * weight
    if len(xw) <= xw.shape[1]:
        weights = xw.T @ np.linalg.solve(xw @ xw.T + RIDGE * np.eye(len(xw), dtype=np.float32), y * weight)
    else:
        weights = np.linalg.solve(xw.T @ xw + RIDGE * np.eye(xw.shape[1], dtype=np.float32), xw.T @ (y * weight))
    right = ((x @ weights * y > 0) * weight**2).mean(axis=0)
    trust = np.clip(2 * right - 1, 0.05, 1)
    return Model(languages, codes, weights.astype(np.float32), (trust / trust.sum()).astype(np.float32))


def losses(model: Model, x: np.ndarray) -> np.ndarray:
    """Texts x languages: the weighted exponential loss of every codeword."""
    bits = np.clip(np.hstack([x, np.ones((len(x), 1), np.float32)]) @ model.weights, -3, 3)
    return np.stack([np.exp(-bits * code) @ model.trust for code in model.codes], axis=1)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous)."""

    def answer(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        lettered = np.array([any(map(str.isalpha, t)) for t in texts], bool)
        names = np.array(["und"] * len(texts), object)
        score, ambiguous = np.zeros(len(texts)), ~lettered
        if len(model.languages) == 1:
            names[lettered], score[lettered] = model.languages[0], 1.0
        elif len(model.languages) > 1 and lettered.any():
            loss = losses(model, np.stack([profile(t) for t, ok in zip(texts, lettered) if ok]))
            share = np.exp(SHARPNESS * (loss.min(axis=1, keepdims=True) - loss))
            share /= share.sum(axis=1, keepdims=True)
            names[lettered] = np.array(model.languages, object)[loss.argmin(axis=1)]
            score[lettered] = share.max(axis=1)
            ranked = np.sort(share, axis=1)
            ambiguous[lettered] = ranked[:, -1] - ranked[:, -2] < AMBIGUOUS
        return names.tolist(), np.clip(score, 0, 1), ambiguous

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, score, ambiguous = answer(b["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(names, pa.string()), pa.array(score), pa.array(ambiguous)],
                ["doc_id", "lang_pred", "score", "ambiguous"],
            )

    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")
