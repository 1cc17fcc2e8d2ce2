"""Sentiment of review texts.

The default scorer counts lexicon words and is made of Spark expressions only.  Any model can
take its place through `score_with_model`, which feeds it Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from martlens.functions import scalars as X

# How a model's raw labels map to sentiments; any other label is neutral.
LABELS = {
    "label_0": "negative",
    "label_1": "positive",
    "negative": "negative",
    "positive": "positive",
    "neutral": "neutral",
}


@dataclass(frozen=True)
class Lexicon:
    positive: frozenset[str]
    negative: frozenset[str]


# Words in English and Vietnamese; pass another Lexicon for other languages.
DEFAULT_LEXICON = Lexicon(
    positive=frozenset(
        "good great best excellent love happy fast nice perfect useful recommend "
        "tốt đẹp tuyệt thích ổn nhanh hay ngon ưng rẻ".split()
    ),
    negative=frozenset(
        "bad worst poor broken slow hate awful useless worthless stupid idiot "
        "tệ kém xấu hỏng chậm chán dở rách giả lừa".split()
    ),
)


def word_balance(text: Column | str, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """How many more positive than negative words a text has."""
    return X.word_balance(text, lexicon.positive, lexicon.negative)


def label_of(balance: Column) -> Column:
    return F.when(balance > 0, "positive").when(balance < 0, "negative").otherwise("neutral")


def confidence_of(balance: Column) -> Column:
    """The larger of two softmax shares, four decimals; 0 when there is no balance either way."""
    return F.when(balance == 0, 0.0).otherwise(F.round(1 / (1 + F.exp(-F.abs(balance).cast("double"))), 4))


def score_with_lexicon(
    rows: DataFrame, text: str = "comment", lexicon: Lexicon = DEFAULT_LEXICON
) -> DataFrame:
    """Add `sentiment` and `confidence`; blank text is neutral with confidence 0."""
    # blank text has no words, hence no balance: neutral, 0
    scored = X.once(rows, "_balance", word_balance(text, lexicon))
    return scored.withColumns(
        {"sentiment": label_of(F.col("_balance")), "confidence": confidence_of(F.col("_balance"))}
    ).drop("_balance")


class Model(Protocol):
    """A scorer: texts in, (raw label, confidence) pairs out, in the same order."""

    def predict(self, texts: Sequence[str]) -> list[tuple[str, float]]: ...


def chunks_by_length(lengths: Sequence[int], batch_size: int, budget: int | None = None) -> list[list[int]]:
    """Places of texts in chunks of like lengths: at most `batch_size` each, and at most `budget` characters once all are
    padded to the longest; a longer text is a chunk of its own."""
    chunks: list[list[int]] = []
    for place in sorted(range(len(lengths)), key=lambda k: (lengths[k], k)):
        padded = (len(chunks[-1]) + 1) * lengths[place] if chunks else 0
        if not chunks or len(chunks[-1]) == batch_size or (budget is not None and padded > budget):
            chunks.append([])
        chunks[-1].append(place)
    return chunks


def padding_share(lengths: Sequence[int], chunks: Sequence[Sequence[int]]) -> float:
    """Which share of what a model is given is padding, when every chunk is padded to its longest text."""
    padded = sum(len(c) * max(lengths[k] for k in c) for c in chunks)
    return 1 - sum(lengths) / padded if padded else 0.0


def score_with_model(
    rows: DataFrame, load: Callable[[], Model], text: str = "comment", batch_size: int = 8, budget: int | None = None
) -> DataFrame:
    """Add `sentiment` and `confidence` from a model that each worker loads once.

    The texts of an Arrow batch are asked about in order of length, `batch_size` at a time or fewer where their padded length
    would pass `budget` characters, and answered in their own order.
    Blank texts are neutral without asking the model.  A batch the model fails on is
    neutral with confidence 0.  `load` must be picklable; truncation is the model's business.
    """
    labels = dict(LABELS)

    @F.pandas_udf("sentiment string, confidence double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for texts in batches:
            out = [("neutral", 0.0)] * len(texts)
            asked = [i for i, t in enumerate(texts) if t is not None and t.strip()]
            for places in chunks_by_length([len(texts.iloc[i]) for i in asked], batch_size, budget):
                chunk = [asked[k] for k in places]
                try:
                    answers = model.predict([texts.iloc[i] for i in chunk])
                    read = [(labels.get(a.lower(), "neutral"), round(float(c), 4)) for a, c in answers]
                    if len(read) != len(chunk):
                        continue  # which answer belongs to which text is unknown
                except Exception:  # a failing batch must not lose its rows
                    continue
                for i, answer in zip(chunk, read, strict=True):
                    out[i] = answer
            yield pd.DataFrame(out, columns=["sentiment", "confidence"])

    scored = X.once(rows.withColumn("_asked", score(text)), "_label", F.col("_asked"))
    answer = {"sentiment": F.col("_label.sentiment"), "confidence": F.col("_label.confidence")}
    return scored.withColumns(answer).drop("_asked", "_label")


class LexiconModel:
    """The lexicon in the form of a model, for workers that score in Python."""

    def __init__(self, lexicon: Lexicon = DEFAULT_LEXICON):
        self.lexicon = lexicon

    def predict(self, texts: Sequence[str]) -> list[tuple[str, float]]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> tuple[str, float]:
        found = "".join(ch if ch.isalpha() else " " for ch in text.lower()).split()
        negative = sum(w in self.lexicon.negative for w in found)
        positive = sum(w in self.lexicon.positive for w in found)
        if negative == positive:
            return "neutral", 0.0
        label = "label_1" if positive > negative else "label_0"
        return label, 1.0 / (1.0 + math.exp(-abs(positive - negative)))


def sentiment_rows(scored: DataFrame, at: Column) -> DataFrame:
    """Rows of the sentiment table."""
    return scored.select(
        "review_id",
        "sentiment",
        F.col("confidence").cast("decimal(5,4)").alias("confidence_score"),
        at.alias("processed_at"),
    )


def mismatches(scored: DataFrame) -> DataFrame:
    """Reviews whose stars and sentiment disagree."""
    high = (F.col("rating") >= 4) & (F.col("sentiment") == "negative")
    low = (F.col("rating") <= 2) & (F.col("sentiment") == "positive")
    kind = F.when(high, "high_rating_negative").when(low, "low_rating_positive")
    return scored.withColumn("mismatch", kind).filter(high | low)


def confusion(predictions: DataFrame, truth: str = "label", predicted: str = "sentiment") -> DataFrame:
    """Rows per true and predicted label."""
    return predictions.groupBy(truth, predicted).agg(F.count("*").alias("n"))


def accuracy(predictions: DataFrame, truth: str = "label", predicted: str = "sentiment") -> DataFrame:
    hits = F.count_if(F.col(truth) == F.col(predicted))
    return predictions.agg(
        F.count("*").alias("n"),
        hits.alias("correct"),
        X.ratio(hits, F.count("*"), 4, 1).alias("accuracy"),
    )
