"""Toxicity by compression distance: which of two zstandard dictionaries shortens a text's windows more.

The ordinary dictionary is trained by zstandard on ordinary texts.  The toxic one consists of windows of toxic
texts, the commonest last.  Windows go into it if they hold character runs that are significantly more frequent in
toxic than in ordinary text (log-likelihood ratio), each run counted once per distinct neighbourhood, so that
copies of a text count as one.  zstandard's own trainer keeps what is common, which here is common to both
kinds of text: left to choose among whole toxic texts it reached an area under the curve of 0.75 only.

A window is a word, or each part of 48 characters of a longer one.  It is compressed four times in a row between blanks, since a
frame of a few bytes is never compressed.  It speaks for toxic text if the toxic dictionary saves at least so many
bytes against the ordinary one and makes the window at most so long.  These two thresholds are those that tell
a second set of labelled documents apart best; the shares of such windows in its two classes turn a document's
count into log-odds, and a third threshold parts the set with the fewest errors.

Defined cases: null, empty and blank texts hold no window and have the score of even windows; a repeated row gets the same score; without labelled
rows of both kinds, or with too few to tell them apart, every score is 0; texts of any length are judged by all their windows; an
empty table gives no rows; columns other than the id and the text are left behind.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from martlens.llm.common import durable, fold, labelled_sample, thinned, where_texts, whole_texts

#: Labelled documents learned from at most, by class (0: ordinary, 1: toxic).
SAMPLE = {0: 8000, 1: 4000}
#: Size of the ordinary dictionary, the pieces of texts it is trained on at most, their characters, and the windows added at most.
DICTIONARY, PIECES, PIECE_CHARS, WINDOWS = 8192, 6000, 400, 256
#: A run counts as toxic from this log-likelihood ratio and this ratio of frequencies (natural logarithm).
RUN, SIGNIFICANT, CONTRAST = 5, 27.0, 2.0
WINDOW_CHARS, TIMES, LEVEL = 48, 4, 13
#: Cells of windows: bytes saved, by compressed length from the shortest on; both are cut at the last one.
SAVED, LENGTHS, SHORTEST = 16, 16, 5
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
REMEMBERED = 300_000


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    odds: np.ndarray  # what a window of each cell adds to a document's log-odds
    threshold: float


def _contexts(sample: DataFrame) -> DataFrame:
    """Distinct (label, word before, word, word after) as the word's parts of WINDOW_CHARS with their runs of characters."""
    words = F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w != "")
    listed = sample.select("label", F.explode(F.array(words)).alias("words"))
    around = F.transform(
        "words", lambda w, i: F.struct(F.get("words", i - 1).alias("before"), w.alias("word"), F.get("words", i + 1).alias("after"))
    )
    distinct = listed.select("label", F.explode(around).alias("c")).select("label", "c.*").distinct()
    # parts overlap by RUN - 1, so that every run of a word is in one of them; a last part that the one before holds is left out
    step = F.regexp_extract_all("word", F.lit(f"(?s).{{1,{WINDOW_CHARS - RUN + 1}}}"), F.lit(0))
    steps = distinct.select("label", F.filter(step, lambda x, i: (i == 0) | (F.char_length(x) >= RUN)).alias("steps"), step.alias("all"))
    part = F.transform(
        "steps",
        lambda x, i: F.struct(
            F.concat(x, F.substring(F.coalesce(F.get("all", i + 1), F.lit("")), 1, RUN - 1)).alias("part"),
            F.when(i == 0, " ").otherwise("").alias("left"),
            F.when(i == F.size("steps") - 1, " ").otherwise("").alias("right"),
        ),
    )
    parts = steps.select("label", F.explode(part).alias("p")).select("label", "p.*")
    framed = F.concat("left", "part", "right")
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(framed) - (RUN - 1), F.lit(1)))
    runs = F.array_distinct(F.transform(starts, lambda i: F.substring(framed, i, RUN)))
    bare = F.regexp_replace("part", r"^\p{Punct}+|\p{Punct}+$", "")
    return parts.select("label", bare.alias("word"), runs.alias("runs"))


def _toxic_windows(sample: DataFrame) -> list[str]:
    """The commonest words of toxic texts that hold a run typical of them; at most WINDOWS."""
    contexts = durable(_contexts(sample))
    counts = contexts.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    if not counts[0] or not counts[1]:
        return []
    na, nb = map(float, counts)
    runs = contexts.select("label", F.explode("runs").alias("run")).groupBy("run")
    a, b = F.col("a"), F.col("b")
    both = runs.agg(F.sum("label").cast("double").alias("a"), F.sum(1 - F.col("label")).cast("double").alias("b"))
    share = lambda n, part: F.when(n > 0, n * F.log(n / ((a + b) * part))).otherwise(0.0)
    ratio = 2 * (share(a, na / (na + nb)) + share(b, nb / (na + nb)))
    contrast = F.log((a + 0.5) / na) - F.log((b + 0.5) / nb)
    typical = both.where((ratio > SIGNIFICANT) & (contrast > CONTRAST)).orderBy(ratio.desc(), "run").limit(2 * WINDOWS).select("run")
    held = contexts.where("label = 1").select("word", F.monotonically_increasing_id().alias("n"), F.explode("runs").alias("run"))
    marked = held.join(F.broadcast(typical), "run", "left_semi").select("n", "word").distinct()
    best = marked.groupBy("word").count().orderBy(F.col("count").desc(), "word").limit(WINDOWS)
    return best.toArrow()["word"].to_pylist()


def _trained(texts: list[bytes]) -> bytes:
    """zstandard's dictionary of some texts; where they are too few for its trainer, the texts themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY, texts).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(texts)[-DICTIONARY:]


def _pieces(sample: DataFrame) -> list[bytes]:
    """What the ordinary dictionary is trained on: PIECES pieces at most, in the order of a hash, of whole texts."""
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0))
    cuts = sample.select("doc_id", F.posexplode(cut).alias("at", "piece")).where(F.trim("piece") != "")
    cuts = cuts.select(F.xxhash64("doc_id", "at").alias("number"), "piece")
    drawn = cuts.where(thinned("number", PIECES, cuts.count())).orderBy(F.xxhash64("number"), "number").limit(PIECES)
    texts = sorted(" ".join(t.lower().split()).encode() for t in drawn.toArrow()["piece"].to_pylist())
    return [t for t in texts if t]


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", sizes: dict[int, int] = SAMPLE) -> Model:
    """Fit on a bounded sample of labelled rows: two thirds for the dictionaries, one for the threshold."""
    sample = durable(labelled_sample(docs, labels, label, sizes).withColumn("part", fold("doc_id", 3)))
    windows = _toxic_windows(sample.where("part > 0").select("label", "text"))
    ordinary = _trained(_pieces(sample.where("part > 0 and label = 0")))
    toxic = " ".join(reversed(windows)).encode()
    unlearned = Model(b"", b"", np.zeros(SAVED * LENGTHS), math.inf)
    if not windows:
        return unlearned
    toxic += b" "
    tried = _histograms(sample.where("part = 0"), ordinary, toxic).toArrow()
    label = tried["label"].to_numpy()
    cells = np.array([np.frombuffer(c, np.int32) for c in tried["cells"].to_pylist()], np.float64).reshape(-1, SAVED * LENGTHS)
    odds = _log_odds(cells[label == 1].sum(axis=0), cells[label == 0].sum(axis=0))
    # without a window that tells the classes of the second set apart nothing is known
    return Model(ordinary, toxic, odds, _threshold(cells @ odds, label)) if odds.any() else unlearned


def _log_odds(toxic: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Log-odds by cell: one value for the cells within the two best thresholds and one for all others."""
    a, b = toxic.reshape(SAVED, LENGTHS), ordinary.reshape(SAVED, LENGTHS)
    total_a, total_b = a.sum() + 1, b.sum() + 1
    best, within, shares = 0.0, np.zeros_like(a, bool), (1.0, 1.0)
    for saved in range(1, SAVED):
        for length in range(LENGTHS):
            p, q = a[saved:, : length + 1].sum(), b[saved:, : length + 1].sum()
            part = total_a / (total_a + total_b)
            if p < 3 or p / total_a <= q / total_b:
                continue
            gain = p * math.log(p / ((p + q) * part)) + (q * math.log(q / ((p + q) * (1 - part))) if q else 0.0)
            if gain > best:
                best, within = gain, np.zeros_like(a, bool)
                within[saved:, : length + 1] = True
                shares = (p + 0.5) / total_a, (q + 0.5) / total_b
    inside, outside = math.log(shares[0] / shares[1]), 0.0
    if best:
        outside = math.log((1 - shares[0]) / (1 - shares[1]))
    return np.where(within.ravel(), inside, outside)


def _threshold(value: np.ndarray, label: np.ndarray) -> float:
    """The cut that parts the classes with the fewest errors: halfway between two values, or above all of them."""
    order = np.argsort(value, kind="stable")
    value, toxic = value[order], label[order] == 1
    # errors of a cut above each value: toxic ones up to it and ordinary ones beyond
    errors = np.cumsum(toxic) + np.cumsum(~toxic[::-1])[::-1] - ~toxic
    last = np.concatenate([value[1:] > value[:-1], [True]])  # of equal values only the last can have a cut above
    cuts = np.concatenate([(value[1:] + value[:-1]) / 2, [value[-1] + 1]])[last]
    best = np.flatnonzero(errors[last] == errors[last].min())
    return float(cuts[best[len(best) // 2]])


class _Scale:
    """Two compressors and the gains of windows seen before."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        options = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, min_match=3, write_content_size=False, write_dict_id=False, write_checksum=False
        )
        made = [zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for d in (ordinary, toxic)]
        self.plain, self.toxic = (zstandard.ZstdCompressor(compression_params=options, dict_data=d) for d in made)
        self.known: dict[str, int] = {}

    def _cell(self, word: str) -> int:
        window = word.strip(PUNCTUATION).encode()
        framed = (b" " + window + b" ") * TIMES
        length = len(self.toxic.compress(framed))
        saved = min(max(len(self.plain.compress(framed)) - length, 0), SAVED - 1)
        cell = saved * LENGTHS + min(max(length - SHORTEST, 0), LENGTHS - 1)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[word] = cell
        return cell

    def cells(self, text: str) -> np.ndarray:
        """How many of a text's windows are in each cell."""
        found, known, make = [], self.known, self._cell
        for word in text.lower().split():
            if len(word) <= WINDOW_CHARS:
                cell = known.get(word)
                found.append(make(word) if cell is None else cell)
            else:
                parts = (word[i : i + WINDOW_CHARS] for i in range(0, len(word), WINDOW_CHARS))
                found += [make(p) if (cell := known.get(p)) is None else cell for p in parts]
        return np.bincount(found, minlength=SAVED * LENGTHS) if found else np.zeros(SAVED * LENGTHS, np.int64)


@functools.lru_cache(maxsize=2)
def _scale(ordinary: bytes, toxic: bytes) -> _Scale:
    return _Scale(ordinary, toxic)


def _histograms(sample: DataFrame, ordinary: bytes, toxic: bytes) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = _scale(ordinary, toxic)
        for b in batches:
            cells = [scale.cells(t).astype(np.int32).tobytes() for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["label"], pa.array(cells, pa.binary())], ["label", "cells"])

    return sample.select("label", "text").mapInArrow(rows, "label int, cells binary")


def scores(model: Model, texts: list[str]) -> np.ndarray:
    """0 to 1 for each text, and 0.5 at the threshold."""
    if not model.toxic:
        return np.zeros(len(texts))
    scale = _scale(model.ordinary, model.toxic)
    over = np.array([float(scale.cells(t) @ model.odds) for t in texts], np.float64) - model.threshold
    return 1 / (1 + np.exp(-np.clip(over, -500, 500)))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(scores(model, b["text"].to_pylist()))], ["doc_id", "score"])

    texts = whole_texts(docs)
    return texts.mapInArrow(rows, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, score double")


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The documents, with all their columns, that score below `limit`."""
    return where_texts(docs, lambda texts: scores(model, texts) < limit)
