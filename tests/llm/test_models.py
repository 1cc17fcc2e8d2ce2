"""Held-out accuracy of the classifiers, and their defined cases."""

from __future__ import annotations

import numpy as np
import pytest

from martlens.llm import langid, quality, toxicity
from martlens.llm.queries import QUERIES
from tests.llm.conftest import HARD

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(ready):
    return {r.doc_id: r for r in ready.read.parquet(f"{FOLDER}/labels.parquet").collect()}


@pytest.mark.parametrize("name, label, least", [("op7_toxicity", "toxic", 0.9), ("op9_quality_votes", "quality", 0.95)])
def test_labels(ready, labels, name, label, least):
    rows = QUERIES[name](ready, FOLDER).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id][label] for r in held]) >= least


def test_languages(ready):
    truth = {r.doc_id: r.lang for r in ready.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op8_language_id"](ready, FOLDER).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.99


@pytest.mark.parametrize("count", [2, 3, 4, 6, 7, 30])
def test_codewords(count):
    codes = langid.codewords(count)
    assert codes.shape[0] == count and len({tuple(c) for c in codes}) == count
    assert count > 6 or codes.shape[1] == 2 ** (count - 1) - 1


def test_language_of_hard_rows(ready, hard, nothing):
    texts = [(i, "the cat and the dog " * 5, "en") for i in range(8)] + [(i, "der Hund und die Katze " * 5, "de") for i in range(8, 16)]
    learned = langid.learn(ready.createDataFrame([*texts, (99, "x", None)], "doc_id long, text string, lang string"))
    assert learned.languages == ("de", "en")
    got = {r.doc_id: r for r in langid.identified(hard, learned).collect()}
    assert len(HARD) + 1 == len(got)
    assert [got[i].lang_pred for i in (1, 2, 3, 11)] == ["und"] * 4 and got[8].lang_pred in ("de", "en")
    assert langid.identified(nothing, learned).count() == 0
    one = langid.learn(ready.createDataFrame(texts[:8], "doc_id long, text string, lang string"))
    assert {(r.lang_pred, r.score) for r in langid.identified(hard, one).collect()} == {("en", 1.0), ("und", 0.0)}
    none = langid.learn(nothing)
    assert {r.lang_pred for r in langid.identified(hard, none).collect()} == {"und"}


def test_quality_of_hard_rows(ready, hard, nothing):
    labels = ready.createDataFrame([(4, 1), (6, 1), (10, 0), (13, 0), (6, 1), (None, 1), (5, None)], "doc_id long, quality int")
    model = quality.learn(hard, labels)
    assert len(model.votes) == 4
    got = {r.doc_id: r.score for r in quality.scored(hard, model).collect()}
    assert got[1] == got[2] == 0.0 and all(0 <= s <= 1 for s in got.values())
    assert quality.good(hard, model).columns == hard.columns
    assert quality.scored(nothing, model).count() == 0
    unlearned = quality.learn(hard, labels.limit(0))
    assert {r.score for r in quality.scored(hard, unlearned).collect()} == {0.0}
    assert quality.good(hard, unlearned).count() == hard.count()


def test_toxicity_of_hard_rows(ready, hard, nothing):
    labels = ready.createDataFrame([(4, 1), (6, 0), (10, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        model = toxicity.learn(hard, known)
        got = [r.score for r in toxicity.scored(hard, model).collect()]
        assert len(got) == hard.count() and all(0 <= s <= 1 for s in got)
        assert toxicity.scored(nothing, model).count() == 0
    assert toxicity.without_toxic(hard, model).columns == hard.columns


def test_toxic_words_are_learned_and_copies_count_once(ready):
    rnd = np.random.default_rng(0)
    syllables = ["ta", "ro", "mi", "len", "ka", "os", "ver", "ti", "un", "pel"]
    word = lambda: "".join(rnd.choice(syllables, rnd.integers(1, 4)))
    rows, labels = [], []
    for i in range(400):
        words = [word() for _ in range(120)]
        if i % 4 == 0:
            for at in rnd.integers(0, 120, 4):
                words[at] = str(rnd.choice(["blorgish", "quazzle", "frimpton"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs = ready.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, ready.createDataFrame(labels[:300], "doc_id long, toxic int"))
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.scored(docs, model).collect()}
    assert np.mean([got[i] == (i % 4 == 0) for i in range(300, 400)]) >= 0.97


def test_thresholds():
    cut = toxicity._threshold
    assert cut(np.array([-2.0, -1.0, 3.0, 4.0]), np.array([0, 0, 1, 1])) == 1.0
    assert cut(np.zeros(5), np.array([0, 0, 1, 0, 0])) == 1.0  # nothing to tell by: all are ordinary
    assert cut(np.array([1.0, 2.0, 2.0, 5.0]), np.array([0, 0, 1, 1])) in (1.5, 3.5)
    assert cut(np.array([1.0, 2.0]), np.array([0, 0])) == 3.0


def test_too_few_labels_refuse_nothing(ready):
    folder = "/root/testdata/sf0.001"
    docs = ready.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.learn(docs, ready.read.parquet(f"{folder}/labels.parquet").limit(30))
    assert toxicity.without_toxic(docs, model).count() >= 0.9 * docs.count()


def test_no_language_is_left_out(ready, monkeypatch):
    monkeypatch.setattr(langid, "ROWS", 240)
    rng = np.random.default_rng(4)
    words = {f"l{k:03}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 4)) for _ in range(6)] for k in range(120)}
    rows = [(len(words) * i + k, " ".join(rng.choice(own, 30)), name) for i in range(4) for k, (name, own) in enumerate(words.items())]
    rows += [(9000 + i, " ".join(rng.choice(words["l000"], 30)), "l000") for i in range(900)]  # a hot language
    docs = ready.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert len(model.languages) == 120
    got = {r.doc_id: r.lang_pred for r in langid.identified(docs, model).collect()}
    assert np.mean([got[i] == lang for i, _, lang in rows]) > 0.95


def test_decoding_as_recomputed(ready):
    docs = ready.read.parquet(f"{FOLDER}/documents.parquet")
    model = langid.learn(docs)
    texts = {r.doc_id: r.text for r in docs.limit(60).collect()}
    for r in langid.identified(docs.limit(60), model).collect():
        bits = np.clip(np.append(langid.profile(texts[r.doc_id]), 1) @ model.weights, -3, 3)
        loss = [sum(t * np.exp(-b * c) for b, c, t in zip(bits, code, model.trust)) for code in model.codes]
        assert r.lang_pred in ("und", model.languages[int(np.argmin(loss))])


def test_votes_as_recomputed(ready, labels):
    docs = ready.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality.learn(docs, ready.read.parquet(f"{FOLDER}/labels.parquet"))
    texts = [r.text or "" for r in docs.orderBy("doc_id").collect()]
    held = np.zeros(4096)
    for t in texts:
        held += quality.counts(t) > 0
    assert np.allclose(model.idf, np.log((1 + len(texts)) / (1 + held)) + 0.1, atol=1e-5)
    for t in texts[:40]:
        x = np.log1p(quality.counts(t)) * model.idf
        x = np.concatenate([x / max(np.linalg.norm(x), 1e-9), quality.SHARES * quality.shares(t)]) @ model.space
        cosine = model.vectors @ (x / max(np.linalg.norm(x), 1e-9))
        near = np.sort(cosine)[::-1][: quality.VOTERS]
        voters = np.argsort(-cosine)[: quality.VOTERS]
        weight = np.maximum(near, 0).astype(float) ** quality.POWER
        want = (weight * model.votes[voters]).sum() / max(weight.sum(), 1e-12)
        assert abs(quality.votes(model, [t])[0] - want) < 1e-3


def test_long_runs_are_counted_whole():
    assert quality.counts("a" * 70_002).max() == 70_000
