from __future__ import annotations

import numpy as np

from martlens.llm import toxicity


def test_toxic_runs_deep_in_texts_without_blanks_are_learned(ready):
    rnd = np.random.default_rng(0)
    syllables = ["ta", "ro", "mi", "len", "ka", "os", "ver", "ti", "un", "pel"]
    rows, labels = [], []
    for i in range(400):
        parts = [str(rnd.choice(syllables)) for _ in range(200)]
        if i % 4 == 0:
            for at in rnd.integers(30, 200, 5):
                parts[at] = str(rnd.choice(["blorgish", "quazzle", "frimpton"]))
        rows.append((i, "".join(parts)))
        labels.append((i, int(i % 4 == 0)))
    docs = ready.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, ready.createDataFrame(labels[:300], "doc_id long, toxic int"))
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.scored(docs, model).collect()}
    assert np.mean([got[i] == (i % 4 == 0) for i in range(300, 400)]) >= 0.9


def test_parts_hold_every_run_of_a_word(ready):
    words = ["".join(chr(0x4E00 + 50 * n + i) for i in range(n)) for n in (1, 4, 5, 44, 45, 48, 49, 93, 500)]
    sample = ready.createDataFrame([(1, w) for w in words], "label int, text string")
    rows = toxicity._contexts(sample).collect()
    got = {run for r in rows for run in r.runs}
    assert got == {f" {w} "[i : i + 5] for w in words for i in range(max(1, len(w) - 2))} and max(len(r.word) for r in rows) == 48


def test_bodies_are_trained_on(ready, monkeypatch):
    monkeypatch.setattr(toxicity, "PIECES", 40)
    docs = ready.createDataFrame([(i, "head " * 80 + "body " * 400) for i in range(50)], "doc_id long, text string")
    found = toxicity._pieces(docs)
    assert len(found) == 40 and sum(b"body" in t for t in found) > 20
