from __future__ import annotations

import random

import numpy as np
import pytest

from martlens.llm import repeats


def brute(rows, window):
    """(doc, text) to what stays, by looking at every window in order."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data, gone = text.encode(), set()
        for i in range(len(data) - window + 1):
            w = data[i : i + window]
            if w in seen:
                gone.update(range(i, i + window))
            seen.add(w)
        out[doc] = bytes(b for i, b in enumerate(data) if i not in gone)
    return out


def kept(df):
    return {r.doc_id: bytes(r.kept) for r in df.collect()}


@pytest.mark.parametrize("window", [12, 100])
def test_as_brute_force(ready, window):
    rnd = random.Random(window)
    parts = ["".join(rnd.choice("abé ") for _ in range(rnd.randint(5, 160))) for _ in range(12)]
    rows = [(i * 3, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9)))) for i in range(60)]
    rows += [(500, "a" * 700), (501, "a" * 350 + "b" + "a" * 350), (502, "ab" * 300)]
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = kept(repeats.without_repeats(docs, window))
    assert got == brute(rows, window)


def test_small_chunks_change_nothing(ready, monkeypatch):
    rnd = random.Random(3)
    long = "".join(rnd.choice("abc") for _ in range(3000))
    parts, whole = [long.encode()], {}
    for size in (1 << 20, 256):
        monkeypatch.setattr(repeats, "CHUNK", size)
        repeats._tables.cache_clear()
        sender = repeats._Sender(100, 28)
        batches = [*sender.add(1, 0, 0, parts[0]), *sender.rest()]
        places = np.concatenate([b["place"].to_numpy() for b in batches])
        covered = sorted(s + i for s, n in zip((places >> 8) & (2**40 - 1), places & 255) for i in range(n))
        whole[size] = covered
    repeats._tables.cache_clear()
    assert whole[256] == whole[1 << 20] == list(range(len(long) - 99))


def test_hard_rows(ready, hard, nothing):
    got = repeats.without_repeats(hard).collect()
    assert len(got) == hard.count()
    texts = {}
    for r in got:
        texts.setdefault(r.doc_id, set()).add(bytes(r.kept))
    assert texts[1] == texts[2] == {b""} and texts[6] == texts[7] == {b"one two three four"}
    assert all(len(t) == 1 for t in texts.values())  # rows alike in id and text get the same result
    assert texts[None] == {b"no id here"}
    assert texts[12] == {b"x"} and texts[13] == {b"word "}  # all but the first period repeats
    assert repeats.without_repeats(nothing).count() == 0


def test_equal_ids_with_other_texts(ready):
    a, b = "x" * 50 + "shared passage " * 10, "shared passage " * 10 + "y" * 50
    docs = ready.createDataFrame([(1, a), (1, b), (2, b)], "doc_id long, text string")
    got = sorted((r.doc_id, len(r.kept)) for r in repeats.without_repeats(docs).collect())
    assert got[-1] == (2, 0) and sum(n for _, n in got) < len(a) + len(b)


def test_whole_rows_come_back(ready, hard):
    out = repeats.deduplicated(hard)
    assert out.columns == hard.columns
    assert out.count() == hard.count()
    cut = {r.doc_id: r for r in out.collect()}
    assert cut[8].text == "Ärger über Öl 日本語 😀 ½" and cut[1].text == "" and cut[8].tag == "t"


def test_a_letter_that_is_cut_goes_whole(ready):
    shared = "é" * 60
    docs = ready.createDataFrame([(1, "a" + shared), (2, "b" + shared)], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in repeats.deduplicated(docs, 99).collect()}
    assert texts[2].startswith("b") and set(texts[2]) <= {"b", "é"}
