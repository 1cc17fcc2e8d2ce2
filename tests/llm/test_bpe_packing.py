from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from martlens.llm import bpe, packing
from martlens.llm.common import table
from martlens.llm.queries import VOCABULARY
from tests.llm.conftest import HARD

PIECES = ["a", "th", "ing", " ", "\n", "'s", "'ll", "!", "#", "<|", "<|endoftext|>", "é", "é", "Σ", "ΑΣ", "İ", "ẞ", "日本", "😀", "½", "12", "\x1c", "\x00", "\u0085", "​"]


@pytest.fixture(scope="module")
def coders():
    return bpe.WordBpe(VOCABULARY), Tokenizer.from_file(VOCABULARY)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_as_the_library_on_odd_texts(text):
    mine, theirs = bpe.coder(VOCABULARY), library()
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert mine.encode(text).tolist() == ids
    assert mine.decode(mine.encode(text)).decode() == theirs.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abcdefghijklmnopqrstuvwxyz", max_size=40))
def test_as_the_library_on_made_up_words(text):
    assert bpe.coder(VOCABULARY).encode(text).tolist() == library().encode(text, add_special_tokens=False).ids


def library(made=[]):  # noqa: B006
    if not made:
        made.append(Tokenizer.from_file(VOCABULARY))
    return made[0]


def test_the_store_may_run_full(monkeypatch, coders):
    mine, theirs = coders
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    text = "stored pieces and stored words, again stored: pieces and words."
    for _ in range(3):
        assert mine.encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_digests_of_hard_rows(hard, nothing, coders):
    _, theirs = coders
    got = {r.doc_id: r for r in bpe.digests(hard, VOCABULARY).collect()}
    for doc, text in HARD:
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        decoded = theirs.decode(ids, skip_special_tokens=False)
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.digests(nothing, VOCABULARY).count() == 0 and bpe.encoded(hard, VOCABULARY).count() == hard.count()


def check_packing(rows, capacity):
    """Sequences are gapless from 0, and no piece lies in two."""
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled)


@pytest.mark.parametrize("group_rows", [65_536, 40])
def test_packing(ready, hard, nothing, coders, monkeypatch, group_rows):
    monkeypatch.setattr(packing, "GROUP_ROWS", group_rows)
    docs = hard
    if group_rows < 100:
        rnd = np.random.default_rng(0)
        docs = ready.createDataFrame([(i, "a " * int(n)) for i, n in enumerate(rnd.integers(1, 900, 400))], "doc_id long, text string")
    rows = packing.packed(docs, VOCABULARY).collect()
    sequences = check_packing(rows, 4096)
    total = sum(r.length for r in rows)
    if group_rows < 100:
        assert len(rows) == 400 and sequences <= 1.02 * total / 4096 + 2
    else:
        _, theirs = coders
        texts = dict(HARD)
        for r in rows:
            ids = [*theirs.encode(texts.get(r.doc_id, "no id here") or "", add_special_tokens=False).ids, 1]
            piece = np.array(ids[r.start : r.start + 4096], "<u4")
            assert r.start == 4096 * r.piece and r.length == len(piece) and r.ids_crc32 == zlib.crc32(piece.tobytes())
        assert packing.packed(nothing, VOCABULARY).count() == 0


def test_sum_of_squares_needs_no_more_sequences_than_the_tokens():
    lengths = np.random.default_rng(2).integers(1, 2000, 5000)
    bins, places = packing.sum_of_squares(lengths, 4096)
    fill = np.bincount(bins, weights=lengths)
    assert fill.max() <= 4096 and bins.max() + 1 <= 1.005 * lengths.sum() / 4096 + 1
    assert len(packing.sum_of_squares(np.array([], np.int64), 4096)[0]) == 0
    assert packing.sum_of_squares(np.array([4096, 4096]), 4096)[0].tolist() == [0, 1]


def test_many_groups_need_few_more_sequences(ready, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 400)
    docs = table(ready, "/root/testdata/sf0.1", "documents")
    got = packing.packed(docs, VOCABULARY).collect()
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all([o for o, _ in sorted(s)] == [sum(n for _, n in sorted(s)[:k]) for k in range(len(s))] for s in used.values())
    assert max(sum(n for _, n in s) for s in used.values()) <= 4096
    assert len(used) <= 1.001 * math.ceil(sum(r.length for r in got) / 4096)
