"""Byte-pair encoding by backtracking over longest matches, and decoding through an offset table.

An Aho-Corasick automaton over the vocabulary finds the longest token at every position of a word.  A
row of tokens is what the merges would give exactly when every two neighbours are stable, that is when
no merge across their border would have come before the merges inside them.  The encoder takes longest
tokens, asks a table of neighbours whether they are stable, and steps back to shorter tokens where they
are not; every position is given up at most once, so a word takes linear time.

The vocabulary has word ends: the last symbol of a word carries a mark.  Texts are composed (NFC),
white space is collapsed, letters are lowered one by one, and words are runs of letters, single digits
or runs of other signs.  The two control tokens are found in the raw text.

Defined cases: a null text is empty and has no ids; a text of white space alone has no ids; repeated
rows are encoded each on its own; a text of any length is encoded whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from martlens.llm.common import whole_texts

# The pattern of words and the mark of a word's end are those of the vocabulary file.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WORD_END = "</w>"

#: Stands for the mark inside this module; no byte of a text is ever written as a blank.
END = " "
#: Separators that str.split() would take although the pattern \s does not.
NOT_SPACE = regex.compile("[\x1c-\x1f]")
SPACES = regex.compile(r"\s+")
#: Pieces of text whose ids are kept per worker; the store starts anew when it is full.
REMEMBERED = 800_000


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte: itself if it has one, else one past 255 in turn."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(hidden)) for b in range(256)]


class WordBpe:
    """One vocabulary file with merges and word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.control = {t["content"]: t["id"] for t in spec["added_tokens"]}
        marked = lambda t: t[: -len(WORD_END)] + END if t.endswith(WORD_END) else t
        self.ids = {marked(t): i for t, i in vocab.items() if t not in self.control}
        # rank 0: a single symbol; the n-th merge makes a token of rank n
        self.rank = dict.fromkeys(self.ids.values(), 0)
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for n, (left, right) in enumerate(pairs, 1):
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.rank[whole], self.halves[whole], self.merged[a, b] = n, (a, b), n
        self.finder = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.finder.add_word(t, (i, len(t)))
        self.finder.make_automaton()
        # the longest token that begins another one, 0 length if there is none
        self.shorter = {i: self._beginning(t) for t, i in self.ids.items()}
        self.signs = {b: s for b, s in enumerate(byte_signs()) if chr(b) != s}
        self.neighbours: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.splitter = regex.compile("|".join(map(regex.escape, self.control)))
        names = {**{i: t.replace(END, WORD_END) for t, i in self.ids.items()}, **{i: t for t, i in self.control.items()}}
        self.spelling = OffsetTable(names)
        self.decimals = OffsetTable({i: str(i) for i in names})

    def _beginning(self, text: str) -> tuple[int, int]:
        return next(((self.ids[text[:n]], n) for n in range(len(text) - 1, 0, -1) if text[:n] in self.ids), (-1, 0))

    def stable(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between neighbours a and b in place."""
        # Undo the merges at the border from the last to the first.  While a piece still stands, a merge
        # across the border that ranks before it would have come first.  Of equal ranks the left one does.
        before = len(self.merged) + 1
        while True:
            rank = self.merged.get((a, b))
            if rank is not None and rank < before:
                return False
            left, right = self.rank[a], self.rank[b]
            if not left and not right:
                return True
            if left > right:
                before, a = left, self.halves[a][1]
            else:
                before, b = right + 1, self.halves[b][0]

    def _remembered(self, pair: int) -> bool:
        if len(self.neighbours) >= REMEMBERED:
            self.neighbours.clear()
        answer = self.neighbours[pair] = self.stable(pair >> 20, pair & 0xFFFFF)
        return answer

    def word(self, word: str) -> list[int]:
        """The ids of one word, as its bytes are merged."""
        if word.isascii() and word.isprintable():
            signs = word + END
        else:
            signs = word.encode().decode("latin-1").translate(self.signs) + END
        known, ask = self.neighbours.get, self._remembered
        out, at, last = [], 0, -1
        for end, (token, size) in self.finder.iter_long(signs):
            pair = last << 20 | token
            if end + 1 - size != at or (last >= 0 and not (ask(pair) if (k := known(pair)) is None else k)):
                break
            out.append(token)
            at, last = end + 1, token
        return out if at == len(signs) else self._step_back(signs)

    def _step_back(self, signs: str) -> list[int]:
        total = len(signs)
        longest = [(-1, 0)] * (total + 1)
        for end, found in self.finder.iter(signs):  # by end: what comes later at a place is longer
            longest[end + 1 - found[1]] = found
        known, ask, shorter = self.neighbours.get, self._remembered, self.shorter
        closed = bytearray(total + 1)
        out, sizes = [], []
        at, (token, size) = 0, longest[0]
        while at < total:
            while size:
                if not closed[at + size]:
                    if not out:
                        break
                    pair = out[-1] << 20 | token
                    if ask(pair) if (k := known(pair)) is None else k:
                        break
                token, size = shorter[token]
            if size:
                out.append(token)
                sizes.append(size)
                at += size
                token, size = longest[at]
            elif out:  # nothing fits here: give this place up and take less of the token before
                closed[at] = 1
                token, size = out.pop(), sizes.pop()
                at -= size
            else:
                raise ValueError("the vocabulary cannot spell this word")
        return out

    def _piece(self, piece: str) -> bytes:
        """The ids of a text without white space; words and pieces share one store."""
        if piece.isalpha():
            ids = array("I", self.word(piece)).tobytes()
        else:
            if piece[-1] in ".," and piece[:-1].isalpha():
                words = [piece[:-1], piece[-1]]
            else:
                words = WORD.findall(piece)
            if len(words) == 1:
                ids = array("I", self.word(piece)).tobytes()
            else:
                ids = b"".join([self.pieces.get(w) or self._piece(w) for w in words])
        if len(self.pieces) >= REMEMBERED:
            self.pieces.clear()
        self.pieces[piece] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        pieces = text.split() if not NOT_SPACE.search(text) else [p for p in SPACES.split(text) if p]
        get, make = self.pieces.get, self._piece
        return b"".join([get(p) or make(p) for p in pieces])

    def encode(self, text: str) -> np.ndarray:
        """All ids of a text, without added control tokens, as unsigned 32-bit numbers."""
        if "<|" not in text:
            return np.frombuffer(self._plain(text), dtype="<u4")
        out, at = [], 0
        for m in self.splitter.finditer(text):
            out += [self._plain(text[at : m.start()]), np.array([self.control[m[0]]], dtype="<u4").tobytes()]
            at = m.end()
        return np.frombuffer(b"".join([*out, self._plain(text[at:])]), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts in UTF-8, joined by one blank; word ends keep their mark."""
        return self.spelling.spell(ids)


class OffsetTable:
    """The texts of all ids in one buffer, each followed by a blank, and where each begins."""

    def __init__(self, names: dict[int, str]):
        parts = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.buffer = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def spell(self, ids: np.ndarray) -> bytes:
        return b"".join(self._spelled(ids[i : i + 1_000_000]) for i in range(0, len(ids), 1_000_000))[:-1]

    def _spelled(self, ids: np.ndarray) -> bytes:
        starts = self.offsets[ids]
        sizes = self.offsets[ids + np.uint32(1)] - starts
        ends = np.cumsum(sizes)
        return self.buffer[np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)].tobytes()


@functools.lru_cache(maxsize=2)
def coder(path: str) -> WordBpe:
    """The coder of a vocabulary file, built once per Python worker."""
    return WordBpe(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for b in batches:
            ids = [bpe.encode(t) for t in b["text"].to_pylist()]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = pa.array(np.concatenate([np.empty(0, "<u4"), *ids]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.ListArray.from_arrays(pa.array(ends), flat)], ["doc_id", "ids"])

    texts = whole_texts(docs)
    return texts.mapInArrow(rows, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of ids and the SHA-256 of ids and of the decoded text, without shipping either."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for b in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in b["text"].to_pylist():
                ids = bpe.encode(text)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(bpe.decimals.spell(ids)).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
