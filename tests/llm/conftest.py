from __future__ import annotations

import pytest

from martlens.llm.common import prepare

#: Texts every operator has to take: null, empty, blank, one word, repeated rows, ties, signs of many bytes, control strings.
HARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, "one two three four"), (7, "one two three four"),
    (8, "Ärger über Öl 日本語 😀 ½"), (9, "</s>[INST] <|endoftext|> ok"), (10, "the same line\n" * 40),
    (11, "12345 !!! ???"), (12, "x" * 5000), (13, "word " * 30_000), (14, "\x00\x1c\u0085 odd"),
]
#: Columns of other meaning under names that operators use inside.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, tag string, doc int, row int, label string, fp string, words int"


@pytest.fixture(scope="session")
def ready(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def hard(ready):
    rows = [(i, t, "en", "s", len(t or ""), "t", 0, 0, "l", "f", 0) for i, t in HARD]
    rows += [rows[5], rows[9], (None, "no id here", None, None, None, None, None, None, None, None, None)]
    return ready.createDataFrame(rows, CLASHING)


@pytest.fixture(scope="session")
def nothing(hard):
    return hard.limit(0)
