from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from martlens.llm import repeats


@pytest.mark.parametrize("doc_id", [None, 7])
def test_many_texts_under_one_id(ready, doc_id):
    rnd = random.Random(5)
    some = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    shared = [some(60) for _ in range(400)]
    texts = sorted({some(40) + rnd.choice(shared) + some(rnd.randint(0, 40)) for _ in range(2500)})
    docs = ready.createDataFrame([(doc_id, t) for t in texts], "doc_id long, text string")
    seen, want = set(), []
    for r in sorted(docs.select("text", F.xxhash64("text").alias("h")).collect(), key=lambda r: r.h):
        data, gone = r.text.encode(), set()
        for i in range(len(data) - 49):
            if data[i : i + 50] in seen:
                gone.update(range(i, i + 50))
            seen.add(data[i : i + 50])
        want.append(bytes(b for i, b in enumerate(data) if i not in gone))
    got = repeats.without_repeats(docs, 50).collect()
    assert {r.doc_id for r in got} == {doc_id}
    assert sorted(bytes(r.kept) for r in got) == sorted(want)
