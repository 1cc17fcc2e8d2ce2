"""Groups of near copies grow by what was found last, not by all links again."""

from __future__ import annotations

from martlens.llm import near_copies
from martlens.llm.simhash import components

SO_FAR, MORE = [(1, 2), (2, 3), (5, 6), (8, 9)], [(3, 6), (9, 12)]


def test_groups_grow_as_by_all_links(ready):
    so_far, more, every = (ready.createDataFrame(x, "u long, v long") for x in (SO_FAR, MORE, SO_FAR + MORE))
    grown = near_copies._grown(near_copies._roots(so_far), more)
    assert sorted(grown.collect()) == sorted(components(every).collect())
    assert {r.root for r in grown.collect()} == {1, 8}


def test_nothing_found_costs_no_round(ready):
    roots = near_copies._roots(ready.createDataFrame(SO_FAR, "u long, v long"))
    assert near_copies._grown(roots, ready.createDataFrame([], "u long, v long")) is roots
