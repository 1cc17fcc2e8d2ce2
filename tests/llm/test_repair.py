from __future__ import annotations

import hashlib
import random

import pytest

from martlens.llm import repair

WORSE = (1 << 30, "")


def plain(codes):
    """Cost and audit by the pattern's automaton, from the last turn back; (cost, audit) pairs compare as asked for."""
    x, y, w, z = (0, ""), (5, "I"), (10, "II"), (0, "")
    for c in reversed(codes):
        stay = 5 if c in "SUA!" else 0
        done = lambda cost, op, rest: (cost + rest[0], op + rest[1])

        def takes(initial, rest):
            if c == "x":
                return WORSE
            return done(stay, "K", rest) if c.lower() == initial else done(stay + 1, "R", rest)

        x0 = min(done(2, "D", x), takes("u", y))
        y0 = min(done(2, "D", y), takes("a", x))
        w0 = min(done(2, "D", w), takes("u", y))
        z0 = min(done(2, "D", z), takes("u", y), done(stay, "K", w) if c in "sS" else WORSE)
        x, y = min(x0, done(5, "I", y0)), min(y0, done(5, "I", x0))
        w, z = min(w0, done(5, "I", y0), done(10, "II", x0)), min(z0, done(5, "I", y0))
    return z


@pytest.mark.parametrize("letters", ["sua?xSUA!", "ua", "uaU", "uuuax", "sSuA"])
def test_audits_as_the_automaton(letters):
    rnd = random.Random(letters)
    for n in [*range(1, 13)] * 25:
        codes = "".join(rnd.choices(letters, k=n))
        assert repair.audit(codes) == plain(codes), codes


@pytest.mark.parametrize("cells", [1, 4000, 1 << 22])
def test_long_conversations_in_blocks(monkeypatch, cells):
    monkeypatch.setattr(repair, "CELLS", cells)
    rnd = random.Random(cells)
    for n in (150, 700):
        codes = "".join(rnd.choices(["ua", "u", "a", "x", "U", "A", "s", "?"], [60, 4, 4, 4, 2, 2, 1, 1], k=n))
        assert repair.audit(codes) == plain(codes)
        assert repair.audit("u" * n) == plain("u" * n)


def report(ready, rows):
    turns = ready.createDataFrame(rows, repair.TURNS.replace("conv_id", "conv_id long").replace("turn,", "turn long,").replace("role,", "role string,") + " string")
    return {r.conv_id: r for r in repair.repair_report(turns, turns).collect()}


def test_faults_and_edits(ready):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 3, "assistant", "Yes!\n"), (1, 7, "assistant", "Yes!\n"),
        (2, 0, "user", "Open"), (2, None, "user", "Before."), (2, 1, "assistant", " \t"), (2, 2, "assistant", "Sure. \x85"),
        (3, None, None, None), (3, None, "", "x."),
        (None, 5, "assistant", "a."), (None, 5, "Assistant", "a."),
        (4, 0, "usher", "Kept as it is."), (4, 1, "tool", "Out 1."),
        (5, 0, "user", "End."),
    ]
    got = report(ready, rows)
    one = got[1]
    assert (one.gaps, one.blank, one.duplicate, one.truncated, one.illegal, one.cost, one.audit) == (4, 0, 1, 0, 1, 2, "KKKD")
    assert one.repaired_sha256 == hashlib.sha256(b"system:Be kind.\nuser:Hi?\nassistant:Yes!\n").hexdigest()
    two = got[2]
    assert (two.gaps, two.blank, two.duplicate, two.truncated) == (0, 1, 0, 2) and (two.cost, two.audit) == plain("uUxA")
    three = got[3]
    assert (three.gaps, three.blank, three.illegal, three.cost, three.audit) == (0, 1, 1, 4, "DD")
    assert three.repaired_sha256 == hashlib.sha256().hexdigest()
    assert got[None].audit == plain("?a")[1] and got[None].cost == plain("?a")[0] and got[None].illegal == 1
    assert got[4].audit == "KR" and got[4].repaired_sha256 == hashlib.sha256(b"usher:Kept as it is.\nassistant:Out 1.").hexdigest()
    assert (got[5].cost, got[5].audit) == (2, "D")


def test_one_long_conversation_among_many(ready):
    rnd = random.Random(5)
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"{t}." if rnd.random() > 0.05 else rnd.choice(["", "cut", "0."])) for t in range(3000)]
    rows += [(100 + k, t, "ua"[t % 2].replace("u", "user").replace("a", "assistant"), "word " * 20_000 + ".") for k in range(3) for t in range(2)]
    got = report(ready, rows)
    seen, codes = set(), []
    for _, _, role, text in rows[:3000]:
        codes.append("x" if not text or (role, text) in seen else role[0] if text[-1] == "." else role[0].upper())
        seen.add((role, text))
    assert (got[7].cost, got[7].audit) == plain("".join(codes))
    assert all(got[100 + k].audit == "KK" and got[100 + k].cost == 0 for k in range(3))


def test_no_turns_left(ready):
    schema = "conv_id long, turn long, role string, text string, fault string, step long"
    turns = ready.createDataFrame([(1, 0, "user", "a.", "f", 1), (2, 0, "user", "a.", "f", 1)], schema)
    got = {r.conv_id: r for r in repair.repair_report(turns, turns.where("conv_id = 2")).collect()}
    assert tuple(got[1])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) and got[2].audit == "D"
    assert repair.repair_report(turns.limit(0), turns.limit(0)).count() == 0
    assert repair.repair_report(turns, turns.limit(0)).count() == 2
