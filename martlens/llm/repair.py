"""Repair of conversations whose turns do not follow the grammar `(s?(ua)+)?` of role initials.

A conversation's turns are aligned with every feasible length of the alternating string by Wagner and Fischer's table of
edits: keep 0, rerole to user or assistant 1, delete 2, insert an empty turn 5, and 5 more for a truncated turn that
stays.  Filled from the last turn backwards, one table serves all lengths, since a cell needs the number of characters
still to come and not the length they belong to; a second table holds the lengths that begin with a system turn.  A greedy
repair gives the incumbent cost; cells that no repair as cheap can reach lie outside Ukkonen's band and are not
filled.  The audits of all cheapest lengths are traced together, step by step, and those that fall behind in ASCII order
are given up.  Of a long conversation only every so many rows of the table stay in memory; the others are filled again when
the trace comes to them.

Spark deals the turns: one shuffle numbers them inside their conversation and marks their faults; the table sees one byte a
turn; its edits are rows that join the turns again by (conversation, place), so the texts of one long conversation meet
only in the stream that digests them.  The table of one conversation is one task's work and grows with its turns times
the width of its band.

Defined cases: a null role or text is one space; a null id is a conversation of its own; turns without a number come
first; equal numbers are ordered by role and text, and a repeated row follows its original.  A conversation of any length,
an empty one included, gets one row.  An empty table gives no rows; columns other than the four are left behind.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from martlens.llm.common import prepare, stored

SPACES = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
NONE = 1 << 40
#: Cells of a table that stay in memory; of larger ones only the rows between blocks do.
CELLS = 1 << 22
ROLES = {"u": "user", "a": "assistant"}
TURNS = "conv_id, turn, role, text"


def damaged(conversations: DataFrame) -> DataFrame:
    """The test damage of the query: by a checksum of its key a row is dropped, emptied, cut, repeated or given to the user."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    cut = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    given = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", given.alias("role"), cut.alias("text"), copies.alias("copy")).drop("copy")


def marked(turns: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text, fault, illegal): turns numbered from 1, each with its first fault."""
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = turns.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))).repartition("conv_id")
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    said = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(said == "", "blank").when(F.col("again"), "duplicate").when(~F.right(said, F.lit(1)).isin(".", "!", "?"), "truncated")
    along = Window.partitionBy("conv_id").orderBy(*order)
    initial = F.substring("role", 1, 1)
    pair = F.concat(F.lag(initial).over(along), initial)
    numbered = dealt.withColumn("again", again).select(
        "conv_id", F.row_number().over(along).cast("long").alias("place"), "turn", "role", "text",
        fault.alias("fault"), F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
    )
    return stored(numbered)


def incumbent(codes: str) -> int:
    """The cost of a repair found in one pass: whatever does not continue the pattern is deleted."""
    cost, last, begun = 0, "", False
    for c in codes:
        if c == "u" and last != "u" or c == "a" and last == "u" or c == "s" and not begun:
            last, begun = c, True
        else:
            cost += DELETE
    cost += INSERT if last == "u" else 2 * INSERT if last == "s" else 0
    return min(cost, DELETE * len(codes))


class Table:
    """Cheapest edits from row i on, with r characters of the target to come: `rows(i)` holds (low, plain, opened).

    `plain` is for r characters of ...uaua, `opened` for a system turn and then an even number r of them.
    """

    def __init__(self, codes: str):
        self.codes, n = codes, len(codes)
        stays = np.array([c.islower() or c == "?" for c in codes] + [False])
        bad = np.array([c not in "suax?" for c in codes] + [False])
        forced = np.array([c == "x" for c in codes] + [False])
        stays &= ~forced
        clean = stays[::-1].cumsum()[::-1]
        spare = incumbent(codes) - DELETE * int(forced.sum() + bad.sum())
        # with r characters to come, a path spends at least 2 for each clean turn too many and 3 for each one too few
        self.low, self.high = np.maximum(clean - spare // 2 - 1, 0), clean + spare // 3 + 1
        width = int((self.high - self.low).max()) + 1
        self.block = n + 1 if (n + 1) * width <= CELLS else math.isqrt(n) + 1
        r = np.arange(self.low[n], self.high[n] + 1)
        last = (int(self.low[n]), INSERT * r, np.full(len(r), NONE))
        self.saved, self.held, row = {n: last}, {n: last}, last
        for i in range(n - 1, -1, -1):
            row = self._above(i, row)
            if self.block > n:
                self.held[i] = row
            elif i % self.block == 0:
                self.saved[i] = row
        self.first = row

    def _above(self, i: int, below: tuple) -> tuple:
        low, size, c = int(self.low[i]), int(self.high[i] - self.low[i]) + 1, self.codes[i]
        plain, before, opened = (_moved(below[0], below[k], at, size) for k, at in ((1, low), (1, low - 1), (2, low)))
        r = np.arange(low, low + size)
        best, begun = DELETE + plain, DELETE + opened
        if c != "x":
            kept = 0 if c in "sua?" else TRUNCATED
            is_u, is_a = c in "uU", c in "aA"
            match = np.where(r % 2 == 0, 0 if is_u else REROLE, 0 if is_a else REROLE)
            best = np.minimum(best, before + match + kept)
            if c in "sS":
                begun = np.minimum(begun, np.where((r % 2 == 0) & (r > 1), plain + kept, NONE))
        return low, np.minimum.accumulate(best - INSERT * r) + INSERT * r, begun

    def rows(self, i: int) -> tuple:
        if i not in self.held:  # fill the block from row i to the next saved one again
            end = min((k for k in self.saved if k > i), default=len(self.codes))
            start = max(k for k in (*self.saved, 0) if k <= i)
            self.held, row = {end: self.saved[end]}, self.saved[end]
            for k in range(end - 1, start - 1, -1):
                self.held[k] = row = self._above(k, row)
        return self.held[i]

    def at(self, i: int, r: int, opened: bool) -> int:
        low, *rows = self.rows(i)
        values = rows[opened]
        return int(values[r - low]) if 0 <= r - low < len(values) else NONE


def _moved(low: int, values: np.ndarray, to: int, size: int) -> np.ndarray:
    """The same row from another first cell on."""
    out = np.full(size, NONE)
    a, b = max(low, to), min(low + len(values), to + size)
    if a < b:
        out[a - to : b - to] = values[a - low : b - low]
    return out


def audit(codes: str) -> tuple[int, str]:
    """The least cost and the ASCII-least audit that has it.

    One character for each turn: x must go (blank or duplicate); s, u, a and ? are role initials, S, U, A and ! those
    of truncated turns.
    """
    table = Table(codes)
    low, plain, opened = table.first
    r = np.arange(low, low + len(plain))
    ends = [(int(v), int(k), kind) for kind, row in ((False, plain), (True, opened)) for k, v in zip(r, row) if k % 2 == 0]
    cost = min(v for v, _, _ in ends)
    paths = [(k, kind) for v, k, kind in ends if v == cost]
    i, n, out = 0, len(codes), []
    while not (i == n and any(k == 0 and not kind for k, kind in paths)):
        moves: dict[str, list[tuple[int, bool]]] = {}
        c = codes[i] if i < n else "x"
        kept = 0 if c in "sua?" else TRUNCATED
        for k, kind in paths:
            value = table.at(i, k, kind)
            want = "" if k == 0 else "u" if k % 2 == 0 else "a"
            if i < n and value == DELETE + table.at(i + 1, k, kind):
                moves.setdefault("D", []).append((k, kind))
            if not kind and k and value == INSERT + table.at(i, k - 1, False):
                moves.setdefault("I", []).append((k - 1, False))
            if c == "x":
                continue
            if kind and c in "sS" and value == kept + table.at(i + 1, k, False):
                moves.setdefault("K", []).append((k, False))
            if not kind and k:
                after = kept + table.at(i + 1, k - 1, False)
                if c.lower() == want and value == after:
                    moves.setdefault("K", []).append((k - 1, False))
                if value == REROLE + after:
                    moves.setdefault("R", []).append((k - 1, False))
        step = min(moves)
        paths, i = list(dict.fromkeys(moves[step])), i + (step != "I")
        out.append(step)
    return cost, "".join(out)


@functools.lru_cache(maxsize=1 << 16)
def _short(codes: str) -> str:
    return audit(codes)[1]


def edits(turns: DataFrame) -> DataFrame:
    """(conv_id, step, op, place, given): the edits of every conversation in order; `given` is a new turn's or a changed role."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def edited(conv: pa.Scalar, codes: str) -> pa.RecordBatch:
        found = _short(codes) if len(codes) <= 64 else audit(codes)[1]
        stay = sum(op != "D" for op in found)
        target = iter("s" * (stay % 2) + "ua" * (stay // 2))
        given = [None if op == "D" else ROLES.get(next(target)) if op in "IR" else next(target) and None for op in found]
        takes = np.array([op != "I" for op in found], bool)
        place = pa.array(takes.cumsum(), pa.int64(), mask=~takes)
        columns = [pa.repeat(conv, len(found)), pa.array(range(len(found)), pa.int64()), pa.array(list(found), pa.string()), place, pa.array(given, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "step", "op", "place", "given"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, out = None, [], []
        for b in batches:
            starts = np.flatnonzero(b["place"].to_numpy() == 1)
            codes = "".join(b["code"].to_pylist())
            cuts = [0, *starts.tolist(), len(codes)]
            held.append(codes[: cuts[1]])
            for k in range(len(starts)):
                if conv is not None:
                    out.append(edited(conv, "".join(held)))
                conv, held = b["conv_id"][cuts[k + 1]], [codes[cuts[k + 1] : cuts[k + 2]]]
            if sum(o.num_rows for o in out) > 4096:
                yield from out
                out = []
        if conv is not None:
            out.append(edited(conv, "".join(held)))
        yield from out

    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("?")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.translate(F.upper(known), "?", "!")).otherwise(known)
    # a byte a turn: by size alone Spark would lay all of them into one task, but the tables take time
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.select("conv_id", "place", code.alias("code")).repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "place")
    return dealt.mapInArrow(rows, f"conv_id {kind}, step long, op string, place long, given string")


def repaired(turns: DataFrame) -> DataFrame:
    """(conv_id, step, op, turn, role, text, fault, illegal): every edit with the turn it is about; the repaired
    conversation is what is not deleted, in order of `step`."""
    steps = edits(turns).alias("e")
    own = turns.alias("t")
    same = F.col("e.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("e.place") == F.col("t.place"))
    return steps.join(own, same, "left").select(
        "e.conv_id", "step", "op", "turn", F.coalesce("given", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        "fault", F.coalesce("illegal", F.lit(False)).alias("illegal"),
    )


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def reports(steps: DataFrame) -> DataFrame:
    """Per conversation its faults, the cost and audit of the repair, and a digest of the repaired turns, which stream by."""
    kind = steps.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired_sha256 string"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, done = None, []

        def close():
            turns = [last - first + 1 - distinct] if distinct else [0]
            done.append((conv, *turns, *(counts[c] for c in _COUNTS[1:]), "".join(ops), digest.hexdigest()))

        def batch():
            ids = pa.array([d[0].as_py() for d in done], id_type)
            columns = [ids, *(pa.array([d[k] for d in done], pa.int64()) for k in range(1, 7)), *(pa.array([d[k] for d in done], pa.string()) for k in (7, 8))]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv_id", *_COUNTS, "audit", "repaired_sha256"])

        for b in batches:
            id_type, ids = b.schema.field("conv_id").type, b["conv_id"]
            columns = (b[c].to_pylist() for c in ("step", "op", "turn", "role", "text", "fault", "illegal"))
            for at, (step, op, turn, role, text, fault, illegal) in enumerate(zip(*columns, strict=True)):
                if step == 0:
                    if conv is not None:
                        close()
                    conv, ops, digest = ids[at], [], hashlib.sha256()
                    counts, first, last, distinct, stays = dict.fromkeys(_COUNTS, 0), 0, None, 0, False
                ops.append(op)
                counts["cost"] += {"D": DELETE, "I": INSERT, "R": REROLE, "K": 0}[op] + (TRUNCATED if op != "D" and fault == "truncated" else 0)
                if fault:
                    counts[fault] += 1
                counts["illegal"] += illegal
                if turn is not None and turn != last:
                    first, last, distinct = turn if last is None else first, turn, distinct + 1
                if op != "D":
                    digest.update(f"{chr(10) if stays else ''}{role}:{text}".encode())
                    stays = True
            if len(done) > 256:
                yield batch()
        if conv is not None:
            close()
            yield batch()

    dealt = steps.repartition("conv_id").sortWithinPartitions("conv_id", "step")
    return dealt.select("conv_id", "step", "op", "turn", "role", "text", "fault", "illegal").mapInArrow(rows, schema)


def repair_report(originals: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for every conversation of `originals`, those without a turn left included."""
    prepare(turns.sparkSession)
    found = reports(repaired(marked(turns)))
    ids = originals.select(F.col("conv_id").alias("original")).distinct()
    joined = ids.join(found, F.col("original").eqNullSafe(F.col("conv_id")), "left")
    empty = hashlib.sha256().hexdigest()
    return joined.select(
        F.col("original").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
