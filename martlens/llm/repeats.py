"""Repeated byte windows by depth-limited passes over suffixes, as a radix sort makes them, with another choice of digits.

A suffix matters only through its first `window` bytes, so it is looked at no further than that, in passes of
growing depth.  A pass of depth k files every window under one digit of k bytes: not its leading bytes, as in a plain
sort by most significant digits, but the k bytes inside it whose hash is smallest, since windows that start near each other
then share their digit and need not all cross the shuffle.  Equal windows hold the same digit at the same place, hence always meet.  Neighbouring
windows under the same occurrence of a digit form a cell, and only cells travel, not windows:

* a digit with one occurrence ends the matter: its windows are unique;
* equal cells (digit and whole bytes) are repeats, all but the first;
* where one digit has different cells, the first cell of each kind goes to the next pass.

In the last pass digits are whole windows, and equal groups are exactly the repeated windows.  Each task
keeps only the first of its equal cells before the shuffle, so a passage that a third of all documents hold
crosses it about once a task.  After the shuffle rows are sorted and streamed with the memory of two rows.

Digits and cells are compared through two independent 64-bit hashes.

Defined cases: a null text is empty; a text shorter than a window keeps all its bytes; of equal windows the
one in the smallest id, then at the smallest place, stays.  A null id comes after all others.  Rows with the
same id are ordered by a hash of their text, and rows alike in id and text count as one document, each
copy getting the same result.  Texts of any length are hashed whole, CHUNK bytes at a time.  An empty table gives no row,
and other columns stay behind.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martlens.llm.common import stored

#: Bytes hashed at once, and cells that a task compares before it sends them on.
CHUNK, HELD = 1 << 20, 1 << 19
#: Depths of the passes as shares of the window; the last is the window itself.
DEPTHS = (0.28, 0.85, 1.0)
NULL_ID = 2**63 - 1
CELLS = "anchor long, cell long, doc long, tag long, place long"

_POSITION = np.uint64((1 << 24) - 1)
_STEP = 0x9E3779B97F4A7C15


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random odd number for each byte value, and the powers of the hash's base and of its inverse."""
    signs = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
    powers = np.full(CHUNK + (1 << 16), _STEP, np.uint64)
    inverses = np.full(len(powers), pow(_STEP, -1, 2**64), np.uint64)
    powers[0] = inverses[0] = 1
    return signs, np.cumprod(powers), np.cumprod(inverses)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def cells_of(parts: list[bytes], window: int, depth: int) -> tuple[np.ndarray, ...]:
    """(anchor, cell, part, start, windows) of all cells of some byte strings, none of which share a window."""
    signs, powers, inverses = _tables()
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    firsts = np.cumsum(sizes) - sizes
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(signs[data] * powers[:n], out=sums[1:])
    grams = _mixed((sums[depth:] - sums[:-depth]) * inverses[: n - depth + 1])
    # the place of the smallest hash in every window, by doubling; equal hashes: the leftmost
    least = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while reach < window - depth + 1:
        step = min(reach, window - depth + 1 - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    held = np.maximum(sizes - window + 1, 0)
    of = np.repeat(np.arange(len(parts)), held)
    starts = np.arange(held.sum()) + np.repeat(firsts - np.cumsum(held) + held, held)
    at = (least[starts] & _POSITION).astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    windows = np.diff(np.concatenate([edge, [len(at)]]))
    start = starts[edge]
    end = start + windows - 1 + window
    # mixed another way than the digits, so that the two hashes are independent
    cell = _mixed(((sums[end] - sums[start]) * inverses[start]) ^ (windows.astype(np.uint64) * np.uint64(0xC4CEB9FE1A85EC53)))
    of = of[edge]
    return grams[at[edge]].view(np.int64), cell.view(np.int64), of, start - firsts[of], windows


def _first_and_later(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by (anchor, cell, doc, tag, place): which begin an anchor, and the row that begins their cell."""
    anchor, cell = rows[0], rows[1]
    new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    new_cell = new_anchor | np.concatenate([[True], cell[1:] != cell[:-1]])
    begin = np.maximum.accumulate(np.where(new_cell, np.arange(len(anchor)), 0))
    return new_anchor, begin


def _alike(rows: list[np.ndarray], begin: np.ndarray) -> np.ndarray:
    """Which rows are of the same document and place as the row that begins their cell."""
    return np.logical_and.reduce([c == c[begin] for c in rows[2:]])


def _arrow(columns: list, names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


class _Sender:
    """Collects a task's cells and lets the first of each kind through; later ones are known to be repeats."""

    def __init__(self, window: int, depth: int):
        self.window, self.depth = window, depth
        self.parts: list[bytes] = []
        self.of: list[tuple[int, int, int]] = []
        self.size = 0
        self.rows: list[list[np.ndarray]] = []
        self.held = 0

    def add(self, doc: int, tag: int, base: int, data: bytes) -> Iterator[pa.RecordBatch]:
        """One byte string that begins at byte `base` of its document; long ones go in chunks of windows."""
        for at in range(0, max(len(data) - self.window + 1, 0), CHUNK):
            part = data[at : at + CHUNK + self.window - 1] if len(data) > CHUNK else data
            if self.size + len(part) > CHUNK:
                yield from self.hashed()
            self.parts.append(part)
            self.of.append((doc, tag, base + at))
            self.size += len(part)

    def hashed(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            anchor, cell, of, start, windows = cells_of(self.parts, self.window, self.depth)
            doc, tag, base = (np.array(x, np.int64) for x in zip(*self.of, strict=True))
            place = ((start + base[of]) << 8) | windows
            self.rows.append([anchor, cell, doc[of], tag[of], place])
            self.held += len(anchor)
            self.parts, self.of, self.size = [], [], 0
        if self.held >= HELD:
            yield from self.sent()

    def sent(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        rows = [np.concatenate(c) for c in zip(*self.rows, strict=True)]
        self.rows, self.held = [], 0
        order = np.lexsort(rows[::-1])
        rows = [c[order] for c in rows]
        _, begin = _first_and_later(rows)
        first = begin == np.arange(len(begin))
        same = _alike(rows, begin)
        keep = first | ~same
        later = ~first[keep]
        anchor, cell, doc, tag, place = (c[keep] for c in rows)
        # a known repeat has no cell; it crosses the shuffle under a number of its own
        anchor = np.where(later, _mixed((doc ^ tag ^ (place << 20)).view(np.uint64)).view(np.int64), anchor)
        for at in range(0, len(anchor), 1 << 16):
            s = slice(at, at + (1 << 16))
            cells = pa.array(cell[s], pa.int64(), mask=later[s])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[s]), cells, *(pa.array(c[s]) for c in (doc, tag, place))], ["anchor", "cell", "doc", "tag", "place"]
            )

    def rest(self) -> Iterator[pa.RecordBatch]:
        yield from self.hashed()
        yield from self.sent()


def _whole(window: int, depth: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(window, depth)
        for b in batches:
            for doc, tag, text in zip(*(b[c].to_pylist() for c in ("doc", "tag", "text")), strict=True):
                yield from sender.add(doc, tag, 0, text.encode())
        yield from sender.rest()

    return rows


def _ranges(places: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (first start, number of starts) of one document's places, overlapping or touching ones joined."""
    p = np.unique(np.array(places, np.int64))
    starts = p >> 8
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], (starts + (p & 255))[order]
    if not len(starts):
        return starts, starts
    reach = np.maximum.accumulate(ends)
    edge = np.concatenate([[True], starts[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(edge)[1:] - 1, [len(edge) - 1]])
    return starts[edge], reach[last] - starts[edge]


def _within(window: int, depth: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(window, depth)
        for b in batches:
            for doc, tag, text, places in zip(*(b[c].to_pylist() for c in ("doc", "tag", "text", "places")), strict=True):
                data = text.encode()
                for start, count in zip(*_ranges(places), strict=True):
                    yield from sender.add(doc, tag, int(start), data[start : start + count - 1 + window])
        yield from sender.rest()

    return rows


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted cells to (doc, tag, place, contested): repeats, and first cells whose anchor has other cells too."""
    held: list[np.ndarray] = [np.empty(0, np.int64)] * 5
    sent = 0  # of the held rows, how many have been given out

    def out(doc, tag, place, contested):
        return _arrow([doc, tag, place, contested], ["doc", "tag", "place", "contested"], [pa.int64()] * 3 + [pa.bool_()])

    for b in batches:
        known = np.asarray(b["cell"].is_null())
        if known.any():
            doc, tag, place = (b[c].to_numpy()[known] for c in ("doc", "tag", "place"))
            yield out(doc, tag, place, np.zeros(len(doc), bool))
            b = b.filter(pa.array(~known))
        if not b.num_rows:
            continue
        rows = [np.concatenate([h, b[c].to_numpy()]) for h, c in zip(held, ("anchor", "cell", "doc", "tag", "place"), strict=True)]
        n = len(rows[0])
        new_anchor, begin = _first_and_later(rows)
        first = begin == np.arange(n)
        later = ~first & ~_alike(rows, begin)
        group = np.cumsum(new_anchor) - 1
        contested = first & (np.bincount(group, weights=first) > 1)[group]
        give = (contested | later) & (np.arange(n) >= sent)
        yield out(*(c[give] for c in rows[2:]), contested[give])
        # the last anchor may go on: keep its first row and the row that begins its last cell
        opened = np.flatnonzero(new_anchor)[-1]
        stay = np.unique([opened, begin[-1]])
        held = [c[stay] for c in rows]
        sent = len(stay) if contested[opened] else 0


def _sorted_out(cells: DataFrame) -> DataFrame:
    dealt = cells.repartition("anchor").sortWithinPartitions("anchor", "cell", "doc", "tag", "place")
    return stored(dealt.mapInArrow(_streamed, "doc long, tag long, place long, contested boolean"))


def repeated_places(keyed: DataFrame, window: int) -> list[DataFrame]:
    """Per pass (doc, tag, place): runs of window starts that repeat an earlier window."""
    depths = [max(1, round(window * d)) for d in DEPTHS]
    if window - depths[0] + 1 > 255:
        raise ValueError("a cell holds at most 255 windows: use a window of at most 350")
    found = []
    cells = keyed.mapInArrow(_whole(window, depths[0]), CELLS)
    for level, depth in enumerate(depths):
        if level:
            todo = _by_document(open_cells)
            texts = keyed.join(todo.hint("shuffle_hash"), ["doc", "tag"]).select("doc", "tag", "text", "places")
            cells = texts.mapInArrow(_within(window, depth), CELLS)
        out = _sorted_out(cells)
        found.append(out.where(~F.col("contested")).select("doc", "tag", "place"))
        open_cells = out.where("contested").select("doc", "tag", "place")
    return found


def _by_document(places: DataFrame) -> DataFrame:
    """The places of each text; a text that comes several times under one id gives each of its places once."""
    return places.groupBy("doc", "tag").agg(F.collect_set("place").alias("places"))


def keyed_texts(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc, tag, text): a non-null id, and the hash of the text that tells apart rows with the same id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    return docs.select(doc.alias("doc"), F.xxhash64(text).alias("tag"), text.alias("text"), *more)


def _cut(batch: pa.RecordBatch, window: int) -> tuple[list[bytes], list[list[tuple[int, int]]]]:
    """What stays of each text of (text, places), and the runs that go."""
    kept, spans = [], []
    for text, places in zip(*(batch[c].to_pylist() for c in ("text", "places")), strict=True):
        data, runs = text.encode(), []
        if places:
            starts, counts = _ranges(places)
            runs = _joined(starts, starts + counts - 1 + window)
        ends = [0, *(end for _, end in runs)]
        starts_of_cuts = [*(start for start, _ in runs), len(data)]
        kept.append(b"".join(data[a:b] for a, b in zip(ends, starts_of_cuts, strict=True)))
        spans.append(runs)
    return kept, spans


def _with_places(docs: DataFrame, window: int) -> DataFrame:
    """doc, tag, text, the whole row as a struct, and the places of the text's repeated windows."""
    found = None
    for places in repeated_places(keyed_texts(docs), window):
        found = places if found is None else found.unionByName(places)
    # the text travels once: the struct holds the other columns
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    keyed = keyed_texts(docs, F.struct(*others).alias("row"))
    joined = keyed.join(_by_document(found).hint("shuffle_hash"), ["doc", "tag"], "left")
    return joined.select("doc", "tag", "text", "row", "places")


def without_repeats(docs: DataFrame, window: int = 100) -> DataFrame:
    """(doc_id, kept, spans): the bytes that stay, and the maximal removed runs as (start, end) byte places.

    A byte goes if a `window` that covers it also starts earlier, in a smaller document or before in its own.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            kept, spans = _cut(b, window)
            ids = [None if doc == NULL_ID else doc for doc in b["doc"].to_pylist()]
            runs = [[{"start": s, "end": e} for s, e in cut] for cut in spans]
            yield _arrow([ids, kept, runs], ["doc_id", "kept", "spans"], [pa.int64(), pa.binary(), kind])

    marked = _with_places(docs.select("doc_id", "text"), window).drop("row")
    return marked.mapInArrow(rows, "doc_id long, kept binary, spans array<struct<start:long,end:long>>")


def deduplicated(docs: DataFrame, window: int = 100) -> DataFrame:
    """The documents, with all their columns, and the repeats cut out of their texts.

    A letter that loses some of its bytes goes as a whole; a text of which nothing is left is empty.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, _ = _cut(b, window)
            texts = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
            yield pa.RecordBatch.from_arrays([b["row"], texts], ["row", "kept"])

    marked = _with_places(docs, window).drop("doc")
    kind = marked.schema["row"].dataType.simpleString()
    cut = marked.mapInArrow(rows, f"row {kind}, kept string")
    return cut.select(*((F.col("kept") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def _joined(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping or touching runs as one; starts are sorted."""
    out: list[tuple[int, int]] = []
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def digests(deduplicated: DataFrame) -> DataFrame:
    """Lengths and the SHA-256 of what `without_repeats` keeps."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return deduplicated.select(
        "doc_id",
        (F.octet_length("kept") + removed).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
