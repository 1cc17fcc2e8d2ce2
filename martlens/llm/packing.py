"""Sum-of-squares packing of tokenised documents into sequences of bounded length.

Every document becomes its ids and one closing id; only what is longer than a sequence is cut.  Each piece
goes where the sum over all residual gaps of (number of open sequences with that gap) squared becomes
smallest.  The rule keeps many different gaps in stock, so that later pieces find one that fits.  Pieces
are taken from long to short, and a new sequence is opened only when no open one can take the piece.

Packing needs lengths only.  Pieces are dealt at random into groups of a bounded number of rows, each of
which one task packs on its own; the sequences of a group that stay unfilled are opened again and packed together with
those of other groups, until one group is left or a round fills less than a twentieth of what it was given.

Defined cases: a null or empty text is its closing id alone; an empty table gives no row; repeated rows
are packed each on its own; pieces of one length, and gaps that are equally good, are taken in order of id and piece,
the smaller gap first.  Texts of any length are coded whole.  Columns other than the id and the text are left behind.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martlens.llm.bpe import coder
from martlens.llm.common import durable, whole_texts

#: Rows that one task packs; it holds only their lengths and the numbers of open sequences.
GROUP_ROWS = 65_536
#: Sequences with at least this share of room left are opened again with those of other groups.
ROOM = 0.005
#: A round that leaves a larger share of its pieces in unfilled sequences is the last one.
LEFT = 0.95


def pieces(docs: DataFrame, path: str, capacity: int = 4096, closing_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids and closing id, cut at `capacity`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        closing = np.array([closing_id], dtype="<u4")
        for b in batches:
            of, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(b["text"].to_pylist()):
                ids = np.concatenate([bpe.encode(text), closing])
                for n, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    of.append(k)
                    piece.append(n)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].take(pa.array(of, pa.int32())), pa.array(piece, pa.int32())]
                + [pa.array(x, pa.int64()) for x in (start, length, crc)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of its sequence and its place there, for every length (0 < length <= capacity)."""
    stock = np.zeros(capacity + 1, dtype=np.int64)  # open sequences by gap; full ones are not counted
    members: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        # half the change of the sum of squares for each gap that can take the piece; gap 0 is not counted
        change = stock[: capacity - size + 1] - stock[size:] + 1
        change[0] = -stock[size]
        usable = stock[size:] > 0
        if usable.any():
            change[~usable] = np.iinfo(np.int64).max
            gap = int(change.argmin()) + size
            which = members[gap].pop()
            stock[gap] -= 1
        else:
            gap, which, made = capacity, made, made + 1
        bins[i], places[i] = which, capacity - gap
        if gap > size:
            stock[gap - size] += 1
            members[gap - size].append(which)
    return bins, places


def _packed(rows: DataFrame, capacity: int) -> DataFrame:
    """Pack each group by itself; sequences are numbered within the group, `room` is what they leave."""

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = group["length"].to_numpy()
        bins, places = sum_of_squares(lengths, capacity)
        room = capacity - np.bincount(bins, weights=lengths).astype(np.int64)[bins]
        for name, column in (("bin", bins), ("offset", places), ("room", room)):
            group = group.append_column(name, pa.array(column, pa.int64()))
        return group

    fields = f"{rows.schema.simpleString()[7:-1]},bin:long,offset:long,room:long"
    return rows.groupBy("group").applyInArrow(pack, fields)


def packed(docs: DataFrame, path: str, capacity: int = 4096, closing_id: int = 1) -> DataFrame:
    """Every piece with its sequence and its place there: the columns of `pieces`, sequence_id and offset."""
    todo = durable(pieces(docs, path, capacity, closing_id))
    done, level = [], 0
    count = todo.count()
    while True:
        groups = max(1, math.ceil(count / GROUP_ROWS))
        dealt = todo.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(level)), F.lit(groups)))
        out = durable(_packed(dealt, capacity))
        # the last level takes all; before, a sequence with much room goes back as its pieces
        final = out if groups == 1 else out.where(F.col("room") < int(ROOM * capacity))
        number = (F.col("bin") * groups + F.col("group")) * 64 + level
        done.append(final.withColumn("sequence_id", number))
        if groups == 1:
            break
        again = out.where(F.col("room") >= int(ROOM * capacity))
        left = again.count()
        if not left:
            break
        if left > LEFT * count:  # little was filled: more rounds would not help, so keep this one
            done[-1] = out.withColumn("sequence_id", number)
            break
        todo, count, level = again.drop("group", "bin", "offset", "room"), left, level + 1
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    result = done[0].select(names)
    for more in done[1:]:
        result = result.unionByName(more.select(names))
    return result
