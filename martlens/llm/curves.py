"""Approximate nearest neighbours on shifted space-filling curves.

Vectors are projected on a few random directions, shifted by a random amount and ordered along a Hilbert curve,
several times with other directions and shifts.  Each order is cut at its quantiles into blocks of neighbouring keys.
A query looks at the blocks around its own in every order, at more of them where these hold fewer than k + 1
different vectors; what it finds is ranked by the exact inner
product of the original vectors, and the orders' findings are merged.

Equal vectors are one row with the few smallest of their ids, so a vector that a third of all rows share is
compared once.  A block is dealt to tasks in chunks of a bounded number of vectors, and its queries in slices
of a bounded number, each pair of a chunk and a slice being one product of matrices; nothing is collected but the
quantiles and the blocks' sizes, whose number is fixed.

How much of the data the windows cover is fixed by `curves`, `blocks` and `window`, at any size.  For vectors with
near neighbours a narrow window does.  Uniformly random vectors have none that are much nearer than the rest, so for
them a recall of 0.9 needs windows that together hold most rows; the defaults are set for that.

Defined cases: vectors that are null, all zero, of another length than most, or that hold a null, NaN or infinity
take no part, neither do null ids; rows that repeat id and vector count once; a score does not depend on what else is
compared, and ties go to the smaller id; with
fewer candidates all are returned; an empty table gives no row; other columns stay behind.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from martlens.llm.common import durable

CURVES, DIRECTIONS, BLOCKS, WINDOW = 24, 6, 64, 5
#: Vectors and queries multiplied at once, at most.
CHUNK, SLICE = 4096, 4096
BITS = 10


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve of integer points (rows) with coordinates of so many bits.

    From the highest bit down, a point's cell tells how the lower bits are turned: where a coordinate's bit is
    set, the lower bits of the first are flipped, else those of the two coordinates change places.
    """
    axes = list(np.ascontiguousarray(cells.T.astype(np.int64)))
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(len(axes)):
            is_set = (axes[i] >> level) & 1 == 1
            swap = np.where(is_set, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(is_set, axes[0] ^ low, axes[0] ^ swap)
            if i:
                axes[i] = axes[i] ^ swap
    # Gray code: each coordinate's bits count from those before it
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((axes[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    key = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for a in axes:
            key = key << 1 | ((a ^ turn) >> level) & 1
    return key


@functools.lru_cache(maxsize=4)
def _directions(size: int, curves: int, directions: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthogonal random directions, as many bases as are needed, and every curve's shifts."""
    rng = np.random.default_rng(11)
    bases = [np.linalg.qr(rng.standard_normal((size, size)))[0] for _ in range(-(-curves * directions // size))]
    return np.concatenate(bases, axis=1)[:, : curves * directions], rng.uniform(0, 0.5, curves * directions)


def curve_keys(x: np.ndarray, curves: int, directions: int) -> np.ndarray:
    """Vectors x curves; only the direction of a vector matters for its place."""
    planes, shifts = _directions(x.shape[1], curves, directions)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    # a random direction's share of a unit vector has a deviation of 1 / sqrt(size): four of them each way fill the grid
    spread = (unit @ planes * (np.sqrt(x.shape[1]) / 8) + 0.5 + shifts) / 1.5
    cells = np.minimum(np.clip(spread, 0, 1) * (1 << BITS), (1 << BITS) - 1).astype(np.int64)
    return np.stack([hilbert_keys(cells[:, c * directions : (c + 1) * directions], BITS) for c in range(curves)], axis=1)


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec): the components as bytes of doubles, for the vectors that take part."""
    v = F.col(vector_col)
    sized = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
    sized = sized.where("vec_id is not null and v is not null and size(v) > 0")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sized = sized.where(~odd & F.exists("v", lambda x: x != 0))
    common = sized.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    length = common["n"] if common else 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, length) + 0.0  # -0.0 becomes 0.0
            yield pa.RecordBatch.from_arrays([b["vec_id"], pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "vec"])

    return sized.where(F.size("v") == length).mapInArrow(rows, "vec_id long, vec binary").distinct()


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def in_order(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of one vector with some, each summed in the same order whatever the others are."""
    return (np.ascontiguousarray(vectors) * query).sum(axis=1)


def _blocks(distinct: DataFrame, curves: int, directions: int, blocks: int) -> np.ndarray:
    """Curves x (blocks - 1): the keys at which the blocks begin."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = curve_keys(_matrix(b["vec"]), curves, directions)
            of = np.tile(np.arange(curves, dtype=np.int32), len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(keys.ravel())], ["curve", "key"])

    keys = distinct.select("vec").mapInArrow(rows, "curve int, key long")
    cuts = F.percentile_approx("key", [i / blocks for i in range(1, blocks)], 20 * blocks).alias("cuts")
    found = {r["curve"]: r["cuts"] for r in keys.groupBy("curve").agg(cuts).toLocalIterator()}
    return np.array([found.get(c, [0] * (blocks - 1)) for c in range(curves)])


def _block_of(x: np.ndarray, cuts: np.ndarray, directions: int) -> np.ndarray:
    keys = curve_keys(x, len(cuts), directions)
    return np.stack([np.searchsorted(c, keys[:, i], side="right") for i, c in enumerate(cuts)], axis=1)


def _sizes(rows_of: DataFrame, cuts: np.ndarray, directions: int, blocks: int) -> np.ndarray:
    """Curves x blocks: how many vectors each block holds."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _block_of(_matrix(b["vec"]), cuts, directions) + np.arange(len(cuts)) * blocks
            place, n = np.unique(at, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64)), pa.array(n.astype(np.int64))], ["place", "n"])

    counts = rows_of.select("vec").mapInArrow(rows, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    out = np.zeros(len(cuts) * blocks, np.int64)
    for r in counts.toLocalIterator():
        out[r["place"]] = r["n"]
    return out.reshape(len(cuts), blocks)


def _windows(held: np.ndarray, reach: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Curves x blocks: the first block of each block's window and the one past it, so wide that it holds `least` vectors or all."""
    curves, blocks = held.shape
    first = np.tile(np.clip(np.arange(blocks) - reach // 2, 0, blocks - reach), (curves, 1))
    past = first + reach
    before = np.concatenate([np.zeros((curves, 1), np.int64), np.cumsum(held, axis=1)], axis=1)
    while True:
        inside = np.take_along_axis(before, past, axis=1) - np.take_along_axis(before, first, axis=1)
        short = inside < np.minimum(least, before[:, -1:])
        if not short.any():
            return first, past
        first, past = np.maximum(first - short, 0), np.minimum(past + short, blocks)


def neighbours(
    vectors: DataFrame,
    queries_where: str,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    curves: int = CURVES,
    directions: int = DIRECTIONS,
    blocks: int = BLOCKS,
    window: int = WINDOW,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each row where `queries_where` on vec_id."""
    usable = durable(_usable(vectors, id_col, vector_col))
    # k + 1 ids of a vector are enough: one may be the query itself
    kept = usable.withColumn("n", F.row_number().over(W.partitionBy("vec").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    distinct = durable(kept.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = usable.where(queries_where).select(F.col("vec_id").alias("query_id"), "vec")
    asked = durable(asked.join(distinct.select("vec", "rep"), "vec").select("query_id", "rep"))
    askers = durable(distinct.join(asked, "rep", "left_semi").select("rep", "vec"))

    cuts = _blocks(distinct, curves, directions, blocks)
    held = _sizes(distinct, cuts, directions, blocks)
    reach = min(window, blocks)
    seen = _sizes(askers, cuts, directions, blocks)
    first, past = _windows(held, reach, k + 1)
    # queries that look at a block: those of the blocks whose window holds it
    looking = np.zeros_like(seen)
    for c, b in np.ndindex(seen.shape):
        looking[c, first[c, b] : past[c, b]] += seen[c, b]
    chunks = np.maximum(-(-held // CHUNK), 1)
    slices = np.maximum(-(-looking // SLICE), 1)

    def spread(rep: np.ndarray, parts: np.ndarray) -> np.ndarray:
        mixed = rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(32))) % parts.astype(np.uint64)).astype(np.int64)

    def emitted(b: pa.RecordBatch, row: np.ndarray, curve: np.ndarray, block: np.ndarray, chunk: np.ndarray, part: np.ndarray):
        group = (curve * blocks + block) << 40 | chunk << 20 | part
        for at in range(0, len(row), 4096):
            s = slice(at, at + 4096)
            taken = b.take(pa.array(row[s]))
            yield pa.RecordBatch.from_arrays([pa.array(group[s]), taken["rep"], taken["vec"]], ["g", "rep", "vec"])

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every vector once per curve and slice of queries."""
        for b in batches:
            block = _block_of(_matrix(b["vec"]), cuts, directions).ravel()
            row, curve = np.divmod(np.arange(len(block)), curves)
            chunk = spread(b["rep"].to_numpy()[row], chunks[curve, block])
            n = slices[curve, block]
            part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield from emitted(b, *(np.repeat(x, n) for x in (row, curve, block, chunk)), part)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every query once per curve, block in its window and chunk of that block."""
        for b in batches:
            own = _block_of(_matrix(b["vec"]), cuts, directions).ravel()
            row, curve = np.divmod(np.arange(len(own)), curves)
            start, n = first[curve, own], past[curve, own] - first[curve, own]
            row, curve, start = (np.repeat(x, n) for x in (row, curve, start))
            block = start + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            n = chunks[curve, block]
            chunk = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            row, curve, block = (np.repeat(x, n) for x in (row, curve, block))
            yield from emitted(b, row, curve, block, chunk, spread(b["rep"].to_numpy()[row], slices[curve, block]))

    def product(data: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if data.num_rows and queries.num_rows:
            rep, asking = data["rep"].to_numpy(), queries["rep"].to_numpy()
            asked_for, there = _matrix(queries["vec"]), _matrix(data["vec"])
            scores = asked_for @ there.T
            n = min(k + 1, len(rep))
            least = np.partition(scores, len(rep) - n, axis=1)[:, len(rep) - n]
            # a product of matrices may err in its last bits by its shape; what could be among the nearest is summed anew in one order
            norms = [np.linalg.norm(m, axis=1) for m in (asked_for, there)]
            slack = 4 * there.shape[1] * np.finfo(np.float64).eps * norms[0] * norms[1].max()
            least = np.where(np.isfinite(slack), least - slack, least)
            for i, s in enumerate(scores):
                near = np.flatnonzero(s >= least[i])
                score = in_order(asked_for[i], there[near])
                best = np.lexsort((rep[near], -score))[:n]
                out[0].append(np.full(len(best), asking[i]))
                out[1].append(rep[near[best]])
                out[2].append(score[best])
        columns = [np.concatenate(c) if c else np.empty(0) for c in out]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["q", "c", "score"])

    layout = "g long, rep long, vec binary"
    left = distinct.select("rep", "vec").mapInArrow(filed, layout).groupBy("g")
    right = askers.mapInArrow(sent, layout).groupBy("g")
    found = left.cogroup(right).applyInArrow(product, "q long, c long, score double")
    # a pair found on several curves is one
    found = found.groupBy("q", "c").agg(F.max("score").alias("score"))
    best = found.withColumn("n", F.row_number().over(W.partitionBy("q").orderBy(F.col("score").desc(), "c")))
    best = best.where(F.col("n") <= k + 1).select("q", "c", "score")
    listed = best.join(distinct.select(F.col("rep").alias("c"), "ids"), "c").select("q", "score", F.explode("ids").alias("vec_id"))
    order = [F.col("score").desc(), "vec_id"]
    top = listed.withColumn("n", F.row_number().over(W.partitionBy("q").orderBy(*order))).where(F.col("n") <= k + 1)
    mine = asked.join(top.select(F.col("q").alias("rep"), "score", "vec_id"), "rep").where("vec_id <> query_id")
    ranked = mine.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
