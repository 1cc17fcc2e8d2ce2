"""SimHash fingerprints, near duplicates by multi-index hashing, and the groups they form.

A fingerprint is cut into segments.  If two differ in at most `distance` bits, they differ in few bits of
some segment: with d = s * q + r for s segments, in at most q bits of one of the first r + 1 segments or in at most
q - 1 of another.  So every fingerprint is filed once per segment, every value in the small Hamming balls
around its segments is looked up, and what is found is verified over all bits.  Equal fingerprints become
one class before that, so copies cost one row however many there are, and links join different
fingerprints only.  Groups are found by alternating large and small stars, each a grouped minimum and a
join, until the links stop changing.

Defined cases: a null text is empty; a text without words has fingerprint zero and is linked like any other;
fewer words than a shingle make one shingle; texts of any length are hashed whole, CHUNK shingles at a time; repeated rows
are members of the same group; an empty table gives no row; other columns stay behind.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from martlens.llm.common import durable, whole_texts

SEED = 42
#: Shingles of one text hashed at a time.
CHUNK = 1 << 16


def fingerprint(text: str, words: int = 3) -> int:
    """Bit b is set if it is in over half of the shingles' hashes; shingles count as often as they occur."""
    # bytes.lower() and bytes.split() know A-Z and the six ASCII separators only, as asked for
    found = text.encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(found) - words + 1)
    last = ends[min(words, len(found)) - 1 :] - 1
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        spans = zip(starts[at : min(at + CHUNK, n)].tolist(), last[at : at + CHUNK].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def majority(hashes: np.ndarray) -> int:
    """Bit b is set if it is in over half of these hashes; none give zero."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        some = np.ascontiguousarray(hashes[at : at + CHUNK], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint as a signed long."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in b["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_hash"], pa.array(fps.view(np.int64))], ["doc_id", "text_hash", "fp"])

    texts = whole_texts(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"doc_id {kind}, text_hash long, fp long")


def _segment(value: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << width) - 1))


def _keys(segment: int, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(segment).alias("segment"), v.alias("value")))


def links(classes: DataFrame, distance: int = 2, segments: int = 2) -> DataFrame:
    """Pairs (u, v), u < v, of distinct fingerprints `fp` that differ in at most `distance` bits; pairs may repeat."""
    width = 64 // segments
    most, more = divmod(distance, segments)
    filed, asked = [], []
    for s in range(segments):
        radius = most if s <= more else most - 1
        if radius < 0:
            continue
        flips = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in itertools.combinations(range(width), r)]
        own = _segment(F.col("fp"), s * width, width)
        ball = F.array(*[own.bitwiseXOR(F.lit(m).cast("long")) for m in flips])
        filed.append(F.struct(F.lit(s).alias("segment"), own.alias("value")))
        asked.append(_keys(s, ball))
    table = classes.select(F.col("fp").alias("v"), F.explode(F.array(*filed)).alias("k")).select("v", "k.*")
    probes = classes.select(F.col("fp").alias("u"), F.explode(F.concat(*asked)).alias("k")).select("u", "k.*")
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    found = probes.join(table, ["segment", "value"]).where((F.col("u") < F.col("v")) & near)
    return found.select("u", "v")


def components(pairs: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that a pair (u, v) names.

    Large star: every larger neighbour of a node is tied to the least of its neighbours and itself.  Small star:
    the same for the smaller neighbours.  Both keep what is connected, and end in stars around the roots.
    """
    tied = durable(pairs.select("u", "v").distinct())
    before = None
    while True:
        state = tied.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = tied.unionByName(tied.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("m").alias("u"), "v").distinct()
        # the smaller neighbours of v are its u's; the least of them is tied to v and to all others
        down = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(down, "v").select(F.col("m").alias("u"), F.col("u").alias("w"), "v")
        ends = small.select("u", F.explode(F.array("w", "v")).alias("v")).where("u < v")
        tied = durable(ends.distinct())
    return tied.select(F.col("v").alias("node"), F.col("u").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2, segments: int = 2) -> DataFrame:
    """(doc_id, text_hash, fp, component_id): component_id is the smallest id in the document's group."""
    prints = durable(fingerprints(docs, words))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes.select("fp"), distance, segments))
    placed = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = placed.join(named, "root").select("fp", "component_id")
    return prints.join(groups, "fp").select("doc_id", "text_hash", "fp", "component_id")


def without_near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2, segments: int = 2) -> DataFrame:
    """One document of each group, with all its columns: the smallest id, and of equal ids the smallest text hash."""
    found = near_duplicates(docs, words, distance, segments)
    # a null component (only null ids) is a group by its fingerprint
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp")).alias("lone")]
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")
    best = found.select(*group, order.alias("o")).groupBy("component_id", "lone").agg(F.min("o").alias("o"))
    keep = durable(best.select(F.col("o.doc_id").alias("keep_id"), F.col("o.text_hash").alias("keep_hash")))
    own = "text_hash"
    while own in docs.columns:
        own += "_"
    mine = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = mine["doc_id"].eqNullSafe(keep["keep_id"]) & (mine[own] == keep["keep_hash"])
    return mine.join(keep, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
