"""Near copies: documents whose sets of word shingles have a Jaccard similarity of 0.8 or more, and the groups they form.

Texts with the same set of shingles are one class.  Every class has a SimHash fingerprint; classes whose fingerprints
differ in few bits are found by multi-index hashing, as `simhash` finds them, and compared by the true similarity of
the whole sets.  One class stands for all of one fingerprint.  Sets at a similarity of 0.8 differ in about ten of 64 bits,
which no small Hamming ball holds, so fingerprints alone would leave most near copies in.  The others meet
in buckets: every class is filed under 40 bands of six min-hashes each, so a pair at a similarity of exactly 0.8 shares no
bucket with a probability of 5 in a million, and a more similar pair with less.  What meets is compared in the same way,
unless its groups are one already.

In a bucket two classes stand for all: every member is compared with both, and they leave the bucket, as nothing is left to
compare them with.  A bucket whose other members all are in one group then is settled, which large groups of near copies
are, with comparisons that grow like their size.

Buckets that are still open are thinned exactly.  Four fifths of the shingles of a similar text are
shared, so a class goes whose shingles are not found to that extent in the other groups of open buckets; many unlike texts
that share a band all leave here, for the cost of counting their shingles.  The rest of a bucket is compared in
blocks of BLOCK classes by one bit string a class, whose odd bits differ at most as often as the sets do: what differs in
more than a ninth of both sizes cannot be similar.  Pairs that pass are verified one for each two groups first, and
only while those groups are apart.

Whole sets never travel with a pair.  A pair is first judged by sizes and bit strings; what is left is verified by one class and
a slice of its partners, and its set goes once to every slice.

Defined cases: words are what ASCII white space parts, A-Z in lower case; fewer words than a shingle make one shingle.  Null,
empty and blank texts have no words and are copies of each other.  Whole texts count, however long: their sets are hashed in
chunks, and a set travels only to be verified.  Of a group the smallest id stays, of equal ids the smallest text hash, and
of rows that repeat an id and a text any one.  Rows with a null id come after all others.  An empty table gives no
rows.  All columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from martlens.llm.common import durable, stored, whole_texts
from martlens.llm.simhash import SEED, components, links, majority

WORDS = 5
BANDS, ROWS = 40, 6
#: Shingles of one text that are min-hashed at a time.
CHUNK = 512
#: Length of a class's bit string, classes of a block, and shingles that a slice of partners has.
BITS, BLOCK, SLICE = 2048, 512, 1 << 18

_FACTORS = np.random.default_rng(23).integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of so many words."""
    found = text.encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]]).tolist()
    last = (ends[min(words, len(found)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, last)), np.uint64, len(last)))


def bands(found: np.ndarray) -> np.ndarray:
    """One number for every band of min-hashes."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(found), CHUNK):
        np.minimum(least, (found[at : at + CHUNK, None] * _FACTORS).min(axis=0), out=least)
    values = [xxhash.xxh64_intdigest(row.tobytes(), n) for n, row in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(values, np.uint64).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets have a Jaccard similarity of 0.8 or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (len(a) + len(b) - both)


def parity(found: np.ndarray) -> bytes:
    """One bit for every remainder: whether an odd number of hashes has it."""
    return np.packbits(np.bincount((found % np.uint64(BITS)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1).tobytes()


def may_be_similar(n, m, differing):
    """Whether sets of these sizes whose bit strings differ so often can be similar: similar sets differ in a ninth at most."""
    return (5 * n >= 4 * m) & (5 * m >= 4 * n) & (9 * differing <= n + m)


def _classes(docs: DataFrame) -> DataFrame:
    """(node, n, bands, parity, fp, best): one row for each set of shingles, with its size and its first document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t) for t in b["text"].to_pylist()]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            filed = pa.array([bands(s).tobytes() for s in sets], pa.binary())
            bits = pa.array([parity(s) for s in sets], pa.binary())
            fp = pa.array(np.array([majority(s) for s in sets], np.uint64).view(np.int64))
            columns = [b["doc_id"], b["text_hash"], pa.array(node), pa.array([len(s) for s in sets], pa.int64()), filed, bits, fp]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "node", "n", "bands", "parity", "fp"])

    texts = whole_texts(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    prints = texts.mapInArrow(rows, f"doc_id {kind}, text_hash long, node long, n long, bands binary, parity binary, fp long")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")
    same = [F.first(c).alias(c) for c in ("n", "bands", "parity", "fp")]
    return stored(prints.groupBy("node").agg(*same, F.min(order).alias("best")))


def _by_fingerprint(classes: DataFrame) -> DataFrame:
    """(u, v): every class with the one that stands for its fingerprint, and those of fingerprints that differ in few bits."""
    heads = stored(classes.groupBy("fp").agg(F.min("node").alias("head")))
    same = classes.join(heads, "fp").where("node <> head").select(F.col("head").alias("u"), F.col("node").alias("v"))
    near = links(heads.select("fp"))
    for c in ("u", "v"):
        near = near.join(heads.select(F.col("fp").alias(c), F.col("head").alias(f"{c}_head")), c)
    return stored(same.unionByName(near.select(F.col("u_head").alias("u"), F.col("v_head").alias("v"))).distinct())


def _members(classes: DataFrame) -> DataFrame:
    """(bucket, node, n) of the buckets with two classes or more."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            filed = np.frombuffer(b"".join(b["bands"].to_pylist()), np.int64)
            node, n = (np.repeat(b[c].to_numpy(), BANDS) for c in ("node", "n"))
            yield pa.RecordBatch.from_arrays([pa.array(filed), pa.array(node), pa.array(n)], ["bucket", "node", "n"])

    filed = classes.select("node", "n", "bands").mapInArrow(rows, "bucket long, node long, n long")
    shared = stored(filed.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1").select("bucket"))
    return stored(filed.join(shared, "bucket").select("bucket", "node", "n"))


def _picked(docs: DataFrame, best: DataFrame) -> tuple[DataFrame, str]:
    """The rows of `docs` that `best` (keep_id, keep_hash, ...) names, each once, and the name of their text's hash."""
    own = "text_hash"
    while own in docs.columns:
        own += "_"
    mine = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = mine["doc_id"].eqNullSafe(best["keep_id"]) & (mine[own] == best["keep_hash"])
    return mine.join(best, same, "left_semi").dropDuplicates(["doc_id", own]), own


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, found): the whole sets of these classes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t) for t in b["text"].to_pylist()]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "found"])

    best = classes.join(nodes, "node", "left_semi")
    best = stored(best.select(F.col("best.doc_id").alias("keep_id"), F.col("best.text_hash").alias("keep_hash")))
    picked, _ = _picked(whole_texts(docs), best)
    return stored(picked.select("text").mapInArrow(rows, "node long, found binary"))


def _bits(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITS // 64)


def _thinned(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """The pairs (u, v) that sizes and bit strings allow to be similar; no set is looked at."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            differing = np.bitwise_count(_bits(b["a"]) ^ _bits(b["b"])).sum(axis=1, dtype=np.int64)
            yield b.filter(pa.array(may_be_similar(b["n"].to_numpy(), b["m"].to_numpy(), differing), pa.bool_())).select(["u", "v"])

    both = pairs.join(prints.select(F.col("node").alias("u"), "n", F.col("parity").alias("a")), "u")
    both = both.join(prints.select(F.col("node").alias("v"), F.col("n").alias("m"), F.col("parity").alias("b")), "v")
    sized = both.where((5 * F.col("n") >= 4 * F.col("m")) & (5 * F.col("m") >= 4 * F.col("n")))
    return sized.select("u", "v", "n", "m", "a", "b").mapInArrow(rows, "u long, v long")


def _verified(pairs: DataFrame, prints: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that are similar indeed; u's set meets its partners slice by slice, one set at a time."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, np.empty(0, np.uint64)
        for b in batches:
            u, v = [], []
            for x, y, found in zip(b["u"].to_pylist(), b["v"].to_pylist(), b["found"], strict=True):
                other = np.frombuffer(found.as_buffer(), np.uint64)
                if y is None:
                    held, own = x, other.copy()
                elif held == x and similar(own, other):
                    u.append(x)
                    v.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    sized = stored(pairs.join(prints.select(F.col("node").alias("v"), "n"), "v").select("u", "v", "n"))
    slices = sized.groupBy("u").agg(F.ceil(F.sum("n") / SLICE).alias("slices"))
    dealt = sized.join(slices, "u").select("u", "v", F.pmod(F.xxhash64("v"), "slices").alias("slice"))
    heads = dealt.select("u", "slice").distinct().join(sets.withColumnRenamed("node", "u"), "u").withColumn("v", F.lit(None).cast("long"))
    met = heads.unionByName(dealt.join(sets.withColumnRenamed("node", "v"), "v"))
    order = ["u", "slice", F.col("v").asc_nulls_first()]
    return stored(met.repartition("u", "slice").sortWithinPartitions(*order).select("u", "v", "found").mapInArrow(rows, "u long, v long"))


def _roots(links: DataFrame) -> DataFrame:
    return stored(components(links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))))


def _grown(roots: DataFrame, found: DataFrame) -> DataFrame:
    """The groups with what `found` joins of them; a group so far goes in as a star, whatever links it came from."""
    if found.isEmpty():
        return roots
    return _roots(found.unionByName(roots.select(F.col("root").alias("u"), F.col("node").alias("v"))))


def _named(members: DataFrame, roots: DataFrame) -> DataFrame:
    """`members` with the group each is in so far."""
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _heads(members: DataFrame) -> DataFrame:
    """(bucket, head): the two classes that stand for each bucket."""
    # the same classes stand for many buckets, so that most comparisons are asked for several times and made once
    order = F.struct(F.xxhash64("node", F.lit("head")), "node")
    ends = members.groupBy("bucket").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    return stored(ends.select("bucket", F.explode(F.array("first.node", "last.node")).alias("head")))


def _open(named: DataFrame) -> DataFrame:
    """The members of buckets that hold two groups or more."""
    sides = named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return stored(named.join(sides.select("bucket"), "bucket"))


def _likely(opened: DataFrame, sets: DataFrame) -> DataFrame:
    """The members whose shingles are found, to four fifths, in other groups of open buckets; all others have no partner."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, root, found in zip(b["node"].to_pylist(), b["root"].to_pylist(), b["found"], strict=True):
                values = np.frombuffer(found.as_buffer(), np.int64)
                columns = [pa.array(np.full(len(values), node)), pa.array(np.full(len(values), root)), pa.array(values)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "root", "shingle"])

    nodes = opened.select("node", "root").distinct()
    told = stored(nodes.join(sets, "node").select("node", "root", "found").mapInArrow(rows, "node long, root long, shingle long"))
    shared = told.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("shingle")
    counts = told.join(shared, "shingle").groupBy("node").agg(F.count("*").alias("held"))
    likely = opened.join(counts, "node").where(5 * F.col("held") >= 4 * F.col("n"))
    return likely.select("bucket", "node", "n", "root")


def _in_blocks(members: DataFrame, prints: DataFrame) -> DataFrame:
    """(u, v) of different groups in one bucket that sizes and bit strings allow, compared block by block.

    A member goes to every pair of blocks its own block is in, as its bit string; no pair is a row before it has passed.
    """

    def met(key: list[np.ndarray]) -> pa.RecordBatch:
        block, node, n, root, bits = (np.concatenate([k[c] for k in key]) for c in range(5))
        first = block == block.min()
        one, two = np.flatnonzero(first), np.flatnonzero(~first) if not first.all() else np.arange(len(block))
        u, v = [], []
        for i in one:
            differing = np.bitwise_count(bits[two] ^ bits[i]).sum(axis=1, dtype=np.int64)
            near = two[may_be_similar(n[i], n[two], differing) & (root[i] != root[two]) & (node[i] != node[two])]
            u.append(np.full(len(near), node[i]))
            v.append(node[near])
        u, v = np.concatenate(u), np.concatenate(v)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for b in batches:
            keys = np.stack([b[c].to_numpy() for c in ("bucket", "low", "high")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            values = [b[c].to_numpy() for c in ("block", "node", "n", "root")] + [_bits(b["parity"])]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo < hi:
                    if at is not None and tuple(keys[lo]) != at:
                        yield met(held)
                        held = []
                    at = tuple(keys[lo])
                    held.append([x[lo:hi] for x in values])
        if held:
            yield met(held)

    sizes = members.groupBy("bucket").agg(F.count("*").alias("held"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    dealt = members.join(sizes.select("bucket", F.ceil(F.col("held") / BLOCK).alias("blocks")), "bucket").join(prints.select("node", "parity"), "node")
    placed = dealt.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), "blocks"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    keyed = other.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "n", "root", "parity")
    order = ["bucket", "low", "high"]
    return stored(keyed.repartition(*order).sortWithinPartitions(*order).mapInArrow(rows, "u long, v long").distinct())


def groups(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, root) for the classes that are similar to another one."""
    close, members = _by_fingerprint(classes), _members(classes)
    nodes = stored(members.select("node").union(close.select("u")).union(close.select("v")).distinct())
    sets = _sets(docs, classes, nodes)
    prints = stored(classes.join(nodes, "node", "left_semi").select("node", "n", "parity"))
    roots = _roots(_verified(_thinned(close, prints), prints, sets))
    named, heads = stored(_named(members, roots)), _heads(members)
    # heads are members of the bucket too
    head = heads.join(named.select("bucket", F.col("node").alias("head"), F.col("root").alias("head_root")), ["bucket", "head"])
    met = named.join(head, "bucket").where("root <> head_root").select(F.col("head").alias("u"), F.col("node").alias("v")).distinct()
    roots = _grown(roots, _verified(_thinned(met, prints), prints, sets))
    others = members.join(heads.withColumnRenamed("head", "node"), ["bucket", "node"], "left_anti")
    opened = _open(stored(_named(others, roots)))
    if opened.isEmpty():
        return roots
    left = _in_blocks(stored(_likely(opened, sets)), prints)
    for thin in (True, False):
        ends = [_named(left.select(F.col(c).alias("node"), "u", "v"), roots).select("u", "v", F.col("root").alias(f"root_{c}")) for c in ("u", "v")]
        left = stored(ends[0].join(ends[1], ["u", "v"]).where("root_u <> root_v"))
        if left.isEmpty():
            break
        asked = left.select("u", "v")
        if thin:  # one pair for each two groups; as a rule that settles them
            sides = left.groupBy(F.least("root_u", "root_v"), F.greatest("root_u", "root_v"))
            asked = stored(sides.agg(F.min(F.struct(F.xxhash64("u", "v"), "u", "v")).alias("one")).select("one.u", "one.v"))
        roots = _grown(roots, _verified(asked, prints, sets))
        left = left.select("u", "v").join(asked, ["u", "v"], "left_anti")
    return roots


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each group, with all its columns: the smallest id, and of equal ids the smallest text hash."""
    classes = _classes(docs)
    named = classes.join(groups(docs, classes), "node", "left").select(F.coalesce("root", "node").alias("root"), "best")
    best = named.groupBy("root").agg(F.min("best").alias("o"))
    kept, own = _picked(docs, durable(best.select(F.col("o.doc_id").alias("keep_id"), F.col("o.text_hash").alias("keep_hash"))))
    return kept.drop(own)
