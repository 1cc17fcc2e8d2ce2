"""Near duplicates: rows whose token sets have a Jaccard similarity of at least 4/5, and the groups they form.

An exact set-similarity search by prefix filtering.  Sets are ordered by rarity; two sets of which four
fifths are shared have a token in common among the first fifth (and one more) of both.  Rows meet in the buckets of those
tokens only, and sizes and positions tell most of those that meet apart before a set is looked at.

Any order that all sets follow finds all pairs; a good one keeps common tokens out of the first fifth.  Tasks count the tokens
that return within CHUNK of them, and what adds up to COMMON or more marks one of SLOTS slots with its magnitude.  A token comes
the later the higher the mark of its slot, so the order is a table of one size that every task is sent, and tokens
are neither shuffled to be counted nor joined.  Only the first fifth of every set crosses a shuffle.

A bucket of up to HUBS sets is compared whole.  In a larger one some sets stand for all: each is compared with the members that are
not in its group yet and leaves the bucket.  A bucket whose members all are in one group is settled, so a large group of near copies
costs as many comparisons as it has members.  One set stands for a bucket at first, and GROWTH times as many in each round that
follows, until every bucket is settled; so no link between different groups is lost, whatever the size of a bucket, and
rounds grow with the logarithm of that size.

Pairs are judged by one bit string a set first: odd bits differ at most as often as the sets do.  Whole sets are made
again from the rows, and only of those that a pair is left for.  In smaller buckets each set is compared with one partner
first, and then with those that are in other groups still; so a set is seldom sent more than once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from martlens.functions import scalars as X
from martlens.operators import graphs
from martlens.session import work_dir

#: Tokens found in so many sets or more count as common; rarer ones are ordered by their hash.
COMMON = 16
#: Buckets of so many sets are compared whole.
HUBS = 64
#: How many times as many sets stand for a larger bucket in the next round.
GROWTH = 8
#: Tokens of one task that are counted at a time, marks that are kept, and the least bits that tell a set apart.
CHUNK, SLOTS, BITS = 1 << 22, 1 << 24, 2048
#: Rows handed to Python at once, where they hold texts or sets and where they are narrow.
TEXTS, NARROW = 512, 1 << 16
#: Bytes of text that are cut into words at a time, and bytes up to which a word is hashed with others.
SPAN, WORD = 1 << 21, 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORDS = np.ones(256, bool)
_WORDS[[9, 10, 11, 12, 13, 32]] = False
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits to 64 bits, one to one, every bit depending on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One hash for each word of `raw`, which goes on for eight bytes behind the last."""
    lanes = np.ndarray((len(raw) - 7,), "<u8", buffer=raw, strides=(1,))
    out = sizes.astype(np.uint64) * _STEP
    live, at = np.flatnonzero(sizes <= WORD), 0
    while len(live):
        left = sizes[live] - at
        lane, part = lanes[starts[live] + at], left < 8
        lane[part] &= (np.uint64(1) << (left[part] * 8).astype(np.uint64)) - np.uint64(1)
        out[live] = _mixed(out[live] ^ lane) + _STEP
        live, at = live[left > 8], at + 8
    for i in np.flatnonzero(sizes > WORD):
        word = raw[starts[i] : starts[i] + sizes[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return out


def _shingled(raw: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of every text's runs, one text after the other, and how many each text has."""
    low = np.zeros(len(raw) + 8, np.uint8)
    low[: len(raw)] = _LOWER[raw]
    inside = np.concatenate([_WORDS[raw], [False]])
    begins, ends = inside[:-1].copy(), inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    ends &= ~inside[1:]
    # a text's first and last byte are at its borders too
    full = offsets[1:] > offsets[:-1]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    begins[first], ends[last] = inside[first], inside[last]
    starts = np.flatnonzero(begins)
    hashes = _word_hashes(low, starts, np.flatnonzero(ends) + 1 - starts)
    edges = np.searchsorted(starts, offsets)
    words = np.diff(edges)
    # how many words follow in the same text
    after = np.repeat(edges[1:], words) - np.arange(len(hashes)) - 1
    runs = np.full(len(hashes), np.uint64(n))
    for k in range(min(n, len(hashes))):
        here = after[: len(hashes) - k] >= k
        head = runs[: len(hashes) - k]
        head[here] = _mixed(head[here] ^ hashes[k:][here]) + _STEP
    # a run begins at every word that n - 1 words follow, and at the first word
    whole = after >= n - 1
    whole[edges[:-1][words > 0]] = True
    runs, counts = runs[whole].view(np.int64), np.where(words > 0, np.maximum(words - n + 1, 1), 0)
    cuts = np.concatenate([[0], np.cumsum(counts)])
    found = [np.unique(runs[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    return np.concatenate([np.empty(0, np.int64), *found]), np.array([len(x) for x in found], np.int64)


def word_shingles(text: Column | str, n: int = 5) -> Column:
    """Distinct hashes of all runs of n words, A-Z in lower case; fewer words are one run, no words none."""

    @F.arrow_udf("array<bigint>")
    def shingles(texts: pa.Array) -> pa.Array:
        texts = texts.fill_null("").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        found, at = [], 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SPAN, "right")) - 1)
            found.append(_shingled(raw[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at], n))
            at = end
        values = np.concatenate([np.empty(0, np.int64), *[x for x, _ in found]])
        sizes = np.concatenate([np.empty(0, np.int64), *[x for _, x in found]])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values))

    return shingles(X.col(text))


def character_runs(text: Column | str, n: int = 3) -> Column:
    """Distinct hashes of all runs of n characters of a name; shorter names are one run, null and empty ones have none."""
    runs = lambda t: F.transform(
        F.sequence(F.lit(1), F.greatest(F.char_length(t) - (n - 1), F.lit(1))), lambda i: F.xxhash64(F.substring(t, i, F.lit(n)))
    )
    name = F.coalesce(F.lower(X.col(text)), F.lit(""))
    none = F.array().cast("array<bigint>")
    return X.let(name, lambda t: F.when(t != "", F.array_distinct(runs(t))).otherwise(none))


class _Tables:
    """Tables written once into the working folder, and marks that every task is sent."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.count = spark, work_dir(spark, "similar"), 0

    def kept(self, df: DataFrame, rows: int = NARROW) -> DataFrame:
        path, self.count = f"{self.folder}/{self.count}", self.count + 1
        # shuffle files go when the table is there
        conf = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
        before = {name: self.spark.conf.get(name, None) for name in conf}
        for name, value in conf.items():
            self.spark.conf.set(name, value)
        try:
            df.write.parquet(path)
        finally:
            for name, value in before.items():
                self.spark.conf.unset(name) if value is None else self.spark.conf.set(name, value)
        return self.spark.read.schema(df.schema).parquet(path)

    def sent(self, marks: DataFrame):
        """The highest mark (1 to 63) of every slot, by (hash, mark): SLOTS bytes, whatever the number of rows."""
        slot = F.col("hash").bitwiseAND(F.lit(SLOTS - 1))
        highest = marks.groupBy(slot.alias("slot")).agg(F.max("mark").alias("mark"))
        # slot and mark in one number: SLOTS of them at most
        made = highest.select((F.col("slot") * 64 + F.col("mark")).cast("int").alias("both")).toArrow()["both"].to_numpy()
        table = np.zeros(SLOTS, np.uint8)
        table[made // 64] = made % 64
        return self.spark.sparkContext.broadcast(table)


def _read(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All sets of a batch, each sorted, one after the other, and where each begins."""
    cuts = tokens.offsets.to_numpy()
    values, cuts = tokens.values.to_numpy()[cuts[0] : cuts[-1]], cuts - cuts[0]
    rising = np.concatenate([[True], values[1:] > values[:-1]])
    rising[cuts[:-1][cuts[:-1] < len(values)]] = True
    if not rising.all():
        values = np.concatenate([np.sort(values[a:b]) for a, b in zip(cuts[:-1], cuts[1:])])
    return values, cuts.astype(np.int64)


def _nodes(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """One number for every set; equal sets have the same."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(values.view(np.uint64) ^ _STEP), dtype=np.uint64)])
    return _mixed((sums[cuts[1:]] - sums[cuts[:-1]]) ^ np.diff(cuts).astype(np.uint64)).view(np.int64)


def _counted(own: DataFrame) -> DataFrame:
    """(key, node, n) for every row, and rows (token, held) of tokens that return within a part of a task."""

    def told(schema: pa.Schema, parts: list[np.ndarray]) -> pa.RecordBatch:
        found = np.concatenate(parts)
        parts.clear()
        found.sort()
        again = np.concatenate([[False], found[1:] == found[:-1], [False]])
        first = np.flatnonzero(again[1:] & ~again[:-1])
        held = np.flatnonzero(again[:-1] & ~again[1:]) - first + 1
        empty = [pa.nulls(len(first), f.type) for f in schema][:3]
        return pa.RecordBatch.from_arrays([*empty, pa.array(found[first]), pa.array(held)], schema=schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, parts, size, seen = None, [], 0, set()
        for b in batches:
            schema = pa.schema([b.schema.field("key"), *[pa.field(c, pa.int64()) for c in ("node", "n", "token", "held")]])
            values, cuts = _read(b["tokens"])
            node, none = _nodes(values, cuts), pa.nulls(len(b), pa.int64())
            yield pa.RecordBatch.from_arrays([b["key"], pa.array(node), pa.array(np.diff(cuts)), none, none], schema=schema)
            for k, x in enumerate(node.tolist()):
                if x not in seen:  # copies would make all their tokens common
                    seen.add(x)
                    parts.append(values[cuts[k] : cuts[k + 1]])
                    size += len(parts[-1])
            if size >= CHUNK:
                yield told(schema, parts)
                size, seen = 0, set()
        if parts:
            yield told(schema, parts)

    numbers = [T.StructField(c, T.LongType()) for c in ("node", "n", "token", "held")]
    return own.mapInArrow(rows, T.StructType([T.StructField("key", own.schema["key"].dataType), *numbers]))


def _odd(values: np.ndarray) -> bytes:
    """One bit for every remainder: whether an odd number of tokens has it.  Large sets have a bit for each token at least."""
    length = max(BITS, 1 << (len(values) - 1).bit_length())
    return np.packbits(np.bincount(values & (length - 1), minlength=length).astype(np.uint8) & 1).tobytes()


def _differing(a: bytes, b: bytes) -> int:
    """How many bits differ; of strings of different lengths the longer one is folded."""
    x, y = (np.frombuffer(c, np.uint64) for c in sorted((a, b), key=len))
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _placed(own: DataFrame, order) -> DataFrame:
    """(node, n, first, bits): the first fifth and one more of every set, rare tokens first, and its bit string.

    Sets of fewer than four tokens are similar to equal ones only and stay out.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, seen = order.value, set()
        for b in batches:
            values, cuts = _read(b["tokens"])
            node, n = _nodes(values, cuts), np.diff(cuts)
            late = marks[values & (SLOTS - 1)]
            some = np.concatenate([[0], np.cumsum(late > 0)])
            some = some[cuts[1:]] > some[cuts[:-1]]
            first, picked, bits = [], [], []
            for k, x in enumerate(node.tolist()):
                if n[k] < 4 or x in seen:
                    continue
                seen.add(x)
                mine, length = values[cuts[k] : cuts[k + 1]], n[k] - (4 * n[k] + 4) // 5 + 1
                bits.append(_odd(mine))
                if some[k]:
                    mine = mine[np.argsort(late[cuts[k] : cuts[k + 1]], kind="stable")]
                first.append(mine[:length])
                picked.append(k)
            if len(seen) > NARROW:
                seen.clear()
            ends = np.concatenate([[0], np.cumsum([len(x) for x in first])])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *first])))
            columns = [pa.array(node[picked]), pa.array(n[picked]), lists, pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "first", "bits"])

    return own.select("tokens").mapInArrow(rows, "node long, n long, first array<long>, bits binary")


def _fit(n, m, place, other):
    """Whether sets of these sizes that share a token at these places can be similar: all before it may be shared, and all after it."""
    least, most = (np.minimum, np.maximum) if isinstance(n, np.ndarray) else (F.least, F.greatest)
    shared = least(place, other) + least(n - place, m - other)
    return (5 * least(n, m) >= 4 * most(n, m)) & (9 * shared >= 4 * (n + m))


def _met(placed: DataFrame) -> DataFrame:
    """Rows (u, v) for the pairs that may be similar in buckets of up to HUBS sets, and (u, bucket, n, place) for the members of larger ones."""
    hubs = HUBS

    def whole(node, n, place, starts, sizes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for m in np.unique(sizes[(sizes > 1) & (sizes <= hubs)]):
            i, j = np.triu_indices(m, 1)
            begins = starts[sizes == m][:, None]
            step = max(1, (1 << 18) // len(i))
            for at in range(0, len(begins), step):
                a, b = (begins[at : at + step] + i).ravel(), (begins[at : at + step] + j).ravel()
                fit = _fit(n[a], n[b], place[a], place[b])
                u, v = node[a[fit]], node[b[fit]]
                by = np.lexsort((v, u))  # the same two meet in many buckets
                u, v = u[by], v[by]
                new = np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])[: len(u)]
                yield u[new], v[new]

    def judged(token, node, n, place) -> pa.RecordBatch:
        same = np.concatenate([[False], token[1:] == token[:-1], [False]])
        met = np.flatnonzero(same[1:] | same[:-1])
        met = met[np.lexsort((node[met], token[met]))]
        # equal sets of several tasks are several rows
        met = met[np.concatenate([[True], (np.diff(token[met]) != 0) | (np.diff(node[met]) != 0)])[: len(met)]]
        token, node, n, place = token[met], node[met], n[met], place[met]
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])[: len(met)])
        sizes = np.diff(np.append(starts, len(token)))
        # members of a bucket are in the order of their numbers
        pairs = [np.empty((2, 0), np.int64), *(np.stack(p) for p in whole(node, n, place, starts, sizes))]
        u, v = np.concatenate(pairs, axis=1)
        large = np.repeat(sizes > hubs, sizes)
        none, empty = pa.nulls(len(u), pa.int64()), pa.nulls(int(large.sum()), pa.int64())
        small = [pa.array(u), pa.array(v), none, none, none]
        rest = [pa.array(node[large]), empty, *[pa.array(x[large]) for x in (token, n, place)]]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(small, rest)], ["u", "v", "bucket", "n", "place"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for b in batches:
            if not len(b):
                continue
            columns = [b[c].to_numpy().astype(np.int64) for c in ("token", "node", "n", "place")]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last bucket may go on
            if cut or (held and held[-1][0][-1] != columns[0][0]):
                parts = [*held, [c[:cut] for c in columns]]
                yield judged(*[np.concatenate([p[c] for p in parts]) for c in range(4)])
                held = []
            held.append([c[cut:] for c in columns])
        if held:
            yield judged(*[np.concatenate([p[c] for p in held]) for c in range(4)])

    filed = placed.select("node", "n", F.posexplode("first").alias("place", "token")).select("token", "node", "n", "place")
    return filed.repartition("token").sortWithinPartitions("token").mapInArrow(rows, "u long, v long, bucket long, n long, place long")


def _thinned(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """The pairs (u, v) that their bit strings allow to be similar: similar sets differ in a ninth of both sizes at most."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            differing = np.array([_differing(x, y) for x, y in zip(b["a"].to_pylist(), b["b"].to_pylist())], np.int64)
            yield b.filter(pa.array(9 * differing <= b["n"].to_numpy() + b["m"].to_numpy(), pa.bool_())).select(["u", "v"])

    both = pairs.join(prints.select(F.col("node").alias("u"), "n", F.col("bits").alias("a")), "u")
    both = both.join(prints.select(F.col("node").alias("v"), F.col("n").alias("m"), F.col("bits").alias("b")), "v")
    return both.select("u", "v", "n", "m", "a", "b").mapInArrow(rows, "u long, v long")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("u", "v")).alias("node"))


def _sets(own: Callable[[DataFrame], DataFrame], rows: DataFrame, key: str, keys: DataFrame, nodes: DataFrame, sent) -> DataFrame:
    """(node, tokens) of these nodes, made again from one row of each."""
    wanted = keys.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key"))
    table = sent(wanted.select(F.xxhash64("key").alias("hash"), F.lit(1).alias("mark")))

    @F.arrow_udf("boolean")
    def asked(hashes: pa.Array) -> pa.Array:
        return pa.array(table.value[hashes.to_numpy() & (SLOTS - 1)] > 0)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, cuts = _read(b["tokens"])
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([pa.array(_nodes(values, cuts)), lists], ["node", "tokens"])

    made = own(rows.where(asked(F.xxhash64(key)))).select("tokens").mapInArrow(named, "node long, tokens array<long>")
    return made.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens"))


def _named(rows: DataFrame, roots: DataFrame | None, node: str = "node", root: str = "root") -> DataFrame:
    """`rows` with the group that each is in so far."""
    if roots is None:
        return rows.withColumn(root, F.col(node))
    known = roots.select(F.col("node").alias(node), F.col("root").alias(root))
    return rows.join(known, node, "left").withColumn(root, F.coalesce(root, node))


def _opened(named: DataFrame) -> DataFrame:
    """The members of buckets that hold two groups or more."""
    sides = named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return named.join(sides.select("bucket"), "bucket")


def _similar(kept: Callable[[DataFrame], DataFrame], pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that are similar indeed."""
    if 8 * pairs.count() < sets.count():  # few sets are asked about: the others stay where they are
        sets = sets.join(kept(_ends(pairs).distinct()), "node", "left_semi")
    both = pairs.join(sets.select(F.col("node").alias("v"), F.col("tokens").alias("b")), "v")
    both = both.join(sets.select(F.col("node").alias("u"), F.col("tokens").alias("a")), "u")
    alike = X.let(F.size(F.array_intersect("a", "b")), lambda c: 9 * c >= 4 * (F.size("a") + F.size("b")))
    return both.where(alike).select("u", "v")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one group yet."""
    ends = _named(_named(pairs, roots, "u", "root_u"), roots, "v", "root_v")
    return ends.where("root_u <> root_v").select("u", "v")


def near_duplicate_groups(rows: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, group_id): group_id is the smallest key that similar rows lead to, itself included.

    Rows without tokens are alike among themselves.  Null keys take no part.  The rows are read three times.
    """
    tables = _Tables(rows.sparkSession)
    kept = tables.kept

    def own(some: DataFrame) -> DataFrame:
        return some.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), tokens.alias("tokens"))

    counted = kept(_counted(own(rows)), TEXTS)
    keys = counted.where("node is not null").select("key", "node")
    held = counted.where("token is not null").groupBy("token").agg(F.sum("held").alias("held")).where(F.col("held") >= COMMON)
    order = tables.sent(held.select(F.col("token").alias("hash"), F.floor(F.log2("held")).alias("mark")))
    # equal sets of one task are one row
    placed = kept(_placed(own(rows), order), TEXTS)
    order.destroy()
    met = kept(_met(placed))
    members = met.where("v is null").select("bucket", F.col("u").alias("node"), "n", "place")
    pairs = kept(met.where("v is not null").select("u", "v").distinct())
    nodes = kept(members.select("node").unionByName(_ends(pairs)).distinct())
    prints = kept(placed.select("node", "n", "bits").join(nodes, "node", "left_semi").dropDuplicates(["node"]))
    pairs = kept(_thinned(pairs, prints))
    nodes = kept(members.select("node").unionByName(_ends(pairs)).distinct())
    sets = kept(_sets(own, rows, key, keys, nodes, tables.sent), TEXTS)

    roots, hubs, level = None, 1, 0
    while True:
        opened = kept(_opened(kept(_named(members, roots))))
        settled = opened.isEmpty()
        if settled and level > 1:
            break
        # in smaller buckets each set is compared with one partner first, and then what is still apart
        if not level:
            asked = one = kept(pairs.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"))
        elif level == 1:
            asked = _apart(pairs.join(one, ["u", "v"], "left_anti"), roots)
        else:
            asked = pairs.limit(0)
        if not settled:
            # the same sets stand for many buckets, so that most comparisons are asked for several times and made once
            first = Window.partitionBy("bucket").orderBy(F.xxhash64("node", F.lit(level)), "node")
            heads = kept(opened.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= hubs).drop("rank"))
            head = heads.select("bucket", *[F.col(c).alias(f"h_{c}") for c in ("node", "n", "place", "root")])
            fits = _fit(F.col("n"), F.col("h_n"), F.col("place"), F.col("h_place"))
            sides = opened.join(head, "bucket").where("root <> h_root").where(fits)
            sides = kept(sides.select(F.least("node", "h_node").alias("u"), F.greatest("node", "h_node").alias("v")).distinct())
            asked = asked.unionByName(_thinned(sides, prints)).distinct()
            opened = opened.join(heads.select("bucket", "node"), ["bucket", "node"], "left_anti")
            members = kept(opened.select("bucket", "node", "n", "place"))
        links = kept(_similar(kept, kept(asked), sets))
        if roots is None or not links.isEmpty():
            # a group so far goes in as a star, whatever links it came from
            if roots is not None:
                links = links.unionByName(roots.select(F.col("root").alias("u"), F.col("node").alias("v")))
            roots = graphs.components(links)
        hubs, level = GROWTH * hubs, level + 1
    keys = keys.join(roots, "node", "left").withColumn("node", F.coalesce("root", "node"))
    least = keys.groupBy("node").agg(F.min("key").alias("group_id"))
    return keys.join(least, "node").select(F.col("key").alias(key), "group_id")
