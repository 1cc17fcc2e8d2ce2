"""Shards of near-equal bytes by fixed virtual slots and a versioned map from slots to shards.

A record belongs to one of SLOTS virtual slots by a hash of its id and text, for good.  One pass adds up the bytes of every
slot in partial sums.  A map says which shard each slot lies in; version 1 deals the slots out in turn, and rebalancing
edits the newest version: slots move from the fullest shard to the emptiest until nothing that moves brings them closer.
A further shard takes slots from the others and no slot moves between those.  Every version is stored as an immutable
folder of SLOTS rows that says which slots moved, so a reader of an older layout still finds its records.

A slot may be far heavier than others: copies of one record, or many records without an id, hash alike.  Records therefore also
have one of PARTS parts, which the place in the input decides for equal ones.  A slot heavier than a sixteenth
of a shard is mapped part by part, all others whole.

`written` stores the records by shard.  Spark rebalances the rows by shard, so large shards have several files of bounded
size; a record's place in its shard is its row in its file plus the rows of the files before, and no row is sorted for it.

Defined cases: a null text has no bytes; each record counts 8 more.  Null ids, repeated rows and equal texts are records
of their own.  All columns are kept, whatever their names.  An empty table gives no rows and a map of equal shares of slots.
Records larger than a shard's share stay whole, so shards can then be uneven.
"""

from __future__ import annotations

import bisect
import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martlens.llm.common import durable, prepare

SLOTS, PARTS = 4096, 64
#: Slots above this share of a shard are mapped part by part.
HEAVY = 1 / 16
OVERHEAD = 8
MAP = "slot int, shards array<int>, moved boolean"


class Cell(NamedTuple):
    """What moves as one: a slot, or one part of a heavy slot (part is -1 for a whole slot)."""

    slot: int
    part: int
    bytes: int


#: A map: for each slot the shards of its parts, one entry if they all lie in one shard.
Shards = dict[int, list[int]]


def size_of(text_col: str | Column = "text") -> Column:
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + OVERHEAD


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, slot, part): every record with its columns as one struct, its slot and its part."""
    record = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"))
    key = [F.col("doc").getField(c) for c in (id_col, text_col)]
    return record.select(
        "doc",
        F.pmod(F.xxhash64(*key), F.lit(SLOTS)).cast("int").alias("slot"),
        F.pmod(F.xxhash64(*key, F.monotonically_increasing_id()), F.lit(PARTS)).cast("int").alias("part"),
    )


def cells(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> list[Cell]:
    """The bytes of all slots, and of the parts of heavy ones: SLOTS + PARTS * shards / HEAVY rows at most, however many records."""
    sized = keyed(docs, id_col, text_col).select("slot", "part", size_of(F.col("doc").getField(text_col)).alias("bytes"))
    parts = durable(sized.groupBy("slot", "part").agg(F.sum("bytes").alias("bytes")))
    total = parts.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first().bytes
    heavy = parts.groupBy("slot").agg(F.sum("bytes").alias("whole")).withColumn("heavy", F.col("whole") > total / shards * HEAVY)
    moving = parts.join(heavy, "slot").groupBy("slot", F.when(F.col("heavy"), F.col("part")).otherwise(-1).alias("part"))
    return sorted(Cell(*r) for r in moving.agg(F.sum("bytes").alias("bytes")).collect())


def dealt(shards: int) -> Shards:
    """The map to begin with: slots in turn."""
    return {s: [s % shards] for s in range(SLOTS)}


def _of(shards: Shards, cell: Cell) -> int:
    own = shards[cell.slot]
    return own[max(cell.part, 0) % len(own)]


def _edited(shards: Shards, moves: dict[Cell, int]) -> Shards:
    out = dict(shards)
    for cell, to in moves.items():
        own = out[cell.slot]
        if cell.part < 0:
            out[cell.slot] = [to] if len(own) == 1 else [to] * len(own)
        else:
            own = [own[k % len(own)] for k in range(PARTS)]
            own[cell.part] = to
            out[cell.slot] = own
    return {s: own[:1] if len(set(own)) == 1 else own for s, own in out.items()}


def _held(shards: Shards, weights: list[Cell], count: int) -> tuple[list[int], list[list[tuple[int, Cell]]]]:
    loads, held = [0] * count, [[] for _ in range(count)]
    for cell in weights:
        at = _of(shards, cell)
        loads[at] += cell.bytes
        bisect.insort(held[at], (cell.bytes, cell))
    return loads, held


def rebalanced(shards: Shards, weights: list[Cell], count: int) -> Shards:
    """The map after moving cells from the fullest shard to the emptiest while that brings the two closer."""
    loads, held = _held(shards, weights, count)
    moves: dict[Cell, int] = {}
    while True:
        full, empty = (pick(range(count), key=lambda k: (loads[k], k)) for pick in (max, min))
        gap = loads[full] - loads[empty]
        # the cell nearest to half the gap; any below the whole gap is a step forward
        at = bisect.bisect_left(held[full], (gap / 2,))
        near = [held[full][k] for k in (at - 1, at) if 0 <= k < len(held[full]) and 0 < held[full][k][0] < gap]
        if not near:
            return _edited(shards, moves)
        entry = min(near, key=lambda e: abs(gap - 2 * e[0]))
        held[full].remove(entry)
        bisect.insort(held[empty], entry)
        loads[full] -= entry[0]
        loads[empty] += entry[0]
        moves[entry[1]] = empty


def grown(shards: Shards, weights: list[Cell], count: int) -> Shards:
    """The map for one more shard, number `count`, which takes cells from the fullest others up to its equal share."""
    loads, held = _held(shards, weights, count)
    share, new, moves = sum(loads) / (count + 1), 0, {}
    while True:
        full = max(range(count), key=lambda k: (loads[k], k))
        at = bisect.bisect_right(held[full], (min(share - new, max(loads[full] - share, 1)), (SLOTS, 0, 0))) - 1
        if at < 0:
            return _edited(shards, moves)
        weight, cell = held[full].pop(at)
        loads[full] -= weight
        new += weight
        moves[cell] = count


def stored_version(spark: SparkSession, shards: Shards, folder: str) -> int:
    """Add a map to the folder as its next version, which must not exist yet; earlier versions stay as they are."""
    version, before = latest(spark, folder)
    rows = [(s, own, before is not None and before[s] != own) for s, own in sorted(shards.items())]
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("errorifexists").parquet(f"{folder}/version={version + 1}")
    return version + 1


def latest(spark: SparkSession, folder: str, version: int | None = None) -> tuple[int, Shards | None]:
    """The newest map, or a given version of it; (0, None) where there is none."""
    try:
        maps = spark.read.schema(f"{MAP}, version int").parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, None
    newest = version or maps.agg(F.max("version")).first()[0]
    return newest, {r.slot: list(r.shards) for r in maps.where(F.col("version") == newest).collect()}


def written(docs: DataFrame, shards: Shards, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the records under folder/shard=N and return them: (doc, slot, shard, place), the place counting from 0 in each shard.

    The map has SLOTS rows; whether it is broadcast is Spark's own decision by that size.
    """
    spark = docs.sparkSession
    table = spark.createDataFrame(sorted(shards.items()), "slot int, shards array<int>")
    own = F.element_at("shards", (F.col("part") % F.size("shards") + 1).cast("int"))
    rows = keyed(docs, id_col, text_col).join(table, "slot").select("doc", "slot", own.alias("shard"))
    rows.hint("rebalance", "shard").write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    return stored_shards(spark, folder, rows.schema)


def stored_shards(spark: SparkSession, folder: str, schema) -> DataFrame:
    """What `written` stored, with each record's place in its shard."""
    found = spark.read.schema(schema).parquet(folder).withColumns({"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")})
    files = durable(found.groupBy("shard", "file").agg(F.count("*").alias("rows")))
    earlier = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    first = files.select("file", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first"))
    return found.join(first, "file").select("doc", "slot", "shard", (F.col("first") + F.col("row")).alias("place"))


def sharded(docs: DataFrame, shards: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """Put the records into so many shards of near-equal bytes: the stored records and the version of the map in folder/map."""
    spark = prepare(docs.sparkSession)
    _, current = latest(spark, f"{folder}/map")
    if current is None:
        current = dealt(shards)
        stored_version(spark, current, f"{folder}/map")
    current = rebalanced(current, cells(docs, shards, id_col, text_col), shards)
    version = stored_version(spark, current, f"{folder}/map")
    return written(docs, current, f"{folder}/data-{uuid.uuid4().hex}", id_col, text_col), version
