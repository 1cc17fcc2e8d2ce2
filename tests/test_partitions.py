"""The stream over landed partitions: progress by offset."""

from __future__ import annotations

import datetime as dt

import pytest

from martlens.sources import messages, partitions
from martlens.streaming import rollups

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def topic(spark, tmp_path):
    """Land (partition, offset) records, read what is new, and return all that was read so far."""

    def step(records, starting="{}"):
        rows = [(p, o, T0, None if o % 2 else str(o), f"{p}:{o}:{extra}") for p, o, extra in records]
        if rows:
            partitions.land(spark.createDataFrame(rows, partitions.RECORDS), str(tmp_path / "in"))
        stream = messages.read_stream(spark, "partitions", {"startingOffsets": starting}, str(tmp_path / "in"))
        rollups.write_available(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        return sorted((r.seq.part, r.seq.offset, r.value.split(":")[2]) for r in spark.read.schema(f"seq {messages.PLACE}, key STRING, value STRING").parquet(str(tmp_path / "out")).collect())

    return step


def test_each_offset_is_read_once(topic):
    first = [(0, 5, "a"), (0, 9, "a"), (1, 1_000_000, "a")]
    assert topic(first) == first
    # an offset again, a gap, a new partition
    more = [(0, 9, "b"), (0, 30, "b"), (2, 7, "b")]
    assert topic(more) == sorted(first + [(0, 30, "b"), (2, 7, "b")])
    assert topic([]) == sorted(first + [(0, 30, "b"), (2, 7, "b")])


def test_starting_offsets(topic):
    assert topic([(0, 1, "a"), (0, 2, "a"), (1, 1, "a")], '{"0": 2}') == [(0, 2, "a"), (1, 1, "a")]


def test_an_empty_topic_gives_no_rows(spark, tmp_path):
    reader = partitions.LandedReader({"path": str(tmp_path / "none")})
    assert reader.latestOffset() == {} and reader.partitions({}, {}) == []


def test_a_large_partition_is_read_by_several_tasks(spark, tmp_path):
    for low in (0, 100, 200):
        rows = [(0, low + k, T0, None, "x") for k in range(100)]
        partitions.land(spark.createDataFrame(rows, partitions.RECORDS).coalesce(1), str(tmp_path))
    reader = partitions.LandedReader({"path": str(tmp_path)})
    spans = reader.partitions({"0": 150}, {"0": 250})
    assert sorted((s.start, s.end) for s in spans) == [(150, 200), (200, 250)]
    assert sum(len(b) for s in spans for b in reader.read(s)) == 100
