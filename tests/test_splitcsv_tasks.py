"""Byte ranges of large files: tasks grow with the bytes, and a task reads little beyond its range."""

import io

import pytest

from marketscope.sources import splitcsv


@pytest.mark.parametrize("megabytes,tasks", [(1, 64), (6000, 188)])
def test_small_ranges_share_tasks(spark, megabytes, tasks):
    step = 1 << 20 if megabytes > 1 else 1 << 8
    size = megabytes << 20
    ranges = spark.range(0, size, step).selectExpr("'f' AS path", "id AS start", f"least(id + {step}, {size}) AS stop")
    spread = splitcsv._spread(ranges)
    assert spread.rdd.getNumPartitions() == tasks and spread.agg({"start": "sum"}).first() == ranges.agg({"start": "sum"}).first()


def test_few_ranges_have_a_task_each(spark):
    ranges = spark.range(0, 40 << 20, 1 << 20).selectExpr("'f' AS path", "id AS start", "id + 1048576 AS stop")
    assert splitcsv._spread(ranges).rdd.getNumPartitions() == 40
    assert splitcsv._spread(ranges.limit(0)).rdd.getNumPartitions() == 1


def test_a_range_reads_little_beyond_its_end():
    class Counted(io.BytesIO):
        got = 0

        def read(self, n=-1):
            data = super().read(n)
            Counted.got += len(data)
            return data

    text = b"".join(b'%d;"a\nb";c\n' % i for i in range(500_000))
    size, found = 1 << 20, 0
    for start in range(0, len(text), size):
        stop = min(start + size, len(text))
        inside = text[:start].count(b'"') % 2 == 1
        for places, _, _ in splitcsv.range_records(Counted(text), start, stop, inside, ";"):
            found += len(places)
    assert found == 500_000
    assert Counted.got < 1.2 * len(text)
