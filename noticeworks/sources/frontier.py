"""An id frontier as a data source: numbers are tried upward from the last known one until too many in a row are missing.

Batch and stream read the same JSON lines file of notices (``id`` and any other fields); the stream's offset is the last id.
Options: ``path``, ``last_id`` (-1), ``max_scan`` (800), ``misses`` (20).
"""

from __future__ import annotations

import io
import json
import os

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader


def scan(known: dict[int, str], last: int, most: int, misses: int) -> tuple[list[tuple[int, str]], int]:
    """The notices after ``last`` up to the frontier, and the highest id seen."""
    found, seen, missed = [], last, 0
    for i in range(last + 1, last + most + 1):
        if i in known:
            found.append((i, known[i]))
            seen, missed = i, 0
        else:
            missed += 1
            if missed >= misses:
                break
    return found, seen


def _load(path: str, last: int, most: int) -> dict[int, str]:
    """The notices numbered ``last + 1`` to ``last + most``. The file streams by, so memory is bounded by ``most``; it may lie in any
    store that Arrow opens by its address (a plain path is local)."""
    store, at = fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))
    found: dict[int, str] = {}
    with store.open_input_stream(at) as raw:
        for line in io.TextIOWrapper(raw, encoding="utf-8"):
            if line.strip() and last < (number := int(json.loads(line)["id"])) <= last + most:
                found[number] = line.strip()
    return found


class _Batch(DataSourceReader):
    def __init__(self, o):
        self.o = o

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        o = self.o
        last, most = int(o.get("last_id", -1)), int(o.get("max_scan", 800))
        yield from scan(_load(o["path"], last, most), last, most, int(o.get("misses", 20)))[0]


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, o):
        self.o = o

    def initialOffset(self):
        return {"last_id": int(self.o.get("last_id", -1))}

    def read(self, start):
        o = self.o
        last, most = start["last_id"], int(o.get("max_scan", 800))
        found, seen = scan(_load(o["path"], last, most), last, most, int(o.get("misses", 20)))
        return iter(found), {"last_id": seen}

    def readBetweenOffsets(self, start, end):
        known = _load(self.o["path"], start["last_id"], end["last_id"] - start["last_id"])
        return iter([(i, known[i]) for i in range(start["last_id"] + 1, end["last_id"] + 1) if i in known])


class FrontierSource(DataSource):
    @classmethod
    def name(cls):
        return "notice_frontier"

    def schema(self):
        return "id bigint, body string"

    def reader(self, schema):
        return _Batch(self.options)

    def simpleStreamReader(self, schema):
        return _Stream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FrontierSource)
