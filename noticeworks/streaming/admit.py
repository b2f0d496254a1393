"""Streams with state: listings admitted once unless they failed, verdicts folded per notice."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STATE = T.StructType([T.StructField("status", T.StringType()), T.StructField("attempts", T.IntegerType()), T.StructField("place", T.LongType())])


def admitted(stream: DataFrame, key: str, place: str, status: str) -> DataFrame:
    """Per key the outcomes that need work: the first, one after a failure, and unlinked changes; ``reason`` says which.

    The state of a key is its last status, the failures since its last success, and the last place; what comes late (a
    place already passed) is ignored. Rows of a key within a batch are taken in order of ``place``.
    """
    out = T.StructType([T.StructField("key", T.StringType()), T.StructField("place", T.LongType()), T.StructField("reason", T.StringType()), T.StructField("attempts", T.IntegerType())])

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, attempts, seen = state.get if state.exists else (None, 0, -1)
        rows: list[tuple] = []
        for batch in batches:
            rows.extend(zip(batch["place"], batch["status"]))
        found = []
        for at, now in sorted(rows):
            if at <= seen:
                continue
            reason = "new" if last is None else "retry" if last == "failed" else "unlinked" if last == "unlinked_change" else None
            if reason:
                found.append((k[0], int(at), reason, int(attempts)))
                attempts = attempts + 1 if now == "failed" else 0
                last = now
            seen = int(at)
        state.update((last, int(attempts), int(seen)))
        yield pd.DataFrame(found, columns=["key", "place", "reason", "attempts"])

    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(place).cast("bigint").alias("place"), F.col(status).alias("status"))
    return rows.groupBy("key").applyInPandasWithState(step, out, _STATE, "append", "NoTimeout")


def admitted_once(stream: DataFrame, key: str, event_time: str, late: str = "6 hours") -> DataFrame:
    """Each key once within the watermark: late rows up to ``late`` are still compared."""
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, late).dropDuplicatesWithinWatermark([key])


def verdict_stream(stream: DataFrame) -> DataFrame:
    """Running verdict per notice (update mode): the last confirmation or exclusion in order of ``place``."""
    status = F.when(F.col("action") == "confirm", "confirmed").when(F.col("action") == "exclude", "excluded")
    return stream.withColumn("s", status).groupBy("url").agg(F.max_by("s", F.when(F.col("s").isNotNull(), F.col("place"))).alias("status"), F.count("*").alias("events"))


def counts_by_window(stream: DataFrame, event_time: str, key: str, width: str = "1 day", late: str = "6 hours") -> DataFrame:
    """Rows per key and window of event time; a window is final once the watermark has passed it."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, late)
    return timed.groupBy(F.window(event_time, width), key).agg(F.count("*").alias("rows"))
