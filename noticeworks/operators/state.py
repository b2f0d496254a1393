"""Incremental state of sources as tables: what to process, what failed, what to forget. ``as_of`` is always given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_process(listing: DataFrame, processed: DataFrame, failed: DataFrame, keys: list[str]) -> DataFrame:
    """Listings that failed before, were never seen, or whose change is still unlinked; each with the reason."""
    p = processed.select(*keys, F.col("status").alias("_status"))
    f = failed.select(*keys, F.lit(True).alias("_failed")).distinct()
    joined = listing.join(p, keys, "left").join(f, keys, "left")
    reason = F.when(F.col("_failed"), "retry").when(F.col("_status").isNull(), "new").when(F.col("_status") == "unlinked_change", "unlinked")
    return joined.withColumn("reason", reason).where("reason is not null").drop("_status", "_failed")


def fold_outcomes(outcomes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The log of outcomes (``status``; ``failed`` is one) folded: last status, and of the failures since the last success their number and first time."""
    success = outcomes.groupBy(*keys).agg(F.max(F.when(F.col("status") != "failed", F.col(order))).alias("_ok"))
    marked = outcomes.join(success, keys).withColumn("_open", (F.col("status") == "failed") & (F.col("_ok").isNull() | (F.col(order) > F.col("_ok"))))
    return marked.groupBy(*keys).agg(
        F.max_by("status", order).alias("status"),
        F.count_if(F.col("_open")).alias("attempts"),
        F.min(F.when(F.col("_open"), F.col(order))).alias("first_failed_at"),
        F.max(order).alias("last_at"),
    )


def pruned(state: DataFrame, as_of: Column, processed_days: int = 60, failed_days: int = 7) -> DataFrame:
    """Forgets what was released ``processed_days`` ago or has failed for ``failed_days``; unknown dates are kept."""
    old = F.coalesce(F.col("released") < F.date_sub(as_of, processed_days), F.lit(False))
    stale = F.coalesce(F.col("first_failed") < F.date_sub(as_of, failed_days), F.lit(False))
    return state.where(~old & ~stale)


def mark_new(rows: DataFrame, previous: DataFrame, key: str, today: Column) -> DataFrame:
    """Adds ``new_on`` and ``is_new``: known keys keep their day, others are new today."""
    known = previous.select(key, F.col("new_on").alias("_on"), F.lit(True).alias("_known"))
    out = rows.join(known, key, "left")
    new_on = F.when(F.col("_known"), F.col("_on")).otherwise(today)
    return out.withColumns({"new_on": new_on, "is_new": F.coalesce(new_on == today, F.lit(False))}).drop("_on", "_known")


def quota(listing: DataFrame, source: str, first: Column, order: list[Column], most: int) -> DataFrame:
    """Listings to examine: all that ``first`` marks, and of the others of each source the first ``most``; ``examined`` says which."""
    from .merge import ranked

    placed = ranked(listing.withColumn("_first", F.coalesce(first, F.lit(False))), [source, "_first"], order, "_place")
    return placed.withColumn("examined", F.col("_first") | (F.col("_place") <= most)).drop("_first", "_place")


def frontier(found: DataFrame, source: str, number: str, start: Column, misses: int) -> DataFrame:
    """Scanning numbers upward from ``start``: those found before ``misses`` numbers in a row were missing."""
    from pyspark.sql import Window

    w = Window.partitionBy(source).orderBy(number)
    gap = F.col(number) - F.coalesce(F.lag(number).over(w), start) - 1
    broken = F.max(F.when(gap >= misses, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return found.where(F.col(number) > start).withColumn("_broken", broken).where("_broken = 0").drop("_broken")


def valid_for_signature(processed: DataFrame, signature: Column) -> DataFrame:
    """What was processed under the same keyword signature; a new signature starts over."""
    return processed.where(F.col("signature") == signature)


def cached(listing: DataFrame, cache: DataFrame, key: str, as_of: Column, days: int) -> DataFrame:
    """Listings with their cached detail: ``fresh``, ``stale`` (a fallback only) or ``missing``."""
    c = cache.select(key, F.col("detail"), F.col("cached_on"))
    out = listing.join(c, key, "left")
    return out.withColumn("cache", F.when(F.col("cached_on").isNull(), "missing").when(F.datediff(as_of, F.col("cached_on")) < days, "fresh").otherwise("stale"))


def advance_cursors(cursors: DataFrame, runs: DataFrame, source: str) -> DataFrame:
    """Cursors after a run: only complete runs count; a weekly run moves the weekly cursor, a monthly one both.

    ``cursors``: source, last, weekly, monthly; ``runs``: source, mode, started, complete.
    """
    done = runs.where("complete").groupBy(source).agg(
        F.max("started").alias("_last"),
        F.max(F.when(F.col("mode").isin("weekly", "monthly", "bootstrap"), F.col("started"))).alias("_weekly"),
        F.max(F.when(F.col("mode").isin("monthly", "bootstrap"), F.col("started"))).alias("_monthly"),
    )
    out = cursors.join(done, source, "full")
    return out.select(source, *[F.greatest(c, f"_{c}").alias(c) for c in ("last", "weekly", "monthly")])


def largest_kept(ids: DataFrame, source: str, number: str, most: int) -> DataFrame:
    """Per source the ``most`` largest numbers."""
    from .merge import ranked

    return ranked(ids, [source], [F.desc(number)], "_place").where(F.col("_place") <= most).drop("_place")
