"""What a run asks of a source, and what it did: windows and their retention, scans of numbers and of listings in phases.

Defined results: unknown (null) days of success count as never; sources without answers, retries or listings are whole
scans of nothing; repeated answers for one number count once (found before failed before missing); extra columns are kept
where rows are handed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.temporal import catch_up_window

# Windows of a listing from the narrowest to the widest.
WINDOWS = ["td", "l3d", "l10d", "l1m", "l3m", "l1y", "all"]


def window_rank(window: Column) -> Column:
    """Place of a window in ``WINDOWS``, from 0; null for others."""
    return F.nullif(F.array_position(F.array(*[F.lit(w) for w in WINDOWS]), window), F.lit(0)) - 1


def run_choice(gap: Column, weekly_gap: Column, monthly_gap: Column, manual: Column, is_empty: Column) -> Column:
    """``struct(mode, window)`` of the next run of a source, from days since its last success and its last backfills.

    A manual window holds. Without items, or without a success, the run is a bootstrap. Else the widest of what the gap needs
    and of the backfills that are due (monthly after 30 days, weekly after 7); of equally wide ones the first of these three.
    """
    option = lambda mode, window, due: F.when(due, F.struct(window_rank(window).alias("rank"), mode.alias("mode"), window.alias("window")))
    needed = catch_up_window(gap)
    options = F.array_compact(
        F.array(
            option(F.when(gap <= 1, "daily").otherwise("catchup"), needed, F.lit(True)),
            option(F.lit("monthly"), F.lit("l3m"), F.coalesce(monthly_gap >= 30, F.lit(True))),
            option(F.lit("weekly"), F.lit("l1m"), F.coalesce(weekly_gap >= 7, F.lit(True))),
        )
    )
    widest = F.reduce(F.slice(options, 2, 2), options[0], lambda best, x: F.when(x["rank"] > best["rank"], x).otherwise(best))
    chosen = F.when(manual.isNotNull(), F.struct(F.lit("manual").alias("mode"), manual.alias("window")))
    chosen = chosen.when(is_empty | gap.isNull(), F.struct(F.lit("bootstrap").alias("mode"), F.lit("l3m").alias("window")))
    return chosen.otherwise(F.struct(widest["mode"].alias("mode"), widest["window"].alias("window")))


def retention_start(today: Column, mode: Column, window: Column) -> Column:
    """The first day that is kept: none for a manual run over all, 366 days back for a manual year, else three months back."""
    manual = mode == "manual"
    return F.when(manual & (window == "all"), F.lit(None).cast("date")).when(manual & (window == "l1y"), F.date_sub(today, 366)).otherwise(F.add_months(today, -3))


def backfills_done(window: Column) -> tuple[Column, Column]:
    """Whether a complete run over ``window`` counts as the weekly and as the monthly backfill."""
    rank = window_rank(window)
    return rank >= WINDOWS.index("l1m"), rank >= WINDOWS.index("l3m")


def number_scan(cursors: DataFrame, answers: DataFrame, processed: DataFrame, retries: DataFrame, source: str, number: str, most: int, misses: int, rewind: dict[str, int]) -> DataFrame:
    """What a scan of numbers does: ``source, number, step, outcome``, one row per number that is asked.

    ``cursors``: source, last, mode (``rewind`` says how far back a mode goes); ``answers``: source, number, answer (found or
    failed); what has no answer is missing. Retries (source, number) are asked first (``step`` 0), then the range in order (1).
    Known numbers up to ``last`` that are processed are not asked again. Beyond ``last`` the scan ends with the ``misses``-th
    number in a row that is not found. A missing number is ``missing_notice`` if it is known, and is ``cleared`` beyond.
    Numbers per source are bounded by ``most`` and ``rewind``.
    """
    back = F.lit(0)
    for mode, n in rewind.items():
        back = F.when(F.col("mode") == mode, n).otherwise(back)
    start = F.greatest(F.lit(1), F.col("last") + 1 - F.when(back > 0, back + 1).otherwise(0))
    ranges = cursors.select(source, "last", F.explode(F.sequence(start, F.col("last") + most)).alias(number))
    again = retries.select(source, number).distinct().join(cursors.select(source, "last"), source).withColumn("_retry", F.lit(True))
    asked = ranges.withColumn("_range", F.lit(True)).join(again, [source, number, "last"], "full")
    worst = answers.groupBy(source, number).agg(F.max(F.when(F.col("answer") == "found", 2).when(F.col("answer") == "failed", 1)).alias("_a"))
    done = processed.select(source, number).distinct().withColumn("_done", F.lit(True))
    rows = asked.join(worst, [source, number], "left").join(done, [source, number], "left")
    rows = rows.where((F.col(number) > F.col("last")) | F.col("_done").isNull())
    rows = rows.withColumn("step", F.when(F.col("_retry"), 0).otherwise(1))
    frontier, order = F.col(number) > F.col("last"), Window.partitionBy(source).orderBy("step", number)
    before = order.rowsBetween(Window.unboundedPreceding, 0)
    missed = F.sum(F.when(frontier & F.coalesce(F.col("_a") != 2, F.lit(True)), 1).otherwise(0)).over(before)
    at_found = F.coalesce(F.max(F.when(F.col("_a") == 2, F.col("_missed"))).over(before), F.lit(0))
    ended = F.coalesce(F.max("_run").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_missed", missed).withColumn("_run", F.when(frontier, F.col("_missed") - at_found).otherwise(0)).withColumn("_ended", ended).where(F.col("_ended") < misses)
    outcome = F.when(F.col("_a") == 2, "found").when(F.col("_a") == 1, "failed").when(frontier, "cleared").otherwise("missing_notice")
    return rows.select(source, number, "step", outcome.alias("outcome"))


def phased_scan(listing: DataFrame, retries: DataFrame, source: str, key: str, title_hit: Column, order: list[Column], most: int = 300, most_failures: int = 3) -> DataFrame:
    """Every listing and retry with its ``phase``: title (no cap), retry (failed less than ``most_failures`` times), given_up,
    content (the first ``most`` others of a source in ``order``), left_out. ``retries``: source, key, failures.
    """
    from .state import quota

    seen = quota(listing.withColumn("_title", F.coalesce(title_hit, F.lit(False))), source, F.col("_title"), order, most)
    phase = F.when(F.col("_title"), "title").when(F.col("examined"), "content").otherwise("left_out")
    again = retries.select(source, key, F.when(F.col("failures") < most_failures, "retry").otherwise("given_up").alias("phase"))
    return seen.select(source, key, phase.alias("phase")).unionByName(again)


def scan_summary(phases: DataFrame, source: str) -> DataFrame:
    """Per source the rows of each phase, whether the scan was complete, and the warning if it was not."""
    n = lambda p: F.count_if(F.col("phase") == p).alias(p)
    out = phases.groupBy(source).agg(*[n(p) for p in ("title", "retry", "given_up", "content", "left_out")])
    return out.withColumns({"scan_complete": F.col("left_out") == 0, "warning": F.when(F.col("left_out") > 0, F.concat(F.col("left_out").cast("string"), F.lit(" not examined")))})


def seeded_cache(cache: DataFrame, rows: DataFrame, key: str, fields: list[str], cached_on: Column) -> DataFrame:
    """The detail cache (key, fields, cached_on), or, if it is empty, what ``rows`` say in any of ``fields``."""
    said = F.array_join(F.array(*[F.coalesce(F.trim(f), F.lit("")) for f in fields]), "") != ""
    seeds = rows.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").where(said).select(key, *fields, cached_on.alias("cached_on"))
    some = cache.select(F.lit(True).alias("_some")).limit(1)
    return cache.select(key, *fields, "cached_on").unionByName(seeds.join(F.broadcast(some), F.lit(True), "left_anti"))  # one row at most


def kept_cache(cache: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Entries whose key is still among ``rows``."""
    return cache.join(rows.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")
