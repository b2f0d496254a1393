"""Listings of sources: rows taken out of pages, read until they are too old, originals before their changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import any_word, words_literal
from ..functions.temporal import normalize_date
from ..functions.text import clean_text


def listed_rows(pages: DataFrame, page: str, row: str, names: list[str]) -> DataFrame:
    """One row per match of ``row`` in each page, its groups as cleaned columns ``names``, ``ord`` their place."""
    groups = [F.regexp_extract_all(F.col(page), F.lit(row), F.lit(i + 1)) for i in range(len(names))]
    zipped = F.arrays_zip(*[g.alias(n) for g, n in zip(groups, names)])
    out = pages.select(*[c for c in pages.columns if c != page], F.posexplode(zipped).alias("ord", "x"))
    return out.select(*[c for c in pages.columns if c != page], "ord", *[clean_text(F.col("x").getItem(n)).alias(n) for n in names])


def until_cutoff(rows: DataFrame, section: list[str], page: str, day: str, cutoff: Column) -> DataFrame:
    """A section is read page by page up to and with the first page that holds a row before ``cutoff``; older rows are dropped.

    Rows of unknown day are kept. The last page of each section is found by a partial aggregation.
    """
    last = rows.where(F.col(day) < cutoff).groupBy(*section).agg(F.min(page).alias("_last"))
    return rows.join(last, section, "left").where(F.col("_last").isNull() | (F.col(page) <= F.col("_last"))).where(F.coalesce(F.col(day) >= cutoff, F.lit(True))).drop("_last")


def collected(
    rows: DataFrame, key: str, place: list[str], *, day: Column | None = None, cutoff: Column | None = None, wanted: Column | None = None, dropped: Column | None = None,
    seen: DataFrame | None = None, again: DataFrame | None = None,
) -> DataFrame:
    """What a source's listing gives to work on: its rows in the window, of each ``key`` the last by ``place``, not ``seen`` before.

    ``day`` before ``cutoff`` is out of the window, an unknown day in it; ``wanted`` (a keyword in a name, a region in the title) must
    hold, ``dropped`` (a result notice) must not, null counts as no. ``again`` are rows to take up again (failed before, or to be
    refreshed) whose key this listing does not have; ``requeued`` tells them. Rows without a key are left out.
    """
    from .merge import last_wins, unseen

    kept = rows.where(F.col(key).isNotNull())
    if day is not None:
        kept = kept.where(F.coalesce(day >= cutoff, F.lit(True)))
    if wanted is not None:
        kept = kept.where(F.coalesce(wanted, F.lit(False)))
    if dropped is not None:
        kept = kept.where(~F.coalesce(dropped, F.lit(False)))
    once = last_wins(kept, [key], place)
    fresh = (unseen(once, seen, [key]) if seen is not None else once).withColumn("requeued", F.lit(False))
    if again is None:
        return fresh
    more = last_wins(again.where(F.col(key).isNotNull()), [key], place)
    return fresh.unionByName(more.join(once.select(key), key, "left_anti").withColumn("requeued", F.lit(True)))


# What became of a listed notice.
OUTCOMES = ["missing_url", "region_prefilter", "result_notice", "ignored_notice_type", "missing_notice", "frozen", "unlinked_change", "change_applied", "matched", "not_matched"]


def outcome(tests: dict[str, Column]) -> Column:
    """The first outcome, in the order of ``OUTCOMES``, whose test holds; ``not_matched`` if none does. Null tests do not hold."""
    if unknown := set(tests) - set(OUTCOMES):
        raise ValueError(f"no such outcomes: {sorted(unknown)}")
    return F.coalesce(*[F.when(tests[name], F.lit(name)) for name in OUTCOMES if name in tests], F.lit("not_matched"))


def notice_kind(title: Column, change: list[str], original: list[str], ignored: list[str]) -> Column:
    """ignored before change before original; other titles are ignored."""
    hit = lambda words: any_word(title, words_literal(words))
    return F.when(hit(ignored), "ignored").when(hit(change), "change").when(hit(original), "original").otherwise("ignored")


def processing_order(is_change: Column, time: Column, place: Column) -> list[Column]:
    """Originals first in their order, then changes by time."""
    return [is_change.asc(), F.when(is_change, time).asc_nulls_first(), place.asc()]


def public_item(rows: DataFrame, source_name: Column) -> DataFrame:
    """A notice as published: dates normalised, the period rebuilt from both ends, missing source and content filled."""
    start = F.regexp_extract("registration_period", r"^(.*?)(?:至|到|~)(.*)$", 1)
    end = F.regexp_extract("registration_period", r"^(.*?)(?:至|到|~)(.*)$", 2)
    period = F.when((start != "") & (end != ""), F.concat(normalize_date(start, True), F.lit("至"), normalize_date(end, True))).otherwise(F.coalesce("registration_period", F.lit("")))
    return rows.withColumns(
        {
            "published_at": normalize_date(F.col("published_at")),
            "bid_deadline": normalize_date(F.col("bid_deadline"), True),
            "registration_period": period,
            "date_basis": F.coalesce(F.nullif("date_basis", F.lit("")), F.lit("official")),
            "source_name": F.coalesce(F.nullif("source_name", F.lit("")), source_name, F.lit("")),
            "project_content": F.coalesce(F.nullif(F.trim("project_content"), F.lit("")), F.col("summary"), F.lit("")),
        }
    )
