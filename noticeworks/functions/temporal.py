"""Dates and times as text: normal forms that never guess, windows, retention. ``as_of`` is always given, never the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three written forms of a full date.
_CN = r"(\d{4})年(\d{1,2})月(\d{1,2})日(?:\s*(\d{1,2})[：:时](\d{1,2})?)?"
_ISO = r"^(\d{4}-\d{2}-\d{2})(?:[ T](\d{1,2}:\d{2}))?"
_DOT = r"^(\d{4})\.(\d{2})\.(\d{2})"


def compact_date_text(c: Column) -> Column:
    """Spaces between digits and around date characters removed."""
    c = F.regexp_replace(c, r"(?<=\d)\s+(?=\d)", "")
    return F.regexp_replace(F.regexp_replace(c, r"\s+(?=[年月日时分])", ""), r"(?<=[年月日时分])\s+", "")


def normalize_date(c: Column, include_time: bool = False) -> Column:
    """A written date as YYYY-MM-DD[ HH:MM]; texts without a full date stay unchanged, null gives ''."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), "^[\\s\"']+|[\\s\"']+$", "")
    pad = lambda i, n: F.lpad(F.regexp_extract(t, _CN, i), n, "0")
    chinese = F.concat_ws("-", pad(1, 4), pad(2, 2), pad(3, 2))
    iso, dot = F.regexp_extract(t, _ISO, 1), F.concat_ws("-", *[F.regexp_extract(t, _DOT, i) for i in (1, 2, 3)])
    if include_time:
        hour, minute = F.regexp_extract(t, _CN, 4), F.regexp_extract(t, _CN, 5)
        chinese = F.when(hour != "", F.concat(chinese, F.lit(" "), F.lpad(hour, 2, "0"), F.lit(":"), F.lpad(minute, 2, "0"))).otherwise(chinese)
        clock = F.regexp_extract(t, _ISO, 2)
        iso = F.when(clock != "", F.concat(iso, F.lit(" "), clock)).otherwise(iso)
    return F.when(t.rlike(_CN), chinese).when(t.rlike(_ISO), iso).when(t.rlike(_DOT), dot).otherwise(t)


def date_part(c: Column) -> Column:
    """The first zero-padded date of this century in a text, '' if it is none of the calendar."""
    found = F.regexp_extract(F.coalesce(c, F.lit("")), r"20\d{2}-\d{1,2}-\d{1,2}", 0)
    return F.when(found.rlike(r"^\d{4}-\d{2}-\d{2}$") & found.try_cast("date").isNotNull(), found).otherwise(F.lit(""))


def day_of(c: Column) -> Column:
    """The date a text begins with, null if it begins with none."""
    head = F.substring(F.coalesce(c, F.lit("")), 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date"))


def epoch_local(ms: Column, zone: str = "Asia/Shanghai", pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Milliseconds since 1970 as local text. The session's zone plays no part."""
    return F.date_format(F.from_utc_timestamp(F.timestamp_seconds(F.floor(ms / 1000)), zone), pattern)


def serial_date(c: Column) -> Column:
    """A spreadsheet's day count (30,000 to 80,000) as date text, with the time if it has one; other texts as they are."""
    n = c.try_cast("double")
    stamp = F.timestamp_seconds(F.round(n * 86400, 0).cast("bigint") - 2_209_161_600)
    text = F.when(n == F.floor(n), F.date_format(stamp, "yyyy-MM-dd")).otherwise(F.date_format(stamp, "yyyy-MM-dd HH:mm"))
    return F.when(n.between(30_000, 80_000), text).otherwise(F.trim(F.coalesce(c, F.lit(""))))


def within_days(day: Column, as_of: Column, days: int) -> Column:
    """Is the day at most ``days`` before ``as_of``? Unknown days are not."""
    return F.coalesce(day >= F.date_sub(as_of, days), F.lit(False))


def retained(day: Column, cutoff: Column, unknown: bool) -> Column:
    """Is the day on or after the cutoff? ``unknown`` decides for days that are not known."""
    return F.coalesce(day >= cutoff, F.lit(unknown))


def elapsed_days(then: Column, now: Column) -> Column:
    return F.greatest(F.lit(0), F.datediff(now, then))


def collection_start(last: Column, weekly: Column, monthly: Column, now: Column) -> tuple[Column, Column]:
    """Mode and start of the next collection window of a source from its three cursors.

    No success yet: 30 days. Monthly check due (30 days): 45 days. Weekly due (7 days): 14 days. Else the last success less
    six hours, so that late records are read again and admitted once.
    """
    due = lambda c, days: c.isNull() | (c <= now - F.expr(f"INTERVAL {days} DAYS"))
    mode = F.when(last.isNull(), "bootstrap").when(due(monthly, 30), "monthly").when(due(weekly, 7), "weekly").otherwise("incremental")
    start = (
        F.when(last.isNull(), now - F.expr("INTERVAL 30 DAYS")).when(due(monthly, 30), now - F.expr("INTERVAL 45 DAYS"))
        .when(due(weekly, 7), now - F.expr("INTERVAL 14 DAYS")).otherwise(last - F.expr("INTERVAL 6 HOURS"))
    )
    return mode, start


def catch_up_window(gap_days: Column) -> Column:
    """The narrowest list window that covers a gap of days."""
    return F.when(gap_days <= 0, "td").when(gap_days == 1, "l3d").when(gap_days <= 9, "l10d").when(gap_days <= 29, "l1m").otherwise("l3m")


_LOOSE = r"(\d{4})[-年](\d{1,2})[-月](\d{1,2})日?(?:[ T]?\s*(\d{1,2}):(\d{2}))?"


def loose_date(text: Column, include_time: bool = False) -> Column:
    """The first date of a text that mixes hyphens and 年月日, as YYYY-MM-DD[ HH:MM]; other texts stay, cleaned."""
    from .text import clean_text

    t = clean_text(text)
    part = lambda i, n: F.lpad(F.regexp_extract(t, _LOOSE, i), n, "0")
    day = F.concat_ws("-", part(1, 4), part(2, 2), part(3, 2))
    if include_time:
        day = F.when(F.regexp_extract(t, _LOOSE, 4) != "", F.concat(day, F.lit(" "), part(4, 2), F.lit(":"), F.regexp_extract(t, _LOOSE, 5))).otherwise(day)
    return F.when(t.rlike(_LOOSE), day).otherwise(t)
