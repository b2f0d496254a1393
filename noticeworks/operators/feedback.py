"""Human verdicts on notices: events are checked, folded in order and laid over the data. A conflict rejects the batch whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fresh_events(events: DataFrame, processed: DataFrame) -> DataFrame:
    """Events not yet applied, each id once (its first place)."""
    new = events.join(processed.select("event_id").distinct(), "event_id", "left_anti")
    return new.groupBy("event_id").agg(F.min_by(F.struct(*[c for c in events.columns if c != "event_id"]), "place").alias("x")).select("event_id", "x.*")


def conflicts(events: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Keys confirmed and excluded in one batch, or against their standing verdict; ``why`` says which."""
    asked = events.where("action in ('confirm', 'exclude')").groupBy("url").agg(F.min("action").alias("low"), F.max("action").alias("high"))
    standing = verdicts.select("url", F.col("status").alias("standing"))
    wanted = F.when(F.col("low") == "confirm", "confirmed").otherwise("excluded")
    both = asked.join(standing, "url", "left")
    why = F.when(F.col("low") != F.col("high"), "both in one batch").when(F.col("standing").isNotNull() & (F.col("standing") != wanted), "against the standing verdict")
    return both.withColumn("why", why).where("why is not null").select("url", "why")


def faults(events: DataFrame, fields: list[str]) -> DataFrame:
    """``url, why`` of events that cannot be applied: no id, an unknown action, an exclusion without a reason, a correction of
    another field or to nothing."""
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    why = (
        F.when(blank("event_id"), "no id")
        .when(~F.coalesce(F.col("action").isin("confirm", "exclude", "correct"), F.lit(False)), "unknown action")
        .when((F.col("action") == "exclude") & blank("reason"), "no reason")
        .when((F.col("action") == "correct") & ~F.coalesce(F.col("field").isin(fields), F.lit(False)), "not a field to correct")
        .when((F.col("action") == "correct") & blank("new_value"), "no value")
    )
    return events.select("url", why.alias("why")).where("why is not null")


def admitted(events: DataFrame, processed: DataFrame, verdicts: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """A batch of events, whole or not at all: the fresh events to apply, and the problems (``url, why``) for which none is.

    Faults of any event and conflicts of fresh ones reject the batch; events that were processed before are left out.
    """
    fresh = fresh_events(events, processed)
    problems = faults(events, fields).unionByName(conflicts(fresh, verdicts))
    some = problems.select(F.lit(True).alias("_some")).limit(1)  # one row at most
    return fresh.join(F.broadcast(some), F.lit(True), "left_anti"), problems


def verdict_summary(events: DataFrame) -> DataFrame:
    """One row about all applied events: notices confirmed, excluded and corrected."""
    status = folded_verdicts(events)
    corrected = folded_corrections(events).agg(F.count_distinct("url").alias("corrected"))
    counts = status.agg(F.count_if(F.col("status") == "confirmed").alias("confirmed"), F.count_if(F.col("status") == "excluded").alias("excluded"))
    return counts.crossJoin(corrected)  # one row each


def exclusion_reasons(events: DataFrame) -> DataFrame:
    """``reason, notices, first_place``: why the notices that stand excluded were, by their last verdict; order by notices descending,
    then by first_place."""
    last = events.where("action in ('confirm', 'exclude')").groupBy("url").agg(F.max_by(F.struct("action", F.trim("reason").alias("reason")), "place").alias("x"), F.min("place").alias("first_place"))
    return last.where("x.action = 'exclude' and coalesce(x.reason, '') != ''").groupBy(F.col("x.reason").alias("reason")).agg(F.count("*").alias("notices"), F.min("first_place").alias("first_place"))


def enriched(events: DataFrame, rows: DataFrame, key: str = "url") -> DataFrame:
    """Events whose ``item`` (a map) is laid over the fields of their current row."""
    held = [c for c in rows.columns if c != key]
    current = rows.select(key, F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(c), F.col(c).cast("string")) for c in held]), lambda e: e["col2"].isNotNull())).alias("_row"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    mine, theirs = F.coalesce("item", empty), F.coalesce("_row", empty)
    both = F.map_concat(F.map_filter(theirs, lambda k, _: ~F.map_contains_key(mine, k)), mine)
    return events.join(current, key, "left").withColumn("item", both).drop("_row")


def folded_verdicts(events: DataFrame) -> DataFrame:
    """Per key the last verdict, its place and the number of events, in the order of ``place``."""
    status = F.when(F.col("action") == "confirm", "confirmed").when(F.col("action") == "exclude", "excluded")
    return events.withColumn("_s", status).groupBy("url").agg(F.max_by("_s", F.when(F.col("_s").isNotNull(), F.col("place"))).alias("status"), F.max("place").alias("last_place"), F.count("*").alias("events"))


def folded_corrections(events: DataFrame) -> DataFrame:
    """Per key and field the last corrected value."""
    return events.where("action = 'correct'").groupBy("url", "field").agg(F.max_by("new_value", "place").alias("new_value"), F.count("*").alias("times"))


def apply_verdicts(rows: DataFrame, verdicts: DataFrame, corrections: DataFrame, fields: list[str]) -> DataFrame:
    """Excluded rows go, corrected fields take their value, ``review_status`` is the verdict (review if there is none)."""
    wide = corrections.groupBy("url").agg(*[F.max(F.when(F.col("field") == f, F.col("new_value"))).alias(f"_n_{f}") for f in fields])
    out = rows.join(verdicts.select("url", F.col("status").alias("_v")), "url", "left").join(wide, "url", "left").where("_v is null or _v != 'excluded'")
    return out.select(*[F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in rows.columns if c != "review_status"], F.coalesce("_v", F.lit("review")).alias("review_status"))


def restored(rows: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Confirmed rows that are missing come back from their snapshot."""
    return rows.unionByName(confirmed.select(*rows.columns).join(rows.select("url"), "url", "left_anti"))


def report(events: DataFrame) -> DataFrame:
    """Events by action and corrections by field: ``kind, value, rows, first_place``; for reasons see ``exclusion_reasons``."""
    rows = events.select(
        "place",
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.lit("action").alias("kind"), F.col("action").alias("value")),
                    F.when(F.col("action") == "correct", F.struct(F.lit("field").alias("kind"), F.col("field").alias("value"))),
                )
            )
        ).alias("x"),
    )
    return rows.groupBy("x.kind", "x.value").agg(F.count("*").alias("rows"), F.min("place").alias("first_place"))


def pending(events: DataFrame, processed: DataFrame) -> DataFrame:
    """What a reader sees before events are applied: per notice the last pending verdict and the corrections that will hold."""
    waiting = events.join(processed.select("event_id").distinct(), "event_id", "left_anti")
    last = folded_verdicts(waiting).select("url", "status", "events")
    fields = folded_corrections(waiting).groupBy("url").agg(F.count("*").alias("fields"))
    return last.join(fields, "url", "left").select("url", "status", "events", F.coalesce("fields", F.lit(0)).alias("fields"))
