"""Keyed merges: who wins, what is kept, which version counts. Order comes from columns that are given, never from arrival.

All of them are hash aggregations with partial results or equi joins; a hot key costs no more than its share, as rows are
combined before the shuffle. Null keys are a key of their own in ``first_wins`` and ``last_wins``; in joins they match nobody.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _whole(df: DataFrame, keys: list[str]) -> Column:
    return F.struct(*[c for c in df.columns if c not in keys])


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key, the last by ``order``."""
    return df.groupBy(*keys).agg(F.max_by(_whole(df, keys), F.struct(*order)).alias("_w")).select(*keys, "_w.*").select(*df.columns)


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.min_by(_whole(df, keys), F.struct(*order)).alias("_w")).select(*keys, "_w.*").select(*df.columns)


def union_last_wins(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace whole rows of ``old``; of several in one table the last by all their columns holds."""
    both = old.withColumn("_from", F.lit(0)).unionByName(new.withColumn("_from", F.lit(1)))
    rest = [c for c in old.columns if c not in keys]
    return last_wins(both, keys, ["_from", *rest]).drop("_from")


def filled(c: Column) -> Column:
    """Null where a text says nothing."""
    return F.when(F.trim(c.cast("string")) != "", c)


def field_merge(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Full outer merge, field by field: a new value wins unless it is null or ''."""
    o, n = old.select(key, *fields).alias("o"), new.select(key, *fields).alias("n")
    joined = o.join(n, key, "full")
    return joined.select(key, *[F.coalesce(filled(F.col(f"n.{f}")), F.col(f"o.{f}")).alias(f) for f in fields])


def overlay(base: DataFrame, curated: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Full outer merge in which every field of a curated row wins, also ''."""
    b, c = base.select(key, *fields).alias("b"), curated.select(key, *fields, F.lit(True).alias("_here")).alias("c")
    joined = b.join(c, key, "full")
    return joined.select(key, *[F.when(F.col("_here"), F.col(f"c.{f}")).otherwise(F.col(f"b.{f}")).alias(f) for f in fields])


def hydrate(rows: DataFrame, source: DataFrame, exact: str, loose: str, fields: list[str], order: list[str], loose_ok: Column | None = None) -> DataFrame:
    """Fills ``fields`` from ``source`` by an exact key, else by a loose one (only where ``loose_ok``); non-empty values win."""
    by_exact = last_wins(source.select(exact, *fields, *order).dropDuplicates(), [exact], order).select(F.col(exact).alias("_e"), *[F.col(f).alias(f"_e_{f}") for f in fields])
    by_loose = last_wins(source.select(loose, *fields, *order).dropDuplicates(), [loose], order).select(F.col(loose).alias("_l"), *[F.col(f).alias(f"_l_{f}") for f in fields])
    ok = loose_ok if loose_ok is not None else F.lit(True)
    out = rows.join(by_exact, F.col(exact) == F.col("_e"), "left").join(by_loose, F.col("_e").isNull() & ok & (F.col(loose) == F.col("_l")), "left")
    return out.select(*[F.coalesce(filled(F.col(f"_e_{c}")), filled(F.col(f"_l_{c}")), F.col(c)).alias(c) if c in fields else F.col(c) for c in rows.columns])


def upsert(existing: DataFrame, new: DataFrame, key: str, order: str, refreshed: list[str]) -> DataFrame:
    """New keys are added as first seen; of known keys only the ``refreshed`` columns take their last value."""
    both = existing.withColumn("_o", F.struct(F.lit(0), order)).unionByName(new.withColumn("_o", F.struct(F.lit(1), order)))
    keep = [c for c in existing.columns if c != key and c not in refreshed]
    first = [F.min_by(c, "_o").alias(c) for c in keep]
    last = [F.max_by(c, "_o").alias(c) for c in refreshed]
    return both.groupBy(key).agg(*first, *last).select(*existing.columns)


def insert_missing(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new`` whose key is not there yet, each key once (the least row of equals)."""
    rest = [c for c in new.columns if c not in keys]
    return first_wins(new, keys, rest or keys).join(existing.select(*keys), keys, "left_anti")


def best_record(df: DataFrame, key: Column, scored: list[str], order: list[str]) -> DataFrame:
    """Per key the row with most non-empty ``scored`` columns, of equals the first by ``order``."""
    score = sum((F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "", 1).otherwise(0) for c in scored[1:]), F.when(F.trim(F.coalesce(F.col(scored[0]).cast("string"), F.lit(""))) != "", 1).otherwise(0))
    keyed = df.withColumns({"_k": key, "_n": -score})
    return keyed.groupBy("_k").agg(F.min_by(F.struct(*df.columns), F.struct("_n", *order)).alias("_w")).select("_w.*")


def latest_version(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """Per project the last version and how many there are (``versions``)."""
    keyed = df.withColumn("project_key", key)
    return keyed.groupBy("project_key").agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_w"), F.count("*").alias("versions")).select("project_key", "_w.*", "versions")


def within_best(df: DataFrame, group: list[str], score: str, margin: float) -> DataFrame:
    """The rows whose score is within ``margin`` of the best of their group."""
    best = df.groupBy(*group).agg(F.max(score).alias("_best"))
    return df.join(best, group).where(F.col(score) >= F.col("_best") - margin).drop("_best")


def ranked(df: DataFrame, group: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Place of each row in its group. For a limit per group; a filter on ``name`` is pushed into the window by the optimizer."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint"))


def unseen(rows: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among the seen ones; null keys count as equal."""
    s = seen.select(*[F.col(k).alias(f"_s_{k}") for k in keys]).distinct()
    on = [rows[k].eqNullSafe(s[f"_s_{k}"]) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return rows.join(s, cond, "left_anti")


def linked_changes(changes: DataFrame, projects: DataFrame, code: str) -> tuple[DataFrame, DataFrame]:
    """Changes with the notice their project code leads to, and those that lead nowhere yet."""
    known = projects.select(code, F.col("url").alias("target_url")).where(F.col(code).isNotNull() & (F.col(code) != ""))
    return changes.join(known, code), changes.join(known, code, "left_anti")


def apply_changes(rows: DataFrame, changes: DataFrame, key: str, fields: list[str], order: str) -> DataFrame:
    """Per field the last non-empty value of all changes of a key; adds ``last_change``. Changes of unknown keys are ignored."""
    last = [F.max_by(F.col(f), F.when(filled(F.col(f)).isNotNull(), F.col(order))).alias(f"_c_{f}") for f in fields]
    patch = changes.groupBy(key).agg(*last, F.max(order).alias("last_change"))
    out = rows.join(patch, key, "left")
    return out.select(*[F.coalesce(filled(F.col(f"_c_{c}")), F.col(c)).alias(c) if c in fields else F.col(c) for c in rows.columns], "last_change")


def refreshed(old: DataFrame, new: DataFrame, key: str, day: str, as_of: Column, days: int = 7) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` that are at most ``days`` old and add what is not there; older rows stay."""
    o = old.select(key, F.struct(*old.columns).alias("_o"))
    n = new.select(key, F.struct(*old.columns).alias("_n"))
    both = o.join(n, key, "full")
    fixed = F.col(f"_o.{day}") < F.date_sub(as_of, days)
    pick = F.when(F.col("_o").isNull(), F.col("_n")).when(F.col("_n").isNull() | F.coalesce(fixed, F.lit(False)), F.col("_o")).otherwise(F.col("_n"))
    return both.select(pick.alias("w")).select("w.*")
