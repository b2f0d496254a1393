"""Notices of one project as versions, what is new among them, and what later notices are attached to them.

Defined results: rows without a name are projects of their own (by their id); null dates are the oldest; an empty table
gives an empty result. A project of any number of versions is aggregated with partial results, never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_key(name: Column, key: Column) -> Column:
    return F.when(F.coalesce(name, F.lit("")) != "", name).otherwise(F.concat(F.lit("notice:"), key.cast("string")))


def versions(rows: DataFrame, project: Column, key: str, date: str) -> DataFrame:
    """``rows`` with ``project``, ``latest_key``, ``versions`` and ``is_latest``: the newest version, of equally new ones the largest
    key; the others are its history.
    """
    named = rows.withColumn("project", project)
    newest = named.groupBy("project").agg(F.max(F.struct(F.coalesce(F.col(date).cast("string"), F.lit("")).alias("d"), F.col(key).alias("k"))).alias("x"), F.count("*").alias("versions"))
    out = named.join(newest.select("project", F.col("x.k").alias("latest_key"), "versions"), "project")
    return out.withColumn("is_latest", F.col(key) == F.col("latest_key"))


def new_today(rows: DataFrame, is_new: Column) -> DataFrame:
    """One row: new versions, and projects with a new version. ``rows`` as from ``versions``."""
    return rows.agg(F.count_if(is_new).alias("new_notices"), F.count_distinct(F.when(is_new, F.col("project"))).alias("new_projects"))


def attached(rows: DataFrame, links: DataFrame, key: str, other: str) -> DataFrame:
    """``project, other`` of all notices linked to any version, each once. ``links``: key, other (all candidates of a notice)."""
    return rows.select("project", key).join(links.select(key, other).distinct(), key).select("project", other).distinct()


def linked_first(linked: Column, date: Column) -> list[Column]:
    """Projects with attached notices first, then the newest."""
    return [F.coalesce(linked > 0, F.lit(False)).desc(), date.desc_nulls_last()]


def most_first(count: Column, name: Column, collation: str = "zh") -> list[Column]:
    """By count, then by name as a reader of the language sorts it."""
    return [count.desc(), F.collate(name, collation).asc()]
