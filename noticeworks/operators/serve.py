"""Filters, facets, orders and pages over published notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def full_text(fields: list[str], query: str) -> Column:
    """Is the query, whatever its case, in the non-blank fields taken together?"""
    joined = F.lower(F.concat_ws(" ", *[F.nullif(F.trim(F.col(f)), F.lit("")) for f in fields]))
    return F.lit(True) if not query.strip() else F.contains(joined, F.lit(query.strip().lower()))


def facet_counts(rows: DataFrame, value: Column, name: str, options: DataFrame | None = None) -> DataFrame:
    """Rows per value; arrays count for each of their values. ``options`` adds values without rows."""
    counted = rows.select(value.alias(name)).groupBy(name).agg(F.count("*").alias("rows"))
    if options is not None:
        counted = options.select(name).distinct().join(counted, name, "left").select(name, F.coalesce("rows", F.lit(0)).alias("rows"))
    return counted


def option_list(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.trim(F.coalesce(F.col(column), F.lit(""))) != "").select(column).distinct()


def blanks_last(column: str) -> list[Column]:
    """Order by a text column, blanks at the end."""
    return [F.when(F.coalesce(F.col(column), F.lit("")) == "", 1).otherwise(0).asc(), F.col(column).asc()]


def fixed_order(column: str, values: list[str]) -> Column:
    """Place of a value in a given order; unknown values come last."""
    at = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    return F.when(at == 0, 999).otherwise(at)


def page(rows: DataFrame, order: list[Column], number: int = 1, size: int = 50) -> DataFrame:
    """One page of a result. Only the rows up to the page are kept while sorting."""
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def newest_first(date: str, key: str) -> list[Column]:
    return [F.col(date).desc_nulls_last(), F.col(key).desc()]


def plan_filter(*, prefecture: str = "", district: str = "", month: str = "", fund: Column | None = None, query: str = "", fields: list[str] | None = None) -> Column:
    """A reader's filters over the latest versions of plans; an empty choice lets all pass. ``month``: how planned_bid_time begins."""
    tests = [F.lit(True) if fund is None else fund, full_text(fields or [], query)]
    tests += [F.col("prefecture") == prefecture] if prefecture else []
    tests += [F.col("district") == district] if district else []
    tests += [F.startswith(F.coalesce("planned_bid_time", F.lit("")), F.lit(month))] if month else []
    out = tests[0]
    for t in tests[1:]:
        out = out & F.coalesce(t, F.lit(False))
    return out


def kept_items(rows: DataFrame, kept: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows a reader keeps, and the kept keys that are still there; keys no longer present are forgotten."""
    keys = kept.select(key).distinct()
    return rows.join(keys, key, "left_semi"), keys.join(rows.select(key), key, "left_semi")


def digest_notes(rows: DataFrame, day: str, selected: Column, today: Column) -> DataFrame:
    """One row: ``date, total, message, warning`` of a day's digest; the warning counts rows collected after ``today``."""
    d = F.col(day)
    out = rows.agg(F.count_if(d == selected).alias("total"), F.count_if(d > today).alias("future"))
    date = F.date_format(selected, "yyyy-MM-dd")
    return out.select(date.alias("date"), "total", F.concat_ws(" ", date, F.col("total").cast("string")).alias("message"), F.when(F.col("future") > 0, F.concat(F.col("future").cast("string"), F.lit(" later than today"))).alias("warning"))


def run_documents(datasets: dict[str, DataFrame], key: str, warnings: DataFrame, paths: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is published about a run: the manifest (dataset, path, rows, keys), the status (rows, warnings, healthy) and the sources
    (dataset, source_name) that each dataset has."""
    counted, sources = None, None
    for name, rows in datasets.items():
        part = rows.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys")).select(F.lit(name).alias("dataset"), F.lit(paths.get(name, "")).alias("path"), "rows", "keys")
        counted = part if counted is None else counted.unionByName(part)
        if "source_name" in rows.columns:
            some = rows.where(F.trim("source_name") != "").select(F.lit(name).alias("dataset"), F.trim("source_name").alias("source_name")).distinct()
            sources = some if sources is None else sources.unionByName(some)
    said = warnings.agg(F.count("*").alias("warnings"))
    status = counted.agg(F.sum("rows").alias("rows")).crossJoin(said).withColumn("healthy", F.col("warnings") == 0)  # one row each
    return counted, status, sources
