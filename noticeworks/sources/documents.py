"""JSON documents, keyword lists and event issues as tables, and the sinks for published documents.

A payload is a document with an envelope (updated_at, coverage, warnings) and items. Missing or broken files give no items
and a warning each, never a failed job, when read tolerantly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import file_system

# The fields of an event, and the comment by which events travel in issues.
EVENT = "array<struct<id:string,action:string,url:string,field:string,old_value:string,new_value:string,reason:string,created_at:string,item:map<string,string>>>"
_MARK = r"(?s)<!--\s*TENDER_FEEDBACK_JSON\s*(.*?)\s*-->"


def payloads(spark: SparkSession, path: str, item: T.StructType, tolerant: bool = True) -> tuple[DataFrame, DataFrame]:
    """Items (with ``file`` and their place ``ord``) and warnings of all documents below ``path``. Strict reading fails instead."""
    schema = T.StructType([T.StructField("updated_at", T.StringType()), T.StructField("coverage", T.StringType()), T.StructField("warnings", T.ArrayType(T.StringType())), T.StructField("items", T.ArrayType(item)), T.StructField("_broken", T.StringType())])
    options = {"mode": "PERMISSIVE" if tolerant else "FAILFAST", "columnNameOfCorruptRecord": "_broken"}
    try:
        files = spark.read.text(path, wholetext=True)
        docs = files.select(F.from_json("value", schema, options).alias("d"), F.input_file_name().alias("file")).select("file", "d.*")
    except Exception as error:
        if not tolerant or "PATH_NOT_FOUND" not in str(error):
            raise
        empty = spark.createDataFrame([], T.StructType([T.StructField("file", T.StringType()), T.StructField("ord", T.IntegerType()), *item.fields]))
        return empty, spark.createDataFrame([(path, "missing")], "file string, warning string")
    items = docs.where("_broken is null").select("file", F.posexplode("items").alias("ord", "x")).select("file", "ord", "x.*")
    bad = docs.where("_broken is not null").select("file", F.lit("not readable").alias("warning"))
    said = docs.where("_broken is null").select("file", F.explode("warnings").alias("warning"))
    return items, bad.unionByName(said)


def resolved(spark: SparkSession, path: str, folders: list[str]) -> str:
    """Where a document given by path or name lies: as it is if it exists, else below the first of ``folders`` that holds it."""
    for candidate in (path, *(f"{f.rstrip('/')}/{path.lstrip('/')}" for f in folders)):
        fs, at = file_system(spark, candidate)
        if fs.exists(at):
            return candidate
    raise FileNotFoundError(path)


def watched_projects(spark: SparkSession, path: str) -> DataFrame:
    """``project_name`` of a watch list (``{"projects": [...]}`` of names or of objects with a project_name); an error where
    ``projects`` is no list."""
    docs = spark.read.text(path, wholetext=True).select(F.get_json_object("value", "$.projects").alias("p"))
    listed = F.when(F.coalesce(F.trim("p").startswith("["), F.lit(False)), F.from_json("p", "array<string>")).otherwise(F.raise_error(F.lit("projects must be a list")).cast("array<string>"))
    names = docs.select(F.explode(listed).alias("x"))
    return names.select(F.coalesce(F.get_json_object("x", "$.project_name"), "x").alias("project_name")).where("trim(project_name) != ''")


def keywords(spark: SparkSession, path: str) -> DataFrame:
    """The words of a list separated by lines and commas of any width, trimmed, blanks dropped, in order."""
    text = spark.read.text(path, wholetext=True)
    words = F.filter(F.transform(F.split("value", "[\\n,，、]"), lambda w: F.trim(w)), lambda w: w != "")
    return text.select(F.posexplode(words).alias("ord", "keyword"))


def issue_events(issues: DataFrame, body: str = "body") -> DataFrame:
    """The verdict events written into the hidden comment of issues; ``place`` is their order. Issues without a comment give none."""
    events = F.from_json(F.get_json_object(F.regexp_extract(body, _MARK, 1), "$.events"), EVENT)
    return issues.select("*", F.posexplode(events).alias("place", "e")).select(*[c for c in issues.columns if c != body], "place", "e.*")


def issue_body(events: DataFrame, group: str) -> DataFrame:
    """The inverse of ``issue_events``: one body per ``group`` with its events in order of ``place``."""
    fields = [c for c in events.columns if c not in (group, "place")]
    packed = events.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("place", *fields))).alias("e"))
    plain = F.transform("e", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return packed.select(group, F.concat(F.lit("<!-- TENDER_FEEDBACK_JSON "), F.to_json(F.struct(plain.alias("events"))), F.lit(" -->")).alias("body"))


PRIVATE = ("contact", "phone", "password", "username", "login_identity")


def public(rows: DataFrame) -> DataFrame:
    """Rows without the columns that never leave the house."""
    return rows.drop(*PRIVATE)


def replace_table(rows: DataFrame, path: str) -> None:
    """Writes ``rows`` beside ``path`` and puts them in its place by two renames.

    The old copy is removed only when the new one is in place; if that fails, the old one is moved back and an error raised.
    Between the renames, for a moment, there is no table at ``path``: readers that must never meet this should retry.
    """
    spark = rows.sparkSession
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    public(rows).write.mode("overwrite").json(staged)
    fs, here = file_system(spark, path)
    new, old = file_system(spark, staged)[1], file_system(spark, f"{staged}.old")[1]
    held = fs.exists(here)
    if held and not fs.rename(here, old):
        fs.delete(new, True)
        raise OSError(f"{path} could not be moved away; it is as it was")
    if not fs.rename(new, here):
        if held and not fs.rename(old, here):
            raise OSError(f"{path} could not be replaced; its old state is at {old}, the new one at {staged}")
        raise OSError(f"{path} could not be replaced; it is as it was")
    if held:
        fs.delete(old, True)
