"""Queries of incremental state, verdicts and linkage. The events table stands for the log of outcomes and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..operators import feedback, linkage, state
from ..runtime import written
from ..tables import table
from .registry import Registry
from .texts import _CLEAN

query = Registry()

_DAY = "date '2024-02-03'"
_STATUS = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'unlinked_change' WHEN 'view' THEN 'ignored' ELSE 'matched' END"


def _status() -> Column:
    e = F.col("event_type")
    return F.when(e == "error", "failed").when(e == "click", "unlinked_change").when(e == "view", "ignored").otherwise("matched")


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", F.col("user_id").alias("key"), "ts", "event_type", _status().alias("status"))


@query(
    f"""WITH e AS (SELECT event_id, user_id AS key, {_STATUS} AS status, ts FROM events), l AS (SELECT event_id, key FROM e WHERE ts >= timestamp '2024-01-15'),
    p AS (SELECT key, arg_max(status, event_id) AS status FROM e WHERE ts < timestamp '2024-01-15' AND status <> 'failed' GROUP BY key),
    f AS (SELECT key FROM e WHERE ts < timestamp '2024-01-15' GROUP BY key HAVING arg_max(status, event_id) = 'failed')
    SELECT l.event_id, l.key, CASE WHEN f.key IS NOT NULL THEN 'retry' WHEN p.status IS NULL THEN 'new' ELSE 'unlinked' END AS reason
    FROM l LEFT JOIN p ON l.key = p.key LEFT JOIN f ON l.key = f.key WHERE f.key IS NOT NULL OR p.status IS NULL OR p.status = 'unlinked_change'"""
)
def admit_batch(spark: SparkSession, folder: str) -> DataFrame:
    e = _log(spark, folder)
    before = e.where("ts < timestamp_ntz'2024-01-15 00:00:00'")
    processed = before.where("status != 'failed'").groupBy("key").agg(F.max_by("status", "event_id").alias("status"))
    failed = before.groupBy("key").agg(F.max_by("status", "event_id").alias("status")).where("status = 'failed'").select("key")
    listing = e.where("ts >= timestamp_ntz'2024-01-15 00:00:00'").select("event_id", "key")
    return state.to_process(listing, processed, failed, ["key"])


@query(
    f"""WITH e AS (SELECT event_id, user_id AS key, {_STATUS} AS status FROM events), s AS (SELECT key, max(event_id) FILTER (WHERE status <> 'failed') AS ok FROM e GROUP BY key)
    SELECT e.key, arg_max(status, event_id) AS status, count(*) FILTER (WHERE status = 'failed' AND (ok IS NULL OR event_id > ok)) AS attempts,
    min(CASE WHEN status = 'failed' AND (ok IS NULL OR event_id > ok) THEN event_id END) AS first_failed_at, max(event_id) AS last_at FROM e JOIN s ON e.key = s.key GROUP BY e.key"""
)
def failure_fold(spark: SparkSession, folder: str) -> DataFrame:
    return state.fold_outcomes(_log(spark, folder).select("event_id", "key", "status"), ["key"], "event_id")


@query(
    f"""SELECT key, strftime(released, '%Y-%m-%d') AS released, strftime(first_failed, '%Y-%m-%d') AS first_failed FROM (
    SELECT user_id AS key, max(CASE WHEN event_type <> 'error' THEN cast(ts AS date) END) AS released, max(CASE WHEN event_type = 'error' THEN cast(ts AS date) END) AS first_failed FROM events GROUP BY user_id)
    WHERE NOT coalesce(released < {_DAY} - INTERVAL 5 DAY, false) AND NOT coalesce(first_failed < {_DAY} - INTERVAL 32 DAY, false)"""
)
def prune_state(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    day = F.to_date("ts")
    rows = e.groupBy(F.col("user_id").alias("key")).agg(F.max(F.when(F.col("event_type") != "error", day)).alias("released"), F.max(F.when(F.col("event_type") == "error", day)).alias("first_failed"))
    out = state.pruned(rows, F.lit("2024-02-03").cast("date"), 5, 32)
    return out.select("key", F.date_format("released", "yyyy-MM-dd").alias("released"), F.date_format("first_failed", "yyyy-MM-dd").alias("first_failed"))


@query(
    """WITH p AS (SELECT canonical_url AS u, min(strftime(collected_at, '%Y-%m-%d')) AS d FROM tenders WHERE batch_no = 0 AND coalesce(canonical_url, '') <> '' GROUP BY canonical_url)
    SELECT t.id, CASE WHEN p.u IS NOT NULL THEN p.d ELSE '2025-01-20' END AS new_on, coalesce(CASE WHEN p.u IS NOT NULL THEN p.d ELSE '2025-01-20' END = '2025-01-20', false) AS is_new
    FROM tenders t LEFT JOIN p ON t.canonical_url = p.u WHERE t.batch_no >= 1"""
)
def new_item_marking(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "tenders").select("id", "batch_no", F.col("canonical_url").alias("u"), F.date_format("collected_at", "yyyy-MM-dd").alias("day"))
    before = t.where("batch_no = 0 and coalesce(u, '') != ''").groupBy("u").agg(F.min("day").alias("new_on"))
    return state.mark_new(t.where("batch_no >= 1").select("id", "u"), before, "u", F.lit("2025-01-20")).select("id", "new_on", "is_new")


@query(
    """SELECT source, count(*) AS listed, count(*) FILTER (WHERE hit OR rn <= 10) AS examined, count(*) FILTER (WHERE NOT (hit OR rn <= 10)) AS left_out FROM (
    SELECT source, hit, row_number() OVER (PARTITION BY source, hit ORDER BY doc_id) AS rn FROM (SELECT source, doc_id, coalesce(contains(text, '设备'), false) AS hit FROM documents)) GROUP BY source"""
)
def quota_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("source", "doc_id", F.contains("text", F.lit("设备")).alias("hit"))
    seen = state.quota(docs, "source", F.col("hit"), [F.asc("doc_id")], 10)
    return seen.groupBy("source").agg(F.count("*").alias("listed"), F.count_if("examined").alias("examined"), F.count_if(~F.col("examined")).alias("left_out"))


@query(
    """SELECT user_id, event_id FROM (SELECT *, max(broken) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS b FROM (
    SELECT user_id, event_id, CASE WHEN event_id - coalesce(lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id), -1) - 1 >= 400 THEN 1 ELSE 0 END AS broken FROM events)) WHERE b = 0 AND event_id > -1"""
)
def id_frontier(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("user_id", "event_id")
    return state.frontier(rows, "user_id", "event_id", F.lit(-1), 400)


@query(
    """SELECT id, cache, count(*) AS n FROM (SELECT t.id, CASE WHEN c.cached_on IS NULL THEN 'missing' WHEN date_diff('day', c.cached_on, date '2025-03-01') < 40 THEN 'fresh' ELSE 'stale' END AS cache
    FROM (SELECT id, url FROM tenders WHERE batch_no >= 5) t LEFT JOIN (SELECT url, max(cast(last_seen_at AS date)) AS cached_on FROM tenders WHERE batch_no < 5 GROUP BY url) c ON t.url = c.url) GROUP BY id, cache"""
)
def detail_cache(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "tenders").select("id", "batch_no", "url", "last_seen_at", "title")
    cache = t.where("batch_no < 5").groupBy("url").agg(F.max(F.to_date("last_seen_at")).alias("cached_on"), F.max("title").alias("detail"))
    out = state.cached(t.where("batch_no >= 5").select("id", "url"), cache, "url", F.lit("2025-03-01").cast("date"), 40)
    return out.groupBy("id", "cache").agg(F.count("*").alias("n"))


# -- verdicts: clicks confirm, errors exclude, purchases correct; the id is the place


_EV = """SELECT event_id, 'u' || user_id AS url, event_id AS place, CASE event_type WHEN 'click' THEN 'confirm' WHEN 'error' THEN 'exclude' ELSE 'correct' END AS action,
    CASE WHEN event_id % 2 = 0 THEN 'buyer' ELSE 'agency' END AS field, cast(event_id AS varchar) AS new_value FROM events WHERE event_type IN ('click', 'error', 'purchase')"""


def _verdict_events(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").where("event_type in ('click', 'error', 'purchase')")
    action = F.when(F.col("event_type") == "click", "confirm").when(F.col("event_type") == "error", "exclude").otherwise("correct")
    return e.select("event_id", F.concat(F.lit("u"), "user_id").alias("url"), F.col("event_id").alias("place"), action.alias("action"), F.when(F.col("event_id") % 2 == 0, "buyer").otherwise("agency").alias("field"), F.col("event_id").cast("string").alias("new_value"))


@query(
    f"""WITH e AS ({_EV}) SELECT url, arg_max(CASE action WHEN 'confirm' THEN 'confirmed' WHEN 'exclude' THEN 'excluded' END, place) FILTER (WHERE action <> 'correct') AS status, max(place) AS last_place, count(*) AS events
    FROM e WHERE event_id >= 100 GROUP BY url"""
)
def verdict_fold(spark: SparkSession, folder: str) -> DataFrame:
    e = _verdict_events(spark, folder)
    return feedback.folded_verdicts(feedback.fresh_events(e, e.where("event_id < 100").select("event_id")))


@query(f"WITH e AS ({_EV}) SELECT url, field, arg_max(new_value, place) AS new_value, count(*) AS times FROM e WHERE action = 'correct' GROUP BY url, field")
def correction_fold(spark: SparkSession, folder: str) -> DataFrame:
    return feedback.folded_corrections(_verdict_events(spark, folder))


@query(
    f"""WITH e AS ({_EV}), b AS (SELECT url, min(action) AS lo, max(action) AS hi FROM e WHERE place >= 9900 AND action <> 'correct' GROUP BY url),
    v AS (SELECT url, arg_max(CASE action WHEN 'confirm' THEN 'confirmed' ELSE 'excluded' END, place) AS st FROM e WHERE place < 9900 AND action <> 'correct' GROUP BY url)
    SELECT url, why FROM (SELECT b.url, CASE WHEN lo <> hi THEN 'both in one batch' WHEN st IS NOT NULL AND st <> CASE lo WHEN 'confirm' THEN 'confirmed' ELSE 'excluded' END THEN 'against the standing verdict' END AS why
    FROM b LEFT JOIN v ON b.url = v.url) WHERE why IS NOT NULL"""
)
def verdict_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    e = _verdict_events(spark, folder)
    standing = feedback.folded_verdicts(e.where("place < 9900 and action != 'correct'"))
    return feedback.conflicts(e.where("place >= 9900"), standing)


@query(
    f"""WITH e AS ({_EV}), v AS (SELECT url, arg_max(CASE action WHEN 'confirm' THEN 'confirmed' ELSE 'excluded' END, place) AS st FROM e WHERE action <> 'correct' AND place < 4000 GROUP BY url),
    c AS (SELECT url, arg_max(new_value, place) FILTER (WHERE field = 'buyer') AS b, arg_max(new_value, place) FILTER (WHERE field = 'agency') AS a FROM e WHERE action = 'correct' GROUP BY url)
    SELECT t.id, coalesce(c.b, t.buyer) AS buyer, coalesce(c.a, t.agency) AS agency, coalesce(v.st, 'review') AS review_status FROM tenders t
    LEFT JOIN v ON v.url = 'u' || (t.id % 300) LEFT JOIN c ON c.url = 'u' || (t.id % 300) WHERE v.st IS NULL OR v.st <> 'excluded'"""
)
def verdict_overlay(spark: SparkSession, folder: str) -> DataFrame:
    e = _verdict_events(spark, folder)
    rows = table(spark, folder, "tenders").select("id", F.concat(F.lit("u"), F.col("id") % 300).alias("url"), "buyer", "agency")
    verdicts = feedback.folded_verdicts(e.where("action != 'correct' and place < 4000"))
    return feedback.apply_verdicts(rows, verdicts, feedback.folded_corrections(e), ["buyer", "agency"]).select("id", "buyer", "agency", "review_status")


# -- linkage: every fiftieth reviewed notice as a plan, all of them as notices


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """Batch codes such as PL-2191 in the content stand for codes, paths of addresses for approval texts, as the table has neither."""
    v = table(spark, folder, "verified_notices")
    code = F.regexp_extract(F.coalesce("project_content", F.lit("")), r"([A-Z]{2}-\d{4})", 1)
    approval = F.regexp_extract(F.coalesce("url", F.lit("")), r"^https?://[^/]+/(.{8,})$", 1)
    return linkage.prepared(v.select(F.col("notice_id").alias("id"), "title", "project_name", "buyer", F.col("project_content").alias("content"), code.alias("code"), approval.alias("approval"), F.date_format("first_seen_at", "yyyy-MM-dd").alias("published_at")))


def _linked(spark: SparkSession, folder: str) -> DataFrame:
    notices = written(_records(spark, folder), "notices")
    plans = written(notices.where("id % 50 = 0"), "plans")
    return linkage.linked(plans, notices, ratios=False).where("plan_id != notice_id")


@query()
def plan_notice_links(spark: SparkSession, folder: str) -> DataFrame:
    """All evidence of notices for plans; the order-sensitive name ratio is beyond SQL."""
    return _linked(spark, folder).select("plan_id", "notice_id", "confidence", "methods", "level")


@query()
def plan_notice_best(spark: SparkSession, folder: str) -> DataFrame:
    return linkage.best_links(_linked(spark, folder)).select("notice_id", "plan_id", "confidence", "level", "rank", "candidates")


@query(
    f"""WITH p AS (SELECT notice_id, {_CLEAN('project_name')} AS n FROM verified_notices), t AS (SELECT notice_id AS id, {_CLEAN('title')} AS n FROM verified_notices)
    SELECT p.notice_id AS plan_id, t.id AS notice_id FROM p JOIN t ON contains(t.n, p.n) AND t.id <> p.notice_id WHERE length(p.n) >= 8"""
)
def plan_notice_containment(spark: SparkSession, folder: str) -> DataFrame:
    """Plan names inside notice titles: both meet in the name's first eight characters, so no pair is tried in vain."""
    v = table(spark, folder, "verified_notices")
    p = v.select(F.col("notice_id").alias("plan_id"), clean_text(F.col("project_name")).alias("p")).where(F.length("p") >= 8)
    t = v.select("notice_id", clean_text(F.col("title")).alias("t"))
    heads = p.withColumn("piece", F.substring("p", 1, 8))
    inside = t.where(F.length("t") >= 8).withColumn("piece", F.explode(linkage.grams(F.col("t"), 8)))
    return heads.join(inside, "piece").where(F.contains("t", "p") & (F.col("plan_id") != F.col("notice_id"))).select("plan_id", "notice_id").distinct()


@query()
def watchlist_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Notices of watched projects; the project of every fiftieth notice is watched."""
    v = table(spark, folder, "verified_notices").select(F.col("notice_id").alias("id"), "project_name", "title")
    watch, notices = v.where("id % 50 = 0").select("project_name"), v
    return linkage.watched(watch, notices)


QUERIES, SQL = query.QUERIES, query.SQL
