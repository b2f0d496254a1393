"""Queries of listings, refreshing, reports and cursors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import extract, text
from ..operators import feedback, listing, merge, state
from ..tables import table
from .registry import Registry
from .states import _EV, _verdict_events
from .texts import _CLEAN, _date_sql

query = Registry()


@query(
    r"""SELECT doc_id, cast(i - 1 AS integer) AS ord, trim(regexp_replace(regexp_extract_all(coalesce(text, ''), '规格型号([A-Z]{2}-\d+)，数量(\d+)', 1)[i], '\s+', ' ', 'g')) AS model,
    trim(regexp_extract_all(coalesce(text, ''), '规格型号([A-Z]{2}-\d+)，数量(\d+)', 2)[i]) AS amount
    FROM (SELECT doc_id, text, unnest(range(1, len(regexp_extract_all(coalesce(text, ''), '规格型号([A-Z]{2}-\d+)，数量(\d+)', 1)) + 1)) AS i FROM documents)"""
)
def listed_rows(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return listing.listed_rows(docs, "text", r"规格型号([A-Z]{2}-\d+)，数量(\d+)", ["model", "amount"])


@query(
    """WITH r AS (SELECT doc_id, source, cast(floor((doc_id - 1) / 100) AS bigint) AS page, cast(fetched_at AS date) AS day FROM documents),
    l AS (SELECT source, min(page) AS last FROM r WHERE day < date '2025-06-01' GROUP BY source)
    SELECT r.doc_id, r.source, r.page FROM r LEFT JOIN l ON r.source = l.source WHERE (l.last IS NULL OR r.page <= l.last) AND coalesce(r.day >= date '2025-06-01', true)"""
)
def list_until_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", "source", F.floor((F.col("doc_id") - 1) / 100).alias("page"), F.to_date("fetched_at").alias("day"))
    return listing.until_cutoff(rows, ["source"], "page", "day", F.lit("2025-06-01").cast("date")).select("doc_id", "source", "page")


@query(
    """SELECT notice_id, CASE WHEN contains(coalesce(title, ''), '中标') OR contains(coalesce(title, ''), '询价') THEN 'ignored' WHEN contains(coalesce(title, ''), '磋商') OR contains(coalesce(title, ''), '谈判') THEN 'change'
    WHEN contains(coalesce(title, ''), '公告') THEN 'original' ELSE 'ignored' END AS kind FROM verified_notices"""
)
def notice_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "verified_notices").select("notice_id", listing.notice_kind(F.col("title"), ["磋商", "谈判"], ["公告"], ["中标", "询价"]).alias("kind"))


@query(
    """WITH o AS (SELECT id, cast(collected_at AS date) AS day, buyer FROM tenders WHERE batch_no <= 8), n AS (SELECT id, cast(last_seen_at AS date) AS day, upper(agency) AS buyer FROM tenders WHERE batch_no >= 4)
    SELECT coalesce(o.id, n.id) AS id, strftime(CASE WHEN o.id IS NULL THEN n.day WHEN n.id IS NULL OR coalesce(o.day < date '2025-01-20' - INTERVAL 7 DAY, false) THEN o.day ELSE n.day END, '%Y-%m-%d') AS day,
    CASE WHEN o.id IS NULL THEN n.buyer WHEN n.id IS NULL OR coalesce(o.day < date '2025-01-20' - INTERVAL 7 DAY, false) THEN o.buyer ELSE n.buyer END AS buyer FROM o FULL JOIN n ON o.id = n.id"""
)
def refresh_rule(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "tenders")
    old = t.where("batch_no <= 8").select("id", F.to_date("collected_at").alias("day"), "buyer")
    new = t.where("batch_no >= 4").select("id", F.to_date("last_seen_at").alias("day"), F.upper("agency").alias("buyer"))
    out = merge.refreshed(old, new, "id", "day", F.lit("2025-01-20").cast("date"))
    return out.select("id", F.date_format("day", "yyyy-MM-dd").alias("day"), "buyer")


@query(
    f"""WITH e AS ({_EV}) SELECT kind, value, count(*) AS "rows", min(place) AS first_place FROM (SELECT 'action' AS kind, action AS value, place FROM e
    UNION ALL SELECT 'field', field, place FROM e WHERE action = 'correct') GROUP BY kind, value"""
)
def verdict_report(spark: SparkSession, folder: str) -> DataFrame:
    return feedback.report(_verdict_events(spark, folder))


@query(
    f"""WITH e AS ({_EV}) SELECT v.url, v.status, v.events, coalesce(f.fields, 0) AS fields FROM (SELECT url, arg_max(CASE action WHEN 'confirm' THEN 'confirmed' WHEN 'exclude' THEN 'excluded' END, place) FILTER (WHERE action <> 'correct') AS status, count(*) AS events
    FROM e WHERE event_id >= 5000 GROUP BY url) v LEFT JOIN (SELECT url, count(DISTINCT field) AS fields FROM e WHERE event_id >= 5000 AND action = 'correct' GROUP BY url) f ON v.url = f.url"""
)
def pending_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    e = _verdict_events(spark, folder)
    return feedback.pending(e, e.where("event_id < 5000").select("event_id"))


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn <= 25")
def largest_ids(spark: SparkSession, folder: str) -> DataFrame:
    return state.largest_kept(table(spark, folder, "events").select("user_id", "event_id"), "user_id", "event_id", 25)


@query(
    """WITH r AS (SELECT user_id, ts, event_type <> 'error' AS complete, CASE event_type WHEN 'view' THEN 'weekly' WHEN 'signup' THEN 'monthly' ELSE 'incremental' END AS mode FROM events)
    SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last, strftime(max(CASE WHEN mode IN ('weekly', 'monthly') THEN ts END), '%Y-%m-%d %H:%M:%S') AS weekly,
    strftime(max(CASE WHEN mode = 'monthly' THEN ts END), '%Y-%m-%d %H:%M:%S') AS monthly FROM r WHERE complete GROUP BY user_id"""
)
def cursors_after_runs(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    mode = F.when(F.col("event_type") == "view", "weekly").when(F.col("event_type") == "signup", "monthly").otherwise("incremental")
    runs = e.select("user_id", mode.alias("mode"), F.col("ts").alias("started"), (F.col("event_type") != "error").alias("complete"), "event_id")
    done = runs.where("complete")
    at = lambda m: F.max(F.when(F.col("mode").isin(*m), F.col("started")))
    cursors = done.where("event_id < 4000").groupBy("user_id").agg(F.max("started").alias("last"), at(["weekly", "monthly"]).alias("weekly"), at(["monthly"]).alias("monthly"))
    out = state.advance_cursors(cursors, runs.where("event_id >= 4000"), "user_id")
    return out.select("user_id", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("last", "weekly", "monthly")])


@query(
    f"""SELECT notice_id, {_date_sql('published_at', False)} AS published_at, {_date_sql('bid_deadline', True)} AS bid_deadline, coalesce(nullif(date_basis, ''), 'official') AS date_basis,
    coalesce(nullif(source_name, ''), 'unknown') AS source_name, coalesce(nullif(trim(project_content), ''), summary, '') AS project_content FROM verified_notices"""
)
def public_items(spark: SparkSession, folder: str) -> DataFrame:
    out = listing.public_item(table(spark, folder, "verified_notices"), F.lit("unknown"))
    return out.select("notice_id", "published_at", "bid_deadline", "date_basis", "source_name", "project_content")


@query(
    f"""SELECT p.notice_id AS watched_id, arg_max(t.id, t.id) AS latest_id, count(*) AS versions FROM (SELECT notice_id, {_CLEAN('buyer')} AS k FROM verified_notices WHERE notice_id % 50 = 0) p
    JOIN (SELECT id, {_CLEAN('buyer')} AS k FROM tenders) t ON p.k = t.k WHERE p.k <> '' GROUP BY p.notice_id"""
)
def watch_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The latest row of each watched party; rows are combined per party before they meet the watch list."""
    rows = table(spark, folder, "tenders").select("id", text.clean_text(F.col("buyer")).alias("k")).where("k != ''")
    latest = merge.latest_version(rows, F.col("k"), ["id"]).select(F.col("project_key").alias("k"), F.col("id").alias("latest_id"), "versions")
    watch = table(spark, folder, "verified_notices").where("notice_id % 50 = 0").select(F.col("notice_id").alias("watched_id"), text.clean_text(F.col("buyer")).alias("k"))
    return watch.join(latest, "k").drop("k")


@query(
    """SELECT id, coalesce(p[1], '') AS region, CASE WHEN len(p) >= 2 THEN p[len(p)] ELSE '' END AS district FROM (
    SELECT id, list_filter(regexp_split_to_array(trim(concat_ws(' - ', region_status, location, submission_place)), '[ ]*[-—－/·][ ]*'), lambda x: x <> '') AS p FROM tenders)"""
)
def location_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of a dashed place, written from the columns that say where, as the table has no such text."""
    parts = extract.location_parts(F.concat_ws(" - ", "region_status", "location", "submission_place"))
    return table(spark, folder, "tenders").select("id", parts["region"].alias("region"), parts["district"].alias("district"))


_LABEL, _BLANKS = r"(?:由|向)[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]*[:：]?[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]*", r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(
    f"""WITH d AS (SELECT doc_id, text, regexp_split_to_array(text, '{_LABEL}') AS p, regexp_extract_all(text, '{_LABEL}') AS l FROM documents),
    u AS (SELECT doc_id, text, i, length(p[i]) + length(l[i]) AS n FROM (SELECT doc_id, text, p, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
    r AS (SELECT doc_id, i, substr(text, cast(sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS bigint) + 1, 120) AS rest FROM u),
    n AS (SELECT doc_id, i, trim(regexp_replace(CASE WHEN regexp_matches(rest, '保管|报送|承担|对|在') THEN regexp_extract(rest, '(?s)^(.*?)(?:保管|报送|承担|对|在)', 1) ELSE rest END, '{_BLANKS}', ' ', 'g'), ' ：:，,。；;') AS name FROM r),
    b AS (SELECT doc_id, arg_min(name, i) AS party FROM n WHERE length(name) BETWEEN 2 AND 80 AND NOT regexp_matches(name, '^(?:为|应|须|可)') AND NOT regexp_matches(name, '[。；;？?！!]') GROUP BY doc_id)
    SELECT d.doc_id, coalesce(party, '') AS party FROM documents d LEFT JOIN b ON d.doc_id = b.doc_id"""
)
def party_names(spark: SparkSession, folder: str) -> DataFrame:
    """Who a text names as responsible; every occurrence is tried."""
    who = extract.party(["由", "向"], r"保管|报送|承担|对|在")
    return table(spark, folder, "documents").select("doc_id", who("text").alias("party"))


QUERIES, SQL = query.QUERIES, query.SQL
