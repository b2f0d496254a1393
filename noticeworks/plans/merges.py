"""Queries of merges, versions, joins, aggregates, orders and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, urls
from ..operators import merge, serve
from ..runtime import small
from ..tables import table
from .registry import Registry
from .texts import _CLEAN, _TITLE, _URL

query = Registry()


@query("""SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def last_wins(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return merge.last_wins(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def first_wins(spark: SparkSession, folder: str) -> DataFrame:
    return merge.first_wins(table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]).drop("ts")


_OLD = "SELECT id, location, buyer, agency FROM tenders WHERE id % 3 <> 0"
_NEW = "SELECT id, CASE WHEN id % 2 = 0 THEN '' ELSE location END AS location, upper(buyer) AS buyer, agency FROM tenders WHERE id % 3 <> 1"


def _old_new(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    t = table(spark, folder, "tenders").select("id", "location", "buyer", "agency")
    old = t.where("id % 3 != 0")
    new = t.where("id % 3 != 1").withColumns({"location": F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.col("location")), "buyer": F.upper("buyer")})
    return old, new


@query(f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT id, location, buyer, agency FROM n UNION ALL SELECT id, location, buyer, agency FROM o WHERE id NOT IN (SELECT id FROM n)")
def union_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    return merge.union_last_wins(*_old_new(spark, folder), ["id"])


@query(
    f"""WITH o AS ({_OLD}), n AS ({_NEW}) SELECT coalesce(n.id, o.id) AS id, {', '.join(f"CASE WHEN trim(n.{c}) <> '' THEN n.{c} ELSE o.{c} END AS {c}" for c in ('location', 'buyer', 'agency'))}
    FROM o FULL JOIN n ON o.id = n.id"""
)
def field_merge(spark: SparkSession, folder: str) -> DataFrame:
    return merge.field_merge(*_old_new(spark, folder), "id", ["location", "buyer", "agency"])


@query(
    f"""WITH o AS ({_OLD}), n AS ({_NEW}) SELECT coalesce(n.id, o.id) AS id, {', '.join(f"CASE WHEN n.id IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in ('location', 'buyer', 'agency'))}
    FROM o FULL JOIN n ON o.id = n.id"""
)
def curated_overlay(spark: SparkSession, folder: str) -> DataFrame:
    return merge.overlay(*_old_new(spark, folder), "id", ["location", "buyer", "agency"])


@query(
    f"""WITH t AS (SELECT id, url, {_URL} AS canon, buyer, agency FROM tenders WHERE coalesce(url, '') <> ''),
    s AS (SELECT * FROM t WHERE id % 2 = 0), r AS (SELECT id, url, canon, CAST('' AS varchar) AS buyer, agency FROM t WHERE id % 2 = 1),
    e AS (SELECT url, arg_max(buyer, id) AS b, arg_max(coalesce(agency, '-'), id) AS a FROM (SELECT url, id, coalesce(buyer, '') AS buyer, coalesce(agency, '') AS agency FROM s) GROUP BY url),
    l AS (SELECT canon, arg_max(buyer, id) AS b, arg_max(agency, id) AS a FROM (SELECT canon, id, coalesce(buyer, '') AS buyer, coalesce(agency, '') AS agency FROM s) GROUP BY canon)
    SELECT r.id, coalesce(nullif(trim(e.b), ''), CASE WHEN e.url IS NULL THEN nullif(trim(l.b), '') END) IS NOT NULL AS filled,
      coalesce(CASE WHEN trim(e.b) <> '' THEN e.b END, CASE WHEN e.url IS NULL AND trim(l.b) <> '' THEN l.b END, r.buyer) AS buyer
    FROM r LEFT JOIN e ON r.url = e.url LEFT JOIN l ON e.url IS NULL AND NOT contains(r.url, '#') AND r.canon = l.canon"""
)
def party_hydration(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "tenders").where("coalesce(url, '') != ''").select("id", "url", urls.canonical_url(F.col("url")).alias("canon"), "buyer", "agency")
    rows = t.where("id % 2 = 1").withColumn("buyer", F.lit(""))
    out = merge.hydrate(rows, t.where("id % 2 = 0"), "url", "canon", ["buyer"], ["id"], ~F.contains("url", F.lit("#")))
    return out.select("id", (F.trim("buyer") != "").alias("filled"), "buyer")


@query(
    """SELECT key, min(first_title) AS title, max(last_seen) AS last_seen, count(*) AS n FROM (SELECT fingerprint AS key, first_value(title) OVER (PARTITION BY fingerprint ORDER BY o, id) AS first_title,
    strftime(first_value(last_seen_at) OVER (PARTITION BY fingerprint ORDER BY o DESC, id DESC), '%Y-%m-%d %H:%M:%S') AS last_seen
    FROM (SELECT *, CASE WHEN batch_no = 0 THEN 0 ELSE 1 END AS o FROM tenders WHERE coalesce(fingerprint, '') <> '')) GROUP BY key"""
)
def upsert_tenders(spark: SparkSession, folder: str) -> DataFrame:
    """First values are kept, only ``last_seen_at`` takes the last one."""
    t = table(spark, folder, "tenders").where("coalesce(fingerprint, '') != ''").select(F.col("fingerprint").alias("key"), "id", "title", "last_seen_at", "batch_no", F.lit(1).alias("n"))
    done = merge.upsert(t.where("batch_no = 0").drop("batch_no", "n"), t.where("batch_no != 0").drop("batch_no", "n"), "key", "id", ["last_seen_at"])
    counts = t.groupBy("key").agg(F.count("*").alias("n"))
    return done.join(counts, "key").select("key", "title", F.date_format("last_seen_at", "yyyy-MM-dd HH:mm:ss").alias("last_seen"), "n")


@query(f"""SELECT k AS title_key, id, buyer FROM (SELECT {_TITLE('title')} AS k, id, buyer, row_number() OVER (PARTITION BY {_TITLE('title')} ORDER BY {' + '.join(f"CASE WHEN trim(coalesce({c}, '')) <> '' THEN 1 ELSE 0 END" for c in ('budget', 'bid_deadline', 'buyer', 'agency'))} DESC, id) AS rn FROM tenders) WHERE rn = 1""")
def best_record(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "tenders").select("id", "title", "budget", "bid_deadline", "buyer", "agency")
    best = merge.best_record(rows, text.normalized_title(F.col("title")), ["budget", "bid_deadline", "buyer", "agency"], ["id"])
    return best.select(text.normalized_title(F.col("title")).alias("title_key"), "id", "buyer")


@query(f"""SELECT project_key, notice_id, versions FROM (SELECT {_CLEAN('project_name')} AS project_key, notice_id, count(*) OVER (PARTITION BY {_CLEAN('project_name')}) AS versions, row_number() OVER (PARTITION BY {_CLEAN('project_name')} ORDER BY first_seen_at DESC, notice_id DESC) AS rn FROM verified_notices WHERE {_CLEAN('project_name')} <> '') WHERE rn = 1""")
def latest_version(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "verified_notices").select("notice_id", "project_name", "first_seen_at").where(text.clean_text(F.col("project_name")) != "")
    return merge.latest_version(rows, text.clean_text(F.col("project_name")), ["first_seen_at", "notice_id"]).select("project_key", "notice_id", "versions")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey) AS best FROM orders) WHERE o_totalprice >= best - 10000.0")
def within_best(spark: SparkSession, folder: str) -> DataFrame:
    return merge.within_best(table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice", 10_000.0)


@query("SELECT source, doc_id, rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY fetched_at DESC, doc_id DESC) AS rank FROM documents) WHERE rank <= 5")
def newest_per_source(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("source", "doc_id", "fetched_at")
    return merge.ranked(rows, ["source"], [F.desc("fetched_at"), F.desc("doc_id")]).where("rank <= 5").drop("fetched_at")


@query("SELECT t.id, t.title FROM tenders t WHERE t.batch_no > 0 AND NOT EXISTS (SELECT 1 FROM tenders h WHERE h.batch_no = 0 AND h.url IS NOT DISTINCT FROM t.url)")
def unseen_rows(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "tenders").select("id", "batch_no", "url", "title")
    return merge.unseen(t.where("batch_no > 0"), t.where("batch_no = 0").select("url"), ["url"]).select("id", "title")


@query("SELECT id, title FROM tenders WHERE title IS NULL OR trim(title) NOT IN (SELECT trim(title) FROM verified_notices WHERE title IS NOT NULL AND review_status = 'confirmed')")
def excluded_titles(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "tenders").select("id", "title")
    out = table(spark, folder, "verified_notices").where("review_status = 'confirmed' and title is not null").select(F.trim("title").alias("_t")).distinct()
    return t.join(out, F.trim("title") == F.col("_t"), "left_anti")


@query(
    """WITH o AS (SELECT user_id, max(event_id) AS origin FROM events WHERE event_type = 'signup' GROUP BY user_id), c AS (SELECT event_id, user_id FROM events WHERE event_type = 'error')
    SELECT c.event_id, o.origin, o.origin IS NOT NULL AS linked FROM c LEFT JOIN o ON c.user_id = o.user_id"""
)
def change_link(spark: SparkSession, folder: str) -> DataFrame:
    """Changes with the notice they mean; what leads nowhere waits unlinked."""
    e = table(spark, folder, "events").select("event_id", F.col("user_id").cast("string").alias("code"), "event_type")
    projects = e.where("event_type = 'signup'").groupBy("code").agg(F.max("event_id").alias("url"))
    hit, miss = merge.linked_changes(e.where("event_type = 'error'").select("event_id", "code"), projects, "code")
    return hit.select("event_id", F.col("target_url").alias("origin"), F.lit(True).alias("linked")).unionByName(miss.select("event_id", F.lit(None).cast("bigint").alias("origin"), F.lit(False).alias("linked")))


@query(
    """WITH c AS (SELECT o_custkey AS k, o_orderkey AS ord, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS segment, o_orderpriority AS name FROM orders WHERE o_orderkey % 2 = 0)
    SELECT c_custkey AS k, coalesce((SELECT arg_max(segment, ord) FROM c WHERE c.k = c_custkey AND segment <> ''), c_mktsegment) AS segment,
      coalesce((SELECT arg_max(name, ord) FROM c WHERE c.k = c_custkey AND name <> ''), c_name) AS name, (SELECT max(ord) FROM c WHERE c.k = c_custkey) AS last_change FROM customer"""
)
def change_apply(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").where("o_orderkey % 2 = 0")
    changes = o.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderstatus")).alias("segment"), F.col("o_orderpriority").alias("name"))
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    return merge.apply_changes(rows, changes, "k", ["segment", "name"], "ord")


@query("SELECT DISTINCT buyer, agency FROM tenders t WHERE batch_no >= 1 AND NOT EXISTS (SELECT 1 FROM tenders h WHERE h.batch_no = 0 AND h.buyer = t.buyer AND h.agency = t.agency)")
def insert_missing(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "tenders").select("batch_no", "buyer", "agency")
    return merge.insert_missing(t.where("batch_no = 0").drop("batch_no"), t.where("batch_no >= 1").drop("batch_no"), ["buyer", "agency"])


@query(
    """SELECT d.doc_id, coalesce(nullif(trim(d.notice_type), ''), a.notice_type, b.notice_type) AS notice_type FROM documents d
    LEFT JOIN (SELECT org_id, min(notice_type) AS notice_type FROM documents WHERE trim(notice_type) <> '' GROUP BY org_id) a ON d.org_id = a.org_id
    LEFT JOIN (SELECT source, min(notice_type) AS notice_type FROM documents WHERE trim(notice_type) <> '' GROUP BY source) b ON d.source = b.source"""
)
def match_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    """Blank fields filled by one key, else by another; the lookups are aggregated before they are joined."""
    d = table(spark, folder, "documents").select("doc_id", "org_id", "source", "notice_type")
    known = d.where("trim(notice_type) != ''")
    a = known.groupBy("org_id").agg(F.min("notice_type").alias("_a"))
    b = known.groupBy("source").agg(F.min("notice_type").alias("_b"))
    out = d.join(a, "org_id", "left").join(b, "source", "left")
    return out.select("doc_id", F.coalesce(merge.filled(F.trim("notice_type")), "_a", "_b").alias("notice_type"))


@query(
    """WITH w AS (SELECT url, buyer, batch_no AS o FROM tenders WHERE batch_no = 0), p AS (SELECT url, buyer, batch_no AS o FROM tenders WHERE batch_no >= 1)
    SELECT url, buyer, o AS came FROM w UNION ALL SELECT url, buyer, o FROM p WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.url IS NOT DISTINCT FROM p.url AND w.buyer IS NOT DISTINCT FROM p.buyer)"""
)
def match_union(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "tenders").select("url", "buyer", F.col("batch_no").alias("came"))
    w = t.where("came = 0")
    return w.unionByName(merge.unseen(t.where("came >= 1"), w, ["url", "buyer"]))


# -- aggregates


@query(
    """SELECT batch_no, count(*) AS "rows", count(*) FILTER (WHERE region_status = 'included') AS included, count(*) FILTER (WHERE len(matched_keywords) > 0) AS matched,
    count(DISTINCT buyer) AS buyers, cast(sum(len(matched_keywords)) AS bigint) AS keywords, strftime(min(collected_at), '%Y-%m-%d') AS first_day FROM tenders GROUP BY batch_no"""
)
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "tenders").groupBy("batch_no").agg(
        F.count("*").alias("rows"), F.count_if(F.col("region_status") == "included").alias("included"), F.count_if(F.size("matched_keywords") > 0).alias("matched"),
        F.countDistinct("buyer").alias("buyers"), F.sum(F.size("matched_keywords")).alias("keywords"), F.date_format(F.min("collected_at"), "yyyy-MM-dd").alias("first_day"),
    )


@query("SELECT keyword, count(*) AS \"rows\", min(id) AS first_id FROM (SELECT id, unnest(matched_keywords) AS keyword FROM tenders) GROUP BY keyword")
def keyword_frequency(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "tenders").select("id", F.explode("matched_keywords").alias("keyword"))
    return rows.groupBy("keyword").agg(F.count("*").alias("rows"), F.min("id").alias("first_id"))


@query("""SELECT s.source_name, count(d.doc_id) AS "rows" FROM source_names s LEFT JOIN documents d ON d.source = s.source_name AND length(d.text) > 500 GROUP BY s.source_name""")
def source_facet(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per source, zero for sources without rows; rows are counted before they meet the options."""
    docs = table(spark, folder, "documents").where(F.length("text") > 500)
    options = table(spark, folder, "source_names").select("source_name")
    return serve.facet_counts(docs, F.col("source"), "source_name", options)


@query("SELECT DISTINCT location FROM tenders WHERE trim(coalesce(location, '')) <> ''")
def location_options(spark: SparkSession, folder: str) -> DataFrame:
    return serve.option_list(table(spark, folder, "tenders"), "location")


@query("SELECT source_name, max(substr(cast(first_seen_at AS varchar), 1, 10)) AS last_day FROM verified_notices WHERE cast(first_seen_at AS date) <= date '2025-09-30' GROUP BY source_name")
def last_day_known(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "verified_notices").where(F.to_date("first_seen_at") <= F.lit("2025-09-30").cast("date"))
    return rows.groupBy("source_name").agg(F.max(F.date_format("first_seen_at", "yyyy-MM-dd")).alias("last_day"))


@query(
    f"""SELECT source, count(*) AS listed, cast(ceil(count(*) / 100.0) AS bigint) AS pages, count(*) FILTER (WHERE {_CLEAN('text')} = '') AS blank, strftime(min(fetched_at), '%Y-%m-%d') AS since,
    CASE WHEN count(*) FILTER (WHERE {_CLEAN('text')} = '') = 0 THEN 'ok' ELSE 'warnings' END AS health FROM documents GROUP BY source"""
)
def scan_report(spark: SparkSession, folder: str) -> DataFrame:
    blank = F.count_if(text.blank(F.col("text")))
    return table(spark, folder, "documents").groupBy("source").agg(
        F.count("*").alias("listed"), F.ceil(F.count("*") / 100).alias("pages"), blank.alias("blank"), F.date_format(F.min("fetched_at"), "yyyy-MM-dd").alias("since"),
        F.when(blank == 0, "ok").otherwise("warnings").alias("health"),
    )


# -- orders, pages, reports


@query(
    """SELECT id, title, bid_deadline FROM tenders WHERE region_status = 'included' AND len(matched_keywords) > 0 AND cast(collected_at AS date) <= date '2025-02-28'
    ORDER BY CASE WHEN coalesce(bid_deadline, '') = '' THEN 1 ELSE 0 END, bid_deadline, id LIMIT 200"""
)
def digest(spark: SparkSession, folder: str) -> DataFrame:
    """The daily list: a top-k report, kept small while sorting."""
    rows = table(spark, folder, "tenders").where("region_status = 'included' and size(matched_keywords) > 0").where(F.to_date("collected_at") <= F.lit("2025-02-28").cast("date"))
    return serve.page(rows, [*serve.blanks_last("bid_deadline"), F.asc("id")], 1, 200).select("id", "title", "bid_deadline")


@query(
    """SELECT id, strftime(collected_at, '%Y-%m-%d') AS published_at, title, url, coalesce(nullif(buyer, ''), '公告未载明') AS buyer FROM tenders WHERE region_status = 'included'
    ORDER BY strftime(collected_at, '%Y-%m-%d') DESC, id DESC LIMIT 500"""
)
def snapshot_export(spark: SparkSession, folder: str) -> DataFrame:
    """The public snapshot: contact and phone are never selected, missing parties get a placeholder."""
    rows = table(spark, folder, "tenders").where("region_status = 'included'")
    out = rows.select("id", F.date_format("collected_at", "yyyy-MM-dd").alias("published_at"), "title", "url", F.coalesce(F.nullif("buyer", F.lit("")), F.lit("公告未载明")).alias("buyer"))
    return serve.page(out, [F.desc("published_at"), F.desc("id")], 1, 500)


@query(
    """SELECT id, title, strftime(collected_at, '%Y-%m-%d') AS day FROM tenders WHERE contains(lower(concat_ws(' ', nullif(trim(title), ''), nullif(trim(buyer), ''), nullif(trim(summary), ''))), '设备')
    AND cast(collected_at AS date) >= date '2024-06-01' AND location IS NOT NULL ORDER BY collected_at DESC, id DESC LIMIT 50 OFFSET 50"""
)
def search_page(spark: SparkSession, folder: str) -> DataFrame:
    """Second page of a full-text search with filters, newest first."""
    rows = table(spark, folder, "tenders").where(serve.full_text(["title", "buyer", "summary"], "设备")).where(F.to_date("collected_at") >= F.lit("2024-06-01").cast("date")).where("location is not null")
    return serve.page(rows, serve.newest_first("collected_at", "id"), 2).select("id", "title", F.date_format("collected_at", "yyyy-MM-dd").alias("day"))


@query(
    """SELECT tag, count(*) AS "rows", coalesce(list_position(['included', 'review', 'excluded'], tag), 999) AS place FROM (SELECT coalesce(region_status, '') AS tag FROM tenders) GROUP BY tag"""
)
def ordered_facet(spark: SparkSession, folder: str) -> DataFrame:
    counted = serve.facet_counts(table(spark, folder, "tenders"), F.coalesce("region_status", F.lit("")), "tag")
    return counted.select("tag", "rows", serve.fixed_order("tag", ["included", "review", "excluded"]).cast("bigint").alias("place"))


@query("SELECT l_returnflag, l_linestatus, cast(sum(cast(l_quantity AS bigint)) AS bigint) AS quantity, count(*) AS \"rows\" FROM lineitem WHERE l_shipdate <= timestamp '2001-06-30' GROUP BY ALL")
def volume_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A plain aggregation over the largest table, for throughput."""
    rows = table(spark, folder, "lineitem").where("l_shipdate <= timestamp_ntz'2001-06-30 00:00:00'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"), F.count("*").alias("rows"))


@query(
    "SELECT n_name, count(*) AS orders, cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS bigint) AS cents FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"
)
def orders_by_nation(spark: SparkSession, folder: str) -> DataFrame:
    """Rows are added up per customer before the dimensions are joined."""
    per = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    c = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    n = small(table(spark, folder, "nation").select("n_nationkey", "n_name"))
    joined = per.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.sum("orders").alias("orders"), F.sum("cents").alias("cents"))


QUERIES, SQL = query.QUERIES, query.SQL
