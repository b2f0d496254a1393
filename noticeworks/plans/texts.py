"""Queries of text, date and amount functions, extraction and labels."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import amounts, classify, extract, temporal, text, urls
from ..tables import table
from .registry import Registry

query = Registry()

_W = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_CLEAN = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '{_W}+', ' ', 'g'))"
_PUNCT = "".join(text.TITLE_PUNCTUATION).replace("'", "''")
_TITLE = lambda c: f"lower(translate({_CLEAN(c)}, '{_PUNCT}', ''))"


@query(f"SELECT id, {_CLEAN('title')} AS title, {_CLEAN('buyer')} AS buyer, {_CLEAN('summary')} AS summary FROM tenders")
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "tenders").select("id", *[text.clean_text(F.col(c)).alias(c) for c in ("title", "buyer", "summary")])


_ENT = "regexp_replace(coalesce(text, ''), '<[^>]+>', ' ', 'g')"
for _n, _v in text.ENTITIES:
    _ENT = f"replace({_ENT}, '{_n}', '{_v}')"


@query(f"SELECT doc_id, {_CLEAN(_ENT)} AS plain FROM documents")
def plain_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", text.plain_text(F.col("text")).alias("plain"))


@query(
    rf"""SELECT doc_id, count(*) AS lines, max(length(line)) AS longest, min(line) AS least FROM (
    SELECT doc_id, trim(regexp_replace(l, '{_W}+', ' ', 'g')) AS line FROM (
    SELECT doc_id, unnest(string_split_regex({_ENT.replace(" '<[^>]+>', ' '", " '<[^>]+>', ' '").replace("regexp_replace(coalesce(text, ''), '<[^>]+>'", "regexp_replace(regexp_replace(coalesce(text, ''), '(?i)</(?:p|div|h[1-6]|li|tr|table)[ ]*>|<br[ ]*/?>', chr(10), 'g'), '<[^>]+>'")},
      '\r\n|[\n\r\x{{0b}}\x{{0c}}\x{{85}}\x{{2028}}\x{{2029}}]')) AS l FROM documents)) WHERE line <> '' GROUP BY doc_id"""
)
def block_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "documents").select("doc_id", F.explode(text.block_lines(F.col("text"))).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.max(F.length("line")).cast("bigint").alias("longest"), F.min("line").alias("least"))


_URL = r"""
 CASE WHEN trim(coalesce(url, '')) = '' THEN '' ELSE
 lower(regexp_extract(trim(url), '^([A-Za-z]+)://', 1)) || '://' || lower(regexp_extract(trim(url), '^[A-Za-z]+://([^/?#]*)', 1))
 || coalesce(nullif(regexp_replace(regexp_extract(trim(url), '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', ''), ''), '/')
 || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(trim(url), '^[^?#]*[?]([^#]*)', 1), '&'),
    lambda p: p <> '' AND lower(regexp_extract(p, '^([^=]*)', 1)) NOT IN ('utm_source', 'utm_medium', 'utm_campaign', 'from', 'spm'))), '&'), ''), '') END"""


@query(f"SELECT id, {_URL} AS canonical FROM tenders")
def canonical_url(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "tenders").select("id", urls.canonical_url(F.col("url")).alias("canonical"))


@query(
    """SELECT host, count(*) AS "rows", count(DISTINCT url) AS addresses, coalesce(max(source_name), host) AS source FROM (
    SELECT lower(regexp_extract(trim(url), '^(?i:https?)://([^/?#:]*)', 1)) AS host, url FROM tenders WHERE url IS NOT NULL)
    LEFT JOIN (SELECT host AS h, source_name FROM source_names) ON host = h WHERE host <> '' GROUP BY host"""
)
def host_facets(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "tenders").where("url is not null").select(urls.host(F.col("url")).alias("host"), "url").where("host != ''")
    counted = rows.groupBy("host").agg(F.count("*").alias("rows"), F.countDistinct("url").alias("addresses"))
    names = table(spark, folder, "source_names").select("host", "source_name").dropDuplicates(["host"])
    return counted.join(names, "host", "left").select("host", "rows", "addresses", F.coalesce("source_name", "host").alias("source"))


@query(f"SELECT id, {_TITLE('title')} AS title FROM tenders")
def normalized_title(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "tenders").select("id", text.normalized_title(F.col("title")).alias("title"))


_LOW = lambda c: f"lower({_CLEAN(c)})"


@query(
    f"""SELECT id, sha256(CASE WHEN u <> '' THEN 'url:' || u ELSE {_TITLE('title')} || '|' || {_LOW('buyer')} || '|' || {_LOW('bid_deadline')} END) AS fingerprint
    FROM (SELECT *, {_URL} AS u FROM tenders)"""
)
def content_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "tenders").withColumn("u", urls.canonical_url(F.col("url")))
    return rows.select("id", text.content_fingerprint(F.col("title"), F.col("u"), F.col("buyer"), F.col("bid_deadline")).alias("fingerprint"))


@query(
    """SELECT signature, count(*) AS "rows" FROM (SELECT sha256(array_to_string(list_sort(list_distinct(matched_keywords)), chr(10))) AS signature FROM tenders
    WHERE matched_keywords IS NOT NULL) GROUP BY signature"""
)
def keyword_signatures(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "tenders").where("matched_keywords is not null")
    return rows.groupBy(text.keyword_signature(F.col("matched_keywords")).alias("signature")).agg(F.count("*").alias("rows"))


@query("SELECT id, regexp_extract(coalesce(url, ''), '[?&](?:notice)?[iI]d=([A-Za-z0-9]+)', 1) AS notice_key, CASE WHEN length(summary) > 20 THEN substr(summary, 1, 20) || '…' ELSE summary END AS short FROM tenders")
def address_keys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "tenders").select("id", F.regexp_extract(F.coalesce("url", F.lit("")), r"[?&](?:notice)?[iI]d=([A-Za-z0-9]+)", 1).alias("notice_key"), text.truncated(F.col("summary"), 20).alias("short"))


# Compatibility forms in SQL, of the characters that have one of a single character.
_SINGLE = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in (*range(0xA0, 0x2F00), *range(0x2F00, 0x2FD6), *range(0x3000, 0x3400), *range(0xF900, 0xFB00), *range(0xFF01, 0xFFE7)) if unicodedata.normalize("NFKC", chr(c)) != chr(c) and len(unicodedata.normalize("NFKC", chr(c))) == 1}
_NFKC = lambda c: f"nfc_normalize(translate(coalesce({c}, ''), '{''.join(_SINGLE)}', '{''.join(x.replace(chr(39), chr(39) * 2) for x in _SINGLE.values())}'))"
_ENDS = lambda suffixes: f"({'|'.join(suffixes)})+$"
_NAME_MARKS = r"""[\s\x{0b}\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{3000}—_·,，。:：;；()（）\[\]【】“”"''、/\\-]+"""
_PLAIN_NAME = lambda c: f"regexp_replace({c}, '{_NAME_MARKS}', '', 'g')"
_LINKED = lambda c: f"regexp_replace({_PLAIN_NAME(f'regexp_replace(lower({_NFKC(c)}), {chr(39)}{text._LOT.pattern}{chr(39)}, {chr(39)}{chr(39)})')}, '{_ENDS(text.LINK_SUFFIXES)}', '')"
_NAMED = "coalesce(project_name, title)"


@query(
    f"""SELECT notice_id, {_LINKED(_NAMED)} AS link_name, regexp_replace({_PLAIN_NAME(f'lower({_NFKC(_NAMED)})')}, '{_ENDS([x for x in text.WATCH_SUFFIXES if x != '项目招标计划'])}', '') AS watch_name,
    trim(regexp_replace({_NFKC(_NAMED)}, '{_W}+', ' ', 'g')) AS shown_name, regexp_replace({_LINKED('buyer')}, '({'|'.join(text.COMPANY_SUFFIXES)})$', '') AS link_buyer,
    regexp_replace(lower({_NFKC('project_content')}), '[^一-鿿0-9a-z]+', '', 'g') AS link_text FROM verified_notices"""
)
def project_names(spark: SparkSession, folder: str) -> DataFrame:
    """The four forms of a project's or party's name."""
    rows = table(spark, folder, "verified_notices")
    name = F.coalesce("project_name", "title")
    return rows.select("notice_id", text.link_name_of(name).alias("link_name"), text.watch_name_of(name).alias("watch_name"), text.shown_name_of(name).alias("shown_name"), text.link_buyer_of("buyer").alias("link_buyer"), text.link_text_of("project_content").alias("link_text"))


# -- dates and amounts


def _date_sql(c: str, time: bool) -> str:
    t = rf"regexp_replace(coalesce({c}, ''), '^[\s\x{{22}}\x{{27}}]+|[\s\x{{22}}\x{{27}}]+$', '', 'g')"
    cn = r"(\d{4})年(\d{1,2})月(\d{1,2})日(?:\s*(\d{1,2})[：:时](\d{1,2})?)?"
    x = lambda i, n: f"lpad(regexp_extract({t}, '{cn}', {i}), {n}, '0')"
    chinese = f"{x(1, 4)} || '-' || {x(2, 2)} || '-' || {x(3, 2)}"
    iso = rf"regexp_extract({t}, '^(\d{{4}}-\d{{2}}-\d{{2}})', 1)"
    if time:
        chinese += f" || CASE WHEN regexp_extract({t}, '{cn}', 4) <> '' THEN ' ' || {x(4, 2)} || ':' || lpad(regexp_extract({t}, '{cn}', 5), 2, '0') ELSE '' END"
        clock = rf"regexp_extract({t}, '^\d{{4}}-\d{{2}}-\d{{2}}[ T](\d{{1,2}}:\d{{2}})', 1)"
        iso += f" || CASE WHEN {clock} <> '' THEN ' ' || {clock} ELSE '' END"
    dot = rf"regexp_replace(regexp_extract({t}, '^\d{{4}}\.\d{{2}}\.\d{{2}}', 0), '\.', '-', 'g')"
    return rf"CASE WHEN regexp_matches({t}, '{cn}') THEN {chinese} WHEN regexp_matches({t}, '^\d{{4}}-\d{{2}}-\d{{2}}') THEN {iso} WHEN regexp_matches({t}, '^\d{{4}}\.\d{{2}}\.\d{{2}}') THEN {dot} ELSE {t} END"


@query(f"SELECT notice_id, {_date_sql('published_at', False)} AS published_on, {_date_sql('bid_deadline', True)} AS deadline FROM verified_notices")
def normalize_date(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "verified_notices").select("notice_id", temporal.normalize_date(F.col("published_at")).alias("published_on"), temporal.normalize_date(F.col("bid_deadline"), True).alias("deadline"))


@query(
    r"""SELECT notice_id, CASE WHEN regexp_matches(d, '^\d{4}-\d{2}-\d{2}$') AND try_cast(d AS date) IS NOT NULL THEN d ELSE '' END AS day FROM (
    SELECT notice_id, regexp_extract(coalesce(published_at, ''), '20\d{2}-\d{1,2}-\d{1,2}', 0) AS d FROM verified_notices)"""
)
def date_part(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "verified_notices").select("notice_id", temporal.date_part(F.col("published_at")).alias("day"))


@query("SELECT event_id, strftime(date_trunc('second', ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS local FROM events")
def epoch_local(spark: SparkSession, folder: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").select("event_id", temporal.epoch_local(ms).alias("local"))


@query(
    """SELECT policy, count(*) AS kept FROM (
    SELECT d, unnest(['keep unknown', 'drop unknown', 'months']) AS policy FROM (SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE cast(o_orderdate AS date) END AS d FROM orders))
    WHERE CASE policy WHEN 'keep unknown' THEN coalesce(d >= date '1998-06-30', true) WHEN 'drop unknown' THEN coalesce(d >= date '1998-06-30', false)
      ELSE coalesce(d >= cast(date '1998-05-31' - INTERVAL 3 MONTH AS date), true) END GROUP BY policy"""
)
def retention_policies(spark: SparkSession, folder: str) -> DataFrame:
    d = F.when(F.col("o_orderkey") % 10 == 0, None).otherwise(F.col("o_orderdate").cast("date"))
    cutoff, months = F.lit("1998-06-30").cast("date"), F.add_months(F.lit("1998-05-31").cast("date"), -3)
    rows = table(spark, folder, "orders").select(d.alias("d"))
    kept = rows.agg(*[F.count_if(x).alias(n) for n, x in (("keep unknown", temporal.retained(F.col("d"), cutoff, True)), ("drop unknown", temporal.retained(F.col("d"), cutoff, False)), ("months", temporal.retained(F.col("d"), months, True)))])
    return kept.unpivot([], ["keep unknown", "drop unknown", "months"], "policy", "kept").where("kept > 0")


@query(
    """SELECT user_id, CASE WHEN last IS NULL THEN 'bootstrap' WHEN monthly IS NULL OR monthly <= n - INTERVAL 30 DAY THEN 'monthly'
      WHEN weekly IS NULL OR weekly <= n - INTERVAL 7 DAY THEN 'weekly' ELSE 'incremental' END AS mode,
      strftime(CASE WHEN last IS NULL THEN n - INTERVAL 30 DAY WHEN monthly IS NULL OR monthly <= n - INTERVAL 30 DAY THEN n - INTERVAL 45 DAY
      WHEN weekly IS NULL OR weekly <= n - INTERVAL 7 DAY THEN n - INTERVAL 14 DAY ELSE last - INTERVAL 6 HOUR END, '%Y-%m-%d %H:%M:%S') AS start
    FROM (SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN ts END) AS last, max(CASE WHEN event_type = 'view' THEN ts END) AS weekly,
      max(CASE WHEN event_type = 'signup' THEN ts END) AS monthly, timestamp '2024-01-31 00:00:00' AS n FROM events GROUP BY user_id)"""
)
def collection_window(spark: SparkSession, folder: str) -> DataFrame:
    at = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("ts")))
    cursors = table(spark, folder, "events").groupBy("user_id").agg(at("purchase").alias("last"), at("view").alias("weekly"), at("signup").alias("monthly"))
    mode, start = temporal.collection_start(F.col("last"), F.col("weekly"), F.col("monthly"), F.expr("timestamp_ntz'2024-01-31 00:00:00'"))
    return cursors.select("user_id", mode.alias("mode"), F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("start"))


@query(r"SELECT id, regexp_replace(regexp_extract(coalesce(budget, ''), '(?:预算金额|最高限价|控制价|总投资)\s*[（(]?[^\d\s]{0,8}?[:：]?\s*([¥￥]?\d[\d,]*(?:\.\d+)?\s*(?:亿元|万元|千元|元)?)', 1), '\s+', '', 'g') AS amount FROM tenders")
def labelled_amount(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "tenders").select("id", amounts.labelled_amount(F.col("budget"), ["预算金额", "最高限价", "控制价", "总投资"]).alias("amount"))


# -- extraction and labels


@query(r"SELECT doc_id, array_to_string(codes, ' ') AS codes, len(codes) AS n FROM (SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '[A-Z]{2}-\d{3,4}'), lambda x, i: list_position(regexp_extract_all(coalesce(text, ''), '[A-Z]{2}-\d{3,4}'), x) = i) AS codes FROM documents)")
def lot_codes(spark: SparkSession, folder: str) -> DataFrame:
    codes = extract.distinct_matches(F.col("text"), r"[A-Z]{2}-\d{3,4}")
    return table(spark, folder, "documents").select("doc_id", F.array_join(codes, " ").alias("codes"), F.size(codes).cast("bigint").alias("n"))


@query(
    r"""SELECT doc_id, coalesce(nullif(trim(regexp_extract(coalesce(text, ''), '合同期(\d+年)', 1)), ''), nullif(trim(regexp_extract(coalesce(text, ''), '工期(\d+日历天)', 1)), ''),
      nullif(trim(regexp_extract(coalesce(text, ''), '保修(\d+个月)', 1)), ''), '') AS term FROM documents"""
)
def contract_term(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", extract.first_match(F.col("text"), [r"合同期(\d+年)", r"工期(\d+日历天)", r"保修(\d+个月)"]).alias("term"))


@query(
    r"""WITH l AS (SELECT doc_id, n, regexp_extract(line, '(?:服务内容为|进度款凭)(.*)$', 1) AS rest FROM (SELECT doc_id, unnest(range(len(ls))) AS n, unnest(ls) AS line FROM (SELECT doc_id, regexp_split_to_array(text, '[\n\r]') AS ls FROM documents)) WHERE regexp_matches(line, '服务内容为|进度款凭')),
    v AS (SELECT doc_id, n, trim(regexp_replace(substr(rest, 1, 6000), '[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS value FROM l),
    b AS (SELECT doc_id, arg_min(value, [-length(value), n]) AS section FROM v WHERE length(value) >= 8 GROUP BY doc_id)
    SELECT d.doc_id, coalesce(section, '') AS section FROM documents d LEFT JOIN b ON d.doc_id = b.doc_id""".replace("\\\\", "\\")
)
def longest_sections(spark: SparkSession, folder: str) -> DataFrame:
    """The longest stretch from a delivery clause to the end of its line. (In SQL the first clause of a line has its longest one.)"""
    section = extract.longest_section(r"服务内容为|进度款凭", r"[\n\r]")
    return table(spark, folder, "documents").select("doc_id", section("text").alias("section"))


@query(
    """SELECT notice_id, array_to_string(list_filter(['工程', '设备', '绿化', '标识', '印'], lambda w: contains(lower(t), lower(w))), ',') AS hits FROM (
    SELECT notice_id, """ + "coalesce(" + _CLEAN("project_name") + ", '') || CASE WHEN " + _CLEAN("project_content") + " <> '' AND " + _CLEAN("project_name") + " <> '' THEN ' ' ELSE '' END || " + _CLEAN("project_content") + """ AS t FROM verified_notices)"""
)
def keyword_hits(spark: SparkSession, folder: str) -> DataFrame:
    words = classify.words_literal(["工程", "设备", "绿化", "标识", "印"])
    hits = classify.field_keyword_hits([F.col("project_name"), F.col("project_content")], words)
    return table(spark, folder, "verified_notices").select("notice_id", F.array_join(hits, ",").alias("hits"))


_R = _CLEAN("location")


@query(f"SELECT id, CASE WHEN contains({_R}, '白荻') OR contains({_R}, '砚池') THEN 'excluded' WHEN contains({_R}, '市') THEN 'included' ELSE 'review' END AS region FROM tenders")
def region_status(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "tenders").select("id", classify.region_status(F.col("location"), ["市"], ["白荻", "砚池"]).alias("region"))


_CATEGORIES = {"works": ["工程", "改造", "维修"], "goods": ["设备", "苗木", "校服"], "services": ["服务", "配送", "保洁", "维保"]}


@query(
    "SELECT id, category, hits FROM (" + " UNION ALL ".join(f"SELECT id, '{n}' AS category, array_to_string(list_filter({w}, lambda k: contains(lower({_CLEAN('title')}), k)), ',') AS hits FROM tenders" for n, w in _CATEGORIES.items()) + ") WHERE hits <> ''"
)
def category_labels(spark: SparkSession, folder: str) -> DataFrame:
    hits = classify.category_hits([F.col("title")], _CATEGORIES)
    return table(spark, folder, "tenders").select("id", F.explode(hits).alias("category", "words")).select("id", "category", F.array_join("words", ",").alias("hits"))


_TAGS = [("open", "公开招标"), ("talks", "磋商|谈判"), ("inquiry", "询价|比选"), ("tender", "招标")]


@query(
    "SELECT tag, count(*) AS \"rows\", count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest(CASE WHEN trim(coalesce(notice_type, '')) = '' THEN ['none'] WHEN len(t) = 0 THEN ['other'] ELSE t END) AS tag FROM (SELECT doc_id, notice_type, list_filter(["
    + ", ".join(f"CASE WHEN regexp_matches(coalesce(notice_type, ''), '{p}') THEN '{t}' END" for t, p in _TAGS)
    + "], lambda x: x IS NOT NULL) AS t FROM documents)) GROUP BY tag"
)
def ordered_tags(spark: SparkSession, folder: str) -> DataFrame:
    tags = classify.ordered_tags(F.col("notice_type"), _TAGS, "other", "none")
    rows = table(spark, folder, "documents").select("doc_id", F.explode(tags).alias("tag"))
    return rows.groupBy("tag").agg(F.count("*").alias("rows"), F.countDistinct("doc_id").alias("docs"))


QUERIES, SQL = query.QUERIES, query.SQL
