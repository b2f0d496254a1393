"""Queries of run windows, phased scans, batches of verdicts, classes, plan fields and projects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, extract, temporal, text
from ..functions.text import clean_text
from ..operators import feedback, listing, projects, scan, serve
from ..runtime import small
from ..tables import table
from .registry import Registry
from .states import _EV, _verdict_events
from .texts import _CLEAN, _TITLE

query = Registry()

_AS_OF = "date '2024-01-31'"


@query(
    f"""WITH u AS (SELECT user_id AS key, max(cast(ts AS date)) FILTER (WHERE event_type = 'purchase') AS s, max(cast(ts AS date)) FILTER (WHERE event_type = 'click') AS w, max(cast(ts AS date)) FILTER (WHERE event_type = 'view') AS m,
      max(value) FILTER (WHERE event_type = 'error') AS e, count(*) FILTER (WHERE event_type = 'signup') = 0 AS none FROM events GROUP BY user_id),
    g AS (SELECT key, none, date_diff('day', s, {_AS_OF}) AS gap, date_diff('day', w, {_AS_OF}) AS wg, date_diff('day', m, {_AS_OF}) AS mg, CASE WHEN e > 100 THEN 'all' WHEN e > 80 THEN 'l1y' END AS manual FROM u),
    n AS (SELECT *, CASE WHEN gap <= 0 THEN 0 WHEN gap = 1 THEN 1 WHEN gap <= 9 THEN 2 WHEN gap <= 29 THEN 3 ELSE 4 END AS r FROM g),
    c AS (SELECT key, CASE WHEN manual IS NOT NULL THEN 'manual' WHEN none OR gap IS NULL THEN 'bootstrap' WHEN coalesce(mg >= 30, true) AND r < 4 THEN 'monthly' WHEN coalesce(wg >= 7, true) AND r < 3 THEN 'weekly' WHEN gap <= 1 THEN 'daily' ELSE 'catchup' END AS mode,
      CASE WHEN manual IS NOT NULL THEN manual WHEN none OR gap IS NULL OR coalesce(mg >= 30, true) THEN 'l3m' WHEN coalesce(wg >= 7, true) AND r < 3 THEN 'l1m' ELSE ['td', 'l3d', 'l10d', 'l1m', 'l3m'][r + 1] END AS win FROM n)
    SELECT key, mode, win AS "window", strftime(CASE WHEN mode = 'manual' AND win = 'all' THEN NULL WHEN mode = 'manual' AND win = 'l1y' THEN {_AS_OF} - INTERVAL 366 DAY ELSE {_AS_OF} - INTERVAL 3 MONTH END, '%Y-%m-%d') AS kept_from,
      win IN ('l1m', 'l3m', 'l1y', 'all') AS weekly_done, win IN ('l3m', 'l1y', 'all') AS monthly_done FROM c"""
)
def run_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Per user as a source: the next run's mode and window, what is kept, and which backfills it counts as."""
    e, day = F.col("event_type"), F.to_date("ts")
    last = lambda kind: F.max(F.when(e == kind, day))
    u = table(spark, folder, "events").groupBy(F.col("user_id").alias("key")).agg(
        last("purchase").alias("s"), last("click").alias("w"), last("view").alias("m"), F.max(F.when(e == "error", F.col("value"))).alias("e"), (F.count_if(e == "signup") == 0).alias("none")
    )
    today = F.lit("2024-01-31").cast("date")
    manual = F.when(F.col("e") > 100, "all").when(F.col("e") > 80, "l1y")
    run = u.withColumn("run", scan.run_choice(F.datediff(today, "s"), F.datediff(today, "w"), F.datediff(today, "m"), manual, F.col("none"))).select("key", "run.mode", "run.window")
    weekly, monthly = scan.backfills_done(F.col("window"))
    kept = F.date_format(scan.retention_start(today, F.col("mode"), F.col("window")), "yyyy-MM-dd")
    return run.select("key", "mode", "window", kept.alias("kept_from"), weekly.alias("weekly_done"), monthly.alias("monthly_done"))


_MODES = "CASE event_type WHEN 'error' THEN 'weekly' WHEN 'click' THEN 'monthly' ELSE 'incremental' END"


@query(
    f"""WITH RECURSIVE c AS (SELECT event_type AS source, cast(quantile_disc(event_id, 0.5) AS bigint) AS last, {_MODES} AS mode FROM events GROUP BY event_type),
    a AS (SELECT event_type AS source, event_id AS number, CASE WHEN value < 2 THEN 1 ELSE 2 END AS a FROM events),
    d AS (SELECT event_type AS source, event_id AS number FROM events WHERE ts < timestamp '2024-01-12' AND value >= 2),
    r AS (SELECT source, number FROM a WHERE a = 1),
    q AS (SELECT c.source, c.last, unnest(range(greatest(1, last + 1 - CASE mode WHEN 'weekly' THEN 501 WHEN 'monthly' THEN 2001 ELSE 0 END), last + 1201)) AS number FROM c UNION SELECT c.source, c.last, r.number FROM r JOIN c ON r.source = c.source),
    k AS (SELECT q.*, a.a, CASE WHEN r.number IS NOT NULL THEN 0 ELSE 1 END AS step FROM q LEFT JOIN a ON q.source = a.source AND q.number = a.number LEFT JOIN r ON q.source = r.source AND q.number = r.number
      LEFT JOIN d ON q.source = d.source AND q.number = d.number WHERE q.number > q.last OR d.number IS NULL),
    s AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY step, number) AS rn FROM k),
    w AS (SELECT source, rn, number, step, a, last, CASE WHEN a = 2 THEN 0 WHEN number > last THEN 1 ELSE 0 END AS run FROM s WHERE rn = 1
      UNION ALL SELECT s.source, s.rn, s.number, s.step, s.a, s.last, CASE WHEN s.a = 2 THEN 0 WHEN s.number > s.last THEN w.run + 1 ELSE w.run END FROM w JOIN s ON s.source = w.source AND s.rn = w.rn + 1 WHERE w.run < 30)
    SELECT source, number, step, CASE WHEN a = 2 THEN 'found' WHEN a = 1 THEN 'failed' WHEN number > last THEN 'cleared' ELSE 'missing_notice' END AS outcome FROM w"""
)
def number_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A scan of event numbers, each kind of event a source with a cursor in its middle; small values stand for failed answers."""
    e = table(spark, folder, "events").select(F.col("event_type").alias("source"), F.col("event_id").alias("number"), "ts", "value")
    middle = e.groupBy("source").agg(F.expr("percentile_disc(0.5) within group (order by number)").cast("bigint").alias("last"))
    cursors = middle.withColumn("mode", F.when(F.col("source") == "error", "weekly").when(F.col("source") == "click", "monthly").otherwise("incremental"))
    answers = e.select("source", "number", F.when(F.col("value") < 2, "failed").otherwise("found").alias("answer"))
    done = e.where("ts < timestamp_ntz'2024-01-12 00:00:00' and value >= 2")
    return scan.number_scan(cursors, answers, done, answers.where("answer = 'failed'"), "source", "number", 1200, 30, {"weekly": 500, "monthly": 2000})


@query(
    """WITH d AS (SELECT source, doc_id, coalesce(contains(text, '设备'), false) AS hit FROM documents WHERE regexp_matches(coalesce(text, ''), '\\S')),
    p AS (SELECT source, CASE WHEN hit THEN 'title' WHEN row_number() OVER (PARTITION BY source, hit ORDER BY doc_id) <= 10 THEN 'content' ELSE 'left_out' END AS phase FROM d
      UNION ALL SELECT source, CASE WHEN isodow(fetched_at) < 3 THEN 'retry' ELSE 'given_up' END FROM documents WHERE NOT regexp_matches(coalesce(text, ''), '\\S')),
    s AS (SELECT source, count(*) FILTER (WHERE phase = 'title') AS title, count(*) FILTER (WHERE phase = 'retry') AS retry, count(*) FILTER (WHERE phase = 'given_up') AS given_up, count(*) FILTER (WHERE phase = 'content') AS content, count(*) FILTER (WHERE phase = 'left_out') AS left_out FROM p GROUP BY source)
    SELECT *, left_out = 0 AS scan_complete, CASE WHEN left_out > 0 THEN left_out || ' not examined' END AS warning FROM s"""
)
def phased_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The four phases per source; documents without text stand for details that failed before, as often as the day of the week says."""
    d = table(spark, folder, "documents").select("source", "doc_id", "text", "fetched_at")
    blank = ~F.coalesce("text", F.lit("")).rlike(r"\S")
    retries = d.where(blank).select("source", "doc_id", (F.weekday("fetched_at") + 1).alias("failures"))
    phases = scan.phased_scan(d.where(~blank).select("source", "doc_id", "text"), retries, "source", "doc_id", F.contains("text", F.lit("设备")), [F.asc("doc_id")], 10)
    return scan.scan_summary(phases, "source")


_FAULTS = """SELECT url, CASE WHEN action = 'exclude' AND trim(coalesce(reason, '')) = '' THEN 'no reason' WHEN action = 'correct' AND field NOT IN ('buyer', 'agency') THEN 'not a field to correct' WHEN action = 'correct' AND trim(coalesce(new_value, '')) = '' THEN 'no value' END AS why"""
_EVR = f"SELECT e.*, CASE WHEN e.action = 'exclude' AND v.value >= 1 THEN 'r' || cast(floor(v.value / 20) AS bigint) END AS reason FROM ({_EV}) e JOIN events v ON e.event_id = v.event_id"


def _reasoned(spark: SparkSession, folder: str) -> DataFrame:
    e = _verdict_events(spark, folder).join(table(spark, folder, "events").select("event_id", "value"), "event_id")
    return e.withColumn("reason", F.when((F.col("action") == "exclude") & (F.col("value") >= 1), F.concat(F.lit("r"), F.floor(F.col("value") / 20).cast("string")))).drop("value")


@query(
    f"""WITH e AS ({_EVR}), f AS (SELECT 'all' AS batch, url, why FROM ({_FAULTS} FROM e) WHERE why IS NOT NULL UNION ALL
      SELECT 'all', url, 'both in one batch' FROM e WHERE action <> 'correct' GROUP BY url HAVING count(DISTINCT action) > 1),
    c AS (SELECT 'corrections' AS batch, url, why FROM ({_FAULTS} FROM e WHERE action = 'correct') WHERE why IS NOT NULL)
    SELECT batch, why AS what, count(*) AS "rows" FROM (SELECT * FROM f UNION ALL SELECT * FROM c) GROUP BY batch, why
    UNION ALL SELECT 'all', 'applied', count(*) FROM e WHERE NOT EXISTS (SELECT 1 FROM f) HAVING count(*) > 0
    UNION ALL SELECT 'corrections', 'applied', count(*) FROM e WHERE action = 'correct' AND NOT EXISTS (SELECT 1 FROM c) HAVING count(*) > 0"""
)
def verdict_admission(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches, all events and the corrections alone: the problems that reject the batch whole, or the events that are applied."""
    e = _reasoned(spark, folder)
    none = feedback.folded_verdicts(e.where("false"))
    out = None
    for name, batch in (("all", e), ("corrections", e.where("action = 'correct'"))):
        fresh, problems = feedback.admitted(batch, e.where("false").select("event_id"), none, ["buyer", "agency"])
        both = problems.select(F.col("why").alias("what")).unionByName(fresh.select(F.lit("applied").alias("what"))).groupBy("what").agg(F.count("*").alias("rows"))
        part = both.select(F.lit(name).alias("batch"), "what", "rows")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    f"""WITH e AS ({_EVR}), l AS (SELECT url, arg_max(action, place) AS action, arg_max(coalesce(trim(reason), ''), place) AS reason, min(place) AS first_place FROM e WHERE action <> 'correct' GROUP BY url)
    SELECT reason, count(*) AS notices, min(first_place) AS first_place FROM l WHERE action = 'exclude' AND reason <> '' GROUP BY reason"""
)
def exclusion_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return feedback.exclusion_reasons(_reasoned(spark, folder))


@query(
    f"""WITH e AS ({_EV}), l AS (SELECT url, arg_max(action, place) AS action FROM e WHERE action <> 'correct' GROUP BY url)
    SELECT (SELECT count(*) FROM l WHERE action = 'confirm') AS confirmed, (SELECT count(*) FROM l WHERE action = 'exclude') AS excluded, (SELECT count(DISTINCT url) FROM e WHERE action = 'correct') AS corrected"""
)
def verdict_summary(spark: SparkSession, folder: str) -> DataFrame:
    return feedback.verdict_summary(_verdict_events(spark, folder))


_INDUSTRIES = {"equipment": ["设备", "仪器"], "works": ["工程", "改造", "维修"], "graphics": ["设计", "印刷"]}
_HITS = lambda words, text: "list_filter([" + ", ".join(f"'{w}'" for w in words) + f"], lambda w: contains(lower({text}), lower(w)))"


@query(
    f"""WITH t AS (SELECT notice_id, review_status, coalesce(matched_keywords, []) AS m, array_to_string(list_filter([{_CLEAN('project_name')}, {_CLEAN('project_content')}], lambda x: x <> ''), ' ') AS t FROM verified_notices),
    h AS (SELECT notice_id, review_status, m, """
    + ", ".join(f"{_HITS(words, 't')} AS {name}" for name, words in _INDUSTRIES.items())
    + """ FROM t), k AS (SELECT *, len(equipment) + len(works) + len(graphics) AS n FROM h),
    c AS (SELECT notice_id, """
    + " || ".join(f"CASE WHEN len({name}) > 0 THEN ['{name}'] ELSE [] END" for name in _INDUSTRIES)
    + """ AS classes, list_concat(list_concat(equipment, works), graphics) AS words FROM k WHERE n > 0 UNION ALL SELECT notice_id, ['graphics'], m FROM k WHERE n = 0 AND review_status = 'confirmed')
    SELECT notice_id, array_to_string(classes, ',') AS classes, array_to_string(list_filter(words, lambda w, i: list_position(words, w) = i), ',') AS words FROM c"""
)
def industry_classes(spark: SparkSession, folder: str) -> DataFrame:
    v = table(spark, folder, "verified_notices").select("notice_id", "project_name", "project_content", "review_status", "matched_keywords")
    none = F.lit(None).cast("map<string,array<string>>")
    classes = classify.industry_classes([F.col("project_name"), F.col("project_content")], _INDUSTRIES, F.col("review_status"), none, F.col("matched_keywords"), "graphics")
    out = v.select("notice_id", classes.alias("c")).where("c is not null")
    return out.select("notice_id", F.array_join(F.map_keys("c"), ",").alias("classes"), F.array_join(classify.all_hits(F.col("c")), ",").alias("words"))


@query(
    f"""SELECT notice_id, array_to_string(CASE WHEN contains({_CLEAN('title')}, '询价') OR contains({_CLEAN('title')}, '比选') THEN [] ELSE {_HITS(['施工', '资质', '甲级'], _CLEAN('project_content'))} END, ',') AS hits FROM verified_notices"""
)
def qualification_hits(spark: SparkSession, folder: str) -> DataFrame:
    hits = classify.qualification_hits(F.col("title"), F.col("project_content"), ["询价", "比选"], ["施工", "资质", "甲级"])
    return table(spark, folder, "verified_notices").select("notice_id", F.array_join(hits, ",").alias("hits"))


_FUNDS = [("bond", "国债|专项债"), ("budget", "财政|预算"), ("own", "自筹|自有")]


@query(
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), k AS (SELECT *, "
    + ", ".join(f"regexp_matches(t, '{p}') AS {n}" for n, p in _FUNDS)
    + """ FROM d)
    SELECT doc_id, own OR regexp_matches(t, '特别国债|超长期') OR contains(t, '补助') OR contains(t, '贷款') AS favoured, contains(t, '贷款') AS by_word, regexp_matches(t, '特别国债|超长期') AS by_pattern, budget AS by_tag FROM k"""
)
def fund_choices(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    tags = classify.ordered_tags(text, _FUNDS, "other", "none")
    words, patterns = ["补助", "贷款"], {"long": "特别国债|超长期"}
    chosen = lambda wanted: classify.fund_filter(F.col("tags"), text, wanted, words, patterns)
    rows = table(spark, folder, "documents").select("doc_id", "text", tags.alias("tags"))
    return rows.select("doc_id", classify.favoured_fund(F.col("tags"), text, "own", patterns["long"], words).alias("favoured"), chosen("贷款").alias("by_word"), chosen("long").alias("by_pattern"), chosen("budget").alias("by_tag"))


@query(
    """SELECT notice_id, coalesce(date_basis <> 'official', true) OR coalesce(project_content, '') = '' OR length(project_content) > 60 OR starts_with(project_content, '详见') OR coalesce(source_name, '') = ''
      OR trim(coalesce(buyer, '')) = '' OR trim(coalesce(agency, '')) = '' AS needed FROM verified_notices"""
)
def enrichment_needed(spark: SparkSession, folder: str) -> DataFrame:
    v = table(spark, folder, "verified_notices")
    known = (F.trim(F.coalesce("buyer", F.lit(""))) != "") & (F.trim(F.coalesce("agency", F.lit(""))) != "")
    basis = F.when(F.coalesce("source_name", F.lit("")) != "", "v3")
    return v.select("notice_id", classify.needs_enrichment(F.col("project_content"), basis, F.col("date_basis"), known, "v3", 60).alias("needed"))


_D = extract.DATE.replace("'", "''")


@query(
    f"""WITH r AS (SELECT id, [coalesce(title, ''), coalesce(submission_place, ''), coalesce(bid_deadline, ''), coalesce(buyer, '')] AS r FROM tenders)
    SELECT id, regexp_extract(array_to_string(r, ' '), '{_D}') AS planned_at,
      coalesce(list_filter(r, lambda c: NOT regexp_matches(c, '^(?:{_D})$') AND NOT regexp_matches(c, '{extract.PLACES}') AND NOT regexp_matches(c, '^[0-9]{{4,}}$') AND c NOT IN ({", ".join(f"'{h}'" for h in extract.PLAN_HEADINGS)}) AND length(c) <= 80 AND c <> '')[1], '') AS content,
      coalesce(list_filter(r, lambda c: regexp_matches(c, '{extract.PLACES}') AND NOT regexp_matches(c, '^(?:{_D})$'))[-1], '') AS place FROM r WHERE regexp_matches(array_to_string(r, ' '), '{_D}')"""
)
def planned_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every tender as a table of a heading row and one row of cells: what is planned, when and where."""
    cells = F.array(*[F.coalesce(c, F.lit("")) for c in ("title", "submission_place", "bid_deadline", "buyer")])
    rows = F.array(F.array(*[F.lit(h) for h in extract.PLAN_HEADINGS]), cells)
    out = table(spark, folder, "tenders").select("id", extract.planned_row(rows).alias("p"))
    return out.where("p.planned_at != ''").select("id", "p.planned_at", "p.content", "p.place")


_PROJECT = f"CASE WHEN {_CLEAN('project_name')} <> '' THEN {_CLEAN('project_name')} ELSE 'notice:' || notice_id END"
_VERSIONS = f"SELECT notice_id, {_PROJECT} AS project, strftime(first_seen_at, '%Y-%m-%d') AS day, source_name FROM verified_notices"


def _versions(spark: SparkSession, folder: str) -> DataFrame:
    v = table(spark, folder, "verified_notices").select("notice_id", "project_name", F.date_format("first_seen_at", "yyyy-MM-dd").alias("day"), "source_name")
    return projects.versions(v, projects.project_key(clean_text(F.col("project_name")), F.col("notice_id")), "notice_id", "day")


@query(f"SELECT notice_id, project, latest_key, versions, notice_id = latest_key AS is_latest FROM (SELECT *, first_value(notice_id) OVER (PARTITION BY project ORDER BY day DESC NULLS LAST, notice_id DESC) AS latest_key, count(*) OVER (PARTITION BY project) AS versions FROM ({_VERSIONS}))")
def project_versions(spark: SparkSession, folder: str) -> DataFrame:
    return _versions(spark, folder).select("notice_id", "project", "latest_key", "versions", "is_latest")


@query(f"SELECT count(*) FILTER (WHERE day >= '2026-01-01') AS new_notices, count(DISTINCT CASE WHEN day >= '2026-01-01' THEN project END) AS new_projects FROM ({_VERSIONS})")
def project_news(spark: SparkSession, folder: str) -> DataFrame:
    return projects.new_today(_versions(spark, folder), F.coalesce(F.col("day") >= "2026-01-01", F.lit(False)))


@query(f"SELECT DISTINCT v.project, s.source_id FROM ({_VERSIONS}) v JOIN source_names s ON v.source_name = s.source_name")
def project_sources(spark: SparkSession, folder: str) -> DataFrame:
    """What is attached to any version of a project, here the sources that published it."""
    links = table(spark, folder, "verified_notices").select("notice_id", "source_name").join(small(table(spark, folder, "source_names")), "source_name").select("notice_id", "source_id")
    return projects.attached(_versions(spark, folder), links, "notice_id", "source_id")


@query(
    """WITH s AS (SELECT canonical_url AS url, max(strftime(last_seen_at, '%Y-%m-%d')) AS cached_on, max(summary) AS summary FROM tenders WHERE batch_no = 0 AND coalesce(canonical_url, '') <> '' GROUP BY canonical_url)
    SELECT url, summary, cached_on FROM s WHERE trim(coalesce(summary, '')) <> '' AND url IN (SELECT canonical_url FROM tenders WHERE batch_no > 0)"""
)
def cache_upkeep(spark: SparkSession, folder: str) -> DataFrame:
    """An empty cache seeded from the accepted history, and pruned to what later batches still list."""
    t = table(spark, folder, "tenders").select(F.col("canonical_url").alias("url"), "batch_no", "summary", F.date_format("last_seen_at", "yyyy-MM-dd").alias("day"))
    rows = t.where("batch_no = 0").groupBy("url").agg(F.max("day").alias("day"), F.max("summary").alias("summary"))
    empty = rows.where("false").withColumn("cached_on", F.col("day"))
    return scan.kept_cache(scan.seeded_cache(empty, rows, "url", ["summary"], F.col("day")), t.where("batch_no > 0"), "url")


@query(
    f"""WITH l AS (SELECT * FROM tenders WHERE batch_no >= 7 AND canonical_url IS NOT NULL AND coalesce(cast(collected_at AS date) >= date '2025-02-01', true) AND coalesce(contains(title, '工程') OR contains(title, '服务'), false) AND NOT coalesce(contains(title, '谈判'), false)),
    o AS (SELECT canonical_url, max(id) AS id FROM l GROUP BY canonical_url),
    a AS (SELECT canonical_url, max(id) AS id FROM tenders WHERE batch_no BETWEEN 1 AND 6 AND canonical_url IS NOT NULL AND coalesce(trim(budget), '') = '' GROUP BY canonical_url)
    SELECT id, canonical_url, false AS requeued FROM o WHERE canonical_url NOT IN (SELECT canonical_url FROM tenders WHERE batch_no = 0 AND canonical_url IS NOT NULL)
    UNION ALL SELECT id, canonical_url, true FROM a WHERE canonical_url NOT IN (SELECT canonical_url FROM o)"""
)
def collected_listing(spark: SparkSession, folder: str) -> DataFrame:
    """A source composed of window, keyword and result filters, last listing per page, what was seen, and what is taken up again."""
    t = table(spark, folder, "tenders").select("id", "batch_no", "canonical_url", "title", F.to_date("collected_at").alias("day"), "budget")
    again = t.where("batch_no between 1 and 6 and coalesce(trim(budget), '') = ''").drop("batch_no")
    wanted, dropped = F.contains("title", F.lit("工程")) | F.contains("title", F.lit("服务")), F.contains("title", F.lit("谈判"))
    seen = t.where("batch_no = 0 and canonical_url is not null").select("canonical_url")
    out = listing.collected(t.where("batch_no >= 7").drop("batch_no"), "canonical_url", ["id"], day=F.col("day"), cutoff=F.lit("2025-02-01").cast("date"), wanted=wanted, dropped=dropped, seen=seen, again=again)
    return out.select("id", "canonical_url", "requeued")


@query(
    """SELECT notice_id, CASE WHEN trim(coalesce(url, '')) = '' THEN 'missing_url' WHEN contains(location, '白荻') THEN 'region_prefilter' WHEN contains(title, '询价') THEN 'result_notice' WHEN contains(title, '比选') THEN 'ignored_notice_type'
    WHEN coalesce(project_content, '') = '' THEN 'missing_notice' WHEN review_status = 'confirmed' THEN 'frozen' WHEN len(matched_keywords) > 0 THEN 'matched' ELSE 'not_matched' END AS outcome FROM verified_notices"""
)
def notice_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    has = lambda c, w: F.contains(c, F.lit(w))
    tests = {
        "matched": F.size("matched_keywords") > 0, "missing_url": F.trim(F.coalesce("url", F.lit(""))) == "", "region_prefilter": has("location", "白荻"), "result_notice": has("title", "询价"),
        "ignored_notice_type": has("title", "比选"), "missing_notice": F.coalesce("project_content", F.lit("")) == "", "frozen": F.col("review_status") == "confirmed",
    }
    return table(spark, folder, "verified_notices").select("notice_id", listing.outcome(tests).alias("outcome"))


_LOOSE = temporal._LOOSE
_L = lambda c: _CLEAN(c)
_LP = lambda c, i, n: f"lpad(regexp_extract({_L(c)}, '{_LOOSE}', {i}), {n}, '0')"


@query(
    f"""SELECT notice_id, CASE WHEN regexp_matches({_L('bid_deadline')}, '{_LOOSE}') THEN {_LP('bid_deadline', 1, 4)} || '-' || {_LP('bid_deadline', 2, 2)} || '-' || {_LP('bid_deadline', 3, 2)} ||
    CASE WHEN regexp_extract({_L('bid_deadline')}, '{_LOOSE}', 4) <> '' THEN ' ' || {_LP('bid_deadline', 4, 2)} || ':' || regexp_extract({_L('bid_deadline')}, '{_LOOSE}', 5) ELSE '' END ELSE {_L('bid_deadline')} END AS deadline FROM verified_notices"""
)
def loose_dates(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "verified_notices").select("notice_id", temporal.loose_date(F.col("bid_deadline"), True).alias("deadline"))


@query(f"SELECT notice_id, {_TITLE(chr(114) + 'egexp_replace(coalesce(title, ' + chr(39) * 2 + '), ' + chr(39) + text._CHANGE_END + chr(39) + ', ' + chr(39) * 2 + ')')} AS key FROM verified_notices")
def change_keys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "verified_notices").select("notice_id", text.change_key(F.col("title")).alias("key"))


@query(
    f"""WITH v AS (SELECT notice_id, title, review_status, coalesce(matched_keywords, []) AS m, trim(split_part(coalesce(project_content, ''), '。', 1)) AS q FROM verified_notices),
    h AS (SELECT *, CASE WHEN contains({_CLEAN('title')}, '询价') THEN [] ELSE {_HITS(['施工', '安装', '种植'], 'q')} END AS h FROM v)
    SELECT notice_id, array_to_string(CASE WHEN coalesce(review_status, '') = 'confirmed' THEN m ELSE h END, ',') AS words FROM h WHERE coalesce(review_status, '') = 'confirmed' OR len(h) > 0"""
)
def requalified(spark: SparkSession, folder: str) -> DataFrame:
    """Notices that are not confirmed must still hit a keyword in their content as it is cut now."""
    v = table(spark, folder, "verified_notices").select("notice_id", "title", "review_status", "matched_keywords", extract.before(F.col("project_content"), "。").alias("q"))
    confirmed = F.coalesce(F.col("review_status") == "confirmed", F.lit(False))
    hits = v.withColumn("h", classify.qualification_hits(F.col("title"), F.col("q"), ["询价"], ["施工", "安装", "种植"]))
    kept = hits.where(confirmed | (F.size("h") > 0))
    none = F.array().cast("array<string>")
    return kept.select("notice_id", F.array_join(F.when(confirmed, F.coalesce("matched_keywords", none)).otherwise(F.col("h")), ",").alias("words"))


@query(
    """SELECT 'tenders' AS dataset, './tenders' AS path, count(*) AS "rows", count(DISTINCT url) AS "keys" FROM tenders UNION ALL SELECT 'notices', '', count(*), count(DISTINCT url) FROM verified_notices"""
)
def manifest(spark: SparkSession, folder: str) -> DataFrame:
    datasets = {"tenders": table(spark, folder, "tenders").select("url"), "notices": table(spark, folder, "verified_notices").select("url", "source_name")}
    return serve.run_documents(datasets, "url", table(spark, folder, "runs").where("error is not null"), {"tenders": "./tenders"})[0]


@query(
    """SELECT '2025-02-05' AS date, count(*) FILTER (WHERE d = date '2025-02-05') AS total, '2025-02-05 ' || count(*) FILTER (WHERE d = date '2025-02-05') AS message,
    CASE WHEN count(*) FILTER (WHERE d > date '2025-06-01') > 0 THEN count(*) FILTER (WHERE d > date '2025-06-01') || ' later than today' END AS warning FROM (SELECT cast(collected_at AS date) AS d FROM tenders)"""
)
def digest_notes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "tenders").select(F.to_date("collected_at").alias("day"))
    return serve.digest_notes(rows, "day", F.lit("2025-02-05").cast("date"), F.lit("2025-06-01").cast("date"))


@query(
    f"""WITH v AS (SELECT *, first_value(notice_id) OVER (PARTITION BY {_PROJECT} ORDER BY strftime(first_seen_at, '%Y-%m-%d') DESC NULLS LAST, notice_id DESC) AS latest FROM verified_notices)
    SELECT notice_id FROM v WHERE notice_id = latest AND location = '白荻市' AND starts_with(strftime(first_seen_at, '%Y-%m-%d'), '2025-') AND contains(lower(concat_ws(' ', nullif(trim(title), ''), nullif(trim(buyer), ''))), '工程')"""
)
def plan_filters(spark: SparkSession, folder: str) -> DataFrame:
    v = table(spark, folder, "verified_notices").withColumns({"day": F.date_format("first_seen_at", "yyyy-MM-dd"), "prefecture": F.col("location")})
    latest = projects.versions(v, projects.project_key(clean_text(F.col("project_name")), F.col("notice_id")), "notice_id", "day").where("is_latest").withColumn("planned_bid_time", F.col("day"))
    return latest.where(serve.plan_filter(prefecture="白荻市", month="2025-", query="工程", fields=["title", "buyer"])).select("notice_id")


QUERIES, SQL = query.QUERIES, query.SQL
