"""Windows, scans, batches of verdicts, classes, plan fields and projects: small cases with nulls, ties, repeats and nothing at all."""

from datetime import date

import pytest
from noticeworks.functions import amounts, classify, extract, temporal, text
from noticeworks.operators import feedback, listing, projects, scan, serve
from noticeworks.sources import documents
from pyspark.sql import functions as F


@pytest.mark.parametrize(
    "gap,weekly,monthly,manual,empty,expected",
    [
        (None, None, None, None, False, ("bootstrap", "l3m")), (0, 0, 0, None, False, ("daily", "td")), (1, 0, 0, None, False, ("daily", "l3d")), (9, 0, 0, None, False, ("catchup", "l10d")),
        (29, 0, 0, None, False, ("catchup", "l1m")), (30, 0, 0, None, False, ("catchup", "l3m")), (0, 7, 0, None, False, ("weekly", "l1m")), (0, None, 29, None, False, ("weekly", "l1m")),
        (0, 7, 30, None, False, ("monthly", "l3m")), (29, 7, 0, None, False, ("catchup", "l1m")), (30, 7, 30, None, False, ("catchup", "l3m")), (0, 0, None, None, False, ("monthly", "l3m")),
        (0, 0, 0, None, True, ("bootstrap", "l3m")), (0, 0, 0, "l1y", True, ("manual", "l1y")), (None, None, None, "all", False, ("manual", "all")),
    ],
)
def test_run_choice(spark, gap, weekly, monthly, manual, empty, expected):
    row = spark.createDataFrame([(gap, weekly, monthly, manual, empty)], "g int, w int, m int, manual string, empty boolean")
    got = row.select(scan.run_choice(F.col("g"), F.col("w"), F.col("m"), F.col("manual"), F.col("empty")).alias("r")).first()["r"]
    assert tuple(got) == expected


def test_retention_and_backfills(spark):
    rows = spark.createDataFrame([("manual", "all"), ("manual", "l1y"), ("daily", "td"), ("monthly", "l3m")], "mode string, window string")
    weekly, monthly = scan.backfills_done(F.col("window"))
    got = [tuple(r) for r in rows.select(scan.retention_start(F.lit("2026-05-31").cast("date"), F.col("mode"), F.col("window")), weekly, monthly).collect()]
    assert got == [(None, True, True), (date(2025, 5, 30), True, True), (date(2026, 2, 28), False, False), (date(2026, 2, 28), True, True)]


def test_number_scan(spark):
    cursors = spark.createDataFrame([("a", 10, "weekly"), ("b", 5, "incremental"), ("c", 0, "incremental")], "source string, last long, mode string")
    answers = spark.createDataFrame([("a", 9, "found"), ("a", 11, "found"), ("a", 13, "failed"), ("a", 15, "found"), ("a", 15, "failed"), ("a", 19, "found"), ("b", 3, "found"), ("b", 6, "found")], "source string, number long, answer string")
    done = spark.createDataFrame([("a", 8), ("a", 8)], "source string, number long")
    retries = spark.createDataFrame([("b", 3), ("b", 3), ("b", 2)], "source string, number long")
    got = scan.number_scan(cursors, answers, done, retries, "source", "number", 12, 3, {"weekly": 3})
    rows = {s: [(r["number"], r["step"], r["outcome"]) for r in sorted(got.where(F.col("source") == s).collect(), key=lambda r: (r["step"], r["number"]))] for s in "abc"}
    # 8 was processed; after 15 three are missing in a row, and 19 is not reached
    assert rows["a"] == [(7, 1, "missing_notice"), (9, 1, "found"), (10, 1, "missing_notice"), (11, 1, "found"), (12, 1, "cleared"), (13, 1, "failed"), (14, 1, "cleared")]
    assert rows["b"] == [(2, 0, "missing_notice"), (3, 0, "found"), (6, 1, "found"), (7, 1, "cleared"), (8, 1, "cleared"), (9, 1, "cleared")]
    assert rows["c"] == [(n, 1, "cleared") for n in (1, 2, 3)]
    assert scan.number_scan(cursors.where("false"), answers, done, retries, "source", "number", 12, 3, {}).count() == 0


def test_phases(spark):
    listing = spark.createDataFrame([("s", i, i == 3 or None, 1) for i in range(6)] + [("t", 1, True, 1)], "source string, id long, hit boolean, phase int").drop("phase")
    retries = spark.createDataFrame([("s", 90, 2), ("s", 91, 3), ("u", 1, 0)], "source string, id long, failures int")
    phases = scan.phased_scan(listing, retries, "source", "id", F.col("hit"), [F.asc("id")], 2)
    assert sorted((r["id"], r["phase"]) for r in phases.where("source = 's'").collect()) == [(0, "content"), (1, "content"), (2, "left_out"), (3, "title"), (4, "left_out"), (5, "left_out"), (90, "retry"), (91, "given_up")]
    got = {r["source"]: r for r in scan.scan_summary(phases, "source").collect()}
    assert not got["s"]["scan_complete"] and got["s"]["warning"] == "3 not examined" and got["t"]["scan_complete"] and got["u"]["retry"] == 1 and got["u"]["warning"] is None


def test_cache(spark):
    empty = spark.createDataFrame([], "id string, a string, b string, cached_on string")
    rows = spark.createDataFrame([("1", "x", None, "d"), ("2", " ", "", "d"), ("", "x", "y", "d"), (None, "x", "y", "d")], "id string, a string, b string, day string")
    assert [r["id"] for r in scan.seeded_cache(empty, rows, "id", ["a", "b"], F.col("day")).collect()] == ["1"]
    held = spark.createDataFrame([("7", "x", "y", "d"), ("1", "x", "y", "d")], empty.schema)
    assert scan.seeded_cache(held, rows, "id", ["a", "b"], F.col("day")).count() == 2
    assert [r["id"] for r in scan.kept_cache(held, rows, "id").collect()] == ["1"]


EVENTS = "event_id string, place long, url string, action string, field string, new_value string, reason string"


def test_batches_are_whole_or_nothing(spark):
    good = [("e1", 1, "u", "confirm", None, None, None), ("e2", 2, "v", "exclude", None, None, "off topic"), ("e3", 3, "u", "correct", "buyer", "X", None)]
    verdicts = spark.createDataFrame([("w", "confirmed")], "url string, status string")
    none = spark.createDataFrame([], "event_id string")

    def admit(rows, processed=none):
        fresh, problems = feedback.admitted(spark.createDataFrame(rows, EVENTS), processed, verdicts, ["buyer"])
        return fresh.count(), sorted(r["why"] for r in problems.collect())

    assert admit(good) == (3, [])
    assert admit([*good, good[0]]) == (3, [])
    assert admit(good, spark.createDataFrame([("e1",)], "event_id string")) == (2, [])
    for bad, why in [
        (("e9", 9, "u", "exclude", None, None, "no"), "both in one batch"), (("e9", 9, "w", "exclude", None, None, "no"), "against the standing verdict"), (("e9", 9, "x", "exclude", None, None, " "), "no reason"),
        (("e9", 9, "x", "correct", "id", "1", None), "not a field to correct"), (("e9", 9, "x", "correct", "buyer", "", None), "no value"), (("", 9, "x", "confirm", None, None, None), "no id"), (("e9", 9, "x", None, None, None, None), "unknown action"),
    ]:
        assert admit([*good, bad]) == (0, [why])
    # a conflict that was processed before is none
    assert admit([*good, ("e9", 9, "u", "exclude", None, None, "no")], spark.createDataFrame([("e9",)], "event_id string")) == (3, [])
    assert admit([]) == (0, [])


def test_reasons_summary_and_enrichment(spark):
    rows = [("1", 1, "a", "exclude", None, None, "r"), ("2", 2, "b", "exclude", None, None, " r "), ("3", 3, "c", "exclude", None, None, "s"), ("4", 4, "c", "confirm", None, None, None), ("5", 5, "d", "exclude", None, None, None), ("6", 6, "a", "correct", "buyer", "X", None)]
    events = spark.createDataFrame(rows, EVENTS)
    assert [tuple(r) for r in feedback.exclusion_reasons(events).collect()] == [("r", 2, 1)]
    assert tuple(feedback.verdict_summary(events).first()) == (1, 3, 1)
    assert tuple(feedback.verdict_summary(events.where("false")).first()) == (0, 0, 0)
    mine = spark.createDataFrame([("a", {"title": "mine"}), ("b", None), ("z", {"k": "v"})], "url string, item map<string,string>")
    current = spark.createDataFrame([("a", "theirs", "B"), ("b", "t", None)], "url string, title string, buyer string")
    got = {r["url"]: r["item"] for r in feedback.enriched(mine, current).collect()}
    assert got == {"a": {"title": "mine", "buyer": "B"}, "b": {"title": "t"}, "z": {"k": "v"}}


def test_classes(spark):
    df = spark.createDataFrame(
        [(1, "设备改造", None, None, None), (2, "x", "confirmed", {"works": ["旧"]}, ["m"]), (3, "x", "confirmed", None, ["m"]), (4, "x", "confirmed", {}, None), (5, None, "review", {"works": ["旧"]}, ["m"])],
        "id int, title string, status string, before map<string,array<string>>, matched array<string>",
    )
    classes = classify.industry_classes([F.col("title")], {"goods": ["设备"], "works": ["改造", "设备"]}, F.col("status"), F.col("before"), F.col("matched"), "other")
    got = {r["id"]: (r["c"], r["h"]) for r in df.select("id", classes.alias("c")).select("id", "c", classify.all_hits(F.col("c")).alias("h")).collect()}
    assert got[1] == ({"goods": ["设备"], "works": ["改造", "设备"]}, ["设备", "改造"]) and got[2] == ({"works": ["旧"]}, ["旧"]) and got[3] == ({"other": ["m"]}, ["m"]) and got[4] == ({"other": []}, []) and got[5][0] is None
    texts = spark.createDataFrame([("变更公告", "需二级资质"), ("招标公告", "需二级资质 ABC"), (None, None)], "title string, text string")
    assert [r[0] for r in texts.select(classify.qualification_hits(F.col("title"), F.col("text"), ["变更"], ["资质", "abc"])).collect()] == [[], ["资质", "abc"], []]
    fund = spark.createDataFrame([(["long"], None), (["other"], "特别国债"), (None, "银行贷款"), (None, None)], "tags array<string>, source string")
    assert [r[0] for r in fund.select(classify.favoured_fund(F.col("tags"), F.col("source"), "long", "特别国债", ["贷款"])).collect()] == [True, True, True, False]
    assert [r[0] for r in fund.select(classify.fund_filter(F.col("tags"), F.col("source"), "", [], {})).collect()] == [True] * 4
    rows = spark.createDataFrame([("好", "v", "official", True), ("详见附件", "v", "official", True), ("好", None, "official", True), ("好" * 401, "v", "official", True), ("好", "v", None, True), ("好", "v", "official", None), (None, "v", "official", True)], "c string, b string, d string, p boolean")
    assert [r[0] for r in rows.select(classify.needs_enrichment(F.col("c"), F.col("b"), F.col("d"), F.col("p"), "v")).collect()] == [False] + [True] * 6


def test_plan_fields(spark):
    rows = [["项目名称", "甲工程", "总投资", "1,200.5"], ["招标人：", "13812345678", "代理机构名称", "乙公司"], ["资金来源", "财政资金"], ["序号", "招标内容", "预计招标时间", "拟交易场所"], ["20251", "施工", "2025-6-1 09:30", "丙交易中心"], ["2", "监理", "2025-7-1", "丁交易中心"]]
    df = spark.createDataFrame([(rows, "公示 2024-01-02"), ([], "公示 2024-01-02 10:00"), (None, None)], "rows array<array<string>>, text string")
    fields = extract.plan_fields(F.col("rows"), F.col("text"), lambda c: classify.ordered_tags(c, [("budget", "财政")], "other", "none"))
    got = df.select(*[c.alias(n) for n, c in fields.items()]).collect()
    assert len(fields) == 14
    first = got[0]
    assert first["project_name"] == "甲工程" and first["budget"] == "1,200.5万元" and first["buyer"] == "" and first["agency"] == "乙公司" and first["fund_source_tags"] == ["budget"]
    assert (first["planned_bid_time"], first["planned_tender_content"], first["planned_trade_place"]) == ("2025-6-1 09:30", "施工", "丙交易中心")
    assert got[1]["planned_bid_time"] == "2024-01-02 10:00" and got[1]["project_name"] == "" and got[2]["planned_bid_time"] == "" and got[2]["fund_source_tags"] == ["none"]


def test_projects(spark):
    rows = [(1, "P", "2025-01-01", True), (2, "P", "2025-02-01", False), (3, "P", "2025-02-01", True), (4, "", None, True), (5, None, None, None), (6, "Q", None, False)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "id long, name string, day string, is_new boolean, rank string")
    v = projects.versions(df, projects.project_key(F.col("name"), F.col("id")), "id", "day")
    got = {r["id"]: (r["project"], r["latest_key"], r["versions"], r["is_latest"]) for r in v.collect()}
    assert got[1] == ("P", 3, 3, False) and got[3] == ("P", 3, 3, True) and got[4] == ("notice:4", 4, 1, True) and got[6] == ("Q", 6, 1, True)
    assert tuple(projects.new_today(v, F.col("is_new")).first()) == (3, 2)
    links = spark.createDataFrame([(1, 70), (2, 70), (3, 71), (9, 72)], "id long, other long")
    assert sorted(tuple(r) for r in projects.attached(v, links, "id", "other").collect()) == [("P", 70), ("P", 71)]
    assert projects.versions(df.where("false"), F.col("name"), "id", "day").count() == 0
    order = spark.createDataFrame([("a", 0, "2026"), ("b", 2, "2025"), ("c", 1, "2026"), ("d", None, None)], "n string, linked int, day string")
    assert [r["n"] for r in order.orderBy(*projects.linked_first(F.col("linked"), F.col("day"))).collect()] == ["c", "b", "a", "d"]
    names = spark.createDataFrame([("重庆", 1), ("北京", 1), ("安徽", 1), ("浙江", 5)], "n string, k int")
    assert [r["n"] for r in names.orderBy(*projects.most_first(F.col("k"), F.col("n"))).collect()][:3] == ["浙江", "安徽", "北京"]


def test_watch_list_and_resolving(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"projects": ["甲", {"project_name": "乙"}, " "]}', encoding="utf-8")
    (tmp_path / "b.json").write_text('{"projects": {"x": 1}}', encoding="utf-8")
    assert [r[0] for r in documents.watched_projects(spark, str(tmp_path / "a.json")).collect()] == ["甲", "乙"]
    with pytest.raises(Exception, match="must be a list"):
        documents.watched_projects(spark, str(tmp_path / "b.json")).collect()
    assert documents.resolved(spark, "a.json", [str(tmp_path / "none"), str(tmp_path)]) == f"{tmp_path}/a.json"
    with pytest.raises(FileNotFoundError):
        documents.resolved(spark, "c.json", [str(tmp_path)])


def test_tables_are_replaced_safely(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    for n in (3, 5):
        documents.replace_table(spark.range(n).withColumn("phone", F.lit("1")), path)
        assert spark.read.json(path).columns == ["id"] and spark.read.json(path).count() == n
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_collected_listing(spark):
    rows = [("a", 1, "甲工程", "2025-02-02"), ("a", 2, "甲工程", "2025-02-02"), ("b", 3, "甲工程结果", "2025-02-02"), ("c", 4, "乙", "2025-02-02"), ("d", 5, "工程", "2025-01-01"), ("e", 6, "工程", None), (None, 7, "工程", "2025-02-02"), ("f", 8, None, "2025-02-02"), ("g", 9, "工程", "2025-02-02")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "url string, id int, title string, day string, rank string")
    again = spark.createDataFrame([("a", 90, "t", None, "x"), ("z", 91, "t", None, "x"), ("z", 92, "t", None, "x"), (None, 93, "t", None, "x")], df.schema)
    seen = spark.createDataFrame([("g",), ("g",)], "url string")
    got = listing.collected(df, "url", ["id"], day=F.col("day"), cutoff=F.lit("2025-02-01"), wanted=F.contains("title", F.lit("工程")), dropped=F.contains("title", F.lit("结果")), seen=seen, again=again)
    assert sorted((r["url"], r["id"], r["requeued"]) for r in got.collect()) == [("a", 2, False), ("e", 6, False), ("z", 92, True)]
    assert listing.collected(df.where("false"), "url", ["id"]).count() == 0 and listing.collected(df, "url", ["id"]).count() == 7


def test_outcomes_forms_and_amounts(spark):
    df = spark.createDataFrame([(True, None), (None, None), (True, True)], "m boolean, f boolean")
    assert [r[0] for r in df.select(listing.outcome({"matched": F.col("m"), "frozen": F.col("f")})).collect()] == ["matched", "not_matched", "frozen"]
    with pytest.raises(ValueError):
        listing.outcome({"other": F.lit(True)})
    dates = spark.createDataFrame([("截止 2025-3月7日 9:05 止",), ("2025年3-07",), ("面议",), (None,)], "t string")
    assert [r[0] for r in dates.select(temporal.loose_date(F.col("t"), True)).collect()] == ["2025-03-07 09:05", "2025-03-07", "面议", ""]
    money = spark.createDataFrame([({"预算": "", "限价": "1,250,000"},), ({"预算": "35万元"},), ({"限价": "面议"},), ({},), (None,), ({"预算": "900"},)], "f map<string,string>")
    assert [r[0] for r in money.select(amounts.mapped_amount(F.col("f"), ["预算", "限价"])).collect()] == ["125万元", "35万元", "面议", "", "", "900元"]
    pair = spark.createDataFrame([(" a ", "a"), (None, "b"), ("", None)], "x string, y string")
    assert [tuple(r) for r in pair.select(amounts.joined_once(F.col("x"), F.col("y")), amounts.first_said(F.col("x"), F.col("y"))).collect()] == [("a", " a "), ("b", "b"), ("", "")]
    keys = spark.createDataFrame([("X项目 招标采购公告",), ("X项目",), (None,)], "t string")
    assert [r[0] for r in keys.select(text.change_key(F.col("t"))).collect()][0] == [r[0] for r in keys.select(text.change_key(F.col("t"))).collect()][1]


def test_readers_choices_and_documents(spark):
    rows = spark.createDataFrame([(1, "u", "P", "D", "2025-06-01", "甲 A"), (2, "v", "P", None, None, None), (3, "w", None, "D", "2025-07-01", "甲")], "id int, url string, prefecture string, district string, planned_bid_time string, title string")
    chosen = lambda **k: [r["id"] for r in rows.where(serve.plan_filter(**k)).collect()]
    assert chosen() == [1, 2, 3] and chosen(prefecture="P") == [1, 2] and chosen(district="D", month="2025-06") == [1] and chosen(query="a", fields=["title"]) == [1]
    there, kept = serve.kept_items(rows, spark.createDataFrame([("u",), ("u",), ("gone",)], "url string"), "url")
    assert [r["id"] for r in there.collect()] == [1] and [r["url"] for r in kept.collect()] == ["u"]
    days = spark.createDataFrame([(date(2025, 1, 1),), (date(2025, 1, 1),), (date(2025, 3, 1),), (None,)], "d date")
    note = serve.digest_notes(days, "d", F.lit("2025-01-01").cast("date"), F.lit("2025-02-01").cast("date")).first()
    assert tuple(note) == ("2025-01-01", 2, "2025-01-01 2", "1 later than today")
    assert serve.digest_notes(days.where("false"), "d", F.lit("2025-01-01").cast("date"), F.lit("2025-02-01").cast("date")).first()["warning"] is None
    named = rows.withColumn("source_name", F.when(F.col("id") < 3, " s "))
    manifest, status, sources = serve.run_documents({"a": named, "b": rows}, "url", rows.where("false"), {"a": "./a"})
    assert sorted(tuple(r) for r in manifest.collect()) == [("a", "./a", 3, 3), ("b", "", 3, 3)] and tuple(status.first()) == (6, 0, True) and [tuple(r) for r in sources.collect()] == [("a", "s")]
