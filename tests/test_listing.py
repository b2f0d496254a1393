from datetime import date, datetime

from pyspark.sql import functions as F

from noticeworks.functions import extract, text
from noticeworks.operators import feedback, listing, merge, state


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_rows_of_pages(spark):
    page = '<li><a href="/a">甲 项目</a><span>2026-06-01</span></li><li><a href="/b">乙</a><span>2026-05-01</span></li>'
    df = spark.createDataFrame([("s", 1, page, "o"), ("s", 2, "", "o"), ("t", 1, None, "o")], "section string, n int, html string, ord_ string")
    got = listing.listed_rows(df, "html", r'<a href="([^"]+)">([^<]*)</a><span>([\d-]+)</span>', ["url", "title", "day"])
    assert rows(got, "section", "ord", "url", "title", "day") == [("s", 0, "/a", "甲 项目", "2026-06-01"), ("s", 1, "/b", "乙", "2026-05-01")]


def test_cutoff_reads_the_last_page_to_its_end(spark):
    d = date
    df = spark.createDataFrame([("s", 1, d(2026, 6, 3)), ("s", 2, d(2026, 5, 1)), ("s", 2, d(2026, 6, 2)), ("s", 3, d(2026, 6, 1)), ("t", 9, d(2026, 6, 1)), ("t", 1, None)], "s string, page int, day date")
    got = listing.until_cutoff(df, ["s"], "page", "day", F.lit(d(2026, 6, 1)))
    assert rows(got, "s", "page", "day") == [("s", 1, d(2026, 6, 3)), ("s", 2, d(2026, 6, 2)), ("t", 1, None), ("t", 9, d(2026, 6, 1))]


def test_kinds_and_order(spark):
    df = spark.createDataFrame([(1, "变更公告", 5), (2, "招标公告", 9), (3, "中标公告", 1), (4, "更正公告", 2), (5, None, 1)], "id int, title string, time int")
    kind = listing.notice_kind(F.col("title"), ["变更", "更正"], ["公告"], ["中标"])
    assert rows(df.select("id", kind.alias("k")), "id", "k") == [(1, "change"), (2, "original"), (3, "ignored"), (4, "change"), (5, "ignored")]
    ordered = df.orderBy(*listing.processing_order(kind == "change", F.col("time"), F.col("id")))
    assert [r["id"] for r in ordered.collect()] == [2, 3, 5, 4, 1]


def test_public_item(spark):
    df = spark.createDataFrame([("2026年6月2日", "2026年6月9日 9时", "2026年6月2日至2026年6月5日 17:00", None, "", "摘要", " ")], "published_at string, bid_deadline string, registration_period string, date_basis string, source_name string, summary string, project_content string")
    r = listing.public_item(df, F.lit("host")).first()
    assert (r["published_at"], r["bid_deadline"], r["registration_period"], r["date_basis"], r["source_name"], r["project_content"]) == ("2026-06-02", "2026-06-09 09:00", "2026-06-02至2026-06-05 17:00", "official", "host", "摘要")


def test_refreshed(spark):
    old = spark.createDataFrame([(1, date(2026, 6, 1), "a"), (2, date(2026, 6, 28), "b"), (3, None, "c")], "id int, day date, v string")
    new = spark.createDataFrame([(1, date(2026, 7, 1), "A"), (2, date(2026, 7, 1), None), (4, None, "D")], "id int, day date, v string")
    assert rows(merge.refreshed(old, new, "id", "day", F.lit(date(2026, 7, 1))), "id", "v") == [(1, "a"), (2, None), (3, "c"), (4, "D")]


def test_reports_and_pending(spark):
    ev = spark.createDataFrame([(1, "u", 1, "confirm", None, None), (2, "u", 2, "correct", "buyer", "x"), (3, "w", 3, "exclude", None, None)], "event_id int, url string, place int, action string, field string, new_value string")
    assert rows(feedback.report(ev), "kind", "value", "rows") == [("action", "confirm", 1), ("action", "correct", 1), ("action", "exclude", 1), ("field", "buyer", 1)]
    assert rows(feedback.pending(ev, ev.where("event_id = 1").select("event_id")), "url", "status", "events", "fields") == [("u", None, 1, 1), ("w", "excluded", 1, 0)]


def test_cursors(spark):
    t = datetime
    cursors = spark.createDataFrame([("a", t(2026, 1, 1), t(2026, 1, 1), None)], "s string, last timestamp, weekly timestamp, monthly timestamp")
    runs = spark.createDataFrame([("a", "weekly", t(2026, 2, 1), True), ("a", "monthly", t(2026, 3, 1), False), ("b", "bootstrap", t(2026, 2, 2), True)], "s string, mode string, started timestamp, complete boolean")
    assert rows(state.advance_cursors(cursors, runs, "s"), "s", "last", "weekly", "monthly") == [("a", t(2026, 2, 1), t(2026, 2, 1), None), ("b", t(2026, 2, 2), t(2026, 2, 2), t(2026, 2, 2))]
    ids = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 1)], "s string, i int")
    assert rows(state.largest_kept(ids, "s", "i", 2), "s", "i") == [("a", 3), ("a", 4), ("b", 1)]


def test_parts_of_text(spark):
    df = spark.createDataFrame([("贵州省-遵义市-播州区",), ("播州区",), (None,)], "x string")
    parts = [tuple(r[0]) for r in df.select(extract.location_parts(F.col("x"), {"播州区": "遵义市"})).collect()]
    assert parts == [("贵州省", "遵义市", "播州区"), ("播州区", "遵义市", ""), ("", "", "")]
    who = extract.party(["采购人", "招标人"], "地址|联系|。")
    assert who.one("采购人：为某局 采购人：某市某局 地址：x") == "某市某局" and who.one(None) == ""
    page = "a<!-- hidden --><b>c</b><div id='m'>body</div>"
    assert text.data_text(page) == "a c body"
    got = spark.createDataFrame([(page, "报名时间：2026-06-01 起 2026-06-05 止")], "p string, t string").select(extract.between(F.col("p"), "<div[^>]*>", "</div>").alias("b"), extract.span(F.col("t"), r"(\d{4}-\d\d-\d\d) 起 (\d{4}-\d\d-\d\d) 止").alias("s")).first()
    assert (got["b"], got["s"]) == ("body", "2026-06-01至2026-06-05")
    names = spark.createDataFrame([("某工程公开招标公告", None), ("x公告", "项目名称：某某道路改造工程，地点")], "t string, b string").select(text.project_title(F.col("t"), F.col("b")).alias("n"))
    assert [r["n"] for r in names.collect()] == ["某工程", "某某道路改造工程"]


def test_details_from_a_table(spark):
    page = "<table><tr><td>招标人</td><td>某局</td></tr><tr><td>资金来源：</td><td>国债</td><td>金额</td><td>12.5</td></tr></table>"
    df = spark.createDataFrame([(page,)], "p string").select(text.table_rows_of("p").alias("r"))
    row = df.select(text.beside_label(F.col("r"), "招标人", "采购人").alias("buyer"), text.beside_label(F.col("r"), "资金来源").alias("fund"), text.beside_label(F.col("r"), "金额").alias("amount"), text.beside_label(F.col("r"), "没有").alias("none")).first()
    assert tuple(row) == ("某局", "国债", "12.5", "")
