from pyspark.sql import functions as F

from noticeworks.functions import amounts, classify, extract, temporal, text, urls


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


def test_clean_text(spark):
    assert one(spark, text.clean_text, "  a　  b\n\tc ") == "a b c"
    assert one(spark, text.clean_text, None) == ""


def test_plain_text_and_lines(spark):
    assert one(spark, text.plain_text, "<p>a&nbsp;&amp;<b>b</b></p>") == "a & b"
    assert one(spark, lambda c: text.plain_text(c, text.all_entities), "x&eacute;&#20013;") == "xé中"
    assert one(spark, text.block_lines, "<div>a</div><p> b<br>c </p>\n\n") == ["a", "b", "c"]


def test_titles_and_signatures(spark):
    assert one(spark, text.normalized_title, "【A-b】（二次） X") == "ab二次 x"
    df = spark.createDataFrame([(["b", "a", "a"], ["a", "b"])], "x array<string>, y array<string>")
    row = df.select(text.keyword_signature("x").alias("a"), text.keyword_signature("y").alias("b")).first()
    assert row["a"] == row["b"]


def test_canonical_url(spark):
    assert one(spark, urls.canonical_url, "HTTPS://Example.com/a/?utm_source=x&b=2&a=1#top") == "https://example.com/a?a=1&b=2"
    assert one(spark, urls.canonical_url, None) == ""


def test_same_page(spark):
    pages = ["http://H.example:80/x%2Dy/?utm_source=a&b=1&a=%e5%85%ac", " https://h.example/x-y?a=%E5%85%AC&b=1#top", "https://h.example/x-y/?spm=1&a=公&b=1"]
    forms = {one(spark, urls.same_page_form, p) for p in pages}
    assert len(forms) == 1
    assert one(spark, urls.same_page_form, "https://h.example/x%2Fy") != one(spark, urls.same_page_form, "https://h.example/x/y")
    assert one(spark, urls.same_page_form, "not an address") is None
    assert one(spark, urls.fingerprint_form, " SHA256:" + "Ab" * 32 + " ") == "ab" * 32
    assert one(spark, urls.fingerprint_form, "ab" * 31) is None


def test_names():
    assert text.link_name("A项目（一标段）招标公告") == "a项目"
    assert text.watch_name("X项目招标计划") == "x项目"  # the shorter ending comes first in this list
    assert text.link_name("X项目招标计划") == "x"
    assert text.shown_name("Ａ　B  项目") == "A B 项目"
    assert text.link_buyer("某某股份有限公司") == "某某"
    assert text.link_text("A-1，中文！") == "a1中文"


def test_tables(spark):
    page = "<table><tr><td>项目名称：</td><td>甲<br>乙</td></tr><tr><th></th></tr><tr><td>预算</td></tr></table>"
    assert text.table_rows(page) == [["项目名称：", "甲 乙"], ["预算"]]
    df = spark.createDataFrame([(page,), (None,)], "p string").select(text.table_rows_of("p").alias("r"))
    got = [r[0] for r in df.select(text.beside_label(F.col("r"), "项目名称")).collect()]
    assert got == ["甲 乙", ""]


def test_dates(spark):
    date = lambda v: one(spark, temporal.normalize_date, v)
    assert date("2026年6月2日 9:05") == "2026-06-02"
    assert one(spark, lambda c: temporal.normalize_date(c, True), "2026年6月2日 9:5") == "2026-06-02 09:05"
    assert date("'2026-06-20T10:00'") == "2026-06-20"
    assert date("2026.06.20") == "2026-06-20"
    assert date("06-20") == "06-20" and date(None) == ""
    assert one(spark, temporal.date_part, "on 2026-6-1") == ""
    assert one(spark, temporal.date_part, "on 2026-06-31") == ""
    assert one(spark, temporal.date_part, "on 2026-06-30.") == "2026-06-30"
    assert one(spark, temporal.serial_date, "46043") == "2026-01-21"
    assert one(spark, temporal.serial_date, "46043.5") == "2026-01-21 12:00"
    assert one(spark, temporal.serial_date, " n/a ") == "n/a"
    assert one(spark, temporal.epoch_local, 1784217600000, "bigint") == "2026-07-17 00:00:00"
    assert one(spark, temporal.compact_date_text, "2 0 26 年 6 月 1 日") == "2026年6月1日"


def test_amounts(spark):
    assert one(spark, lambda c: amounts.labelled_amount(c, ["预算金额"]), "预算金额：1,200.5 万元。") == "1,200.5万元"
    assert one(spark, amounts.scaled_amount, 1234567.0, "double") == "123.457万元"
    assert one(spark, amounts.scaled_amount, 900.0, "double") == "900元"
    assert one(spark, amounts.with_unit, "12.5") == "12.5万元"
    assert one(spark, amounts.with_unit, "面议") == "面议"


def test_labels(spark):
    words = classify.words_literal(["B", "a", "x"])
    assert one(spark, lambda c: classify.keyword_hits(c, words), "ab") == ["B", "a"]
    assert one(spark, lambda c: classify.region_status(c, ["甲"], ["乙"]), "甲乙") == "excluded"
    rules = [("one", "a"), ("two", "b")]
    tags = lambda v: one(spark, lambda c: classify.ordered_tags(c, rules, "other", "none"), v)
    assert tags("ba") == ["one", "two"] and tags("c") == ["other"] and tags(" ") == ["none"] and tags(None) == ["none"]


def test_sections(spark):
    longest = extract.longest_section("资格要求[:：]", "三、")
    assert longest.one("资格要求：short 三、 资格要求：a longer section here 三、 x") == "a longer section here"
    assert longest.one(None) == ""
    valid = extract.first_valid_section(["项目内容[:：]", "采购内容[:：]"], "二、", "预算", near="项目概况")
    assert valid.one("项目内容：详见附件 二、 采购内容：修建道路和桥梁 二、") == "修建道路和桥梁"
    lines = lambda v: one(spark, lambda c: extract.section_of_lines(F.split(c, "\\|"), "内容", "联系"), v)
    assert lines("x|项目内容：a|b|联系人|c") == "a b" and lines("x") == ""
    assert one(spark, lambda c: extract.distinct_matches(c, "[A-Z]\\d", "A"), "A1 B2 A1 B2") == ["1", "B2"]
