from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from noticeworks.operators import feedback, linkage, merge, serve, state
from noticeworks.sources import documents, frontier, sheets


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 1, "n"), ("b", 1, "y"), ("b", 1, "y")], "k string, o int, v string")
    assert set(map(tuple, merge.last_wins(df, ["k"], ["o"]).collect())) == {("a", 2, None), (None, 1, "n"), ("b", 1, "y")}
    assert set(map(tuple, merge.first_wins(df, ["k"], ["o"]).collect())) == {("a", 1, "x"), (None, 1, "n"), ("b", 1, "y")}
    assert merge.last_wins(df.where("false"), ["k"], ["o"]).count() == 0


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id int, x string, y string")
    new = spark.createDataFrame([(2, "", "e"), (3, None, "f")], "id int, x string, y string")
    assert set(map(tuple, merge.field_merge(old, new, "id", ["x", "y"]).collect())) == {(1, "a", "b"), (2, "c", "e"), (3, None, "f")}
    assert set(map(tuple, merge.overlay(old, new, "id", ["x", "y"]).collect())) == {(1, "a", "b"), (2, "", "e"), (3, None, "f")}
    assert set(map(tuple, merge.union_last_wins(old, new, ["id"]).collect())) == {(1, "a", "b"), (2, "", "e"), (3, None, "f")}


def test_upsert_keeps_first_values(spark):
    old = spark.createDataFrame([("k", 1, "first", "old")], "key string, id int, title string, seen string")
    new = spark.createDataFrame([("k", 2, "second", "new"), ("n", 3, "third", "x")], "key string, id int, title string, seen string")
    assert rows(merge.upsert(old, new, "key", "id", ["seen"]), "key", "title", "seen") == [("k", "first", "new"), ("n", "third", "x")]


def test_best_and_latest(spark):
    df = spark.createDataFrame([(1, "t", "", "x"), (2, "t", "y", "x"), (3, "t", "z", "w")], "id int, t string, a string, b string")
    assert merge.best_record(df, F.col("t"), ["a", "b"], ["id"]).first()["id"] == 2
    latest = merge.latest_version(df, F.col("t"), ["id"]).first()
    assert (latest["id"], latest["versions"]) == (3, 3)


def test_changes(spark):
    base = spark.createDataFrame([("u", "b0", "d0"), ("v", "b1", "d1")], "url string, budget string, deadline string")
    changes = spark.createDataFrame([("u", 1, "b2", ""), ("u", 2, "", "d2"), ("gone", 3, "x", "x")], "url string, at int, budget string, deadline string")
    got = merge.apply_changes(base, changes, "url", ["budget", "deadline"], "at")
    assert set(map(tuple, got.collect())) == {("u", "b2", "d2", 2), ("v", "b1", "d1", None)}


def test_unseen_takes_nulls_as_equal(spark):
    a = spark.createDataFrame([(None, "x"), ("k", "y")], "k string, v string")
    assert rows(merge.unseen(a, a.where("k is null"), ["k"]), "v") == [("y",)]


def test_admission(spark):
    listing = spark.createDataFrame([("n",), ("f",), ("u",), ("d",)], "k string")
    processed = spark.createDataFrame([("f", "matched"), ("u", "unlinked_change"), ("d", "matched")], "k string, status string")
    failed = spark.createDataFrame([("f",), ("f",)], "k string")
    assert rows(state.to_process(listing, processed, failed, ["k"]), "k", "reason") == [("f", "retry"), ("n", "new"), ("u", "unlinked")]


def test_outcomes(spark):
    log = spark.createDataFrame([("a", 1, "failed"), ("a", 2, "matched"), ("a", 3, "failed"), ("a", 4, "failed"), ("b", 1, "failed"), ("b", 2, "matched")], "k string, at int, status string")
    assert rows(state.fold_outcomes(log, ["k"], "at"), "k", "status", "attempts", "first_failed_at") == [("a", "failed", 2, 3), ("b", "matched", 0, None)]


def test_prune_and_mark(spark):
    as_of = F.lit(date(2026, 7, 1))
    s = spark.createDataFrame([("a", date(2026, 6, 1), None), ("b", date(2026, 1, 1), None), ("c", None, None), ("d", None, date(2026, 6, 1))], "k string, released date, first_failed date")
    assert rows(state.pruned(s, as_of), "k") == [("a",), ("c",)]
    now = spark.createDataFrame([("a",), ("z",)], "k string")
    prev = spark.createDataFrame([("a", "2026-06-30")], "k string, new_on string")
    assert rows(state.mark_new(now, prev, "k", F.lit("2026-07-01")), "k", "new_on", "is_new") == [("a", "2026-06-30", False), ("z", "2026-07-01", True)]


def test_quota_and_frontier(spark):
    listing = spark.createDataFrame([("s", i, i == 3) for i in range(6)], "s string, i int, hit boolean")
    seen = state.quota(listing, "s", F.col("hit"), [F.asc("i")], 2)
    assert rows(seen.where("examined"), "i") == [(0,), (1,), (3,)]
    ids = spark.createDataFrame([("s", i) for i in (1, 2, 5, 30, 31)], "s string, i int")
    assert rows(state.frontier(ids, "s", "i", F.lit(0), 20), "i") == [(1,), (2,), (5,)]
    assert frontier.scan({1: "a", 2: "b", 30: "c"}, 0, 800, 20) == ([(1, "a"), (2, "b")], 2)


def test_verdicts(spark):
    ev = spark.createDataFrame(
        [(1, "u", 1, "confirm", None, None), (2, "u", 2, "correct", "buyer", "B"), (3, "w", 3, "exclude", None, None), (3, "w", 4, "exclude", None, None), (4, "x", 5, "confirm", None, None), (5, "x", 6, "exclude", None, None)],
        "event_id int, url string, place int, action string, field string, new_value string",
    )
    none = spark.createDataFrame([], "event_id int")
    fresh = feedback.fresh_events(ev, none)
    assert fresh.count() == 5
    standing = spark.createDataFrame([("w", "confirmed")], "url string, status string")
    assert rows(feedback.conflicts(ev, standing), "url", "why") == [("w", "against the standing verdict"), ("x", "both in one batch")]
    items = spark.createDataFrame([("u", "a"), ("w", "b"), ("n", "c")], "url string, buyer string")
    out = feedback.apply_verdicts(items, feedback.folded_verdicts(ev.where("url != 'x'")), feedback.folded_corrections(ev), ["buyer"])
    assert rows(out, "url", "buyer", "review_status") == [("n", "c", "review"), ("u", "B", "confirmed")]
    assert rows(feedback.restored(items.where("url = 'n'"), items), "url") == [("n",), ("u",), ("w",)]


def prepared(spark, records):
    return linkage.prepared(spark.createDataFrame(records, "id long, title string, project_name string, buyer string, content string, code string, approval string, published_at string"))


def test_linkage(spark):
    plan = [(1, "", "贵山县城市道路改造工程", "某某局", "修建道路和桥梁三千米并安装路灯若干以及绿化工程", "2405-520000-04-01-123456", "", "2026-05-01")]
    notices = [
        (10, "", "贵山县城市道路改造工程", "某某局", "", "", "", "2026-06-01"),
        (11, "", "贵山县城市道路改造工程（二标段）施工", "别的公司", "", "", "", "2026-06-01"),
        (12, "", "别的工程项目", "", "代码2405-520000-04-01-123456", "2405-520000-04-01-123456", "", "2026-06-01"),
        (13, "", "贵山县城市道路改造工程", "某某局", "", "", "", "2026-04-01"),
        (14, "", "全不相干的事", "", "", "", "", ""),
        (15, None, None, None, None, None, None, None),
    ]
    exact = linkage.linked(prepared(spark, plan), prepared(spark, notices), exact=True)
    met = linkage.linked(prepared(spark, plan), prepared(spark, notices))
    got = {r["notice_id"]: (r["confidence"], r["methods"], r["level"]) for r in exact.collect()}
    assert got[10] == (1.0, "name+buyer", "high") and got[12][:2] == (1.0, "code") and got[11][1] == "name"
    assert 13 not in got and 14 not in got and 15 not in got
    assert {r["notice_id"] for r in met.collect()} == set(got)
    best = linkage.best_links(exact)
    assert best.where("rank = 1").count() == 3


PLACES = "贵山县 云水市 石湾区 青芜市 禾川县 望澜市".split()


def linkage_cases():
    hot = [(100 + i, "", "贵山县城市道路改造工程", f"第{i}单位", "修建道路和桥梁三千米并安装路灯若干以及绿化工程", "C-77", "黔发改〔2024〕12号", "2026-06-01") for i in range(150)]
    other = [(300 + i, "", f"{PLACES[i % 6]}{chr(0x4E00 + 37 * i)}{chr(0x5E00 + 53 * i)}采购项目", f"局{chr(0x6E00 + 11 * i)}", f"采购{chr(0x6000 + 7 * i) * 9}设备以及安装{chr(0x7000 + 5 * i) * 9}服务", "", "", "2026-06-01") for i in range(60)]
    return hot, other


def all_links(spark, plans, notices, **more):
    return {(r["plan_id"], r["notice_id"]): tuple(r)[2:] for r in linkage.linked(prepared(spark, plans), prepared(spark, notices), **more).collect()}


def test_links_of_a_hot_project(spark):
    hot, other = linkage_cases()
    plans = [
        (1, "", "贵山县城市道路改造工程", "甲", "", "", "", "2026-05-01"), (2, "", "乙项目", "乙", "修建道路和桥梁三千米并安装路灯若干以及绿化工程", "", "", ""),
        (3, "", "丙项目", "丙", "", "c77", "", ""), (4, "", "丁项目", "丁", "", "", "黔发改〔2024〕12号", ""), (5, "", "城市道路改造工程", "戊", "", "", "", "2026-07-01"),
    ]
    got = all_links(spark, plans, hot + other)
    assert all((p, h[0]) in got for p in (1, 2, 3, 4) for h in hot) and not any(p == 5 for p, _ in got)
    assert got == all_links(spark, plans, hot + other, exact=True)


def test_links_by_every_evidence(spark):
    hot, other = linkage_cases()
    notices = other + [
        (1, "", "甲子河堤防加固", "某某县水务局有限公司", "", "", "", ""), (2, "", "乙丑道路", "某某县水务局第二分局", "", "", "", ""), (3, "", "丙寅桥梁", "水务", "", "", "", ""),
        (4, "", "天地玄黄宇宙洪荒", "", "", "", "", ""), (5, "", "己巳楼", "", "投资代码为2405520000040112的工程", "", "", ""), (6, "", "庚午馆", "公告未载明", "", "", "关于某某县城市道路立项的批复意见", ""),
        (7, "", "辛未站", "", "甲一乙二丙三丁四戊五己六庚七辛八壬九癸十子丑", "", "", ""), (8, "", "壬申厂", "公告未载明", "", "", "批复", ""),
    ]
    plans = [
        (11, "", "子项目甲", "某某县水务局", "", "", "", ""), (12, "", "天地玄黄宙宇洪荒", "", "", "", "", ""), (13, "", "丑项目乙", "公告未载明", "", "2405-520000-04-0112", "某某县城市道路立项的批复", ""),
        (14, "", "寅项目丙", "", "甲东乙西丙南丁北戊上己下庚左辛右壬前癸后子寅", "", "", ""),
    ]
    got = all_links(spark, plans, notices)
    assert {(11, 1), (11, 2), (11, 3), (12, 4), (13, 5), (13, 6), (13, 8), (14, 7)} <= set(got)
    assert got == all_links(spark, plans, notices, exact=True)


def test_watch_and_serve(spark):
    watch = spark.createDataFrame([("某市第一污水处理厂扩建工程",), ("",)], "project_name string")
    n = spark.createDataFrame([(1, "某市第一污水处理厂扩建工程招标公告", None), (2, "某市第一污水处理厂扩建工程监理服务", None), (3, "其他", None)], "id int, project_name string, title string")
    assert rows(linkage.watched(watch, n), "id", "confidence") == [(1, 1.0), (2, 0.96)]
    df = spark.createDataFrame([("b",), ("",), ("a",), (None,)], "d string")
    assert [r[0] for r in df.orderBy(*serve.blanks_last("d")).collect()][:2] == ["a", "b"]
    assert df.where(serve.full_text(["d"], " A ")).count() == 1


def test_workbook(spark, tmp_path):
    import zipfile

    book = tmp_path / "b.xlsx"
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>no</t></si><si><r><t>na</t></r><r><t>me</t></r></si></sst>")
        z.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet {main}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row><c r="A2"><v>1</v></c><c r="B2" t="inlineStr"><is><t>x</t></is></c><c r="C2" t="str"><v>u</v></c><c r="D2" t="b"><v>1</v></c></row>'
            f'<row><c r="D3"><v>2.5</v></c></row><row/></sheetData></worksheet>',
        )
    sheets.register(spark)
    df = spark.read.format("notice_xlsx").load(str(book))
    assert [r["cells"] for r in df.orderBy("row").collect()] == [["no", "name"], ["1", "x", "u", "true"], [None, None, None, "2.5"], []]
    assert rows(sheets.source_accounts(df), "source_no", "source_name", "url", "company") == [("1", "x", "u", "2.5"), ("1", "x", "u", "true")]
    assert sheets.below_header(df, "name").count() == 3
    with pytest.raises(ValueError):
        sheets.below_header(df, "nowhere")
    with pytest.raises(KeyError):
        list(sheets.read_workbook(str(book), "T"))


def test_documents(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a.json").write_text('{"updated_at": "x", "warnings": ["w"], "items": [{"url": "u", "contact": "c"}]}')
    (tmp_path / "b.json").write_text('{"items": [')
    item = T.StructType([T.StructField("url", T.StringType()), T.StructField("contact", T.StringType())])
    items, warnings = documents.payloads(spark, str(tmp_path), item)
    assert rows(items, "url", "ord") == [("u", 0)] and sorted(r["warning"] for r in warnings.collect()) == ["not readable", "w"]
    none, missing = documents.payloads(spark, str(tmp_path / "no.json"), item)
    assert none.count() == 0 and missing.first()["warning"] == "missing"
    out = str(tmp_path / "out")
    for _ in range(2):
        documents.replace_table(items.select("url", "contact"), out)
    assert spark.read.json(out).columns == ["url"] and spark.read.json(out).count() == 1
    (tmp_path / "k.txt").write_text("a, b，c、\n d")
    assert [r["keyword"] for r in documents.keywords(spark, str(tmp_path / "k.txt")).orderBy("ord").collect()] == ["a", "b", "c", "d"]
    ev = spark.createDataFrame([(7, 0, "e1", "confirm"), (7, 1, "e2", "exclude")], "issue int, place int, id string, action string")
    back = documents.issue_events(documents.issue_body(ev, "issue"))
    assert rows(back, "issue", "place", "id", "action") == [(7, 0, "e1", "confirm"), (7, 1, "e2", "exclude")]


def test_windows(spark):
    from noticeworks.functions.temporal import catch_up_window, collection_start

    t = datetime
    df = spark.createDataFrame([(1, None, None, None), (2, t(2026, 7, 1, 7), t(2026, 6, 30), t(2026, 6, 20)), (3, t(2026, 7, 1), t(2026, 6, 1), t(2026, 6, 20))], "id int, last timestamp, weekly timestamp, monthly timestamp")
    mode, start = collection_start(F.col("last"), F.col("weekly"), F.col("monthly"), F.lit(t(2026, 7, 1, 8)))
    got = {r[0]: (r[1], r[2]) for r in df.select("id", mode, start).collect()}
    assert got[1][0] == "bootstrap" and got[2] == ("incremental", t(2026, 7, 1, 1)) and got[3][0] == "weekly"
    gaps = spark.createDataFrame([(g,) for g in (0, 1, 9, 29, 30)], "g int")
    assert [r[0] for r in gaps.select(catch_up_window(F.col("g"))).collect()] == ["td", "l3d", "l10d", "l1m", "l3m"]


def test_watched_against_all_pairs(spark):
    import random
    from difflib import SequenceMatcher

    from noticeworks.functions.text import watch_name

    random.seed(9)
    signs = "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未"
    names = ["".join(random.choices(signs, k=random.randint(4, 24))) for _ in range(40)]
    for base in list(names):
        x = list(base)
        for _ in range(random.randint(1, 4)):  # letters put in here and taken out there leave no long common run
            x.insert(random.randrange(len(x)), random.choice(signs))
            x.pop(random.randrange(len(x)))
        names.append("".join(x) + random.choice(["", "招标公告", "工程" + base]))
    names += [None, "", names[0], names[0] + "公告"]
    notices = [(i, v if i % 3 else None, v, "clash") for i, v in enumerate(names)]
    df = spark.createDataFrame(notices, "id int, project_name string, title string, w_name string")
    watch = spark.createDataFrame([(x,) for x in names[::3]], "project_name string")
    want = set()
    for w in {watch_name(x) for x in names[::3]} - {""}:
        for i, v in enumerate(names):
            n = watch_name(v)
            if n and (w == n or (min(len(w), len(n)) >= 8 and (w in n or n in w)) or SequenceMatcher(None, w, n).ratio() >= 0.82):
                want.add((w, i, 1.0 if w == n else 0.96 if min(len(w), len(n)) >= 8 and (w in n or n in w) else round(SequenceMatcher(None, w, n).ratio(), 3)))
    assert {tuple(r) for r in linkage.watched(watch, df).collect()} == want and len(want) > 30
    assert linkage.watched(watch.where("false"), df).count() == 0 and linkage.watched(watch, df.where("false")).count() == 0


def test_common_in_order():
    import random

    import numpy as np

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    random.seed(3)
    for size in (3, 40, 70, 200):
        texts = [[random.randrange(9) for _ in range(random.randint(1, size))] for _ in range(30)]  # letter 9 is none
        mine = [[random.randrange(9) for _ in range(random.randint(1, size))] for _ in range(3)]
        masks, table = np.zeros((-(-size // 64), 3, 10), np.uint64), np.full((30, size), 9, np.int32)
        for k, x in enumerate(mine):
            for i, letter in enumerate(x):
                masks[i >> 6, k, letter] |= np.uint64(1 << (i & 63))
        for j, x in enumerate(texts):
            table[j, : len(x)] = x
        which, js = np.repeat(np.arange(3), 30), np.tile(np.arange(30), 3)
        want = np.array([longest(mine[k], texts[j]) for k, j in zip(which, js)])
        assert (linkage._common_in_order(masks, which, table[js], np.zeros(90, np.int64)) == want).all()
        least = want + np.array([random.randint(-2, 2) for _ in want])
        got = linkage._common_in_order(masks, which, table[js], least)
        assert ((got == want) | ((got == -1) & (want < least))).all() and (got < least)[want < least].all()


def test_values_of_notices_are_prepared_once_for_many_plans(spark):
    import pyarrow as pa

    plans, notices = spark.range(600).selectExpr("cast(id as string) AS p"), spark.range(50).selectExpr("cast(id as string) AS n")
    seen = linkage.compared(plans, notices, lambda left, right: pa.table({"rows": pa.array([right.num_rows], pa.int64())}), "rows long").collect()
    assert sum(r["rows"] for r in seen) == 50


def test_best_links_read_the_pairs_once(spark):
    rows = [(1, 10, "2026-01-02", 0.9, "high"), (2, 10, "2026-01-03", 0.88, "high"), (3, 10, None, 0.9, "high"), (4, 10, "2026-01-01", 0.8, "high"), (5, 11, "", 0.75, "high")]
    pairs = spark.createDataFrame(rows, "plan_id long, notice_id long, plan_published_at string, confidence double, level string")
    best = linkage.best_links(pairs.repartition(3, "plan_id"))
    got = sorted((r["notice_id"], r["rank"], r["plan_id"], r["candidates"], r["level"], r["primary"]) for r in best.collect())
    assert got == [(10, 1, 1, 3, "candidate", True), (10, 2, 3, 3, "candidate", False), (10, 3, 2, 3, "candidate", False), (11, 1, 5, 1, "high", True)]
    assert best._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def dated_cases():
    days = ["", "2025-12-31", "2026-01-15", "2026-01-16", "2026-02-01", "2026-03-09", "2027-01-01"]
    record = lambda i, k: (i, "", f"{PLACES[k % 3]}道路{k % 4}号改造采购项目", f"局{k % 5}", f"修建道路{k % 4}和桥梁三千米并安装路灯若干以及绿化工程{k % 3}", "C-7" if k % 9 == 0 else "", "", days[k % 7])
    return [record(i, i) for i in range(12)], [record(100 + i, 5 * i + 1) for i in range(90)]


@pytest.mark.parametrize("block, heads", [(4000, 100_000), (5, 0)])
def test_links_in_blocks_by_month_against_all_pairs(spark, monkeypatch, block, heads):
    plans, notices = dated_cases()
    monkeypatch.setattr(linkage, "NOTICE_BLOCK", block)
    monkeypatch.setattr(linkage, "HEADS", heads)
    got = all_links(spark, plans, notices)
    assert len(got) > 100 and got == all_links(spark, plans, notices, exact=True)


def test_plans_later_than_a_block_are_not_compared(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(linkage, "NOTICE_BLOCK", 20)
    plans = spark.createDataFrame([("早", "2026-01-01"), ("晚", "2026-06-01"), ("无", "")], "name string, day string")
    notices = spark.createDataFrame([(f"n{i}", f"2026-{1 + i % 9:02d}-02") for i in range(180)] + [("u", "~")], "name string, day string")
    near = lambda left, right: pa.table({"plans": pa.array([linkage._dated(left, right).num_rows]), "notices": pa.array([right.num_rows]), "last": pa.array([max(right.column("day").to_pylist())])})
    seen = linkage.compared(plans, notices, near, "plans long, notices long, last string").where("notices > 0").collect()
    assert sum(r["notices"] for r in seen) == 181 and {r["last"][5:7]: r["plans"] for r in seen if r["last"] != "~"} == {f"{m:02d}": 2 if m < 6 else 3 for m in range(1, 10)}


def test_ranges_hold_all_days(monkeypatch):
    monkeypatch.setattr(linkage, "NOTICE_BLOCK", 10)
    assert linkage._ranges([]) == [("", 0, 1)] and linkage._ranges([("", 35)]) == [("", 0, 4)]
    assert linkage._ranges([("2026-01", 4), ("2026-02", 7), ("2026-03", 25), ("2026-04", 1)]) == [("", 0, 2), ("2026-03", 2, 3), ("2026-04", 5, 1)]


def test_known_heads_are_met_in_tasks(spark):
    inner, outer = spark.createDataFrame([("甲乙",), ("𠀀丙丁",), ("x" * 40,)], "p_value string"), spark.createDataFrame([("子甲乙丑𠀀丙丁",), ("y" + "x" * 41,), ("x" * 39,)], "n_value string")
    met = linkage.contained(inner, outer, "p_value", "n_value")
    assert sorted(tuple(r) for r in met.collect()) == sorted([("甲乙", "子甲乙丑𠀀丙丁"), ("𠀀丙丁", "子甲乙丑𠀀丙丁"), ("x" * 40, "y" + "x" * 41)])
    assert "Generate" not in met._jdf.queryExecution().optimizedPlan().toString()


def test_best_links_prepare_every_notice_once(spark, data, monkeypatch):
    from noticeworks.plans import states

    calls, whole = [], linkage.prepared
    monkeypatch.setattr(linkage, "prepared", lambda df: calls.append(1) or whole(df))
    states.plan_notice_best(spark, data)
    assert len(calls) == 1
