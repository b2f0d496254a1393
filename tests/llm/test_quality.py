from noticeworks.llm.quality import text_quality

PROSE = "成交人须在2025年3月2日前把人脸识别闸机运抵怀茂翠客运站。临洛市西郊区居民431户受益，含塘虎虎农贸市场片区。利旧热镀锌护栏18组，新购154株；施工日志缺项时扣减15.8分。" * 3
CASES = [
    (1, PROSE, None), (2, "\n".join(PROSE[i : i + 26] for i in range(0, len(PROSE), 26)), None), (3, "\n".join(f"{n}、{s}。" for n, s in zip("一二三四五", PROSE.split("。"))), None),
    (4, "\n".join(f"{i}. 红叶石楠球；" for i in range(5)) + "\n6. 喷灌阀门\n7. 课桌椅", "list"), (5, "序号\t名称\t数量\n" + "\n".join(f"{i}\t雨水井盖\t{i * 7}" for i in range(9)), "table"),
    (6, "\n".join(f"{i} | 镀膜玻璃 | 26.5 |" for i in range(9)), "table"), (7, "\n".join(f"{i},喷灌阀门,WC-4517,{i},1513.89元" for i in range(9)), "table"),
    (8, "#~<|#{*%_$!{，_%&+/@:&@\\，+^*，{`&^!%!)；(:；@{}+@" * 3, "junk"), (9, "67GEGCWbKWANzpmJfRiKMqUPovGhdztFGSSQ+YiyzMJX5P36HLQJx8sEvYGKWX9Mn+E8FLR9Znsa\n" * 4, "junk"),
    (10, '<td class="x99"><span style="font:10px">&nbsp;</span></td>\n.c881{margin:9px;width:546px}\n' * 5, "junk"), (11, "折叠会议桌 " * 30 + "。", "junk"), (12, "锟斤拷烫烫烫屯屯" * 30, "junk"),
    (13, "è¿\x90è·\x9d24.4å\x85¬é\x87\x8cï¼\x8cå\x8d¸è\x87³" * 5, "junk"), (14, "泺歐咆趁豭貵霒鏹搢琭霼飾骸寡泖臸觽茭穬稬櫢噀笨迭" * 5, "junk"), (15, "", None), (16, None, None), (17, " \t\r\n ", None),
    (18, "The contractor keeps a copy of the bond until 23 January 2024. Offers that omit the test record are set aside by the buyer.\n" * 2 + "The contract runs 47 months and includes roof sealing.", None),
    (19, "\n".join(f"* water meters, {i}" for i in range(12)), "list"), (20, "和曦明产业园、\n洲福永苗圃、\n向昌平南街、\n庆迎潭社区", "list"), (21, "".join(f"第{i}批货物须在{i}日前运抵{i}号仓库，由使用部门登记。" for i in range(4000)), None), (22, PROSE * 300, "junk"),
]


def test_kinds_and_statistics(spark):
    common = spark.createDataFrame([("的", "zh"), ("须", "zh"), ("the", "en"), ("of", "en"), (None, None), ("", "zh")], "word string, lang string")
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in CASES] + [(1, PROSE, "clash")], "doc_id long, text string, kind string")
    rows = text_quality(docs, common).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(CASES) + 1
    for i, text, kind in CASES:
        assert got[i]["kind"] == kind, (i, (text or "")[:30], got[i])
    assert got[16]["word_count"] == 0 and got[16]["mean_word_length"] is None and "too few words" in got[16]["failures"]
    english = got[18]
    assert english["word_count"] == 57 and english["punct_line_share"] == 1.0 and english["common_share"] > 0.1
    assert got[4]["bullet_share"] == 1.0 and "bullet lines" in got[4]["failures"] and "list" in got[4]["failures"]
    assert text_quality(docs.where("false"), common).count() == 0
    assert text_quality(docs, common.where("false")).where("common_share > 0").count() == 0
