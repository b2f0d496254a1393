from noticeworks.llm.looks import Reader, folded, lattice, look_classes, one_form, same_look


def test_folding():
    assert folded("ＰＰＰ（二次）　x y") == "PPP(二次) x y"
    assert folded("公︁开​招­标⁠") == "公开招标"
    assert folded("⼯⾷⻋⺠路年") == "工食车民路年"
    assert folded("m²㎡①½№Ⅲ") == "m²㎡①½№Ⅲ"  # raised, circled and one-character signs stay
    assert folded("") == "" and folded("é") == "é"


def test_lattice_is_the_same_for_all_spellings():
    assert lattice("KOPAX") == lattice("КОРАХ") == lattice("ΚΟΡΑΧ")
    reader = Reader({"^K": 5, "KO": 5, "OP": 5, "PA": 5, "AX": 5, "X$": 5, "^В": 9, "Во": 9, "ос": 9, "сх": 9, "хо": 9, "од": 9, "д$": 9})
    assert {reader.one_form(x) for x in ("KOPAX", "КОРАХ", "KОPAХ")} == {"KOPAX"}
    assert {reader.one_form(x) for x in ("Восход", "Bocxoд", "Вοсход")} == {"Восход"}
    assert reader.one_form("Å") == reader.one_form("А̊")
    assert reader.one_form("Norvik") != reader.one_form("Nørvik")


def test_same_look(spark):
    rows = [
        (1, "PPP项目", "甲局"), (2, "ＰＰＰ项目", "甲局"), (3, "PPP项目", "甲​局"), (4, "PPP项目", "甲局"), (5, "PPP 项目", "甲局"), (6, "m2", "甲局"), (7, "m²", "甲局"),
        (8, None, "甲局"), (9, "", "甲局"), (10, "Ｐ", None), (11, "x" * 50_000, "乙"), (12, "x" * 49_999 + "ｘ", "乙"),
    ]
    df = spark.createDataFrame([(*r, "look") for r in rows], "id long, title string, buyer string, look string")
    got = sorted(tuple(r) for r in same_look(df, "id", ["title", "buyer"]).collect())
    assert got == [(1, 2), (1, 3), (2, 3), (2, 4), (3, 4), (11, 12)]
    assert same_look(df.where("false"), "id", ["title", "buyer"]).count() == 0
    assert one_form(df, ["title"]).where("title is null and title_form is null").count() == 1
    links = {}
    for a, b in got:
        links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
    classes = {r["id"]: r for r in look_classes(df, "id", ["title", "buyer"]).collect()}
    assert {i: r["links"] for i, r in classes.items()} == links
    assert classes[4]["class_id"] == classes[1]["class_id"] == 1 and classes[2]["class_id"] == 2 and classes[3]["look_id"] == 1 and classes[12]["look_id"] == 11


def test_many_equal_rows_and_one_other(spark):
    rows = spark.range(5000).selectExpr("id", "if(id = 77, 'Ａ标', 'A标') as title", "'甲' as buyer")
    assert same_look(rows, "id", ["title", "buyer"]).count() == 4999
