import random

from noticeworks.llm import leaks


def brute(text, items, least):
    grams = {text[i : i + least] for i in range(len(text) - least + 1)}
    return {k for k, t in items if any(t[i : i + least] in grams for i in range(len(t) - least + 1))}


def test_detector_against_brute_force():
    random.seed(4)
    for _ in range(40):
        alphabet = random.choice(["ab", "abc", "abcdefgh"])
        least = random.choice([4, 5, 9, 12])
        items = [(k, "".join(random.choices(alphabet, k=random.randint(0, 60)))) for k in range(8)]
        items.append((9, items[0][1]))
        detector = leaks.Detector(items, least)
        for _ in range(20):
            text = "".join(random.choices(alphabet, k=random.randint(0, 120)))
            if random.random() < 0.7:
                source = random.choice(items)[1]
                at = random.randrange(len(source) + 1)
                text += source[at : at + random.randint(0, 30)] + "".join(random.choices(alphabet, k=5))
            assert detector.leaked(text) == brute(text, items, least)
            covered = {i for s, e in detector.spans(text) for i in range(s, e)}
            wanted = {i for p in range(len(text) - least + 1) if any(text[p : p + least] in t for _, t in items) for i in range(p, p + least)}
            assert covered == wanted


def test_leaks_and_removal(spark):
    random.seed(5)
    item = "".join(chr(0x4E00 + random.randrange(5000)) for _ in range(60))
    wide = "Ｑuestion１２３" + item
    docs = [(1, "前文。" + item[:45] + "，后文" + "甲" * 200), (2, item[:39] + "断" + item[39:]), (3, None), (4, ""), (5, "，".join(item)), (6, "question123" + item[:29]), (7, "无关" * 30_000 + item)]
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int")
    i = spark.createDataFrame([(10, wide), (11, None), (12, ""), (13, "短")], "item_id long, text string")
    assert sorted(tuple(r) for r in leaks.find_leaks(d, i).collect()) == [(1, 10), (5, 10), (6, 10), (7, 10)]
    out = {r["doc_id"]: r for r in leaks.remove_leaks(d, i).collect()}
    assert out[1]["action"] == "cut" and out[1]["text"] == "前文。，后文" + "甲" * 200 and out[1]["leaked_chars"] == 45
    assert out[5]["action"] == "drop" and out[5]["text"] is None and out[2]["action"] == "keep" and out[3]["text"] is None
    assert leaks.find_leaks(d, i.where("false")).count() == 0 and leaks.find_leaks(d.where("false"), i).count() == 0


def test_parts_of_items_give_the_same(spark, monkeypatch):
    random.seed(6)
    items = [(k, "".join(chr(0x4E00 + random.randrange(900)) for _ in range(70))) for k in range(12)]
    docs = [(n, "".join(random.choice(items)[1][random.randrange(20) :] + "间隔文字" * random.randint(0, 20) for _ in range(random.randint(0, 3)))) for n in range(40)]
    docs.append((0, docs[0][1]))  # a repeated row
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, leaks.remove_leaks(d, i).collect()), key=str)
    found = sorted(map(tuple, leaks.find_leaks(d, i).collect()))
    monkeypatch.setattr(leaks, "PART_CHARS", 200)
    assert len(leaks.item_parts(i, "item_id", "text")) > 2
    assert sorted(map(tuple, leaks.remove_leaks(d, i).collect()), key=str) == whole and {r[4] for r in whole} == {"keep", "cut", "drop"}
    assert sorted(map(tuple, leaks.find_leaks(d, i).collect())) == found
    assert {r[0] for r in whole if r[4] != "keep"} == {x[0] for x in found}
    assert leaks.remove_leaks(d, i.where("false")).where("action = 'keep'").count() == 41


def test_sigma_is_one_letter(spark):
    word = "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣ"
    d = spark.createDataFrame([(1, f"{word} {word} {word}. " + "x" * 200)], "doc_id long, text string")
    i = spark.createDataFrame([(2, f"{word}{word}{word}")], "item_id long, text string")
    assert leaks.find_leaks(d, i).count() == 1
    assert leaks.remove_leaks(d, i).first()["action"] == "cut"
