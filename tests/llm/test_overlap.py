import os
import random
from fractions import Fraction

import numpy as np
import pytest

from noticeworks import runtime
from noticeworks.llm import overlap


@pytest.mark.parametrize("seed", range(12))
def test_search_against_brute_force(seed):
    random.seed(seed)
    t = random.choice([Fraction(3, 5), Fraction(4, 5), Fraction(1, 2)])
    size = random.choice([6, 12, 40, 300])
    sets = []
    for _ in range(random.randint(1, 60)):
        if sets and random.random() < 0.5:
            s = set(random.choice(sets)) ^ {random.randrange(size) for _ in range(random.randint(0, 4))}
        else:
            s = {random.randrange(size) for _ in range(random.choice([1, 2, 3, 10, 60, 150]))}
        sets.append(s or {1})
    tokens = np.concatenate([np.array(sorted(s)) for s in sets])
    found = [(min(a, b), max(a, b)) for x, y in overlap.search(np.array([len(s) for s in sets]), tokens, t) for a, b in zip(x.tolist(), y.tolist())]
    expected = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if Fraction(len(sets[i] & sets[j]), len(sets[i] | sets[j])) >= t}
    assert set(found) == expected


def texts(n):
    random.seed(n)
    words = ["".join(random.choices("甲乙丙丁戊己庚辛壬癸子丑寅卯", k=3)) for _ in range(60)]
    out = []
    for i in range(n):
        if i % 3 and out:
            base = list(random.choice(out))
            for _ in range(random.randint(0, 6)):
                base[random.randrange(len(base))] = random.choice("金木水火土Ab1")
            out.append("".join(base))
        else:
            out.append("".join(random.choices(words, k=random.randint(8, 20))))
    return out


def test_tokens_keep_sizes_and_overlaps(monkeypatch):
    monkeypatch.setattr(overlap, "_mixed", lambda g: (g.view(np.uint64) % np.uint64(7)) << np.uint64(33))  # nearly all fall together
    words = [t for t in texts(12)]
    shard, record, token = overlap.dealt_sets(words, 1)
    sets = [set(token[record == i].tolist()) for i in range(12)]
    for i in range(12):
        assert len(sets[i]) == len(overlap.grams_of(words[i]))
        for j in range(i):
            assert len(sets[i] & sets[j]) >= len(np.intersect1d(overlap.grams_of(words[i]), overlap.grams_of(words[j])))


@pytest.mark.parametrize("task_records", [1000, 60])
def test_pairs_against_brute_force(spark, task_records):
    rows = [(i, t) for i, t in enumerate(texts(120))]
    records = overlap.bare_records(spark.createDataFrame(rows, "id long, t string"), "id", ["t"])
    got = {(r["a"], r["b"]) for r in overlap.candidates(records, task_records=task_records).collect()}
    expected = {(i, j) for i, a in rows for j, b in rows if i < j and overlap.similarity(overlap.bare(a), overlap.bare(b)) >= 0.6}
    assert expected and expected <= got


def test_similar_pairs(spark):
    long = "".join(chr(0x4E00 + i % 5000) for i in range(40_000))
    rows = [
        (1, "标题", "名称", "内容一二三四五六七八九十"), (2, "标题", "名称", "内容，一二三四五六七八九十！"), (3, "标 题", None, "名称内容一二三四五六七八九十"), (4, "完全", "不同", "的另一件事情"),
        (5, None, None, "ab"), (6, None, None, None), (7, "x", "y", long), (8, "x", "z", long), (4, "完全", "不同", "的另一件事情"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "notice_id long, title string, project_name string, project_content string, set int")
    got = sorted((r["id_a"], r["id_b"], round(r["similarity"], 3)) for r in overlap.similar_pairs(df, "notice_id", ["title", "project_name", "project_content"]).collect())
    assert got[:3] == [(1, 2, 1.0), (1, 3, 1.0), (2, 3, 1.0)] and [(a, b) for a, b, _ in got[3:]] == [(7, 8)]
    assert overlap.similar_pairs(df.where("false"), "notice_id", ["title"]).count() == 0
    assert overlap.bare("Ａ-b ² É_1!") == "ａb²é1"


def test_groups(spark):
    rows = [(i, t) for i, t in enumerate(texts(60))] + [(100, texts(60)[0]), (101, texts(60)[0]), (102, None)]
    df = spark.createDataFrame(rows, "id long, t string")
    pairs = [tuple(r) for r in overlap.similar_pairs(df, "id", ["t"]).select("id_a", "id_b").collect()]
    links, root = dict.fromkeys((i for i, t in rows if t), 0), {i: i for i, t in rows if t}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    for _ in range(60):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = overlap.similar_groups(df, "id", ["t"]).collect()
    assert {r["id"]: (r["links"], r["group_id"]) for r in got} == {i: (links[i], root[i]) for i in links}
    assert {r["class_id"] for r in got if r["id"] in (0, 100, 101)} == {0}


def test_cells_hold_few_copies_and_lose_nothing():
    random.seed(5)
    base = [random.sample(range(4000), 16) for _ in range(80)]
    sets = [sorted(set(random.choice(base)) ^ set(random.sample(range(4000), random.randint(0, 4)))) for _ in range(200)]
    sizes, tokens = np.array([len(s) for s in sets]), np.concatenate(sets)
    weight = np.bincount(tokens, minlength=4096)
    place, record = overlap._Sets(sizes, tokens, weight).visits(overlap.SIMILARITY, 1000)
    assert np.bincount(record).max() <= 10 and (np.diff(place) >= 0).all()  # pairs of tokens fell into 45 cells and more
    found = lambda cell: {(a, b) for x, y in overlap.search(sizes, tokens, overlap.SIMILARITY, weight, cell) for a, b in zip(x.tolist(), y.tolist())}
    whole = found(None)
    assert len(whole) > 100 and set().union(*[found((c, 7)) for c in range(7)]) == whole


def test_packed_tokens():
    for tokens in ([], [0, 5, (1 << 24) - 1], [1, 1 << 24]):
        data = overlap._packed(np.array(tokens, np.int64))
        assert overlap._unpacked(data, len(tokens)).tolist() == tokens


def test_nothing_is_left_of_dealt_shards(spark):
    before = set(runtime.names_in(spark, os.path.dirname(runtime.scratch_path(spark, "x"))))
    df = spark.createDataFrame(list(enumerate(texts(120))), "id long, t string")
    overlap.candidates(overlap.bare_records(df, "id", ["t"]), task_records=60)
    left = set(runtime.names_in(spark, os.path.dirname(runtime.scratch_path(spark, "x")))) - before
    path = os.path.dirname(runtime.scratch_path(spark, "x")).removeprefix("file://")
    assert not any(f.endswith(".parquet") for x in left if x.startswith(("dealt", "met")) for _, _, files in os.walk(os.path.join(path, x)) for f in files)
    assert any(x.startswith("pairs") for x in left)


@pytest.mark.parametrize("entries", [50, 1_000_000])
def test_long_lists_are_divided_and_lose_nothing(monkeypatch, entries):
    random.seed(8)
    sets = [set(random.sample(range(120), random.randint(3, 16))) for _ in range(400)]
    sets += [set(random.choice(sets)) ^ set(random.sample(range(120), random.randint(0, 3))) for _ in range(200)] + [set(range(12)) | {i % 5 + 20} for i in range(40)]
    sets = [s or {1} for s in sets]
    sizes, tokens = np.array([len(s) for s in sets]), np.concatenate([sorted(s) for s in sets])
    expected = {(i, j) for i in range(len(sets)) for j in range(i) if Fraction(len(sets[i] & sets[j]), len(sets[i] | sets[j])) >= overlap.SIMILARITY}
    compared = []
    count = np.bitwise_count
    monkeypatch.setattr(overlap, "ENTRIES", entries)
    monkeypatch.setattr(np, "bitwise_count", lambda x: compared.append(len(x)) or count(x))
    costs = []
    for deeper in (10**9, 0):
        monkeypatch.setattr(overlap, "DEEPER", deeper)
        compared.clear()
        for how in ((None, None), (np.bincount(tokens), 3)):
            cells = range(how[1] or 1)
            pairs = [p for c in cells for p in overlap.search(sizes, tokens, overlap.SIMILARITY, how[0], how[1] and (c, how[1]))]
            assert {(max(a, b), min(a, b)) for x, y in pairs for a, b in zip(x.tolist(), y.tolist())} == expected
        costs.append(sum(compared))
    assert costs[1] * 2 < costs[0]


def test_ordered_sets_are_taken_as_they_come():
    random.seed(9)
    sets = [random.sample(range(60), random.randint(2, 12)) for _ in range(300)]
    sizes, tokens = np.array([len(s) for s in sets]), np.concatenate(sets)
    weight = np.bincount(tokens)
    sorted_ = np.concatenate([sorted(s, key=lambda k: (weight[k], k)) for s in sets])
    found = lambda *how, **more: {(a, b) for x, y in overlap.search(*how, **more) for a, b in zip(x.tolist(), y.tolist())}
    assert found(sizes, sorted_, overlap.SIMILARITY, ordered=True, cell=(1, 2)) == found(sizes, tokens, overlap.SIMILARITY, weight, (1, 2))
