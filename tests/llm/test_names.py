import random

import numpy as np
import pytest

from noticeworks.llm import names
from noticeworks.llm.names import Metric, core, forms_of, link_names, padded, radius_join

REGISTER = [
    (1, "溪陵市农业农村局", "bureau", "溪陵", None), (2, "溪陵市林业局", "bureau", "溪陵", None), (3, "融宇（柏桐）交通投资有限责任公司", "company", "柏桐", "融宇交通"),
    (4, "禾川市第一中学", "institute", "禾川", None), (5, "云岭省博信电力设备股份有限公司", "company", "白荻", None), (6, "Grantley & Thornby Procurement Services Ltd.", "agency", "柏桐", None),
    (7, "云岭励信文化传媒有限公司石湾分公司", "company", "石湾", None), (8, "青芜市德越工程咨询集团有限责任公司", "agency", "青芜", "德越工程"), (9, None, None, None, None),
]
SCHEMA = "org_id long, name string, kind string, city string, short_name string"


def edit(a, b, metric):
    n = len(a), len(b)
    d = np.zeros((n[0] + 1, n[1] + 1), int)
    d[:, 0], d[0] = range(n[0] + 1), range(n[1] + 1)
    for i in range(1, n[0] + 1):
        for j in range(1, n[1] + 1):
            sub = int(metric.substitution(np.array([ord(a[i - 1])]), np.array([ord(b[j - 1])]))[0])
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + sub)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[-1, -1]


def test_metric_against_plain_loops():
    metric = Metric(frozenset("溪陵市农业农村局林融宇交通"))
    words = ["溪陵市农业农村局", "溪陵市林业局", "溪陵市农业农村菊", "溪林业局", "", "abc", "acb", "abd", "融容宇"]
    table, sizes = padded(words)
    for w in words:
        got = metric.distances(table, sizes, *padded([w], 9))
        assert got.tolist() == [edit(x, w, metric) for x in words]
    d = np.array([metric.distances(table, sizes, *padded([w], 9)) for w in words])
    assert (d == d.T).all() and all(d[i, j] <= d[i, k] + d[k, j] for i in range(9) for j in range(9) for k in range(9))


def test_cores():
    assert core(" 采购单位:溪陵市 农业​农村局（盖章） ") == "溪陵市农业农村局"
    assert core("GRANTLEY & THORNBY PROCUREMENT SERVICES LTD") == core("Grantley and Thornby Proc. Svcs Limited") == "grantley thornby procurement services"
    assert "农业局(溪陵市)" in [f for f, _, _ in forms_of(1, "溪陵市农业农村局", "bureau", "溪陵", None, ["云岭"])]


def test_links(spark):
    spellings = {
        1: ["溪陵农业农村局", "云岭省溪陵市农业局", "农业农村局（溪陵市）", "溪陵市农业农村菊", "招标人：溪陵市农业农村局", "溪陵市农业村农局", "溪︀陵市农业农村局"],
        3: ["融宇交通", "柏桐市融宇交通投资", "容宇（柏桐）交通投资有限责任公司", "融宇交通投资有限责任公司（柏桐）", "融宇(柏桐)交通投资（有限公司）"],
        4: ["禾川一中", "禾川市第一中学学", "云岭省禾川市第一中学(本级)"], 5: ["博信电力设备有限公司", "云岭省博信电力社备股份有限公司", "云岭省博信电力设备公司"],
        6: ["Thornby & Grantley", "Thhornby-Grantley Procurement Services", "Procurement Services Grantley & Thornby", "Thornby, Grantley & Co. Procurement Services"],
        7: ["石湾分公司（云岭励信文化传媒有限公司）", "云岭励信文化传媒石湾分公司"], 8: ["青芜德越工程咨询集团", "德越工程"],
        None: ["溪陵市水务局", "禾川市第二中学", "云岭省融信电力设备股份有限公司", "公告未载明", "Hollin & Tessaro Project Management Ltd.", "", None, "甲" * 30_000],
    }
    rows = [(i, v, v, org) for i, (org, v) in enumerate((o, v) for o, vs in spellings.items() for v in vs)]
    df = spark.createDataFrame(rows, "id long, buyer string, agency string, org_id long")
    register = spark.createDataFrame(REGISTER, SCHEMA)
    got = {(r["id"], r["field"]): r["org_id"] for r in link_names(df, register, "id", ["buyer", "agency"]).collect()}
    for i, value, _, org in rows:
        assert got.get((i, "buyer")) == org and got.get((i, "agency")) == org, value
    assert link_names(df.where("false"), register, "id", ["buyer"]).count() == 0
    assert link_names(df, register.where("false"), "id", ["buyer"]).count() == 0


def test_no_swap_is_pruned(spark):
    forms = ["望澜投资有限公司", "望澜投资(有限责任公司)", "望澜投资有限责任公司", "望澜投资有限责任公司望澜分公司", "溪陵市农业农村局", "农业农村局(溪陵市)", "溪陵农业局", "云岭省溪陵市农业农村局", "AC", "ABC"]
    swapped = sorted({f[:i] + f[i + 1] + f[i] + f[i + 2 :] for f in forms for i in range(len(f) - 1)} | {f[:i] + f[i + 1 :] for f in forms for i in range(len(f))})
    letters = frozenset("".join(forms))
    table, sizes = padded(forms)
    want = {(x, f, int(d)) for x in swapped for f, d in zip(forms, Metric(letters).distances(table, sizes, *padded([x]))) if d <= 1}
    side = lambda texts, name: spark.createDataFrame([(x,) for x in texts], f"{name} string")
    assert {tuple(r) for r in radius_join(side(swapped, "core"), side(forms, "form"), letters).collect()} == want


def test_equally_near_is_nobody(spark):
    register = spark.createDataFrame([(1, "甲乙丙丁局", "bureau", None, None), (2, "甲乙丙戊局", "bureau", None, None)], SCHEMA)
    df = spark.createDataFrame([(1, "甲乙丙菊局"), (2, "甲乙丙丁丁局")], "id long, buyer string")
    assert [(r["id"], r["org_id"]) for r in link_names(df, register, "id", ["buyer"]).collect()] == [(2, 1)]


def test_pivots_measure_by_a_metric():
    rng = random.Random(2)
    metric = Metric(frozenset("甲乙丙丁局"))
    words = sorted({"".join(rng.choices("甲乙丙丁局菊ab", k=rng.randint(0, 5))) for _ in range(120)})
    table, sizes = padded(words)
    d = np.array([metric.distances(table, sizes, *padded([w], 5), swaps=False) for w in words])
    near = np.array([metric.distances(table, sizes, *padded([w], 5)) for w in words])
    assert (d == d.T).all() and (np.diag(d) == 0).all() and (near <= d).all() and (d <= 2 * near).all()
    assert (d[:, None, :] <= d[:, :, None] + d[None, :, :]).all()


@pytest.mark.parametrize("part_names", [20_000, 7])
def test_radius_join_against_all_pairs(spark, monkeypatch, part_names):
    monkeypatch.setattr(names, "PART_NAMES", part_names)
    rng = random.Random(4)
    forms = sorted({"".join(rng.choices("甲乙丙丁戊己", k=rng.randint(3, 7))) for _ in range(150)} | {"甲乙戊", "甲丙乙戊"})
    typed = {"乙甲戊"}
    for f in forms:
        i = rng.randrange(len(f) - 1)
        typed |= {f[:i] + f[i + 1] + f[i] + f[i + 2 :], f[:i] + f[i + 1 :], f[:i] + "局" + f[i:], f[:i] + "x" + f[i + 1 :]}
    typed = sorted(typed)
    letters = frozenset("甲乙丙丁戊己")
    table, sizes = padded(forms)
    want = {(x, f, int(d)) for x in typed for f, d in zip(forms, Metric(letters).distances(table, sizes, *padded([x]))) if d <= 1}
    side = lambda texts, name: spark.createDataFrame([(x,) for x in texts], f"{name} string")
    got = [tuple(r) for r in radius_join(side(typed, "core"), side(forms, "form"), letters).collect()]
    assert set(got) == want and len(got) == len(want) and ("乙甲戊", "甲乙戊", 1) in want


def test_short_forms_are_met_whole(spark):
    register = spark.createDataFrame([(1, "甲乙局", "bureau", None, "甲乙")], SCHEMA)
    df = spark.createDataFrame([(1, "甲乙"), (2, "甲"), (3, "甲丙")], "id long, buyer string")
    assert [r["id"] for r in link_names(df, register, "id", ["buyer"]).collect()] == [1]
