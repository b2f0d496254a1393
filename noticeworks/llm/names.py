"""Variant spellings of organisation names linked to the register (problem 5), by metric-space partitioning.

Typed names are stripped of look-alikes, roles and seals; registered names are written out in the forms people use (short
legal form, moved or dropped place, usual abbreviations, turned partners). Forms are assigned to the nearest pivot; a typed
name goes to every cell and ring that the triangle inequality cannot rule out, and inside a cell all pairs within the
radius are found by an edit metric: insertion, deletion and swap of neighbours cost 1, substitution 1 where it is a slip
(a character no registered name has, or one of like sound, or between Latin letters) and else 2.

Defined results: null and empty names mean nobody; a name with two equally near organisations means nobody; equal typed
names are looked up once; an empty register or table gives an empty result; names of any length are compared whole; forms
of one or two characters mean an organisation only as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import written
from .looks import CLASSES, folded

#: Edits at most between a typed name and a form of a registered one.
RADIUS = 1
#: Pivots at least and at most (one for FORMS_PER_PIVOT forms), and the forms they are chosen from at most (the smallest by hash: a
#: bounded sample, only speed depends on it).
PIVOTS, MOST_PIVOTS, FORMS_PER_PIVOT, PIVOT_SAMPLE = 12, 96, 20_000, 1500
#: Typed names of one cell and ring that a task compares at most, on average; more are dealt out, each part with all forms.
PART_NAMES = 20_000
#: Forms shorter than this mean an organisation only as they are: an edit would leave too little of them.
SHORTEST_NEAR = 3
#: Resolved names that may be broadcast; more are joined by shuffle.
BROADCAST_NAMES = 100_000

# Usual abbreviations of offices and institutes.
SHORT = {
    "教育和体育局": ["教体局", "教育局"], "交通运输局": ["交通局", "交运局"], "公共资源交易中心": ["交易中心", "公资中心"], "农业农村局": ["农业局", "农村局"],
    "城市管理综合执法局": ["城管局", "执法局", "城市管理局"], "市场监督管理局": ["市监局", "市场监管局"], "住房和城乡建设局": ["住建局", "建设局"],
    "卫生健康局": ["卫健局"], "应急管理局": ["应急局"], "妇幼保健院": ["妇幼院", "妇保院"], "职业技术学院": ["职院", "职技院"], "自然资源和规划局": ["自规局", "资规局"],
    "生态环境局": ["环境局"], "文化广电旅游局": ["文旅局", "文广旅局"], "发展和改革局": ["发改局"], "人力资源和社会保障局": ["人社局"], "水利局": [],
}
# Latin abbreviations and words that say nothing of the name.
LATIN_WORDS = {
    "proc": "procurement", "svcs": "services", "svc": "services", "eng": "engineering", "engg": "engineering", "consult": "consulting", "cons": "consulting",
    "proj": "project", "mgmt": "management", "mgt": "management", "and": "", "co": "", "ltd": "", "limited": "", "inc": "", "company": "",
}
# Characters of like sound that are typed for each other.
LIKE_SOUND = (
    "局菊 限线 育玉 理里 管官 资姿 责则 院苑 招昭 代带 林琳 程呈 设社 询寻 恒横 医依 科棵 健键 泓洪 睿锐 园圆 融容 旭序 利立 诺糯 康慷 营莹 捷杰 诚成 备倍 沃握 "
    "政证 隆龙 督都 邦帮 远愿 监鉴 瀚翰 冠贯 腾藤 岳悦 耀曜 骏俊 卓桌 启起 晟胜 峰锋 辰晨 铭名 鼎顶 泽则 弘宏 达答 务物 输书 源原 佳嘉 创闯 维唯 亿忆 赢盈 "
    "翔祥 凯楷 拓托 众重 基机 德得 励力 汇会 君军 迅讯 景井 衡横 智志 星兴 信芯 博伯 澎彭 和合 正政 通同 业叶 宇雨 越悦"
).split()

# Numbers and directions, which tell names apart also where no registered name has them.
TELLING = "零一二三四五六七八九十百千0123456789东南西北中上下左右大小新老甲乙丙丁"

_ROLE = re.compile(r"^(?:采购单位|采购人|招标人|招标单位|建设单位|业主单位|业主|代理机构|招标代理机构|采购代理机构|代理|甲方|委托单位|发包人)[:： ]*(?=.{2})")
_SEAL = re.compile(r"(?:[(（](?:盖章|公章|本级|签章)[)）]|招标办|采购办|[。.．;；,，、]|\s)+$")
_LATIN_TEXT = re.compile(r"[A-Za-z]{3}")
_LATIN_LIKE = {ord(ch): group[0] for group in CLASSES for ch in group[1:]}
_FORM = re.compile(r"^(.+?)(集团)?(股份有限公司|有限责任公司|有限公司)(?:(.{2,4}?)分公司)?$")


def core(name: str) -> str:
    """A typed or registered name without look-alikes, role, seal, spaces and, if Latin, case and empty words."""
    text = folded(name)
    text = re.sub(r"\s+", " ", text).strip()
    text = _SEAL.sub("", _ROLE.sub("", text))
    plain = text.translate(_LATIN_LIKE)
    if _LATIN_TEXT.search(plain):
        words = re.sub(r"[^0-9A-Za-zÀ-ɏ一-鿿']+", " ", plain).lower().split()
        return " ".join(w for w in (LATIN_WORDS.get(w, w) for w in words) if w)
    return text.replace(" ", "").replace("（", "(").replace("）", ")")


_NUMBER = re.compile(r"^第([一二三四五六七八九十]+)(人民医院|中学|小学|幼儿园)$")


def _office_forms(place: str, office: str, provinces: list[str]) -> dict[str, int]:
    names = [office, *SHORT.get(office, [])]
    numbered = _NUMBER.match(office)
    if numbered:
        names += {"人民医院": [f"{numbered[1]}医院", f"{numbered[1]}院"], "中学": [f"{numbered[1]}中"], "小学": [f"{numbered[1]}小"], "幼儿园": [f"{numbered[1]}幼"]}[numbered[2]]
    forms: dict[str, int] = {}
    for i, n in enumerate(names):
        level = min(i, 1)
        for p in (f"{place}市", place, *[f"{v}省{place}{s}" for v in provinces for s in ("市", "")]):
            forms.setdefault(f"{p}{n}", level)
        for p in (f"{place}市", place):
            forms.setdefault(f"{n}({p})", level)
    return forms


def _company_forms(name: str, place: str | None, provinces: list[str]) -> dict[str, int]:
    m = _FORM.match(name)
    if not m:
        return {name: 0}
    stem, group, legal, branch = m[1], m[2] or "", m[3], m[4]
    before, inside = "", False
    for p in provinces:
        for pre in (f"{p}省", p):
            if not before and stem.startswith(pre):
                before, stem = pre, stem[len(pre) :]
    if place:
        for pre in (f"{place}市", place):
            if not before and stem.startswith(pre):
                before, stem = pre, stem[len(pre) :]
        if f"({place})" in stem:
            inside, brand = True, stem.split(f"({place})")[0]
            stem = stem.replace(f"({place})", "")
    forms: dict[str, int] = {}
    legals = list(dict.fromkeys([legal, "公司", "", "有限公司", "(有限公司)", f"({legal})"]))
    groups = [group] if not group else [group, ""]
    if branch:
        places = [f"{p}{s}" for p in provinces for s in ("", "省")]
        for g in groups:
            for le in legals:
                for b in (f"{branch}分公司", f"({branch}分公司)", f"{branch}市分公司"):
                    for p in [*places, ""]:
                        forms.setdefault(f"{p}{stem}{g}{le}{b}", 1 if p else 2)
                for p in [*places, ""]:
                    forms.setdefault(f"{branch}分公司({p}{stem}{g}{le})", 1 if p else 2)
        return forms
    local = place if (inside or (before and place and before.startswith(place))) else None
    fronts = [f"{local}市", local] if local else [f"{p}{s}" for p in provinces for s in ("省", "")] if before else []
    for g in groups:
        for le in legals:
            for p in fronts:
                forms.setdefault(f"{p}{stem}{g}{le}", 1)
            forms.setdefault(f"{stem}{g}{le}", 2)
            for p in fronts:
                forms.setdefault(f"{stem}{g}{le}({p})", 1)
                forms.setdefault(f"{stem}{g}({p}){le}", 1)
                if inside:
                    forms.setdefault(f"{brand}({p}){stem[len(brand):]}{g}{le}", 1)
    return forms


def _latin_forms(name: str) -> dict[str, int]:
    words = name.split()
    if len(words) < 2:
        return {name: 0}
    a, b, rest = words[0], words[1], " ".join(words[2:])
    turned = [f"{a} {b}", f"{b} {a}"]
    forms = {name: 0}
    for i, pair in enumerate(turned):
        for text in ([f"{pair} {rest}", f"{rest} {pair}"] if rest else []):
            forms.setdefault(text, 1 + i)
        forms.setdefault(pair, 2 + i)
    return forms


def forms_of(org: int, name: str, kind: str | None, city: str | None, short: str | None, provinces: list[str]) -> list[tuple[str, int, int]]:
    """``(form, org, level)`` of one registered name; of two organisations with one form the lower level holds."""
    full = core(name)
    if not full:
        return []
    forms = {full: 0}
    if re.search("[a-z]{3}", full):
        found = _latin_forms(full)
    elif city and full.startswith(f"{city}市") and not _FORM.match(full):
        found = _office_forms(city, full[len(city) + 1 :], provinces)
    else:
        found = _company_forms(full, city, provinces)
    for text, level in found.items():
        forms.setdefault(text, level)
    if short and core(short):
        forms.setdefault(core(short), 1)
    return [(text, org, level) for text, level in forms.items() if text]


class Metric:
    """The edit metric, over many pairs at once."""

    def __init__(self, letters: frozenset[str]):
        self.known = np.zeros(0x110000, bool)
        if letters:
            self.known[[ord(c) for c in letters]] = True
        self.sounds = np.array(sorted({(ord(x) << 21) | ord(y) for p in LIKE_SOUND for x, y in ((p[0], p[1]), (p[1], p[0]))}), np.int64)

    def like_sound(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 21) | b
        return self.sounds[np.minimum(np.searchsorted(self.sounds, key), len(self.sounds) - 1)] == key

    def substitution(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        latin = (a < 0x250) & (b < 0x250) & (a > 0x40) & (b > 0x40)
        slip = latin | ~self.known[a] | ~self.known[b] | self.like_sound(a, b)
        return np.where(a == b, 0, np.where(slip, 1, 2))

    def distances(self, a: np.ndarray, a_len: np.ndarray, b: np.ndarray, b_len: np.ndarray, swaps: bool = True) -> np.ndarray:
        """Distances of padded code point rows ``a[i]`` and ``b[i]`` (either may be one row for all).

        Swaps of cost 1 break the triangle inequality (CA, AC, ABC: 1 and 1, but 3). Without ``swaps`` they cost 2, as a
        deletion and an insertion; that is a metric, and at most twice the distance with them.
        """
        n = max(len(a), len(b))
        rows, cols = a.shape[1], b.shape[1]
        out = np.zeros(n, np.int64)
        a_len, b_len = np.broadcast_to(a_len, n), np.broadcast_to(b_len, n)
        before, last = None, np.broadcast_to(np.arange(cols + 1), (n, cols + 1)).copy()
        first = a_len == 0
        out[first] = last[first, b_len[first]]
        for i in range(1, rows + 1):
            now = np.empty((n, cols + 1), np.int64)
            now[:, 0] = i
            for j in range(1, cols + 1):
                x, y = a[:, i - 1], b[:, j - 1]
                best = np.minimum(np.minimum(last[:, j], now[:, j - 1]) + 1, last[:, j - 1] + self.substitution(x, y))
                if swaps and i > 1 and j > 1:
                    swapped = (x == b[:, j - 2]) & (a[:, i - 2] == y)
                    best = np.where(swapped, np.minimum(best, before[:, j - 2] + 1), best)
                now[:, j] = best
            here = a_len == i
            out[here] = now[here, b_len[here]]
            before, last = last, now
        return out


def padded(texts: list[str], width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    width = width or int(sizes.max(initial=1))
    table = np.zeros((len(texts), width), np.int64)
    for i, t in enumerate(texts):
        table[i, : len(t)] = list(map(ord, t))
    return table, sizes


def choose_pivots(forms: list[str], metric: Metric, count: int = PIVOTS) -> list[str]:
    """Forms far from each other, by farthest-first traversal."""
    if not forms:
        return []
    table, sizes = padded(forms)
    chosen = [0]
    nearest = metric.distances(table, sizes, table[:1], sizes[:1], swaps=False)
    while len(chosen) < min(count, len(forms)):
        at = int(np.argmax(nearest))
        if not nearest[at]:
            break
        chosen.append(at)
        nearest = np.minimum(nearest, metric.distances(table, sizes, table[at : at + 1], sizes[at : at + 1], swaps=False))
    return [forms[i] for i in chosen]


def _to_pivots(texts: list[str], pivots: list[str], metric: Metric) -> np.ndarray:
    table, sizes = padded(texts)
    return np.stack([metric.distances(table, sizes, *padded([p]), swaps=False) for p in pivots], axis=1)


def radius_join(typed: DataFrame, forms: DataFrame, letters: frozenset[str], radius: int = RADIUS) -> DataFrame:
    """``core, form, distance`` of all typed names and forms within ``radius``; both sides are tables of distinct texts."""
    spark, reach = typed.sparkSession, 2 * radius
    sample = [r[0] for r in forms.orderBy(F.xxhash64("form"), "form").limit(PIVOT_SAMPLE).collect()]
    count = PIVOTS if len(sample) < PIVOT_SAMPLE else min(MOST_PIVOTS, max(PIVOTS, forms.count() // FORMS_PER_PIVOT))
    pivots = choose_pivots(sample, Metric(letters), count)
    if not pivots:
        return spark.createDataFrame([], "core string, form string, distance int")

    def place_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        metric = Metric(letters)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            far = _to_pivots(texts, pivots, metric) if texts else np.zeros((0, len(pivots)), np.int64)
            cell = far.argmin(axis=1) if len(texts) else np.zeros(0, np.int64)
            ring = far[np.arange(len(texts)), cell]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell.astype(np.int32)), pa.array(ring.astype(np.int32)), pa.array([r.tobytes() for r in far.astype(np.int16)], pa.binary())], names=["form", "cell", "ring", "far"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))  # distinct texts are few bytes but much work: spread them
    placed = written(forms.select("form").repartition(n).mapInArrow(place_forms, "form string, cell int, ring int, far binary"), "forms")
    rings = {}
    for r in placed.groupBy("cell", "ring").count().collect():  # bounded by pivots times the longest distance
        rings.setdefault(r["cell"], set()).add(r["ring"])

    def place_typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        metric = Metric(letters)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            far = _to_pivots(texts, pivots, metric) if texts else np.zeros((0, len(pivots)), np.int64)
            who, cells, ring_of = [], [], []
            for c, inhabited in sorted(rings.items()):
                # a form within the radius is at most reach = 2 * radius away without swaps; one of this cell at ring k is so
                # only if |d(x, pivot) - k| <= reach, and its own pivot is its nearest: k <= d(form, p) <= d(x, p) + reach
                limit = far.min(axis=1) + reach if len(texts) else np.zeros(0, np.int64)
                for k in sorted(inhabited):
                    near = np.flatnonzero((np.abs(far[:, c] - k) <= reach) & (k <= limit))
                    who.append(near)
                    cells.append(np.full(len(near), c))
                    ring_of.append(np.full(len(near), k))
            who = np.concatenate(who) if who else np.zeros(0, np.int64)
            cells, ring_of = (np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32) for x in (cells, ring_of))
            rows = [r.tobytes() for r in far.astype(np.int16)]
            yield pa.RecordBatch.from_arrays([pa.array([texts[i] for i in who], pa.string()), pa.array(cells), pa.array(ring_of), pa.array([rows[i] for i in who], pa.binary())], names=["core", "cell", "ring", "far"])

    longest = forms.agg(F.max(F.length("form"))).first()[0]  # a longer text is further away than the radius
    asked = typed.select("core").where(F.length("core") <= longest + radius).repartition(n).mapInArrow(place_typed, "core string, cell int, ring int, far binary")

    def inside(left: pa.Table, right: pa.Table) -> pa.Table:
        metric = Metric(letters)
        cores, texts = left.column("core").to_pylist(), right.column("form").to_pylist()
        if not cores or not texts:
            return pa.table({"core": pa.array([], pa.string()), "form": pa.array([], pa.string()), "distance": pa.array([], pa.int32())})
        mine = np.frombuffer(b"".join(left.column("far").to_pylist()), np.int16).reshape(len(cores), -1)
        theirs = np.frombuffer(b"".join(right.column("far").to_pylist()), np.int16).reshape(len(texts), -1)
        a_all, b_all = padded(cores), padded(texts)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        step = max(1, 2_000_000 // (len(texts) * theirs.shape[1]))
        for at in range(0, len(cores), step):
            longer = np.abs(a_all[1][at : at + step, None] - b_all[1][None])
            # what makes up the lengths is no swap and counts once
            close = (np.abs(mine[at : at + step, None, :] - theirs[None]) <= (reach - longer)[:, :, None]).all(axis=2)
            close &= longer <= radius
            x, y = np.nonzero(close)
            x += at
            for part in range(0, len(x), 20_000):
                px, py = x[part : part + 20_000], y[part : part + 20_000]
                d = metric.distances(a_all[0][px], a_all[1][px], b_all[0][py], b_all[1][py])
                good = d <= radius
                found.append((px[good], py[good], d[good]))
        x, y, d = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        return pa.table({"core": pa.array([cores[i] for i in x], pa.string()), "form": pa.array([texts[i] for i in y], pa.string()), "distance": pa.array(d.astype(np.int32))})

    # cells that many names ask for are dealt out by name; counts of cells and rings are as bounded as rings are
    asked = written(asked, "asked")
    many = {(r["cell"], r["ring"]): -(-r["count"] // PART_NAMES) for r in asked.groupBy("cell", "ring").count().collect() if r["count"] > PART_NAMES}
    parts = F.lit(1)
    for (cell, ring), k in many.items():
        parts = F.when((F.col("cell") == cell) & (F.col("ring") == ring), k).otherwise(parts)
    left = asked.withColumn("part", F.pmod(F.xxhash64("core"), parts).cast("int") if many else F.lit(0)).repartition(n, "cell", "ring", "part").groupBy("cell", "ring", "part")
    right = placed.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)) if many else F.lit(0)).groupBy("cell", "ring", "part")
    return left.cogroup(right).applyInArrow(inside, "core string, form string, distance int")


def link_names(rows: DataFrame, register: DataFrame, key: str, fields: list[str], radius: int = RADIUS) -> DataFrame:
    """``id, field, org_id, distance`` of every name in ``fields`` that means a registered organisation.

    ``register``: org_id, name, kind, city, short_name. Typed names are made distinct before anything is compared.
    """
    spark = rows.sparkSession
    typed = rows.select(F.col(key).cast("bigint").alias("id"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x")).select("id", "x.field", "x.value").where("value is not null and value != ''")

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([core(v) for v in batch.column(0).to_pylist()], pa.string())], names=["value", "core"])

    values = written(typed.select("value").distinct().mapInArrow(cores, "value string, core string").where("core != ''"), "values")
    provinces = sorted(r["p"] for r in register.select(F.regexp_extract("name", "^(..)省", 1).alias("p")).where("p != ''").distinct().collect())

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [f for row in zip(*[c.to_pylist() for c in batch.columns]) if row[1] for f in forms_of(*row, provinces)]
            cols = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32())], names=["form", "org_id", "level"])

    spelled = register.select(F.col("org_id").cast("bigint"), "name", "kind", "city", "short_name").mapInArrow(spell, "form string, org_id bigint, level int")
    spelled = written(spelled.groupBy("form", "org_id").agg(F.min("level").alias("level")), "spelled")
    low = spelled.groupBy("form").agg(F.min("level").alias("low"))
    lowest = spelled.join(low, "form").where("level = low").groupBy("form").agg(F.min("org_id").alias("org_id"), F.count("*").alias("n"), F.first("level").alias("level"))
    forms = written(lowest.select("form", F.when(F.col("n") == 1, F.col("org_id")).alias("org_id"), "level"), "lowest")
    letters = frozenset(TELLING) | frozenset(r["c"] for r in register.select(F.explode(F.split("name", "")).alias("c")).where("c != ''").distinct().collect())  # bounded by Unicode
    distinct = values.select("core").distinct()
    exact = distinct.join(forms, F.col("core") == F.col("form")).select("core", "org_id", F.lit(0).alias("distance"))
    rest = distinct.join(forms.select(F.col("form").alias("core")), "core", "left_anti")
    near = radius_join(rest, forms.select("form").where(F.length("form") >= SHORTEST_NEAR), letters, radius).join(forms, "form")

    def sounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        metric = Metric(letters)
        for batch in batches:
            alike = []
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                differ = [(x, y) for x, y in zip(a, b) if x != y] if len(a) == len(b) else []
                alike.append(len(differ) == 1 and bool(metric.like_sound(np.array([ord(differ[0][0])]), np.array([ord(differ[0][1])]))[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), batch.column(4), pa.array(alike)], names=["core", "form", "org_id", "level", "distance", "alike"])

    ranked = near.select("core", "form", "org_id", "level", "distance").mapInArrow(sounds, "core string, form string, org_id bigint, level int, distance int, alike boolean")
    best = ranked.withColumn("rank", F.struct("distance", ~F.col("alike"), "level"))
    top = best.groupBy("core").agg(F.min("rank").alias("rank"))
    close = best.join(top, ["core", "rank"]).groupBy("core").agg(F.min("org_id").alias("org_id"), F.max("org_id").alias("other"), F.max(F.col("org_id").isNull()).alias("unclear"), F.min("distance").alias("distance"))
    close = close.where("org_id = other and not unclear").select("core", "org_id", "distance")
    meant = exact.where("org_id is not null").unionByName(close)
    resolved = written(values.join(meant, "core").select("value", "org_id", "distance"), "resolved")
    side = F.broadcast(resolved) if resolved.count() <= BROADCAST_NAMES else resolved
    return typed.join(side, "value").select("id", "field", "value", "org_id", "distance")
