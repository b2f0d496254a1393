"""Quantities recorded in different units brought to one (problem 2).

``harmonise_amounts`` reads a money amount out of free text, finds its unit in the text, else in a context column,
else by a log-scale mixture whose components are offset by the known conversion factors, and returns fen.

Defined results: null, empty and placeholder texts, rates, ranges, unit prices and foreign currency give no amount
(``status`` names why) and null ``fen``; an empty table gives an empty result; repeated rows are kept as they are;
texts of any length are searched whole; extra columns are left alone, as only the named columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.width import SPACES, fold_width

# How many yuan a unit word stands for.
FACTORS = {
    "": 1, "元": 1, "圆": 1, "百": 100, "佰": 100, "千": 1_000, "仟": 1_000, "k": 1_000, "万": 10_000, "w": 10_000,
    "十万": 100_000, "百万": 1_000_000, "m": 1_000_000, "million": 1_000_000, "千万": 10_000_000, "亿": 100_000_000,
    "bn": 1_000_000_000, "billion": 1_000_000_000,
}
#: Units a bare number may be in, as yuan: the components of the mixture.
BARE_UNITS = {"元": 1, "千元": 1_000, "万元": 10_000, "亿元": 100_000_000}

_NUMBER = r"(\d[\d,]*(?:\.\d+)?|\.\d+)"
_UNIT = r"(亿|千万|百万|十万|万|千|仟|百|佰|billion|bn|million|m|w|k)?"
_FOREIGN = r"美元|欧元|日元|港元|港币|英镑|澳元|加元|韩元|卢布|法郎|usd|eur|jpy|hkd|gbp|aud|cad|chf|us\$|\$|€|£"
_RATE = r"%|‰|折扣|下浮|上浮|费率|百分之|千分之"
_EACH = r"每|单价|/|平方米|㎡|m²"
_RANGE = r"\d(?:亿|千万|百万|十万|万|千|百)?元?(?:-|~|—|–|―|至|到)+¥?\d"
_CHINESE = "零〇一二三四五六七八九两壹贰叁肆伍陆柒捌玖十百千万亿拾佰仟"
_DIGITS = "零一二三四五六七八九"
_CONTEXT = r"(?:单位|预算以|金额以|金额均以|均以|价格以|报价以|计价以)(?:为|是)?[:：]?(?:人民币)?(亿|百万|万|千)?元"


def chinese_number(text: Column) -> Column:
    """The whole number written in Chinese numerals, everyday or financial; null for null, 0 for no numeral."""
    plain = F.translate(text, "〇两壹贰叁肆伍陆柒捌玖拾佰仟", "零二一二三四五六七八九十百千")
    zero = F.lit(0).cast("decimal(24,0)")
    start = F.struct(zero.alias("total"), zero.alias("section"), zero.alias("digit"))

    def step(acc: Column, ch: Column) -> Column:
        total, section, digit = acc["total"], acc["section"], acc["digit"]
        at = F.instr(F.lit(_DIGITS), ch)
        unit = F.when(ch == "十", 10).when(ch == "百", 100).when(ch == "千", 1000)

        def state(t: Column, s: Column, d: Column) -> Column:
            return F.struct(t.cast("decimal(24,0)").alias("total"), s.cast("decimal(24,0)").alias("section"), d.cast("decimal(24,0)").alias("digit"))

        return (
            F.when(at > 0, state(total, section, at - 1))
            .when(unit.isNotNull(), state(total, section + F.when(digit == 0, 1).otherwise(digit) * unit, zero))
            .when(ch == "万", state(total + (section + digit) * 10_000, zero, zero))
            .when(ch == "亿", state((total + section + digit) * 100_000_000, zero, zero))
            .otherwise(acc)
        )

    return F.aggregate(F.split(plain, ""), start, step, lambda acc: acc["total"] + acc["section"] + acc["digit"])


def _factor(unit: Column) -> Column:
    pairs = [x for k, v in FACTORS.items() if k for x in (F.lit(k), F.lit(v).cast("decimal(14,0)"))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), unit), F.lit(1).cast("decimal(14,0)"))


def context_unit(text: Column) -> Column:
    """The unit a context text gives for amounts (``元``, ``千元`` ...), null if it gives none."""
    folded = F.regexp_replace(fold_width(text), SPACES, "")
    return F.when(folded.rlike(_CONTEXT), F.concat(F.regexp_extract(folded, _CONTEXT, 1), F.lit("元")))


def parse_amounts(df: DataFrame, amount: str, context: str) -> DataFrame:
    """Adds ``number``, ``unit``, ``unit_source`` (text, context, none) and ``status`` (amount or why there is none)."""
    s = F.col("_s")
    first = rf"{_NUMBER}{_UNIT}"
    df = df.withColumn("_s", F.lower(F.regexp_replace(fold_width(F.col(amount)), SPACES, "")))
    # every step is a column of its own, so that none is computed twice
    df = df.withColumns(
        {
            "_number": F.replace(F.regexp_extract(s, _NUMBER, 1), F.lit(","), F.lit("")),
            "_suffix": F.regexp_extract(s, first, 2),
            "_words": F.regexp_extract(s, rf"([{_CHINESE}]+)(?:元|圆|整|$|[)）,，])", 1),
            "_label": F.when(s.rlike(r"元[)\]]?[:：]¥?[\d.]"), F.concat(F.regexp_extract(s, r"[(\[]?(?:单位[:：])?(亿|百万|万|千)?元[)\]]?[:：]¥?[\d.]", 1), F.lit("元"))),
            "_jiao": F.regexp_extract(s, r"[元圆]([零一二三四五六七八九壹贰叁肆伍陆柒捌玖])角", 1),
            "_fen": F.regexp_extract(s, r"([零一二三四五六七八九壹贰叁肆伍陆柒捌玖])分", 1),
            "_given": context_unit(F.col(context)),
        }
    )
    one = lambda c: F.greatest(F.instr(F.lit(_DIGITS), F.translate(F.col(c), "壹贰叁肆伍陆柒捌玖", "一二三四五六七八九")) - 1, F.lit(0))
    small = F.when(F.col("_jiao") != "", one("_jiao")).otherwise(0) * F.lit(0.1).cast("decimal(2,1)") + F.when(F.col("_fen") != "", one("_fen")).otherwise(0) * F.lit(0.01).cast("decimal(3,2)")
    spelled = (F.col("_number") == "") & (F.col("_words") != "")
    df = df.withColumn("number", F.when(F.col("_number") != "", F.col("_number").try_cast("decimal(24,8)")).when(spelled, (chinese_number(F.col("_words")) + small).cast("decimal(24,8)")))
    status = (
        F.when(s.isNull() | (s == ""), "missing")
        .when(s.rlike(_FOREIGN), "foreign")
        .when(s.rlike(_RATE), "rate")
        .when(s.rlike(_RANGE), "range")
        .when(s.rlike(_EACH), "unit price")
        .when(F.col("number").isNull() | (F.col("number") <= 0), "no amount")
        .otherwise("amount")
    )
    stated = (
        F.when(spelled, F.lit("元"))
        .when((F.col("_suffix") != "") | s.rlike(rf"{_NUMBER}{_UNIT}(?:元|圆)"), F.concat("_suffix", F.lit("元")))
        .when(F.col("_label").isNotNull(), F.col("_label"))
        .when(s.rlike(r"¥|rmb|cny|人民币|元|圆"), F.lit("元"))
    )
    out = df.withColumns({"status": status, "_stated": stated})
    out = out.withColumns(
        {
            "unit": F.coalesce("_stated", "_given"),
            "unit_source": F.when(F.col("_stated").isNotNull(), "text").when(F.col("_given").isNotNull(), "context").otherwise("none"),
            "number": F.when(F.col("status") == "amount", F.col("number")),
        }
    )
    return _settled(out.drop("_s", "_number", "_suffix", "_words", "_label", "_jiao", "_fen", "_given", "_stated"), ["number", "unit", "unit_source", "status"])


def _settled(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``columns`` computed here, once: filters on them are not pushed down as copies of all they are made of."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*columns))))


@dataclass(frozen=True)
class UnitMixture:
    """Amounts in yuan are log-normal mixtures; a bare number is such an amount over one of the factors."""

    weights: tuple[float, ...]
    means: tuple[float, ...]
    sigmas: tuple[float, ...]
    unit_weights: tuple[float, ...]

    def with_posterior(self, df: DataFrame, number: str, out: list[str]) -> DataFrame:
        """Adds the posterior of each unit of ``BARE_UNITS`` for a number, as columns ``out``."""
        x = F.log10(F.col(number).cast("double"))
        parts = {}
        for name, pi, factor in zip(out, self.unit_weights, BARE_UNITS.values()):
            density = F.lit(0.0)
            for w, mu, sd in zip(self.weights, self.means, self.sigmas):
                z = (F.col("_x") + F.lit(math.log10(factor) - mu)) / F.lit(sd)
                density = density + F.lit(w / sd) * F.exp(-z * z / 2)
            parts[name] = F.lit(pi) * density
        df = df.withColumn("_x", x).withColumns(parts)
        total = sum((F.col(n) for n in out[1:]), F.col(out[0])) + F.lit(1e-300)
        return df.withColumn("_total", total).withColumns({n: F.col(n) / F.col("_total") for n in out}).drop("_x", "_total")


#: Width of a bin of log10 amounts; there are at most BINS of them, whatever the number of rows.
BIN, LOW, BINS = 0.02, -4.0, 1000


def fit_unit_mixture(parsed: DataFrame, components: int = 2, rounds: int = 200, prior: dict[str, float] | None = None, settled: float = 1e-7) -> UnitMixture:
    """EM on the binned log amounts of all rows. Only the bins (at most 2 x ``BINS`` counts) come to the driver.

    It ends when no parameter moves by more than ``settled``, after ``rounds`` at most. Amounts below or above all bins count in
    the outermost ones. ``prior``: how likely a bare number has each unit, where that is known; else it is learnt.
    """
    factor = _factor(F.regexp_replace("unit", "元$", ""))
    value = F.when(F.col("unit").isNotNull(), F.col("number") * factor).otherwise(F.col("number"))
    bins = (
        parsed.where("status = 'amount'")
        .select((F.col("unit_source") != "none").alias("known"), F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((F.log10(value.cast("double")) - LOW) / BIN))).alias("bin"))
        .groupBy("known", "bin")
        .count()
        .collect()
    )
    hist = {True: np.zeros(BINS), False: np.zeros(BINS)}
    for row in bins:
        hist[row["known"]][int(row["bin"])] += row["count"]
    x = LOW + (np.arange(BINS) + 0.5) * BIN
    offsets = np.log10(np.array(list(BARE_UNITS.values()), dtype=float))
    base = hist[True] if hist[True].sum() else hist[False]
    if not base.sum():
        return UnitMixture((1.0,), (5.5,), (1.0,), tuple([1 / len(offsets)] * len(offsets)))
    mean = float(np.average(x, weights=base))
    spread = max(float(np.sqrt(np.average((x - mean) ** 2, weights=base))), 0.05)
    mu = mean + spread * np.linspace(-0.7, 0.7, components)
    sd = np.full(components, max(spread, 0.05))
    w = np.full(components, 1 / components)
    pi = np.full(len(offsets), 1 / len(offsets))
    if prior:
        pi = np.array([prior.get(u, 0.0) for u in BARE_UNITS])
        pi /= pi.sum()
    before = np.concatenate([mu, sd, w, pi])
    for _ in range(rounds):
        known = w[:, None] / sd[:, None] * np.exp(-((x[None] - mu[:, None]) ** 2) / (2 * sd[:, None] ** 2)) + 1e-300
        known_r = known / known.sum(0) * hist[True]
        y = x[None, None] + offsets[None, :, None]
        bare = pi[None, :, None] * w[:, None, None] / sd[:, None, None] * np.exp(-((y - mu[:, None, None]) ** 2) / (2 * sd[:, None, None] ** 2)) + 1e-300
        bare_r = bare / bare.sum((0, 1)) * hist[False]
        mass = known_r.sum(1) + bare_r.sum((1, 2))
        mu = ((known_r * x).sum(1) + (bare_r * y).sum((1, 2))) / np.maximum(mass, 1e-9)
        var = ((known_r * (x - mu[:, None]) ** 2).sum(1) + (bare_r * (y - mu[:, None, None]) ** 2).sum((1, 2))) / np.maximum(mass, 1e-9)
        sd = np.sqrt(np.maximum(var, 0.05**2))
        w = mass / mass.sum()
        if hist[False].sum() and not prior:
            pi = np.maximum(bare_r.sum((0, 2)) / hist[False].sum(), 1e-6)
            pi /= pi.sum()
        now = np.concatenate([mu, sd, w, pi])
        if np.abs(now - before).max() <= settled:
            break
        before = now
    return UnitMixture(tuple(map(float, w)), tuple(map(float, mu)), tuple(map(float, sd)), tuple(map(float, pi)))


def harmonise_amounts(df: DataFrame, amount: str, context: str, bare_rule: str | None = "元", sure: float = 0.9) -> DataFrame:
    """Every amount of ``df`` in fen.

    Adds ``status``, ``number``, ``unit``, ``unit_source`` (text, context, rule, posterior, none), ``fen``, ``likely_unit``
    (the unit that the numbers alone suggest for one without any), ``posterior`` (of the unit that was used) and ``uncertain``.

    A number whose unit neither text nor context gives has the unit of highest posterior under the mixture; how likely each unit is
    beforehand is learnt from the numbers. A ``bare_rule`` is a prior that is certain and leaves nothing to choose: the unit is
    the rule's. ``uncertain`` is set where the numbers alone give the unit used a posterior below ``sure``.
    """
    parsed = parse_amounts(df, amount, context)
    names = list(BARE_UNITS)
    posts = [f"_p{i}" for i in range(len(names))]
    mixture = fit_unit_mixture(parsed)
    out = mixture.with_posterior(parsed, "number", posts).withColumn("_bare", (F.col("status") == "amount") & (F.col("unit_source") == "none"))
    out = out.withColumn("_best", F.greatest(*posts))
    bare = F.col("_bare")
    out = out.withColumn("likely_unit", F.when(bare, F.coalesce(*[F.when(F.col(p) == F.col("_best"), F.lit(n)) for p, n in zip(posts, names)])))
    chosen = F.lit(bare_rule) if bare_rule else F.col("likely_unit")
    out = out.withColumns({"unit": F.when(bare, chosen).otherwise(F.col("unit")), "unit_source": F.when(bare, "rule" if bare_rule else "posterior").otherwise(F.col("unit_source"))})
    used = F.coalesce(*[F.when(F.col("unit") == n, F.col(p)) for p, n in zip(posts, names)], F.lit(0.0))
    out = out.withColumns({"posterior": F.when(bare, used).when(F.col("status") == "amount", F.lit(1.0)), "_factor": _factor(F.regexp_replace("unit", "元$", ""))})
    fen = F.round(F.col("number") * F.col("_factor") * 100, 0).cast("bigint")
    out = out.withColumns({"fen": F.when(F.col("status") == "amount", fen), "uncertain": F.col("posterior") < sure})
    out = out.drop("_bare", "_best", "_factor", *posts)
    return _settled(out, ["unit", "unit_source", "fen", "likely_unit", "posterior", "uncertain"])


def hidden_unit_accuracy(df: DataFrame, amount: str, context: str, every: int = 5) -> DataFrame:
    """How well the mixture finds units that were hidden from it: ``unit, n, right, sure, sure_right`` over a held-out share.

    Amounts of ``df`` with a known unit of ``BARE_UNITS`` are split by a hash of their text: of one in ``every`` only the bare
    number is shown, and the fit sees the others with their units and these without.
    """
    parsed = parse_amounts(df, amount, context).where("status = 'amount' and unit_source != 'none'")
    known = parsed.where(F.col("unit").isin(list(BARE_UNITS))).select("number", F.col("unit").alias("true_unit"), (F.pmod(F.xxhash64(amount), F.lit(every)) == 0).alias("held"))
    shown = known.select("number", "true_unit", "held", F.lit("amount").alias("status"), F.when(~F.col("held"), F.col("true_unit")).alias("unit"), F.when(F.col("held"), "none").otherwise("text").alias("unit_source"))
    names = list(BARE_UNITS)
    posts = [f"_p{i}" for i in range(len(names))]
    out = fit_unit_mixture(shown).with_posterior(shown.where("held"), "number", posts).withColumn("_best", F.greatest(*posts))
    found = F.coalesce(*[F.when(F.col(p) == F.col("_best"), F.lit(n)) for p, n in zip(posts, names)])
    right, sure = found == F.col("true_unit"), F.col("_best") >= 0.9
    return out.groupBy(F.col("true_unit").alias("unit")).agg(F.count("*").alias("n"), F.count_if(right).alias("right"), F.count_if(sure).alias("sure"), F.count_if(sure & right).alias("sure_right"))
