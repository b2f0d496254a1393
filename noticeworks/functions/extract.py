"""Values and sections taken out of running text by labels, with built-in expressions where one match decides."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import clean_text


def first_match(text: Column, patterns: list[str], group: int = 1) -> Column:
    """The first non-empty group of the first pattern that has one; '' if none has."""
    t = F.coalesce(text, F.lit(""))
    tries = [F.nullif(F.trim(F.regexp_extract(t, p, group)), F.lit("")) for p in patterns]
    return F.coalesce(*tries, F.lit(""))


def distinct_matches(text: Column, pattern: str, leading: str | None = None) -> Column:
    """All matches in order, each once; ``leading``: an expression cut off their beginning."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))
    if leading:
        found = F.transform(found, lambda x: F.regexp_replace(x, "^(?:" + leading + ")+", ""))
    return F.array_distinct(F.filter(found, lambda x: x != ""))


def before(text: Column, stop: str) -> Column:
    """The text up to the first match of ``stop``, cleaned."""
    return clean_text(F.split(F.coalesce(text, F.lit("")), stop, 2)[0])


def longest_section(label: str, stop: str, most: int = 6000, least: int = 8):
    """A function giving the longest section that follows a label and ends at ``stop``; the first of equals, '' if none.

    Every occurrence of the label counts, which no built-in expression can say; hence Arrow batches.
    """
    labels, stops, white = re.compile(label), re.compile(stop), re.compile(r"\s+")

    def one(text: str | None) -> str:
        best = ""
        for m in labels.finditer(text or ""):
            rest = text[m.end() : m.end() + most]
            end = stops.search(rest)
            value = white.sub(" ", rest[: end.start()] if end else rest).strip()
            if len(value) >= least and len(value) > len(best):
                best = value
        return best

    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    run.one = one
    return run


def first_valid_section(labels: list[str], stop: str, nested: str, most: int = 800, least: int = 4, near: str | None = None):
    """A function giving the first section that holds up: labels in order of rank, every occurrence of each.

    A section that begins with a nested label, has fewer than ``least`` telling characters or only refers elsewhere is
    passed over, as is an occurrence within 16 characters after ``near``.
    """
    ranked, stops, nest = [re.compile(x) for x in labels], re.compile(stop), re.compile(nested)
    refer, idle, number = re.compile(r"^(?:详见|见附件|参见|以.{0,6}为准)"), re.compile(r"[\W\d_]+"), re.compile(r"^[\s:：、.．\d一二三四五六七八九十（）()]+")

    def one(text: str | None) -> str:
        for label in ranked:
            for m in label.finditer(text or ""):
                if near and near in text[max(0, m.start() - 16) : m.start()]:
                    continue
                rest = number.sub("", text[m.end() : m.end() + most])
                end = stops.search(rest)
                value = re.sub(r"\s+", " ", rest[: end.start()] if end else rest).strip()
                if not nest.match(value) and not refer.match(value) and len(idle.sub("", value)) >= least:
                    return value
        return ""

    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    run.one = one
    return run


def section_of_lines(lines: Column, label: str, stop: str) -> Column:
    """The rest of the first line with the label and the lines after it, up to a line that begins with ``stop``; '' if none."""
    start = F.struct(F.lit(0).alias("state"), F.array().cast("array<string>").alias("kept"))

    def step(acc: Column, line: Column) -> Column:
        rest = clean_text(F.regexp_replace(line, "^.*?" + label + r"\s*[:：]?", ""))
        opened = F.struct(F.lit(1).alias("state"), F.when(rest != "", F.array(rest)).otherwise(F.array().cast("array<string>")).alias("kept"))
        closed = F.struct(F.lit(2).alias("state"), acc["kept"].alias("kept"))
        more = F.struct(F.lit(1).alias("state"), F.array_append(acc["kept"], line).alias("kept"))
        return F.when((acc["state"] == 0) & line.rlike(label), opened).when((acc["state"] == 1) & line.rlike("^" + stop), closed).when(acc["state"] == 1, more).otherwise(acc)

    return F.aggregate(lines, start, step, lambda acc: F.array_join(acc["kept"], " "))


def first_line_value(lines: Column, pattern: str) -> Column:
    """Group 1 of the first line that matches; '' if none does."""
    return F.coalesce(F.regexp_extract(F.try_element_at(F.filter(lines, lambda x: x.rlike(pattern)), F.lit(1)), pattern, 1), F.lit(""))


def between(page: Column, start: str, stop: str) -> Column:
    """The part of a page between two marks, the whole page if they are not there."""
    p = F.coalesce(page, F.lit(""))
    found = F.regexp_extract(p, rf"(?is)(?:{start})(.*?)(?:{stop})", 1)
    return F.when(found == "", p).otherwise(found)


def span(text: Column, pattern: str) -> Column:
    """Two groups of the first match as ``a至b``; '' if there is no match."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike(pattern), F.concat(F.trim(F.regexp_extract(t, pattern, 1)), F.lit("至"), F.trim(F.regexp_extract(t, pattern, 2)))).otherwise(F.lit(""))


def party(labels: list[str], stop: str, bad_start: str = "为|应|须|可", least: int = 2, most: int = 80):
    """A function giving the first valid name after a label: every occurrence is tried, cut at ``stop``, and checked."""
    label, stops, bad = re.compile("(?:" + "|".join(labels) + r")\s*[:：]?\s*"), re.compile(stop), re.compile(bad_start)

    def one(text: str | None) -> str:
        for m in label.finditer(text or ""):
            rest = text[m.end() : m.end() + 120]
            end = stops.search(rest)
            name = re.sub(r"\s+", " ", rest[: end.start()] if end else rest).strip(" ：:，,。；;")
            if least <= len(name) <= most and not bad.match(name) and not re.search(r"[。；;？?！!]", name):
                return name
        return ""

    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    run.one = one
    return run


def location_parts(c: Column, districts: dict[str, str] | None = None) -> Column:
    """``region, prefecture, district`` of a place written with dashes; a district alone finds its region by ``districts``."""
    parts = F.filter(F.split(clean_text(c), r"\s*[-—－/·]\s*"), lambda x: x != "")
    n = F.size(parts)
    at = lambda i: F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit(""))
    lookup = F.create_map(*[x for k, v in (districts or {"": ""}).items() for x in (F.lit(k), F.lit(v))])
    last = F.when(n >= 2, at(-1)).otherwise(F.lit(""))
    return F.struct(at(1).alias("region"), F.when(n >= 3, at(-2)).otherwise(F.coalesce(F.try_element_at(lookup, at(-1)), F.lit(""))).alias("prefecture"), last.alias("district"))


# A date with or without a time, a mobile number, headings of the planning table, words of trading places.
DATE = r"20\d{2}-\d{1,2}-\d{1,2}(?:\s+\d{1,2}:\d{2}(?::\d{2})?)?"
MOBILE = r"^1[3-9]\d{9}$"
PLAN_HEADINGS = ["序号", "招标内容", "预计招标时间", "拟交易场所"]
PLACES = "交易中心|交易场所"


def first_date(text: Column) -> Column:
    """The first date of a text, with its time if it has one; '' if there is none."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), DATE, 0)


def planned_row(rows: Column) -> Column:
    """``struct(planned_at, content, place)`` of the first table row that holds a date, all '' without one.

    ``place`` is the last cell that names a trading place; ``content`` the first cell that is no date, place, number of four
    digits or more, or heading, and has 80 characters at most.
    """
    dated = F.filter(rows, lambda r: F.array_join(r, " ").rlike(DATE))
    row = F.coalesce(F.try_element_at(dated, F.lit(1)), F.array().cast("array<string>"))
    is_place = lambda c: c.rlike(PLACES) & ~c.rlike(f"^(?:{DATE})$")
    other = F.filter(row, lambda c: ~c.rlike(f"^(?:{DATE})$") & ~c.rlike(PLACES) & ~c.rlike(r"^\d{4,}$") & ~c.isin(PLAN_HEADINGS) & (F.length(c) <= 80) & (c != ""))
    pick = lambda cells, at: F.coalesce(F.try_element_at(cells, F.lit(at)), F.lit(""))
    return F.struct(first_date(F.array_join(row, " ")).alias("planned_at"), pick(other, 1).alias("content"), pick(F.filter(row, is_place), -1).alias("place"))


# The labels beside which the fields of a plan stand.
PLAN_LABELS = {
    "project_name": ("工程建设项目名称", "项目名称"), "fixed_asset_code": ("固定资产投资项目代码",), "approval": ("项目批准文件及文号", "批准文件"), "buyer": ("招标人名称", "招标人"),
    "agency": ("招标人委托的代理机构名称", "代理机构名称"), "budget": ("投资估算", "总投资", "项目投资"), "fund_source": ("资金来源",), "project_content": ("项目建设内容", "建设内容", "项目概况"),
    "project_location": ("项目建设地点", "建设地点"), "supervisor": ("行政监督部门", "监督部门"),
}


def plan_fields(rows: Column, text: Column, tags) -> dict[str, Column]:
    """The fields of a plan from the rows of its tables and its plain text; ``tags`` makes a column of tags of the fund's text.

    Parties that are only a mobile number are blanked; a bare budget is in 万元; the planned day is that of the planning table, else
    the first date of the text.
    """
    from .amounts import with_unit
    from .text import beside_label

    out = {name: beside_label(rows, *labels) for name, labels in PLAN_LABELS.items()}
    for party_field in ("buyer", "agency"):
        out[party_field] = F.when(out[party_field].rlike(MOBILE), "").otherwise(out[party_field])
    plan = planned_row(rows)
    out["budget"] = with_unit(out["budget"])
    out["fund_source_tags"] = tags(out["fund_source"])
    out["planned_bid_time"] = F.when(plan["planned_at"] != "", plan["planned_at"]).otherwise(first_date(text))
    out["planned_tender_content"], out["planned_trade_place"] = plan["content"], plan["place"]
    return out
