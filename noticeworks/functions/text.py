"""Text normalisation: cleaning, markup, titles, names, identifiers. Null counts as missing text unless said otherwise."""

from __future__ import annotations

import html
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space in the wide sense: any of Unicode's, for regular expressions of the JVM.
WHITE = r"[\s\u001c-\u001f\u0085   -     　]"
# Punctuation that makes no difference between titles.
TITLE_PUNCTUATION = "，。、“”‘’：；（）()【】[]-_/\\"
# The five entities every page uses, in the order in which they are decoded.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")]
_BLOCK_END = r"(?i)</(?:p|div|h[1-6]|li|tr|table)\s*>|<br\s*/?>"


def clean_text(c: Column) -> Column:
    """Runs of white space as one space, ends trimmed; null gives ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), WHITE + "+", " "))


def blank(c: Column) -> Column:
    return clean_text(c) == ""


def basic_entities(c: Column) -> Column:
    """The five common entities decoded, JVM-side."""
    for name, value in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(value))
    return c


@F.pandas_udf(T.StringType())
def all_entities(texts: pd.Series) -> pd.Series:
    """All named and numeric entities decoded; null stays null."""
    return texts.map(lambda t: None if t is None else html.unescape(t))


def plain_text(c: Column, decode=basic_entities) -> Column:
    """Tags as spaces, then entities decoded, then white space collapsed; the text inside script and style is kept."""
    return clean_text(decode(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " ")))


def block_lines(c: Column, decode=basic_entities) -> Column:
    """The lines of a page: closing block tags end a line, other tags are spaces, blank lines are dropped."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), _BLOCK_END, "\n"), "<[^>]+>", " ")
    return F.filter(F.transform(F.split(decode(text), r"\r\n|[\n\r\u000b\u000c\u0085  ]"), clean_text), lambda x: x != "")


def normalized_title(c: Column) -> Column:
    """Cleaned, without punctuation, in lower case; spaces inside are kept."""
    return F.lower(F.translate(clean_text(c), TITLE_PUNCTUATION, ""))


def content_fingerprint(title: Column, url: Column, buyer: Column, deadline: Column) -> Column:
    """SHA-256 of the canonical address if there is one, else of title, buyer and deadline. ``url``: canonical already."""
    rest = F.concat_ws("|", normalized_title(title), F.lower(clean_text(buyer)), F.lower(clean_text(deadline)))
    return F.sha2(F.when(F.coalesce(url, F.lit("")) != "", F.concat(F.lit("url:"), url)).otherwise(rest), 256)


def keyword_signature(words: Column) -> Column:
    """SHA-256 of a set of keywords, whatever their order and repeats."""
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(words)), "\n"), 256)


def detail_signature(*columns: str) -> Column:
    """SHA-256 of a record's named fields, in order of their names."""
    return F.sha2(F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in sorted(columns)])), 256)


def truncated(c: Column, most: int) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("…"))).otherwise(c)


def absolute_url(c: Column, base: Column) -> Column:
    """An address made absolute against a site's root."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("")).when(c.rlike("^https?://"), c).when(c.startswith("//"), F.concat(F.lit("https:"), c)).otherwise(F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(c, "^/+", "")))


def fields_map(fields: Column, name: str = "name", value: str = "value") -> Column:
    """A list of name and value pairs as a map; blank names go, of equal names the last holds."""
    kept = F.filter(F.transform(fields, lambda x: F.struct(clean_text(x[name]).alias("k"), clean_text(x[value]).alias("v"))), lambda x: x["k"] != "")
    last = F.filter(kept, lambda x, i: ~F.exists(F.slice(kept, i + 2, F.greatest(F.size(kept), F.lit(1))), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(last)


# -- project and party names: four forms that must not be mixed up

# Ends of notice titles that are not part of a project's name, in the order in which they are taken off.
LINK_SUFFIXES = ["项目招标计划", "招标计划", "公开招标公告", "竞争性磋商公告", "竞争性谈判公告", "询比采购公告", "询价采购公告", "采购公告", "施工招标公告", "招标公告", "磋商公告", "谈判公告", "询价公告", "公告"]
WATCH_SUFFIXES = ["招标计划", "项目招标计划", "公开招标公告", "竞争性磋商公告", "采购公告", "施工招标公告", "招标公告", "公告"]
COMPANY_SUFFIXES = ["有限责任公司", "股份有限公司", "集团有限公司", "有限公司", "股份公司", "集团公司", "公司"]
# Punctuation that does not count in project names.
NAME_PUNCTUATION = " \t\r\n-—_·,，。:：;；()（）[]【】“”\"'、/\\"

_NAME_PUNCTUATION = re.compile(r"[\s" + re.escape(NAME_PUNCTUATION.strip()) + "]+")
# Fixed value: how lots and packages are written behind a name.
_LOT = re.compile(r"(?:第?[一二三四五六七八九十\d]+(?:标段|包|品目)|[一二三四五六七八九十\d]+标段).*$")


def _endings(suffixes: list[str]) -> str:
    """One expression for all endings in a row. What ends in an ending that comes earlier in the list never gets its turn."""
    live = [s for i, s in enumerate(suffixes) if not any(s.endswith(x) for x in suffixes[:i])]
    return "(?:" + "|".join(map(re.escape, live)) + ")+$"


_LINK_END, _WATCH_END = re.compile(_endings(LINK_SUFFIXES)), re.compile(_endings(WATCH_SUFFIXES))
_COMPANY_END = re.compile("(?:" + "|".join(COMPANY_SUFFIXES) + ")$")
_NOT_LINKED = re.compile("[^一-鿿0-9a-z]+")


def _compatible(value: str | None) -> str:
    return unicodedata.normalize("NFKC", value or "")


def link_name(value: str | None) -> str:
    """For linkage: compatibility form, lower case, from the lot on cut, no punctuation, notice endings gone."""
    return _LINK_END.sub("", _NAME_PUNCTUATION.sub("", _LOT.sub("", _compatible(value).lower())))


def watch_name(value: str | None) -> str:
    """For watch lists: as ``link_name`` with its own endings, lots kept."""
    return _WATCH_END.sub("", _NAME_PUNCTUATION.sub("", _compatible(value).lower()))


def shown_name(value: str | None) -> str:
    """For pages: compatibility form with single spaces, case and endings kept."""
    return " ".join(_compatible(value).split())


def link_buyer(value: str | None) -> str:
    """A party for linkage: ``link_name`` without one ending of a company."""
    return _COMPANY_END.sub("", link_name(value))


def link_text(value: str | None) -> str:
    """Only Han characters, digits and Latin letters, in compatibility form and lower case."""
    return _NOT_LINKED.sub("", _compatible(value).lower())


def _vectorized(f):
    @F.pandas_udf(T.StringType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(f)

    return run


link_name_of, watch_name_of, shown_name_of, link_buyer_of, link_text_of = map(_vectorized, (link_name, watch_name, shown_name, link_buyer, link_text))


# -- pages


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self.cell = []
        elif tag in ("br", "p", "div") and self.cell is not None:
            self.cell.append(" ")

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            text = re.sub(r"\s+", " ", "".join(self.cell)).strip()
            if text:
                if not self.rows:
                    self.rows.append([])
                self.rows[-1].append(text)
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def table_rows(page: str | None) -> list[list[str]]:
    """Rows of cell texts of all tables of a page; empty cells and rows are dropped."""
    parser = _Tables()
    parser.feed(page or "")
    parser.close()
    return [r for r in parser.rows if r]


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def table_rows_of(pages: pd.Series) -> pd.Series:
    return pages.map(table_rows)


def beside_label(rows: Column, *labels: str) -> Column:
    """The cell right of the first cell (row by row) that holds one of the labels, spaces ignored; '' if none."""
    wanted = "|".join(re.escape(x) for x in labels)

    def in_row(row: Column) -> Column:
        found = F.filter(F.arrays_zip(F.slice(row, 1, F.greatest(F.size(row) - 1, F.lit(0))).alias("a"), F.slice(row, 2, F.greatest(F.size(row), F.lit(1))).alias("b")), lambda p: F.regexp_replace(p["a"], r"[\s:：]+", "").rlike(wanted))
        return F.try_element_at(found, F.lit(1))["b"]

    hits = F.filter(F.transform(rows, in_row), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(hits, F.lit(1)), F.lit(""))


# Fixed value: how a change notice's title ends behind the project's name.
_CHANGE_END = "(?:招标|采购|询比|磋商|谈判)(?:采购)?公告$"


def change_key(name: Column) -> Column:
    """A title for the dedup of changes: without its notice ending, then normalised."""
    return normalized_title(F.regexp_replace(F.coalesce(name, F.lit("")), _CHANGE_END, ""))


class _Data(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data):
        self.parts.append(data)


def data_text(page: str | None) -> str:
    """The data between tags, joined by spaces; comments are left out, unlike in ``plain_text``."""
    parser = _Data()
    parser.feed(page or "")
    parser.close()
    return re.sub(r"\s+", " ", " ".join(parser.parts)).strip()


data_text_of = _vectorized(data_text)


def project_title(title: Column, body: Column | None = None) -> Column:
    """A project's name: the labelled value of the body, else the title without its notice ending."""
    cut = F.regexp_replace(clean_text(title), "(?:" + "|".join(LINK_SUFFIXES) + ")+$", "")
    if body is None:
        return cut
    labelled = F.trim(F.regexp_extract(F.coalesce(body, F.lit("")), r"(?:项目名称|工程名称)\s*[:：]\s*([^\s，。；;]{4,80})", 1))
    return F.when(labelled != "", labelled).otherwise(cut)
