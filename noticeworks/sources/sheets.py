"""Spreadsheet workbooks as a data source, and the two imports built on it.

``spark.read.format("notice_xlsx").load(path)`` gives ``sheet, row, cells``: one row per sheet row, cells padded by column
letter, null where empty. Options: ``sheet`` (only this one; a name that is not there is an error). A folder or glob reads
all its workbooks, one partition each.
"""

from __future__ import annotations

import glob
import os
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.temporal import serial_date
from ..functions.text import clean_text

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it: any store that Arrow opens by its address; a plain path is local."""
    return fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


def workbooks(path: str) -> list[str]:
    """The workbooks of a folder or glob (globs are local), or the one at ``path``."""
    if "://" not in path and (found := sorted(glob.glob(path))) and not os.path.isdir(path):
        return found
    store, at = located(path)
    info = store.get_file_info(at)
    if info.type == fs.FileType.File:
        return [path]
    if info.type != fs.FileType.Directory:
        return []
    names = sorted(f.base_name for f in store.get_file_info(fs.FileSelector(at)) if f.base_name.endswith(".xlsx"))
    return [f"{path.rstrip('/')}/{n}" for n in names]


def _column(reference: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]*", reference)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def _text(cell, shared: list[str]) -> str | None:
    kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    if value is None or value.text is None:
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return "true" if value.text == "1" else "false"
    if kind in ("str", "e"):
        return value.text
    number = float(value.text)
    return str(int(number)) if number.is_integer() else repr(number)


def read_workbook(path: str, only: str | None = None) -> Iterator[tuple[str, int, list[str | None]]]:
    """``sheet, row, cells`` of a workbook."""
    store, at = located(path)
    with store.open_input_file(at) as raw, zipfile.ZipFile(raw) as book:
        names = set(book.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in root.iter(f"{_MAIN}si")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        sheets = [(s.get("name"), targets[s.get(_REL)]) for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")]
        if only is not None and only not in [n for n, _ in sheets]:
            raise KeyError(f"no sheet {only!r} in {path}")
        for name, target in sheets:
            if only is not None and name != only:
                continue
            part = target.lstrip("/") if target.startswith("/") else "xl/" + target
            for number, row in enumerate(ElementTree.fromstring(book.read(part)).iter(f"{_MAIN}row")):
                cells: list[str | None] = []
                for i, cell in enumerate(row.iter(f"{_MAIN}c")):
                    at = _column(cell.get("r")) if cell.get("r") else i
                    cells.extend([None] * (at + 1 - len(cells)))
                    cells[at] = _text(cell, shared)
                yield name, number, cells


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.files = workbooks(options["path"])
        if not self.files:
            raise FileNotFoundError(options["path"])
        self.sheet = options.get("sheet")

    def partitions(self):
        return [_File(f) for f in self.files]

    def read(self, partition):
        yield from read_workbook(partition.path, self.sheet)


class WorkbookSource(DataSource):
    @classmethod
    def name(cls):
        return "notice_xlsx"

    def schema(self):
        return "sheet string, row int, cells array<string>"

    def reader(self, schema):
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WorkbookSource)


def _cell(i: int) -> Column:
    return clean_text(F.try_element_at("cells", F.lit(i + 1)))


def source_accounts(rows: DataFrame) -> DataFrame:
    """Accounts of sources below one header row: the first three columns are filled down before blank rows are dropped."""
    filled = lambda i: F.coalesce(F.last(F.nullif(_cell(i), F.lit("")), ignorenulls=True).over(Window.partitionBy("sheet").orderBy("row")), F.lit(""))
    notes = F.concat_ws(" | ", F.nullif(_cell(7), F.lit("")), F.nullif(_cell(8), F.lit("")))
    body = rows.where("row > 0").withColumn("blank", F.concat(*[_cell(i) for i in range(9)]) == "")
    names = ["source_no", "source_name", "url"]
    out = body.select("row", "blank", *[filled(i).alias(n) for i, n in enumerate(names)], *[_cell(i + 3).alias(n) for i, n in enumerate(["company", "login_identity", "username", "password"])], notes.alias("notes"))
    return out.where("not blank").drop("blank")


def below_header(rows: DataFrame, *labels: str) -> DataFrame:
    """Rows below the first one that holds all ``labels``; an error if there is none."""
    marked = rows.where(F.forall(F.array(*[F.lit(x) for x in labels]), lambda x: F.exists("cells", lambda c: clean_text(c) == x)))
    first = marked.agg(F.min("row")).first()[0]
    if first is None:
        raise ValueError(f"no row with {labels}")
    return rows.where(F.col("row") > first)


def historical_tenders(rows: DataFrame, dates: tuple[int, ...] = (0, 7, 12)) -> DataFrame:
    """Past tenders from sheet rows of 17 columns, the second being the title; day counts in ``dates`` become dates."""
    names = ["collected_at", "title", "url", "budget", "summary", "location", "registration_fee", "registration_deadline", "buyer", "contact", "phone", "agency", "bid_deadline", "submission_channel", "submission_method", "submission_place", "remarks"]
    out = [(serial_date(_cell(i)) if i in dates else _cell(i)).alias(n) for i, n in enumerate(names)]
    return rows.select("row", *out).where("title != ''")
