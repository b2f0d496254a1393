"""Money as written: labelled amounts, scaling, compact formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def labelled_amount(text: Column, labels: list[str], unit_required: bool = False) -> Column:
    """The amount that follows one of the labels, with its unit; '' if there is none."""
    unit = r"(?:亿元|万元|千元|元)"
    pattern = rf"(?:{'|'.join(labels)})\s*[（(]?[^\d\s]{{0,8}}?[:：]?\s*([¥￥]?\d[\d,]*(?:\.\d+)?\s*{unit}{'' if unit_required else '?'})"
    return F.regexp_replace(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1), r"\s+", "")


def compact_number(x: Column) -> Column:
    """At most six significant digits without trailing zeros."""
    size = F.when(x == 0, 0).otherwise(F.floor(F.log10(F.abs(x))).cast("int"))
    digits = F.greatest(F.lit(0), F.lit(5) - size)
    scale = F.pow(F.lit(10.0), digits)
    rounded = F.round(x * scale, 0) / scale
    text = F.format_string("%.8f", rounded)
    return F.regexp_replace(F.regexp_replace(text, r"0+$", ""), r"\.$", "")


def scaled_amount(x: Column) -> Column:
    """Yuan as text, in ten thousands from there on."""
    return F.when(x >= 10_000, F.concat(compact_number(x / 10_000), F.lit("万元"))).otherwise(F.concat(compact_number(x), F.lit("元")))


def with_unit(text: Column, unit: str = "万元") -> Column:
    """A bare number gets the unit, other text stays."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when(t.rlike(r"^[\d,.]+$"), F.concat(t, F.lit(unit))).otherwise(t)


def mapped_amount(fields: Column, labels: list[str]) -> Column:
    """The amount under the first of the labels that says anything: a bare number of yuan is scaled, other text stays; '' if none."""
    said = first_said(*[F.try_element_at(fields, F.lit(x)) for x in labels])
    number = F.regexp_replace(said, ",", "").try_cast("double")
    return F.when(said.rlike("元|万") | number.isNull(), said).otherwise(scaled_amount(number))


def first_said(*values: Column) -> Column:
    """The first value that is not blank; '' if all are."""
    return F.coalesce(*[F.when(F.trim(v) != "", v) for v in values], F.lit(""))


def joined_once(*values: Column) -> Column:
    """All values that are not blank, each once, joined by spaces."""
    return F.array_join(F.array_distinct(F.filter(F.array(*[F.trim(F.coalesce(v, F.lit(""))) for v in values]), lambda x: x != "")), " ")
