"""Queries of the general training-data problems (2 and 4) over the tables of TESTDATA.md."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.timestamps import normalise_times
from ..operators.units import harmonise_amounts, hidden_unit_accuracy
from ..runtime import small
from ..tables import table


def p2_units(spark: SparkSession, folder: str) -> DataFrame:
    """Every tender with its amount in fen, where its unit comes from, and how sure a bare number's unit is; bare numbers have the
    unit of highest posterior, no rule is given."""
    rows = table(spark, folder, "tenders").select("id", "budget", "summary")
    out = harmonise_amounts(rows, "budget", "summary", bare_rule=None)
    return out.select("id", "status", "unit", "unit_source", "fen", "likely_unit", F.round("posterior", 6).alias("posterior"), "uncertain")


def p2_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Per unit, how many amounts the mixture gives the right unit when only their number is shown to it."""
    return hidden_unit_accuracy(table(spark, folder, "tenders").select("budget", "summary"), "budget", "summary")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "tenders").select("id", "budget", "summary")
    return harmonise_amounts(rows, "budget", "summary").where("fen is not null").select("id", "fen")


def p4_times(spark: SparkSession, folder: str) -> DataFrame:
    """Every stated point of time with the reading that was chosen."""
    fields = ["notice_id", "source_name", "first_seen_at", "published_at", "bid_deadline", "registration_period"]
    return normalise_times(table(spark, folder, "verified_notices").select(*fields), small(table(spark, folder, "source_names")))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return p4_times(spark, folder).select("notice_id", "field", "utc_ms")


QUERIES = {"p2_found": p2_found, "p2_units": p2_units, "p2_accuracy": p2_accuracy, "p4_found": p4_found, "p4_times": p4_times}
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F))).replace("'", "''") + "　￥"
_PLAIN = "".join(map(chr, range(0x21, 0x7F))).replace("'", "''") + " ¥"
_PART = lambda c, u: f"greatest(0, instr('零一二三四五六七八九', regexp_extract({c}, '([一二三四五六七八九]){u}', 1)) - 1) * (CASE WHEN regexp_matches({c}, '[一二三四五六七八九]{u}') THEN 1 ELSE 0 END)"
_SECTION = lambda c: f"({_PART(c, '千')} * 1000 + {_PART(c, '百')} * 100 + CASE WHEN regexp_matches({c}, '(^|[零千百])十') THEN 10 ELSE {_PART(c, '十')} * 10 END + {_PART(c, '$')})"

SQL: dict[str, str] = {
    "p2_found": rf"""WITH n AS (SELECT id, lower(regexp_replace(translate(budget, '{_WIDE}', '{_PLAIN}'), '\s+', '', 'g')) AS s, regexp_replace(translate(coalesce(summary, ''), '{_WIDE}', '{_PLAIN}'), '\s+', '', 'g') AS c FROM tenders),
    k AS (SELECT id, s, c, regexp_matches(s, '\d') AS arabic FROM n WHERE s <> '' AND NOT regexp_matches(s, '美元|欧元|日元|港元|usd|eur|\$|€|£|%|折扣|下浮|每|单价|/|㎡') AND NOT regexp_matches(s, '\d[亿万千百]*元?[-~—至到]+\d')),
    a AS (SELECT id, cast(replace(regexp_extract(s, '(\d[\d,]*(?:\.\d+)?)', 1), ',', '') AS decimal(24, 6)) AS v, regexp_extract(s, '\d[\d,]*(?:\.\d+)?(亿|千万|百万|十万|万|千|仟|百|million|m|w)?', 1) AS u,
      regexp_matches(s, '¥|rmb|cny|人民币|元|圆') OR regexp_extract(s, '\d[\d,]*(?:\.\d+)?(亿|千万|百万|十万|万|千|仟|百|million|m|w)?', 1) <> '' AS stated, regexp_extract(c, '(?:单位|预算以|金额以|金额均以)为?[:：]?(?:人民币)?(亿|百万|万|千)?元', 1) AS g FROM k WHERE arabic),
    w AS (SELECT id, translate(regexp_extract(s, '([零一二三四五六七八九两壹贰叁肆伍陆柒捌玖十百千万亿拾佰仟]+)(?:元|圆)', 1), '两壹贰叁肆伍陆柒捌玖拾佰仟', '二一二三四五六七八九十百千') AS t FROM k WHERE NOT arabic),
    p AS (SELECT id, CASE WHEN contains(t, '亿') THEN split_part(t, '亿', 1) ELSE '' END AS y, CASE WHEN contains(t, '亿') THEN split_part(t, '亿', 2) ELSE t END AS r FROM w WHERE t <> ''),
    q AS (SELECT id, y, CASE WHEN contains(r, '万') THEN split_part(r, '万', 1) ELSE '' END AS m, CASE WHEN contains(r, '万') THEN split_part(r, '万', 2) ELSE r END AS e FROM p),
    f AS (SELECT id, v * (CASE CASE WHEN stated THEN u ELSE g END WHEN '亿' THEN 100000000 WHEN '千万' THEN 10000000 WHEN '百万' THEN 1000000 WHEN 'm' THEN 1000000 WHEN 'million' THEN 1000000 WHEN '十万' THEN 100000
      WHEN '万' THEN 10000 WHEN 'w' THEN 10000 WHEN '千' THEN 1000 WHEN '仟' THEN 1000 WHEN '百' THEN 100 ELSE 1 END) * 100 AS x FROM a
      UNION ALL SELECT id, ({_SECTION('y')} * 100000000 + {_SECTION('m')} * 10000 + {_SECTION('e')}) * 100 FROM q)
    SELECT id, cast(round(x) AS bigint) AS fen FROM f WHERE x > 0""",
}
