"""Queries of the training-text problems over the tables of TESTDATA.md."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import table
from .bpe import decode_texts, encode_texts
from .history import alike, repeats
from .leaks import find_leaks, remove_leaks
from .looks import CLASSES, HYPHENS, RADICALS, look_classes, one_form, same_look
from .names import link_names
from .overlap import similar_groups, similar_pairs
from .quality import text_quality


def p1_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Title and buyer of every tender in one form."""
    rows = table(spark, folder, "tenders").select("id", "title", "buyer")
    return one_form(rows, ["title", "buyer"]).select("id", "title_form", "buyer_form")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return same_look(table(spark, folder, "tenders"), "id", ["title", "buyer"])


def p1_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Every tender with a partner of the same look: its look, its class of equally stored rows, and its number of partners."""
    return look_classes(table(spark, folder, "tenders"), "id", ["title", "buyer"])


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return repeats(table(spark, folder, "tenders").select("id", "batch_no", "fingerprint", "canonical_url"))


def p3_near(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of later batches whose title and summary an accepted row covers by four fifths, with that row and the coverage."""
    return alike(table(spark, folder, "tenders").select("id", "batch_no", "title", "summary"), ["title", "summary"])


def p5_names(spark: SparkSession, folder: str) -> DataFrame:
    """Every buyer and agency that is registered, with the organisation and the edits between."""
    rows = table(spark, folder, "tenders").select("id", "buyer", "agency")
    return link_names(rows, table(spark, folder, "organizations"), "id", ["buyer", "agency"])


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "organizations").select(F.col("org_id").cast("bigint").alias("org_id"), "name")
    out = p5_names(spark, folder).join(names, "org_id")
    return out.where("value != name").select("id", "field", "org_id")


_P6_PARTS = ["title", "project_name", "project_content"]


def _with_content(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "verified_notices").where("project_content is not null and project_content != ''").select("notice_id", *_P6_PARTS)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    out = similar_pairs(_with_content(spark, folder), "notice_id", _P6_PARTS)
    return out.select(F.col("id_a").alias("notice_id_a"), F.col("id_b").alias("notice_id_b"))


def p6_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every notice with content: its class of equal notices, its group of similar ones, and its number of links."""
    return similar_groups(_with_content(spark, folder), "notice_id", _P6_PARTS).withColumnRenamed("id", "notice_id")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_texts(table(spark, folder, "documents").select("doc_id", "text"))


def p7_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as its ids are decoded again; null comes back as empty."""
    return decode_texts(encode_texts(table(spark, folder, "documents").select("doc_id", "text")))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "eval_items"))


def p8_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Every document after its leaked spans were cut, or dropped where they cover most of it."""
    out = remove_leaks(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "eval_items"))
    return out.withColumn("coverage", F.round("coverage", 6))


def p9_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of every document, with the failed rules in one text."""
    out = text_quality(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "common_words"))
    return out.withColumn("failures", F.concat_ws("; ", "failures"))


def p9_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Those statistics of every document that SQL can give as well."""
    out = text_quality(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "common_words"))
    return out.select("doc_id", "n_chars", "word_count", "mean_word_length", "symbol_ratio", "punct_line_share", "common_share")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    out = text_quality(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "common_words"))
    return out.where("kind is not null").select("doc_id", "kind")


QUERIES = {"p1_found": p1_found, "p1_forms": p1_forms, "p1_classes": p1_classes, "p3_found": p3_found, "p3_near": p3_near, "p5_found": p5_found, "p5_names": p5_names, "p6_found": p6_found, "p6_groups": p6_groups, "p7_ids": p7_ids, "p7_round_trip": p7_round_trip, "p8_found": p8_found, "p8_clean": p8_clean, "p9_counts": p9_counts, "p9_found": p9_found, "p9_statistics": p9_statistics}
_FOLD = "lower(translate(<text>, '" + "".join(map(chr, range(0xFF01, 0xFF5F))).replace("'", "''") + "', '" + "".join(map(chr, range(0x21, 0x7F))).replace("'", "''") + "'))"
_LETTERS = lambda c: f"regexp_replace({_FOLD.replace('<text>', c)}, '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_PAGE = r"""lower(regexp_extract(trim(canonical_url), '(?i)^https?://([^/?#:]+)', 1)) || url_decode(regexp_replace(regexp_extract(trim(canonical_url), '(?i)^https?://[^/?#]*([^?#]*)', 1), '/+$', ''))
    || '?' || array_to_string(list_sort(list_filter(string_split(regexp_extract(trim(canonical_url), '^[^?#]*[?]([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_[a-z0-9_]*|spm|from)='))), '&')"""

_HAN = r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"
_SPACE = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
_STOPS = "。！？；!?;.…”’\"'')）】"

# A look in SQL: folded, composed, and every letter as the first of its look-alikes (one reading or another makes no difference there).
_quoted = lambda t: t.replace("'", "''")
_FIRST = {ch: group[0] for group in CLASSES for ch in group[1:]}
_FROM_TO = {**{chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}, **RADICALS, **dict.fromkeys(HYPHENS, "-"), **{chr(c): " " for c in (0x09, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)}}
_FROM_TO |= {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in (*range(0x2F00, 0x2FD6), *range(0xFF61, 0xFFBF), 0xFFE5) if len(unicodedata.normalize("NFKC", chr(c))) == 1}
_SHOWN_NOT = r"[\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{E0001}-\x{E01EF}]"
_LOOK = lambda c: f"translate(nfc_normalize(translate(nfc_normalize(translate(regexp_replace({c}, '{_SHOWN_NOT}', '', 'g'), '{_quoted(''.join(_FROM_TO))}', '{_quoted(''.join(_FROM_TO.values()))}')), '{''.join(_FIRST)}', '{''.join(_FIRST.values())}')), '{''.join(_FIRST)}', '{''.join(_FIRST.values())}')"

SQL: dict[str, str] = {
    "p1_found": f"""WITH t AS (SELECT id, title, buyer, {_LOOK('title')} AS t, {_LOOK('buyer')} AS b FROM tenders WHERE title <> '' AND buyer <> '')
    SELECT x.id AS id_a, y.id AS id_b FROM t x JOIN t y ON x.t = y.t AND x.b = y.b AND x.id < y.id WHERE x.title <> y.title OR x.buyer <> y.buyer""",
    "p1_classes": f"""WITH t AS (SELECT id, title, buyer, {_LOOK('title')} AS t, {_LOOK('buyer')} AS b FROM tenders WHERE title <> '' AND buyer <> ''),
    c AS (SELECT id, min(id) OVER (PARTITION BY t, b) AS look_id, min(id) OVER (PARTITION BY t, b, title, buyer) AS class_id, count(*) OVER (PARTITION BY t, b) - count(*) OVER (PARTITION BY t, b, title, buyer) AS links FROM t)
    SELECT * FROM c WHERE links > 0""",
    "p7_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p8_clean": f"""WITH i AS (SELECT {_LETTERS('text')} AS t FROM eval_items), d AS (SELECT doc_id, text, {_LETTERS('text')} AS t FROM documents),
    a AS (SELECT DISTINCT substr(t, n, 40) AS w FROM (SELECT t, unnest(range(1, length(t) - 38)) AS n FROM i WHERE length(t) >= 40)),
    b AS (SELECT doc_id, n FROM (SELECT doc_id, t, unnest(range(1, length(t) - 38)) AS n FROM d WHERE length(t) >= 40) x JOIN a ON substr(x.t, x.n, 40) = a.w),
    g AS (SELECT doc_id, n, sum(start) OVER (PARTITION BY doc_id ORDER BY n) AS g FROM (SELECT doc_id, n, CASE WHEN n - lag(n, 1, -100) OVER (PARTITION BY doc_id ORDER BY n) > 40 THEN 1 ELSE 0 END AS start FROM b)),
    s AS (SELECT doc_id, g, min(n) AS s, max(n) + 39 AS e FROM g GROUP BY doc_id, g),
    n AS (SELECT s.doc_id, count(*) AS n_spans, cast(sum(e - s + 1) AS bigint) AS leaked, sum(e - s + 1) / any_value(length(d.t)) AS share FROM s JOIN d ON s.doc_id = d.doc_id GROUP BY s.doc_id),
    p AS (SELECT doc_id, i, ch, sum(letter) OVER (PARTITION BY doc_id ORDER BY i) AS k, letter FROM (SELECT doc_id, i, ch, CASE WHEN regexp_matches(ch, '[\\p{{L}}\\p{{N}}]') THEN 1 ELSE 0 END AS letter FROM (SELECT doc_id, unnest(range(1, length(text) + 1)) AS i, unnest(string_split(text, '')) AS ch FROM d WHERE doc_id IN (SELECT doc_id FROM n)))),
    r AS (SELECT s.doc_id, min(p.i) AS f, max(p.i) AS l FROM s JOIN p ON p.doc_id = s.doc_id AND p.letter = 1 AND p.k BETWEEN s.s AND s.e GROUP BY s.doc_id, s.g),
    k AS (SELECT p.doc_id, string_agg(p.ch, '' ORDER BY p.i) AS text FROM p WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = p.doc_id AND p.i BETWEEN r.f AND r.l) GROUP BY p.doc_id)
    SELECT d.doc_id, coalesce(n_spans, 0) AS n_spans, coalesce(leaked, 0) AS leaked_chars, round(coalesce(share, 0), 6) AS coverage, CASE WHEN n.doc_id IS NULL THEN 'keep' WHEN share > 0.5 THEN 'drop' ELSE 'cut' END AS action,
      CASE WHEN n.doc_id IS NULL THEN d.text WHEN share > 0.5 THEN NULL ELSE coalesce(k.text, '') END AS text FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN k ON d.doc_id = k.doc_id""",
    "p9_counts": rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    c AS (SELECT doc_id, length(t) AS n_chars, length(t) - length(regexp_replace(t, '{_HAN}', '', 'g')) + len(regexp_extract_all(regexp_replace(t, '{_HAN}', ' ', 'g'), '[\p{{L}}\p{{N}}]+(?:[''’.,-][\p{{L}}\p{{N}}]+)*')) AS word_count,
      length(t) - length(regexp_replace(t, '[\p{{L}}\p{{N}}]', '', 'g')) AS letters, length(regexp_replace(t, '{_SPACE}', '', 'g')) AS ink,
      length(t) - length(regexp_replace(t, '[\p{{S}}#@^_~*|\\<>{{}}\[\]=+$%&/]', '', 'g')) AS symbols FROM d),
    l AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE contains('{_STOPS}', right(x, 1))) AS stops FROM (SELECT doc_id, regexp_replace(x, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS x FROM (SELECT doc_id, unnest(string_split_regex(t, '[\n\r\x{{0b}}\x{{0c}}\x{{85}}\x{{2028}}\x{{2029}}]')) AS x FROM d)) WHERE x <> '' GROUP BY doc_id)
    , g AS (SELECT string_agg(word, '|' ORDER BY length(word) DESC, word) FILTER (WHERE NOT regexp_matches(word, '^[\x00-\x7f]*$')) AS whole, list(lower(word)) FILTER (WHERE regexp_matches(word, '^[\x00-\x7f]+$')) AS spaced FROM common_words),
    h AS (SELECT doc_id, len(regexp_extract_all(lower(t), whole)) + len(list_filter(regexp_extract_all(lower(t), '[a-z]+(?:[''’-][a-z]+)*'), lambda w: list_contains(spaced, w))) AS common FROM d, g)
    SELECT c.doc_id, n_chars, word_count, CASE WHEN word_count > 0 THEN round(letters / word_count, 6) END AS mean_word_length, CASE WHEN ink > 0 THEN round(symbols / ink, 6) END AS symbol_ratio,
      round(stops / n, 6) AS punct_line_share, CASE WHEN word_count > 0 THEN round(common / word_count, 6) END AS common_share FROM c JOIN h ON c.doc_id = h.doc_id LEFT JOIN l ON c.doc_id = l.doc_id""",
    "p3_found": f"""WITH RECURSIVE k AS (
        SELECT id, 'f' || lower(regexp_extract(fingerprint, '([0-9A-Fa-f]{{64}})', 1)) AS key FROM tenders WHERE regexp_matches(coalesce(fingerprint, ''), '[0-9A-Fa-f]{{64}}')
        UNION ALL SELECT id, 'u' || {_PAGE} FROM tenders WHERE regexp_matches(trim(coalesce(canonical_url, '')), '(?i)^https?://')),
    e AS (SELECT DISTINCT x.id AS a, y.id AS b FROM k x JOIN k y ON x.key = y.key AND x.id <> y.id),
    r AS (SELECT a AS id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON r.id = e.a)
    SELECT min(root) AS first_id, r.id FROM r JOIN tenders t ON r.id = t.id WHERE t.batch_no >= 1 GROUP BY r.id HAVING min(root) < r.id""",
    "p6_found": r"""WITH s AS (SELECT notice_id, regexp_replace(lower(coalesce(title, '') || coalesce(project_name, '') || project_content), '[^\p{L}\p{N}]+', '', 'g') AS t FROM verified_notices WHERE project_content <> ''),
    g AS (SELECT DISTINCT notice_id, substr(t, i, 3) AS g FROM (SELECT notice_id, t, unnest(range(1, length(t) - 1)) AS i FROM s)),
    n AS (SELECT notice_id, count(*) AS n FROM g GROUP BY notice_id),
    o AS (SELECT a.notice_id AS x, b.notice_id AS y, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.notice_id < b.notice_id GROUP BY 1, 2)
    SELECT x AS notice_id_a, y AS notice_id_b FROM o JOIN n p ON p.notice_id = x JOIN n q ON q.notice_id = y WHERE c >= 0.6 * (p.n + q.n - c)""",
    "p6_groups": r"""WITH RECURSIVE s AS (SELECT notice_id, regexp_replace(lower(coalesce(title, '') || coalesce(project_name, '') || project_content), '[^\p{L}\p{N}]+', '', 'g') AS t FROM verified_notices WHERE project_content <> ''),
    g AS (SELECT DISTINCT notice_id, substr(t, i, 3) AS g FROM (SELECT notice_id, t, unnest(range(1, length(t) - 1)) AS i FROM s)),
    n AS (SELECT notice_id, count(*) AS n, list_sort(list(g)) AS whole FROM g GROUP BY notice_id),
    c AS (SELECT notice_id, min(notice_id) OVER (PARTITION BY whole) AS class_id FROM n),
    o AS (SELECT a.notice_id AS x, b.notice_id AS y, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.notice_id <> b.notice_id GROUP BY 1, 2),
    e AS (SELECT x, y FROM o JOIN n p ON p.notice_id = x JOIN n q ON q.notice_id = y WHERE c >= 0.6 * (p.n + q.n - c)),
    r AS (SELECT notice_id AS root, notice_id AS at FROM n UNION SELECT r.root, e.y FROM r JOIN e ON r.at = e.x)
    SELECT c.notice_id, class_id, min(root) AS group_id, (SELECT count(*) FROM e WHERE e.x = c.notice_id) AS links FROM c JOIN r ON r.at = c.notice_id GROUP BY c.notice_id, class_id""",
    "p8_found": f"""WITH i AS (SELECT item_id, {_LETTERS('text')} AS t FROM eval_items), d AS (SELECT doc_id, {_LETTERS('text')} AS t FROM documents WHERE text IS NOT NULL),
    a AS (SELECT DISTINCT item_id, substr(t, n, 40) AS w FROM (SELECT item_id, t, unnest(range(1, length(t) - 38)) AS n FROM i WHERE length(t) >= 40)),
    b AS (SELECT DISTINCT doc_id, substr(t, n, 40) AS w FROM (SELECT doc_id, t, unnest(range(1, length(t) - 38)) AS n FROM d WHERE length(t) >= 40))
    SELECT DISTINCT doc_id, item_id FROM a JOIN b ON a.w = b.w""",
}
