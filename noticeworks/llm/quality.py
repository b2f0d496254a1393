"""Per-document text quality statistics and what they say a text is (problem 9).

All texts of an Arrow batch are one array of code points; a table of character classes turns it into counts per line and
per text, without a loop over characters. Then published fixed thresholds are applied, with the reason of every failure.

Defined results: null, empty and blank texts have zero counts, null ratios, no kind and the failure ``too few words``;
ties between kinds go to junk, then table, then list; repeated rows are kept; whole texts are read, of any length;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: More common words than this are no list of common words.
MOST_COMMON_WORDS = 10_000

# Published fixed thresholds: words 50 to 100,000, mean word length 3 to 10 (for texts in letters), symbol ratio 0.1, nine
# tenths bullet lines, three tenths of lines ending in an ellipsis, two common words; lines ending in punctuation.
LEAST_WORDS, MOST_WORDS = 50, 100_000
LEAST_WORD_LENGTH, MOST_WORD_LENGTH = 3.0, 10.0
MOST_SYMBOLS, MOST_BULLETS, MOST_ELLIPSES, LEAST_COMMON, LEAST_STOPS = 0.1, 0.9, 0.3, 2, 0.1
#: Mean word length below which a text is written in Han characters, each a word.
HAN_WORD_LENGTH = 1.6
#: Sizes up to which a line is a short item; a Latin word counts as WORD_SIZE Han characters.
ITEM_SIZE, QUANTITY_ITEM_SIZE, WORD_SIZE, LEAST_ITEMS = 13, 32, 2.2, 3

_BULLET = re.compile(r"(?:[-*•●○■◆◇·▪–—+>]|[一二三四五六七八九十百]+[、.．]|[（(](?:\d{1,3}|[一二三四五六七八九十]+|[a-z])[)）]|\d{1,3}(?:[.、．)）](?!\d)|\s)|[①-⑳])\s*")
_TAIL = re.compile(r"[。；;、,，.！!\s]+$")
_SENTENCE = re.compile(r"[。！？；!?;]|[a-z]\. ")
_QUANTITY = re.compile(r"(?:[，,、] ?|[㐀-鿿] )\d[\d.]* ?[^\W\d_]{0,4}[㎡]?$")
_MARKUP = re.compile(r"</?[A-Za-z][^<>]*>|^[.#@]?[\w-]+\s*\{[^{}]*\}|^\s*(?:function|var|let)\b.*[;{]$")
_ESCAPES = re.compile(r"(?:%[0-9A-Fa-f]{2}|\\u[0-9a-fA-F]{4}|\\x[0-9a-fA-F]{2}|&#\d+;){6,}")
_RULE = re.compile(r"[\s|:+=-]*\|[\s|:+=-]*")
_CELLS = re.compile(r"[^,]{1,40}(?:,[^,\s][^,]{0,40}){2,},?[；;。]?")
_UNITS = re.compile(r"[\s　。！？；!?;、，,]+")
_LATIN = re.compile(r"[a-z]+(?:['’-][a-z]+)*")

NEWLINE, SPACE, ALNUM, HAN, RARE, BROKEN, SYMBOL, STOP, JOINER, CODE, BULLET = (1 << i for i in range(11))


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Bits of the classes of every code point, by rule."""
    bits = np.zeros(0x110000, np.uint16)
    for code in range(0x110000):
        if 0xD800 <= code <= 0xDFFF or 0xE000 <= code <= 0xF8FF or code > 0x3FFFF:
            continue
        cat = unicodedata.category(chr(code))
        if cat[0] in "LN":
            bits[code] |= ALNUM
        elif cat[0] == "S":
            bits[code] |= SYMBOL
        elif cat[0] == "Z":
            bits[code] |= SPACE
    for code in (0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0x2028, 0x2029):
        bits[code] |= NEWLINE | SPACE
    bits[[0x09, 0x20, 0xA0, 0x3000, 0xFEFF]] |= SPACE
    for low, high in ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)):
        bits[low : high + 1] |= HAN | RARE
    # the Han characters of everyday use: the first level of GB 2312, rows 16 to 55
    cells = (bytes([row, cell]) for row in range(0xB0, 0xD8) for cell in range(0xA1, 0xFF))
    everyday = "".join(c.decode("gb2312", "ignore") for c in cells)
    bits[[ord(c) for c in everyday]] &= np.uint16(0xFFFF ^ RARE)
    bits[0x80:0x100] |= BROKEN
    bits[0x00:0x09] |= BROKEN
    bits[0xFFFD] |= BROKEN
    for chars, bit in (("#@^_~*|\\<>{}[]=+$%&/�", SYMBOL), ("。！？；!?;.…”’\"')）】", STOP), ("'’.,-", JOINER), ("+/=_-", CODE), ("-*•●○■◆◇·▪–—+>一二三四五六七八九十百（(0123456789①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳", BULLET)):
        bits[[ord(c) for c in chars]] |= bit
    bits[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] |= CODE
    return bits


def common_words_of(common_words: DataFrame, limit: int = MOST_COMMON_WORDS) -> tuple[frozenset[str], str | None]:
    """Words written with spaces, and one expression of all others, longest first; more than ``limit`` are refused."""
    words = sorted({r[0] for r in common_words.select("word").where("word is not null and word != ''").limit(limit + 1).collect()}, key=lambda w: (-len(w), w))
    if len(words) > limit:
        raise ValueError(f"more than {limit} common words")
    return frozenset(w.lower() for w in words if w.isascii()), "|".join(re.escape(w) for w in words if not w.isascii()) or None


def _item(line: str, han: int, latin: int) -> bool:
    """Is the line a short item by itself?"""
    rest = _TAIL.sub("", _BULLET.sub("", line, count=1) if _BULLET.match(line) else line)
    if _SENTENCE.search(rest):
        return False
    head = line[: len(line) - len(rest)]
    size = han - sum("㐀" <= c <= "鿿" for c in head) + WORD_SIZE * (latin - any(c.isdigit() for c in head))
    return ("，" not in rest and size <= ITEM_SIZE) or (size <= QUANTITY_ITEM_SIZE and bool(_QUANTITY.search(rest)))


def _periodic(line: str) -> bool:
    """Is the line one thing over and over?"""
    n = len(line)
    if n < 8:
        return False
    again = line.find(line[:2], 2)
    return 0 < again <= n / 4 and len(line) - line.count(line[:again]) * again <= 0.2 * n


def measure(texts: list[str], spaced: frozenset[str], whole: re.Pattern | None) -> dict[str, np.ndarray]:
    """Counts of every text, as arrays."""
    n = len(texts)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    bits = classes()[points]
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask.astype(np.int64), starts) if n else np.zeros(0, np.int64)

    def has(bit: int) -> np.ndarray:
        return (bits & np.uint16(bit)) != 0

    alnum, han, space = has(ALNUM), has(HAN), has(SPACE)
    other = alnum & ~han
    joined = np.zeros(len(bits), bool)
    joined[1:-1] = has(JOINER)[1:-1] & other[:-2] & other[2:]
    word = other | joined
    word_start = word.copy()
    word_start[1:] &= ~word[:-1]
    out = {
        "n_chars": sizes,
        "letters": per_text(alnum),
        "words": per_text(word_start) + per_text(han),
        "ink": per_text(~space),
        "symbols": per_text(has(SYMBOL)),
    }
    # lines: from newline to newline, without outer spaces
    breaks = np.flatnonzero(has(NEWLINE))
    first = np.concatenate([[0], breaks[:-1] + 1]).astype(np.int64) if len(breaks) else np.zeros(0, np.int64)
    ink = np.flatnonzero(~space)
    a, b = np.searchsorted(ink, first), np.searchsorted(ink, breaks)
    filled = b > a
    first, begin, end = first[filled], ink[a[filled]], ink[b[filled] - 1] + 1
    owner = np.searchsorted(starts, first, side="right") - 1
    length = end - begin
    m = len(begin)

    def per_line(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[end] - total[begin]

    def lines_with(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner[mask], minlength=n)

    l_alnum, l_han, l_rare, l_broken = per_line(alnum), per_line(han), per_line(has(RARE)), per_line(has(BROKEN))
    l_word = per_line(word_start)
    pipes, tabs, commas = per_line(points == 0x7C), per_line(points == 0x09), per_line(points == 0x2C)
    wide_comma, tags, percents = per_line(points == 0xFF0C), per_line((points == 0x3C) | (points == 0x7B)), per_line((points == 0x25) | (points == 0x5C) | (points == 0x26))
    gap = np.zeros(len(bits), bool)
    gap[2:] = ~space[2:] & (points[1:-1] == 0x20) & (points[:-2] == 0x20)
    wide_gap = np.zeros(len(bits), bool)
    wide_gap[1:] = ~space[1:] & (points[:-1] == 0x3000)
    gaps = per_line(gap | wide_gap) - (gap | wide_gap)[begin] if m else np.zeros(0, np.int64)
    code = has(CODE)
    since = np.arange(len(bits)) - np.maximum.accumulate(np.where(~code, np.arange(len(bits)), -1))
    encoded = per_line(code & (since == 40)) > 0
    last, start_bits = end - 1, bits[begin] if m else np.zeros(0, np.uint16)
    stops = (bits[last] & np.uint16(STOP)) != 0
    ellipses = (points[last] == 0x2026) | ((points[last] == 0x2E) & (length >= 3) & (points[np.maximum(last - 1, 0)] == 0x2E) & (points[np.maximum(last - 2, 0)] == 0x2E))
    junk = encoded | (l_broken > 0.15 * length) | ((l_han >= 6) & (l_rare > 0.3 * l_han)) | (l_alnum < 0.4 * length)
    table = (tabs > 0) | (pipes >= 2) | (gaps >= 2)
    bullets = (start_bits & np.uint16(BULLET)) != 0
    rule = np.zeros(m, bool)
    item = np.zeros(m, bool)
    maybe_item = (l_han + WORD_SIZE * l_word <= QUANTITY_ITEM_SIZE + 8) & ((wide_comma == 0) | (l_han + WORD_SIZE * l_word <= QUANTITY_ITEM_SIZE + 8))
    # one thing over and over has its first two characters four times at least (unit <= a quarter, four fifths covered)
    opens = np.zeros(len(bits), np.int64)
    opens[begin] = 1
    line_of = np.maximum(np.cumsum(opens) - 1, 0)
    again = np.zeros(len(bits), bool)
    if m:
        again[:-1] = (points[:-1] == points[begin][line_of[:-1]]) & (points[1:] == points[np.minimum(begin + 1, len(points) - 1)][line_of[:-1]])
    maybe_periodic = (length >= 8) & (per_line(again) >= 4)
    at = begin - starts[owner]
    # only lines that one of the patterns can match are looked at as text
    for i in np.flatnonzero((tags > 0) | (percents >= 6) | (commas >= 2) | bullets | maybe_item | (pipes > 0) | maybe_periodic):
        text = texts[owner[i]]
        line = text[at[i] : at[i] + length[i]]
        if bullets[i]:
            bullets[i] = _BULLET.match(line) is not None
        if pipes[i] and _RULE.fullmatch(line):
            rule[i] = True
            continue
        if junk[i]:
            continue
        if (tags[i] and _MARKUP.search(line)) or (percents[i] >= 6 and _ESCAPES.search(line)) or _periodic(line):
            junk[i] = True
        elif table[i]:
            continue
        elif commas[i] >= 2 and _CELLS.fullmatch(line):
            table[i] = True
        elif maybe_item[i]:
            item[i] = _item(line, l_han[i], l_word[i])
    table = rule | (table & ~junk)
    junk &= ~rule
    item &= ~(table | junk)
    out |= {
        "lines": lines_with(np.ones(m, bool)), "stops": lines_with(stops), "bullets": lines_with(bullets), "ellipses": lines_with(ellipses), "items": lines_with(item),
        "ink_lines": np.bincount(owner, length, minlength=n), "list": np.bincount(owner[item], length[item], minlength=n), "table": np.bincount(owner[table], length[table], minlength=n), "junk": np.bincount(owner[junk], length[junk], minlength=n),
    }
    common, repeated = np.zeros(n, np.int64), np.zeros(n, bool)
    for i, text in enumerate(texts):
        if not text:
            continue
        low = text.lower()
        common[i] = (len(whole.findall(low)) if whole else 0) + sum(w in spaced for w in _LATIN.findall(low))
        units = [u for u in _UNITS.split(text) if u]
        distinct = len(set(units))
        repeated[i] = len(units) >= 8 and (distinct <= 2 or distinct <= 0.08 * len(units))
    return out | {"common": common, "repeated": repeated}


_NUMBERS = ["mean_word_length", "symbol_ratio", "punct_line_share", "common_share", "bullet_share", "list_share", "table_share", "junk_share"]


def text_quality(docs: DataFrame, common_words: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its statistics, the kind of text it is where it is not prose, and the reasons of all failed rules.

    Columns: ``key, n_chars, word_count, mean_word_length, symbol_ratio, punct_line_share, common_share, bullet_share,
    list_share, table_share, junk_share, kind, failures``. ``kind`` is list, table or junk where these take more than half.
    """
    spaced, pattern = common_words_of(common_words)
    key_type = docs.schema[key].dataType.simpleString()
    counted = ["n_chars", "words", "letters", "ink", "symbols", "lines", "stops", "bullets", "ellipses", "items", "ink_lines", "list", "table", "junk", "common"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = re.compile(pattern) if pattern else None
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = measure([t or "" for t in part.column(1).to_pylist()], spaced, whole)
                arrays = [part.column(0), *[pa.array(found[c].astype(np.int64)) for c in counted], pa.array(found["repeated"])]
                yield pa.RecordBatch.from_arrays(arrays, names=[key, *counted, "repeated"])

    df = docs.select(key, text).mapInArrow(run, f"{key} {key_type}, " + ", ".join(f"`{c}` bigint" for c in counted) + ", repeated boolean")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    plain = ~F.col("repeated")
    df = df.withColumns(
        {
            "mean_word_length": share("letters", "words"),
            "symbol_ratio": share("symbols", "ink"),
            "punct_line_share": share("stops", "lines"),
            "common_share": share("common", "words"),
            "bullet_share": share("bullets", "lines"),
            "list_share": F.when(F.col("ink_lines") > 0, F.when(plain & (F.col("items") >= LEAST_ITEMS), F.col("list") / F.col("ink_lines")).otherwise(0.0)),
            "table_share": F.when(F.col("ink_lines") > 0, F.when(plain, F.col("table") / F.col("ink_lines")).otherwise(0.0)),
            "junk_share": F.when(F.col("ink_lines") > 0, F.when(plain, F.col("junk") / F.col("ink_lines")).otherwise(1.0)),
        }
    )
    j, b, li = F.col("junk_share"), F.col("table_share"), F.col("list_share")
    df = df.withColumn("kind", F.when(j + b + li > 0.5, F.when((j >= b) & (j >= li), "junk").when(b >= li, "table").otherwise("list")))
    rules = [
        ("too few words", F.col("words") < LEAST_WORDS),
        ("too many words", F.col("words") > MOST_WORDS),
        ("mean word length", (F.col("mean_word_length") >= HAN_WORD_LENGTH) & ~F.col("mean_word_length").between(LEAST_WORD_LENGTH, MOST_WORD_LENGTH)),
        ("symbols", F.col("symbol_ratio") > MOST_SYMBOLS),
        ("bullet lines", F.col("bullet_share") > MOST_BULLETS),
        ("ellipsis lines", F.col("ellipses") > MOST_ELLIPSES * F.col("lines")),
        ("few common words", F.col("common") < LEAST_COMMON),
        ("lines without end", F.col("punct_line_share") < LEAST_STOPS),
        ("list", F.col("kind") == "list"),
        ("table", F.col("kind") == "table"),
        ("junk", F.col("kind") == "junk"),
    ]
    failures = F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules]))
    return df.select(key, "n_chars", F.col("words").alias("word_count"), *[F.round(c, 6).alias(c) for c in _NUMBERS], "kind", failures.alias("failures"))
