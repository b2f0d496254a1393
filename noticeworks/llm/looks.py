"""Text that looks the same brought to one form (problem 1).

A text is first freed of characters that show nothing, composed, and folded where compatibility is only a matter of
width, of the kind of a space, or of a radical's own code point. Raised, circled and squared signs stay what they are.
Then every run of Latin, Greek and Cyrillic letters becomes a lattice of look-alikes, and Viterbi picks the reading with
the best script-consistent character bigrams. The lattice is the same for all spellings of one look, and so is its reading.

Defined results: null stays null, empty stays empty; ties go to the alternative that comes first in the class; texts of
any length are read whole; repeated rows are kept; an empty table gives an empty result; other columns are untouched.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import written

# Letters of the three scripts that look alike, Latin first.
CLASSES = [
    "AАΑ", "BВΒ", "CСϹ", "EЕΕ", "FϜ", "HНΗ", "IІΙӀ", "JЈͿ", "KКΚ", "MМΜ", "NΝ", "OОΟ", "PРΡ", "QԚ", "SЅ", "TТΤ", "WԜ", "XХΧ", "YУΥҮ", "ZΖ", "GԌ",
    "aаɑ", "cсϲ", "dԁ", "eе", "gɡ", "hһ", "iіι", "jјϳ", "lӏ", "oоο", "pрρ", "qԛ", "sѕ", "uυ", "vѵν", "wԝ", "xх", "yуγ",
]
# Radicals with code points of their own and the characters they look like.
RADICALS = dict(
    zip(
        "⺁⺅⺉⺊⺌⺍⺎⺏⺐⺒⺓⺔⺕⺖⺗⺘⺙⺛⺜⺝⺞⺟⺠⺡⺢⺣⺤⺦⺧⺨⺩⺪⺫⺬⺭⺮⺯⺰⺱⺲⺶⺷⺹⺺⺻⺼⺽⺾⺿⻀⻁⻂⻃⻄⻅⻆⻇⻈⻉⻋⻌⻍⻎⻐⻑⻒⻓⻔⻕⻖⻗⻘⻙⻚⻛⻜⻝⻞⻟⻠⻡⻢⻣⻤⻥⻦⻧⻨⻩⻪⻫⻬⻭⻮⻯⻰⻱⻲⻳",
        "厂亻刂卜小小兀尣尢巳幺彑彐忄心扌攵旡日月歺母民氵氺灬爫丬牛犭王疋目示礻竹糹纟罒罒羊羊耂肀聿肉臼艹艹艹虎衤覀西见角角讠贝车辶辶辶钅長镸长门阜阝雨青韦页风飞食食飠饣首马骨鬼鱼鸟卤麦黄黾斉齐歯齿竜龙龜亀龟",
    )
)
# Hyphens that look like the plain one.
HYPHENS = "‐‑﹣−"

_LETTERS = re.compile("[A-Za-zÀ-ɏɐ-ʯͰ-Ͽἀ-῿Ѐ-ԯḀ-ỿ][A-Za-zÀ-ɏɐ-ʯͰ-Ͽἀ-῿Ѐ-ԯḀ-ỿ\u0300-\u036f]*")
_MARKS = re.compile("[\u0300-\u036f]+")
_PLAIN = re.compile("[ -~一-鿿、。]*")
_ALTERNATIVES = {ch: group for group in CLASSES for ch in group}
#: Weight of a change of script inside a run of letters, in bits.
SCRIPT_CHANGE = 12.0


def _ignorable(ch: str) -> bool:
    code = ord(ch)
    return unicodedata.category(ch) == "Cf" or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF or code in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, 0x180B, 0x180C, 0x180D, 0x180F)


@lru_cache(maxsize=70_000)
def _folded(ch: str) -> str:
    """One character by itself: gone, a plain space, or its own plain form where only width or code point differ."""
    if _ignorable(ch):
        return ""
    if unicodedata.category(ch) == "Zs" or ch == "\t":
        return " "
    if ch in HYPHENS:
        return "-"
    if ch in RADICALS:
        return RADICALS[ch]
    how = unicodedata.decomposition(ch)
    if how.startswith(("<wide>", "<narrow>")):
        return "".join(map(_folded, unicodedata.normalize("NFKC", ch)))
    if 0x2F00 <= ord(ch) <= 0x2FDF or 0xF900 <= ord(ch) <= 0xFAFF or 0x2F800 <= ord(ch) <= 0x2FA1F:
        return unicodedata.normalize("NFKC", ch)
    return ch


def folded(text: str) -> str:
    """Text without ignorable characters, composed, in plain width and spaces."""
    if _PLAIN.fullmatch(text):
        return text
    return unicodedata.normalize("NFC", "".join(map(_folded, text)))


def bare_letters(run: str) -> str:
    return run if run.isascii() else _MARKS.sub("", unicodedata.normalize("NFD", run))


def script(ch: str) -> str:
    code = ord(ch)
    return "greek" if 0x370 <= code <= 0x3FF or 0x1F00 <= code <= 0x1FFF else "cyrillic" if 0x400 <= code <= 0x52F else "latin"


def lattice(run: str) -> list[str]:
    """Per letter all letters that look like it."""
    return [_ALTERNATIVES.get(ch, ch) for ch in run]


class Reader:
    """Bigram scores of letters, and the best reading of a run of letters."""

    def __init__(self, bigrams: dict[str, int]):
        self.bigrams = bigrams
        self.first: dict[str, int] = {}
        for pair, n in bigrams.items():
            self.first[pair[0]] = self.first.get(pair[0], 0) + n
        self.known: dict[str, str] = {}

    def score(self, a: str, b: str) -> float:
        p = (self.bigrams.get(a + b, 0) + 0.1) / (self.first.get(a, 0) + 60.0)
        changed = a not in "^" and b not in "$" and script(a) != script(b)
        return math.log2(p) - (SCRIPT_CHANGE if changed else 0.0)

    def read(self, run: str) -> str:
        found = self.known.get(run)
        if found is not None:
            return found
        best: list[tuple[float, str]] = [(0.0, "^")]
        paths = [""]
        for options in [*lattice(run), "$"]:
            now, ways = [], []
            for ch in options:
                scores = [s + self.score(prev, ch) for s, prev in best]
                at = max(range(len(scores)), key=lambda i: (scores[i], -i))
                now.append((scores[at], ch))
                ways.append(paths[at] + ch)
            best, paths = now, ways
        found = paths[0][:-1]
        if len(self.known) > 100_000:
            self.known.clear()
        self.known[run] = found
        return found

    def _run(self, run: str) -> str:
        """A run of letters: its bases are read, their accents kept where they are."""
        if run.isascii():
            return self.read(run)
        apart = unicodedata.normalize("NFD", run)
        bases = bare_letters(run)
        read = iter(self.read(bases))
        return unicodedata.normalize("NFC", "".join(ch if "\u0300" <= ch <= "\u036f" else next(read) for ch in apart))

    def one_form(self, text: str) -> str:
        return _LETTERS.sub(lambda m: self._run(m[0]), folded(text))


def bigram_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Letter bigrams of the runs of one script in ``columns`` of all rows, after folding.

    What comes to the driver is bounded by the alphabets: pairs of letters of three scripts, not by the rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for run in map(bare_letters, _LETTERS.findall(folded(text))):
                    if len({script(ch) for ch in run}) == 1:
                        marked = f"^{run}$"
                        for i in range(len(marked) - 1):
                            counts[marked[i : i + 2]] = counts.get(marked[i : i + 2], 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["pair", "n"])

    letters = r"[A-Za-zÀ-ԯḀ-῿Ａ-ｚ]"
    texts = df.select(F.explode(F.array(*columns)).alias("t")).where(F.col("t").rlike(letters))
    rows = texts.mapInArrow(count, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    return {r["pair"]: r["n"] for r in rows}


@lru_cache(maxsize=2)
def _reader(bigrams: tuple[tuple[str, int], ...]) -> Reader:
    return Reader(dict(bigrams))


def one_form(df: DataFrame, columns: list[str], suffix: str = "_form") -> DataFrame:
    """Adds, for every column, its one form. The scores are learnt from all rows of ``df``."""
    model = df.sparkSession.sparkContext.broadcast(tuple(sorted(bigram_counts(df, columns).items())))

    def build() -> Column:
        @F.pandas_udf(T.StringType())
        def form(texts: pd.Series) -> pd.Series:
            reader = _reader(model.value)
            return texts.map(lambda t: None if t is None else reader.one_form(t))

        return form

    form = build()
    return df.withColumns({c + suffix: form(F.col(c)) for c in columns})


def looks(df: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``columns`` are all present, as ``id, look, stored`` (digests), and the looks stored in several ways: ``look, stored, size``.

    What is stored in the same characters is one class, however many rows have it; its size is counted before anything is joined.
    """
    present = df.select(key, *columns).where(" and ".join(f"{c} is not null and {c} != ''" for c in columns))
    formed = one_form(present, columns)
    digest = lambda cols: F.unhex(F.md5(F.concat_ws("\u0000", *cols)))
    rows = written(formed.select(F.col(key).cast("bigint").alias("id"), digest([f"{c}_form" for c in columns]).alias("look"), digest(columns).alias("stored")), "looks")
    classes = rows.groupBy("look", "stored").agg(F.count("*").alias("size"))
    several = classes.groupBy("look").agg(F.count("*").alias("n")).where("n > 1").select("look")
    return rows, written(classes.join(several, "look"), "classes")


def same_look(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Pairs ``id_a < id_b`` of rows whose ``columns`` all look the same while not all are stored in the same characters.

    Rows with a null or empty column have no partner. Classes of equal rows are paired first; the rows are put in their places
    at the end, so that what is joined is what comes out, also where many rows of a look are stored alike.
    """
    rows, classes = looks(df, key, columns)
    pairs = classes.select("look", F.col("stored").alias("stored_a")).join(classes.select("look", F.col("stored").alias("stored_b")), "look").where("stored_a < stored_b")
    x = rows.select("look", F.col("stored").alias("stored_a"), F.col("id").alias("x"))
    y = rows.select("look", F.col("stored").alias("stored_b"), F.col("id").alias("y"))
    out = pairs.join(x, ["look", "stored_a"]).join(y, ["look", "stored_b"]).where("x != y")
    return out.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def look_classes(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per row that has a partner in ``same_look``: ``id``, ``look_id`` and ``class_id`` (the least ids of its look and of
    the rows stored like it) and ``links``, the number of its partners. Nothing is expanded.
    """
    rows, classes = looks(df, key, columns)
    totals = classes.groupBy("look").agg(F.sum("size").alias("total"))
    mine = rows.join(classes, ["look", "stored"]).join(totals, "look")
    least = rows.join(totals.select("look"), "look", "left_semi").groupBy("look", "stored").agg(F.min("id").alias("class_id"))
    firsts = least.groupBy("look").agg(F.min("class_id").alias("look_id"))
    return mine.join(least, ["look", "stored"]).join(firsts, "look").select("id", "look_id", "class_id", (F.col("total") - F.col("size")).alias("links"))
