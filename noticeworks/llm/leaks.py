"""Held-out test items leaking into training text (problem 8), by a generalised suffix automaton.

The automaton of all normalised test items is built once per Python worker; the letters and digits of every text stream
through it, tracking the longest match that ends at each character. A match of ``least`` characters or more is a leak of
every item that holds it. Streaming starts only near an anchor: each common run of ``least`` characters holds one of the
text's aligned blocks of ``BLOCK`` characters, so skipping where no block occurs in any item loses nothing.

Defined results: null and empty texts and items leak nothing; items shorter than ``least`` never match; an empty table on
either side gives an empty result; repeated rows each report; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.width import fold_width
from ..runtime import written

#: Letters and digits of items that one automaton holds; more items are split and the texts read once per part. At this size an
#: automaton took 410 MB of a worker (measured with random Han texts).
PART_CHARS = 500_000
LEAST = 40


def letters_and_digits(text: Column) -> Column:
    """Only letters and digits, in lower case and plain width, JVM-side; a sigma is the same at the end of a word."""
    return F.translate(F.regexp_replace(F.lower(fold_width(text)), r"[^\p{L}\p{N}]+", ""), "ς", "σ")


class SuffixAutomaton:
    """Of several strings; ``items_of`` names those that hold the last ``least`` characters of a match."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, int]] = []
        for item, text in items:
            last = 0
            for ch in text:
                last = self._extend(last, ch)
                ends.append((last, item))
        self.top = [-1] * len(self.length)
        self.items: dict[int, set[int]] = {}
        for state, item in ends:
            at = self.topmost(state, least)
            if at >= 0:
                self.items.setdefault(at, set()).add(item)

    def topmost(self, state: int, least: int) -> int:
        """The state of the last ``least`` characters of ``state``'s strings, -1 if they are shorter."""
        if self.length[state] < least:
            return -1
        walk = []
        while self.top[state] < 0 and self.length[self.link[state]] >= least:
            walk.append(state)
            state = self.link[state]
        found = self.top[state] if self.top[state] >= 0 else state
        self.top[state] = found
        for s in walk:
            self.top[s] = found
        return found

    def _copy(self, p: int, q: int, ch: str) -> int:
        clone = len(self.length)
        self.length.append(self.length[p] + 1)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(ch) == q:
            self.next[p][ch] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, ch: str) -> int:
        q = self.next[last].get(ch)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._copy(last, q, ch)
        state = len(self.length)
        self.length.append(self.length[last] + 1)
        self.next.append({})
        self.link.append(0)
        p = last
        while p >= 0 and ch not in self.next[p]:
            self.next[p][ch] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][ch]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._copy(p, q, ch)
        return state


class Detector:
    def __init__(self, items: list[tuple[int, str]], least: int):
        items = [(i, t) for i, t in items if t and len(t) >= least]
        self.least = least
        self.block = max(1, least // 2)
        self.stride = least - self.block + 1
        self.automaton = SuffixAutomaton(items, least)
        self.blocks = {t[i : i + self.block] for _, t in items for i in range(len(t) - self.block + 1)}

    def near_anchors(self, text: str) -> list[tuple[int, int]]:
        """Stretches of ``text`` outside which no run of ``least`` characters can match."""
        block, stride, blocks = self.block, self.stride, self.blocks
        found: list[tuple[int, int]] = []
        for p in range(0, len(text) - block + 1, stride):
            if text[p : p + block] in blocks:
                start, end = max(0, p - stride), min(len(text), p + block + stride)
                if found and start <= found[-1][1]:
                    found[-1] = (found[-1][0], end)
                else:
                    found.append((start, end))
        return found

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, state) of every end at which the longest match has ``least`` characters or more."""
        a, out = self.automaton, []
        nexts, link, length, least = a.next, a.link, a.length, self.least
        for start, end in self.near_anchors(text):
            state, size = 0, 0
            for i in range(start, end):
                ch = text[i]
                while state and ch not in nexts[state]:
                    state = link[state]
                    size = length[state]
                if ch in nexts[state]:
                    state = nexts[state][ch]
                    size += 1
                if size >= least:
                    out.append((i + 1 - size, i + 1, state))
        return out

    def leaked(self, text: str) -> set[int]:
        a = self.automaton
        found: set[int] = set()
        for state in {a.topmost(s, self.least) for _, _, s in self.matches(text)}:
            found |= a.items.get(state, set())
        return found

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Maximal stretches covered by matches, merged, in order."""
        merged: list[list[int]] = []
        for start, end, _ in sorted((s, e, 0) for s, e, _ in self.matches(text)):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        return [(s, e) for s, e in merged]


@lru_cache(maxsize=1)
def _detector(items: tuple[tuple[int, str], ...], least: int) -> Detector:
    return Detector(list(items), least)


def item_parts(items: DataFrame, key: str, text: str) -> list[tuple[tuple[int, str], ...]]:
    """The normalised items in parts of at most ``PART_CHARS`` characters (one longer item is a part of its own)."""
    rows = items.select(F.col(key).alias("k"), letters_and_digits(F.col(text)).alias("t")).where("length(t) > 0")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    count = max(1, -(-total // PART_CHARS))
    parts = []
    for i in range(count):
        mine = rows if count == 1 else rows.where(F.pmod(F.xxhash64("k"), F.lit(count)) == i)
        parts.append(tuple(sorted((r["k"], r["t"]) for r in mine.collect())))
    return [p for p in parts if p]


def find_leaks(docs: DataFrame, items: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, item_id`` of every text and item that share a run of ``least`` letters and digits."""
    narrow = docs.select("doc_id", letters_and_digits(F.col("text")).alias("t")).where(F.length("t") >= least)
    out = None
    for part in item_parts(items, "item_id", "text"):
        held = docs.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            detector = _detector(held.value, least)
            for batch in batches:
                ids, found = [], []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for item in sorted(detector.leaked(text.as_py())):
                        ids.append(doc)
                        found.append(item)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.int64())], names=["doc_id", "item_id"])

        rows = narrow.mapInArrow(run, "doc_id bigint, item_id bigint")
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint")


def with_offsets(text: str) -> tuple[str, list[int]]:
    """Letters and digits of ``text`` as in ``letters_and_digits``, with the place of each in ``text``."""
    kept, places = [], []
    for i, ch in enumerate(text):
        if 0xFF01 <= ord(ch) <= 0xFF5E:
            ch = chr(ord(ch) - 0xFEE0)
        if ch.isalnum():
            low = ch.lower()[0]
            kept.append("σ" if low == "ς" else low)
            places.append(i)
    return "".join(kept), places


def remove_leaks(docs: DataFrame, items: DataFrame, least: int = LEAST, longest_kept: int = 40, most_covered: float = 0.5) -> DataFrame:
    """Texts without their leaked spans: ``doc_id, n_spans, leaked_chars, coverage, action, text``.

    Spans of ``longest_kept`` letters and digits or more are cut (``action`` cut); where spans cover more than
    ``most_covered`` of the letters and digits, the text is dropped (null); all other texts are kept as they are.

    Each part of the items has a pass of its own, which adds its spans to those found before; between passes the rows are
    written down, so that a worker never holds more than one automaton.
    """
    rows = docs.select("doc_id", "text", F.lit(None).cast("array<int>").alias("spans"))
    for n, part in enumerate(item_parts(items, "item_id", "text")):
        held = docs.sparkSession.sparkContext.broadcast(part)

        def mark(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            detector = _detector(held.value, least)
            for batch in batches:
                spans = []
                for text, before in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    flat = with_offsets(text)[0] if text and len(text) >= least else ""
                    found = [x for s, e in detector.spans(flat) if e - s >= longest_kept for x in (s, e)]
                    spans.append((before or []) + found or None)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.list_(pa.int32()))], names=["doc_id", "text", "spans"])

        rows = (written(rows, "marked") if n else rows).mapInArrow(mark, "doc_id bigint, text string, spans array<int>")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                spans: list[tuple[int, int]] = []
                for s, e in sorted(zip(found[::2], found[1::2])) if found else ():
                    if spans and s <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(spans[-1][1], e))
                    else:
                        spans.append((s, e))
                if not spans:
                    out.append((doc, 0, 0, 0.0, "keep", text))
                    continue
                flat, places = with_offsets(text)
                leaked = sum(e - s for s, e in spans)
                share = leaked / len(flat)
                if share > most_covered:
                    out.append((doc, len(spans), leaked, share, "drop", None))
                    continue
                kept, at = [], 0
                for s, e in spans:
                    kept.append(text[at : places[s]])
                    at = places[e - 1] + 1
                kept.append(text[at:])
                out.append((doc, len(spans), leaked, share, "cut", "".join(kept)))
            cols = list(zip(*out)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "n_spans", "leaked_chars", "coverage", "action", "text"])

    return rows.mapInArrow(cut, "doc_id bigint, n_spans bigint, leaked_chars bigint, coverage double, action string, text string")
