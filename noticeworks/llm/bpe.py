"""Byte-level BPE as a lazily determinised finite-state transducer (problem 7).

The merges are compiled into a transducer over characters. A state is what is not yet settled of a word: the last token
put out and the bytes read since. Among the ways to end a token inside those bytes the transducer keeps all that may
still turn out right (two neighbouring tokens must be what the merges make of their bytes) and puts out the tokens that
all of them share, so its delay is bounded by the longest token. States and moves are made when first met and kept.

Defined results: null and empty texts have no ids; text that looks like a special token is ordinary text; texts of any
length are read whole, in one pass; equal texts have equal ids.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the pattern by which byte_bpe_50k cuts a text into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Moves and whole words kept at most by one task; when reached, they are dropped and made anew. Results do not depend on it.
KEPT_MOVES, KEPT_WORDS = 1_000_000, 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class State(dict):
    """Moves of one state by character: ``(next state, tokens put out)``, made when first asked for."""

    __slots__ = ("machine", "last", "pending", "paths")

    def __missing__(self, ch: str) -> tuple[State, tuple[int, ...]]:
        step = self[ch] = self.machine.move(self, ch)
        return step


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.prefixes = {token[:i] for token in ranks for i in range(1, len(token) + 1)}
        self.fits: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.reset()

    def reset(self) -> None:
        self.made = 0
        self.states: dict[tuple[int, bytes], State] = {}
        self.fits.clear()
        self.start = self.state(-1, b"", [()])

    def merged(self, text: bytes) -> list[int]:
        """What the merges make of ``text``, lowest rank first: the definition the transducer is compiled from."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def fit(self, left: int, right: int) -> bool:
        """May ``right`` follow ``left``?"""
        if left < 0:
            return True
        known = self.fits.get((left, right))
        if known is None:
            known = self.fits[left, right] = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known

    def state(self, last: int, pending: bytes, paths: list[tuple[int, ...] | None]) -> State:
        """``paths``: the tokens of each prefix of ``pending`` after ``last``, None where no token can end."""
        key = (last, pending)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State()
            found.machine, found.last, found.pending, found.paths = self, last, pending, paths
        return found

    def move(self, state: State, ch: str) -> tuple[State, tuple[int, ...]]:
        last, pending, paths = state.last, state.pending + ch.encode("utf-8", "surrogatepass"), list(state.paths)
        ranks, prefixes = self.ranks, self.prefixes
        for end in range(len(paths), len(pending) + 1):
            here = None
            for start in range(end):
                before = paths[start]
                if before is not None:
                    token = ranks.get(pending[start:end])
                    if token is not None and self.fit(before[-1] if before else last, token):
                        here = (*before, token)
                        break
            paths.append(here)
        alive = [p for start, p in enumerate(paths) if p is not None and (start == len(pending) or pending[start:] in prefixes)]
        shared = alive[0]
        for p in alive[1:]:
            n = 0
            while n < len(shared) and n < len(p) and shared[n] == p[n]:
                n += 1
            shared = shared[:n]
        if shared:
            # a prefix has one way of tokens at most: what does not begin with the settled ones ends nowhere any more
            k, done = len(shared), sum(len(self.bytes_of[t]) for t in shared)
            last, pending = shared[-1], pending[done:]
            paths = [p[k:] if p is not None and p[:k] == shared else None for p in paths[done:]]
        self.made += 1
        return self.state(last, pending, paths), shared

    def word(self, text: str) -> tuple[int, ...]:
        if self.made > KEPT_MOVES:
            self.reset()
        row, out = self.start, []
        for ch in text:
            row, settled = row[ch]
            if settled:
                out += settled
        out += row.paths[-1] or ()
        return tuple(out)

    def encode(self, text: str, out: array) -> None:
        """Appends the ids of ``text`` to ``out``."""
        words = self.words
        for w in _cut(text):
            ids = words.get(w)
            if ids is None:
                ids = self.word(w)
                if len(w) <= 24:
                    if len(words) >= KEPT_WORDS:
                        words.clear()
                    words[w] = ids
            out.extend(ids)


_cut = regex.compile(PATTERN).findall


@lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    """One transducer per Python worker and vocabulary; its moves stay for the worker's later tasks."""
    return Transducer(read_ranks(path))


@lru_cache(maxsize=4)
def token_bytes(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


class Utf8Machine:
    """An incremental UTF-8 state machine: takes bytes in pieces of any size, gives text, and holds back unfinished characters.

    What can be no character gives one replacement character for each longest beginning of one (as in the Unicode standard);
    surrogates written as three bytes are kept if ``surrogates``.
    """

    def __init__(self, surrogates: bool = True):
        self.surrogates = surrogates
        self.held, self.need, self.low, self.high = bytearray(), 0, 0x80, 0xBF

    def _begin(self, byte: int, out: bytearray) -> None:
        self.low, self.high = 0x80, 0xBF
        if byte < 0x80:
            out.append(byte)
            return
        if 0xC2 <= byte <= 0xDF:
            self.need = 1
        elif 0xE0 <= byte <= 0xEF:
            self.need = 2
            self.low, self.high = 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED and not self.surrogates else 0xBF
        elif 0xF0 <= byte <= 0xF4:
            self.need = 3
            self.low, self.high = 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
        else:
            out += _REPLACEMENT
            return
        self.held.append(byte)

    def feed(self, piece: bytes) -> str:
        if not self.held and piece.isascii():
            return piece.decode("ascii")
        out = bytearray()
        for byte in piece:
            if self.need and self.low <= byte <= self.high:
                self.held.append(byte)
                self.need -= 1
                self.low, self.high = 0x80, 0xBF
                if not self.need:
                    out += self.held
                    self.held.clear()
                continue
            if self.need:
                out += _REPLACEMENT
                self.held.clear()
                self.need = 0
            self._begin(byte, out)
        return out.decode("utf-8", "surrogatepass")

    def finish(self) -> str:
        """The end of the text: an unfinished character is broken."""
        broken = bool(self.held)
        self.held.clear()
        self.need = 0
        return "\ufffd" if broken else ""


_REPLACEMENT = "\ufffd".encode()


def decode(ids: Iterable[int], bytes_of: dict[int, bytes]) -> Iterator[str]:
    """Text of a stream of ids, piece by piece, by an incremental UTF-8 state machine; unknown ids count as broken."""
    machine = Utf8Machine()
    for token in ids:
        piece = machine.feed(bytes_of.get(token, b"\xff"))
        if piece:
            yield piece
    rest = machine.finish()
    if rest:
        yield rest


VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``key`` and ``ids`` (array<int>) of every row. ``vocabulary``: path of the ranks, the same on all machines."""
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(vocabulary)
        for batch in batches:
            ids, offsets = array("i"), array("i", [0])
            for value in batch.column(1):
                if value.is_valid:
                    machine.encode(value.as_py(), ids)
                offsets.append(len(ids))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "ids"])

    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"{key} {key_type}, ids array<int>")


def decode_texts(df: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``key`` and ``text`` of every row of ids; an empty list gives an empty text."""
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = token_bytes(vocabulary)
        for batch in batches:
            texts = ["".join(decode(value.as_py() or (), bytes_of)) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return df.select(F.col(key), F.col(ids)).mapInArrow(run, f"{key} {key_type}, text string")
