"""Near-duplicate records by inverted lists of rare trigrams (problem 6), exact at any number of records.

A record is the set of its character trigrams. The trigrams are dealt into ``shards`` by hash: where two sets reach the
similarity, their parts in at least one shard do too, so each shard is searched by itself and nothing is lost. Inside a
shard, records meet in the lists of their rarest tokens; a list in which too many meet is divided by the next token they
share, so that lists stay short as records grow in number. Who meets is compared by 64 bits, then by binary search of the
tokens. Equal sets are searched once. Where a shard is too large for a task, its lists are dealt by their first token, so
that each record is copied a bounded number of times, and one shard is shuffled at a time, so that these copies never lie
on disk for all shards at once. Pairs are then measured exactly.

Defined results: null parts count as empty; records without content or with fewer than three letters have no partner;
equal sets are similar (1.0), however many rows share one; repeated keys are rows of their own; an empty table gives an
empty result; texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import release, written

SIMILARITY = Fraction(3, 5)
#: Parts the trigrams are dealt into, and records that one task holds of a shard.
SHARDS, TASK_RECORDS = 16, 240_000
#: First tokens of the short lists a record is in, about: cells are made that many times as small.
KEYS = 8
#: Slots in which tokens are counted where tasks must agree on what is rare (8 bytes each).
SLOTS = 1 << 20
#: Records dealt at once.
DEALT = 4_000
#: Entries of merged lists held at once by one task.
MERGED = 1_000_000
#: Meetings that cost as much as an entry of a list: where there are more, the list is divided. Entries of divided lists held at once.
DEEPER, ENTRIES = 3, 1_000_000

_DROP = re.compile(r"[\W_]+")


def bare(text: str) -> str:
    """Lower case, only letters and digits of any script."""
    return _DROP.sub("", text.lower())


def grams_of(text: str) -> np.ndarray:
    """The sorted set of trigrams of a bare text, each as three code points in one number."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if len(points) < 3:
        return np.empty(0, np.int64)
    return _distinct(points[:-2] << 42 | points[1:-1] << 21 | points[2:])


def _distinct(x: np.ndarray) -> np.ndarray:
    """As ``np.unique``, but by sorting, which is faster for numbers."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def _mixed(grams: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = grams.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def dealt_sets(texts: list[str], shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard, record and token of all trigrams, in this order; a token is a trigram in 24 bits.

    Where trigrams of a set fall on one token, each further one takes the next free number. So a set keeps its size, and two
    sets share at least as many tokens as trigrams: what is similar stays so.
    """
    sets = [grams_of(t) for t in texts]
    record = np.repeat(np.arange(len(sets)), [len(g) for g in sets])
    mixed = _mixed(np.concatenate(sets)) if sets else np.empty(0, np.uint64)
    shard = ((mixed >> np.uint64(3)) % np.uint64(shards)).astype(np.int64)
    owner, token = np.divmod(np.sort((shard * len(sets) + record) << 24 | (mixed >> np.uint64(40)).astype(np.int64)), 1 << 24)
    shard, record = np.divmod(owner, max(len(sets), 1))
    while True:
        again = np.flatnonzero((shard[1:] == shard[:-1]) & (record[1:] == record[:-1]) & (token[1:] <= token[:-1])) + 1
        if not len(again):
            return shard, record, token
        token[again] = token[again - 1] + 1


def _packed(tokens: np.ndarray) -> bytes:
    """Tokens in three bytes each; in four if one was moved beyond 24 bits."""
    four = tokens.astype("<u4").view(np.uint8).reshape(-1, 4)
    return (four if int(tokens.max(initial=0)) >> 24 else four[:, :3]).tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    """The ``n`` tokens that ``_packed`` wrote."""
    four = np.zeros((n, 4), np.uint8)
    four[:, : len(data) // max(n, 1)] = np.frombuffer(data, np.uint8).reshape(n, -1) if n else 0
    return four.view("<u4").ravel().astype(np.int64)


def need(a: np.ndarray | int, b: np.ndarray | int, t: Fraction) -> np.ndarray | int:
    """Overlap that sets of sizes ``a`` and ``b`` need: the least o with o >= t (a + b - o)."""
    num, den = t.numerator, t.numerator + t.denominator
    return -(-(num * (a + b)) // den)


class _Sets:
    """Token sets of many records (one after the other, any order inside), by size, each in order from its rarest token on.

    Rarity is what ``weight`` says of a token (equal ones by number), or how many of these records have it; ``ordered`` sets come
    from the rarest token on. ``record``: whose set each is.
    """

    def __init__(self, sizes: np.ndarray, tokens: np.ndarray, weight: np.ndarray | None = None, ordered: bool = False):
        self.record = np.argsort(sizes, kind="stable")
        self.sizes = sizes[self.record]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), self.sizes)
        self.v = int(tokens.max(initial=0)) + 1
        if ordered:
            first = (np.cumsum(sizes) - sizes)[self.record]
            self.token = tokens[np.arange(len(tokens)) + np.repeat(first - self.starts[:-1], self.sizes)]
        else:
            values, token, df = np.unique(tokens, return_inverse=True, return_counts=True)
            rare = np.argsort(df if weight is None else weight[values % len(weight)], kind="stable")
            rank = np.empty(len(values), np.int64)
            rank[rare] = np.arange(len(values))
            place = np.empty(len(sizes), np.int64)
            place[self.record] = np.arange(len(sizes))
            self.token = values[rare][np.sort(np.repeat(place, sizes) * len(values) + rank[token]) - self.doc * np.int64(len(values))]
        self.probe_key = np.sort(self.doc * np.int64(self.v) + self.token)  # a token in a record: by binary search

    def last(self, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
        """Of each record the place up to which its first shared token must lie where it is listed, and where it asks.

        If two sets share o tokens, the first of them is among each one's |set| - o + 1 rarest, the k-th among the |set| - o + k rarest.
        """
        return self.sizes - need(self.sizes, self.sizes, t), self.sizes - -(-(t.numerator * self.sizes) // t.denominator)

    def visits(self, t: Fraction, cells: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells in which a record may share its first token, and the record; in order of the cells."""
        some = np.flatnonzero(np.arange(len(self.doc)) <= (self.starts[:-1] + self.last(t)[1])[self.doc])  # who asks goes farther than who is listed
        visit = _distinct(_cell_of(self.token[some], cells) * len(self.sizes) + self.record[self.doc[some]])
        return visit // len(self.sizes), visit % len(self.sizes)

    def signatures(self) -> np.ndarray:
        """64 bits of each set, turned over once by every token: sets differ in as many tokens as bits at least."""
        return np.bitwise_xor.reduceat(np.uint64(1) << (_mixed(self.token) >> np.uint64(58)), self.starts[:-1]) if len(self.doc) else np.empty(0, np.uint64)


def search(sizes: np.ndarray, tokens: np.ndarray, t: Fraction, weight: np.ndarray | None = None, cell: tuple[int, int] | None = None, ordered: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of records (by position) whose sets, none empty, reach similarity ``t``. ``tokens``: all sets, one after the other.

    Records meet in lists of those that hold a token among their rarest ones; a list in which too many meet is divided by the next
    token they share, and again, as far as this makes the lists shorter. ``cell``: (i, n), only lists whose first token falls
    into the i-th of n cells; the same ``weight`` must hold in all, as it must where sets come ``ordered`` by it.
    """
    sets = _Sets(sizes, tokens, weight, ordered)
    sizes, doc, token, starts, probe_key, v = sets.sizes, sets.doc, sets.token, sets.starts, sets.probe_key, sets.v
    listed, asks = (starts[:-1] + x for x in sets.last(t))
    least = np.searchsorted(sizes, -(-(t.numerator * sizes) // t.denominator))  # the first record that is not too small for each
    only = -(-(t.numerator * sizes) // t.denominator)  # tokens that it shares with the smallest possible partner
    signs = sets.signatures()
    sums = np.arange(2 * int(sizes.max(initial=0)) + 1)
    room = sums - 2 * need(sums, 0, t)

    def measured(x: np.ndarray, low: np.ndarray, count: np.ndarray, others: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Similar pairs of records ``x`` and their ``count`` records of ``others`` from ``low`` on, the larger (of equals the later) first."""
        total, at = np.cumsum(count), 0
        while at < len(x):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + MERGED, "right")))
            c = count[at:stop]
            px = np.repeat(x[at:stop], c)
            py = others[np.arange(len(px)) + np.repeat(low[at:stop] - (np.cumsum(c) - c), c)]
            at = stop
            keep = np.flatnonzero((py < px) & (py >= least[px]))
            px, py = px[keep], py[keep]
            keep = np.flatnonzero(np.bitwise_count(signs[px] ^ signs[py]) <= room[sizes[px] + sizes[py]])
            pair = _distinct(px[keep] * np.int64(len(sizes)) + py[keep])
            for some in range(0, len(pair), MERGED // 16):
                px, py = np.divmod(pair[some : some + MERGED // 16], len(sizes))
                s = sizes[py]  # the smaller one's tokens are probed in the larger one
                member = np.repeat(np.arange(len(px)), s)
                pos = np.arange(len(member)) + np.repeat(starts[py] - (np.cumsum(s) - s), s)
                wanted = px[member] * v + token[pos]
                hit = probe_key[np.minimum(np.searchsorted(probe_key, wanted), len(probe_key) - 1)] == wanted
                good = np.bincount(member, hit, minlength=len(px)) >= need(sizes[px], s, t)
                yield sets.record[px[good]], sets.record[py[good]]

    def lists(key: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where lists of entries in order of ``key`` begin, how many are in each and how many listed, and which those are."""
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        is_listed = at < listed[doc[at]] + depth
        return first, np.diff(np.r_[first, len(key)]), np.add.reduceat(is_listed, first, dtype=np.int64) if len(first) else first, is_listed

    def met(key: np.ndarray, at: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs that share the ``depth`` tokens of a ``key``; ``at``: place of the last of them in a record, by ``key``."""
        first, entries, n, is_listed = lists(key, at, depth)
        some = (entries > 1) & (n > 0)
        inside = np.repeat(some, entries)
        at, is_listed, entries, n = at[inside], is_listed[inside], entries[some], n[some]
        if not len(at):
            return
        first, owner = np.cumsum(entries) - entries, np.repeat(np.arange(len(entries)), entries)
        who = doc[at]
        children = np.minimum(asks[who] + depth, starts[1:][who] - 1) - at
        pairs, below = entries * n, np.add.reduceat(children, first)
        deep = pairs > DEEPER * (below + entries)
        low, others = np.cumsum(n) - n, who[is_listed]
        chosen = np.flatnonzero(deep)
        while len(chosen):
            taken = max(1, int(np.searchsorted(np.cumsum(below[chosen]), ENTRIES, "right")))
            mine, chosen = chosen[:taken], chosen[taken:]
            entry = np.arange(int(entries[mine].sum())) + np.repeat(first[mine] - (np.cumsum(entries[mine]) - entries[mine]), entries[mine])
            c = children[entry]
            next_at = np.arange(int(c.sum())) + np.repeat(at[entry] + 1 - (np.cumsum(c) - c), c)
            next_key = np.repeat(owner[entry], c) * np.int64(v) + token[next_at]
            by = np.argsort(next_key)
            next_key, next_at = next_key[by], next_at[by]
            start, held, k, _ = lists(next_key, next_at, depth + 1)
            left = np.bincount(next_key[start] // v, held * k * (held > 1), minlength=len(entries))
            deep[mine] = shorter = 2 * left[mine] <= pairs[mine]
            if not shorter.all():  # records much alike would meet again and again
                inside = deep[next_key // v]
                next_key, next_at = next_key[inside], next_at[inside]
            yield from met(next_key, next_at, depth + 1)
        now = ~deep[owner] | (only[who] <= depth)  # those that may share no more tokens ask in any case
        yield from measured(who[now], low[owner[now]], n[owner[now]], others)

    place = np.flatnonzero(np.arange(len(doc)) <= asks[doc])
    if cell is not None:
        place = place[_cell_of(token[place], cell[1]) == cell[0]]
    place = place[np.argsort(token[place])]
    yield from met(token[place], place, 1)


def _cell_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (_mixed(keys) % np.uint64(n)).astype(np.int64)


def similarity(a: str, b: str) -> float:
    """Shared trigrams over all trigrams of two bare texts, 0 if there are none."""
    x, y = grams_of(a), grams_of(b)
    if not len(x) or not len(y):
        return 0.0
    every = np.sort(np.concatenate([x, y]))
    both = int(np.count_nonzero(every[1:] == every[:-1]))
    return both / (len(x) + len(y) - both)


def bare_records(rows: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """``id, bare, digest`` of every record that has a trigram; ``digest`` names its set of trigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, names = [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                short = bare(text)
                grams = grams_of(short)
                if len(grams):
                    ids.append(i)
                    texts.append(short)
                    names.append(hashlib.md5(grams.tobytes()).digest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(names, pa.binary())], names=["id", "bare", "digest"])

    text = F.concat(*[F.coalesce(F.col(p), F.lit("")) for p in parts])
    return rows.select(F.col(key).cast("bigint").alias("id"), text.alias("t")).mapInArrow(run, "id bigint, bare string, digest binary")


def token_weights(dealt: DataFrame) -> np.ndarray:
    """How often tokens occur in ``dealt``, in ``SLOTS`` slots: an order of rarity that is the same in all tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for sizes, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total += np.bincount(_unpacked(tokens, int(np.frombuffer(sizes, np.int32).sum())) % SLOTS, minlength=SLOTS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["slot", "n"])

    weight = np.zeros(SLOTS, np.int64)
    for slot, n in dealt.select("sizes", "tokens").mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n")).collect():
        weight[slot] = n
    return weight


_DEALT = "cell int, ids binary, sizes binary, tokens binary"


def _batch(rows: list[tuple[int, bytes, bytes, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names=["cell", "ids", "sizes", "tokens"])


def candidates(records: DataFrame, t: Fraction = SIMILARITY, shards: int = SHARDS, task_records: int = TASK_RECORDS) -> DataFrame:
    """Pairs ``a < b`` of ``records`` (``id, bare``) whose sets reach ``t`` in some shard; each pair once, as a table.

    Where a shard has more records than a task holds, its lists are dealt into cells by the first token of their key, and a
    record's part goes to the cells of its own short lists: to ``KEYS`` or so at most, however many records and cells there
    are. All shards are then written once, and shuffled one after the other: what one has shuffled is removed before the next.
    """
    n = records.count()
    cells = 1 if n <= task_records else -(-KEYS * n // task_records)
    spark = records.sparkSession

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, DEALT):
                ids = batch.column(0).slice(at, DEALT).to_numpy(zero_copy_only=False).astype(np.int64)
                shard, record, token = dealt_sets(batch.column(1).slice(at, DEALT).to_pylist(), shards)
                bounds = np.searchsorted(shard, np.arange(shards + 1))
                rows = []
                for s in range(shards):
                    r, k = record[bounds[s] : bounds[s + 1]], token[bounds[s] : bounds[s + 1]]
                    who, counts = np.unique(r, return_counts=True)
                    if len(who):
                        rows.append((s, ids[who].tobytes(), counts.astype(np.int32).tobytes(), _packed(k)))
                yield _batch(rows)

    def joined(dealt: DataFrame, weight: np.ndarray | None = None) -> DataFrame:
        """The pairs of all shards of ``dealt``, or, with ``weight``, of all cells of one."""
        held = spark.sparkContext.broadcast(weight)

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, ids, sizes, tokens in zip(*[c.to_pylist() for c in batch.columns]):
                    who, counts = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int32).astype(np.int64)
                    k = _unpacked(tokens, int(counts.sum()))
                    sets = _Sets(counts, k, held.value)
                    place, mine = sets.visits(t, cells)
                    first = np.empty(len(counts), np.int64)
                    first[sets.record] = sets.starts[:-1]
                    edges = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True]) if len(place) else []
                    rows = []
                    for low, high in zip(edges[:-1], edges[1:]):
                        some = mine[low:high]
                        c = counts[some]
                        at_token = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c) + np.repeat(first[some], c)
                        rows.append((int(place[low]), who[some].tobytes(), c.astype(np.int32).tobytes(), _packed(sets.token[at_token])))
                    yield _batch(rows)

        def join(key: tuple, group: pa.Table) -> pa.Table:
            ids = np.frombuffer(b"".join(group.column("ids").to_pylist()), np.int64)
            counts = [np.frombuffer(x, np.int32).astype(np.int64) for x in group.column("sizes").to_pylist()]
            tokens = np.concatenate([_unpacked(x, int(c.sum())) for x, c in zip(group.column("tokens").to_pylist(), counts)])
            cell = None if weight is None else (key[0].as_py(), cells)
            found = [x * len(ids) + y for x, y in search(np.concatenate(counts), tokens, t, cell=cell, ordered=cell is not None)]  # in cells, as ``send`` ordered them
            a, b = (ids[i] for i in np.divmod(_distinct(np.concatenate([*found, np.empty(0, np.int64)])), max(len(ids), 1)))
            return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

        if weight is not None:
            dealt = dealt.mapInArrow(send, _DEALT)
        return dealt.repartition(shards if weight is None else min(cells, 100_000), "cell").groupBy("cell").applyInArrow(join, "a bigint, b bigint")

    dealt = records.select("id", "bare").mapInArrow(deal, _DEALT)
    if cells == 1:
        found = written(joined(dealt).distinct(), "pairs")
        release(spark)
        return found
    dealt = written(dealt, "dealt", ["cell"]).select("cell", "ids", "sizes", "tokens")
    weight = token_weights(dealt)
    met = []
    for s in range(shards):
        met.append(written(joined(dealt.where(F.col("cell") == s), weight), "met"))
        release(spark)
    release(spark, dealt)
    every = met[0]
    for x in met[1:]:
        every = every.unionByName(x)
    found = written(every.distinct(), "pairs")
    release(spark, *met)
    return found


def similar_sets(rows: DataFrame, key: str, parts: list[str], t: Fraction = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Similar pairs of distinct sets (``a < b, similarity``) and the rows of each set (``set, id``); a set is named by its least row."""
    spark = rows.sparkSession
    records = written(bare_records(rows, key, parts), "bare")
    sets = written(records.groupBy("digest").agg(F.min("id").alias("set"), F.min_by("bare", "id").alias("bare")), "sets")
    members = written(records.join(sets.select("digest", "set"), "digest").select("set", "id"), "members")
    release(spark, records)
    pairs = candidates(sets.select(F.col("set").alias("id"), "bare"), t)
    texts = sets.select(F.col("set"), "bare")
    both = pairs.join(texts.select(F.col("set").alias("a"), F.col("bare").alias("bare_a")), "a").join(texts.select(F.col("set").alias("b"), F.col("bare").alias("bare_b")), "b")
    least = float(t)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([similarity(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["a", "b", "similarity"])

    measured = both.select("a", "b", "bare_a", "bare_b").mapInArrow(measure, "a bigint, b bigint, similarity double").where(F.col("similarity") >= least)
    return measured, members


def similar_pairs(rows: DataFrame, key: str, parts: list[str], t: Fraction = SIMILARITY) -> DataFrame:
    """``id_a < id_b, similarity`` of all pairs of rows that reach ``t``.

    Searched are the sets; the rows that share a set are put in its place at the end, as their pairs are asked for.
    """
    measured, members = similar_sets(rows, key, parts, t)
    equal = members.groupBy("set").count().where("count > 1").select("set")
    same = members.join(equal, "set", "left_semi")
    inside = same.select("set", F.col("id").alias("id_a")).join(same.select("set", F.col("id").alias("id_b")), "set").where("id_a < id_b").select("id_a", "id_b", F.lit(1.0).alias("similarity"))
    across = measured.join(members.select(F.col("set").alias("a"), F.col("id").alias("x")), "a").join(members.select(F.col("set").alias("b"), F.col("id").alias("y")), "b")
    across = across.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "similarity")
    return across.unionByName(inside)


def similar_groups(rows: DataFrame, key: str, parts: list[str], t: Fraction = SIMILARITY) -> DataFrame:
    """One row per row that has a set: ``id``, ``class_id`` (rows of one set), ``group_id`` (sets linked directly or through
    others) and ``links`` (rows it is similar to). Nothing is expanded: links are counted per set, by the sizes of the sets.
    """
    from .history import components

    measured, members = similar_sets(rows, key, parts, t)
    pairs = written(measured.select("a", "b"), "pairs")
    sizes = members.groupBy("set").agg(F.count("*").alias("size"))
    turned = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    across = turned.join(sizes.select(F.col("set").alias("b"), "size"), "b").groupBy(F.col("a").alias("set")).agg(F.sum("size").alias("across"))
    roots = components(pairs).select(F.col("node").alias("set"), "root")
    per_set = sizes.join(across, "set", "left").join(roots, "set", "left")
    per_set = per_set.select("set", F.coalesce("root", "set").alias("group_id"), (F.col("size") - 1 + F.coalesce("across", F.lit(0))).alias("links"))
    return members.join(per_set, "set").select("id", F.col("set").alias("class_id"), "group_id", "links")
