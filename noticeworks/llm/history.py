"""New batches checked for repeats against all accepted history (problem 3), by content-defined chunking.

What names a page (fingerprint, address) is cut into chunks where a rolling hash of the last bytes says so. A table that
lasts from batch to batch leads from chunk to accepted record, dealt into buckets by chunk. A record is there by its rarest
chunks only, as few as what covers it must share one of; a key of a new batch asks with all its chunks. From the chunk lists
found, the shared bytes are added up, and what is covered both ways is a repeat (or, below full coverage, alike). The chunks
of the rest are appended. The texts of history are never read again; its table, a row per record, is not shuffled, and only
the buckets that are asked for are read.

How widely a chunk is shared (hosts, paths) is counted with every batch, in a fixed number of slots, so that a chunk that
becomes common later is not what new records are found by. This only steers; it changes no result.

Defined results: missing fingerprints and addresses link nothing; repeated rows inside one batch link to the first of
them; rows without a batch number count as history; an empty table gives an empty result; keys of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import fingerprint_form, same_page_form
from ..runtime import names_in, read_bytes, scratch_path, write_bytes, written

#: Bytes the rolling hash looks back on, and the bits that must be zero at a cut (chunks of 16 bytes on average).
WINDOW, CUT_BITS = 8, 4
#: Chunk occurrences of a batch up to which their hashes (8 bytes each) and its owners are broadcast; a larger batch is joined by shuffle.
BROADCAST_CHUNKS = 1_000_000
#: Chunk occurrences of the first batch per bucket of the index, and slots in which the occurrences of chunks are counted (8 bytes each).
BUCKET_CHUNKS, SLOTS = 4_000_000, 65_536
#: Share of its bytes by which a record must be covered, both ways, to be a repeat; and to be alike.
COVERAGE, NEAR = 1.0, 0.8

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_GEAR = _mixed((np.arange(1, 257, dtype=np.uint64)) * _STEP)


def chunks_of(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and lengths of all chunks of ``keys``, and for each key where its chunks begin (one more at the end)."""
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.zeros(1, np.int32)
    sizes = np.fromiter(map(len, keys), np.int64, len(keys))
    data = np.frombuffer(b"".join(keys), np.uint8)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    gear = _GEAR[data]
    rolling = np.zeros(len(data), np.uint64)
    with np.errstate(over="ignore"):
        for back in range(min(WINDOW, len(data))):
            shifted = np.zeros(len(data), np.uint64)
            shifted[back:] = gear[: len(data) - back] << np.uint64(back)
            rolling += np.where(place >= back, shifted, np.uint64(0))
        cut = ((rolling >> np.uint64(WINDOW + 4)) & np.uint64((1 << CUT_BITS) - 1)) == 0
        cut[ends[sizes > 0] - 1] = True
        last = np.flatnonzero(cut)
        owner = np.searchsorted(ends, last, side="right")
        first = np.empty_like(last)
        if len(last):
            first[0] = 0
            first[1:] = last[:-1] + 1
        lengths = last - first + 1
        # polynomial hash of each chunk from prefix sums; the base is odd, so it can be divided out
        inside = np.arange(len(data)) - np.repeat(first, lengths)
        powers = np.ones(int(lengths.max(initial=1)), np.uint64)
        if len(powers) > 1:
            powers[1:] = _BASE
            powers = np.cumprod(powers, dtype=np.uint64)
        values = _mixed(data.astype(np.uint64) + np.uint64(0x100)) * powers[inside]
        hashes = _mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64)) if len(first) else np.empty(0, np.uint64)
    begin = np.searchsorted(owner, np.arange(len(keys) + 1))
    return hashes.view(np.int64), lengths.astype(np.int32), begin.astype(np.int32)


_KEY_SCHEMA = "batch int, digest binary, id bigint, total int, chunks array<bigint>, sizes array<int>"


def keys_of(named: DataFrame) -> DataFrame:
    """``batch, id, key`` with the key's digest."""
    return named.select("batch", "id", "key", F.unhex(F.md5("key")).alias("digest"))


def chunked(keys: DataFrame) -> DataFrame:
    """Each key of a batch once, with the first row that has it, its length and its chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [k.encode() for k in b.column(3).to_pylist()]
            hashes, lengths, begin = chunks_of(texts)
            lists = pa.ListArray.from_arrays(pa.array(begin), pa.array(hashes))
            sizes = pa.ListArray.from_arrays(pa.array(begin), pa.array(lengths))
            total = pa.array(np.fromiter(map(len, texts), np.int32, len(texts)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), total, lists, sizes], names=["batch", "digest", "id", "total", "chunks", "sizes"])

    once = keys.groupBy("batch", "digest").agg(F.min("id").alias("id"), F.first("key").alias("key"))
    return once.select("batch", "digest", "id", "key").mapInArrow(run, _KEY_SCHEMA)


def _rarest(keys: DataFrame, counts: np.ndarray, coverage: float) -> DataFrame:
    """``keys`` with ``rare``: their rarest chunks, as few as anything that covers a key must share one of.

    What shares none of chunks that hold more than 1 - ``coverage`` of a key's bytes covers less than ``coverage`` of it.
    ``counts`` (a fixed number of slots of chunk hashes) only say which chunks are rare: results do not depend on them.
    """
    held = keys.sparkSession.sparkContext.broadcast(counts)
    schema = "digest binary, id bigint, total int, chunks array<bigint>, sizes array<int>, rare array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = held.value
        for b in batches:
            flat, lens = b.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64), b.column(4).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column(3)).to_numpy(zero_copy_only=False))
            by = np.lexsort((flat, slots[flat % SLOTS], row))
            row, flat, lens = row[by], flat[by], lens[by]
            upto = np.cumsum(lens) - lens
            begin = np.searchsorted(row, np.arange(b.num_rows))
            before = upto - upto[np.minimum(begin, max(len(upto) - 1, 0))][row] if len(row) else upto
            total = b.column(2).to_numpy(zero_copy_only=False)
            kept = before <= (1 - coverage) * total[row] + 1e-9
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=b.num_rows))]).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[kept]))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(5)), rare], names=["digest", "id", "total", "chunks", "sizes", "rare"])

    return keys.select("digest", "id", "total", "chunks", "sizes").mapInArrow(run, schema)


def _bytes_in(chunks: Column, sizes: Column, other: Column) -> Column:
    """Bytes of the chunks that ``other`` has as well."""
    return F.aggregate(F.zip_with(chunks, sizes, lambda c, n: F.when(F.array_contains(other, c), n).otherwise(0)), F.lit(0), lambda a, x: a + x)


class ChunkStore:
    """The lasting table from chunks to accepted records, below ``path``; a store that is there already is taken up again.

    Per batch it holds two things: ``index/batch=N``, its keys under their rarest chunks, dealt into buckets by chunk, with the owner of
    those that repeat another; and ``counts-N``, how often its chunks fall into each of ``SLOTS`` slots.
    """

    INDEX = "chunk bigint, id bigint, digest binary, owner bigint, covered double, total int, chunks array<bigint>, sizes array<int>, batch int, bucket int"

    def __init__(self, spark, path: str | None = None, coverage: float = COVERAGE):
        self.spark, self.coverage = spark, coverage
        self.path = path or scratch_path(spark, "chunks")
        self.buckets: int | None = None
        self.counts: dict[int, np.ndarray] = {}
        there = set(names_in(spark, self.path)) if path else set()
        if "buckets" in there:
            self.buckets = int(read_bytes(spark, f"{self.path}/buckets"))
        for name in there:
            # the counts are written last: a batch whose append was broken off is not there
            if name.startswith("counts-") and name.count(".") == 0:
                self.counts[int(name[7:])] = np.frombuffer(read_bytes(spark, f"{self.path}/{name}"), np.int64)

    @property
    def batches(self) -> list[int]:
        return sorted(self.counts)

    def _index_of(self, batch: int) -> str:
        return f"{self.path}/index/batch={batch}"

    def _at(self, what: str, batch: int) -> str:
        return f"{self.path}/{what}-{batch:06d}"

    def _read(self, batches: list[int]) -> DataFrame:
        return self.spark.read.schema(self.INDEX).option("basePath", f"{self.path}/index").parquet(*[self._index_of(b) for b in batches])

    def _index(self, keys: DataFrame | None = None) -> DataFrame:
        """The accepted records of all batches; for ``keys`` that touch few buckets only these are read."""
        index = self._read(self.batches).where("owner is null").drop("owner", "covered")
        if keys is not None and self.buckets > 1:
            touched = [r[0] for r in keys.select(F.explode("chunks").alias("c")).select(F.pmod("c", F.lit(self.buckets)).cast("int")).distinct().collect()]
            if len(touched) < self.buckets:
                index = index.where(F.col("bucket").isin(touched))
        return index

    def _found(self, keys: DataFrame, index: DataFrame, small: bool) -> DataFrame:
        """``digest, owner, covered`` of the keys that a record of ``index`` covers: the best covering one, of equals the first.

        Records are in the index by their rarest chunks only, and keys ask with all of theirs. So what is widely shared brings up
        next to nothing, and what covers is met whatever was rare when it was put there.
        """
        c = self.coverage
        asked = keys.select(F.col("digest").alias("q_digest"), F.col("id").alias("q_id"), F.col("total").alias("q_total"), F.col("chunks").alias("q_chunks"), F.col("sizes").alias("q_sizes"), F.explode(F.array_distinct("chunks")).alias("chunk"))
        if small:  # the index is sifted where it lies; only what a batch asks for is moved
            index = index.join(F.broadcast(asked.select("chunk").distinct()), "chunk", "left_semi")
        pairs = index.join(asked, "chunk").where((F.col("id") < F.col("q_id")) & (F.col("total") >= c * F.col("q_total")) & (F.col("q_total") >= c * F.col("total")))
        mine = _bytes_in(F.col("q_chunks"), F.col("q_sizes"), F.col("chunks")) / F.col("q_total")
        theirs = _bytes_in(F.col("chunks"), F.col("sizes"), F.col("q_chunks")) / F.col("total")
        covered = pairs.select("q_digest", "digest", "id", F.least(mine, theirs).alias("covered")).where(F.col("covered") >= c)
        if c == 1.0:  # an exact check may follow: the same chunks in another order are another key
            covered = covered.where("q_digest = digest")
        best = covered.groupBy("q_digest").agg(F.max(F.struct("covered", (-F.col("id")).alias("first"))).alias("x"))
        return best.select(F.col("q_digest").alias("digest"), (-F.col("x.first")).alias("owner"), "x.covered")

    def append(self, batch: int, keys: DataFrame) -> None:
        """Checks one batch of keys (from ``chunked``) and appends it: keys without an owner are accepted, the others point to theirs.

        A batch that is appended again takes its own place again. How widely a chunk is shared is learnt with every batch.
        """
        self.counts.pop(batch, None)
        spread = keys.select("digest", "id", "total", "chunks", "sizes")
        new = np.zeros(SLOTS, np.int64)
        for slot, n in spread.select(F.explode("chunks").alias("c")).groupBy(F.pmod("c", F.lit(SLOTS)).cast("int").alias("slot")).count().collect():
            new[slot] = n
        small = int(new.sum()) <= BROADCAST_CHUNKS
        if self.buckets is None:
            self.buckets = max(1, -(-int(new.sum()) // BUCKET_CHUNKS))
            write_bytes(self.spark, f"{self.path}/buckets", str(self.buckets).encode())
        known = _rarest(spread, sum(self.counts.values(), new), self.coverage)
        found = []
        if self.counts:
            found.append(self._found(spread, self._index(spread), small))
        if self.coverage < 1:  # equal keys are one key by now; alike ones may be in one batch
            found.append(self._found(spread, known.withColumn("chunk", F.explode(F.array_distinct("rare"))), small))
        if found:
            best = found[0] if len(found) == 1 else found[0].unionByName(found[1]).groupBy("digest").agg(F.max(F.struct("covered", (-F.col("owner")).alias("first"))).alias("x")).select("digest", (-F.col("x.first")).alias("owner"), "x.covered")
            decided = known.join(F.broadcast(best) if small else best, "digest", "left")
        else:
            decided = known.withColumns({"owner": F.lit(None).cast("bigint"), "covered": F.lit(None).cast("double")})
        rows = decided.select(F.explode(F.array_distinct("rare")).alias("chunk"), "id", "digest", "owner", "covered", "total", "chunks", "sizes")
        rows = rows.withColumn("bucket", F.pmod("chunk", F.lit(self.buckets)).cast("int"))
        if self.buckets > 1:
            rows = rows.repartition("bucket").sortWithinPartitions("bucket", "chunk")
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(self._index_of(batch))
        write_bytes(self.spark, self._at("counts", batch), new.tobytes())
        self.counts[batch] = new

    def keys(self) -> DataFrame:
        """``batch, digest, id, owner, covered`` of each key of each batch; a key that is under several chunks comes once."""
        rows = self._read(self.batches).select("batch", "digest", "id", "owner", "covered")
        return rows if self.coverage == 1.0 else rows.dropDuplicates(["batch", "digest"])

    def owners(self) -> DataFrame:
        """``batch, digest, owner``: for each key of each batch the row that was accepted first."""
        return self.keys().select("batch", "digest", F.coalesce("owner", "id").alias("owner"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``a, b``: every node but the smallest of its component with it, as ``node, root``.

    Alternating large and small stars; each round is a written table, and no node's neighbours are gathered in one place.
    """
    e = written(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(small_low.select("u", F.col("m").alias("v"))).distinct()
        e = written(small, "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def page_keys(rows: DataFrame) -> DataFrame:
    """``batch, id, key``: what names the page of each row, none to two keys."""
    forms = F.array(F.concat(F.lit("f:"), fingerprint_form(F.col("fingerprint"))), F.concat(F.lit("u:"), same_page_form(F.col("canonical_url"))))
    return rows.select(F.coalesce("batch_no", F.lit(0)).cast("int").alias("batch"), F.col("id").cast("bigint").alias("id"), F.explode(F.array_compact(forms)).alias("key"))


def follow(stream: DataFrame, store: ChunkStore, checkpoint: str):
    """A streaming query that checks and appends every micro-batch of rows; one that is run again is appended once."""
    return stream.writeStream.foreachBatch(lambda rows, n: store.append(n, written(chunked(keys_of(page_keys(rows).withColumn("batch", F.lit(n)))), "batch"))).option("checkpointLocation", checkpoint)


def content_keys(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``batch, id, key``: what the ``columns`` of each row say, none where they say nothing."""
    text = F.concat_ws("\n", *[F.nullif(F.trim(c), F.lit("")) for c in columns])
    return rows.select(F.coalesce("batch_no", F.lit(0)).cast("int").alias("batch"), F.col("id").cast("bigint").alias("id"), F.concat(F.lit("t:"), text).alias("key")).where("key != 't:'")


def checked(named: DataFrame, coverage: float = COVERAGE) -> tuple[ChunkStore | None, DataFrame]:
    """All batches of ``named`` (batch, id, key) taken one after the other by a store of their own; and ``batch, id, digest`` of all."""
    keys = written(keys_of(named), "named")
    once = written(chunked(keys), "once", ["batch"])
    batches = sorted(r[0] for r in once.select("batch").distinct().collect())
    store = ChunkStore(named.sparkSession, coverage=coverage) if batches else None
    for batch in batches:
        store.append(batch, once.where(F.col("batch") == batch))
    return store, keys.select("batch", "id", "digest")


def repeats(rows: DataFrame) -> DataFrame:
    """``first_id, id`` of every row of a later batch that repeats an earlier row, directly or through further rows.

    ``rows``: id, batch_no, fingerprint, canonical_url. The batches are taken one after the other, in order of their number.
    Only owners that some row names together are linked further, however many rows name them.
    """
    store, keys = checked(page_keys(rows))
    if store is None:
        return rows.sparkSession.createDataFrame([], "first_id bigint, id bigint")
    named = keys.join(store.owners(), ["batch", "digest"])
    mine = written(named.groupBy("id").agg(F.min("owner").alias("low"), F.max("owner").alias("high"), F.max("batch").alias("batch")), "owners")
    roots = components(mine.where("low != high").select(F.col("low").alias("a"), F.col("high").alias("b")).distinct())
    out = mine.where("batch >= 1").join(roots, F.col("low") == F.col("node"), "left").select(F.coalesce("root", "low").alias("first_id"), "id")
    return out.where("first_id < id")


def alike(rows: DataFrame, columns: list[str], coverage: float = NEAR) -> DataFrame:
    """``id, near_id, coverage`` of every row of a later batch whose ``columns`` an accepted row covers.

    The bytes of chunks that both have make up ``coverage`` of either at least; of several records the best covering one, of
    equals the first. A row may be covered by an earlier one of its own batch, be that accepted or not; rows of a batch that
    say the same have what the first of them has, or repeat it.
    """
    store, keys = checked(content_keys(rows, columns), coverage)
    if store is None:
        return rows.sparkSession.createDataFrame([], "id bigint, near_id bigint, coverage double")
    owned = store.keys().withColumnRenamed("id", "first")
    out = keys.where("batch >= 1").join(owned, ["batch", "digest"])
    near = F.coalesce("owner", F.when(F.col("first") < F.col("id"), F.col("first")))
    return out.select("id", near.alias("near_id"), F.when(F.col("owner").isNotNull(), F.round("covered", 6)).otherwise(1.0).alias("coverage")).where("near_id is not null")
