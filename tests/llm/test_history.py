import random

from noticeworks.llm import history
from noticeworks.llm.history import ChunkStore, alike, chunked, chunks_of, components, follow, keys_of, repeats
from pyspark.sql import functions as F


def batch_of(named):
    return chunked(keys_of(named))


def test_chunks_are_local_and_whole():
    random.seed(1)
    text = bytes(random.randrange(256) for _ in range(4000))
    hashes, lengths, begin = chunks_of([text, b"", b"insert" + text, text])
    parts = [hashes[begin[i] : begin[i + 1]].tolist() for i in range(4)]
    assert lengths[begin[0] : begin[1]].sum() == 4000 and parts[1] == [] and parts[0] == parts[3]
    assert len(set(parts[0]) & set(parts[2])) >= len(parts[0]) - 3  # an insertion moves only the chunks it touches
    assert chunks_of([])[2].tolist() == [0]


def test_components(spark):
    random.seed(2)
    for n in (0, 1, 40):
        edges = [(random.randrange(60), random.randrange(60)) for _ in range(n)] + ([(i, i + 1) for i in range(100, 140)] if n else [])
        parent = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for a, b in edges:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        expected = sorted((x, find(x)) for x in parent if find(x) != x)
        df = spark.createDataFrame(edges, "a long, b long")
        assert sorted(tuple(r) for r in components(df).collect()) == expected


F1, F2, F3 = ("%064x" % i for i in (1, 2, 3))


def test_repeats(spark):
    u = "https://h.example/notice?id="
    rows = [
        (1, 0, F1, u + "1"), (2, 0, F2, u + "2"), (3, 0, None, None), (4, 1, "SHA256:" + F1.upper(), ""), (5, 1, None, "HTTP://H.example:80/notice/?utm_source=a&id=2#x"),
        (6, 1, "", None), (7, 2, F3, u + "7"), (8, 2, F3, u + "8"), (9, 3, None, u + "8&from=x"), (10, 3, F1, u + "2"), (11, 3, None, u + "3&lot=1"), (12, 3, None, u + "3&lot=2"), (13, None, None, u + "99"),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], "id long, batch_no int, fingerprint string, canonical_url string, owner int")
    got = {r["id"]: r["first_id"] for r in repeats(df).collect()}
    assert got == {4: 1, 5: 1, 8: 7, 9: 7, 10: 1}  # 10 joins the pages of 1 and 2
    assert repeats(df.where("false")).count() == 0


def test_a_store_lasts(spark, tmp_path):
    def batch(n, low, high):
        return batch_of(spark.range(low, high).selectExpr(f"{n} as batch", f"id + {n} * 10000 as id", "'u:h.example/notice?id=' || id as key"))

    path = f"file://{tmp_path}/store"
    ChunkStore(spark, path).append(0, batch(0, 0, 500))
    again = ChunkStore(spark, path)
    assert again.batches == [0] and again.buckets == 1
    again.append(1, batch(1, 400, 600))
    owners = ChunkStore(spark, path).owners().where("batch = 1")
    assert owners.count() == 200 and owners.where("owner < 10000").count() == 100


def _pages(spark, batch, low, high, shift, host="h.example"):
    return batch_of(spark.range(low, high).selectExpr(f"{batch} as batch", f"id + {shift} as id", f"'u:{host}/portal/detail?noticeId=G' || lpad(cast(id as string), 8, '0') as key"))


def test_widely_shared_chunks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(history, "BUCKET_CHUNKS", 2_000)  # several buckets
    store = ChunkStore(spark)
    store.append(0, _pages(spark, 0, 0, 3000, 0))
    assert store.buckets > 1
    store.append(1, _pages(spark, 1, 2000, 4000, 10_000))
    owners = store.owners().where("batch = 1")
    assert owners.where("owner < 10000").count() == 1000 and owners.count() == 2000
    store.append(2, _pages(spark, 2, 3500, 3600, 20_000))
    assert store.owners().where(F.col("batch") == 2).where("owner between 13500 and 13599").count() == 100
    # of a host that becomes common only now, no record is found by the common chunks
    store.append(3, _pages(spark, 3, 0, 2000, 30_000, "new.example"))
    index = store._index()
    asked = _pages(spark, 4, 0, 50, 40_000, "new.example").select("digest", F.explode("chunks").alias("chunk"))
    assert asked.join(index.select("chunk", "id"), "chunk").count() <= 50 * 40
    assert index.groupBy("id").count().where("count > 1").count() == 0


def test_few_buckets_are_read(spark, monkeypatch):
    monkeypatch.setattr(history, "BUCKET_CHUNKS", 200)
    store = ChunkStore(spark)
    store.append(0, _pages(spark, 0, 0, 2000, 0))
    assert store.buckets > 20
    pruned = store._index(_pages(spark, 1, 5, 7, 10_000))
    assert pruned.select("bucket").distinct().count() <= 20
    assert "bucket" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_alike_against_brute_force(spark):
    random.seed(5)
    signs = "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥天地玄黄宇宙洪荒"
    texts = []
    for i in range(60):
        if i > 5 and random.random() < 0.6:
            t = list(random.choice(texts))
            for _ in range(random.randint(0, 3)):
                t[random.randrange(len(t))] = random.choice(signs)
            texts.append("".join(t))
        else:
            texts.append("".join(random.choices(signs, k=80)))
    rows = [(i, i // 15, t, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, (100, 2, None, ""), (101, 2, " ", None)], "id long, batch_no int, title string, summary string")
    parts = []
    hashes, lengths, begin = chunks_of([f"t:{t}".encode() for t in texts])
    for i in range(len(texts)):
        parts.append(list(zip(hashes[begin[i] : begin[i + 1]].tolist(), lengths[begin[i] : begin[i + 1]].tolist())))

    def covered(i, j):
        inside = lambda a, b: sum(n for c, n in a if c in {x for x, _ in b}) / sum(n for _, n in a)
        sizes = sorted(sum(n for _, n in parts[k]) for k in (i, j))
        return min(inside(parts[i], parts[j]), inside(parts[j], parts[i])) if sizes[0] >= 0.8 * sizes[1] else 0.0

    expected, accepted = {}, set()
    for batch in range(4):
        mine = range(batch * 15, batch * 15 + 15)
        taken = set()
        for i in mine:
            first = next(k for k in mine if texts[k] == texts[i])
            if first < i:  # the same text has the same owner
                expected[i] = expected.get(first, (first, 1.0))
                continue
            options = [(covered(i, j), -j) for j in [*accepted, *(k for k in mine if k < i)] if covered(i, j) >= 0.8]
            if options:
                expected[i] = (-max(options)[1], round(max(options)[0], 6))
            else:
                taken.add(i)
        accepted |= taken
    got = {r["id"]: (r["near_id"], r["coverage"]) for r in alike(df, ["title", "summary"]).collect()}
    assert got == {i: x for i, x in expected.items() if i >= 15} and len(got) > 10
    assert alike(df.where("false"), ["title", "summary"]).count() == 0


def test_stream_of_batches(spark, tmp_path):
    schema = "id long, batch_no int, fingerprint string, canonical_url string"
    url = "https://h.example/notice?id="
    for n, rows in enumerate([[(1, 0, F1, url + "1"), (2, 0, None, url + "2")], [(3, 1, None, url + "2#top"), (4, 1, F1, None), (5, 1, F2, url + "5")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(n)))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in" / "*"))
    store = ChunkStore(spark, f"file://{tmp_path}/store")
    follow(stream, store, str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(180)
    assert store.batches == [0, 1]
    assert sorted((r["owner"]) for r in store.owners().where("batch = 1").collect()) == [1, 2, 5, 5]
    before = sorted(map(tuple, store.owners().collect()))
    store.append(1, batch_of(spark.createDataFrame([(1, 3, "u:h.example/notice?id=2"), (1, 5, "u:h.example/notice?id=5")], "batch int, id long, key string")))
    assert store.batches == [0, 1] and len(before) == 7 and store.owners().where("batch = 1 and owner = 2").count() == 1
