import json

from pyspark.sql import functions as F

from noticeworks.operators import state
from noticeworks.sources import frontier
from noticeworks.streaming import admit


def run(query, name, mode, path):
    q = query.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(path)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return query.sparkSession.table(name)


def run_files(query, out, path):
    q = query.writeStream.outputMode("append").format("parquet").option("path", str(out)).option("checkpointLocation", str(path)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return query.sparkSession.read.parquet(str(out))


def test_admission_stream(spark, tmp_path):
    src = tmp_path / "in"
    schema = "k string, at long, status string"
    first = [("a", 1, "matched"), ("a", 2, "matched"), ("b", 1, "failed"), ("b", 2, "failed"), ("b", 3, "matched"), ("b", 4, "matched"), ("c", 1, "unlinked_change"), ("c", 2, "matched")]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(str(src))
    stream = spark.readStream.schema(schema).parquet(str(src))
    out = run_files(admit.admitted(stream, "k", "at", "status"), tmp_path / "out", tmp_path / "c1")
    got = sorted((r["key"], r["place"], r["reason"], r["attempts"]) for r in out.collect())
    assert got == [("a", 1, "new", 0), ("b", 1, "new", 0), ("b", 2, "retry", 1), ("b", 3, "retry", 2), ("c", 1, "new", 0), ("c", 2, "unlinked", 0)]
    # the stream goes on from its state, and what is late is ignored
    spark.createDataFrame([("a", 1, "matched"), ("a", 3, "matched"), ("d", 1, "matched")], schema).coalesce(1).write.mode("append").parquet(str(src))
    out = run_files(admit.admitted(stream, "k", "at", "status"), tmp_path / "out", tmp_path / "c1")
    assert sorted((r["key"], r["place"]) for r in out.collect()) == sorted([(k, p) for k, p, *_ in got] + [("d", 1)])


def test_stream_agrees_with_batch(spark, data, tmp_path):
    e = spark.read.parquet(f"{data}/events.parquet").select("user_id", "event_id", F.when(F.col("event_type") == "error", "failed").otherwise("matched").alias("status"))
    e.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    out = run(admit.admitted(stream, "user_id", "event_id", "status"), "both", "append", tmp_path / "c")
    folded = state.fold_outcomes(e, ["user_id"], "event_id")
    news = out.where("reason = 'new'")
    assert news.count() == folded.count()
    first = e.groupBy("user_id").agg(F.min("event_id").alias("first"))
    assert news.join(first, news.key == first.user_id.cast("string")).where("place = first").count() == folded.count()


def test_once_and_windows(spark, data, tmp_path):
    e = spark.read.parquet(f"{data}/events.parquet").select("event_id", "ts", "event_type")
    for _ in range(2):
        e.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    assert run(admit.admitted_once(stream, "event_id", "ts"), "once", "append", tmp_path / "c1").count() == e.count()
    win = run(admit.counts_by_window(stream, "ts", "event_type"), "win", "complete", tmp_path / "c2")
    assert win.agg(F.sum("rows")).first()[0] == 2 * e.count()


def test_verdict_stream(spark, tmp_path):
    rows = [("u", 1, "confirm"), ("u", 2, "correct"), ("w", 3, "confirm"), ("w", 4, "exclude")]
    spark.createDataFrame(rows, "url string, place long, action string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("url string, place long, action string").parquet(str(tmp_path / "in"))
    out = run(admit.verdict_stream(stream), "verdicts", "complete", tmp_path / "c")
    assert sorted(tuple(r) for r in out.collect()) == [("u", "confirmed", 2), ("w", "excluded", 2)]


def test_frontier_source(spark, tmp_path):
    path = tmp_path / "n.jsonl"
    path.write_text("\n".join(json.dumps({"id": i, "t": f"n{i}"}) for i in (1, 2, 5, 40)))
    frontier.register(spark)
    df = spark.read.format("notice_frontier").option("path", str(path)).option("last_id", 0).load()
    assert [r["id"] for r in df.orderBy("id").collect()] == [1, 2, 5]
    stream = spark.readStream.format("notice_frontier").option("path", str(path)).option("last_id", 0).load()
    q = stream.writeStream.format("memory").queryName("front").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert [r["id"] for r in spark.table("front").orderBy("id").collect()] == [1, 2, 5]
