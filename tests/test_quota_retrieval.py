import math
from collections import Counter
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from quire.functions import plain
from quire.operators import quota
from quire.operators import retrieval as rt
from quire.streaming.limiter import admit_stream


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=UTC).timestamp()


def test_limiter_across_pacific_midnight():
    q = quota.Limiter(2, 0)
    assert [q.take(at(t)) for t in ("2024-01-02T07:59:50", "2024-01-02T07:59:51", "2024-01-02T07:59:52", "2024-01-02T08:00:01")] == [True, True, False, True]
    assert q.used == 1
    spaced = quota.Limiter(0, 60)
    assert spaced.take(at("2024-01-02T07:59:50")) and not spaced.take(at("2024-01-02T08:00:30")) and spaced.wait(at("2024-01-02T08:00:30")) == 20


def test_day_windows_follow_dst(spark):
    rows = spark.createDataFrame([("2024-03-10 20:00:00",), ("2024-11-03 20:00:00",), ("2024-06-01 06:59:59",)], "t string").withColumn("ts", F.col("t").cast("timestamp"))
    got = [(r.w["start"], (r.w["end"] - r.w["start"]).total_seconds() / 3600) for r in rows.select(quota.day_window(F.col("ts")).alias("w")).collect()]
    assert [h for _, h in got] == [23, 25, 24] and got[2][0] == datetime(2024, 5, 31, 7)


def test_error_policy(spark):
    rows = spark.createDataFrame([(429, None, '{"quotaId": "GenerateRequestsPerDay"}'), (404, None, "x"), (503, None, '{"a": [{"retryDelay": "2.5s"}]}'), (None, "ReadTimeout", None), (None, "ValueError", None)], "s int, e string, j string")
    got = rows.select(quota.retryable(F.col("s"), F.col("e")).alias("r"), quota.daily_quota(F.col("j")).alias("d"), quota.retry_delay("j").alias("w")).collect()
    assert [r.r for r in got] == [True, False, True, True, False] and [r.d for r in got] == [True, False, False, False, False] and [r.w for r in got] == [None, None, 2.5, None, None]
    assert quota.backoff(3) == 4 and quota.backoff(9) == 60 and quota.pause_after_429("{}", 3, 5, 99) == 99 and quota.pause_after_429('{"retryDelay": "7s"}', 1, 5, 99) == 7


def test_streaming_limiter_keeps_its_state(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        source = str(tmp_path / "in")
        schema = "key string, ts timestamp"
        for times in (["2024-01-02 10:00:00", "2024-01-02 10:00:10"], ["2024-01-02 10:01:00", "2024-01-02 10:02:30"]):
            spark.createDataFrame([("k", t) for t in times], "key string, t string").select("key", F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(source)
            run = admit_stream(spark.readStream.schema(schema).parquet(source), 2, 30).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out"))
            run.trigger(availableNow=True).start().awaitTermination()
        got = [r.admitted for r in spark.read.parquet(str(tmp_path / "out")).orderBy("ts").collect()]
        assert got == [True, False, True, False]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


DOCS = [(1, "apple pie and apple tart", "Fruit"), (2, "Äpple crumble", ""), (3, "beef stew", "apple"), (4, "nothing here at all", ""), (5, "more stew", None)]


def test_bm25_equals_the_formula(spark):
    chunks = spark.createDataFrame(DOCS, "id long, body string, section string")
    queries = spark.createDataFrame([("q", "apple"), ("q", "stew"), ("r", "nowhere")], "query string, term string")
    got = {(r.query, r.id): r.score for r in rt.bm25(rt.postings(chunks, "id", "body", "section"), chunks, queries, "id").collect()}
    body, head = ({i: Counter(plain.index_terms((r[k]) or "")) for i, *r in [(d[0], d[1], d[2]) for d in DOCS]} for k in (0, 1))
    dl = {i: body[i].total() + head[i].total() for i in body}
    want = {}
    for term in ("apple", "stew"):
        n = sum(body[i][term] + head[i][term] > 0 for i in body)
        idf = math.log((5 - n + 0.5) / (n + 0.5))
        idf = idf if idf > 0 else 1e-6
        for i in body:
            f = 10 * body[i][term] + 3 * head[i][term]
            if f:
                want[("q", i)] = want.get(("q", i), 0) - idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl[i] / (sum(dl.values()) / 5)))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    best = rt.top_k(rt.bm25(rt.postings(chunks, "id", "body", "section"), chunks, queries, "id"), 2, "id").orderBy("rank").collect()
    assert [r.id for r in best] == sorted((i for _, i in want), key=lambda i: (want[("q", i)], i))[:2]


def test_embedding_cache(spark):
    inputs = spark.createDataFrame([("c1", "x", "h1"), ("c2", "x", "h1"), ("c3", "y", "h3")], "chunk_id string, text string, embedding_input_sha256 string")
    make = lambda: rt.FakeEmbedder(16)
    empty = spark.createDataFrame([], "cache_key string, embedding array<float>")
    vectors, new = rt.with_cache(inputs, empty, make)
    assert vectors.count() == 3 and new.count() == 2
    cached = spark.createDataFrame(new.collect(), new.schema)
    assert rt.with_cache(inputs, cached, make)[1].count() == 0
    short = cached.withColumn("embedding", F.slice("embedding", 1, 8))
    assert rt.with_cache(inputs, short, make)[1].count() == 2


def test_cosine(spark):
    vectors = spark.createDataFrame([(i, plain.fake_embedding(str(i), 8)) for i in range(20)], "id long, embedding array<float>")
    queries = spark.createDataFrame([("a", plain.fake_embedding("3", 8))], "query string, q array<double>")
    got = rt.cosine_top_k(vectors, queries, "id", 3).orderBy("rank").collect()
    assert got[0].id == 3 and got[0].score == pytest.approx(1, abs=1e-6)
