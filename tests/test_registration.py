"""Registration as a stream: outcomes don't depend on the order in which rows arrive, nor on what is delivered twice."""

import random
import shutil
import time
from datetime import timedelta

import pytest

from lexloom.plans import QUERIES
from lexloom.streaming import registration


def expected(rows, known):
    first = {}
    for i, h, at in rows:
        first[h] = min(first.get(h, (2**70, "")), (at, str(i)))
    return {(i, h): "loaded" if first[h] == (at, str(i)) and h not in known else "duplicate_content" for i, h, at in rows}


class Feed:
    """A folder of files that a stream reads one by one, and the folder of its outcomes."""

    def __init__(self, spark, base, known, keep=timedelta(days=1)):
        self.spark, self.base, self.keep = spark, f"file://{base}", keep
        self.known = spark.createDataFrame([(k,) for k in known], "h string")

    def put(self, rows):
        self.spark.createDataFrame(rows, "doc_id long, h string, at long").coalesce(1).write.mode("append").parquet(f"{self.base}/in")
        time.sleep(0.01)  # files are read in the order of their times

    def run(self):
        stream = self.spark.readStream.schema("doc_id long, h string, at long").option("maxFilesPerTrigger", 1).parquet(f"{self.base}/in")
        return registration.deliver(registration.outcomes(stream, self.known, "h", "at", "doc_id", self.keep), f"{self.base}/out", f"{self.base}/position")

    def result(self):
        return {(r.id, r.content): r.reason for r in registration.settled(self.spark, f"{self.base}/out", "long").collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_gives_the_same(spark, tmp_path, seed):
    rnd = random.Random(seed)
    rows = [(i, "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", "known", None, f"own{i}"]), rnd.randrange(40)) for i in range(120)]
    rnd.shuffle(rows)
    feed = Feed(spark, tmp_path, ["known", None])
    for k in range(0, 120, 40):
        feed.put(rows[k : k + 40] + rows[k : k + 3])  # some rows come twice
    feed.put(rows[:10])
    assert feed.run() == 4
    assert feed.result() == expected(rows, {"known"})
    feed.put(rows[50:60])  # and again, to a stream that goes on
    feed.run()
    assert feed.result() == expected(rows, {"known"})


def test_a_batch_that_is_delivered_again_changes_nothing(spark, tmp_path):
    rows = [(5, "a", 5), (3, "a", 3), (9, "b", 1)]
    feed = Feed(spark, tmp_path, [])
    feed.put(rows[:1])
    feed.put(rows[1:])
    feed.run()
    before = feed.result()
    assert before == expected(rows, set())
    shutil.rmtree(tmp_path / "position" / "commits")  # as if it had stopped before it noted the batches
    feed.run()
    assert feed.result() == before


def test_contents_are_forgotten_after_a_while(spark, tmp_path):
    feed = Feed(spark, tmp_path, [], timedelta(milliseconds=1))
    for row in [(1, "a", 1), (2, "b", 2), (3, "a", 3)]:
        feed.put([row])
        feed.run()
        time.sleep(0.05)
    assert feed.result() == {(1, "a"): "loaded", (2, "b"): "loaded", (3, "a"): "loaded"}


def test_nothing_arrives(spark, tmp_path):
    feed = Feed(spark, tmp_path, [])
    spark.createDataFrame([], "doc_id long, h string, at long").write.parquet(f"{feed.base}/in")
    feed.run()
    assert feed.result() == {}


def test_the_query_equals_one_look(spark, sf):
    stream = {tuple(r) for r in QUERIES["stream_register"](spark, sf).select("doc_id", "reason").collect()}
    assert stream == {tuple(r) for r in QUERIES["bronze_dedup_first_wins"](spark, sf).select("doc_id", "reason").collect()}


def test_contents_share_buckets(spark, tmp_path):
    """Python is called once a bucket, not once a content, with the same outcomes."""
    rnd = random.Random(4)
    rows = [(i, rnd.choice(["hot", "known", None, f"own{i}", f"pair{i // 2}"]), rnd.randrange(40)) for i in range(200)]
    base = f"file://{tmp_path}"
    for k in range(0, 200, 50):
        spark.createDataFrame(rows[k : k + 50], "doc_id long, h string, at long").coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema("doc_id long, h string, at long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    changes = registration.outcomes(stream, spark.createDataFrame([("known",)], "h string"), "h", "at", "doc_id", buckets=3)
    assert registration.deliver(changes, f"{base}/out", f"{base}/position") == 4
    assert {(r.id, r.content): r.reason for r in registration.settled(spark, f"{base}/out", "long").collect()} == expected(rows, {"known"})
    state = spark.read.format("statestore").load(f"{base}/position")
    assert state.filter("key.slot >= 0").count() <= 3
