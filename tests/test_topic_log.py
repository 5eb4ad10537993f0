"""The topic source and sink: commits, offsets, restarts, replays, lost writes."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from posturn.schemas import ENVELOPE, LANDING
from posturn.session import scratch_path
from posturn.sources import topic_log
from posturn.sources.topic_log import FORMAT, Store, TopicStreamWriter, TopicWriter, register


@pytest.fixture()
def topic(spark, request):
    register(spark)
    return scratch_path(spark, "topics", f"{request.node.name}-{os.urandom(4).hex()}")


def put(spark, path, rows):
    spark.createDataFrame(rows, LANDING).write.format(FORMAT).mode("append").save(path)


def got(spark, path):
    return sorted(r.key for r in spark.read.format(FORMAT).schema(LANDING).load(path).collect())


def run_copy(spark, source, target, checkpoint):
    q = (spark.readStream.format(FORMAT).schema(LANDING).load(source).writeStream.format(FORMAT)
         .option("path", target).option("writer", "copy").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def test_restarts_neither_lose_nor_repeat(spark, topic):
    source, target, checkpoint = (os.path.join(topic, d) for d in ("a", "b", "ckpt"))
    put(spark, source, [("1", "x"), ("2", None)])
    put(spark, source, [("3", "x")])
    run_copy(spark, source, target, checkpoint)
    assert got(spark, target) == ["1", "2", "3"]
    run_copy(spark, source, target, checkpoint)           # nothing new
    assert got(spark, target) == ["1", "2", "3"]
    put(spark, source, [("4", "x")] * 3)
    run_copy(spark, source, target, checkpoint)
    assert got(spark, target) == ["1", "2", "3", "4", "4", "4"]


def test_a_batch_whose_commit_was_not_logged_is_replayed_once(spark, topic):
    """The sink has committed, the engine has not: the restarted query sends the batch again."""
    source, target, checkpoint = (os.path.join(topic, d) for d in ("a", "b", "ckpt"))
    for k in range(2):
        put(spark, source, [(str(k), "x")])
        run_copy(spark, source, target, checkpoint)
    last = sorted(f for f in os.listdir(os.path.join(checkpoint, "commits")) if not f.startswith("."))[-1]
    for f in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(checkpoint, "commits", f)):
            os.remove(os.path.join(checkpoint, "commits", f))
    run_copy(spark, source, target, checkpoint)
    assert got(spark, target) == ["0", "1"] and Store(target).commits() == 2
    listed = {s["name"] for k in range(2) for s in Store(target).commit(k)["segments"]}
    assert set(os.listdir(os.path.join(target, "segments"))) == listed   # the repeated segment is gone


def test_uncommitted_and_aborted_writes_are_not_seen(spark, topic):
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"key": ["1"], "value": ["x"]})
    for writer, extra in ((TopicWriter(topic, ""), ()), (TopicStreamWriter(topic, "w"), (0,))):
        lost, kept = writer.write(iter([batch])), writer.write(iter([batch, batch]))
        empty = writer.write(iter([]))
        assert empty.segment is None
        writer.abort([lost, None, empty], *extra)
        before = Store(topic).commits()
        assert not os.path.exists(os.path.join(topic, "segments", lost.segment))
        writer.commit([kept, None, empty], *extra)
        assert Store(topic).commits() == before + 1
    assert got(spark, topic) == ["1"] * 4
    TopicStreamWriter(topic, "other").commit([replace(kept, segment=None)], 0)   # another writer's batch 0 is its own
    assert Store(topic).commits() == 3


def test_splits_follow_row_groups(spark, topic, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(topic_log, "GROUP_ROWS", 10)
    batches = [pa.RecordBatch.from_pydict({"key": [f"{k:03}" for k in range(lo, lo + 10)], "value": ["x" * 100] * 10})
               for lo in range(0, 100, 10)]
    writer = TopicWriter(topic, "")
    writer.commit([writer.write(iter(batches))])
    splits = topic_log._splits(Store(topic), 0, 1, 3000)
    assert len(splits) > 3 and [(s.first, t.first) for s, t in zip(splits, splits[1:])] == [
        (s.first, s.last) for s in splits[:-1]] and splits[-1].last == 10
    df = spark.read.format(FORMAT).schema(LANDING).option("splitBytes", 3000).load(topic)
    assert df.rdd.getNumPartitions() == len(splits) and got(spark, topic) == [f"{k:03}" for k in range(100)]


def test_empty_topics_schemas_and_refusals(spark, topic):
    assert spark.read.format(FORMAT).load(topic).schema == ENVELOPE
    assert spark.read.format(FORMAT).load(topic).count() == 0
    put(spark, topic, [])
    assert got(spark, topic) == []
    put(spark, topic, [("k", "v")])
    rows = spark.read.format(FORMAT).load(topic)          # fields the segment lacks are null
    assert [(r.topic, r.key, r.headers) for r in rows.collect()] == [(None, "k", None)]
    with pytest.raises(Exception, match="only appended"):
        spark.range(1).select(F.lit("k").alias("key")).write.format(FORMAT).mode("overwrite").save(topic)
    with pytest.raises(Exception, match="needs a path"):
        spark.read.format(FORMAT).load().count()
