"""Deliveries to many wildcard subscriptions against matching every pair by its regular expression."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from posturn.functions.topics import topic_regex
from posturn.operators.delivery import deliver
from posturn.sinks.envelopes import broker_records, message_path

TOPIC = "topic string, n int"
SUBSCRIPTION = "queue string, subscription string"


def matches(subscription, topic):
    return re.match(topic_regex(subscription).replace(r"\z", r"\Z"), topic) is not None


@pytest.mark.parametrize("broadcast_rows", [0, 10_000])
def test_deliver_against_every_pair(spark, broadcast_rows):
    rng = random.Random(3)
    words = ["a", "b", "ab", "", "é", "a*b", ">", "*"]
    topics = ["/".join(rng.choice(words[:6]) for _ in range(rng.randrange(1, 5))) for _ in range(150)]
    rows = [(t, k) for k, t in enumerate(topics)] + [(topics[0], 0), (None, -1)]
    subs = [(f"q{rng.randrange(40)}", "/".join(rng.choice([*words, "a*", "é*"]) for _ in range(rng.randrange(1, 5))))
            for _ in range(300)] + [("all", ">"), ("all", "a/>"), (None, ">"), ("none", None)]
    got = sorted(tuple(r) for r in deliver(spark.createDataFrame(rows, TOPIC), spark.createDataFrame(subs, SUBSCRIPTION),
                                           broadcast_rows=broadcast_rows).collect())
    queues = {}
    for q, s in subs:
        if q is not None and s is not None:
            queues.setdefault(q, []).append(s)
    want = sorted((t, n, q) for (t, n), (q, own) in itertools.product(rows, queues.items())
                  if t is not None and any(matches(s, t) for s in own))
    assert set(got) == set(want), (sorted(set(got) - set(want))[:5], sorted(set(want) - set(got))[:5])
    assert got == want and len(want) > 200


def test_deliver_without_rows(spark):
    topics, subs = spark.createDataFrame([("a", 1)], TOPIC), spark.createDataFrame([("q", "a")], SUBSCRIPTION)
    assert deliver(topics, subs.limit(0)).collect() == []
    assert deliver(topics.limit(0), subs).collect() == []
    assert deliver(topics, subs).columns == ["topic", "n", "queue"]
    with pytest.raises(ValueError):
        deliver(topics.withColumnRenamed("n", "queue"), subs)


def test_many_subscriptions_are_one_join(spark):
    subs = spark.range(10_000).selectExpr("concat('q', id) AS queue", "concat('p/*/C_', id, '/>') AS subscription")
    topics = spark.range(500).selectExpr("concat('p/x/C_', id * 7, '/y') AS topic", "int(id) AS n")
    df = deliver(topics, subs)
    assert {(r.n, r.queue) for r in df.collect()} == {(n, f"q{7 * n}") for n in range(500)}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2 and "RLIKE" not in plan


def test_broker_records(spark):
    rows = [("sale/x/receipt/STORE_1/é", "k1", "v", None), ("elsewhere", "k2", "v", [("application", bytearray(b"json"))])]
    env = spark.createDataFrame(rows, "topic string, key string, value string, headers array<struct<key: string, value: binary>>")
    got = broker_records(env, "sale/x").select("topic", "headers", message_path(F.col("headers")).alias("path")).collect()
    assert [r.path for r in got] == [r[0] for r in rows]
    assert [r.topic for r in got] == ["sale.x.receipt", "sale.x.other"]
    assert [[h.key for h in r.headers] for r in got] == [["path"], ["application", "path"]]
