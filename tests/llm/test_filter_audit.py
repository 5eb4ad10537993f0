"""Filter audit against a plain walk through every order."""

import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from posturn.llm.common import prepared
from posturn.llm.filter_audit import COPY_OF_EARLIER, audit
from posturn.llm.queries import quality_filters

LABELS = "doc_id long, quality int, toxic int"


def walk(rows, fails, labels):
    """Report rows of ``[(doc_id, part)]`` with one set of failed names each, order by order."""
    names = sorted({n for f in fails for n in f[1]})
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out, shapley = {}, Counter()
    for part in {p or "" for _, p in rows}:
        own = [(r[0], f[0]) for r, f in zip(rows, fails) if (r[1] or "") == part]
        for order in itertools.permutations(names):
            left, gone = own, []
            for step, name in enumerate(order, 1):
                hit = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                out[part, "".join(order), step] = [
                    len(left), len(hit), sum(name in r[1] for r in gone), sum(r[1] == {name} for r in own),
                    sum(r[0] in good for r in hit), sum(r[0] in toxic for r in hit)]
                gone += hit
                shapley[part, name] += len(hit)
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def report(df):
    return sorted(tuple(r) for r in df.collect())


def test_every_order_against_a_walk(spark):
    prepared(spark)
    texts = ["aa", "ab", "b", None, "", "aac", "aa", "aa", "cb", "x"] * 3
    rows = [(k if k % 7 else None, [None, "de", "", "en"][k % 4], t) for k, t in enumerate(texts)] + [(3, "de", None)] * 2
    labels = [(k, k % 2, int(k % 3 == 0)) for k in range(0, 30, 2)] + [(4, 1, 1), (None, 1, 1), (8, None, None)]
    docs = spark.createDataFrame([(*r, 0, "p", 1) for r in rows],
                                 "doc_id long, lang string, text string, row int, part string, passed int").repartition(3)
    filters = {"A": F.col("text").contains("a"), "B": F.col("text").contains("b"), "C": COPY_OF_EARLIER}
    least = {}
    for i, _, t in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    fails = [({n for n in "AB" if n.lower() in (t or "")} | ({"C"} if i is not None and i > least[t or ""] else set()), "ABC")
             for i, _, t in rows]
    got = audit(docs, filters, spark.createDataFrame(labels, LABELS))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    assert report(got) == walk([r[:2] for r in rows], fails, labels)


def test_hot_copies_and_zero_parts(spark):
    """One text in most rows; a part that fails nothing still has its rows."""
    prepared(spark)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2900, "copy").otherwise(
        F.col("id").cast("string")).alias("text"), F.when(F.col("id") < 2950, "en").otherwise("fr").alias("lang"))
    labels = spark.createDataFrame([], LABELS)
    got = report(audit(docs, {"E": COPY_OF_EARLIER, "Z": F.lit(False)}, labels))
    assert got == [("en", "EZ", 1, 51, 2899, 0, 2899, 0, 0, 5798), ("en", "EZ", 2, 51, 0, 0, 0, 0, 0, 0),
                   ("en", "ZE", 1, 2950, 0, 0, 0, 0, 0, 0), ("en", "ZE", 2, 51, 2899, 0, 2899, 0, 0, 5798),
                   ("fr", "EZ", 1, 50, 0, 0, 0, 0, 0, 0), ("fr", "EZ", 2, 50, 0, 0, 0, 0, 0, 0),
                   ("fr", "ZE", 1, 50, 0, 0, 0, 0, 0, 0), ("fr", "ZE", 2, 50, 0, 0, 0, 0, 0, 0)]


def test_empty_table_and_too_many_filters(spark):
    prepared(spark)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], LABELS)
    assert report(audit(docs, quality_filters(), labels)) == []
    with pytest.raises(ValueError):
        audit(docs, {str(k): F.lit(True) for k in range(7)}, labels)
    with pytest.raises(ValueError):
        audit(docs, {}, labels)


def test_the_five_filters_by_hand(spark):
    """Words, distinct words, capitals, signs and copies at their bounds; long texts whole."""
    prepared(spark)
    word = lambda n: " ".join(f"w{k}" for k in range(n))
    rows = [(1, word(199), "A"), (2, word(200), ""), (3, "\v".join(["x"] * 200), "B"), (4, word(100) + " " + word(100), ""),
            (5, word(194) + " ABCDEFG" * 6, "C"), (6, word(200) + " a|b", "D"), (7, word(200), "E"), (8, None, "A"), (9, "", "AE"),
            (10, " \t\n" + word(60_000), ""), (11, "\xa0".join(["y"] * 400), "A")]
    docs = spark.createDataFrame([(i, t, "l") for i, t, _ in rows], "doc_id long, text string, lang string")
    got = report(audit(docs, quality_filters(), spark.createDataFrame([], LABELS)))
    assert got == walk([(i, "l") for i, _, _ in rows], [(set(f), "ABCDE") for _, _, f in rows], [])
