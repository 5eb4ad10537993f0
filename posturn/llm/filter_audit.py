"""Filter interaction audit: what each filter removes, in every order of the filters.

One id table per filter holds the rows that fail it.  Which rows survive a
prefix of filters depends on the set of filters alone, so the sets are carried
as bits: every row that fails anything starts with the empty set and goes
through the filters once; at each it takes two lanes, one that leaves the
filter out and one whose set has it, and a left-anti join with the filter's ids
ends the second lane of rows that fail.  What is left are the survivors of
every set.  A left-semi join of the survivors with each filter's ids gives
the removals that the filter makes after the set.  All ten joins are on the
row key; counts by part and set are small, and the orders are read off them.

Rows that fail nothing survive every set and are only counted.  Texts are read
once.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posturn.llm.common import written

#: A filter given as this fails the rows whose text a smaller id has too.
COPY_OF_EARLIER = "copy of an earlier row"
#: More filters than this have more orders than a report can hold.
MOST_FILTERS = 6
#: Groups of equal texts above this share of all rows are joined by broadcast; there are fewer than its inverse.
HOT_SHARE = 1 / 10_000
#: Label tables of up to so many rows (a few MB as a hash table) may be broadcast.
BROADCAST_LABELS = 100_000


def earlier_copies(rows: DataFrame) -> DataFrame:
    """``(row)`` of the rows whose ``digest`` a row with a smaller ``doc_id`` has; a null id is neither smaller nor larger."""
    n = rows.count()
    groups = written(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                                                F.count("*").alias("n")).where("first < last"), "audit-copies")
    hot = F.col("n") > n * HOT_SHARE
    ids = rows.select("row", "doc_id", "digest")

    def later(some: DataFrame) -> DataFrame:
        return ids.join(some, "digest").where("doc_id > first").select("row")

    return later(F.broadcast(groups.where(hot))).unionByName(later(groups.where(~hot)))


def _labelled(rows: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with ``good`` and ``toxic`` as 0 or 1; of an id's label rows one that says so is enough."""
    flags = labels.groupBy(F.col(id_col).alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).where("doc_id is not null")
    flags = written(flags, "audit-labels")
    if flags.count() <= BROADCAST_LABELS:
        flags = F.broadcast(flags)
    known = rows.where("doc_id is not null").join(flags, "doc_id", "left")
    absent = rows.where("doc_id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    return known.unionByName(absent, allowMissingColumns=True).select(
        "row", "part", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def failing_ids(docs: DataFrame, filters: Mapping[str, Column | str], id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "lang") -> tuple[DataFrame, dict[str, DataFrame]]:
    """All rows as ``(row, doc_id, part)``, and one table of failing ``(row)`` per filter; ``row`` is unique.

    A condition that is null does not fail.  A null part counts as ''.
    """
    # Conditions see the caller's columns; only what follows is kept, so no other name can clash.
    flags = [F.coalesce(c, F.lit(False)).alias(f"fails_{k}") for k, c in enumerate(filters.values()) if not isinstance(c, str)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), *flags), "audit-rows")
    tables = {}
    for k, (name, condition) in enumerate(filters.items()):
        failing = earlier_copies(rows) if isinstance(condition, str) else rows.where(f"fails_{k}").select("row")
        tables[name] = written(failing, f"audit-{k}")
    return rows.select("row", "doc_id", "part"), tables


def survivors(rows: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``rows`` once per set of filters that they pass, as bits in ``passed`` in the order of ``tables``."""
    out = rows.withColumn("passed", F.lit(0))
    for bit, ids in enumerate(tables.values()):
        lanes = out.withColumn("through", F.explode(F.array(F.lit(False), F.lit(True))))
        ids = ids.select(F.col("row").alias("failing"))
        out = lanes.join(ids, (lanes["row"] == ids["failing"]) & lanes["through"], "left_anti").withColumn(
            "passed", F.when(F.col("through"), F.col("passed") + (1 << bit)).otherwise(F.col("passed"))).drop("through")
    return out


def orders(names: list[str]) -> list[tuple[int, str, int, str, int, int]]:
    """``(k, order, step, filter, bits before, bits after)`` of every step of every order."""
    bit = {name: 1 << k for k, name in enumerate(names)}
    steps = []
    for order in itertools.permutations(names):
        before = 0
        for step, name in enumerate(order, 1):
            steps.append((len(steps), "".join(order), step, name, before, before | bit[name]))
            before |= bit[name]
    return steps


def audit(docs: DataFrame, filters: Mapping[str, Column | str], labels: DataFrame, id_col: str = "doc_id",
          text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``filters`` maps names to failure conditions on ``docs``, or to
    ``COPY_OF_EARLIER``.  Columns: part, filter_order (the names joined), step
    and, in rows of the part, kept (after the step), removed (by it), redundant (fail its filter,
    removed earlier), unique_fails (fail its filter only), good_lost and toxic_lost (removed here, labelled
    so), shapley (the filter's removals summed over all orders).  Rows are
    told apart one by one, so null and repeated ids count each; other columns
    are ignored.  An empty table gives no rows.
    """
    names = list(filters)
    if not 1 <= len(names) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters can be audited")
    spark = docs.sparkSession
    rows, tables = failing_ids(docs, filters, id_col, text_col, part_col)
    every = tables[names[0]]
    for name in names[1:]:
        every = every.unionByName(tables[name])
    failing = _labelled(rows.join(every, "row", "left_semi"), labels, id_col)
    passing = written(survivors(failing, tables), "audit-survivors")

    removed = None
    for bit, name in enumerate(names):
        hit = passing.where(F.col("passed").bitwiseAND(1 << bit) == 0).join(tables[name], "row", "left_semi")
        hit = hit.groupBy("part", "passed").agg(F.count("*").alias("removed"), F.sum("good").alias("good_lost"),
                                                F.sum("toxic").alias("toxic_lost")).withColumn("filter", F.lit(name))
        removed = hit if removed is None else removed.unionByName(hit)
    removed = written(removed, "audit-removed")
    sizes = rows.groupBy("part").agg(F.count("*").alias("total"))
    left = passing.groupBy("part", "passed").agg(F.count("*").alias("left"))
    # Every failing row survives the empty set.
    failed = left.where("passed = 0").select("part", F.col("left").alias("failed"))
    parts = written(sizes.join(failed, "part", "left").select(
        "part", F.expr("total - coalesce(failed, 0)").alias("clean")), "audit-parts")

    n, others = len(names), {name: (1 << len(names)) - 1 - (1 << k) for k, name in enumerate(names)}
    weight = F.element_at(F.array(*[F.lit(w) for w in _weights(n)]), F.bit_count("passed") + 1)
    last = F.create_map(*[F.lit(x) for pair in others.items() for x in pair])
    per_filter = removed.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * weight).alias("shapley"),
        F.sum(F.when(F.col("passed") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.col("passed") == last[F.col("filter")], F.col("removed"))).alias("unique_fails"))

    steps = orders(names)
    known = F.broadcast(spark.createDataFrame(steps, "k int, filter_order string, step int, filter string, before int, after int"))
    report = parts.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1)))).join(known, "k")
    report = report.join(removed.withColumnRenamed("passed", "before"), ["part", "filter", "before"], "left") \
        .join(per_filter, ["part", "filter"], "left") \
        .join(left.withColumnRenamed("passed", "after"), ["part", "after"], "left")

    def count(expr: str, name: str) -> Column:
        return F.expr(expr).cast("long").alias(name)

    return report.select(
        "part", "filter_order", "step", count("clean + coalesce(left, 0)", "kept"), count("coalesce(removed, 0)", "removed"),
        count("coalesce(fails, 0) - coalesce(removed, 0)", "redundant"), count("coalesce(unique_fails, 0)", "unique_fails"),
        count("coalesce(good_lost, 0)", "good_lost"), count("coalesce(toxic_lost, 0)", "toxic_lost"),
        count("coalesce(shapley, 0)", "shapley"))


def _weights(n: int) -> list[int]:
    """Orders in which a filter comes right after a given set, by the set's size."""
    factorial = [1]
    for k in range(1, n):
        factorial.append(factorial[-1] * k)
    return [factorial[k] * factorial[n - 1 - k] for k in range(n)]
