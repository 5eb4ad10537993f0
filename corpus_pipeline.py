"""A corpus pipeline over ``documents``: quality, exact and near copies, benchmark leaks, packing.

Every stage but the last keeps or drops whole rows, so it returns the columns
it was given.  A row is told from others by its ``doc_id`` and text, so rows
with null or repeated ids are judged one by one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from posturn.llm.common import lower_ascii, prepared, table, written
from posturn.llm.decontam import leaks
from posturn.llm.exact import exact_groups
from posturn.llm.packing import pack
from posturn.llm.quality import THRESHOLD, score_rows, train
from posturn.llm.queries import packed_digest
from posturn.llm.simhash import simhash_groups


#: Tables of up to so many ids (about 5 MB as a hash table) may be broadcast; larger ones are joined by shuffle.
BROADCAST_IDS = 100_000


def _sized(ids: DataFrame) -> DataFrame:
    """``ids`` written once, and marked for broadcast if their counted rows allow that."""
    ids = written(ids, "pipeline-ids")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``: id and text digest, in the order of ids with null ids last."""
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    return docs.withColumn("__row", F.struct(F.isnull("doc_id").alias("absent"), F.col("doc_id").alias("id"),
                                             digest.alias("digest")))


def _same(rows: DataFrame, keys: DataFrame):
    """Condition that a row's ``__row`` is a key's ``__id`` and ``__sha``."""
    return rows["__row"]["id"].eqNullSafe(keys["__id"]) & (rows["__row"]["digest"] == keys["__sha"])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier does not reject (predicted 1)."""
    prepared(spark)
    ranker = train(docs, table(spark, sf_dir, "labels"))
    return score_rows(docs, ranker, "__score").where(F.col("__score") >= THRESHOLD).drop("__score")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts (A-Z lower-cased): the largest id's."""
    prepared(spark)
    groups = written(exact_groups(docs), "pipeline-exact")
    ids = groups.select(F.col("doc_id").alias("__id"), F.col("sha256").alias("__sha"), "kept")
    gone = ids.groupBy("__id", "__sha").agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
    # A row repeated with both id and text is kept once.
    gone = _sized(gone.where("not stays or n > 1"))
    digest = F.unhex(F.sha2(lower_ascii(F.coalesce("text", F.lit(""))).cast("binary"), 256))
    rows = docs.withColumn("__digest", digest)
    same = rows["doc_id"].eqNullSafe(gone["__id"]) & (rows["__digest"] == gone["__sha"])
    single = rows.join(gone, same, "left_anti")
    twice = rows.join(gone.where("stays"), same, "left_semi")
    nth = Window.partitionBy("doc_id", "__digest").orderBy(F.lit(1))
    once = twice.withColumn("__n", F.row_number().over(nth)).where("__n = 1").drop("__n")
    return (single if gone.where("stays").isEmpty() else single.unionByName(once)).drop("__digest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash class (3-word shingles, at most 2 bits apart): the least id's, then the least digest's."""
    prepared(spark)
    rows = _keyed(docs)
    groups = simhash_groups(rows, width=3, max_bits=2, id_col="__row")
    keys = groups.groupBy(F.col("doc_id.id").alias("__id"), F.col("doc_id.digest").alias("__sha")).agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count("*").alias("n"))
    # A row repeated with both id and text is kept once.
    gone = _sized(keys.where("not stays or n > 1"))
    single = rows.join(gone, _same(rows, gone), "left_anti")
    stays = gone.where("stays")
    if not stays.isEmpty():
        nth = Window.partitionBy("__row").orderBy(F.lit(1))
        single = single.unionByName(rows.join(stays, _same(rows, stays), "left_semi")
                                    .withColumn("__n", F.row_number().over(nth)).where("__n = 1").drop("__n"))
    return single.drop("__row")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a leaked benchmark item."""
    prepared(spark)
    rows = _keyed(docs)
    found = leaks(rows, table(spark, sf_dir, "benchmark"), id_col="__row")
    gone = _sized(found.select(F.col("doc_id.id").alias("__id"), F.col("doc_id.digest").alias("__sha")).distinct())
    return rows.join(gone, _same(rows, gone), "left_anti").drop("__row")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, as ``op8_packing`` returns them."""
    prepared(spark)
    return packed_digest(pack(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("packing", packing),
]

# No SQL form: a learnt model, SimHash and a tokenizer decide; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again."""
    docs = table(prepared(spark), sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
