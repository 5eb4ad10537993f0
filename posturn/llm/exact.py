"""Exact duplicates through an extendible-hash index on shared files.

A text's pseudo-key is a 64-bit hash.  The directory starts with one bucket
and doubles while a bucket holds more bytes than the capacity; a bucket then
splits by the next leading bit.  Only a bounded histogram (``2 ** max_depth``
prefixes, more of them for a larger table) reaches the driver.  Each bucket belongs to one owner task, which
reads its keys in order, compares the bytes of equal keys and chains those that
differ.  A bucket that no further bit can split (one text repeated very often)
overflows into several owners; their representatives, one per owner and text,
are compared in a second pass.  The index - keys, chain numbers and ids, texts
only for overflow representatives - is a table in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posturn.llm.common import lower_ascii, shuffle_partitions, written

MAX_DEPTH = 14
#: Leading bits of the directory for tables too large for ``MAX_DEPTH``; the histogram has at most 2 ** 18 numbers.
DEEPEST = 18
MIN_BUCKET_BYTES, MAX_BUCKET_BYTES = 1 << 18, 32 << 20


def directory(sizes: dict[int, int], capacity: int, max_depth: int) -> list[tuple[int, int, int]]:
    """``(first leaf, depth, owners)`` of each bucket, by doubling.

    ``sizes`` has the bytes below each ``max_depth``-bit prefix.  A bucket of
    local depth d covers all prefixes with the same leading d bits.
    """
    prefix = [0]
    for leaf in range(1 << max_depth):
        prefix.append(prefix[-1] + sizes.get(leaf, 0))
    depth, buckets = 0, [(0, 0)]  # (leading bits, local depth)
    while True:
        split = []
        for bits, local in buckets:
            span = max_depth - local
            held = prefix[(bits + 1) << span] - prefix[bits << span]
            if local == depth and held > capacity and local < max_depth:
                split += [(bits << 1, local + 1), (bits << 1 | 1, local + 1)]
            else:
                split.append((bits, local))
        if len(split) == len(buckets):
            break
        depth, buckets = depth + 1, split
    out = []
    for bits, local in buckets:
        span = max_depth - local
        held = prefix[(bits + 1) << span] - prefix[bits << span]
        out.append((bits << span, local, max(1, -(-held // capacity))))
    return out


def depth_for(total: int, least: int) -> int:
    """Leading bits that keep an average bucket of ``total`` bytes under half of the largest capacity."""
    return min(max(least, DEEPEST), max(least, (2 * total // MAX_BUCKET_BYTES).bit_length()))


def _owner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain the rows of each pseudo-key by their bytes.

    Rows come sorted by (bucket, salt, h), so only the distinct texts of one
    pseudo-key are held at a time.
    """
    current, chain = None, []
    for batch in batches:
        cols = batch.to_pydict()
        numbers, firsts, reps = [], [], []
        for bucket, salt, owners, h, text in zip(cols["bucket"], cols["salt"], cols["owners"], cols["h"], cols["text"]):
            if (bucket, salt, h) != current:
                current, chain = (bucket, salt, h), []
            first = text not in chain
            if first:
                chain.append(text)
            numbers.append(chain.index(text))
            firsts.append(first)
            reps.append(text if first and owners > 1 else None)
        keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in keep] + [pa.array(numbers, pa.int32()), pa.array(firsts, pa.bool_()),
                                               pa.array(reps, pa.binary())],
            [batch.schema.names[i] for i in keep] + ["chain", "first", "rep"])


def _owned(rows: DataFrame, order: list) -> DataFrame:
    """Give every (bucket, salt) to one task, sorted by pseudo-key, and chain there."""
    kinds = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != "text")
    return rows.repartition(shuffle_partitions(rows.sparkSession), "bucket", "salt") \
        .sortWithinPartitions("bucket", "salt", "h", *order) \
        .mapInArrow(_owner, f"{kinds}, chain int, first boolean, rep binary")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 max_depth: int = MAX_DEPTH, capacity: int | None = None) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, sha256, h, chain)``, one row per input row.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  Of equal texts the row with the largest ``doc_id`` is kept (null
    ids are least); of rows that repeat both id and text exactly one is.  Other
    columns are ignored; an empty table gives no rows.  ``sha256`` is the binary
    digest of the normalised text in UTF-8.
    """
    spark = docs.sparkSession
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), norm.cast("binary").alias("text")) \
        .withColumn("h", F.xxhash64("text"))

    def histogram(depth: int) -> tuple[Column, dict[int, int]]:
        leaf = F.shiftrightunsigned("h", 64 - depth).cast("int")
        held = rows.groupBy(leaf.alias("leaf")).agg(F.sum(F.octet_length("text") + 64).alias("n"))
        return leaf, {r[0]: r[1] for r in held.collect()}

    leaf, sizes = histogram(max_depth)
    if capacity is None:
        depth = depth_for(sum(sizes.values()), max_depth)
        if depth > max_depth:
            max_depth, (leaf, sizes) = depth, histogram(depth)
        capacity = min(MAX_BUCKET_BYTES, max(MIN_BUCKET_BYTES, sum(sizes.values()) // (2 * shuffle_partitions(spark))))
        # Buckets of a full directory grow with the table, so that only a repeated text makes one overflow.
        capacity = max(capacity, 2 * sum(sizes.values()) >> max_depth)
    buckets = directory(sizes, capacity, max_depth)
    leaves = [(leaf_, k, owners) for k, ((at, local, owners)) in enumerate(buckets)
              for leaf_ in range(at, at + (1 << (max_depth - local))) if leaf_ in sizes]
    entries = spark.createDataFrame(leaves, "leaf int, bucket int, owners int")
    placed = rows.withColumn("leaf", leaf).join(F.broadcast(entries), "leaf").drop("leaf") \
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("owners")).cast("int")) \
        .withColumn("sha256", F.unhex(F.sha2("text", 256)))
    index = written(_owned(placed, [F.col("doc_id").desc_nulls_last()]), "exact-index")

    # Overflowed buckets: compare the owners' representatives, one task per pseudo-key's bucket.
    over = index.where("owners > 1 and first").select("bucket", F.lit(0).alias("salt"), "owners", "h",
                                                      F.col("salt").alias("own_salt"), F.col("chain").alias("own_chain"),
                                                      F.col("rep").alias("text"))
    merged = _owned(over, []).select("bucket", "h", F.col("own_salt").alias("salt"),
                                     F.col("own_chain").alias("chain"), F.col("chain").alias("whole"))
    named = index.drop("rep").join(merged, ["bucket", "h", "salt", "chain"], "left") \
        .withColumn("chain", F.coalesce("whole", "chain"))
    # Written, so that the join below reads plain exchanges and a hot group's rows can be split.
    groups = written(named.groupBy("h", "chain").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
                     "exact-groups")
    return named.join(groups, ["h", "chain"]).select(
        "doc_id", "keep_id", "group_size",
        (F.col("first") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "sha256", "h", "chain")
