"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints (64 bits) come from hashed word shingles.  Two of them link when
they differ in at most ``max_bits`` bits.  The index is a tree whose nodes
factor out the bits that all fingerprints below share (a masked pattern):

* The top nodes fix a run of bits.  The bits are cut into ``max_bits + 1``
  runs, so by the pigeonhole rule a linked pair agrees on one whole run and
  meets below at least one top node.  A top node with more than ``cap``
  members is cut again by its free bits in the same way; a few levels leave
  so few free bits that no node can exceed the cap.
* Below a top node the members are sorted by Gray rank, so neighbours differ
  in few bits, and every ``FANOUT`` neighbours get a parent that keeps the
  bits they share.  A search adds up, from node to node, the differences in
  the bits that are new at each node, and drops the whole group once the sum
  exceeds ``max_bits``.

A task emits a spanning forest of the links it finds, never all pairs, and
the classes are the connected components over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posturn.llm.common import written
from posturn.llm.components import components

SEED = 42
FANOUT = 8
GROUP_CAP = 2048
_QUERY_BLOCK = 512
_HASH_BLOCK = 1 << 18


def fingerprint(data: bytes, width: int) -> int:
    """The signed 64-bit fingerprint of UTF-8 bytes: majority bits of the shingles' XXH64."""
    words = data.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) < width:
        hashes = [xxhash.xxh64_intdigest(text, SEED)]
        return int(np.array(hashes, np.uint64).view(np.int64)[0])
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    ends = ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _HASH_BLOCK):
        block = np.array([digest(text[s:e], SEED) for s, e in
                          zip(starts[at:at + _HASH_BLOCK], ends[at:at + _HASH_BLOCK])], np.uint64)
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` of every row; a null or wordless text has fingerprint zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t or b"", width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, fp long")


def _children(mask: int, parts: int) -> list[int]:
    """``mask`` extended by each of ``parts`` runs of its free bits (signed longs)."""
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    out = []
    for run in np.array_split(free, parts):
        child = mask | sum(1 << int(b) for b in run)
        out.append(child)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code word in the reflected Gray sequence."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


def _tree(offsets: np.ndarray, prints: np.ndarray) -> list[dict]:
    """Levels from leaves to roots; one root per group of ``prints[offsets[g]:offsets[g + 1]]``."""
    group = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    levels = [{"and": prints, "or": prints, "group": group, "last": np.arange(len(prints))}]
    while len(levels[-1]["group"]) > len(offsets) - 1:
        below = levels[-1]
        first = np.flatnonzero(np.r_[True, np.diff(below["group"]) != 0])
        place = np.arange(len(below["group"])) - np.repeat(first, np.diff(np.r_[first, len(below["group"])]))
        start = np.flatnonzero(place % FANOUT == 0)
        end = np.r_[start[1:], len(place)]
        levels.append({"and": np.bitwise_and.reduceat(below["and"], start),
                       "or": np.bitwise_or.reduceat(below["or"], start),
                       "group": below["group"][start], "last": below["last"][end - 1],
                       "start": start, "end": end})
    for level in levels:
        level["mask"] = ~(level["and"] ^ level["or"])
    return levels


def _root(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def linked_groups(offsets: np.ndarray, prints: np.ndarray, max_bits: int) -> np.ndarray:
    """For each fingerprint the least position it is linked with, directly or through others, in its group.

    ``prints`` is sorted by Gray rank within each group.
    """
    levels = _tree(offsets, prints)
    top = len(levels) - 1
    parent = np.arange(len(prints))
    leaf_group = levels[0]["group"]
    for at in range(0, len(prints), _QUERY_BLOCK):
        query = np.arange(at, min(at + _QUERY_BLOCK, len(prints)))
        node = leaf_group[query]  # at the top there is one node per group
        covered = np.zeros(len(query), np.uint64)
        acc = np.zeros(len(query), np.int64)
        for depth in range(top, -1, -1):
            level = levels[depth]
            new = level["mask"][node] & ~covered
            acc = acc + np.bitwise_count((prints[query] ^ level["and"][node]) & new)
            keep = (acc <= max_bits) & (level["last"][node] > query)
            query, node, acc = query[keep], node[keep], acc[keep]
            covered = level["mask"][node]
            if depth and len(node):
                start, fan = level["start"][node], level["end"][node] - level["start"][node]
                query, acc, covered = np.repeat(query, fan), np.repeat(acc, fan), np.repeat(covered, fan)
                node = np.repeat(start, fan) + np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan)
        while len(query):
            a, b = parent[query], parent[node]
            apart = a != b
            if not apart.any():
                break
            np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            parent = _root(parent)
    return parent


def _link(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column(0)
            prints = members.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = np.diff(members.offsets.to_numpy())
            group = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((gray_rank(prints), group))
            prints = prints[order]
            offsets = np.r_[0, np.cumsum(sizes)]
            parent = linked_groups(offsets, prints, max_bits)
            held = np.flatnonzero(parent != np.arange(len(parent)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[held].view(np.int64)), pa.array(prints[parent[held]].view(np.int64))], ["a", "b"])
    return run


def link_forest(prints: DataFrame, max_bits: int, cap: int = GROUP_CAP) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints within ``max_bits`` of each other.

    ``prints`` has one long column ``fp`` without repeats, and is cheap to read
    again (a written table).
    """
    parts = max_bits + 1
    cap = max(cap, 1 << parts)  # so that a node with too many members always has a free bit for each run
    masks = _children(0, parts)
    rows = prints.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask")) \
        .withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    edges = None
    while True:
        counts = rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        small = rows.join(counts.where(F.col("n") <= cap).drop("n"), ["mask", "key"])
        found = small.groupBy("mask", "key").agg(F.collect_list("fp").alias("members")).select("members") \
            .mapInArrow(_link(max_bits), "a long, b long")
        edges = found if edges is None else edges.unionByName(found)
        large = counts.where(F.col("n") > cap).drop("n")
        if large.isEmpty():
            return edges
        # A node with too many members: cut its free bits again. With at most
        # log2(cap) free bits left no node can be too large, so this ends.
        below = {m: _children(m, parts) for m in masks}
        masks = [c for m in masks for c in below[m]]
        finer = F.create_map(*[x for m, cs in below.items()
                               for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(c)) for c in cs]))])
        rows = rows.join(large, ["mask", "key"]).select("fp", F.explode(finer[F.col("mask")]).alias("mask")) \
            .withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        rows = written(rows, "simhash-nodes")


def simhash_groups(docs: DataFrame, width: int = 3, max_bits: int = 2, cap: int = GROUP_CAP,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row.

    ``component_id`` is the least ``doc_id`` reachable over links of at most
    ``max_bits`` differing bits, the row's own included.  Repeated rows come
    back repeated.  A null text counts as empty (fingerprint zero, linked like
    any other); a null id stays null and never names a class unless the class
    has no other id.  Other columns of ``docs`` are ignored; an empty table
    gives no rows.
    """
    marked = written(fingerprints(docs, width, id_col, text_col), "simhash-prints")
    least = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    joined = components(link_forest(least.select("fp"), max_bits, cap))
    # Fingerprints without a link are their own class.
    named = least.join(joined.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = named.join(ids, "component").select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")
