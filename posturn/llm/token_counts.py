"""Token counts by separator scan over flat, unindexed token files.

A flat token stream is document after document, each closed by the
end-of-document id, without any index.  It is stored as numbered blocks of
``BLOCK_TOKENS`` ids, so blocks cut through documents.  Tasks search whole
blocks for the separator with one vectorised comparison and report, per block,
how many separators it has and the ids before the first and after the last one.
An exclusive prefix scan over the blocks of a stream (a window over these few
numbers) gives each block its first document's ordinal and the ids carried
into it, which completes the documents that cross blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from posturn.llm.tokens import TOKENIZER, encoder

END_OF_DOCUMENT = 50256
#: The largest 16-bit id: outside the vocabulary, so any text can be written, one with ``<|endoftext|>`` in it too.
OUTSIDE = 0xFFFF
BLOCK_TOKENS = 1 << 18

BLOCKS = "stream long, block long, tokens binary"


def write_streams(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_OF_DOCUMENT,
                  block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenize whole texts into flat streams, one per input partition.

    ``path/blocks`` has ``(stream, block, tokens)``, tokens as little-endian
    unsigned 16-bit ids when all ids fit and 32-bit ids otherwise;
    ``path/order`` has ``(stream, ordinal, doc_id)``, the order in which the
    documents were written.  A null or empty text is its end id alone.  An end
    id inside a text would split it, so the id must be one that texts never
    encode to; one that occurs raises an error.
    """
    kind = docs.schema[id_col].dataType
    wide = end_id > 0xFFFF
    dtype = np.dtype("<u4" if wide else "<u2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        held: list[np.ndarray] = []
        size = block = ordinal = 0
        stream = None
        end = np.array([end_id], dtype)

        def flush(all_of_it: bool):
            nonlocal held, size, block
            joined = np.concatenate(held) if held else np.zeros(0, dtype)
            at = 0
            while len(joined) - at >= block_tokens or (all_of_it and at < len(joined)):
                yield block, joined[at:at + block_tokens].tobytes()
                at += block_tokens
                block += 1
            held = [joined[at:]]
            size = len(held[0])

        def rows(blocks, ids):
            n, m = len(blocks), len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([stream] * (n + m), pa.int64()), pa.array([b for b, _ in blocks] + [None] * m, pa.int64()),
                 pa.array([t for _, t in blocks] + [None] * m, pa.binary()),
                 pa.array([None] * n + list(range(ordinal - m, ordinal)), pa.int64()),
                 pa.concat_arrays([pa.nulls(n, ids.type), ids])], ["stream", "block", "tokens", "ordinal", "doc_id"])

        for batch in batches:
            if batch.num_rows:
                stream = batch.column(0)[0].as_py()
            blocks = []
            for text in batch.column(2).to_pylist():
                ids = np.frombuffer(enc.encode(text or ""), "<u4")
                if (ids == end_id).any():
                    raise ValueError(f"a text encodes to the end-of-document id {end_id}")
                if not wide and len(ids) and ids.max() > 0xFFFF:
                    raise ValueError("ids above 65,535 need an end id above it, so that streams are 32 bits wide")
                held += [ids.astype(dtype), end]
                size += len(ids) + 1
                ordinal += 1
                if size >= 4 * block_tokens:
                    blocks += flush(False)
            yield rows(blocks, batch.column(1))
        rest = list(flush(True))
        if rest:
            yield rows(rest, pa.nulls(0, kind_arrow))

    kind_arrow = to_arrow_type(kind)
    source = docs.select(F.spark_partition_id().cast("long").alias("stream"), F.col(id_col).alias("doc_id"),
                         F.col(text_col).alias("text"))
    both = source.mapInArrow(run, f"{BLOCKS}, ordinal long, doc_id {kind.simpleString()}") \
        .withColumn("kind", F.when(F.col("tokens").isNotNull(), "blocks").otherwise("order"))
    both.write.partitionBy("kind").option("compression", "zstd").parquet(path)


def _read(spark: SparkSession, path: str, kind: str, id_type: str = "bigint") -> DataFrame:
    schema = f"{BLOCKS}, ordinal long, doc_id {id_type}, kind string"
    return spark.read.schema(schema).parquet(path).where(F.col("kind") == kind)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """``(stream, block, tokens)`` of a folder of streams."""
    return _read(spark, path, "blocks").select("stream", "block", "tokens")


def scan_separators(blocks: DataFrame, end_id: int = END_OF_DOCUMENT, width: int | None = None) -> DataFrame:
    """``(stream, ordinal, n_tokens)`` of every document, its end id not counted.

    ``blocks`` has ``(stream, block, tokens)`` as in ``write_streams``; block
    numbers are ordered but need not be dense, empty blocks are allowed, null
    tokens count as empty.  Ids after a stream's last separator are a document
    that was never closed; it is counted too.  Repeated block numbers are an
    error of the stream and counted in any order.
    """
    dtype = np.dtype(f"<u{width or (4 if end_id > 0xFFFF else 2)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, inner = [], []
            for data in batch.column(2).to_pylist():
                tokens = np.frombuffer(data or b"", dtype)
                at = np.flatnonzero(tokens == end_id)
                # Ids before each separator, and after the last one.
                lengths = np.diff(np.r_[-1, at]) - 1
                inner.append(lengths)
                ends.append(len(tokens) - (at[-1] + 1 if len(at) else 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(inner, pa.list_(pa.int64())),
                                              pa.array(ends, pa.int64())], ["stream", "block", "closed", "open"])

    found = blocks.select("stream", "block", "tokens").mapInArrow(
        run, "stream long, block long, closed array<long>, open long")
    before = Window.partitionBy("stream").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("stream").orderBy("block")
    # The scan: documents closed before a block, and ids carried into it since the last separator.
    n = F.size("closed")
    scanned = found.withColumn("first", F.coalesce(F.sum(n).over(before), F.lit(0))) \
        .withColumn("total", F.coalesce(F.sum("open").over(before), F.lit(0))) \
        .withColumn("reset", F.coalesce(
            F.max(F.when(n > 0, F.struct("block", "total"))).over(before)["total"], F.lit(0))) \
        .withColumn("carried", F.col("total") - F.col("reset")) \
        .withColumn("last", F.lead("block").over(here).isNull())
    closed = scanned.select("stream", "first", "carried", F.posexplode("closed").alias("place", "length")).select(
        "stream", (F.col("first") + F.col("place")).alias("ordinal"),
        (F.col("length") + F.when(F.col("place") == 0, F.col("carried")).otherwise(0)).alias("n_tokens"))
    tail = scanned.where("last").select("stream", (F.col("first") + n).alias("ordinal"),
                                        (F.col("open") + F.when(n > 0, 0).otherwise(F.col("carried"))).alias("n_tokens"))
    return closed.unionByName(tail.where("n_tokens > 0"))


def token_counts(spark: SparkSession, path: str, end_id: int = END_OF_DOCUMENT, id_type: str = "bigint") -> DataFrame:
    """``(doc_id, n_tokens)`` of the documents of a folder written by ``write_streams``; empty if none were."""
    order = _read(spark, path, "order", id_type).select("stream", "ordinal", "doc_id")
    return order.join(scan_separators(read_blocks(spark, path), end_id), ["stream", "ordinal"]) \
        .select("doc_id", "n_tokens")
