"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the binary digits
of n (long documents start with as many pieces of the largest length as fit).
Each piece is a sequence of its own in the bucket of its length, so no sequence
crosses documents and none needs padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posturn.llm.tokens import TOKENIZER, encoder

MAX_LENGTH = 2048
END_ID = 1


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Powers of two, descending, that add up to ``n``; none above ``longest`` (itself one)."""
    full, rest = divmod(n, longest)
    return [longest] * full + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, longest: int = MAX_LENGTH,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, length, ids, doc_tokens, sequence_id, offset, bucket)`` of every piece.

    ``ids`` are little-endian unsigned 32-bit token ids.  A null or empty text
    is the end id alone.  ``sequence_id`` is unique and holds one piece at
    offset 0; ``bucket`` is the power of its length.  Repeated rows are packed
    repeatedly, null ids are kept, other columns are ignored.  Nothing is
    shuffled: buckets can be written apart with ``partitionBy("bucket")``.
    """
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    kind = docs.schema[id_col].dataType
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            rows, starts, lengths, ids, totals = [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                tokens = enc.encode(text or "") + end
                at = 0
                for n in piece_lengths(len(tokens) // 4, longest):
                    rows.append(row)
                    starts.append(at)
                    lengths.append(n)
                    ids.append(tokens[4 * at:4 * (at + n)])
                    totals.append(len(tokens) // 4)
                    at += n
            for lo in range(0, len(rows), 20_000):
                part = slice(lo, lo + 20_000)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows[part], pa.int64())), pa.array(starts[part], pa.int64()),
                     pa.array(lengths[part], pa.int64()), pa.array(ids[part], pa.binary()),
                     pa.array(totals[part], pa.int64())],
                    ["doc_id", "start", "length", "ids", "doc_tokens"])

    pieces = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind.simpleString()}, start long, length long, ids binary, doc_tokens long")
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()) \
        .withColumn("offset", F.lit(0).cast("long")) \
        .withColumn("bucket", F.log2("length").cast("int"))
