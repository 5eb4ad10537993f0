"""Lookup documents: whole JSON documents (arrays of objects or of strings).

A lookup list is stored as one or more JSON documents, each a top-level
array.  ``multiLine`` reading parses a document per file, so a catalogue is
split into several documents of bounded size and read in parallel.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_DOCUMENT = 10_000


def write_json_documents(df: DataFrame, path: str, rows_per_document: int = ROWS_PER_DOCUMENT) -> str:
    """Write ``df`` as JSON array documents of about ``rows_per_document`` rows each."""
    n_docs = max(1, math.ceil(df.count() / rows_per_document))
    # The row id makes the bucket uniform even when one row value repeats a
    # third of the table; it is stable when a partition is recomputed.
    bucket = F.pmod(F.xxhash64(*df.columns, F.monotonically_increasing_id()), F.lit(n_docs))
    docs = (df.withColumn("_doc", bucket)
              .groupBy("_doc").agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value")))
    # One folder per document: every file holds exactly one JSON document.
    docs.write.mode("overwrite").partitionBy("_doc").text(path)
    return path


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all array-of-object documents under ``path`` (declared schema)."""
    rows = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return rows.select(*schema.fieldNames())


def read_string_list(spark: SparkSession, path: str) -> DataFrame:
    """Values of array-of-string documents under ``path`` (one row per value)."""
    docs = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return docs.select(F.explode(F.from_json("value", "array<string>")).alias("value"))
