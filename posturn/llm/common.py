"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posturn.session import configure, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table; read by Spark alone, so any store works."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


#: Rows of whole texts that a Python worker holds at a time.
BATCH_ROWS = "1000"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, package and checkpoint folder, and batches fit for whole texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    scratch_path(spark)
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` once to the shared folder and read it back.

    The folder is the one of ``spark.checkpoint.dir``; every executor sees it,
    so a lost executor re-reads the table instead of recomputing its input.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
