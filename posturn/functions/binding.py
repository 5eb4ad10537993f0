"""Columns that are computed once, whatever is built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns`` (replacing those of the same names), bound like a ``let``.

    Catalyst inlines a projected expression into every filter and projection
    above it.  For a validation of hundreds of terms that means to evaluate it
    again per use.  Here the columns are the only element of an
    array that is expanded in place: a narrow step with generated code, below
    which no predicate on its output is pushed and into which no projection
    is collapsed.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
