"""Distinct counts from sketches that loads write and reads merge, without the rows."""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_SIZE = 14  # a sketch has 2^14 registers, 12 kB at most


def relative_error(lg_size: int = LG_SIZE, deviations: float = 3) -> float:
    """The error of a merged estimate that ``deviations`` standard errors allow."""
    return deviations * 1.04 / sqrt(1 << lg_size)


def distinct_sketches(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], lg_size: int = LG_SIZE
) -> DataFrame:
    """Per ``by`` the number of rows and for each column a sketch of its distinct values.

    Null is no value. ``by`` is usually the load, so a load adds its own rows and changes
    none. Partial sketches are merged map-side; a group costs its sketches, not its rows.
    """
    sketches = [
        F.hll_sketch_agg(_hashable(df, c), lg_size).alias(f"{c}_sketch") for c in columns
    ]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *sketches)


def _hashable(df: DataFrame, column: str) -> Column:
    """Sketches take whole numbers, texts and bytes; other types go in as text."""
    kind = df.schema[column].dataType.simpleString()
    col = F.col(column)
    return col if kind in ("int", "bigint", "string", "binary") else col.cast("string")


def merged_counts(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per ``by`` the rows of all sketches together and the estimated distinct values."""
    estimates = [
        F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"{c}_distinct") for c in columns
    ]
    return sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), *estimates)
