"""Lookups with a default, and totals over a left join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame, table: DataFrame, on: Sequence[str], defaults: Mapping[str, Column]
) -> DataFrame:
    """``df`` with the columns of ``table`` (unique per ``on``), defaults where unknown."""
    joined = df.join(table.select(*on, *defaults), list(on), "left")
    return joined.withColumns({n: F.coalesce(F.col(n), d) for n, d in defaults.items()})


def left_join_totals(
    parents: DataFrame,
    children: DataFrame,
    on: str,
    child_column: str,
    parent_measures: Sequence[Column],
    total: str,
    distinct: str,
) -> DataFrame:
    """One row: ``total`` rows of ``parents LEFT JOIN children``, ``distinct`` values of
    ``child_column`` in them, and ``parent_measures``.

    The measures must be insensitive to repeated rows, as distinct counts, minima and maxima
    are; they are taken from the parents alone. Parents and children are counted per key
    before the join, so only two counts per key meet. Distinct values of children come from
    the pairs (key, value) that have a parent.
    """
    pairs = children.groupBy(on, child_column).agg(F.count(F.lit(1)).alias("_n"))
    per_key = pairs.groupBy(on).agg(F.sum("_n").alias("_n"))
    per_parent = parents.groupBy(on).agg(F.count(F.lit(1)).alias("_p"))
    rows = F.sum(F.col("_p") * F.coalesce("_n", F.lit(1)))
    counted = per_parent.join(per_key, on, "left").agg(F.coalesce(rows, F.lit(0)).alias(total))
    matched = pairs.join(per_parent.select(on), on, "left_semi")
    values = matched.agg(F.count_distinct(child_column).alias(distinct))
    # three tables of one row each, brought together by a constant key
    one = F.lit(0).alias("_one")
    tables = [counted, values, parents.agg(*parent_measures)]
    first, *rest = [t.select("*", one) for t in tables]
    for table in rest:
        first = first.join(table, "_one")
    return first.drop("_one")
