"""Columns to rows, maps to rows, children under parents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import OrderedGroups

PAGE_ROWS = 10_000


def numbered_columns_to_rows(
    df: DataFrame, keep: Sequence[str], slots: Sequence[Sequence[Column]], names: Sequence[str]
) -> DataFrame:
    """One row per slot whose first column is set, e.g. (risk_1, weight_1), (risk_2, weight_2)."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(slot, names)]) for slot in slots]
    rows = df.select(*keep, F.inline(F.array(*structs)))
    return rows.filter(F.coalesce(F.col(names[0]).cast("string"), F.lit("")) != "")


def nested_map_to_rows(
    df: DataFrame, keep: Sequence[str], column: Column, outer: str, inner: str, value: str
) -> DataFrame:
    """One row per entry of a map of maps; null values are kept."""
    return df.select(*keep, F.explode(column).alias(outer, "_inner")).select(
        *keep, outer, F.explode("_inner").alias(inner, value)
    )


def unpivot(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per key and value column."""
    return df.unpivot(list(keys), list(values), name, value)


def nest_children(
    parents: DataFrame,
    children: DataFrame,
    on: str,
    order: Sequence[str],
    fields: Sequence[str],
    name: str,
    page_rows: int = PAGE_ROWS,
    max_rows: int | None = None,
) -> DataFrame:
    """Parents with their children as a sorted list, an empty list where there are none.

    A list holds at most ``page_rows`` children. A parent with more gets several
    rows, ``page`` 0, 1, ...: no list grows with the data and no child is lost.
    """
    groups = OrderedGroups(
        children.select(*dict.fromkeys([on, *order, *fields])), [on], order, max_rows
    )
    numbered = groups.done(groups.add(groups.df, _no=groups.number()))
    # A page follows from the row's number alone, so it is the same however the rows were cut.
    paged = numbered.withColumn("page", F.floor((F.col("_no") - 1) / page_rows))
    child = F.struct(F.col("_no"), *[F.col(f).alias(f) for f in fields])
    lists = paged.groupBy(on, "page").agg(F.array_sort(F.collect_list(child)).alias(name))
    stripped = F.transform(name, lambda c: F.struct(*[c[f].alias(f) for f in fields]))
    lists = lists.select(on, "page", stripped.alias(name))
    empty = F.array().cast(lists.schema[name].dataType)
    return (
        parents.join(lists, on, "left")
        .withColumn(name, F.coalesce(name, empty))
        .withColumn("page", F.coalesce("page", F.lit(0)).cast("long"))
    )
