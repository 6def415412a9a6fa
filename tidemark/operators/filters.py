"""Optional filters combined with AND, and the source's sort conventions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import contains_ignoring_case, moment


def all_given(df: DataFrame, predicates: Iterable[Column | None]) -> DataFrame:
    """Rows that meet every predicate that is not None."""
    given = [p for p in predicates if p is not None]
    return df.filter(reduce(lambda a, b: a & b, given)) if given else df


def equals(column: str, value: object | None) -> Column | None:
    return None if value is None else F.col(column) == F.lit(value)


def equals_upper(column: str, value: str | None) -> Column | None:
    """Exact match with the upper-cased argument."""
    return None if value is None else F.col(column) == F.lit(value.upper())


def at_least(column: str, value: datetime | None) -> Column | None:
    return None if value is None else F.col(column) >= moment(value)


def at_most(column: str, value: datetime | None) -> Column | None:
    return None if value is None else F.col(column) <= moment(value)


def contains(column: str, text: str | None) -> Column | None:
    return None if text is None else contains_ignoring_case(F.col(column), text)


def collated(column: Column | str, collation: str = "UNICODE_CI") -> Column:
    """A text that groups and sorts by a collation instead of by bytes.

    PostgreSQL and others sort by a locale: "debt" before "EBITDA", where bytes say the
    opposite. The result goes into ``ascending``, ``groupBy`` or a join like any column.
    """
    return F.collate(F.col(column) if isinstance(column, str) else column, collation)


def ascending(*columns: str) -> list[Column]:
    """Nulls last, as the source database sorts."""
    return [F.col(c).asc_nulls_last() for c in columns]


def descending(*columns: str) -> list[Column]:
    """Nulls first, as the source database sorts."""
    return [F.col(c).desc_nulls_first() for c in columns]
