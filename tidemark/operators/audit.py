"""Table constraints as queries, since plain Parquet enforces none."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows; null refers to nothing.

    Counting per key first keeps a key with very many rows out of the join.
    """
    counted = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(child_key).agg(F.count(F.lit(1)).alias("n"))
    )
    keys = parent.select(F.col(parent_key).alias("_p"))
    return counted.join(keys, F.col(child_key) == F.col("_p"), "left_anti")


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """How many rows meet each condition, all in one pass."""
    return df.agg(*[F.count_if(c).cast("long").alias(n) for n, c in conditions.items()])


def total_and_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_distinct(column).alias("distinct_values")
    )


def reconcile_counts(
    parents: DataFrame, children: DataFrame, on: str, declared: str
) -> DataFrame:
    """Parents whose declared number of children differs from the actual number.

    The children are counted before the join. A null declaration is not compared.
    """
    actual = children.groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    return (
        parents.select(on, declared)
        .join(actual, on, "left")
        .withColumn("actual", F.coalesce("_n", F.lit(0)))
        .filter(F.col(declared).isNotNull() & (F.col(declared) != F.col("actual")))
        .select(on, declared, "actual")
    )


@dataclass(frozen=True)
class Constraints:
    """Constraints of one table. A CHECK holds unless it is false, as in SQL."""

    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    checks: Mapping[str, Column] = field(default_factory=dict)
    # (column, parent table, parent column)
    foreign_keys: Sequence[tuple[str, str, str]] = ()


def row_checks(name: str, df: DataFrame, c: Constraints) -> list[DataFrame]:
    """What single rows violate, counted in one pass: one row per constraint, or no table."""
    conditions = {f"NOT NULL {col}": F.col(col).isNull() for col in c.not_null}
    conditions |= {f"CHECK {label}": ~check for label, check in c.checks.items()}
    if not conditions:
        return []
    counts = conditional_counts(df, {f"c{i}": cond for i, cond in enumerate(conditions.values())})
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias("constraint"), F.col(f"c{i}").alias("violations"))
            for i, label in enumerate(conditions)
        ]
    )
    return [counts.select(F.lit(name).alias("table_name"), F.inline(pairs))]


def constraint_audit(
    tables: Mapping[str, DataFrame], constraints: Mapping[str, Constraints]
) -> DataFrame:
    """One row per constraint: table_name, constraint, violations.

    A unique key counts the surplus rows, a foreign key the rows without parent.
    Rows with a null in a unique key are not compared, as in SQL.
    """
    parts: list[DataFrame] = []
    for name, c in constraints.items():
        df = tables[name]
        parts += row_checks(name, df, c)
        for key in c.unique:
            surplus = duplicate_keys(df.dropna("any", subset=list(key)), key).agg(
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")
            )
            parts.append(
                surplus.select(
                    F.lit(name).alias("table_name"),
                    F.lit(f"UNIQUE {', '.join(key)}").alias("constraint"), "violations",
                )
            )
        for column, parent, parent_key in c.foreign_keys:
            lost = orphans(df, tables[parent], column, parent_key).agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("violations")
            )
            parts.append(
                lost.select(
                    F.lit(name).alias("table_name"),
                    F.lit(f"FOREIGN KEY {column} -> {parent}.{parent_key}").alias("constraint"),
                    "violations",
                )
            )
    return reduce(DataFrame.unionByName, parts)
