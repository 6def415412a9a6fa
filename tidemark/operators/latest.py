"""First, latest and n-th row per group, and values as of a point in time.

All of these filter on a row number, so Spark keeps only the wanted rows of each
group in every map task before the shuffle: a huge group costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import moment
from tidemark.operators.ordered import OrderedGroups, position_in


# Up to this many dates plain comparisons in generated code beat a binary search.
_COMPARED_ONE_BY_ONE = 64


def _desc(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in order]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each group; null keys form one group."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` of each group; nulls count as greatest."""
    return first_per_key(df, keys, _desc(order))


def nth_occurrence(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, max_rows: int | None = None
) -> DataFrame:
    """The n-th row of each group in ascending order; groups with fewer rows vanish."""
    return first_occurrences(df, keys, order, n, "_rn", max_rows).filter(f"_rn = {n}").drop("_rn")


def first_occurrences(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, name: str, max_rows: int | None = None
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1 in ``name``.

    Up to the limit of Spark's window group limit each map task keeps ``n`` rows per group;
    beyond it a large group is numbered piece by piece. ``order`` must then be total.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= limit:
        window = Window.partitionBy(*keys).orderBy(*order)
        numbered = df.withColumn(name, F.row_number().over(window))
    else:
        groups = OrderedGroups(df, keys, order, max_rows)
        numbered = groups.done(groups.add(groups.df, **{name: groups.number()}))
    return numbered.filter(F.col(name) <= n)


def latest_with_parent(
    facts: DataFrame,
    parents: DataFrame,
    on: str,
    entity: str,
    order: Sequence[str],
) -> DataFrame:
    """Latest fact per entity, where the entity name is a column of the parent.

    The facts are first cut down to one row per ``on``; the join and the second
    step then see only those, so neither is hurt by a parent with many facts.
    """
    per_parent = latest_per_key(facts, [on], order)
    return latest_per_key(per_parent.join(parents, on, "left"), [entity], order)


def as_of(df: DataFrame, keys: Sequence[str], order: Sequence[str], when: datetime) -> DataFrame:
    """Latest row per group at or before ``when``; ``order[0]`` is the time column."""
    return latest_per_key(df.filter(F.col(order[0]) <= moment(when)), keys, order)


def as_of_dates(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    dates: Sequence[datetime],
    name: str = "as_of",
) -> DataFrame:
    """Latest row per group at or before each of several dates.

    Each row goes to the first date that can see it, one row per (group, date)
    survives, and that row is repeated for the dates up to its successor. The
    facts are never paired with all dates.
    """
    if not dates:
        raise ValueError("dates must not be empty")
    dates = sorted(set(dates))
    time = F.col(order[0])
    dtype = df.schema[order[0]].dataType
    literals = [(moment(d) if isinstance(d, datetime) else F.lit(d)).cast(dtype) for d in dates]
    bounds = F.array(*literals)
    # index of the first date >= time: the number of dates strictly before it
    if len(dates) <= _COMPARED_ONE_BY_ONE:
        below = reduce(lambda a, b: a + b, [(time > d).cast("int") for d in literals])
    else:
        strictly = F.array(*[F.struct(d.alias("d"), F.lit(1).alias("s")) for d in literals])
        below = position_in(strictly, len(dates), F.struct(time.alias("d"), F.lit(0).alias("s")))
    seen = df.filter(time <= literals[-1]).withColumn("_slot", below)
    kept = latest_per_key(seen, [*keys, "_slot"], order)
    # at most len(dates) rows per group from here on
    following = F.lead("_slot").over(Window.partitionBy(*keys).orderBy("_slot"))
    until = F.coalesce(following, F.lit(len(dates))) - 1
    spread = kept.withColumn("_until", until)
    return spread.withColumn(
        name, F.explode(F.slice(bounds, F.col("_slot") + 1, F.col("_until") - F.col("_slot") + 1))
    ).drop("_slot", "_until")


def as_of_join(
    requests: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    request_order: Sequence[str],
    fact_order: Sequence[str],
    fact_columns: Sequence[str],
    max_rows: int | None = None,
) -> DataFrame:
    """Each request row with the latest fact of its group at or before its time.

    Both sides are merged into one ordered sequence and the last fact seen is
    carried forward: one shuffle, no inequality join. Requests keep all their
    columns; ``fact_columns`` are null where there is no earlier fact.
    ``*_order`` are (time, tie-break ...) columns of equal types and number.
    """
    order = [f"_o{i}" for i in range(len(fact_order))]
    fact = F.struct(*[F.col(c).alias(c) for c in fact_columns]).alias("_fact")
    left = requests.select(
        *[F.col(k) for k in keys],
        F.struct("*").alias("_request"),
        *[F.col(c).alias(o) for c, o in zip(request_order, order)],
        F.lit(1).alias("_side"),
    )
    right = facts.select(
        *[F.col(k) for k in keys],
        fact,
        *[F.col(c).alias(o) for c, o in zip(fact_order, order)],
        F.lit(0).alias("_side"),
    )
    merged = left.unionByName(right, allowMissingColumns=True)
    # at equal times the facts come first
    groups = OrderedGroups(merged, keys, [order[0], "_side", *order[1:]], max_rows)
    carried = groups.add(groups.df, _known=groups.last_known(F.col("_fact")))
    return carried.filter("_side = 1").select(
        "_request.*", *[F.col(f"_known.{c}").alias(c) for c in fact_columns]
    )
