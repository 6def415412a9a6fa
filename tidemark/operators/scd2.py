"""Type-2 history: a new version whenever a tracked attribute changes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import moment, round4
from tidemark.operators import dedup
from tidemark.operators.ordered import OrderedGroups, in_ranges


def _changed(groups: OrderedGroups, df: DataFrame, tracked: Sequence[str]) -> DataFrame:
    """Adds ``_changed``: the row's tracked values differ from the previous row's.

    Null equals null. Comparing with the previous row is the same as comparing
    with the current version, because rows that start no version have its values.
    """
    values = F.struct(*tracked)
    df = groups.add(df, _prev=groups.lag(values))
    same = F.col("_prev").isNotNull() & F.col("_prev.v").eqNullSafe(values)
    return df.withColumn("_changed", ~same).drop("_prev")


def versions(
    records: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    tracked: Sequence[str],
    keep: Sequence[str] = (),
    max_rows: int | None = None,
) -> DataFrame:
    """The versions of each entity.

    ``order[0]`` is the time a record takes effect, the rest breaks ties. Result:
    entity, tracked and ``keep`` columns of the version's first record, version_no,
    valid_from, valid_to (null while current) and is_current.
    """
    columns = list(dict.fromkeys([*entity, *order, *tracked, *keep]))
    groups = OrderedGroups(records.select(*columns), entity, order, max_rows)
    started = _changed(groups, groups.df, tracked).filter("_changed").drop("_changed")
    closed = groups.add(
        started, version_no=groups.number(), _next=groups.lead(F.col(order[0]))
    )
    return closed.select(
        *entity, *[c for c in tracked if c not in entity],
        *[c for c in keep if c not in entity and c not in tracked],
        "version_no",
        F.col(order[0]).alias("valid_from"),
        F.col("_next.v").alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def assign_versions(
    records: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    tracked: Sequence[str],
    version_value: Column,
    name: str,
    max_rows: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Every record with ``version_value`` of the record that started its version.

    Adds also ``starts_version``. This is how facts learn the key of their version
    without a join back to the dimension.
    """
    groups = OrderedGroups(records, entity, order, max_rows, at_most)
    marked = _changed(groups, groups.df, tracked)
    starting = F.when(F.col("_changed"), version_value)
    carried = groups.add(marked, **{name: groups.last_known(starting)})
    return groups.done(carried.withColumnRenamed("_changed", "starts_version"))


def continue_versions(
    incoming: DataFrame,
    open_versions: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    tracked: Sequence[str],
    incoming_key: str,
    version_key: str,
    max_rows: int | None = None,
    at_most: int | None = None,
    entities: DataFrame | None = None,
) -> DataFrame:
    """New records with the key of their version, given the versions open so far.

    An open version stands first in its entity's sequence; a record that repeats
    its tracked values keeps ``version_key``, any other starts a version of its own,
    known by the record's ``incoming_key``. Only the entities of the batch are read.
    ``at_most`` is a bound of the rows in ``incoming``, where the caller knows one; it saves
    counting the rows of each entity. ``entities`` are those of ``incoming``, where they are
    cheaper to read than its rows.
    """
    names = (incoming if entities is None else entities).select(*entity)
    if at_most is not None and at_most > dedup.BROADCAST_KEYS:
        names = names.hint("merge")  # their files are far smaller than they are in memory
    touched = open_versions.join(names, list(entity), "left_semi")
    base = touched.select(
        *entity, *tracked, F.col(version_key).alias("_key"), F.lit(False).alias("_new")
    )
    new = incoming.withColumn("_key", F.col(incoming_key)).withColumn("_new", F.lit(True))
    sequence = new.unionByName(base, allowMissingColumns=True)
    if at_most is not None:  # and as many open versions at most
        sequence = sequence.repartition(in_ranges(2 * at_most), *entity)
    assigned = assign_versions(
        sequence, entity, ["_new", *order], tracked, F.col("_key"), version_key, max_rows,
        None if at_most is None else at_most + 1,  # and the open version of the entity
    )
    return assigned.filter("_new").drop("_new", "_key")


def current(version_rows: DataFrame) -> DataFrame:
    return version_rows.filter("is_current")


def valid_at(version_rows: DataFrame, when: Column | datetime) -> DataFrame:
    """The versions in force at a moment: valid_from <= moment < valid_to."""
    at = when if isinstance(when, Column) else moment(when)
    return version_rows.filter(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    )


def sorted_named_weights(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Distinct (name, weight) pairs in sorted order, pairs without a name dropped."""
    structs = [F.struct(n.alias("name"), round4(w).alias("weight")) for n, w in pairs]
    named = F.filter(F.array(*structs), lambda p: F.coalesce(p["name"], F.lit("")) != "")
    return F.array_sort(F.array_distinct(named))


def sorted_names(names: Sequence[Column]) -> Column:
    """Distinct non-empty names in sorted order."""
    present = F.filter(F.array(*names), lambda n: F.coalesce(n, F.lit("")) != "")
    return F.array_sort(F.array_distinct(present))
