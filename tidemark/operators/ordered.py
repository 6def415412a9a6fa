"""Ordered operations within groups that stay spread out when one group is huge.

A plain ``Window.partitionBy(key)`` puts a whole group into one task. Here the rows of
keys with more rows than one task should hold are range-partitioned by key and order and
written once with the number of their range, the *chunk*, so (key, chunk) is the window
partition. What has to cross a chunk border (previous value, running count, ...) comes
from a summary with one row per heavy key and chunk: at most one row per range plus one
per heavy key, however the keys are spread.

Which keys are heavy is counted exactly, for every input. Their number is not limited,
and they never pass through the driver. Without any, the plain window is taken.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import shared_dir

# Rows of one group that a single task may sort.
MAX_ROWS_PER_TASK = 4_000_000

# Rows of a range when a whole table is numbered or sorted, and of a task that sorts wide rows.
ROWS_PER_RANGE = 50_000

CHUNK = "_chunk"

_POSITION_BITS = 33  # of monotonically_increasing_id: the lower ones count the rows of a partition


def position_in(bounds: Column, count: int | Column, value: Column) -> Column:
    """How many of the ascending ``bounds`` are <= ``value``, by binary search.

    ``count`` is the number of bounds, as a number or a Column.
    """
    top = count.bit_length() if isinstance(count, int) else 31
    size = F.lit(count) if isinstance(count, int) else count
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(top))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            (step <= size - at) & (F.try_element_at(bounds, at + step) <= value), at + step
        ).otherwise(at),
    )


@dataclass(frozen=True)
class _OrderedColumn:
    """A column over the ordered group, and how it continues over a chunk border."""

    local: Column  # within the chunk
    of_chunk: Column  # aggregate of one chunk, for its neighbours
    carried: Callable[[Column], Column]  # what the neighbours hand to a chunk
    joined: Callable[[Column, Column], Column]  # local and carried value to the result


class OrderedGroups:
    """Rows of ``df`` grouped by ``keys`` and ordered ascending by ``order``.

    ``order`` must be total within a key, else the results depend on chance.
    :meth:`add` takes a DataFrame derived from :attr:`df` by adding columns or
    removing rows; as long as no shuffle comes between, repeated calls share one
    exchange and one sort.

    Making the object counts the rows per key, unless ``at_most``, a number of rows that no
    key is known to exceed, rules heavy keys out. Only with heavy keys are rows
    written, into the session's shared folder, where they stay until its owner clears it.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        max_rows: int | None = None,
        at_most: int | None = None,
    ):
        self.keys, self.order = list(keys), list(order)
        self.max_rows = max_rows or MAX_ROWS_PER_TASK
        if at_most is not None and at_most <= self.max_rows:
            heavy = None
        else:
            heavy = self._heavy_keys(df)
        rows = heavy.agg(F.sum("_n").alias("n")).first()["n"] if heavy is not None else None
        self.split = rows is not None
        self.df = self._with_chunks(df, heavy, -(-rows // self.max_rows)) if self.split else df
        self.partition = self.keys + ([CHUNK] if self.split else [])
        self.window = Window.partitionBy(*self.partition).orderBy(*self.order)

    def _heavy_keys(self, df: DataFrame) -> DataFrame:
        counts = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n"))
        return counts.filter(F.col("_n") > self.max_rows)

    # -- splitting ----------------------------------------------------------------

    def _order_struct(self) -> Column:
        return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(self.order)])

    def _with_chunks(self, df: DataFrame, heavy: DataFrame, ranges: int) -> DataFrame:
        """The rows of heavy keys with the number of their range, all others with null.

        Spark samples the borders of the ranges anew in each run, so the rows are stored
        with their number. The heavy keys are stored too: then Catalyst knows the size of
        that side and decides by itself whether to broadcast it.
        """
        keys = self._stored(self._aliased(heavy.select(*self.keys)), "heavy-keys")
        ranged = (
            df.join(keys, self._same_key(), "left_semi")
            .repartitionByRange(ranges, *self.keys, *self.order)
            .withColumn(CHUNK, F.spark_partition_id())
        )
        light = df.join(keys, self._same_key(), "left_anti")
        return light.withColumn(CHUNK, F.lit(None).cast("int")).unionByName(self._stored(ranged, "chunks"))

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_dir(df.sparkSession, f"ordered-{name}")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _names(self) -> list[str]:
        return [f"_k{i}" for i in range(len(self.keys))]

    def _aliased(self, table: DataFrame) -> DataFrame:
        return table.withColumnsRenamed(dict(zip(self.keys, self._names(), strict=True)))

    def _same_key(self, extra: Sequence[tuple[str, str]] = ()) -> Column:
        """Null-safe equality, so a group of null keys counts as a group too."""
        pairs = list(zip(self.keys, self._names(), strict=True)) + list(extra)
        condition = F.lit(True)
        for left, right in pairs:
            condition = condition & F.col(left).eqNullSafe(F.col(right))
        return condition

    # -- ordered columns --------------------------------------------------------------

    def lag(self, value: Column) -> _OrderedColumn:
        """struct(v) of the previous row of the group, null on its first row."""
        boxed = F.struct(value.alias("v"))
        return _OrderedColumn(
            local=F.lag(boxed).over(self.window),
            of_chunk=F.max_by(boxed, self._order_struct()),
            carried=lambda v: F.lag(v).over(self._across()),
            joined=F.coalesce,
        )

    def lead(self, value: Column) -> _OrderedColumn:
        """struct(v) of the next row of the group, null on its last row."""
        boxed = F.struct(value.alias("v"))
        return _OrderedColumn(
            local=F.lead(boxed).over(self.window),
            of_chunk=F.min_by(boxed, self._order_struct()),
            carried=lambda v: F.lead(v).over(self._across()),
            joined=F.coalesce,
        )

    def number(self) -> _OrderedColumn:
        """Position of the row in its group, from 1."""
        before = self._across().rowsBetween(Window.unboundedPreceding, -1)
        return _OrderedColumn(
            local=F.row_number().over(self.window).cast("long"),
            of_chunk=F.count(F.lit(1)),
            carried=lambda v: F.sum(v).over(before),
            joined=lambda here, carry: here + F.coalesce(carry, F.lit(0)),
        )

    def last_known(self, value: Column) -> _OrderedColumn:
        """The latest non-null ``value`` up to and including the row."""
        frame = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = self._across().rowsBetween(Window.unboundedPreceding, -1)
        return _OrderedColumn(
            local=F.last(value, ignorenulls=True).over(frame),
            of_chunk=F.max_by(value, F.when(value.isNotNull(), self._order_struct())),
            carried=lambda v: F.last(v, ignorenulls=True).over(before),
            joined=F.coalesce,
        )

    def add(self, df: DataFrame, **columns: _OrderedColumn) -> DataFrame:
        """``df`` with the given ordered columns, all from one pass over each chunk.

        The rows a summary counts are those of ``df``, so a filter before ``add``
        holds for the neighbours across chunk borders as well. With heavy keys the
        summary is computed and stored here, for the same reason as the heavy keys.
        """
        if not self.split:
            return df.withColumns({n: c.local for n, c in columns.items()})
        heavy = df.filter(F.col(CHUNK).isNotNull())
        summary = heavy.groupBy(*self.keys, CHUNK).agg(
            *[c.of_chunk.alias(f"_v_{n}") for n, c in columns.items()]
        )
        small = self._aliased(
            summary.select(
                *self.keys,
                F.col(CHUNK).alias("_c"),
                *[c.carried(F.col(f"_v_{n}")).alias(f"_carry_{n}") for n, c in columns.items()],
            )
        )
        small = self._stored(small, "borders")
        here = df.withColumns({n: c.local for n, c in columns.items()})
        both = here.join(small, self._same_key([(CHUNK, "_c")]), "left")
        full = {n: c.joined(F.col(n), F.col(f"_carry_{n}")) for n, c in columns.items()}
        return both.withColumns(full).drop("_c", *self._names(), *[f"_carry_{n}" for n in columns])

    def _across(self) -> WindowSpec:
        """The chunks of a heavy key in order: one row each."""
        return Window.partitionBy(*self.keys).orderBy(CHUNK)

    def done(self, df: DataFrame) -> DataFrame:
        """``df`` without the helper column."""
        return df.drop(CHUNK)


def in_ranges(rows: int, max_rows: int | None = None) -> int:
    """Tasks for ``rows`` wide rows, each with about ``max_rows`` of them."""
    return rows // (max_rows or ROWS_PER_RANGE) + 1


def placed_in_order(df: DataFrame, order: Sequence[str], ranges: int, place: str) -> DataFrame:
    """``df`` in that many ranges of ``order``, sorted, with ``place``: the number of the range
    in the upper bits and the position in it in the lower ones.

    Spark samples the borders anew in each run, so the rows are to be stored before
    :func:`numbered_by_place` counts them.
    """
    ranged = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return ranged.withColumn(place, F.monotonically_increasing_id())


def numbered_by_place(stored: DataFrame, place: str, ranges: int, name: str, start: int = 0) -> DataFrame:
    """Stored rows of :func:`placed_in_order` with ``name`` = start + 1, start + 2, ... for ``place``.

    The rows stay where they are: only the sizes of the ranges are counted and broadcast.
    """
    if ranges == 1:
        return stored.withColumn(name, F.col(place) + F.lit(start + 1).cast("long")).drop(place)
    part = F.shiftright(place, _POSITION_BITS)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    position = F.col(place).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    found = stored.join(F.broadcast(offsets), part == F.col("_part"))
    number = F.col("_before") + position + F.lit(start + 1).cast("long")
    return found.withColumn(name, number).drop(place, "_part", "_before")


def dense_ids(
    df: DataFrame, order: Sequence[str], name: str, start: int = 0, max_rows: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """``name`` = start + 1, start + 2, ... along ``order``, as a serial column counts.

    The whole table is one group here; beyond ``max_rows`` it is stored in ranges, once, in the
    session's shared folder, and numbered range by range. ``at_most`` is a bound of the rows,
    where the caller knows one.
    """
    ranges = in_ranges(df.count() if at_most is None else at_most, max_rows)
    if ranges == 1:
        one = Window.partitionBy("_all").orderBy(*order)
        number = F.row_number().over(one).cast("long") + F.lit(start)
        return df.withColumn("_all", F.lit(0)).withColumn(name, number).drop("_all")
    path = shared_dir(df.sparkSession, "ordered-ids")
    placed = placed_in_order(df, order, ranges, "_place")
    placed.write.parquet(path)
    stored = df.sparkSession.read.schema(placed.schema).parquet(path)
    return numbered_by_place(stored, "_place", ranges, name, start)
