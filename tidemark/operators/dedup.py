"""Removal of content already seen, in the batch and in all history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import first_per_key

# Keys of a batch that Catalyst may send to every executor, whatever it takes their size to be.
BROADCAST_KEYS = 200_000


def new_content(
    batch: DataFrame,
    history: DataFrame | None,
    on: Sequence[str],
    order: Sequence[Column | str],
    stored_by: Sequence[str] = (),
    at_most: int | None = None,
) -> DataFrame:
    """Rows to load: the first of equal content in the batch, none seen in history.

    The batch is reduced first, map-side, so a content repeated a billion times
    reaches the join once. ``stored_by`` names columns of both sides that follow from ``on``
    and partition the stored history, such as a prefix of the hash: then only the
    partitions are read in which a row of the batch can be. ``at_most`` is a bound of the rows
    of the batch, where the caller knows one.
    """
    first = first_per_key(batch, on, order)
    if history is not None and at_most is not None and at_most > BROADCAST_KEYS:
        # Catalyst goes by the size of files, which says little about that of the keys in memory.
        # A batch like this is in all partitions of the history anyway.
        return first.join(history.select(*on), list(on), "left_anti")
    return first if history is None else _unseen(first, history, [*stored_by, *on])


def _unseen(rows: DataFrame, history: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose keys are not in history.

    An anti join can only broadcast history. So history is cut down to the keys of the
    rows first, where Catalyst may broadcast these: a small batch shuffles no history.
    """
    seen = history.select(*on).join(rows.select(*on), list(on), "left_semi")
    return rows.join(seen, list(on), "left_anti")


def load_status(
    batch: DataFrame,
    history: DataFrame | None,
    on: Sequence[str],
    order: Sequence[str],
    key: Sequence[str],
) -> DataFrame:
    """Every batch row with ``status`` loaded / skipped_duplicate.

    ``key`` identifies a batch row; the join back goes over it, so it stays even
    when many rows share one content.
    """
    winners = new_content(batch.select(*dict.fromkeys([*key, *on, *order])), history, on, order)
    mark = winners.select(*key, F.lit("loaded").alias("status"))
    return batch.join(mark, list(key), "left").withColumn(
        "status", F.coalesce("status", F.lit("skipped_duplicate"))
    )


def insert_if_absent(
    incoming: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Rows to append so that ``keys`` stay unique; of equal incoming keys the first by ``order``.

    Without an order the other columns decide, so the survivor is always the same row.
    """
    rest = [c for c in incoming.columns if c not in keys]
    return _unseen(first_per_key(incoming, keys, order or rest or list(keys)), existing, keys)
