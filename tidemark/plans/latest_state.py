"""The latest row of each key, kept up by loads instead of being read from all facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from tidemark.operators.latest import latest_per_key
from tidemark.sources.buckets import BUCKETS, BucketedTable


class LatestState:
    """A stored table with one row per ``keys``: the greatest by ``order`` of all loads so far.

    ``order`` must be total within a key. A load reduces its batch to one row per key, reads
    the buckets of these keys, keeps the greater row of each and writes these buckets anew. So
    rows may come late, in any order and more than once: the state is a maximum, and a load
    repeated under its own id gives the same state again. ``state`` is the load to go on from.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
        order: Sequence[str], state: str | None = None, buckets: int = BUCKETS,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order, self.buckets = list(keys), list(order), buckets
        self.table = self._at(state)

    def _at(self, state: str | None) -> BucketedTable:
        return BucketedTable(self.spark, self.path, self.schema, self.keys, state, self.buckets)

    def load(self, batch: DataFrame, load_id: str) -> list[int]:
        """Bring in the rows of a batch; returns the buckets read and written."""
        names = [f.name for f in self.schema.fields]
        latest = latest_per_key(batch.select(*names), self.keys, self.order)
        # written first: the batch is computed once, and the write tells the touched buckets
        seen, place = Observation(), f"{self.path}_batches/load_id={load_id}"
        metrics = [c.alias(n) for n, c in self.table.touched_metrics().items()]
        latest.observe(seen, *metrics).write.mode("overwrite").parquet(place)
        touched = self.table.touched(seen.get)
        if not touched:
            self.table.note(load_id, [])
        else:
            incoming = self.spark.read.schema(self.schema).parquet(place)
            both = self.table.read(touched).unionByName(incoming)
            self.table.write(latest_per_key(both, self.keys, self.order), load_id, touched)
        self.table = self._at(load_id)
        return touched

    def rows(self) -> DataFrame:
        return self.table.read()
