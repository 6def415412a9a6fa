"""Tables with one row per key that loads rewrite bucket by bucket.

A key's bucket is a hash of it. A load reads and writes only the buckets of the keys in its
batch, each as a folder of its own load; a short list, written with the load, says which
load's folder holds each bucket. An earlier state stays readable under its own list, so a
load that fails changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64  # of a new table; rows of one bucket are rewritten together
_WORD = 64  # buckets that one number of touched flags holds

_LIST = T.StructType(
    [T.StructField("bucket", T.IntegerType()), T.StructField("load_id", T.StringType()),
     T.StructField("buckets", T.IntegerType())]
)


def inline_rows(spark: SparkSession, schema: T.StructType, values: Sequence[tuple]) -> DataFrame:
    """A few rows known to the driver, as a plan without Python workers."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields, strict=True)])
        for row in values
    ]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


class BucketedTable:
    """One row per ``key`` columns, stored under ``path``.

    ``state`` is the load whose list counts, None for an empty table. The number of buckets
    is that of the first load; a later one keeps it. ``inside`` names folders between those
    of a load and of its buckets.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str],
        state: str | None = None, buckets: int = BUCKETS, inside: str = "",
    ):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, list(key)
        self.inside = inside
        self.folders: dict[int, str] = {}
        self.buckets = buckets
        if state is not None:
            found = spark.read.schema(_LIST).parquet(f"{self._lists}/load_id={state}").collect()
            self.folders = {r["bucket"]: r["load_id"] for r in found if r["bucket"] is not None}
            self.buckets = found[0]["buckets"] if found else buckets

    @property
    def _lists(self) -> str:
        return f"{self.path}_lists"

    def bucket(self) -> Column:
        """The bucket of a row; a null key has one too."""
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    # -- which buckets a batch touches ----------------------------------------------

    def touched_metrics(self) -> dict[str, Column]:
        """Aggregates for ``DataFrame.observe``: one bit per bucket that has a row."""
        number = self.bucket()
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(_WORD)))
        words = -(-self.buckets // _WORD)
        return {
            f"touched_{w}": F.bit_or(F.when(F.floor(number / _WORD) == w, bit).otherwise(F.lit(0).cast("long")))
            for w in range(words)
        }

    def touched(self, metrics: dict) -> list[int]:
        """The buckets named by observed ``touched_metrics``."""
        words = [(metrics.get(f"touched_{w}") or 0) for w in range(-(-self.buckets // _WORD))]
        return [b for b in range(self.buckets) if words[b // _WORD] >> (b % _WORD) & 1]

    # -- reading and writing -----------------------------------------------------------

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of the given buckets, of all without. Other buckets' folders are not listed."""
        wanted = self.folders if buckets is None else [b for b in buckets if b in self.folders]
        paths = [f"{self.path}/load_id={self.folders[b]}/{self.inside}bucket={b}" for b in sorted(wanted)]
        if not paths:
            return inline_rows(self.spark, self.schema, [])
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame, load_id: str, touched: Iterable[int]) -> None:
        """Write the whole new content of the touched buckets and the list that goes with it."""
        seen = Observation()
        placed = rows.observe(seen, *[c.alias(n) for n, c in self.touched_metrics().items()])
        # one file per bucket: the rows of a bucket meet in one task
        (
            placed.withColumn("bucket", self.bucket()).repartition("bucket")
            .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/load_id={load_id}")
        )
        filled = set(self.touched(seen.get))
        self.folders = {b: f for b, f in self.folders.items() if b not in set(touched) - filled}
        self.note(load_id, filled)

    def note(self, load_id: str, touched: Iterable[int]) -> None:
        """Write the list of a load whose buckets are stored."""
        folders = self.folders | {b: load_id for b in touched}
        entries = [(b, f, self.buckets) for b, f in sorted(folders.items())] or [(None, None, self.buckets)]
        listed = inline_rows(self.spark, _LIST, entries)
        listed.write.mode("overwrite").parquet(f"{self._lists}/load_id={load_id}")
