"""Warehouse tables as Parquet folders, partitioned by the load that wrote them.

A load writes its rows under its own ``load_id`` and becomes visible with the
run event that reports success, for all tables at once. Rows of a failed load
stay invisible. A load writes the dimension versions it has closed and those of the
buckets it has touched that are open after it; the other buckets' open versions stay
where earlier loads have put them (``sources/buckets.py``).
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.latest import latest_per_key
from tidemark.schemas import RAW_RECORD, SHEET_ROW, TABLES
from tidemark.sources.buckets import BucketedTable

_LISTS = [
    T.StructField("risks", T.ArrayType(
        T.StructType([
            T.StructField("name", T.StringType()), T.StructField("weight", T.DecimalType(5, 4))
        ])
    )),
    T.StructField("methodologies", T.ArrayType(T.StringType())),
]

_EVENT = T.StructType(
    [*TABLES["pipeline_run_state"].fields, T.StructField("load_id", T.StringType()),
     T.StructField("event_at", T.TimestampType()), T.StructField("last_upload_id", T.LongType()),
     T.StructField("versions_in", T.StringType())]
)

VERSION = T.StructType(TABLES["dim_company"].fields + _LISTS)

# Stored folders. dim_company is made of the versions closed by any load and the open ones.
_STORED: dict[str, T.StructType] = {
    **{n: s for n, s in TABLES.items() if n not in ("dim_company", "pipeline_run_state")},
    "dim_company_versions": VERSION,
    "known_hashes": T.StructType(
        [T.StructField("data_hash", T.StringType()), T.StructField("hash_prefix", T.StringType())]
    ),
    "quality_report": T.StructType(
        [T.StructField(n, T.StringType()) for n in ("source_filename", "rated_entity")]
        + [T.StructField(n, T.IntegerType())
           for n in ("total_checks", "passed", "failed_critical", "failed_warning")]
        + [T.StructField(n, T.DoubleType()) for n in ("completeness_pct", "validity_pct")]
        + [T.StructField("failures", T.ArrayType(T.StructType(
            [T.StructField(n, T.StringType()) for n in ("field", "rule", "severity", "message")]
        ))), T.StructField("status", T.StringType())]
    ),
    "quarantine": T.StructType(
        RAW_RECORD.fields
        + [T.StructField("file_modified_at", T.TimestampType()),
           T.StructField("reasons", T.ArrayType(T.StringType())),
           T.StructField("dag_run_id", T.StringType())]
    ),
    "sheet_rows": SHEET_ROW,
}

# Columns by which the rows of a load are laid out in folders, and those that bring the rows
# of one folder into one task before they are written, where they do not lie so already.
_PARTITIONED = {
    "dim_company_versions": (["is_current", "bucket"], []),
    "known_hashes": (["hash_prefix"], ["hash_prefix"]),
}


def rows(spark: SparkSession, schema: T.StructType, count: int, values: dict | None = None) -> DataFrame:
    """``count`` rows of constants, typed by ``schema``; needs no Python worker."""
    known = values or {}
    columns = [F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0, count, 1, 1).select(*columns)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self) -> None:
        """Create the folders that are absent. Reads go by the fixed schemas, so an empty
        folder is an empty table."""
        context = self.spark.sparkContext
        conf, make = context._jsc.hadoopConfiguration(), context._jvm.org.apache.hadoop.fs.Path
        for name in (*_STORED, "run_events"):
            path = make(self.path(name))
            path.getFileSystem(conf).mkdirs(path)

    # -- writing ------------------------------------------------------------------

    def write(self, name: str, df: DataFrame, load_id: str) -> None:
        """Write the rows of one load. A retry of the same load replaces its own rows."""
        path = f"{self.path(name)}/load_id={load_id}"
        if name in _PARTITIONED:
            folders, together = _PARTITIONED[name]
            df = df.repartition(*together) if together else df
            df.write.mode("overwrite").partitionBy(*folders).parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)

    def written(self, name: str, load_id: str, schema: T.StructType | None = None) -> DataFrame:
        """Rows of one load, visible or not."""
        reader = self.spark.read.schema(schema or _STORED[name])
        return reader.parquet(f"{self.path(name)}/load_id={load_id}")

    # -- runs ---------------------------------------------------------------------

    def _event(self, row: dict) -> None:
        rows(self.spark, _EVENT, 1, row).write.mode("append").parquet(self.path("run_events"))

    def events(self) -> DataFrame:
        return self.spark.read.schema(_EVENT).parquet(self.path("run_events"))

    def begin_run(self, dag_run_id: str) -> dict:
        """Record a run as running; a second start of the same run resets its row."""
        now = datetime.now(timezone.utc)
        known = F.max(F.when(F.col("dag_run_id") == dag_run_id, F.col("run_id")))
        ids = self.events().agg(
            known.alias("same"), F.max("run_id").alias("top"), *_last_state()
        ).first()
        run = {
            "run_id": ids["same"] or (ids["top"] or 0) + 1,
            "dag_run_id": dag_run_id, "started_at_utc": now, "status": "running",
            "files_staged": 0, "files_loaded": 0, "files_skipped": 0,
            "load_id": f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}", "event_at": now,
            "last_upload_id": ids["last_upload_id"] or 0, "versions_in": ids["versions_in"],
        }
        self._event(run)
        return run

    def complete_run(
        self, run: dict, status: str, staged: int = 0, loaded: int = 0, skipped: int = 0
    ) -> None:
        now = datetime.now(timezone.utc)
        self._event(
            {**run, "completed_at_utc": now, "status": status, "files_staged": staged,
             "files_loaded": loaded, "files_skipped": skipped, "event_at": now}
        )

    def run_state(self) -> DataFrame:
        """pipeline_run_state: the latest event of each run."""
        return run_state(self.events()).select(*TABLES["pipeline_run_state"].names)

    def watermark(self, column: str = "completed_at_utc") -> datetime | None:
        """Time of the last successful run. ``started_at_utc`` also sees files changed
        while that run was working; their content hashes make the overlap harmless."""
        moment = last_success(self.run_state(), column).first()[0]
        return moment.astimezone(timezone.utc) if moment else None

    # -- reading ------------------------------------------------------------------

    def _visible(self) -> DataFrame:
        return self.events().filter("status = 'success'").select("load_id")

    def read(self, name: str) -> DataFrame:
        """A warehouse table as of the last successful load."""
        if name == "pipeline_run_state":
            return self.run_state()
        if name == "dim_company":
            return self.versions().select(*TABLES[name].names)
        return self._stored(name).join(self._visible(), "load_id", "left_semi").select(*_STORED[name].names)

    def read_dated(self, name: str) -> DataFrame:
        """A table with ``visible_at``, the time from which each row's load shows."""
        shown = self.events().filter("status = 'success'").groupBy("load_id").agg(
            F.max("event_at").alias("visible_at")
        )
        return self._stored(name).join(shown, "load_id").select(*_STORED[name].names, "visible_at")

    def _stored(self, name: str) -> DataFrame:
        schema = T.StructType(_STORED[name].fields + [T.StructField("load_id", T.StringType())])
        return self.spark.read.schema(schema).parquet(self.path(name))

    def open_versions(self, state: str | None) -> BucketedTable:
        """The open versions as the load ``state`` left them, by bucket of the entity."""
        return BucketedTable(
            self.spark, self.path("dim_company_versions"), VERSION, ["entity_name"], state,
            inside="is_current=true/",
        )

    def current_versions(self) -> DataFrame:
        """Open versions as the last successful load left them."""
        state = self.events().agg(*_last_state()).first()["versions_in"]
        return self.open_versions(state).read().withColumn("is_current", F.lit(True))

    def versions(self) -> DataFrame:
        closed = self.read("dim_company_versions").filter(~F.col("is_current"))
        return closed.unionByName(self.current_versions())


def _last_state() -> list[Column]:
    """What the last successful load left: the ids given so far, the list of open versions."""
    success = F.when(F.col("status") == "success", F.col("event_at"))
    return [F.max_by(c, success).alias(c) for c in ("last_upload_id", "versions_in")]


def run_state(events: DataFrame) -> DataFrame:
    """The latest event per run. At equal times completion counts after the start."""
    order = events.withColumn("_done", F.col("completed_at_utc").isNotNull())
    return latest_per_key(order, ["dag_run_id"], ["event_at", "_done"]).drop("_done")


def last_success(state: DataFrame, column: str = "completed_at_utc") -> DataFrame:
    return state.filter("status = 'success'").agg(F.max(column).alias(column))


__all__ = ["Warehouse", "last_success", "run_state"]
