"""One batch run: staged files to warehouse rows, with watermark, gate and run state."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import rules as R
from tidemark.operators.dedup import new_content
from tidemark.operators.kvsheet import parse_records
from tidemark.operators.ordered import (
    ROWS_PER_RANGE,
    OrderedGroups,
    in_ranges,
    numbered_by_place,
    placed_in_order,
)
from tidemark.operators.scd2 import continue_versions
from tidemark.plans import ratings
from tidemark.sources.buckets import BUCKETS, BucketedTable
from tidemark.sources.files import modified_since
from tidemark.sources.sheet_csv import write_sheet_csv
from tidemark.sources.warehouse import VERSION, Warehouse
from tidemark.sources.workbook import read_sheets

HALT, QUARANTINE = "halt", "quarantine"

ROW = "_row"  # a number of its own for each stored record of a load


@dataclass(frozen=True)
class RunResult:
    dag_run_id: str
    load_id: str
    staged: int
    loaded: int
    skipped: int
    quarantined: int = 0


def run_batch(
    spark: SparkSession,
    root: str,
    input_dir: str,
    dag_run_id: str,
    csv_dir: str | None = None,
    watermark_column: str = "completed_at_utc",
    on_failure: str = HALT,
) -> RunResult:
    """Load the workbooks changed since the last successful run."""
    warehouse = Warehouse(spark, root)
    warehouse.create()
    run = warehouse.begin_run(dag_run_id)
    with reported_run(warehouse, run) as counts:
        files = modified_since(spark, input_dir, warehouse.watermark(watermark_column))
        # the listing alone tells that nothing has changed; no file is opened for it
        if files.select("path").isEmpty():
            counts.update(staged=0, loaded=0, skipped=0)
        else:
            counts.update(load_files(warehouse, files, run, csv_dir, on_failure))
    return RunResult(dag_run_id, run["load_id"], **counts)


class reported_run:
    """Closes the run as success or failed, whatever step ends it.

    A run that the gate has halted still reports the records it has staged.
    """

    def __init__(self, warehouse: Warehouse, run: dict):
        self.warehouse, self.run, self.counts = warehouse, run, {}

    def __enter__(self) -> dict:
        return self.counts

    def __exit__(self, kind, error, trace) -> None:
        status = "failed" if kind else "success"
        self.counts.update(getattr(error, "counts", {}))
        known = {n: self.counts[n] for n in ("staged", "loaded", "skipped") if n in self.counts}
        self.warehouse.complete_run(self.run, status, **known)


def load_files(
    warehouse: Warehouse, files: DataFrame, run: dict, csv_dir: str | None = None,
    on_failure: str = HALT,
) -> dict:
    """Decode, check and load the given files (path, source_filename, content, modificationTime)."""
    load_id = run["load_id"]
    # The decoded sheets are written once: all later steps read columns, not workbooks.
    warehouse.write("sheet_rows", read_sheets(files), load_id)
    sheets = warehouse.written("sheet_rows", load_id)
    if csv_dir:
        write_sheet_csv(sheets, csv_dir)
    staged = files.select("source_filename", F.col("modificationTime").alias("file_modified_at"))
    # A workbook with an empty sheet still counts as a record, one that fails the checks.
    records = staged.select("source_filename").join(parse_records(sheets), "source_filename", "left")
    return load_records(warehouse, records, staged, run, on_failure)


def checked_records(records: DataFrame) -> DataFrame:
    """Raw records to their normalised form (``clean``), quality ``report`` and, where a
    critical rule rejects them, the record as it came (``raw``).

    All are structs of one row, so one pass over the records serves the gate, the report
    and the load.
    """
    report = R.report_columns(ratings.record_rules())
    kept = records.withColumn("report", F.struct(*[c.alias(n) for n, c in report.items()])).withColumns(
        {
            "entity": F.col("rated_entity"),
            "raw": F.when(F.col("report.failed_critical") > 0, F.struct(*records.columns)),
        }
    )
    also = ["entity", "raw", "report"]
    clean = ratings.normalise(kept, also)
    inner = [c for c in clean.columns if c not in also]
    return clean.select(*also, F.struct(*inner).alias("clean"))


def load_records(
    warehouse: Warehouse, records: DataFrame, mtimes: DataFrame, run: dict, on_failure: str = HALT
) -> dict:
    """Check raw records, then load those with new content.

    The records are read once: they are written with their hash and report, and the write
    itself counts them and those that a critical rule rejects. ``on_failure`` says what
    becomes of such a batch: ``halt`` loads nothing of it, ``quarantine`` stores its rejected
    records in a table of their own and loads the rest.
    """
    load_id = run["load_id"]
    seen = Observation()
    failing = F.col("report.failed_critical") > 0
    numbered = checked_records(ratings.with_mtimes(records, mtimes)).withColumn(
        ROW, F.monotonically_increasing_id()
    )
    warehouse.write(
        "checked",
        numbered.observe(
            seen, F.count(F.lit(1)).alias("n"), F.count_if(failing).alias("rejected"),
            F.sum("report.failed_critical").alias("bad"),
        ),
        load_id,
    )
    checked = warehouse.spark.read.parquet(f"{warehouse.path('checked')}/load_id={load_id}")
    report = R.with_status(
        checked.select("clean.source_filename", F.col("entity").alias("rated_entity"), "report.*")
    )
    staged, rejected = seen.get["n"], seen.get["rejected"]
    if rejected and on_failure == HALT:
        warehouse.write("quality_report", report, load_id)
        error = R.QualityGateError(f"{seen.get['bad']} critical failure(s), nothing loaded")
        error.counts = {"staged": staged, "loaded": 0, "skipped": 0}
        raise error
    side = {"quality_report": report}
    if rejected:
        side["quarantine"] = quarantine_rows(checked.filter(failing), run)
        checked = checked.filter(~failing)
    loaded = load_normalised(warehouse, checked.select("clean.*", ROW), run, side, staged)
    counts = {"staged": staged, "loaded": loaded, "skipped": staged - rejected - loaded}
    return counts | ({"quarantined": rejected} if rejected else {})


def quarantine_rows(rejected: DataFrame, run: dict) -> DataFrame:
    """The rejected records as they came, with what they failed."""
    return rejected.select(
        "raw.*",
        F.transform(
            F.filter("report.failures", lambda f: f["severity"] == R.CRITICAL),
            lambda f: f["message"],
        ).alias("reasons"),
        F.lit(run["dag_run_id"]).alias("dag_run_id"),
    )


def load_normalised(
    warehouse: Warehouse, normalised: DataFrame, run: dict, side: dict[str, DataFrame] | None = None,
    at_most: int | None = None,
) -> int:
    """Write the star-schema rows of the records with new content; returns their number.

    ``normalised`` are stored records with a ``ROW`` number. Which of them are new, and in which
    order, is found on a few narrow columns; the records themselves meet the result by ``ROW``
    and are never sorted by content or file.

    ``side`` holds further tables of the load, written along with the others. ``at_most`` is a
    bound of the records, where the caller knows one.
    """
    load_id, versions = run["load_id"], warehouse.open_versions(run["versions_in"])
    # Written in the order of their numbers, each with its place in it; the write counts the
    # records and notes the buckets of their entities.
    most = normalised.count() if at_most is None else at_most
    ranges = in_ranges(most)
    seen = Observation()
    keys = normalised.select(ROW, "source_filename", "data_hash", F.col("rated_entity").alias("entity_name"))
    fresh = new_content(
        ratings.with_hash_prefix(keys), warehouse.read("known_hashes"), ["data_hash"],
        ["source_filename", ROW], ["hash_prefix"], most,
    ).select(ROW, "source_filename", "entity_name")
    fresh = placed_in_order(fresh, ["source_filename"], ranges, "_place")
    warehouse.write(
        "fresh",
        fresh.observe(
            seen, F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in versions.touched_metrics().items()]
        ),
        load_id,
    )
    loaded, touched = seen.get["n"], versions.touched(seen.get)
    if loaded:
        outputs = _star_rows(warehouse, normalised, versions, touched, loaded, ranges, run)
    else:
        outputs = {}
    # Independent jobs: submitted together, Spark fills the cluster with their tasks.
    outputs |= side or {}
    if outputs:
        with ThreadPoolExecutor(len(outputs)) as pool:
            jobs = [pool.submit(warehouse.write, name, df, load_id) for name, df in outputs.items()]
            for job in jobs:
                job.result()
    if loaded:
        versions.note(load_id, touched)
        run.update(last_upload_id=run["last_upload_id"] + loaded, versions_in=load_id)
    return loaded


def _star_rows(
    warehouse: Warehouse, normalised: DataFrame, versions: BucketedTable, touched: list[int], loaded: int,
    ranges: int, run: dict,
) -> dict[str, DataFrame]:
    """The rows of the fact and bridge tables; the versions are written here."""
    load_id, last_id = run["load_id"], run["last_upload_id"]
    fresh = warehouse.spark.read.parquet(f"{warehouse.path('fresh')}/load_id={load_id}")
    numbers = numbered_by_place(fresh, "_place", ranges, "upload_id", last_id).select(ROW, "upload_id")
    records = ratings.with_dimension_columns(ratings.with_hash_prefix(normalised))
    if ranges > 1:  # the size of the files says little about that of the rows
        records, numbers = records.repartition(ranges, ROW), numbers.repartition(ranges, ROW).hint("merge")
    numbered = records.join(numbers, ROW).drop(ROW)
    batch_time = F.lit(datetime.now(timezone.utc))
    # One microsecond apart, so that the versions of one entity start at different times.
    ordinal = (F.col("upload_id") - F.lit(last_id)).cast("long")
    new = numbered.withColumns(
        {
            "loaded_at_utc": F.timestamp_micros(F.unix_micros(batch_time) + ordinal),
            "dag_run_id": F.lit(run["dag_run_id"]),
        }
    )
    open_versions = versions.read(touched)
    versioned = continue_versions(
        new, open_versions, ["entity_name"], ["loaded_at_utc"], ratings.TRACKED,
        "upload_id", "company_id", at_most=loaded, entities=fresh.select("entity_name"),
    )
    warehouse.write("accepted", versioned, load_id)
    accepted = warehouse.spark.read.parquet(f"{warehouse.path('accepted')}/load_id={load_id}")
    return {
        "known_hashes": accepted.select("data_hash", "hash_prefix"),
        "upload_log": ratings.upload_rows(accepted),
        "fact_ratings": ratings.rating_rows(accepted),
        "fact_scope_credit_hist": ratings.metric_rows(accepted),
        "dim_company_industry_risk": ratings.risk_rows(accepted),
        "dim_company_rating_methodology": ratings.methodology_rows(accepted),
        "dim_company_versions": next_versions(open_versions, accepted, versions.bucket(), loaded),
    }


def next_versions(
    open_versions: DataFrame, accepted: DataFrame, bucket: Column, at_most: int | None = None
) -> DataFrame:
    """The versions closed by this load and those open after it, of the given open versions.

    ``at_most`` is a bound of the rows in ``accepted``, where the caller knows one. The rows
    meet by bucket once, for the window and for the write alike, those of a large load by a
    slice of it; an entity without a new version keeps the one it has.
    """
    columns = [f.name for f in VERSION.fields]
    both = open_versions.drop("valid_to", "is_current").unionByName(ratings.version_rows(accepted))
    slices = in_ranges(0 if at_most is None else at_most, BUCKETS * ROWS_PER_RANGE)
    placed, by = both.withColumn("bucket", bucket), ["bucket"]
    if slices > 1:
        by = ["bucket", "_slice"]
        placed = placed.withColumn("_slice", F.pmod(F.hash("entity_name"), F.lit(slices)))
        placed = placed.repartition(BUCKETS * slices, *by)
    else:
        placed = placed.repartition(*by)
    groups = OrderedGroups(
        placed, [*by, "entity_name"], ["valid_from"], at_most=None if at_most is None else at_most + 1
    )
    bounded = groups.done(groups.add(groups.df, _next=groups.lead(F.col("valid_from"))))
    return bounded.withColumns(
        {"valid_to": F.col("_next.v"), "is_current": F.col("_next").isNull()}
    ).select(*columns, "bucket")


def replay(
    warehouse: Warehouse, dag_run_id: str, corrected: DataFrame, on_failure: str = QUARANTINE
) -> RunResult:
    """Load corrected records of the quarantine as a run of their own.

    ``corrected`` has the columns of ``still_quarantined``, changed where they were wrong.
    Records that still fail stay in quarantine.
    """
    run = warehouse.begin_run(dag_run_id)
    with reported_run(warehouse, run) as counts:
        records = corrected.drop("file_modified_at", "reasons", "dag_run_id")
        mtimes = corrected.select("source_filename", "file_modified_at")
        counts.update(load_records(warehouse, records, mtimes, run, on_failure))
    return RunResult(dag_run_id, run["load_id"], **counts)


def still_quarantined(warehouse: Warehouse) -> DataFrame:
    """Rejected records whose file no later load has brought in, the latest of each file.

    A later record of the file with known content counts as brought in too, as it needs no
    further work.
    """
    return ratings.unresolved(
        warehouse.read_dated("quarantine"), warehouse.read_dated("quality_report")
    )


__all__ = [
    "HALT", "QUARANTINE", "RunResult", "load_files", "load_normalised", "load_records", "replay",
    "reported_run", "run_batch", "still_quarantined",
]
