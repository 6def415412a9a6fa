"""What a load reads and writes: buckets, pruned history, the gate's counts, the quarantine."""

import os

import pytest
from pyspark.sql import functions as F

from tests.sheets import A_1, B_1, workbook, write_workbooks
from tidemark.operators import dedup, ordered
from tidemark.operators.audit import Constraints, constraint_audit
from tidemark.operators.dedup import new_content
from tidemark.operators.latest import latest_per_key
from tidemark.operators.rules import QualityGateError
from tidemark.operators.scd2 import continue_versions
from tidemark.plans import audit_state, runs
from tidemark.plans.audit_state import AuditState
from tidemark.plans.latest_state import LatestState
from tidemark.plans.runs import QUARANTINE, replay, run_batch, still_quarantined
from tidemark.schemas import RAW_RECORD
from tidemark.sources.buckets import BucketedTable
from tidemark.sources.sheet_csv import read_sheet_csv, reload_sheet_csv, write_sheet_csv
from tidemark.sources.warehouse import Warehouse


def folders(root):
    """Bucket folders under a table, by load."""
    return {
        (load.name, bucket.name)
        for load in root.glob("load_id=*") for bucket in load.rglob("bucket=*") if bucket.is_dir()
    }


def read_files(df):
    return {f.split("load_id=")[1].split("/part-")[0] for f in df.inputFiles()}


# --- buckets --------------------------------------------------------------------------------


def test_untouched_buckets_are_neither_read_nor_written(spark, tmp_path):
    """A load of two keys reads and writes their buckets and leaves all others alone."""
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    first = BucketedTable(spark, str(tmp_path / "t"), rows.schema, ["k"], buckets=70)
    first.write(rows, "a", range(70))
    table = BucketedTable(spark, str(tmp_path / "t"), rows.schema, ["k"], "a", buckets=5)
    assert table.buckets == 70 and table.read().count() == 200
    before = folders(tmp_path / "t")
    wanted = [r[0] for r in rows.filter("k IN (3, 77)").select(table.bucket()).distinct().collect()]
    found = table.read(wanted)
    assert read_files(found) == {f"a/bucket={b}" for b in wanted}
    table.write(found.withColumn("v", F.when(F.col("k").isin(3, 77), 2).otherwise(1)), "b", wanted)
    assert folders(tmp_path / "t") - before == {("load_id=b", f"bucket={b}") for b in wanted}
    again = BucketedTable(spark, str(tmp_path / "t"), rows.schema, ["k"], "b")
    assert again.read().count() == 200 and {r.k for r in again.read().filter("v = 2").collect()} == {3, 77}
    # the state before is still there, and a table without rows has one too
    assert BucketedTable(spark, str(tmp_path / "t"), rows.schema, ["k"], "a").read().filter("v = 2").count() == 0
    empty = BucketedTable(spark, str(tmp_path / "e"), rows.schema, ["k"])
    assert empty.read().count() == 0
    empty.write(rows.limit(0), "a", [])
    assert BucketedTable(spark, str(tmp_path / "e"), rows.schema, ["k"], "a").read().count() == 0


def test_observed_buckets(spark, tmp_path):
    """The write tells exactly the buckets of its rows, null keys included."""
    from pyspark.sql import Observation

    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    table = BucketedTable(spark, str(tmp_path / "t"), rows.schema, ["k"], buckets=130)
    seen = Observation()
    rows.observe(seen, *[c.alias(n) for n, c in table.touched_metrics().items()]).write.format("noop").mode("overwrite").save()
    assert table.touched(seen.get) == sorted(r[0] for r in rows.select(table.bucket()).distinct().collect())


def test_latest_state_with_late_rows(spark, tmp_path):
    """Three loads, one of them late and one repeated, give the latest of all rows."""
    loads = [
        [(k, k % 7, f"first {k}") for k in range(60)],
        [(k, 1, f"late {k}") for k in range(0, 60, 2)] + [(None, 1, "no key")],
        [(5, 9, "x"), (5, 9, "w"), (71, None, "no time"), (None, 0, "older")],
    ]
    kind = "k int, t int, name string"
    state = LatestState(spark, str(tmp_path / "s"), spark.createDataFrame([], kind).schema, ["k"], ["t", "name"], buckets=16)
    for i, rows in enumerate(loads):
        touched = state.load(spark.createDataFrame(rows, kind), f"l{i}")
        assert 0 < len(touched) <= 16
    assert len(touched) <= 3
    everything = spark.createDataFrame([r for rows in loads for r in rows], kind)
    expected = sorted(map(str, latest_per_key(everything, ["k"], ["t", "name"]).collect()))
    assert sorted(map(str, state.rows().collect())) == expected
    resumed = LatestState(spark, str(tmp_path / "s"), state.schema, ["k"], ["t", "name"], "l1")
    resumed.load(spark.createDataFrame(loads[2], kind), "l2")
    assert sorted(map(str, resumed.rows().collect())) == expected
    assert resumed.load(spark.createDataFrame([], kind), "l3") == [] and resumed.rows().count() == len(expected)


# --- history ----------------------------------------------------------------------------------


def test_history_is_pruned_by_prefix(spark, tmp_path):
    """A small batch reads the history partitions of its own prefixes only."""
    place = str(tmp_path / "h")
    hashed = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("data_hash"), "id")
    hashed = hashed.withColumn("hash_prefix", F.left("data_hash", F.lit(2)))
    hashed.filter("id < 4000").drop("id").repartition("hash_prefix").write.partitionBy("hash_prefix").parquet(place)
    history = spark.read.schema("data_hash string, hash_prefix string").parquet(place)
    hashed.filter("id IN (7, 4500)").write.parquet(str(tmp_path / "b"))
    batch = spark.read.parquet(str(tmp_path / "b"))
    fresh = new_content(batch, history, ["data_hash"], ["id"], ["hash_prefix"])
    assert [r.id for r in fresh.collect()] == [4500]
    assert "dynamicpruning" in fresh._jdf.queryExecution().executedPlan().toString()


def test_keys_of_a_large_batch_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Catalyst takes the few bytes of a file for the size of its keys; a known bound counts more."""
    hashed = spark.range(2000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("data_hash"), F.concat(F.lit("e"), F.col("id") % 50).alias("entity"), "id"
    )
    hashed.write.parquet(str(tmp_path / "b"))
    batch = spark.read.parquet(str(tmp_path / "b"))
    many = spark.range(5_000_000).select(F.sha2(F.col("id").cast("string"), 256).alias("data_hash"))
    old = spark.range(5_000_000).select(F.concat(F.lit("e"), F.col("id")).alias("entity"), F.lit("a").alias("v"), F.col("id").alias("key"))

    def plans(at_most):
        fresh = new_content(batch, many, ["data_hash"], ["id"], at_most=at_most)
        new = batch.select("entity", "id", F.lit("b").alias("v"))
        carried = continue_versions(
            new, old, ["entity"], ["id"], ["v"], "id", "key", at_most=at_most, entities=batch.select("entity")
        )
        return [df._jdf.queryExecution().executedPlan().toString() for df in (fresh, carried)]

    assert all("BroadcastExchange" in plan for plan in plans(2000))
    monkeypatch.setattr(dedup, "BROADCAST_KEYS", 1999)
    assert not any("Broadcast" in plan for plan in plans(2000))
    history = hashed.filter("id < 1500").select("data_hash")
    found = new_content(batch.unionByName(batch), history, ["data_hash"], ["id"], at_most=4000)
    assert sorted(r.id for r in found.collect()) == list(range(1500, 2000))


# --- audit ------------------------------------------------------------------------------------


def test_audit_of_loads_is_the_audit_of_all_rows(spark, tmp_path):
    """Children before parents, repeats over loads, nulls, an empty load: always the full audit."""
    rules = {
        "p": Constraints(not_null=["id"], unique=[["id"], ["a", "b"]]),
        "c": Constraints(checks={"small": F.col("v") < 5}, foreign_keys=[("p_id", "p", "id"), ("q_id", "p", "id")]),
    }
    p_kind, c_kind = "id long, a string, b string", "p_id long, q_id long, v int"
    loads = [
        ([(1, "x", "y"), (2, 'x","', "y"), (2, "x", '","y'), (None, None, "y")], [(1, 9, 1), (7, 1, 9), (None, 7, None)]),
        ([(1, "x", "y"), (7, None, "y")], [(7, 8, 1), (8, 8, 8), (8, None, 2)]),
        ([], []),
        ([(8, "x", "y"), (7, "z", "y")], [(9, 9, 9)]),
    ]
    state, seen = AuditState(spark, str(tmp_path), rules), [[], []]
    for number, (parents, children) in enumerate(loads):
        seen[0] += parents
        seen[1] += children
        state.load({"p": spark.createDataFrame(parents, p_kind), "c": spark.createDataFrame(children, c_kind)}, f"l{number}")
        tables = {"p": spark.createDataFrame(seen[0], p_kind), "c": spark.createDataFrame(seen[1], c_kind)}
        full = {(r.table_name, r.constraint): r.violations for r in constraint_audit(tables, rules).collect()}
        assert {(r.table_name, r.constraint): r.violations for r in state.violations().collect()} == full
    resumed = AuditState(spark, str(tmp_path), rules, state.loads)
    resumed.load({"p": spark.createDataFrame([(9, "n", "n")], p_kind)}, "last")
    found = {(r.table_name, r.constraint): r.violations for r in resumed.violations().collect()}
    assert found["c", "FOREIGN KEY p_id -> p.id"] == 0 and found["c", "FOREIGN KEY q_id -> p.id"] == 0


# --- whole runs -------------------------------------------------------------------------------


def touch(path, content, ahead=2):
    import time

    path.write_bytes(content)
    os.utime(path, (time.time() + ahead,) * 2)


class jobs_of:
    """Counts the jobs that a block of code starts."""

    def __init__(self, spark):
        self.context = spark.sparkContext

    def __enter__(self):
        self.before = self._next()
        return self

    def __exit__(self, *_):
        self.n = self._next() - self.before - 1

    def _next(self):
        # job numbers count up; one tiny job tells where they stand
        self.context.setJobGroup("probe", "probe")
        self.context.parallelize([0], 1).count()
        found = max(self.context.statusTracker().getJobIdsForGroup("probe"))
        self.context._jsc.clearJobGroup()
        return found


def test_loads_take_few_jobs_and_touch_few_buckets(spark, tmp_path):
    root, folder = tmp_path / "wh", tmp_path / "in"
    write_workbooks(folder)
    with jobs_of(spark) as create:
        Warehouse(spark, str(root)).create()
    with jobs_of(spark) as first:
        run_batch(spark, str(root), str(folder), "r1")
    touch(folder / "corporates_C_1.xlsm", workbook(B_1 | {1: ["Rated entity", "Company C"]}))
    before = folders(root / "dim_company_versions")
    with jobs_of(spark) as second:
        result = run_batch(spark, str(root), str(folder), "r2")
    assert result.loaded == 1
    # Company C's bucket alone is new
    assert len(folders(root / "dim_company_versions") - before) == 1
    os.utime(folder / "corporates_C_1.xlsm", (1, 1))
    with jobs_of(spark) as nothing:
        assert run_batch(spark, str(root), str(folder), "r3").staged == 0
    print("jobs", create.n, first.n, second.n, nothing.n)
    assert first.n + second.n < 80 and nothing.n <= 12
    wh = Warehouse(spark, str(root))
    assert sorted(r.entity_name for r in wh.current_versions().collect()) == ["Company A", "Company B", "Company C"]
    assert wh.read("dim_company").count() == 5


def test_a_halted_run_reports_what_it_staged(spark, tmp_path):
    root, folder = str(tmp_path / "wh"), tmp_path / "in"
    write_workbooks(folder, ["corporates_A_1"])
    touch(folder / "bad_1.xlsm", workbook(B_1 | {11: ["Reporting Currency/Units", "chf"]}))
    with pytest.raises(QualityGateError):
        run_batch(spark, root, str(folder), "r1")
    state = Warehouse(spark, root).read("pipeline_run_state").first()
    assert (state["status"], state["files_staged"], state["files_loaded"]) == ("failed", 2, 0)


def test_quarantine_and_replay(spark, tmp_path):
    root, folder = str(tmp_path / "wh"), tmp_path / "in"
    write_workbooks(folder, ["corporates_A_1"])
    touch(folder / "bad_1.xlsm", workbook(B_1 | {11: ["Reporting Currency/Units", "chf"]}))
    touch(folder / "bad_2.xlsm", workbook({}))
    result = run_batch(spark, root, str(folder), "r1", on_failure=QUARANTINE)
    assert (result.staged, result.loaded, result.skipped, result.quarantined) == (3, 1, 0, 2)
    wh = Warehouse(spark, root)
    reports = {r.source_filename: r for r in wh.read("quality_report").collect()}
    assert reports["corporates_A_1.xlsm"].status != "FAILED" and reports["bad_1.xlsm"].status == "FAILED"
    assert [f.field for f in reports["bad_1.xlsm"].failures if f.severity == "CRITICAL"] == ["currency"]
    assert reports["bad_1.xlsm"].completeness_pct == 100.0
    waiting = {r.source_filename: r for r in still_quarantined(wh).collect()}
    assert set(waiting) == {"bad_1.xlsm", "bad_2.xlsm"} and len(waiting["bad_1.xlsm"].reasons) == 1
    corrected = still_quarantined(wh).withColumn("currency", F.upper("currency"))
    result = replay(wh, "r2", corrected)
    assert (result.staged, result.loaded, result.quarantined) == (2, 1, 1)
    assert [r.source_filename for r in still_quarantined(wh).collect()] == ["bad_2.xlsm"]
    assert {r.source_filename for r in wh.read("upload_log").collect()} == {"corporates_A_1.xlsm", "bad_1.xlsm"}
    # the file itself, mended, brings known content: nothing to load, and nothing left to do
    touch(folder / "bad_2.xlsm", workbook(A_1), 60)
    os.utime(folder / "bad_1.xlsm", (1, 1))
    os.utime(folder / "corporates_A_1.xlsm", (1, 1))
    result = run_batch(spark, root, str(folder), "r3", on_failure=QUARANTINE)
    assert (result.staged, result.loaded, result.skipped) == (1, 0, 1)
    assert still_quarantined(wh).count() == 0


# --- CSV ----------------------------------------------------------------------------------------


def test_csv_keeps_every_cell(spark, tmp_path):
    texts = ["a\nb", 'say "no"', "x,y", " wide ", "back\\nslash\\", "\r\n", "", '"', "\\", "tab\tend"]
    cell = "struct<kind:string,text:string>"
    rows = [("one.xlsm", 3, [None, *[("s", t) for t in texts], ("n", "1.5")]), ("one.xlsm", 4, [("s", "last")])]
    sheets = spark.createDataFrame(rows, f"source_filename string, row_idx int, cells array<{cell}>")
    out = str(tmp_path / "csv")
    for _ in range(2):
        write_sheet_csv(sheets, out)
    found = {r.row_idx: r.cells for r in reload_sheet_csv(spark, out).collect()}
    assert set(found) == {3, 4}
    assert [c and c.text for c in found[3]][:12] == [None, *texts, "1.5"] and [c.kind for c in found[3] if c][-1] == "n"
    assert [c and c.text for c in found[4]][:2] == ["last", None]


def test_csv_of_other_writers(spark, tmp_path):
    import csv

    with open(tmp_path / "two_master.csv", "w", newline="") as file:
        csv.writer(file).writerows([[0, "", "Rated entity", "line one\nline two, still"], [1, *["x,"] * 20, 'quote "q"']])
    rows = {r.row_idx: [c and c.text for c in r.cells] for r in read_sheet_csv(spark, str(tmp_path)).collect()}
    assert rows[0][:3] == [None, "Rated entity", "line one\nline two, still"] and rows[1] == ["x,"] * 20 + ['quote "q"']


def test_a_load_in_several_ranges(spark, tmp_path, monkeypatch):
    """More records than a task takes: numbers follow the file names, versions close each other."""
    monkeypatch.setattr(ordered, "ROWS_PER_RANGE", 2)
    monkeypatch.setattr(runs, "ROWS_PER_RANGE", 2)
    monkeypatch.setattr(runs, "BUCKETS", 1)
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.create()
    names = [f.name for f in RAW_RECORD.fields]
    known = {
        "source_filename": "concat('f', 9 - id, '.xlsm')", "rated_entity": "concat('E', id % 2)", "sector": "'S'",
        "country": "concat('C', id)", "currency": "'EUR'", "accounting_principles": "'IFRS'",
        "business_year_end": "'May'", "methodology_1": "'M'", "industry_risk_1": "'I'",
        "industry_risk_score_1": "'BBB'", "industry_weight_1": "1.0",
    }
    types = {f.name: f.dataType.simpleString() for f in RAW_RECORD.fields}
    records = spark.range(10).selectExpr(*[f"CAST({known.get(n, 'NULL')} AS {types[n]}) AS {n}" for n in names])
    mtimes = records.selectExpr("source_filename", "current_timestamp() AS file_modified_at")
    run = warehouse.begin_run("first")
    with runs.reported_run(warehouse, run) as counts:
        counts.update(runs.load_records(warehouse, records, mtimes, run))
    assert counts["loaded"] == 10
    fresh = spark.read.parquet(f"{warehouse.path('fresh')}/load_id={run['load_id']}")
    assert len({r["f"] for r in fresh.select(F.input_file_name().alias("f")).collect()}) > 1
    # what is sorted to number the records is narrow, however wide they are
    assert sorted(fresh.columns) == ["_place", "_row", "entity_name", "source_filename"]
    log = sorted((r.upload_id, r.source_filename) for r in warehouse.read("upload_log").collect())
    assert log == [(i + 1, f"f{i}.xlsm") for i in range(10)]
    versions = sorted((r.entity_name, r.valid_from, r.valid_to, r.country) for r in warehouse.read("dim_company").filter("NOT is_current").collect())
    assert [(v[0], v[3]) for v in versions] == [("E0", "C8"), ("E0", "C6"), ("E0", "C4"), ("E0", "C2"), ("E1", "C9"), ("E1", "C7"), ("E1", "C5"), ("E1", "C3")]
    assert all(a[2] == b[1] for a, b in zip(versions, versions[1:]) if a[0] == b[0])


def test_keys_of_large_loads_lie_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(audit_state, "KEYS_PER_TASK", 5)
    constraints = {"t": Constraints(unique=[["a"]], foreign_keys=[("b", "p", "b")])}
    state = audit_state.AuditState(spark, str(tmp_path / "state"), constraints, digits=1)
    rows = spark.range(400).selectExpr("id DIV 2 AS a", "id AS b")
    state.load({"t": rows}, "one")
    state.load({"t": rows.filter("a < 10"), "p": spark.range(100).selectExpr("id AS b")}, "two")
    found = {r["constraint"]: r["violations"] for r in state.violations().collect()}
    assert found == {"UNIQUE a": 220, "FOREIGN KEY b -> p.b": 300}
    folder = next((tmp_path / "state/keys/load_id=one").glob("constraint=UNIQUE*"))
    assert max(len(list(d.glob("*.parquet"))) for d in folder.glob("digit=*")) > 1
