"""Whole runs: first load, re-run, changed and failing files, the read queries."""

import os
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.sheets import A_1, B_1, HASHES, SHEETS, workbook, write_workbooks
from tidemark.operators.rules import QualityGateError
from tidemark.plans import reads
from tidemark.plans.audit import warehouse_audit
from tidemark.plans.runs import run_batch
from tidemark.sources.files import list_files
from tidemark.sources.warehouse import Warehouse
from tidemark.functions.text import file_name


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    write_workbooks(root / "in")
    first = run_batch(spark, str(root / "wh"), str(root / "in"), "run-1", str(root / "csv"))
    second = run_batch(spark, str(root / "wh"), str(root / "in"), "run-2")
    return root, Warehouse(spark, str(root / "wh")), first, second


def tables(warehouse, *names):
    return [warehouse.read(n) for n in names]


def test_counts_of_both_runs(loaded):
    _, _, first, second = loaded
    assert (first.staged, first.loaded, first.skipped) == (4, 4, 0)
    assert (second.staged, second.loaded, second.skipped) == (0, 0, 0)


def test_table_sizes(loaded):
    _, wh, _, _ = loaded
    sizes = {
        "upload_log": 4, "dim_company": 4, "dim_company_industry_risk": 6,
        "dim_company_rating_methodology": 5, "fact_ratings": 4, "fact_scope_credit_hist": 240,
        "pipeline_run_state": 2,
    }
    assert {n: wh.read(n).count() for n in sizes} == sizes


def test_upload_log(loaded):
    _, wh, _, _ = loaded
    rows = wh.read("upload_log").orderBy("upload_id").collect()
    assert [(r["upload_id"], r["source_filename"], r["data_hash"]) for r in rows] == [
        (i + 1, f"{n}.xlsm", HASHES[n]) for i, n in enumerate(sorted(SHEETS))
    ]
    assert {r["rows_extracted"] for r in rows} == {1}


def test_versions_close_each_other(loaded):
    _, wh, _, _ = loaded
    rows = reads.company_versions(wh.read("dim_company"), "Company A").collect()
    assert [r["company_id"] for r in rows] == [1, 2]
    assert rows[0]["valid_to"] == rows[1]["valid_from"] and rows[1]["valid_to"] is None
    assert [r["is_current"] for r in rows] == [False, True]
    assert rows[0]["business_year_end_month"] == 12


def test_audit_finds_nothing(loaded):
    _, wh, _, _ = loaded
    bad = warehouse_audit(wh).filter("violations > 0").collect()
    assert bad == []


def test_run_state(loaded):
    _, wh, _, _ = loaded
    rows = reads.run_history(wh.read("pipeline_run_state")).collect()
    assert [(r["dag_run_id"], r["status"], r["files_loaded"]) for r in rows] == [
        ("run-2", "success", 0), ("run-1", "success", 4)
    ]


def test_reads(loaded):
    root, wh, _, _ = loaded
    dim, fact, log, hist, risk, meth = tables(
        wh, "dim_company", "fact_ratings", "upload_log", "fact_scope_credit_hist",
        "dim_company_industry_risk", "dim_company_rating_methodology",
    )
    assert [r["entity_name"] for r in reads.current_companies(dim).collect()] == ["Company A", "Company B"]
    assert reads.company(dim, "Company B").first()["currency"] == "CHF"
    assert reads.company(dim, "Nobody").count() == 0
    with pytest.raises(reads.NotFound):
        reads.company(dim, "Nobody", strict=True)

    assert [r["snapshot_id"] for r in reads.latest_snapshots(fact, dim).collect()] == [2, 4]
    both = reads.compare_companies(fact, dim, " Company A ,, Company B")
    assert [r["snapshot_id"] for r in both.collect()] == [2, 4]
    first_load = log.agg(F.min("loaded_at_utc")).first()[0].astimezone(timezone.utc)
    past = reads.compare_companies(fact, dim, "Company A,Company B", first_load)
    assert [r["snapshot_id"] for r in past.collect()] == [1]
    with pytest.raises(ValueError):
        reads.compare_companies(fact, dim, " , ")

    ids = lambda df: sorted(r["snapshot_id"] for r in df.collect())
    assert ids(reads.snapshots(fact, dim)) == [1, 2, 3, 4]
    assert ids(reads.snapshots(fact, dim, currency="eur")) == [1, 2]
    assert ids(reads.snapshots(fact, dim, sector="auto%parts")) == [3, 4]
    assert ids(reads.snapshots(fact, dim, country="GERMANY", company_id=2)) == [2]
    assert ids(reads.snapshots(fact, dim, to_date=first_load)) == [1]
    assert ids(reads.snapshots(fact, dim, from_date=first_load + timedelta(microseconds=1))) == [2, 3, 4]
    assert reads.snapshot(fact, dim, 3).first()["liquidity"] == "+1 notch"

    history = reads.metric_history(hist, dim, "Company A").collect()
    assert len(history) == 120
    assert history == sorted(history, key=lambda r: (r["metric_name"], r["year"], r["upload_id"]))
    assert {r["metric_value_num"] is None for r in history if r["metric_value"] == "No data"} == {True}

    stats = reads.upload_stats(log, fact, dim).first()
    assert (stats["total_uploads"], stats["unique_files"], stats["unique_companies"], stats["unique_entities"]) == (4, 4, 4, 2)
    detail = reads.upload_details(log, fact, dim, 1).first()
    assert [s["snapshot_id"] for s in detail["snapshots"]] == [1]
    assert reads.upload_details(log, fact, dim).count() == 4

    weights = [tuple(r) for r in reads.current_risk_weights(risk, dim).collect()]
    assert [(w[0], float(w[2])) for w in weights] == [("Company A", 1.0), ("Company B", 0.75), ("Company B", 0.25)]
    assert reads.current_methodologies(meth, dim).count() == 2
    assert reads.all_scores(fact, dim).count() == 4
    assert reads.metric_series(hist, dim, "Company B").count() == 120
    assert reads.version_history(dim, "Company B").count() == 2
    assert reads.company_overview(dim).count() == 2
    assert reads.upload_overview(log).count() == 4
    assert [r["upload_id"] for r in reads.uploads(log).collect()] == [4, 3, 2, 1]
    assert {r["company_id"]: len(r["risks"]) for r in reads.version_risks(risk).collect()} == {1: 1, 2: 1, 3: 2, 4: 2}
    assert {r["company_id"]: len(r["methodologies"]) for r in reads.version_methodologies(meth).collect()} == {1: 2, 2: 1, 3: 1, 4: 1}

    files = list_files(wh.spark, str(root / "in"), "*_1.xlsm").withColumn("source_filename", file_name(F.col("path")))
    found = {r["upload_id"]: r["status"] for r in reads.upload_file(log, files).collect()}
    assert found == {1: "found", 2: "missing_file", 3: "found", 4: "missing_file"}
    assert reads.upload_file(log, files, 99).count() == 0


def touch(path, content):
    """Write a file so that its time is after everything before."""
    path.write_bytes(content)
    later = time.time() + 2
    os.utime(path, (later, later))


def test_later_runs(spark, tmp_path):
    """Unchanged attributes keep the version, a revert is skipped, a bad record halts."""
    root, folder = str(tmp_path / "wh"), tmp_path / "in"
    write_workbooks(folder, ["corporates_A_1", "corporates_B_1"])
    run_batch(spark, root, str(folder), "r1")
    wh = Warehouse(spark, root)

    # only a score changes: new rating, same version
    score = A_1 | {17: ["Business risk profile", "A"]}
    touch(folder / "corporates_A_3.xlsm", workbook(score))
    # the same content under another name: skipped
    touch(folder / "corporates_B_9.xlsm", workbook(B_1))
    result = run_batch(spark, root, str(folder), "r2")
    assert (result.staged, result.loaded, result.skipped) == (2, 1, 1)
    assert wh.read("dim_company").count() == 2
    facts = wh.read("fact_ratings").orderBy("rating_id").collect()
    assert [(r["rating_id"], r["company_id"]) for r in facts] == [(1, 1), (2, 2), (3, 1)]

    # tracked attribute changes twice in one batch: two more versions
    touch(folder / "corporates_A_4.xlsm", workbook(A_1 | {12: ["Country of origin", "X"]}))
    touch(folder / "corporates_A_5.xlsm", workbook(score | {12: ["Country of origin", "Y"]}))
    os.utime(folder / "corporates_A_3.xlsm", (1, 1))
    os.utime(folder / "corporates_B_9.xlsm", (1, 1))
    result = run_batch(spark, root, str(folder), "r3")
    assert (result.staged, result.loaded) == (2, 2)
    versions = reads.company_versions(wh.read("dim_company"), "Company A").collect()
    assert [(r["country"], r["is_current"]) for r in versions] == [
        ("Federal Republic of Germany", False), ("X", False), ("Y", True)
    ]
    assert versions[1]["valid_to"] == versions[2]["valid_from"]
    assert [r.violations for r in warehouse_audit(wh).filter("violations > 0").collect()] == []

    # back to the first content: seen before, so it is not loaded
    for name in ("corporates_A_4", "corporates_A_5"):
        os.utime(folder / f"{name}.xlsm", (1, 1))
    touch(folder / "corporates_A_6.xlsm", workbook(A_1))
    result = run_batch(spark, root, str(folder), "r4")
    assert (result.staged, result.loaded, result.skipped) == (1, 0, 1)

    # one bad record halts the whole batch and nothing of it shows
    os.utime(folder / "corporates_A_6.xlsm", (1, 1))
    touch(folder / "corporates_C_1.xlsm", workbook(B_1 | {1: ["Rated entity", "Company C"]}))
    touch(folder / "corporates_C_2.xlsm", workbook(B_1 | {11: ["Reporting Currency/Units", "chf"]}))
    with pytest.raises(QualityGateError):
        run_batch(spark, root, str(folder), "r5")
    assert wh.read("upload_log").count() == 5
    state = {r["dag_run_id"]: r["status"] for r in wh.read("pipeline_run_state").collect()}
    assert state == {"r1": "success", "r2": "success", "r3": "success", "r4": "success", "r5": "failed"}

    # an empty sheet is a record too, and fails the checks
    os.remove(folder / "corporates_C_2.xlsm")
    touch(folder / "corporates_D_1.xlsm", workbook({}))
    with pytest.raises(QualityGateError):
        run_batch(spark, root, str(folder), "r6")

    # the same run id again resets its row, and now succeeds
    os.remove(folder / "corporates_D_1.xlsm")
    result = run_batch(spark, root, str(folder), "r5")
    assert result.loaded == 1
    rows = [r for r in wh.read("pipeline_run_state").collect() if r["dag_run_id"] == "r5"]
    assert [(r["status"], r["run_id"]) for r in rows] == [("success", 5)]
    assert wh.watermark() <= datetime.now(timezone.utc)
    assert wh.watermark("started_at_utc") <= wh.watermark()
