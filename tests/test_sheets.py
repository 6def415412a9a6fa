"""Workbook to sheet rows to record to content hash."""

import pytest
from pyspark.sql import functions as F

from tests.sheets import A_1, B_1, HASHES, SHEETS, workbook, write_workbooks
from tidemark.operators.kvsheet import parse_records
from tidemark.plans.ratings import normalise
from tidemark.sources.files import list_files, modified_since
from tidemark.sources.sheet_csv import read_sheet_csv, reload_sheet_csv, write_sheet_csv
from tidemark.sources.workbook import read_sheets, sheet_rows_from_cells


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("books")
    write_workbooks(path)
    (path / "notes.txt").write_text("not a workbook")
    return path


@pytest.fixture(scope="module")
def sheets(spark, folder):
    return read_sheets(modified_since(spark, str(folder), None)).cache()


def stored(spark, df, path):
    """As a run does it: records are written once and read back."""
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.fixture(scope="module")
def raw(spark, sheets, tmp_path_factory):
    return stored(spark, parse_records(sheets), tmp_path_factory.mktemp("raw") / "records")


@pytest.fixture(scope="module")
def records(raw):
    return {r["source_filename"]: r for r in raw.collect()}


def hashes(raw):
    rows = normalise(raw.withColumn("file_modified_at", F.current_timestamp()))
    return {r[0]: r[1] for r in rows.select("source_filename", "data_hash").collect()}


def test_staging_is_strict_and_skips_other_files(spark, folder):
    files = modified_since(spark, str(folder), None)
    assert files.count() == 4
    newest = files.agg(F.max("modificationTime")).first()[0]
    assert modified_since(spark, str(folder), newest).count() == 0


def test_one_row_per_non_empty_sheet_row(sheets):
    counts = {r[0]: r[1] for r in sheets.groupBy("source_filename").count().collect()}
    assert counts == {f"{n}.xlsm": 31 for n in SHEETS}


def test_fields(records):
    a, b = records["corporates_A_1.xlsm"], records["corporates_B_1.xlsm"]
    assert a["rated_entity"] == "Company A" and b["rated_entity"] == "Company B"
    assert a["methodology_2"] == "Consumer Products Rating Methodology"
    assert records["corporates_A_2.xlsm"]["methodology_2"] is None
    assert (a["industry_weight_1"], a["industry_weight_2"]) == (1.0, None)
    assert (b["industry_weight_1"], b["industry_weight_2"]) == (0.15, 0.85)
    assert a["liquidity_adjustment"] == "-2 notches" and b["liquidity_adjustment"] == "+1 notch"
    assert a["sector_specific_factor_2"] is None


def test_series(records):
    metrics = records["corporates_A_1.xlsm"]["scope_credit_metrics"]
    assert len(metrics) == 6
    years = [str(y) for y in range(2018, 2025)] + ["2025E", "2026E", "2027E"]
    assert all(sorted(m) == years for m in metrics.values())
    assert metrics["Scope-adjusted loan/value"]["2023"]["text"] == "No data"
    assert metrics["Liquidity (time-series)"]["2018"]["text"] == "4.862"


def test_content_hashes(raw):
    assert hashes(raw) == {f"{n}.xlsm": h for n, h in HASHES.items()}


def test_csv_round_trip(spark, sheets, tmp_path):
    out = str(tmp_path / "csv")
    write_sheet_csv(sheets, out)
    again = reload_sheet_csv(spark, out)
    assert again.count() == 4 * 31
    assert hashes(stored(spark, parse_records(again), tmp_path / "records")) == HASHES


def test_csv_flat_files(spark, tmp_path):
    (tmp_path / "x_1_master.csv").write_text('1,,Rated entity, "Acme, Inc" ,,,,,,,,,,\n2,,Industry weight,1,,,,,,,,,,\n')
    (tmp_path / "x_2_master.csv").write_text('1,,Rated entity,Other,,,,,,,,,,\n')
    rows = {r["source_filename"]: r for r in parse_records(read_sheet_csv(spark, str(tmp_path))).collect()}
    assert set(rows) == {"x_1", "x_2"}
    assert rows["x_2"]["rated_entity"] == "Other"
    assert rows["x_1"]["industry_weight_1"] == 1.0


def test_inline_strings_give_the_same_rows(spark, tmp_path):
    (tmp_path / "a.xlsm").write_bytes(workbook(A_1))
    (tmp_path / "b.xlsm").write_bytes(workbook(A_1, inline=True))
    rows = read_sheets(modified_since(spark, str(tmp_path), None))
    by_file = rows.groupBy("row_idx", "cells").count()
    assert {r["count"] for r in by_file.collect()} == {2}


def test_missing_sheet_fails(spark, tmp_path):
    (tmp_path / "a.xlsm").write_bytes(workbook(A_1, name="OTHER"))
    with pytest.raises(Exception, match="no sheet named MASTER"):
        read_sheets(modified_since(spark, str(tmp_path), None)).collect()


def test_last_row_wins_and_odd_cells(spark, tmp_path):
    sheet = {
        0: ["Rated entity", "  first "],
        3: ["Rated entity", " second\t"],
        4: ["Country of origin", "N/A"],
        5: ["Industry weight", "abc", "0.5"],
        6: ["Leverage", True],
        7: ["Liquidity", "+1 notch"],
        8: ["Liquidity", 1, 2],
        9: ["Liquidity", 7, 8],
        10: ["[Scope Credit Metrics]", 2020, "2021E", None, 2023],
        11: ["Scope-adjusted FFO/debt", 1.5, "  "],
        12: ["Scope-adjusted FFO/debt", 2.5, "Locked", 3],
        13: [None, "no label"],
    }
    (tmp_path / "a.xlsm").write_bytes(workbook(sheet))
    row = parse_records(read_sheets(modified_since(spark, str(tmp_path), None))).first()
    assert row["rated_entity"] == "second"
    assert row["country"] is None
    assert (row["industry_weight_1"], row["industry_weight_2"]) == (None, 0.5)
    assert row["leverage"] == "True"
    assert row["liquidity_adjustment"] == "+1 notch"
    metrics = {m: {y: c and c["text"] for y, c in s.items()} for m, s in row["scope_credit_metrics"].items()}
    assert metrics == {
        "Scope-adjusted FFO/debt": {"2020": "2.5", "2021E": "Locked"},
        "Liquidity (time-series)": {"2020": "1", "2021E": "2"},
    }


def test_repeated_year_keeps_the_last(spark, tmp_path):
    sheet = {0: ["[Scope Credit Metrics]", 2020, 2020], 1: ["Scope-adjusted FFO/debt", 1, 2]}
    (tmp_path / "a.xlsm").write_bytes(workbook(sheet))
    row = parse_records(read_sheets(modified_since(spark, str(tmp_path), None))).first()
    assert {y: c["text"] for y, c in row["scope_credit_metrics"]["Scope-adjusted FFO/debt"].items()} == {"2020": "2"}


def test_no_header_no_series(spark, tmp_path):
    (tmp_path / "a.xlsm").write_bytes(workbook({k: v for k, v in B_1.items() if k != 34}))
    row = parse_records(read_sheets(modified_since(spark, str(tmp_path), None))).first()
    assert row["scope_credit_metrics"] == {}


def test_long_cells_give_the_same_rows(raw, sheets):
    cells = sheets.select(
        "source_filename", "row_idx", F.posexplode("cells").alias("col_idx", "c")
    ).select("source_filename", "row_idx", "col_idx", "c.kind", "c.text")
    again = parse_records(sheet_rows_from_cells(cells))
    by_name = lambda r: r["source_filename"]
    assert sorted(again.collect(), key=by_name) == sorted(raw.collect(), key=by_name)


def test_content_is_read_only_when_used(spark, folder):
    plan = list_files(spark, str(folder)).select("path")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_wide_rows_and_rewrites(spark, tmp_path):
    """Rows wider than usual keep all cells, and writing a sheet again replaces it."""
    out = str(tmp_path / "wide")
    cells = lambda n: [("s", f"c{i}") if i % 3 else None for i in range(n)]
    schema = "source_filename string, row_idx int, cells array<struct<kind: string, text: string>>"
    first = spark.createDataFrame([("a.xlsm", 1, cells(20)), ("a.xlsm", 2, cells(3)), ("b.xlsm", 1, cells(2))], schema)
    again = spark.createDataFrame([("a.xlsm", 1, cells(25))], schema)
    write_sheet_csv(first, out)
    write_sheet_csv(again, out)
    found = {(r.source_filename, r.row_idx): r.cells for r in reload_sheet_csv(spark, out).collect()}
    assert sorted(found) == [("a", 1), ("b", 1)]
    assert [c and c.text for c in found["a", 1]][:25] == [c and c[1] for c in cells(25)]
    with pytest.raises(ValueError, match="25 cells"):
        write_sheet_csv(again, out, width=13)


def test_csv_of_many_sheets_is_a_few_files(spark, tmp_path):
    out = tmp_path / "csv"
    cell = "array(named_struct('kind', 's', 'text', concat('v{}, ', id)))"
    sheets = spark.range(300).selectExpr("concat('s', id, ',.xlsm') AS source_filename", "1 AS row_idx", cell.format(1) + " AS cells")
    unnamed = sheets.limit(1).selectExpr("CAST(NULL AS string) AS source_filename", "row_idx", "cells")
    write_sheet_csv(sheets.unionByName(unnamed), str(out))
    write_sheet_csv(sheets.filter("source_filename < 's2'").selectExpr(
        "source_filename", "row_idx", "transform(cells, c -> named_struct('kind', c.kind, 'text', replace(c.text, 'v1', 'v2'))) AS cells"
    ), str(out))
    assert len(list(out.rglob("*.csv"))) < 60
    found = {r.source_filename: r.cells[0].text for r in reload_sheet_csv(spark, str(out)).collect()}
    expected = {f"s{i},": f"v{2 if f's{i}' < 's2' else 1}, {i}" for i in range(300)}
    assert found == expected | {None: "v1, 0"}


def test_rows_of_a_sheet_meet_before_they_are_sorted(spark):
    cells = "array(NULL, named_struct('kind', 's', 'text', 'Rated entity'), named_struct('kind', 's', 'text', concat('n', id)))"
    rows = spark.range(20).selectExpr("concat(id % 5, '.xlsm') AS source_filename", "CAST(id AS int) AS row_idx", f"{cells} AS cells")
    records = parse_records(rows)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    # aggregates print above what they read: none stands below the exchange of the rows
    assert "SortAggregate" not in plan.split("REPARTITION_BY_COL")[1]
    assert {r.source_filename: r.rated_entity for r in records.collect()} == {f"{i}.xlsm": f"n{i + 15}" for i in range(5)}
