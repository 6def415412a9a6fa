"""De-duplication, audits, lookups, filters and streams on small fixtures."""

from datetime import datetime

from pyspark.sql import functions as F

from tests.sheets import B_1, workbook, write_workbooks
from tidemark.operators import audit, dedup, filters, kvsheet, lookup, reshape
from tidemark.operators.latest import first_occurrences, latest_per_key, latest_with_parent, nth_occurrence
from tidemark.operators.scd2 import sorted_named_weights, sorted_names
from tidemark.sources.warehouse import Warehouse, run_state
from tidemark.streaming.ingest import distinct_stream, ingest_new_files, stream_table


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_new_content_and_status(spark):
    batch = spark.createDataFrame([("b", "h1"), ("a", "h1"), ("c", "h2"), ("d", "h3"), ("e", None), ("f", None)], "name string, h string")
    history = spark.createDataFrame([("h2",)], "h string")
    assert rows(dedup.new_content(batch, history, ["h"], ["name"]), "name") == [("a",), ("d",), ("e",)]
    status = dedup.load_status(batch, history, ["h"], ["name"], ["name"])
    assert {n for n, s in rows(status, "name", "status") if s == "loaded"} == {"a", "d", "e"}
    assert status.count() == 6


def test_one_hot_content_shrinks_before_the_shuffle(spark):
    batch = spark.range(1000).select("id", (F.col("id") % 1).alias("h"))
    plan = dedup.new_content(batch, None, ["h"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange hashpartitioning")[1]


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([(1, "a")], "k int, v string")
    incoming = spark.createDataFrame([(1, "b"), (2, "c"), (2, "c")], "k int, v string")
    assert rows(dedup.insert_if_absent(incoming, existing, ["k"]), "k", "v") == [(2, "c")]


def test_latest(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, None, 3), (None, 1, 4), (None, 2, 5)], "k int, t int, id int")
    assert rows(latest_per_key(df, ["k"], ["t", "id"]), "id") == [(3,), (5,)]  # nulls sort first when descending
    assert rows(nth_occurrence(df, ["k"], ["id"], 2), "id") == [(2,), (5,)]
    assert rows(first_occurrences(df, ["k"], ["id"], 2, "n"), "id", "n") == [(1, 1), (2, 2), (4, 1), (5, 2)]
    many = spark.range(3000).select((F.col("id") % 1500 > 0).alias("k"), "id")
    assert rows(nth_occurrence(many, ["k"], ["id"], 1001, max_rows=400), "id") == [(1001,)]  # ids 1, 2, ...
    parents = spark.createDataFrame([(1, "x")], "k int, name string")
    found = latest_with_parent(df, parents, "k", "name", ["t", "id"])
    assert rows(found, "name", "id") == [("x", 3), (None, 5)]


def test_sorted_lists(spark):
    df = spark.createDataFrame([("b", 0.4, "a", 0.6), ("a", 0.5, "a", 0.5), (None, 1.0, "", None)], "n1 string, w1 double, n2 string, w2 double")
    pairs = [(F.col("n1"), F.col("w1")), (F.col("n2"), F.col("w2"))]
    lists = [[(p["name"], float(p["weight"])) for p in r[0]] for r in df.select(sorted_named_weights(pairs)).collect()]
    assert lists == [[("a", 0.6), ("b", 0.4)], [("a", 0.5)], []]
    assert [r[0] for r in df.select(sorted_names([F.col("n1"), F.col("n2")])).collect()] == [["a", "b"], ["a"], []]


def test_reshape(spark):
    df = spark.createDataFrame([(1, "a", 0.1, None, 0.2), (2, "", 0.3, "b", None)], "id int, n1 string, w1 double, n2 string, w2 double")
    slots = [(F.col("n1"), F.col("w1")), (F.col("n2"), F.col("w2"))]
    assert rows(reshape.numbered_columns_to_rows(df, ["id"], slots, ["n", "w"]), "id", "n", "w") == [(1, "a", 0.1), (2, "b", None)]
    m = spark.createDataFrame([(1, {"x": {"2020": "1", "2021": None}, "y": {}})], "id int, m map<string,map<string,string>>")
    found = reshape.nested_map_to_rows(m, ["id"], F.col("m"), "metric", "year", "value")
    assert rows(found, "metric", "year", "value") == [("x", "2020", "1"), ("x", "2021", None)]


def test_strip_cells_drops_empty_rows(spark):
    cell = "struct<kind:string,text:string>"
    df = spark.createDataFrame(
        [("f", 0, [None, ("s", " a\t"), ("n", "1")]), ("f", 5, [None, None])],
        f"source_filename string, row_idx int, cells array<{cell}>",
    )
    found = kvsheet.strip_cells(df).collect()
    assert [(r["row_idx"], [c and tuple(c) for c in r["cells"]]) for r in found] == [(0, [None, ("s", "a"), ("n", "1")])]


def test_audit(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, 5, "x"), (1, 5, "x"), (9, None, ""), (None, 7, None)], "pid int, w int, s string")
    c = audit.Constraints(
        not_null=["w"], unique=[["pid", "w"]], checks={"w small": F.col("w") < 6, "s": F.col("s") != ""},
        foreign_keys=[("pid", "parent", "id")],
    )
    found = audit.constraint_audit({"parent": parent, "child": child}, {"child": c})
    assert rows(found, "constraint", "violations") == [
        ("CHECK s", 1), ("CHECK w small", 1), ("FOREIGN KEY pid -> parent.id", 1), ("NOT NULL w", 1), ("UNIQUE pid, w", 1)
    ]
    assert rows(audit.orphans(child, parent, "pid", "id"), "pid", "n") == [(9, 1)]
    counted = parent.withColumn("n", F.lit(2).cast("long"))
    assert rows(audit.reconcile_counts(counted, child.withColumnRenamed("pid", "id"), "id", "n"), "id", "actual") == [(2, 0)]
    assert tuple(audit.total_and_distinct(child, "w").first()) == (4, 2)


def test_left_join_totals_equal_the_plain_join(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, f string")
    children = spark.createDataFrame([(1, 7), (1, 7), (1, 8), (2, 7)], "id int, c int")
    measures = [F.count_distinct("f").alias("f")]
    found = lookup.left_join_totals(parents, children, "id", "c", measures, "n", "c").first()
    joined = parents.join(children, "id", "left")
    assert (found["n"], found["f"], found["c"]) == (joined.count(), 2, 2)
    assert lookup.left_join_totals(parents.filter("id > 9"), children, "id", "c", measures, "n", "c").first()["n"] == 0


def test_filters(spark):
    df = spark.createDataFrame([(1, "EUR"), (2, "CHF"), (None, None)], "id int, cur string")
    assert filters.all_given(df, [None]).count() == 3
    assert rows(filters.all_given(df, [filters.equals_upper("cur", "chf"), filters.equals("id", 2)]), "id") == [(2,)]
    assert [r["id"] for r in df.orderBy(*filters.ascending("id")).collect()] == [1, 2, None]
    assert [r["id"] for r in df.orderBy(*filters.descending("id")).collect()] == [None, 2, 1]


def test_date_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.timestamp_seconds("id").alias("t"), "id").write.parquet(path)
    low, high = datetime(1970, 1, 1, 0, 0, 2), datetime(1970, 1, 1, 0, 0, 4)
    df = filters.all_given(spark.read.parquet(path), [filters.at_least("t", low), filters.at_most("t", high)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t" in plan and "LessThanOrEqual(t" in plan
    assert df.count() == 3


def test_run_state(spark):
    t = lambda s: datetime(2024, 1, 1, 0, 0, s)
    events = spark.createDataFrame(
        [("r1", t(1), None, "running"), ("r1", t(1), t(1), "success"), ("r2", t(2), None, "running")],
        "dag_run_id string, event_at timestamp, completed_at_utc timestamp, status string",
    )
    assert rows(run_state(events), "dag_run_id", "status") == [("r1", "success"), ("r2", "running")]


def test_distinct_stream_over_several_runs(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "h string"
    for batch in (["a", "a", "b"], ["b", "c"], ["a", "d", "d"]):
        spark.createDataFrame([(x,) for x in batch], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        distinct_stream(stream, ["h"], out, check).awaitTermination()
    assert rows(spark.read.parquet(out), "h") == [("a",), ("b",), ("c",), ("d",)]


def test_stream_table_reads_one_table(spark, tmp_path):
    (tmp_path / "t").mkdir()
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "raw"))
    part = next((tmp_path / "raw").glob("*.parquet"))
    (tmp_path / "t" / "x.parquet").write_bytes(part.read_bytes())
    (tmp_path / "t" / "y.parquet").write_text("not read")
    stream = stream_table(spark, str(tmp_path / "t"), "x", spark.range(1).schema)
    distinct_stream(stream, ["id"], str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3


def test_stream_ingest(spark, tmp_path):
    """New files are loaded once; a copy under another name is skipped by its content."""
    root, folder, check = str(tmp_path / "wh"), tmp_path / "in", str(tmp_path / "check")
    write_workbooks(folder, ["corporates_A_1", "corporates_B_1"])
    ingest_new_files(spark, root, str(folder), check).awaitTermination()
    wh = Warehouse(spark, root)
    assert wh.read("upload_log").count() == 2
    write_workbooks(folder, ["corporates_A_2"])
    (folder / "copy.xlsm").write_bytes(workbook(B_1))
    ingest_new_files(spark, root, str(folder), check).awaitTermination()
    assert rows(wh.read("upload_log"), "source_filename") == [("corporates_A_1.xlsm",), ("corporates_A_2.xlsm",), ("corporates_B_1.xlsm",)]
    assert wh.read("dim_company").count() == 3
    state = rows(wh.read("pipeline_run_state"), "dag_run_id", "status", "files_loaded", "files_skipped")
    assert state == [("stream-0", "success", 2, 0), ("stream-1", "success", 1, 1)]
