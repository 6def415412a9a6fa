"""Ordered operations give the same result whether or not heavy keys are split."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import latest, scd2
from tidemark.operators.latest import as_of_dates, as_of_join
from tidemark.operators.ordered import CHUNK, OrderedGroups, dense_ids, position_in
from tidemark.operators.reshape import nest_children


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """4000 rows: one key holds more than a third, another is null, many are small."""
    rng = random.Random(5)
    rows = []
    for i in range(4000):
        key = "hot" if i % 5 < 2 else (None if i % 5 == 2 else f"k{rng.randrange(300)}")
        # few distinct times, so that the tie-break decides often
        rows.append((key, rng.randrange(40), i, rng.choice("aab"), rng.choice([None, 1, 2])))
    path = str(tmp_path_factory.mktemp("skew") / "t")
    spark.createDataFrame(rows, "key string, t int, id int, tag string, v int").write.parquet(path)
    return spark.read.parquet(path)


def brute(df):
    groups = {}
    for r in sorted(df.collect(), key=lambda r: (r["t"], r["id"])):
        groups.setdefault(r["key"], []).append(r)
    return groups


def test_heavy_keys_are_split_and_the_rest_is_not(skewed):
    groups = OrderedGroups(skewed, ["key"], ["t", "id"], max_rows=150)
    assert groups.split
    sizes = groups.df.groupBy("key", CHUNK).count().collect()
    hot = [r["count"] for r in sizes if r["key"] == "hot"]
    assert len(hot) > 3 and max(hot) < 1000 and sum(hot) == 1600
    assert {r[CHUNK] for r in sizes if r["key"] and r["key"] != "hot"} == {None}
    assert groups.df.count() == 4000


def test_without_heavy_keys_nothing_is_split(skewed):
    groups = OrderedGroups(skewed, ["key"], ["t", "id"])
    assert not groups.split and CHUNK not in groups.df.columns


def test_more_heavy_keys_than_shuffle_partitions(spark):
    """Every heavy key is cut, however many there are; the estimate of an exploded input is not asked."""
    rows = spark.range(24).select(F.col("id").alias("key"), F.explode(F.sequence(F.lit(1), F.lit(500))).alias("t"))
    groups = OrderedGroups(rows, ["key"], ["t"], max_rows=100)
    sizes = groups.df.groupBy("key", CHUNK).count().collect()
    assert max(r["count"] for r in sizes) < 300
    assert {r["key"] for r in sizes} == set(range(24)) and all(r[CHUNK] is not None for r in sizes)
    numbered = groups.add(groups.df, no=groups.number(), before=groups.lag(F.col("t")))
    assert numbered.filter("no <> t OR before.v <> t - 1 OR (before IS NULL AND t > 1)").count() == 0
    assert numbered.count() == 12_000


def test_no_hint_forces_a_broadcast(skewed):
    groups = OrderedGroups(skewed, ["key"], ["t", "id"], max_rows=150)
    plan = groups.add(groups.df, no=groups.number())._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan.lower()


@pytest.mark.parametrize("max_rows", [None, 150, 37])
def test_lag_lead_number_and_carry(skewed, max_rows):
    groups = OrderedGroups(skewed, ["key"], ["t", "id"], max_rows)
    df = groups.add(groups.df, before=groups.lag(F.col("v")), after=groups.lead(F.col("id")))
    df = groups.add(df, no=groups.number(), known=groups.last_known(F.col("v")))
    df = groups.done(df)
    found = {r["id"]: (r["before"] and r["before"]["v"], r["before"] is None,
                       r["after"] and r["after"]["v"], r["no"], r["known"]) for r in df.collect()}
    expected = {}
    for rows in brute(skewed).values():
        known = None
        for i, r in enumerate(rows):
            known = r["v"] if r["v"] is not None else known
            before = rows[i - 1] if i else None
            after = rows[i + 1] if i + 1 < len(rows) else None
            expected[r["id"]] = (before and before["v"], before is None, after and after["id"], i + 1, known)
    assert found == expected


@pytest.mark.parametrize("max_rows", [None, 150])
def test_versions(skewed, max_rows):
    found = scd2.versions(skewed, ["key"], ["t", "id"], ["tag", "v"], ["id"], max_rows)
    got = {r["id"]: (r["version_no"], r["valid_from"], r["valid_to"], r["is_current"]) for r in found.collect()}
    expected = {}
    for rows in brute(skewed).values():
        starts = [r for i, r in enumerate(rows) if i == 0 or (r["tag"], r["v"]) != (rows[i - 1]["tag"], rows[i - 1]["v"])]
        for i, r in enumerate(starts):
            last = i + 1 == len(starts)
            expected[r["id"]] = (i + 1, r["t"], None if last else starts[i + 1]["t"], last)
    assert got == expected


@pytest.mark.parametrize("max_rows", [None, 150])
def test_continued_versions_equal_one_pass(skewed, max_rows):
    args = (["key"], ["t", "id"], ["tag", "v"])
    whole = scd2.assign_versions(skewed, *args, F.col("id"), "version", max_rows)
    early, late = skewed.filter("t < 20"), skewed.filter("t >= 20")
    open_versions = scd2.current(scd2.versions(early, *args, ["id"], max_rows)).withColumnRenamed("id", "version")
    continued = scd2.continue_versions(late, open_versions, *args, "id", "version", max_rows)
    columns = ["id", "version", "starts_version"]
    key = lambda r: r["id"]
    # null keys have no open version to continue: an entity is known by its name
    expected = whole.filter("t >= 20 AND key IS NOT NULL").select(columns).collect()
    got = continued.filter("key IS NOT NULL").select(columns).collect()
    assert sorted(got, key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("max_rows", [None, 150])
def test_as_of_join(skewed, max_rows):
    facts = skewed.filter("tag = 'b'").select("key", "t", "id", F.col("id").alias("fact"))
    found = as_of_join(skewed, facts, ["key"], ["t", "id"], ["t", "id"], ["fact"], max_rows)
    expected = {}
    for rows in brute(skewed).values():
        for r in rows:
            seen = [f for f in rows if f["tag"] == "b" and f["t"] <= r["t"]]
            expected[r["id"]] = max(seen, key=lambda f: (f["t"], f["id"]))["id"] if seen else None
    assert {r["id"]: r["fact"] for r in found.collect()} == expected
    assert found.columns == [*skewed.columns, "fact"]


@pytest.mark.parametrize("compared", [64, 2])
def test_as_of_dates(skewed, monkeypatch, compared):
    monkeypatch.setattr(latest, "_COMPARED_ONE_BY_ONE", compared)
    dates = [-1, 10, 11, 25, 99]
    found = as_of_dates(skewed, ["key"], ["t", "id"], dates)
    expected = set()
    for key, rows in brute(skewed).items():
        for d in dates:
            seen = [r for r in rows if r["t"] <= d]
            if seen:
                expected.add((key, d, seen[-1]["id"]))
    assert {(r["key"], r["as_of"], r["id"]) for r in found.collect()} == expected


@pytest.mark.parametrize("max_rows", [None, 300])
def test_dense_ids(skewed, max_rows):
    rows = dense_ids(skewed, ["t", "id"], "n", 7, max_rows).collect()
    by_order = sorted(rows, key=lambda r: (r["t"], r["id"]))
    assert [r["n"] for r in by_order] == list(range(8, 4008))


@pytest.mark.parametrize(("page_rows", "max_rows"), [(10_000, None), (100, None), (100, 150)])
def test_nested_children_are_complete_and_bounded(spark, skewed, page_rows, max_rows):
    parents = spark.createDataFrame([("hot",), ("k1",), ("none",)], "key string")
    nested = nest_children(parents, skewed, "key", ["t", "id"], ["id"], "ids", page_rows, max_rows)
    pages = {}
    for r in nested.collect():
        pages.setdefault(r["key"], {})[r["page"]] = [c["id"] for c in r["ids"]]
    groups = brute(skewed)
    for key in ("hot", "k1"):
        assert sorted(pages[key]) == list(range(len(pages[key])))
        assert all(len(p) <= page_rows for p in pages[key].values())
        flat = [i for n in sorted(pages[key]) for i in pages[key][n]]
        assert flat == [r["id"] for r in groups[key]]
    assert pages["none"] == {0: []}


def test_one_exchange_for_a_whole_version_history(skewed):
    plan = scd2.versions(skewed, ["key"], ["t", "id"], ["tag"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65])
def test_position_in(spark, n):
    bounds = [i * 2 for i in range(n)]
    values = list(range(-2, 2 * n + 2))
    df = spark.createDataFrame([(v,) for v in values], "v int")
    array = F.array(*[F.lit(b) for b in bounds])
    rows = df.select("v", position_in(array, n, F.col("v")).alias("a"), position_in(array, F.size(array), F.col("v")).alias("b"))
    for r in rows.collect():
        expected = sum(b <= r["v"] for b in bounds)
        assert (r["a"], r["b"]) == (expected, expected)


def test_dense_ids_of_a_table_come_from_several_tasks(spark):
    rows = spark.range(120_000).selectExpr("id", "reverse(CAST(id AS string)) AS k")
    found = dense_ids(rows, ["k", "id"], "n", 7).withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in found}) > 1
    expected = sorted((str(i)[::-1], i) for i in range(120_000))
    assert sorted((r.n, r.k, r.id) for r in found) == [(8 + at, *pair) for at, pair in enumerate(expected)]
