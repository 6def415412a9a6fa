"""The checks of a record: one field changed at a time."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rules as R
from tidemark.plans.ratings import record_rules
from tidemark.schemas import EXPECTED_METRICS, RAW_RECORD

BASE = {
    "source_filename": "test.xlsm", "rated_entity": "Test Co", "sector": "Tech",
    "methodology_1": "General", "industry_risk_1": "Software", "industry_risk_score_1": "BBB",
    "industry_weight_1": 1.0, "segmentation_criteria": "Revenue", "currency": "EUR",
    "country": "Germany", "accounting_principles": "IFRS", "business_year_end": "December",
    "business_risk_profile": "BB", "liquidity_adjustment": "+1 notch", "scope_credit_metrics": {},
}
FULL = {m: {} for m in EXPECTED_METRICS}


@pytest.fixture(scope="module")
def check(spark):
    def run(*changes):
        rows = [
            tuple({**BASE, "source_filename": str(i), **c}.get(f.name) for f in RAW_RECORD.fields)
            for i, c in enumerate(changes)
        ]
        df = spark.createDataFrame(rows, RAW_RECORD)
        report = R.quality_report(df, ["source_filename"], record_rules())
        valid = df.select("source_filename", R.is_valid(record_rules()).alias("valid"))
        return [r.asDict(True) for r in report.join(valid, "source_filename").orderBy(F.col("source_filename").cast("int")).collect()]

    return run


def failed(row):
    return [(f["field"], f["rule"], f["severity"]) for f in row["failures"]]


COVERAGE = ("scope_credit_metrics", "metrics_coverage", "WARNING")

CASES = [
    ({}, True, []),
    ({"rated_entity": None}, False, [("rated_entity", "not_null", "CRITICAL")]),
    ({"rated_entity": "  "}, False, [("rated_entity", "not_null", "CRITICAL")]),
    ({"currency": "eur"}, False, [("currency", "iso3_format", "CRITICAL")]),
    ({"currency": "EU"}, False, [("currency", "iso3_format", "CRITICAL")]),
    ({"currency": "EURO"}, False, [("currency", "iso3_format", "CRITICAL")]),
    ({"currency": None}, False, [("currency", "iso3_format", "CRITICAL")]),
    ({"currency": "EUR\n"}, True, []),
    ({"business_year_end": "0"}, True, [("business_year_end", "valid_month", "WARNING")]),
    ({"business_year_end": "13"}, True, [("business_year_end", "valid_month", "WARNING")]),
    ({"business_year_end": "Quatember"}, True, [("business_year_end", "valid_month", "WARNING")]),
    ({"business_year_end": "12.0"}, True, [("business_year_end", "valid_month", "WARNING")]),
    ({"business_year_end": "JUNE"}, True, []),
    ({"business_year_end": "6"}, True, []),
    ({"industry_risk_score_1": "XYZ"}, True, [("industry_risk_score_1", "rating_scale", "WARNING")]),
    ({"leverage": "aaa"}, True, [("leverage", "rating_scale", "WARNING")]),
    ({"industry_weight_1": None}, False, [("industry_weight_1", "weight_range", "CRITICAL"), ("industry_weight", "weights_sum_to_one", "CRITICAL")]),
    ({"industry_weight_1": 1.2}, False, [("industry_weight_1", "weight_range", "CRITICAL"), ("industry_weight", "weights_sum_to_one", "CRITICAL")]),
    ({"industry_weight_1": float("nan")}, False, [("industry_weight_1", "weight_range", "CRITICAL"), ("industry_weight", "weights_sum_to_one", "CRITICAL")]),
    ({"industry_weight_1": 0.15, "industry_weight_2": 0.85, "industry_risk_2": "x"}, True, []),
    ({"industry_weight_1": 0.25, "industry_weight_2": 0.75, "industry_risk_2": "x"}, True, []),
    ({"industry_weight_1": 0.995}, True, []),
    ({"industry_weight_1": 1.5, "industry_weight_2": -0.5, "industry_risk_2": "x"}, False, [("industry_weight_1", "weight_range", "CRITICAL"), ("industry_weight_2", "weight_range", "CRITICAL")]),
    ({"liquidity_adjustment": "bad"}, True, [("liquidity_adjustment", "notch_format", "WARNING")]),
    ({"liquidity_adjustment": None}, True, [("liquidity_adjustment", "notch_format", "WARNING")]),
    ({"liquidity_adjustment": " -12 notches "}, True, []),
    ({"industry_risk_2": "x"}, True, [("industry_risk_2", "dual_risk_consistency", "WARNING")]),
    ({"industry_weight_1": 0.5, "industry_weight_2": 0.5}, True, [("industry_risk_2", "dual_risk_consistency", "WARNING")]),
    ({"accounting_principles": "UK GAAP"}, True, [("accounting_principles", "known_framework", "WARNING")]),
    ({"accounting_principles": " HGB "}, True, []),
    ({"accounting_principles": ""}, False, [("accounting_principles", "not_null", "CRITICAL")]),
    ({"scope_credit_metrics": None}, True, []),
]


def test_each_rule(check):
    for (change, valid, failures), row in zip(CASES, check(*[c for c, _, _ in CASES])):
        assert (row["valid"], failed(row)) == (valid, [*failures, COVERAGE]), change
        assert row["total_checks"] == 30


def test_report_numbers(check):
    good, bad, full = check({}, {"rated_entity": None, "currency": "x", "leverage": "?"}, {"scope_credit_metrics": FULL})
    assert (good["passed"], good["failed_critical"], good["failed_warning"]) == (29, 0, 1)
    assert (good["completeness_pct"], good["validity_pct"], good["status"]) == (100.0, 96.7, "WARNING")
    assert (bad["passed"], bad["failed_critical"], bad["failed_warning"]) == (26, 2, 2)
    assert (bad["completeness_pct"], bad["status"]) == (85.7, "FAILED")
    assert (full["passed"], full["validity_pct"], full["status"], full["failures"]) == (30, 100.0, "PASSED", [])


def messages(row):
    return {(f["field"], f["rule"]): f["message"] for f in row["failures"]}


def test_messages(check):
    part, weights, risk, weight = check(
        {"scope_credit_metrics": {k: FULL[k] for k in EXPECTED_METRICS[:4]}, "currency": "eu"},
        {"industry_weight_1": 0.5},
        {"industry_risk_2": "Cars"},
        {"industry_weight_1": 0.5, "industry_weight_2": 0.5},
    )
    assert messages(part)[COVERAGE[:2]] == (
        "4/6 metrics found, without Scope-adjusted debt/EBITDA, Scope-adjusted loan/value"
    )
    assert "'eu' is no three-letter currency code" in messages(part)["currency", "iso3_format"]
    assert messages(weights)["industry_weight", "weights_sum_to_one"] == "Industry weights add up to 0.5000, not to one"
    assert "'Cars' comes without" in messages(risk)["industry_risk_2", "dual_risk_consistency"]
    assert "industry_weight_2=0.5 stands without" in messages(weight)["industry_risk_2", "dual_risk_consistency"]


def test_gate_and_split(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, name string")
    rules = [R.not_null("name")]
    R.gate(df.filter("id = 1"), rules)
    R.gate(df, [R.not_null("name", R.WARNING)])
    R.gate(df, [])
    with pytest.raises(R.QualityGateError):
        R.gate(df, rules)
    valid, quarantined = R.split_valid(df, rules)
    assert ([r["id"] for r in valid.collect()], [r["id"] for r in quarantined.collect()]) == ([1], [2])


def test_run_summary(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, name string")
    summary = lambda d, rules: R.run_summary(R.quality_report(d, ["id"], rules)).first()
    bad = summary(df, [R.not_null("name")])
    assert (bad["files"], bad["critical"], bad["checks"], bad["passed"], bad["overall_pct"]) == (3, 1, 3, 2, 66.7)
    assert bad["run_status"] == "1 critical failure(s)"
    warned = summary(df, [R.not_null("name", R.WARNING)])
    assert warned["run_status"] == "all files passed (warnings present)"
    empty = summary(df.filter("id > 9"), [R.not_null("name")])
    assert (empty["files"], empty["overall_pct"], empty["run_status"]) == (0, 100.0, "all files passed")


def test_checks_stay_in_the_row(spark):
    df = spark.range(10).withColumn("name", F.col("id").cast("string"))
    plan = R.quality_report(df, ["id"], [R.not_null("name")])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
