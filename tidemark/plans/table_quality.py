"""Quality rules and reports bound to the test tables, with equivalent SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import rules as R
from tidemark.plans.table_queries import Tables, query
from tidemark.schemas import ACCOUNTING_FRAMEWORKS, CURRENCY_PATTERN, NOTCH_PATTERN, RATING_SCALE

EXPECTED = ["a", "b", "c"]

_RECORDS_SQL = """
    WITH rec AS (
        SELECT p_partkey,
            nullif(p_brand, 'Brand#7') AS entity,
            CASE WHEN p_size = 14 THEN NULL WHEN p_size = 13 THEN lower(substr(p_type, 1, 3))
                 ELSE substr(p_type, 1, 3) END AS currency,
            CASE WHEN p_size = 15 THEN NULL WHEN p_size % 4 = 0 THEN CAST(p_size AS VARCHAR)
                 WHEN p_size % 4 = 1 THEN ' March ' WHEN p_size % 4 = 2 THEN 'DECEMBER'
                 ELSE 'Q' || p_size END AS year_end,
            CASE p_type WHEN 'LARGE' THEN 'AAA' WHEN 'SMALL' THEN 'BB+' WHEN 'PROMO' THEN 'XYZ'
                 WHEN 'ECONOMY' THEN NULL ELSE 'B-' END AS score,
            CASE WHEN p_size <> 16 THEN p_size / 40.0 :: DOUBLE END AS weight_1,
            CASE WHEN p_size % 3 = 0 THEN 1 :: DOUBLE - p_size / 40.0 :: DOUBLE END AS weight_2,
            CASE p_size % 5 WHEN 0 THEN '+1 notch' WHEN 1 THEN ' -2 notches ' WHEN 2 THEN 'two'
                 WHEN 3 THEN NULL ELSE '+3 notch' END AS notch,
            CASE p_type WHEN 'LARGE' THEN 'IFRS' WHEN 'SMALL' THEN ' HGB ' WHEN 'PROMO' THEN 'UK GAAP'
                 ELSE '' END AS framework,
            CASE WHEN p_size % 2 = 0 THEN p_name END AS risk_2,
            p_size % 4 AS shape
        FROM part),
    checks AS (
        SELECT p_partkey, 'entity' AS field, 'not_null' AS rule,
               entity IS NOT NULL AND trim(entity) <> '' AS passed, 'CRITICAL' AS severity,
               'entity has no value' AS text FROM rec
        UNION ALL SELECT p_partkey, 'risk_2', 'not_null', risk_2 IS NOT NULL, 'WARNING',
               'risk_2 has no value' FROM rec
        UNION ALL SELECT p_partkey, 'currency', 'iso3_format',
               coalesce(regexp_matches(currency, '^[A-Z]{3}$'), false), 'CRITICAL',
               coalesce('currency ''' || currency || ''' is no three-letter currency code',
                        'currency is null') FROM rec
        UNION ALL SELECT p_partkey, 'year_end', 'valid_month',
               coalesce(lower(trim(year_end)) IN ('march', 'december')
                        OR TRY_CAST(year_end AS INTEGER) BETWEEN 1 AND 12, false), 'WARNING',
               coalesce('year_end ''' || year_end || ''' names no month',
                        'year_end is null') FROM rec
        UNION ALL SELECT p_partkey, 'score', 'rating_scale', score IS NULL OR score <> 'XYZ', 'WARNING',
               'score value ''' || score || ''' lies outside the rating scale' FROM rec
        UNION ALL SELECT p_partkey, 'weight_1', 'weight_range',
               coalesce(weight_1 BETWEEN 0 AND 1, false), 'CRITICAL',
               coalesce('weight_1 = ' || weight_1 || ' lies outside 0 to 1',
                        'weight_1 has no value') FROM rec
        UNION ALL SELECT p_partkey, 'weight_2', 'weight_range',
               weight_2 IS NULL OR weight_2 BETWEEN 0 AND 1,
               CASE WHEN weight_2 IS NULL THEN 'WARNING' ELSE 'CRITICAL' END,
               'weight_2 = ' || weight_2 || ' lies outside 0 to 1' FROM rec
        UNION ALL SELECT p_partkey, 'part_weight', 'weights_sum_to_one',
               abs(coalesce(weight_1, 0) + coalesce(weight_2, 0) - 1) <= 0.01, 'CRITICAL',
               'Part weights add up to ' || printf('%.4f', coalesce(weight_1, 0) + coalesce(weight_2, 0))
               || ', not to one' FROM rec
        UNION ALL SELECT p_partkey, 'notch', 'notch_format',
               coalesce(regexp_matches(trim(notch), '^[+-][0-9]+ notch(es)?$'), false), 'WARNING',
               coalesce('notch ''' || notch || ''' is no notch', 'notch is null') FROM rec
        UNION ALL SELECT p_partkey, 'risk_2', 'dual_risk_consistency',
               (risk_2 IS NOT NULL) = (weight_2 IS NOT NULL), 'WARNING',
               coalesce('risk_2 ''' || risk_2 || ''' comes without weight_2',
                        'weight_2=' || weight_2 || ' stands without risk_2') FROM rec
        UNION ALL SELECT p_partkey, 'framework', 'known_framework', framework <> 'UK GAAP', 'WARNING',
               'framework ''' || framework || ''' is none of '
               || '(HGB, IFRS, Local GAAP, Swiss GAAP FER, US GAAP)' FROM rec
        UNION ALL SELECT p_partkey, 'metrics', 'metrics_coverage', shape = 0, 'WARNING',
               CASE shape WHEN 1 THEN '1/3 metrics found, without b, c'
                    WHEN 2 THEN '2/3 metrics found, without a, b'
                    ELSE '0/3 metrics found, without a, b, c' END FROM rec),
    report AS (
        SELECT p_partkey, CAST(count(*) AS INTEGER) AS total_checks,
               CAST(count(*) FILTER (passed) AS INTEGER) AS passed,
               CAST(count(*) FILTER (NOT passed AND severity = 'CRITICAL') AS INTEGER) AS failed_critical,
               CAST(count(*) FILTER (NOT passed AND severity = 'WARNING') AS INTEGER) AS failed_warning,
               round(100.0 :: DOUBLE * count(*) FILTER (passed AND rule = 'not_null')
                     / count(*) FILTER (rule = 'not_null'), 1) AS completeness_pct,
               round(100.0 :: DOUBLE * count(*) FILTER (passed) / count(*), 1) AS validity_pct
        FROM checks GROUP BY p_partkey)
"""


def part_records(t: Tables) -> DataFrame:
    """A record per part in which every rule passes for some rows and fails for others."""
    size, kind = F.col("p_size"), F.col("p_type")

    def by_kind(values: dict[str, str | None], rest: str) -> Column:
        chain = F
        for key, value in values.items():
            chain = chain.when(kind == key, F.lit(value))
        return chain.otherwise(F.lit(rest))

    code = F.left(kind, F.lit(3))
    names = lambda *n: F.array(*[F.lit(x) for x in n])
    return t.part.select(
        "p_partkey",
        F.nullif(F.col("p_brand"), F.lit("Brand#7")).alias("entity"),
        F.when(size == 13, F.lower(code)).when(size != 14, code).alias("currency"),
        F.when(size == 15, F.lit(None))
        .when(size % 4 == 0, size.cast("string")).when(size % 4 == 1, " March ")
        .when(size % 4 == 2, "DECEMBER").otherwise(F.concat(F.lit("Q"), size.cast("string")))
        .alias("year_end"),
        by_kind({"LARGE": "AAA", "SMALL": "BB+", "PROMO": "XYZ", "ECONOMY": None}, "B-").alias("score"),
        F.when(size != 16, size / 40.0).alias("weight_1"),
        F.when(size % 3 == 0, 1 - size / 40.0).alias("weight_2"),
        F.when(size % 5 == 0, "+1 notch").when(size % 5 == 1, " -2 notches ")
        .when(size % 5 == 2, "two").when(size % 5 == 4, "+3 notch").alias("notch"),
        by_kind({"LARGE": "IFRS", "SMALL": " HGB ", "PROMO": "UK GAAP"}, "").alias("framework"),
        F.when(size % 2 == 0, F.col("p_name")).alias("risk_2"),
        F.when(size % 4 == 0, names("a", "b", "c")).when(size % 4 == 1, names("a"))
        .when(size % 4 == 2, names("c", "x")).alias("present"),
    )


def part_rules() -> list[R.Rule]:
    return [
        R.not_null("entity"),
        R.not_null("risk_2", R.WARNING),
        R.matches("currency", "iso3_format", CURRENCY_PATTERN, R.CRITICAL,
                  "is no three-letter currency code"),
        R.month("year_end"),
        R.in_scale("score", RATING_SCALE),
        R.fraction("weight_1", required=True),
        R.fraction("weight_2", required=False),
        R.sums_to_one("part_weight", ["weight_1", "weight_2"]),
        R.matches("notch", "notch_format", NOTCH_PATTERN, R.WARNING, "is no notch", trim=True),
        R.both_or_neither("risk_2", "weight_2"),
        R.known_value("framework", ACCOUNTING_FRAMEWORKS),
        R.covers("metrics", F.col("present"), EXPECTED),
    ]


@query(_RECORDS_SQL + """
    SELECT p_partkey, field, rule, passed, severity,
           CASE WHEN passed THEN '' ELSE text END AS message FROM checks
""")
def rule_checks_long(t: Tables) -> DataFrame:
    return R.checks_long(part_records(t), ["p_partkey"], part_rules())


@query(_RECORDS_SQL + "SELECT p_partkey, field, rule, severity, text AS message FROM checks WHERE NOT passed")
def rule_failures(t: Tables) -> DataFrame:
    return R.failures_long(part_records(t), ["p_partkey"], part_rules())


@query(_RECORDS_SQL + """
    SELECT *, CASE WHEN failed_critical > 0 THEN 'FAILED' WHEN failed_warning > 0 THEN 'WARNING'
                   ELSE 'PASSED' END AS status FROM report
""")
def quality_report(t: Tables) -> DataFrame:
    return R.quality_report(part_records(t), ["p_partkey"], part_rules(), failures=False)


@query(_RECORDS_SQL + """
    SELECT p_partkey, coalesce(failures, '') AS failures FROM report LEFT JOIN (
        SELECT p_partkey, string_agg(line, '; ' ORDER BY line) AS failures
        FROM (SELECT p_partkey, concat(severity, ' ', field, ' ', rule, ': ', text) AS line
              FROM checks WHERE NOT passed)
        GROUP BY p_partkey) USING (p_partkey)
""")
def report_failures(t: Tables) -> DataFrame:
    """The list of failures that each report carries, as one text."""
    report = R.quality_report(part_records(t), ["p_partkey"], part_rules())
    lines = F.transform(
        "failures",
        lambda f: F.concat(f["severity"], F.lit(" "), f["field"], F.lit(" "), f["rule"], F.lit(": "), f["message"]),
    )
    return report.select("p_partkey", F.array_join(F.array_sort(lines), "; ").alias("failures"))


@query(_RECORDS_SQL + """
    SELECT count(*) AS files, CAST(sum(failed_critical) AS BIGINT) AS critical,
           CAST(sum(failed_warning) AS BIGINT) AS warnings, CAST(sum(total_checks) AS BIGINT) AS checks,
           CAST(sum(passed) AS BIGINT) AS passed,
           round(100.0 :: DOUBLE * sum(passed) / sum(total_checks), 1) AS overall_pct,
           sum(failed_critical) || ' critical failure(s)' AS run_status
    FROM report
""")
def run_summary(t: Tables) -> DataFrame:
    report = R.quality_report(part_records(t), ["p_partkey"], part_rules(), failures=False)
    return R.run_summary(report)


@query(_RECORDS_SQL + "SELECT p_partkey, failed_critical = 0 AS valid FROM report")
def valid_and_quarantined(t: Tables) -> DataFrame:
    valid, quarantined = R.split_valid(part_records(t), part_rules())
    key = lambda df, flag: df.select("p_partkey", F.lit(flag).alias("valid"))
    return key(valid, True).unionByName(key(quarantined, False))


@query("""
    WITH checks AS (
        SELECT l_discount BETWEEN 0 AND 1 AS a, l_tax BETWEEN 0 AND 1 AS b,
               abs(l_discount + l_tax - 1) <= 0.01 AS c, l_returnflag IN ('A', 'N') AS d,
               regexp_matches(l_linestatus, '^[A-Z]$') AS e FROM lineitem)
    SELECT count(*) AS files, count(*) FILTER (NOT c) AS critical, count(*) FILTER (NOT d) AS warnings,
           5 * count(*) AS checks,
           CAST(sum(a :: INT + b :: INT + c :: INT + d :: INT + e :: INT) AS BIGINT) AS passed,
           round(100.0 :: DOUBLE * sum(a :: INT + b :: INT + c :: INT + d :: INT + e :: INT)
                 / (5 * count(*)), 1) AS overall_pct,
           count(*) FILTER (NOT c) || ' critical failure(s)' AS run_status
    FROM checks
""")
def line_quality_summary(t: Tables) -> DataFrame:
    checks = [
        R.fraction("l_discount", required=True),
        R.fraction("l_tax", required=False),
        R.sums_to_one("line_weight", ["l_discount", "l_tax"]),
        R.in_scale("l_returnflag", ["A", "N"]),
        R.matches("l_linestatus", "iso1_format", "^[A-Z]$", R.CRITICAL, "must be one letter"),
    ]
    return R.run_summary(R.quality_report(t.lineitem, ["l_orderkey"], checks, failures=False))
