"""Data-quality rules as data, evaluated row by row inside the JVM.

A rule is a predicate Column (never null) with a field, a name, a severity and a
message for the case it fails. All results of a record are computed in its row;
only failures are ever exploded.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import percent, strip
from tidemark.schemas import MONTHS

CRITICAL, WARNING = "CRITICAL", "WARNING"

_FAILURES = "array<struct<field:string,rule:string,severity:string,message:string>>"


@dataclass(frozen=True)
class Rule:
    field: str
    name: str
    passed: Column
    severity: str | Column
    message: str | Column

    def has_severity(self, severity: str) -> Column | bool:
        """Known when the plan is built, unless the severity depends on the row."""
        return self.severity == severity

    def head(self) -> list[Column]:
        return [F.lit(self.field).alias("field"), F.lit(self.name).alias("rule")]

    def result(self) -> Column:
        message = F.when(self.passed, "").otherwise(self.message)
        return F.struct(
            *self.head(), self.passed.alias("passed"), _column(self.severity).alias("severity"),
            message.alias("message"),
        )

    def failure(self) -> Column:
        """Null when the rule passed."""
        details = F.struct(
            *self.head(), _column(self.severity).alias("severity"),
            _column(self.message).alias("message"),
        )
        return F.when(~self.passed, details)

    def failed_as(self, severity: str) -> Column | None:
        same = self.has_severity(severity)
        if isinstance(same, bool):
            return ~self.passed if same else None
        return ~self.passed & same


def _column(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def rule(
    field: str, name: str, passed: Column, severity: str | Column, message: str | Column
) -> Rule:
    """A rule; a predicate that is null counts as failed."""
    return Rule(field, name, F.coalesce(passed, F.lit(False)), severity, message)


def _blank(col: Column) -> Column:
    return col.isNull() | (strip(col.cast("string")) == "")


def _missing_or(field: str, text: Column) -> Column:
    return F.when(F.col(field).isNull(), f"{field} is null").otherwise(text)


def not_null(field: str, severity: str = CRITICAL) -> Rule:
    return rule(
        field, "not_null", ~_blank(F.col(field)), severity, f"{field} has no value"
    )


def matches(field: str, name: str, pattern: str, severity: str, tail: str, trim: bool = False) -> Rule:
    """The value matches a pattern; null fails. ``tail`` ends the message."""
    col = F.col(field)
    text = F.concat(F.lit(f"{field} '"), col, F.lit(f"' {tail}"))
    return rule(
        field, name, (strip(col) if trim else col).rlike(pattern), severity, _missing_or(field, text)
    )


def month(field: str) -> Rule:
    """An English month name in any case or an integer 1..12."""
    col = F.col(field)
    text = F.lower(strip(col))
    number = F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))
    passed = text.isin(MONTHS) | F.coalesce(number.between(1, 12), F.lit(False))
    message = F.concat(
        F.lit(f"{field} '"), col, F.lit("' names no month")
    )
    return rule(field, "valid_month", passed, WARNING, _missing_or(field, message))


def in_scale(field: str, scale: Sequence[str], severity: str = WARNING) -> Rule:
    """The value is in the scale; null passes."""
    col = F.col(field)
    message = F.concat(F.lit(f"{field} value '"), col, F.lit("' lies outside the rating scale"))
    return rule(field, "rating_scale", col.isNull() | col.isin(list(scale)), severity, message)


def fraction(field: str, required: bool) -> Rule:
    """The value lies in [0, 1]; null fails only where required."""
    col = F.col(field)
    severity = CRITICAL if required else F.when(col.isNull(), WARNING).otherwise(CRITICAL)
    message = F.when(col.isNull(), f"{field} has no value").otherwise(
        F.concat(F.lit(f"{field} = "), col.cast("string"), F.lit(" lies outside 0 to 1"))
    )
    passed = F.when(col.isNull(), F.lit(not required)).otherwise(col.between(0.0, 1.0))
    return rule(field, "weight_range", passed, severity, message)


def sums_to_one(name: str, fields: Sequence[str], tolerance: float = 0.01) -> Rule:
    """The fields add up to one within the tolerance, null counting as zero."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(f), F.lit(0.0)) for f in fields])
    label = name.replace("_", " ").capitalize()
    message = F.format_string(f"{label}s add up to %.4f, not to one", total)
    return rule(name, "weights_sum_to_one", F.abs(total - 1.0) <= tolerance, CRITICAL, message)


def known_value(field: str, known: Sequence[str]) -> Rule:
    """The value is in a known set; blank passes, another rule reports it."""
    col = F.col(field)
    message = F.concat(
        F.lit(f"{field} '"), col, F.lit(f"' is none of ({', '.join(sorted(known))})")
    )
    passed = _blank(col) | strip(col).isin(list(known))
    return rule(field, "known_framework", passed, WARNING, message)


def both_or_neither(named: str, weight: str) -> Rule:
    """A name and its weight are both set or both absent."""
    has_name, has_weight = ~_blank(F.col(named)), F.col(weight).isNotNull()
    message = F.when(
        has_name,
        F.concat(F.lit(f"{named} '"), F.col(named), F.lit(f"' comes without {weight}")),
    ).otherwise(
        F.concat(
            F.lit(f"{weight}="), F.col(weight).cast("string"),
            F.lit(f" stands without {named}"),
        )
    )
    return rule(named, "dual_risk_consistency", has_name == has_weight, WARNING, message)


def covers(field: str, present: Column, expected: Sequence[str]) -> Rule:
    """The expected names are all in the array ``present``; the message lists the missing."""
    have = F.coalesce(present, F.array().cast("array<string>"))
    missing = F.array_except(F.array(*[F.lit(e) for e in expected]), have)
    message = F.concat(
        F.size(F.array_distinct(have)).cast("string"),
        F.lit(f"/{len(set(expected))} metrics found, without "),
        F.array_join(F.array_sort(missing), ", "),
    )
    return rule(field, "metrics_coverage", F.size(missing) == 0, WARNING, message)


# --- evaluation ------------------------------------------------------------------------


def _count(flags: Sequence[Column | None]) -> Column:
    return reduce(lambda a, b: a + b, [f.cast("int") for f in flags if f is not None], F.lit(0))


def is_valid(rules: Sequence[Rule]) -> Column:
    """No CRITICAL rule failed; true without any rule."""
    failed = [r.failed_as(CRITICAL) for r in rules]
    return reduce(lambda a, b: a & ~b, [f for f in failed if f is not None], F.lit(True))


def check_list(rules: Sequence[Rule]) -> Column:
    """All results of the record as an array."""
    return F.array(*[r.result() for r in rules])


def failure_list(rules: Sequence[Rule]) -> Column:
    """The failed results of the record as an array.

    Records that pass everything, as most do, build no structs at all.
    """
    failed = F.array_compact(F.array(*[r.failure() for r in rules]))
    all_passed = reduce(lambda a, b: a & b, [r.passed for r in rules], F.lit(True))
    return F.when(all_passed, F.array().cast(_FAILURES)).otherwise(failed)


def checks_long(df: DataFrame, keys: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """One row per record and rule."""
    return df.select(*keys, F.inline(check_list(rules)))


def failures_long(df: DataFrame, keys: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """One row per failure."""
    return df.select(*keys, F.inline(failure_list(rules)))


def report_columns(rules: Sequence[Rule], failures: bool = True) -> dict[str, Column]:
    """Counts, percentages and the list of failures of a record, by name."""
    total = F.lit(len(rules))
    passed = _count([r.passed for r in rules])
    required = [r.passed for r in rules if r.name == "not_null"]
    columns = {
        "total_checks": total,
        "passed": passed,
        "failed_critical": _count([r.failed_as(CRITICAL) for r in rules]),
        "failed_warning": _count([r.failed_as(WARNING) for r in rules]),
        "completeness_pct": percent(_count(required), F.lit(len(required))),
        "validity_pct": percent(passed, total),
    }
    return columns | ({"failures": failure_list(rules)} if failures else {})


def quality_report(
    df: DataFrame, keys: Sequence[str], rules: Sequence[Rule], failures: bool = True
) -> DataFrame:
    """Per record: counts, percentages, status and the list of failures. No shuffle."""
    columns = report_columns(rules, failures)
    return with_status(df.select(*keys, *[c.alias(n) for n, c in columns.items()]))


def with_status(report: DataFrame) -> DataFrame:
    return report.withColumn("status", record_status(F.col("failed_critical"), F.col("failed_warning")))


def record_status(critical: Column, warning: Column) -> Column:
    return F.when(critical > 0, "FAILED").when(warning > 0, "WARNING").otherwise("PASSED")


def run_summary(report: DataFrame) -> DataFrame:
    """Totals of a run in one row; 100 percent where nothing was checked."""
    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.col(name).cast("long")), F.lit(0))

    totals = report.agg(
        F.count(F.lit(1)).alias("files"),
        total("failed_critical").alias("critical"),
        total("failed_warning").alias("warnings"),
        total("total_checks").alias("checks"),
        total("passed").alias("passed"),
    )
    label = (
        F.when(
            F.col("critical") > 0,
            F.concat(F.col("critical").cast("string"), F.lit(" critical failure(s)")),
        )
        .when(F.col("warnings") > 0, "all files passed (warnings present)")
        .otherwise("all files passed")
    )
    return totals.select(
        "*",
        percent(F.col("passed"), F.col("checks")).alias("overall_pct"),
        label.alias("run_status"),
    )


class QualityGateError(ValueError):
    """At least one record failed a CRITICAL rule."""


def gate(df: DataFrame, rules: Sequence[Rule]) -> None:
    """Raise when any record is invalid. Stops at the first one found."""
    if df.filter(~is_valid(rules)).limit(1).count():
        raise QualityGateError("one or more records failed a critical check")


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) records, as an alternative to halting the batch."""
    return df.filter(is_valid(rules)), df.filter(~is_valid(rules))
