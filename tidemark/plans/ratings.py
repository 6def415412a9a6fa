"""The ratings preset: rules, normalisation and the rows of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.canonical import content_hash
from tidemark.functions.text import clean_str, month_number, round4
from tidemark.operators import rules as R
from tidemark.operators.latest import latest_per_key
from tidemark.operators.lookup import lookup
from tidemark.operators.reshape import numbered_columns_to_rows
from tidemark.operators.scd2 import sorted_named_weights, sorted_names
from tidemark.schemas import (
    ACCOUNTING_FRAMEWORKS,
    CURRENCY_PATTERN,
    EXPECTED_METRICS,
    NOTCH_PATTERN,
    RATING_SCALE,
    RECORD_TEXT_FIELDS,
    SCORE_COLUMNS,
    TABLES,
)

REQUIRED_FIELDS = [
    "rated_entity", "sector", "country", "accounting_principles", "methodology_1",
    "industry_risk_1", "industry_risk_score_1",
]
SCORE_FIELDS = [
    "industry_risk_score_1", "industry_risk_score_2", "business_risk_profile",
    "blended_industry_risk_profile", "competitive_positioning", "market_share",
    "diversification", "operating_profitability", "sector_specific_factor_1",
    "sector_specific_factor_2", "financial_risk_profile", "leverage", "interest_cover",
    "cash_flow_cover",
]

# dim_company column -> record column; a change in any of them, or in the sorted
# risk or methodology list, starts a new version.
DIMENSION_COLUMNS = {
    "sector_name": "sector",
    "country": "country",
    "reporting_currency": "currency",
    "accounting_principles": "accounting_principles",
    "business_year_end_month": "business_year_end_month",
    "industry_risk_segmentation_criteria": "segmentation_criteria",
}
TRACKED = [*DIMENSION_COLUMNS, "risks", "methodologies"]


def record_rules() -> list[R.Rule]:
    """The 30 checks of a record."""
    return [
        *[R.not_null(f) for f in REQUIRED_FIELDS],
        R.matches(
            "currency", "iso3_format", CURRENCY_PATTERN, R.CRITICAL,
            "is no three-letter currency code",
        ),
        R.month("business_year_end"),
        *[R.in_scale(f, RATING_SCALE) for f in SCORE_FIELDS],
        R.fraction("industry_weight_1", required=True),
        R.fraction("industry_weight_2", required=False),
        R.sums_to_one("industry_weight", ["industry_weight_1", "industry_weight_2"]),
        R.matches(
            "liquidity_adjustment", "notch_format", NOTCH_PATTERN, R.WARNING,
            "is no notch such as '+1 notch'", trim=True,
        ),
        R.both_or_neither("industry_risk_2", "industry_weight_2"),
        R.known_value("accounting_principles", ACCOUNTING_FRAMEWORKS),
        R.covers("scope_credit_metrics", F.map_keys("scope_credit_metrics"), EXPECTED_METRICS),
    ]


def content_fields() -> dict[str, Column]:
    """The fields that make up a record's content; file name and time do not."""
    fields = {name: clean_str(F.col(name)) for name in RECORD_TEXT_FIELDS}
    fields["currency"] = F.upper(fields["currency"])
    for name in ("industry_weight_1", "industry_weight_2", "scope_credit_metrics"):
        fields[name] = F.col(name)
    return fields


def with_mtimes(records: DataFrame, mtimes: DataFrame) -> DataFrame:
    """Adds file_modified_at from (source_filename, file_modified_at); now() where unknown."""
    return lookup(
        records, mtimes, ["source_filename"], {"file_modified_at": F.current_timestamp()}
    )


def normalise(records: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Raw records with file_modified_at to normalised, hash-keyed records.

    The columns named in ``also`` pass unchanged.
    """
    # Cleaned in a projection of their own: the hash uses each field several times.
    fields = {n: c.alias(n) for n, c in content_fields().items()}
    clean = records.select("source_filename", "file_modified_at", *fields.values(), *also)
    return clean.select(
        "source_filename",
        "file_modified_at",
        *[n for n in fields if n != "business_year_end"],
        month_number(F.col("business_year_end")).cast("short").alias("business_year_end_month"),
        content_hash(clean, list(fields)).alias("data_hash"),
        F.col("file_modified_at").alias("effective_date"),
        *also,
    )


def unresolved(quarantined: DataFrame, reports: DataFrame) -> DataFrame:
    """Of each file the latest quarantined record, unless the file has passed since.

    Both tables have ``source_filename`` and ``visible_at``, the time from which a load shows.
    """
    latest = latest_per_key(quarantined, ["source_filename"], ["visible_at", "rated_entity"])
    passed = reports.filter("failed_critical = 0").groupBy("source_filename").agg(
        F.max("visible_at").alias("_passed_at")
    )
    joined = latest.join(passed, "source_filename", "left")
    open_still = F.col("_passed_at").isNull() | (F.col("_passed_at") <= F.col("visible_at"))
    return joined.filter(open_still).drop("_passed_at", "visible_at")


def with_hash_prefix(rows: DataFrame) -> DataFrame:
    """Adds the first two digits of the content hash, by which its history is stored."""
    return rows.withColumn("hash_prefix", F.left("data_hash", F.lit(2)))


def with_dimension_columns(records: DataFrame) -> DataFrame:
    """Adds the tracked columns under their warehouse names."""
    weights = [
        (F.col(f"industry_risk_{i}"), F.col(f"industry_weight_{i}")) for i in (1, 2)
    ]
    renamed = {new: F.col(old) for new, old in DIMENSION_COLUMNS.items()}
    return records.withColumns(
        {
            "entity_name": F.col("rated_entity"),
            **renamed,
            "risks": sorted_named_weights(weights),
            "methodologies": sorted_names([F.col("methodology_1"), F.col("methodology_2")]),
        }
    )


# --- rows of the star schema ----------------------------------------------------------------
# ``accepted`` holds one row per loaded record: the normalised and dimension columns,
# upload_id, company_id, starts_version and loaded_at_utc. upload_id counts up like a
# serial column. The other keys follow from it, so they need no numbering of their own:
# a version is known by the upload that started it, a rating by its upload, a metric
# value by its upload and its position in the record.

_POSITION_BITS = 20  # a sheet of 16384 columns and six series has fewer values than 2^20


def upload_rows(accepted: DataFrame) -> DataFrame:
    return accepted.withColumn("rows_extracted", F.lit(1)).select(*TABLES["upload_log"].names)


def rating_rows(accepted: DataFrame) -> DataFrame:
    return accepted.select(
        F.col("upload_id").alias("rating_id"),
        "upload_id",
        "company_id",
        *[F.col(old).alias(new) for new, old in SCORE_COLUMNS.items()],
        "data_hash",
        "loaded_at_utc",
    )


def metric_rows(accepted: DataFrame) -> DataFrame:
    """One row per metric and year of a record. Map keys make them unique per upload."""
    values = F.flatten(
        F.transform(
            F.array_sort(F.map_keys("scope_credit_metrics")),
            lambda metric: F.transform(
                F.map_entries(F.element_at("scope_credit_metrics", metric)),
                lambda e: F.struct(
                    metric.alias("metric_name"), e["key"].alias("year"),
                    e["value"]["text"].alias("metric_value"),
                ),
            ),
        )
    )
    rows = accepted.select(
        "company_id", "upload_id", "loaded_at_utc", F.posexplode(values).alias("pos", "m")
    )
    key = F.shiftleft("upload_id", _POSITION_BITS) + F.col("pos")
    return rows.select(
        key.alias("scope_credit_id"), "company_id", "upload_id", "m.*", "loaded_at_utc"
    )


def risk_rows(accepted: DataFrame) -> DataFrame:
    """Risk weights of the records that start a version; the first of equal names counts.

    ON CONFLICT DO NOTHING keeps slot 1, so slot 2 counts only with another name.
    """
    other = ~F.col("industry_risk_2").eqNullSafe(F.col("industry_risk_1"))
    second = F.when(other, F.col("industry_risk_2"))
    slots = [
        (F.col("industry_risk_1"), round4(F.col("industry_weight_1"))),
        (second, round4(F.col("industry_weight_2"))),
    ]
    return numbered_columns_to_rows(
        accepted.filter("starts_version"), ["company_id"], slots, ["industry_risk_name", "weight"]
    )


def methodology_rows(accepted: DataFrame) -> DataFrame:
    starting = accepted.filter("starts_version")
    return starting.select(
        "company_id", F.explode("methodologies").alias("rating_methodology_name")
    )


def version_rows(accepted: DataFrame) -> DataFrame:
    """Open rows of the versions that begin in ``accepted``."""
    return accepted.filter("starts_version").select(
        "company_id",
        "entity_name",
        *DIMENSION_COLUMNS,
        "risks",
        "methodologies",
        F.col("loaded_at_utc").alias("valid_from"),
        F.col("upload_id").alias("source_upload_id"),
        "loaded_at_utc",
    )
