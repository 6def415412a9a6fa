"""The read queries on the warehouse tables.

Every function takes DataFrames and returns a lazy DataFrame. With ``strict``
a lookup that finds nothing raises; otherwise it is empty.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import name_list
from tidemark.operators import filters as flt
from tidemark.operators.latest import latest_per_key, latest_with_parent
from tidemark.operators.lookup import left_join_totals
from tidemark.operators.reshape import nest_children
from tidemark.schemas import SCORE_COLUMNS
from tidemark.sources.files import source_file_status

_COMPANY = [
    "company_id", "entity_name", "sector_name", "country", "reporting_currency",
    "accounting_principles", "business_year_end_month",
]
_PUBLIC_NAMES = {"sector_name": "sector", "reporting_currency": "currency", "rating_id": "snapshot_id"}

_SNAPSHOT = [
    "rating_id", "upload_id", "company_id", "entity_name", "sector_name", "country",
    "reporting_currency", *SCORE_COLUMNS, "data_hash", "loaded_at_utc",
]


class NotFound(LookupError):
    """A lookup with ``strict`` found nothing."""


def _public(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(_PUBLIC_NAMES.get(c, c)) for c in columns])


def _found(df: DataFrame, strict: bool, what: str) -> DataFrame:
    if strict and df.isEmpty():
        raise NotFound(f"{what} not found")
    return df


def _version(dim_company: DataFrame) -> DataFrame:
    """The dimension columns a snapshot shows."""
    return dim_company.select(
        "company_id", "entity_name", "sector_name", "country", "reporting_currency"
    )


# --- companies --------------------------------------------------------------------------


def current_companies(dim_company: DataFrame) -> DataFrame:
    rows = dim_company.filter("is_current").orderBy(*flt.ascending("entity_name"))
    return _public(rows, [*_COMPANY, "valid_from", "loaded_at_utc"])


def company(dim_company: DataFrame, entity_name: str, strict: bool = False) -> DataFrame:
    row = dim_company.filter(F.col("is_current") & (F.col("entity_name") == entity_name))
    columns = [*_COMPANY, "valid_from", "valid_to", "is_current", "loaded_at_utc"]
    return _found(_public(row, columns), strict, f"company {entity_name!r}")


def company_versions(dim_company: DataFrame, entity_name: str, strict: bool = False) -> DataFrame:
    """All versions of an entity, oldest first."""
    rows = dim_company.filter(F.col("entity_name") == entity_name)
    columns = [*_COMPANY, "valid_from", "valid_to", "is_current", "loaded_at_utc"]
    result = _public(rows, columns).orderBy(*flt.ascending("valid_from"))
    return _found(result, strict, f"company {entity_name!r}")


def metric_history(
    fact_scope_credit_hist: DataFrame, dim_company: DataFrame, entity_name: str, strict: bool = False
) -> DataFrame:
    """The metric series of an entity over all its versions and uploads."""
    ids = dim_company.filter(F.col("entity_name") == entity_name).select("company_id", "entity_name")
    rows = fact_scope_credit_hist.join(ids, "company_id").select(
        "scope_credit_id", "company_id", "upload_id", "entity_name", "metric_name", "year",
        "metric_value", F.col("metric_value").try_cast("double").alias("metric_value_num"),
        "loaded_at_utc",
    )
    result = rows.orderBy(*flt.ascending("metric_name", "year", "upload_id"))
    return _found(result, strict, f"time series of {entity_name!r}")


def compare_companies(
    fact_ratings: DataFrame,
    dim_company: DataFrame,
    entity_names: str,
    as_of: datetime | None = None,
) -> DataFrame:
    """Latest snapshot of each named entity, optionally as of a moment."""
    names = name_list(entity_names)
    facts = flt.all_given(fact_ratings, [flt.at_most("loaded_at_utc", as_of)])
    wanted = _version(dim_company).filter(F.col("entity_name").isin(names))
    joined = facts.join(wanted, "company_id")
    latest = latest_per_key(joined, ["entity_name"], ["loaded_at_utc", "rating_id"])
    return _public(latest, _SNAPSHOT).orderBy(*flt.ascending("entity_name"))


# --- snapshots --------------------------------------------------------------------------


def latest_snapshots(fact_ratings: DataFrame, dim_company: DataFrame) -> DataFrame:
    latest = latest_with_parent(
        fact_ratings, _version(dim_company), "company_id", "entity_name",
        ["loaded_at_utc", "rating_id"],
    )
    return _public(latest, _SNAPSHOT).orderBy(*flt.ascending("entity_name"))


def snapshots(
    fact_ratings: DataFrame,
    dim_company: DataFrame,
    company_id: int | None = None,
    from_date: datetime | None = None,
    to_date: datetime | None = None,
    sector: str | None = None,
    country: str | None = None,
    currency: str | None = None,
) -> DataFrame:
    """Snapshots that meet all given filters, newest first."""
    joined = fact_ratings.join(_version(dim_company), "company_id", "left")
    rows = flt.all_given(
        joined,
        [
            flt.equals("company_id", company_id),
            flt.at_least("loaded_at_utc", from_date),
            flt.at_most("loaded_at_utc", to_date),
            flt.contains("sector_name", sector),
            flt.contains("country", country),
            flt.equals_upper("reporting_currency", currency),
        ],
    )
    return _public(rows.orderBy(*flt.descending("loaded_at_utc", "rating_id")), _SNAPSHOT)


def snapshot(
    fact_ratings: DataFrame, dim_company: DataFrame, snapshot_id: int, strict: bool = False
) -> DataFrame:
    row = fact_ratings.filter(F.col("rating_id") == snapshot_id)
    joined = row.join(_version(dim_company), "company_id", "left")
    return _found(_public(joined, _SNAPSHOT), strict, f"snapshot {snapshot_id}")


# --- uploads ----------------------------------------------------------------------------


def uploads(upload_log: DataFrame) -> DataFrame:
    return upload_log.orderBy(*flt.descending("loaded_at_utc", "upload_id"))


def upload_stats(
    upload_log: DataFrame, fact_ratings: DataFrame, dim_company: DataFrame | None = None
) -> DataFrame:
    """Totals over the uploads left-joined to their facts. ``unique_companies`` counts versions.

    With the dimension given, ``unique_entities`` counts names.
    """
    measures = [
        F.count_distinct("source_filename").alias("unique_files"),
        F.min("loaded_at_utc").alias("earliest_upload"),
        F.max("loaded_at_utc").alias("latest_upload"),
    ]
    facts = fact_ratings.select("upload_id", "company_id")
    stats = left_join_totals(
        upload_log, facts, "upload_id", "company_id", measures, "total_uploads", "unique_companies"
    )
    if dim_company is None:
        return stats
    entities = (
        facts.select("company_id").distinct()
        .join(dim_company.select("company_id", "entity_name"), "company_id", "left")
        .agg(F.count_distinct("entity_name").alias("unique_entities"))
    )
    # two single rows side by side
    return stats.withColumn("_one", F.lit(1)).join(
        entities.withColumn("_one", F.lit(1)), "_one"
    ).drop("_one")


def upload_details(
    upload_log: DataFrame,
    fact_ratings: DataFrame,
    dim_company: DataFrame,
    upload_id: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """Uploads with their snapshots as a sorted list, one upload or all."""
    log = flt.all_given(upload_log, [flt.equals("upload_id", upload_id)])
    facts = flt.all_given(fact_ratings, [flt.equals("upload_id", upload_id)])
    children = _public(facts.join(_version(dim_company), "company_id", "left"), _SNAPSHOT)
    nested = nest_children(
        log, children, "upload_id", ["snapshot_id"], children.columns, "snapshots"
    )
    return _found(nested, strict, f"upload {upload_id}")


def upload_file(
    upload_log: DataFrame, files: DataFrame, upload_id: int | None = None
) -> DataFrame:
    """Source file of one upload or all: found or missing_file; no row for an unknown id."""
    log = flt.all_given(upload_log, [flt.equals("upload_id", upload_id)])
    return source_file_status(log.select("upload_id", "source_filename"), files)


# --- published report queries -------------------------------------------------------------


def run_history(pipeline_run_state: DataFrame) -> DataFrame:
    return pipeline_run_state.orderBy(*flt.descending("started_at_utc")).select(
        "dag_run_id", "status", "files_staged", "files_loaded", "files_skipped", "completed_at_utc"
    )


def company_overview(dim_company: DataFrame) -> DataFrame:
    return dim_company.filter("is_current").orderBy(*flt.ascending("entity_name")).select(
        "entity_name", "sector_name", "country", "reporting_currency", "accounting_principles",
        "valid_from",
    )


def _bridge_of_current(bridge: DataFrame, dim_company: DataFrame) -> DataFrame:
    names = dim_company.filter("is_current").select("company_id", "entity_name")
    return bridge.join(names, "company_id")


def current_risk_weights(dim_company_industry_risk: DataFrame, dim_company: DataFrame) -> DataFrame:
    rows = _bridge_of_current(dim_company_industry_risk, dim_company)
    return rows.orderBy(*flt.ascending("entity_name"), *flt.descending("weight")).select(
        "entity_name", "industry_risk_name", "weight"
    )


def current_methodologies(
    dim_company_rating_methodology: DataFrame, dim_company: DataFrame
) -> DataFrame:
    rows = _bridge_of_current(dim_company_rating_methodology, dim_company)
    return rows.orderBy(*flt.ascending("entity_name")).select(
        "entity_name", "rating_methodology_name"
    )


def all_scores(fact_ratings: DataFrame, dim_company: DataFrame) -> DataFrame:
    names = dim_company.select("company_id", "entity_name", "sector_name")
    return (
        fact_ratings.join(names, "company_id")
        .orderBy(*flt.descending("loaded_at_utc"))
        .select(
            "entity_name", "sector_name", "business_risk_profile", "financial_risk_profile",
            "leverage", "liquidity", "loaded_at_utc",
        )
    )


def metric_series(
    fact_scope_credit_hist: DataFrame, dim_company: DataFrame, entity_name: str
) -> DataFrame:
    return metric_history(fact_scope_credit_hist, dim_company, entity_name).select(
        "entity_name", "metric_name", "year", "metric_value"
    )


def version_history(dim_company: DataFrame, entity_name: str) -> DataFrame:
    return company_versions(dim_company, entity_name).select(
        "entity_name", "valid_from", "valid_to", "is_current"
    )


def upload_overview(upload_log: DataFrame) -> DataFrame:
    return uploads(upload_log).select(
        "source_filename", "rows_extracted", "data_hash", "loaded_at_utc"
    )


def version_risks(dim_company_industry_risk: DataFrame) -> DataFrame:
    """Each version's risks as a sorted list; the sheet has two slots per version."""
    pair = F.struct(F.col("industry_risk_name").alias("name"), "weight")
    return dim_company_industry_risk.groupBy("company_id").agg(
        F.array_sort(F.collect_list(pair)).alias("risks")
    )


def version_methodologies(dim_company_rating_methodology: DataFrame) -> DataFrame:
    """Each version's methodologies as a sorted list; the sheet has two slots per version."""
    return dim_company_rating_methodology.groupBy("company_id").agg(
        F.array_sort(F.collect_list("rating_methodology_name")).alias("methodologies")
    )
