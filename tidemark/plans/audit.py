"""The constraints of the warehouse tables, checked as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.audit import Constraints, constraint_audit
from tidemark.sources.warehouse import Warehouse


def _not_blank(column: str):
    return F.col(column) != ""


def warehouse_constraints() -> dict[str, Constraints]:
    company, upload = ("dim_company", "company_id"), ("upload_log", "upload_id")
    return {
        "upload_log": Constraints(
            not_null=["upload_id", "source_filename", "file_modified_at", "data_hash", "loaded_at_utc"],
            unique=[["upload_id"], ["source_filename", "data_hash"], ["data_hash"]],
            checks={
                "source_filename not blank": _not_blank("source_filename"),
                "length(data_hash) = 64": F.length("data_hash") == 64,
            },
        ),
        "pipeline_run_state": Constraints(
            not_null=["run_id", "dag_run_id", "started_at_utc", "status"],
            unique=[["run_id"], ["dag_run_id"]],
            checks={"status": F.col("status").isin("running", "success", "failed")},
        ),
        "dim_company": Constraints(
            not_null=["company_id", "entity_name", "sector_name", "valid_from", "is_current",
                      "loaded_at_utc"],
            unique=[["company_id"], ["entity_name", "valid_from"]],
            checks={
                "entity_name not blank": _not_blank("entity_name"),
                "sector_name not blank": _not_blank("sector_name"),
                "business_year_end_month": F.col("business_year_end_month").between(1, 12),
                "current versions are open": ~F.col("is_current") | F.col("valid_to").isNull(),
            },
            foreign_keys=[("source_upload_id", *upload)],
        ),
        "dim_company_industry_risk": Constraints(
            not_null=["company_id", "industry_risk_name", "weight"],
            unique=[["company_id", "industry_risk_name"]],
            checks={
                "industry_risk_name not blank": _not_blank("industry_risk_name"),
                "weight": F.col("weight").between(0, 1),
            },
            foreign_keys=[("company_id", *company)],
        ),
        "dim_company_rating_methodology": Constraints(
            not_null=["company_id", "rating_methodology_name"],
            unique=[["company_id", "rating_methodology_name"]],
            checks={"rating_methodology_name not blank": _not_blank("rating_methodology_name")},
            foreign_keys=[("company_id", *company)],
        ),
        # The grain is (upload, version): several ratings of one version are legal.
        "fact_ratings": Constraints(
            not_null=["rating_id", "upload_id", "company_id", "data_hash", "loaded_at_utc"],
            unique=[["rating_id"], ["upload_id", "company_id"]],
            foreign_keys=[("upload_id", *upload), ("company_id", *company)],
        ),
        "fact_scope_credit_hist": Constraints(
            not_null=["scope_credit_id", "company_id", "upload_id", "metric_name", "year",
                      "loaded_at_utc"],
            unique=[["scope_credit_id"], ["upload_id", "metric_name", "year"]],
            checks={"metric_name not blank": _not_blank("metric_name"), "year not blank": _not_blank("year")},
            foreign_keys=[("upload_id", *upload), ("company_id", *company)],
        ),
    }


def warehouse_audit(warehouse: Warehouse) -> DataFrame:
    """One row per constraint with the number of violations."""
    constraints = warehouse_constraints()
    return constraint_audit({n: warehouse.read(n) for n in constraints}, constraints)


def ratings_per_version(fact_ratings: DataFrame) -> DataFrame:
    """Versions with several ratings, which a unique key on the version would forbid."""
    return fact_ratings.groupBy("company_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
