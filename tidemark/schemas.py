"""Column types of records and warehouse tables, and the fixed value sets."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, SHORT = T.StringType(), T.LongType(), T.IntegerType(), T.ShortType()
DOUBLE, BOOL, TS = T.DoubleType(), T.BooleanType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# --- sheets and records ------------------------------------------------------------

# One spreadsheet cell: kind is 'n' (number), 's' (text) or 'b' (boolean).
CELL = _struct(("kind", STRING), ("text", STRING))

# One non-empty sheet row; ``cells[i]`` is column i, null where the cell is empty.
SHEET_ROW = _struct(
    ("source_filename", STRING), ("row_idx", INT), ("cells", T.ArrayType(CELL, True))
)

METRICS = T.MapType(STRING, T.MapType(STRING, CELL, True), True)

RECORD_TEXT_FIELDS = [
    "rated_entity", "sector", "methodology_1", "methodology_2",
    "industry_risk_1", "industry_risk_2", "industry_risk_score_1", "industry_risk_score_2",
    "segmentation_criteria", "currency", "country", "accounting_principles",
    "business_year_end", "business_risk_profile", "blended_industry_risk_profile",
    "competitive_positioning", "market_share", "diversification", "operating_profitability",
    "sector_specific_factor_1", "sector_specific_factor_2", "financial_risk_profile",
    "leverage", "interest_cover", "cash_flow_cover", "liquidity_adjustment",
]
RECORD_WEIGHT_FIELDS = ["industry_weight_1", "industry_weight_2"]

RAW_RECORD = T.StructType(
    [T.StructField("source_filename", STRING)]
    + [T.StructField(name, STRING) for name in RECORD_TEXT_FIELDS]
    + [T.StructField(name, DOUBLE) for name in RECORD_WEIGHT_FIELDS]
    + [T.StructField("scope_credit_metrics", METRICS)]
)

# --- warehouse tables ---------------------------------------------------------------

# fact column -> record field
SCORE_COLUMNS = {
    "business_risk_profile": "business_risk_profile",
    "financial_risk_profile": "financial_risk_profile",
    "blended_industry_risk_profile": "blended_industry_risk_profile",
    "competitive_positioning": "competitive_positioning",
    "market_share": "market_share",
    "diversification": "diversification",
    "operating_profitability": "operating_profitability",
    "sector_company_specific_factor_1": "sector_specific_factor_1",
    "sector_company_specific_factor_2": "sector_specific_factor_2",
    "leverage": "leverage",
    "interest_cover": "interest_cover",
    "cash_flow_cover": "cash_flow_cover",
    "liquidity": "liquidity_adjustment",
}

TABLES: dict[str, T.StructType] = {
    "upload_log": _struct(
        ("upload_id", LONG), ("source_filename", STRING), ("file_modified_at", TS),
        ("data_hash", STRING), ("dag_run_id", STRING), ("rows_extracted", INT),
        ("loaded_at_utc", TS),
    ),
    "pipeline_run_state": _struct(
        ("run_id", LONG), ("dag_run_id", STRING), ("started_at_utc", TS),
        ("completed_at_utc", TS), ("status", STRING), ("files_staged", INT),
        ("files_loaded", INT), ("files_skipped", INT),
    ),
    "dim_company": _struct(
        ("company_id", LONG), ("entity_name", STRING), ("sector_name", STRING),
        ("country", STRING), ("reporting_currency", STRING), ("accounting_principles", STRING),
        ("business_year_end_month", SHORT), ("industry_risk_segmentation_criteria", STRING),
        ("valid_from", TS), ("valid_to", TS), ("is_current", BOOL),
        ("source_upload_id", LONG), ("loaded_at_utc", TS),
    ),
    "dim_company_industry_risk": _struct(
        ("company_id", LONG), ("industry_risk_name", STRING), ("weight", T.DecimalType(5, 4))
    ),
    "dim_company_rating_methodology": _struct(
        ("company_id", LONG), ("rating_methodology_name", STRING)
    ),
    "fact_ratings": T.StructType(
        list(_struct(("rating_id", LONG), ("upload_id", LONG), ("company_id", LONG)))
        + [T.StructField(name, STRING) for name in SCORE_COLUMNS]
        + list(_struct(("data_hash", STRING), ("loaded_at_utc", TS)))
    ),
    "fact_scope_credit_hist": _struct(
        ("scope_credit_id", LONG), ("company_id", LONG), ("upload_id", LONG),
        ("metric_name", STRING), ("year", STRING), ("metric_value", STRING),
        ("loaded_at_utc", TS),
    ),
}

# --- fixed values -------------------------------------------------------------------
# These sets and labels must equal the source data's conventions for right results.

RATING_SCALE = [
    "AAA", "AA+", "AA", "AA-", "A+", "A", "A-", "BBB+", "BBB", "BBB-", "BB+", "BB", "BB-",
    "B+", "B", "B-", "CCC+", "CCC", "CCC-", "CC", "C", "D",
]

ACCOUNTING_FRAMEWORKS = ["HGB", "IFRS", "Local GAAP", "Swiss GAAP FER", "US GAAP"]

EXPECTED_METRICS = [
    "Liquidity (time-series)",
    "Scope-adjusted EBITDA interest cover",
    "Scope-adjusted FFO/debt",
    "Scope-adjusted FOCF/debt",
    "Scope-adjusted debt/EBITDA",
    "Scope-adjusted loan/value",
]

MONTHS = [
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december",
]

CURRENCY_PATTERN = r"^[A-Z]{3}$"
NOTCH_PATTERN = r"^[+-]\d+ notch(es)?$"
METRICS_HEADER = "[Scope Credit Metrics]"
LIQUIDITY_LABEL = "Liquidity"
LIQUIDITY_SERIES = "Liquidity (time-series)"

# record field -> (sheet label, value position)
SHEET_LABELS: dict[str, tuple[str, int]] = {
    "rated_entity": ("Rated entity", 0),
    "sector": ("CorporateSector", 0),
    "methodology_1": ("Rating methodologies applied", 0),
    "methodology_2": ("Rating methodologies applied", 1),
    "industry_risk_1": ("Industry risk", 0),
    "industry_risk_2": ("Industry risk", 1),
    "industry_risk_score_1": ("Industry risk score", 0),
    "industry_risk_score_2": ("Industry risk score", 1),
    "industry_weight_1": ("Industry weight", 0),
    "industry_weight_2": ("Industry weight", 1),
    "segmentation_criteria": ("Segmentation criteria", 0),
    "currency": ("Reporting Currency/Units", 0),
    "country": ("Country of origin", 0),
    "accounting_principles": ("Accounting principles", 0),
    "business_year_end": ("End of business year", 0),
    "business_risk_profile": ("Business risk profile", 0),
    "blended_industry_risk_profile": ("(Blended) Industry risk profile", 0),
    "competitive_positioning": ("Competitive Positioning", 0),
    "market_share": ("Market share", 0),
    "diversification": ("Diversification", 0),
    "operating_profitability": ("Operating profitability", 0),
    "sector_specific_factor_1": ("Sector/company-specific factors (1)", 0),
    "sector_specific_factor_2": ("Sector/company-specific factors (2)", 0),
    "financial_risk_profile": ("Financial risk profile", 0),
    "leverage": ("Leverage", 0),
    "interest_cover": ("Interest cover", 0),
    "cash_flow_cover": ("Cash flow cover", 0),
}
