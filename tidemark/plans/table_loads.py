"""Streams and whole loads on data derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedup import new_content
from tidemark.operators.sketches import distinct_sketches, merged_counts, relative_error
from tidemark.plans import reads
from tidemark.plans.audit_state import AuditState
from tidemark.plans.latest_state import LatestState
from tidemark.plans.ratings import normalise, with_hash_prefix
from tidemark.plans.runs import QUARANTINE, load_records, replay, reported_run, still_quarantined
from tidemark.plans.table_queries import SQL, Tables, query, star_constraints
from tidemark.schemas import RAW_RECORD
from tidemark.session import shared_dir
from tidemark.sources.sheet_csv import reload_sheet_csv, write_sheet_csv
from tidemark.sources.warehouse import Warehouse
from tidemark.streaming.ingest import distinct_stream, stream_table


def _distinct(t: Tables, name: str, columns: dict[str, Column]) -> DataFrame:
    """Runs a de-duplicating stream over a table until all of it is read."""
    schema = getattr(t, name).schema
    stream = stream_table(t.spark, t.folder, name, schema).select(
        *[c.alias(n) for n, c in columns.items()]
    )
    place = shared_dir(t.spark, f"stream-{name}")
    distinct_stream(stream, list(columns), f"{place}/out", f"{place}/checkpoint").awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(f"{place}/out")


@query("SELECT DISTINCT user_id, event_type FROM events")
def incremental_stream(t: Tables) -> DataFrame:
    return _distinct(
        t, "events", {"user_id": F.col("user_id"), "event_type": F.col("event_type")}
    )


@query("SELECT DISTINCT sha256(text) AS data_hash FROM documents")
def distinct_content_stream(t: Tables) -> DataFrame:
    return _distinct(t, "documents", {"data_hash": F.sha2("text", 256)})


# --- state kept up by loads -------------------------------------------------------------------


def _late_batches(t: Tables) -> list[tuple[str, DataFrame]]:
    """The orders in three loads: the second brings rows again, the third many older ones."""
    orders = t.orders
    return [
        ("open", orders.filter("o_orderstatus = 'O'")),
        ("partly", orders.filter("o_orderstatus <> 'F'")),
        ("older", orders.filter("o_orderstatus = 'F'")),
    ]


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderstatus
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                       ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    WHERE rn = 1
""")
def latest_kept_by_loads(t: Tables) -> DataFrame:
    """The latest order per customer from a stored state, after three loads, one of them late."""
    columns = ["o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"]
    state = LatestState(
        t.spark, shared_dir(t.spark, "latest-state"), t.orders.select(*columns).schema,
        ["o_custkey"], ["o_orderdate", "o_orderkey"],
    )
    for name, batch in _late_batches(t):
        state.load(batch, name)
    return state.rows()


@query("""
    SELECT o_orderpriority, count(*) AS n_rows, count(DISTINCT o_custkey) AS customers,
           count(DISTINCT o_orderdate) AS days, true AS customers_close, true AS days_close
    FROM orders GROUP BY o_orderpriority
""")
def distinct_by_sketches(t: Tables) -> DataFrame:
    """Distinct counts merged from the sketches of several loads, held against exact ones."""
    place, by = shared_dir(t.spark, "sketches"), ["o_orderpriority"]
    columns = ["o_custkey", "o_orderdate"]
    for status in ("O", "P", "F"):
        batch = t.orders.filter(F.col("o_orderstatus") == status)
        distinct_sketches(batch, by, columns).write.parquet(f"{place}/load_id={status}")
    merged = merged_counts(t.spark.read.parquet(place), by, columns)
    exact = t.orders.groupBy(*by).agg(
        F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_orderdate").alias("days")
    )

    def close(estimate: str, true: str) -> Column:
        return F.abs(F.col(estimate) - F.col(true)) <= F.ceil(F.col(true) * relative_error())

    return merged.join(exact, by).select(
        *by, "n_rows", "customers", "days",
        close("o_custkey_distinct", "customers").alias("customers_close"),
        close("o_orderdate_distinct", "days").alias("days_close"),
    )


@query("""
    WITH h AS (SELECT doc_id, sha256(text) AS data_hash, doc_id IN (SELECT doc_id FROM labels) AS known
               FROM documents)
    SELECT min(doc_id) AS doc_id, data_hash FROM h WHERE NOT known
    AND data_hash NOT IN (SELECT data_hash FROM h WHERE known) GROUP BY data_hash
""")
def new_by_hash_prefix(t: Tables) -> DataFrame:
    """Documents with content that a history stored by hash prefix doesn't hold; the labelled
    ones are the history."""
    place = shared_dir(t.spark, "hash-history")
    hashed = with_hash_prefix(t.documents.select("doc_id", F.sha2("text", 256).alias("data_hash")))
    history = hashed.join(t.labels, "doc_id", "left_semi").select("data_hash", "hash_prefix")
    history.repartition("hash_prefix").write.partitionBy("hash_prefix").parquet(place)
    stored = t.spark.read.schema(history.schema).parquet(place)
    batch = hashed.join(t.labels, "doc_id", "left_anti")
    rows = new_content(batch, stored, ["data_hash"], ["doc_id"], ["hash_prefix"])
    return rows.select("doc_id", "data_hash")


@query(SQL["constraint_audit"])
def audit_kept_by_loads(t: Tables) -> DataFrame:
    """The constraint audit from three loads that read their own rows and stored keys only.

    Line items come before some of their orders, and documents before their labels, so
    foreign keys are broken for a while.
    """
    state = AuditState(t.spark, shared_dir(t.spark, "audit-state"), star_constraints(), digits=1)
    old = F.col("o_orderstatus") == "F"
    state.load({"customer": t.customer, "orders": t.orders.filter(old)}, "old")
    state.load({"lineitem": t.lineitem, "documents": t.documents}, "details")
    state.load({"orders": t.orders.filter(~old), "labels": t.labels}, "new")
    return state.violations()


@query("""
    SELECT 'customer_' || c_custkey AS source_filename, row_idx, texts
    FROM customer, LATERAL (VALUES
        (0, '|Rated entity|' || c_name || repeat('|', 15)),
        (1, '|note|first line' || chr(10) || c_name || '|say "' || c_mktsegment || '"|a,b| \\n \\|' || chr(13) || chr(10)
            || repeat('|', 11)),
        (2, repeat('|', 17) || 'far right ' || c_custkey), (3, repeat('|', 17))) rows(row_idx, texts)
""")
def sheet_csv_round_trip(t: Tables) -> DataFrame:
    """Sheets with line breaks, quotes, an all-empty and a wide row, written twice and read back."""

    def cells(*texts: Column | None) -> Column:
        padded = [*texts, *[None] * (18 - len(texts))]
        blank = F.lit(None).cast("struct<kind:string,text:string>")
        boxed = [
            blank if c is None else F.struct(F.lit("s").alias("kind"), c.alias("text")) for c in padded
        ]
        return F.array(*boxed).alias("cells")

    def line(row: int, *texts: Column | None) -> Column:
        return F.struct(F.lit(row).alias("row_idx"), cells(*texts))

    name, segment, key = F.col("c_name"), F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    lines = F.array(
        line(0, None, F.lit("Rated entity"), name),
        line(1, None, F.lit("note"), F.concat(F.lit("first line\n"), name),
             F.concat(F.lit('say "'), segment, F.lit('"')), F.lit("a,b"), F.lit(" \\n \\"), F.lit("\r\n")),
        line(2, *[None] * 17, F.concat(F.lit("far right "), key)),
        line(3),
    )
    file = F.concat(F.lit("customer_"), key, F.lit(".xlsm"))
    sheets = t.customer.select(file.alias("source_filename"), F.inline(lines))
    place = shared_dir(t.spark, "sheet-csv")
    for _ in range(2):
        write_sheet_csv(sheets, place, width=18)
    found = reload_sheet_csv(t.spark, place, width=18)
    texts = F.transform("cells", lambda c: F.coalesce(c["text"], F.lit("")))
    return found.select("source_filename", "row_idx", F.array_join(texts, "|").alias("texts"))


# --- a whole load ---------------------------------------------------------------------------


def _order_records(t: Tables) -> DataFrame:
    """Each order as a raw record of its customer.

    Country, currency, framework, year end, risks and methodologies change from order to
    order, each by a rule of its own, so any of them can start a version.
    """
    level = F.left("o_orderpriority", F.lit(1)).cast("int")
    mixed = F.col("o_orderstatus") == "P"
    known = {
        "source_filename": F.format_string("order-%010d.xlsm", F.col("o_orderkey")),
        "rated_entity": F.col("c_name"),
        "sector": F.col("c_mktsegment"),
        "country": F.concat(F.lit("Country "), F.col("o_orderstatus")),
        "currency": F.when(F.year("o_orderdate") >= 1998, "USD").otherwise("EUR"),
        "accounting_principles": F.when(level <= 2, "IFRS").otherwise("US GAAP"),
        "business_year_end": F.when(F.month("o_orderdate") <= 6, "June").otherwise("December"),
        "methodology_1": F.lit("General"),
        "methodology_2": F.when(level == 3, F.col("c_mktsegment")),
        "industry_risk_1": F.lit("Industry"),
        "industry_risk_2": F.when(mixed, "Trade"),
        "industry_risk_score_1": F.lit("BBB"),
        "industry_weight_1": F.when(mixed, 0.75).otherwise(1.0),
        "industry_weight_2": F.when(mixed, 0.25),
        "liquidity_adjustment": F.lit("+1 notch"),
        "business_risk_profile": F.element_at(
            F.array(*[F.lit(s) for s in ("AAA", "A", "BBB", "BB", "B")]), level
        ),
        "scope_credit_metrics": F.create_map(
            F.lit("Liquidity (time-series)"),
            F.create_map(
                F.year("o_orderdate").cast("string"),
                F.struct(F.lit("n").alias("kind"), F.floor("o_totalprice").cast("string").alias("text")),
            ),
        ),
    }
    joined = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return joined.select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_RECORD.fields]
    )


def _load(t: Tables) -> Warehouse:
    """Loads the records in two batches: first the orders with status F, then all.

    The second batch meets its known content again and must skip it.
    """
    warehouse = Warehouse(t.spark, shared_dir(t.spark, "warehouse"))
    warehouse.create()
    records = _order_records(t)
    first = records.filter("country = 'Country F'")
    mtimes = records.select("source_filename", F.current_timestamp().alias("file_modified_at"))
    for name, batch in (("first", first), ("second", records)):
        run = warehouse.begin_run(name)
        with reported_run(warehouse, run) as counts:
            counts.update(load_records(warehouse, batch, mtimes, run))
    return warehouse


_LOADED: dict[tuple[str, str], Warehouse] = {}


def _shared_load(t: Tables) -> Warehouse:
    """One load per session and folder for all queries that only read its tables."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _LOADED:
        _LOADED[key] = _load(t)
    return _LOADED[key]


_LOAD_SQL = """
    WITH content AS (
        SELECT o_orderkey, c_name, c_mktsegment, o_orderstatus, o_orderstatus <> 'F' AS second,
               substr(o_orderpriority, 1, 1) AS level, year(o_orderdate) AS y,
               floor(o_totalprice) AS v, month(o_orderdate) <= 6 AS early
        FROM orders JOIN customer ON c_custkey = o_custkey),
    kept AS (
        SELECT *, row_number() OVER (ORDER BY second, o_orderkey) AS upload_id,
               CASE WHEN y >= 1998 THEN 'USD' ELSE 'EUR' END AS currency,
               CASE WHEN level <= '2' THEN 'IFRS' ELSE 'US GAAP' END AS framework,
               CASE WHEN early THEN 6 ELSE 12 END AS month,
               CASE WHEN o_orderstatus = 'P' THEN 'Industry 0.7500, Trade 0.2500'
                    ELSE 'Industry 1.0000' END AS risks,
               CASE WHEN level <> '3' THEN 'General' WHEN c_mktsegment < 'General'
                    THEN c_mktsegment || ', General' ELSE 'General, ' || c_mktsegment END AS methodologies
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY c_name, c_mktsegment, o_orderstatus, level, y, v, early
                  ORDER BY second, o_orderkey) AS rn FROM content)
        WHERE rn = 1),
    tracked AS (
        SELECT *, concat_ws('|', o_orderstatus, currency, framework, month, risks, methodologies) AS tracked
        FROM kept),
    marked AS (
        SELECT *, lag(tracked) OVER (PARTITION BY c_name ORDER BY upload_id) IS DISTINCT FROM tracked AS starts
        FROM tracked),
    facts AS (
        SELECT *, max(CASE WHEN starts THEN upload_id END)
                  OVER (PARTITION BY c_name ORDER BY upload_id) AS company_id,
               CASE level WHEN '1' THEN 'AAA' WHEN '2' THEN 'A' WHEN '3' THEN 'BBB'
                          WHEN '4' THEN 'BB' ELSE 'B' END AS profile
        FROM marked),
    versions AS (
        SELECT *, row_number() OVER (PARTITION BY c_name ORDER BY company_id) AS version_no,
               row_number() OVER (PARTITION BY c_name ORDER BY company_id DESC) = 1 AS is_current
        FROM facts WHERE starts)
"""


@query(_LOAD_SQL + """
    SELECT f.upload_id, f.company_id, f.c_name AS entity_name, 'Country ' || f.o_orderstatus AS country,
           f.currency AS reporting_currency, f.profile AS business_risk_profile,
           CAST(f.y AS VARCHAR) AS year, CAST(CAST(f.v AS BIGINT) AS VARCHAR) AS metric_value,
           v.version_no, v.is_current, v.month, v.framework AS accounting_principles,
           v.risks, v.methodologies
    FROM facts f JOIN versions v ON v.company_id = f.company_id
""")
def incremental_star_load(t: Tables) -> DataFrame:
    """Two batches through checks, hashing, de-duplication and versioning into all tables."""
    warehouse = _load(t)
    dim = warehouse.read("dim_company")
    facts = reads.snapshots(warehouse.read("fact_ratings"), dim)
    history = warehouse.read("fact_scope_credit_hist").select("upload_id", "year", "metric_value")
    number = F.row_number().over(Window.partitionBy("entity_name").orderBy("valid_from"))
    versions = dim.select(
        "company_id", "is_current", "accounting_principles", number.alias("version_no"),
        F.col("business_year_end_month").cast("int").alias("month"),
    )
    risks = reads.version_risks(warehouse.read("dim_company_industry_risk")).select(
        "company_id",
        F.array_join(F.transform("risks", lambda r: F.concat_ws(" ", r["name"], r["weight"])), ", ").alias("risks"),
    )
    methods = reads.version_methodologies(warehouse.read("dim_company_rating_methodology")).select(
        "company_id", F.array_join("methodologies", ", ").alias("methodologies")
    )
    for table in (versions, risks, methods):
        facts = facts.join(table, "company_id")
    return facts.join(history, "upload_id").select(
        "upload_id", "company_id", "entity_name", "country",
        F.col("currency").alias("reporting_currency"), "business_risk_profile", "year", "metric_value", "version_no", "is_current", "month",
        "accounting_principles", "risks", "methodologies",
    )


@query(_LOAD_SQL + """
    SELECT 'first' AS dag_run_id, 'success' AS status, count(*) FILTER (o_orderstatus = 'F') AS files_staged,
           (SELECT count(*) FROM kept WHERE o_orderstatus = 'F') AS files_loaded,
           count(*) FILTER (o_orderstatus = 'F') - (SELECT count(*) FROM kept WHERE o_orderstatus = 'F') AS files_skipped
    FROM content
    UNION ALL
    SELECT 'second', 'success', count(*), (SELECT count(*) FROM kept WHERE o_orderstatus <> 'F'),
           count(*) - (SELECT count(*) FROM kept WHERE o_orderstatus <> 'F')
    FROM content
""")
def report_run_history(t: Tables) -> DataFrame:
    rows = reads.run_history(_shared_load(t).read("pipeline_run_state")).drop("completed_at_utc")
    counts = ["files_staged", "files_loaded", "files_skipped"]
    return rows.withColumns({c: F.col(c).cast("long") for c in counts})


@query(_LOAD_SQL + """
    SELECT c_name AS entity_name, c_mktsegment AS sector_name, 'Country ' || o_orderstatus AS country,
           currency AS reporting_currency, framework AS accounting_principles
    FROM versions WHERE is_current
""")
def report_companies(t: Tables) -> DataFrame:
    return reads.company_overview(_shared_load(t).read("dim_company")).drop("valid_from")


@query(_LOAD_SQL + """
    SELECT c_name AS entity_name, unnest(string_split(methodologies, ', ')) AS rating_methodology_name
    FROM versions WHERE is_current
""")
def report_methodologies(t: Tables) -> DataFrame:
    warehouse = _shared_load(t)
    return reads.current_methodologies(
        warehouse.read("dim_company_rating_methodology"), warehouse.read("dim_company")
    )


@query(_LOAD_SQL + """
    SELECT c_name AS entity_name, split_part(r, ' ', 1) AS industry_risk_name,
           CAST(split_part(r, ' ', 2) AS DOUBLE) AS weight
    FROM (SELECT c_name, unnest(string_split(risks, ', ')) AS r FROM versions WHERE is_current)
""")
def report_risk_weights(t: Tables) -> DataFrame:
    warehouse = _shared_load(t)
    rows = reads.current_risk_weights(
        warehouse.read("dim_company_industry_risk"), warehouse.read("dim_company")
    )
    return rows.withColumn("weight", F.col("weight").cast("double"))


@query(_LOAD_SQL + """
    SELECT c_name AS entity_name, c_mktsegment AS sector_name, profile AS business_risk_profile,
           '+1 notch' AS liquidity
    FROM facts
""")
def report_all_scores(t: Tables) -> DataFrame:
    warehouse = _shared_load(t)
    rows = reads.all_scores(warehouse.read("fact_ratings"), warehouse.read("dim_company"))
    return rows.select("entity_name", "sector_name", "business_risk_profile", "liquidity")


@query(_LOAD_SQL + """
    SELECT c_name AS entity_name, 'Liquidity (time-series)' AS metric_name, CAST(y AS VARCHAR) AS year,
           CAST(CAST(v AS BIGINT) AS VARCHAR) AS metric_value
    FROM facts WHERE c_name = 'Customer#000000007'
""")
def report_metric_series(t: Tables) -> DataFrame:
    warehouse = _shared_load(t)
    return reads.metric_series(
        warehouse.read("fact_scope_credit_hist"), warehouse.read("dim_company"), "Customer#000000007"
    )


@query(_LOAD_SQL + """
    SELECT c_name AS entity_name, version_no, is_current, NOT is_current AS closed FROM versions
    WHERE c_name = 'Customer#000000007'
""")
def report_version_history(t: Tables) -> DataFrame:
    rows = reads.version_history(_shared_load(t).read("dim_company"), "Customer#000000007")
    number = F.row_number().over(Window.partitionBy("entity_name").orderBy("valid_from"))
    # a version ends where the next one begins
    following = F.lead("valid_from").over(Window.partitionBy("entity_name").orderBy("valid_from"))
    return rows.withColumns({"version_no": number, "closed": F.coalesce(F.col("valid_to") == following, F.lit(False))}).select(
        "entity_name", "version_no", "is_current", "closed"
    )


@query(_LOAD_SQL + """
    SELECT company_id, c_name AS entity_name, 'Country ' || o_orderstatus AS country, month
    FROM versions WHERE is_current AND c_name = 'Customer#000000007'
""")
def report_company(t: Tables) -> DataFrame:
    row = reads.company(_shared_load(t).read("dim_company"), "Customer#000000007")
    return row.select(
        "company_id", "entity_name", "country", F.col("business_year_end_month").cast("int").alias("month")
    )


@query(_LOAD_SQL + """
    SELECT format('order-{:010d}.xlsm', o_orderkey) AS source_filename, 1 AS rows_extracted, upload_id,
           64 AS hash_length FROM facts
""")
def report_uploads(t: Tables) -> DataFrame:
    log = _shared_load(t).read("upload_log")
    overview = reads.upload_overview(log).join(log.select("source_filename", "upload_id"), "source_filename")
    return overview.select(
        "source_filename", "rows_extracted", "upload_id", F.length("data_hash").alias("hash_length")
    )


@query("""
    WITH content AS (
        SELECT o_orderkey, c_name, c_mktsegment, o_orderstatus, o_orderpriority,
               year(o_orderdate) AS y, floor(o_totalprice) AS v, month(o_orderdate) <= 6 AS early
        FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT count(*) AS records,
           (SELECT count(*) FROM (SELECT DISTINCT c_name, c_mktsegment, o_orderstatus, o_orderpriority, y, v, early
                                  FROM content)) AS contents,
           count(*) AS months_known
    FROM content
""")
def normalised_contents(t: Tables) -> DataFrame:
    """Records and distinct content hashes after normalisation."""
    rows = normalise(_order_records(t).withColumn("file_modified_at", F.current_timestamp()))
    return rows.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("data_hash").alias("contents"),
        F.count("business_year_end_month").alias("months_known"),
    )


# --- quarantine -----------------------------------------------------------------------------


def _part_records(t: Tables) -> DataFrame:
    """Each part as a raw record; small sizes have no country, large ones weights that are off."""
    known = {
        "source_filename": F.format_string("part-%010d.xlsm", F.col("p_partkey")),
        "rated_entity": F.col("p_name"), "sector": F.col("p_type"),
        "country": F.when(F.col("p_size") > 10, F.lit("Country")),
        "currency": F.lit("EUR"), "accounting_principles": F.lit("IFRS"),
        "business_year_end": F.lit("May"), "methodology_1": F.col("p_brand"),
        "industry_risk_1": F.lit("Industry"), "industry_risk_score_1": F.lit("BBB"),
        "industry_weight_1": F.when(F.col("p_size") > 45, 0.5).otherwise(1.0),
        "sector_specific_factor_1": F.col("p_partkey").cast("string"),
    }
    return t.part.select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_RECORD.fields]
    )


@query("""
    SELECT p_partkey, p_size <= 10 OR p_size > 45 AS was_rejected, p_size > 10 AS is_loaded, p_size <= 10 AS in_quarantine,
           CASE WHEN p_size <= 10 OR p_size > 45 THEN 1 ELSE 0 END AS reasons
    FROM part
""")
def quarantine_and_replay(t: Tables) -> DataFrame:
    """A load that sets bad records aside, and a second one with the corrected part of them.

    The corrected weights load; the records without a country are rejected again.
    """
    warehouse = Warehouse(t.spark, shared_dir(t.spark, "quarantine"))
    warehouse.create()
    records = _part_records(t)
    mtimes = records.select("source_filename", F.current_timestamp().alias("file_modified_at"))
    run = warehouse.begin_run("first")
    with reported_run(warehouse, run) as counts:
        counts.update(load_records(warehouse, records, mtimes, run, QUARANTINE))
    waiting = still_quarantined(warehouse)
    replay(warehouse, "second", waiting.withColumn("industry_weight_1", F.lit(1.0)))
    rejected = warehouse.read("quarantine").filter("dag_run_id = 'first'")
    bad = rejected.select("source_filename", F.size("reasons").alias("reasons"), F.lit(True).alias("was_rejected"))
    good = warehouse.read("upload_log").select("source_filename", F.lit(True).alias("is_loaded"))
    still = still_quarantined(warehouse).select("source_filename", F.lit(True).alias("in_quarantine"))
    rows = records.select("source_filename", F.col("sector_specific_factor_1").cast("long").alias("p_partkey"))
    for table in (bad, good, still):
        rows = rows.join(table, "source_filename", "left")
    no = F.lit(False)
    return rows.select(
        "p_partkey", *[F.coalesce(c, no).alias(c) for c in ("was_rejected", "is_loaded", "in_quarantine")],
        F.coalesce("reasons", F.lit(0)).alias("reasons"),
    )
