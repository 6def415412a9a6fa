"""The operators bound to the star-schema test tables, each with equivalent SQL.

Customers are the entities, orders their dated snapshots, line items the details.
Every query runs over its whole tables; a filter is there only where it is what
the operator does.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions.canonical import content_hash
from tidemark.operators import audit, dedup, kvsheet, latest, lookup, reshape, scd2
from tidemark.operators import filters as flt
from tidemark.operators.ordered import dense_ids
from tidemark.sources.files import source_file_status
from tidemark.sources.warehouse import last_success, run_state


class Tables:
    """The tables of one folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    """Registers a function of Tables under its name, with its SQL if there is one."""

    def register(function: Callable[[Tables], DataFrame]):
        name = function.__name__
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql:
            SQL[name] = sql
        return function

    return register


# --- latest and as-of -------------------------------------------------------------------


@query("""
    SELECT c_name, c_mktsegment, o_orderkey, o_orderdate, o_totalprice, o_orderstatus
    FROM (SELECT *, row_number() OVER (PARTITION BY c_name
                                       ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders LEFT JOIN customer ON c_custkey = o_custkey)
    WHERE rn = 1
""")
def latest_per_entity(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    rows = latest.latest_with_parent(
        t.orders, customers, "o_custkey", "c_name", ["o_orderdate", "o_orderkey"]
    )
    return rows.select(
        "c_name", "c_mktsegment", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"
    )


@query("""
    SELECT c_mktsegment, o_orderkey, o_orderdate, o_totalprice
    FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment
                                       ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders JOIN customer ON c_custkey = o_custkey
          WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')
            AND o_orderdate <= TIMESTAMP '1998-06-30 00:00:00')
    WHERE rn = 1
""")
def compare_as_of(t: Tables) -> DataFrame:
    names = tx.name_list("BUILDING, MACHINERY,, FURNITURE ")
    segments = t.customer.filter(F.col("c_mktsegment").isin(names)).select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment"
    )
    rows = latest.as_of(
        t.orders.join(segments, "o_custkey"), ["c_mktsegment"], ["o_orderdate", "o_orderkey"],
        datetime(1998, 6, 30),
    )
    return rows.select("c_mktsegment", "o_orderkey", "o_orderdate", "o_totalprice").orderBy(
        *flt.ascending("c_mktsegment")
    )


@query("""
    SELECT o_custkey, as_of, o_orderkey, o_orderdate
    FROM (SELECT o_custkey, as_of, o_orderkey, o_orderdate,
                 row_number() OVER (PARTITION BY o_custkey, as_of
                                    ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders JOIN (SELECT unnest([TIMESTAMP '1995-12-31', TIMESTAMP '1996-12-31',
                                           TIMESTAMP '1997-12-31', TIMESTAMP '1998-12-31',
                                           TIMESTAMP '1999-12-31', TIMESTAMP '2000-12-31']) AS as_of)
               ON o_orderdate <= as_of)
    WHERE rn = 1
""")
def as_of_many_dates(t: Tables) -> DataFrame:
    year_ends = [datetime(year, 12, 31) for year in range(1995, 2001)]
    rows = latest.as_of_dates(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], year_ends)
    return rows.select("o_custkey", "as_of", "o_orderkey", "o_orderdate")


@query("""
    SELECT event_id, user_id, ts, last_id, last_value
    FROM (SELECT e.event_id, e.user_id, e.ts, p.event_id AS last_id, p.value AS last_value,
                 row_number() OVER (PARTITION BY e.event_id
                                    ORDER BY p.ts DESC NULLS LAST, p.event_id DESC NULLS LAST) AS rn
          FROM events e
          LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
               ON p.user_id = e.user_id AND p.ts <= e.ts)
    WHERE rn = 1
""")
def last_purchase_as_of_event(t: Tables) -> DataFrame:
    purchases = t.events.filter("event_type = 'purchase'").select(
        "user_id", "ts", "event_id",
        F.col("event_id").alias("last_id"), F.col("value").alias("last_value"),
    )
    return latest.as_of_join(
        t.events.select("event_id", "user_id", "ts"), purchases, ["user_id"],
        ["ts", "event_id"], ["ts", "event_id"], ["last_id", "last_value"],
    )


# --- filters and lookups ----------------------------------------------------------------


def _order_snapshots(t: Tables) -> DataFrame:
    place = t.customer.join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "n_name")
    return t.orders.join(place, "o_custkey", "left")


_SNAPSHOT_SQL = """
    SELECT o_orderkey AS snapshot_id, c_name AS entity_name, c_mktsegment AS sector,
           n_name AS country, o_orderstatus AS currency, o_totalprice, o_orderdate
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
                LEFT JOIN nation ON n_nationkey = c_nationkey
"""


def _public(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("o_orderkey").alias("snapshot_id"), F.col("c_name").alias("entity_name"),
        F.col("c_mktsegment").alias("sector"), F.col("n_name").alias("country"),
        F.col("o_orderstatus").alias("currency"), "o_totalprice", "o_orderdate",
    )


@query(_SNAPSHOT_SQL + """
    WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate <= TIMESTAMP '1999-09-30'
      AND c_mktsegment ILIKE '%build%' AND n_name ILIKE '%nation_1%' AND o_orderstatus = 'F'
    ORDER BY o_orderdate DESC
""")
def filtered_snapshots(t: Tables) -> DataFrame:
    rows = flt.all_given(
        _order_snapshots(t),
        [
            flt.equals("o_orderkey", None),
            flt.at_least("o_orderdate", datetime(1996, 3, 1)),
            flt.at_most("o_orderdate", datetime(1999, 9, 30)),
            flt.contains("c_mktsegment", "build"),
            flt.contains("n_name", "nation_1"),
            flt.equals_upper("o_orderstatus", "f"),
        ],
    )
    return _public(rows.orderBy(*flt.descending("o_orderdate")))


@query(_SNAPSHOT_SQL)
def unfiltered_snapshots(t: Tables) -> DataFrame:
    return _public(flt.all_given(_order_snapshots(t), [None, None]))


@query(_SNAPSHOT_SQL + " WHERE o_orderkey = 4321")
def snapshot_by_id(t: Tables) -> DataFrame:
    return _public(flt.all_given(_order_snapshots(t), [flt.equals("o_orderkey", 4321)]))


@query("""
    SELECT c_mktsegment AS entity_name, o_orderkey, l_linenumber, l_partkey, l_quantity
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
                  JOIN customer ON c_custkey = o_custkey
    WHERE c_mktsegment = 'BUILDING'
    ORDER BY l_linenumber, o_orderkey, l_partkey
""")
def entity_history(t: Tables) -> DataFrame:
    wanted = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_mktsegment")
    versions = t.orders.join(wanted, F.col("o_custkey") == F.col("c_custkey"))
    rows = t.lineitem.join(versions, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        F.col("c_mktsegment").alias("entity_name"), "o_orderkey", "l_linenumber", "l_partkey",
        "l_quantity",
    ).orderBy(*flt.ascending("l_linenumber", "o_orderkey", "l_partkey"))


@query("""
    SELECT doc_id, lang, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic
    FROM documents LEFT JOIN labels USING (doc_id)
""")
def lookup_with_default(t: Tables) -> DataFrame:
    return lookup.lookup(
        t.documents.select("doc_id", "lang"), t.labels, ["doc_id"],
        {"quality": F.lit(-1), "toxic": F.lit(0)},
    )


@query("""
    SELECT doc_id AS upload_id, l.path,
           CASE WHEN l.path IS NULL THEN 'missing_file' ELSE 'found' END AS status
    FROM documents
    LEFT JOIN (SELECT doc_id, 'in/doc-' || doc_id || '.xlsm' AS path FROM labels) l USING (doc_id)
""")
def source_file_lookup(t: Tables) -> DataFrame:
    uploads = t.documents.select(
        F.col("doc_id").alias("upload_id"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".xlsm")).alias("source_filename"),
    )
    path = F.concat(F.lit("in/doc-"), F.col("doc_id").cast("string"), F.lit(".xlsm"))
    files = t.labels.select(path.alias("path"), tx.file_name(path).alias("source_filename"))
    return source_file_status(uploads, files).select("upload_id", "path", "status")


# --- totals and nesting -----------------------------------------------------------------


@query("""
    SELECT count(*) AS total_uploads, count(DISTINCT o_custkey) AS unique_files,
           count(DISTINCT l_partkey) AS unique_companies,
           min(o_orderdate) AS earliest_upload, max(o_orderdate) AS latest_upload
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
""")
def upload_stats(t: Tables) -> DataFrame:
    children = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    measures = [
        F.count_distinct("o_custkey").alias("unique_files"),
        F.min("o_orderdate").alias("earliest_upload"),
        F.max("o_orderdate").alias("latest_upload"),
    ]
    return lookup.left_join_totals(
        t.orders, children, "o_orderkey", "l_partkey", measures, "total_uploads", "unique_companies"
    )


@query("""
    WITH numbered AS (
        SELECT *, (row_number() OVER (PARTITION BY l_orderkey
                                      ORDER BY l_linenumber, l_partkey, l_suppkey) - 1) // 3 AS page
        FROM lineitem)
    SELECT o_orderkey, o_orderdate, CAST(coalesce(page, 0) AS BIGINT) AS page,
           CAST(count(l_orderkey) AS INTEGER) AS n,
           coalesce(string_agg(l_linenumber || ':' || l_partkey, ','
                               ORDER BY l_linenumber, l_partkey, l_suppkey), '') AS items
    FROM orders LEFT JOIN numbered ON l_orderkey = o_orderkey
    GROUP BY o_orderkey, o_orderdate, page
""")
def parent_with_children(t: Tables) -> DataFrame:
    children = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    nested = reshape.nest_children(
        t.orders.select("o_orderkey", "o_orderdate"), children, "o_orderkey",
        ["l_linenumber", "l_partkey", "l_suppkey"], ["l_linenumber", "l_partkey"], "children", page_rows=3,
    )
    item = lambda c: F.concat_ws(
        ":", c["l_linenumber"].cast("string"), c["l_partkey"].cast("string")
    )
    return nested.select(
        "o_orderkey", "o_orderdate", "page", F.size("children").alias("n"),
        F.array_join(F.transform("children", item), ",").alias("items"),
    )


@query("""
    SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types
    FROM part GROUP BY p_brand
""")
def sorted_name_list(t: Tables) -> DataFrame:
    pairs = t.part.select("p_brand", "p_type").distinct()
    lists = pairs.groupBy("p_brand").agg(F.array_sort(F.collect_list("p_type")).alias("types"))
    return lists.select("p_brand", F.array_join("types", ",").alias("types"))


@query("""
    SELECT p_brand, page, count(*) AS n, string_agg(p_name, ',' ORDER BY p_name) AS names
    FROM (SELECT p_brand, p_name,
                 (row_number() OVER (PARTITION BY p_brand ORDER BY p_name) - 1) // 4 AS page
          FROM (SELECT DISTINCT p_brand, p_name FROM part))
    GROUP BY p_brand, page
""")
def sorted_names_in_pages(t: Tables) -> DataFrame:
    """The sorted list of a brand's names, four to a row: no list grows with its group."""
    pairs = t.part.select("p_brand", "p_name").distinct()
    brands = t.part.select("p_brand").distinct()
    nested = reshape.nest_children(
        brands, pairs, "p_brand", ["p_name"], ["p_name"], "names", page_rows=4
    )
    return nested.select(
        "p_brand", F.col("page").cast("long").alias("page"), F.size("names").cast("long").alias("n"),
        F.array_join(F.transform("names", lambda c: c["p_name"]), ",").alias("names"),
    )


@query("""
    SELECT name, count(DISTINCT spelling) AS spellings, dense_rank() OVER (ORDER BY name) AS place
    FROM (SELECT lower(p_name) AS name, CASE WHEN p_size % 2 = 0 THEN upper(p_name) ELSE p_name END AS spelling
          FROM part) GROUP BY name
""")
def names_in_collation(t: Tables) -> DataFrame:
    """Names grouped and numbered by a case-insensitive collation, as a database may sort."""
    spelling = F.when(F.col("p_size") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    rows = t.part.select(spelling.alias("spelling"), flt.collated(spelling).alias("key"))
    groups = rows.groupBy("key").agg(
        F.count_distinct("spelling").alias("spellings"), F.lower(F.min("spelling")).alias("name")
    )
    return dense_ids(groups, ["key"], "place").select("name", "spellings", "place")


# --- type-2 history ---------------------------------------------------------------------

_VERSIONS_SQL = """
    WITH marked AS (
        SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate,
               lag(o_orderpriority) OVER w IS DISTINCT FROM o_orderpriority
               OR lag(o_orderkey) OVER w IS NULL AS starts
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
    versions AS (
        SELECT o_custkey, o_orderpriority, o_orderkey,
               row_number() OVER w AS version_no, o_orderdate AS valid_from,
               lead(o_orderdate) OVER w AS valid_to, lead(o_orderkey) OVER w IS NULL AS is_current
        FROM marked WHERE starts WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
"""


def _versions(t: Tables) -> DataFrame:
    return scd2.versions(
        t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderpriority"], ["o_orderkey"]
    )


@query(_VERSIONS_SQL + "SELECT * FROM versions")
def scd2_versions(t: Tables) -> DataFrame:
    return _versions(t)


@query(_VERSIONS_SQL + """
    SELECT o_custkey AS company_id, c_name AS entity_name, o_orderpriority AS sector, valid_from
    FROM versions JOIN customer ON c_custkey = o_custkey WHERE is_current ORDER BY c_name
""")
def current_companies(t: Tables) -> DataFrame:
    rows = scd2.current(_versions(t)).join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return rows.select(
        F.col("o_custkey").alias("company_id"), F.col("c_name").alias("entity_name"),
        F.col("o_orderpriority").alias("sector"), "valid_from",
    ).orderBy(*flt.ascending("entity_name"))


@query(_VERSIONS_SQL + """
    SELECT c_name, version_no, o_orderpriority, valid_from, valid_to, is_current
    FROM versions JOIN customer ON c_custkey = o_custkey
    WHERE c_name = 'Customer#000000042' ORDER BY valid_from
""")
def entity_versions(t: Tables) -> DataFrame:
    wanted = t.customer.filter(F.col("c_name") == "Customer#000000042").select("c_custkey", "c_name")
    orders = t.orders.join(wanted, F.col("o_custkey") == F.col("c_custkey"))
    rows = scd2.versions(orders, ["c_name"], ["o_orderdate", "o_orderkey"], ["o_orderpriority"])
    return rows.orderBy(*flt.ascending("valid_from"))


@query(_VERSIONS_SQL + """
    SELECT o_custkey, version_no, o_orderpriority, valid_from, valid_to FROM versions
    WHERE valid_from <= TIMESTAMP '1998-01-01' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1998-01-01')
""")
def point_in_time_version(t: Tables) -> DataFrame:
    return scd2.valid_at(_versions(t), datetime(1998, 1, 1)).select(
        "o_custkey", "version_no", "o_orderpriority", "valid_from", "valid_to"
    )


@query(_VERSIONS_SQL + """
    SELECT o_orderkey, o_custkey, starts AS starts_version,
           max_by(CASE WHEN starts THEN o_orderkey END,
                  CASE WHEN starts THEN (o_orderdate, o_orderkey) END)
               OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version_key
    FROM marked
""")
def version_of_each_fact(t: Tables) -> DataFrame:
    rows = scd2.assign_versions(
        t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority"),
        ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderpriority"], F.col("o_orderkey"),
        "version_key",
    )
    return rows.select("o_orderkey", "o_custkey", "starts_version", "version_key")


@query(_VERSIONS_SQL + """
    , keyed AS (
        SELECT o_orderkey, o_custkey, o_orderdate, starts,
               max_by(CASE WHEN starts THEN o_orderkey END,
                      CASE WHEN starts THEN (o_orderdate, o_orderkey) END)
                   OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version_key
        FROM marked)
    SELECT o_orderkey, o_custkey, starts AS starts_version, version_key
    FROM keyed WHERE o_orderdate >= TIMESTAMP '1999-01-01'
""")
def incremental_versions(t: Tables) -> DataFrame:
    """A second batch continues the versions that the first one left open."""
    cut = tx.moment(datetime(1999, 1, 1))
    early, late = t.orders.filter(F.col("o_orderdate") < cut), t.orders.filter(F.col("o_orderdate") >= cut)
    first = scd2.versions(
        early, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderpriority"], ["o_orderkey"]
    )
    open_versions = scd2.current(first).withColumnRenamed("o_orderkey", "version_key")
    rows = scd2.continue_versions(
        late.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority"), open_versions,
        ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderpriority"], "o_orderkey", "version_key",
    )
    return rows.select("o_orderkey", "o_custkey", "starts_version", "version_key")


# --- de-duplication ---------------------------------------------------------------------


def _text_hash() -> Column:
    return F.sha2("text", 256)


@query("""
    SELECT doc_id, lang, source, data_hash
    FROM (SELECT doc_id, lang, source, sha256(text) AS data_hash,
                 row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS rn FROM documents)
    WHERE rn = 1
""")
def dedup_first(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "lang", "source", _text_hash().alias("data_hash"))
    return dedup.new_content(rows, None, ["data_hash"], ["doc_id"])


@query("""
    WITH batch AS (SELECT doc_id, sha256(text) AS h FROM documents
                   WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
    history AS (SELECT sha256(text) AS h FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
    SELECT doc_id, h AS data_hash
    FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id) AS rn FROM batch)
    WHERE rn = 1 AND h NOT IN (SELECT h FROM history)
""")
def not_yet_loaded(t: Tables) -> DataFrame:
    batch, history = _batch_and_history(t)
    return dedup.new_content(batch, history, ["data_hash"], ["doc_id"])


def _batch_and_history(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Labelled documents count as loaded, the others are the batch."""
    rows = t.documents.select("doc_id", _text_hash().alias("data_hash"))
    return rows.join(t.labels, "doc_id", "left_anti"), rows.join(t.labels, "doc_id", "left_semi")


_STATUS_SQL = """
    WITH batch AS (SELECT doc_id, sha256(text) AS h FROM documents
                   WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
    history AS (SELECT sha256(text) AS h FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
    marked AS (SELECT doc_id, substr(h, 1, 12) AS hash_prefix,
                      CASE WHEN row_number() OVER (PARTITION BY h ORDER BY doc_id) = 1
                            AND h NOT IN (SELECT h FROM history)
                           THEN 'loaded' ELSE 'skipped_duplicate' END AS status FROM batch)
"""


def _load_status(t: Tables) -> DataFrame:
    batch, history = _batch_and_history(t)
    rows = dedup.load_status(batch, history, ["data_hash"], ["doc_id"], ["doc_id"])
    return rows.select("doc_id", tx.hash_prefix(F.col("data_hash")).alias("hash_prefix"), "status")


@query(_STATUS_SQL + "SELECT * FROM marked")
def load_status(t: Tables) -> DataFrame:
    return _load_status(t)


@query(_STATUS_SQL + "SELECT status, count(*) AS files FROM marked GROUP BY status")
def load_counts(t: Tables) -> DataFrame:
    return _load_status(t).groupBy("status").agg(F.count(F.lit(1)).alias("files"))


@query("""
    SELECT min(doc_id) AS doc_id, text FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE d.text = b.text) GROUP BY text
""")
def insert_if_absent(t: Tables) -> DataFrame:
    rows = dedup.insert_if_absent(t.documents, t.benchmark, ["text"], ["doc_id"])
    return rows.select("doc_id", "text")


# --- reshaping --------------------------------------------------------------------------


@query("""
    SELECT * FROM (
        SELECT l_orderkey, nullif(l_returnflag, 'N') AS risk_name,
               CAST(CAST(l_discount AS DECIMAL(5,4)) AS DOUBLE) AS weight FROM lineitem
        UNION ALL
        SELECT l_orderkey, nullif(l_linestatus, 'F'), CAST(CAST(l_tax AS DECIMAL(5,4)) AS DOUBLE)
        FROM lineitem)
    WHERE risk_name IS NOT NULL AND risk_name <> ''
""")
def bridge_unpivot(t: Tables) -> DataFrame:
    slots = [
        (F.nullif(F.col("l_returnflag"), F.lit("N")), tx.round4(F.col("l_discount"))),
        (F.nullif(F.col("l_linestatus"), F.lit("F")), tx.round4(F.col("l_tax"))),
    ]
    rows = reshape.numbered_columns_to_rows(t.lineitem, ["l_orderkey"], slots, ["risk_name", "weight"])
    return rows.withColumn("weight", F.col("weight").cast("double"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN r IS NULL AND s IS NULL THEN ''
                WHEN s IS NULL OR r = s THEN r WHEN r IS NULL THEN s
                WHEN r < s THEN r || ',' || s ELSE s || ',' || r END AS names
    FROM (SELECT *, nullif(l_returnflag, 'N') AS r, nullif(l_linestatus, 'F') AS s FROM lineitem)
""")
def sorted_names_in_row(t: Tables) -> DataFrame:
    names = scd2.sorted_names(
        [F.nullif(F.col("l_returnflag"), F.lit("N")), F.nullif(F.col("l_linestatus"), F.lit("F"))]
    )
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.array_join(names, ",").alias("names")
    )


@query(_VERSIONS_SQL + """
    SELECT o_custkey, risk_name, weight
    FROM (SELECT l_orderkey, nullif(l_returnflag, 'N') AS risk_name,
                 CAST(CAST(l_discount AS DECIMAL(5,4)) AS DOUBLE) AS weight FROM lineitem
          UNION ALL
          SELECT l_orderkey, nullif(l_linestatus, 'F'), CAST(CAST(l_tax AS DECIMAL(5,4)) AS DOUBLE)
          FROM lineitem) b
    JOIN versions ON versions.o_orderkey = b.l_orderkey AND versions.is_current
    WHERE risk_name IS NOT NULL
""")
def bridge_of_current_version(t: Tables) -> DataFrame:
    ids = scd2.current(_versions(t)).select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    rows = bridge_unpivot(t).join(ids, "l_orderkey").select("o_custkey", "risk_name", "weight")
    return rows.orderBy(*flt.ascending("o_custkey"), *flt.descending("weight"))


@query("""
    SELECT event_id, event_type AS metric_name, 'k' AS year,
           json_extract_string(props, '$.k') AS metric_value
    FROM events
""")
def map_explode(t: Tables) -> DataFrame:
    series = F.create_map("event_type", F.from_json("props", "map<string,string>"))
    return reshape.nested_map_to_rows(
        t.events, ["event_id"], series, "metric_name", "year", "metric_value"
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, metric, value
    FROM lineitem UNPIVOT (value FOR metric IN (l_quantity, l_extendedprice, l_discount, l_tax))
""")
def column_unpivot(t: Tables) -> DataFrame:
    return reshape.unpivot(
        t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey"],
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "metric", "value",
    )


@query("""
    SELECT b.user_id, b.metric, b.position, b.value, h.year
    FROM (SELECT user_id, event_type AS metric, day(ts) AS position, max_by(value, event_id) AS value
          FROM events WHERE event_type <> 'signup' GROUP BY ALL) b
    JOIN (SELECT user_id, day(ts) AS position, max_by(event_id, event_id) AS year
          FROM events WHERE event_type = 'signup' GROUP BY ALL) h USING (user_id, position)
""")
def header_unpivot(t: Tables) -> DataFrame:
    """Cells of a user's block joined to the header cell at the same position."""
    cells = t.events.select(
        "user_id", F.dayofmonth("ts").cast("long").alias("position"), "event_type", "event_id", "value"
    )
    headers = kvsheet.last_value_per_key(
        cells.filter("event_type = 'signup'").withColumn("year", F.col("event_id")),
        ["user_id", "position"], "event_id", ["year"],
    )
    block = kvsheet.last_value_per_key(
        cells.filter("event_type <> 'signup'").withColumnRenamed("event_type", "metric"),
        ["user_id", "metric", "position"], "event_id", ["value"],
    )
    rows = kvsheet.header_unpivot(block, headers, ["user_id"], "position")
    return rows.select("user_id", "metric", "position", "value", "year")


# --- key-value sheets -------------------------------------------------------------------


@query("""
    SELECT user_id, event_type, max_by(value, event_id) AS value, max_by(props, event_id) AS props
    FROM events GROUP BY user_id, event_type
""")
def last_value_per_key(t: Tables) -> DataFrame:
    return kvsheet.last_value_per_key(t.events, ["user_id", "event_type"], "event_id", ["value", "props"])


@query("""
    SELECT user_id,
           max_by(value, event_id) FILTER (event_type = 'click') AS click_value,
           max_by(value, event_id) FILTER (event_type = 'purchase') AS purchase_value,
           max_by(value, event_id) FILTER (event_type = 'signup') AS signup_value,
           max_by(value, event_id) FILTER (event_type = 'error') AS error_value,
           max_by(value, event_id) FILTER (event_type = 'view') AS view_value
    FROM events GROUP BY user_id
""")
def kv_pivot(t: Tables) -> DataFrame:
    labels = {e: f"{e}_value" for e in ("click", "purchase", "signup", "error", "view")}
    return kvsheet.pivot_last(t.events, ["user_id"], "event_type", "event_id", F.col("value"), labels)


@query("""
    SELECT user_id, event_type, event_id, value
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events)
    WHERE rn = 2
""")
def nth_occurrence(t: Tables) -> DataFrame:
    rows = latest.nth_occurrence(t.events, ["user_id", "event_type"], ["event_id"], 2)
    return rows.select("user_id", "event_type", "event_id", "value")


def _customer_sheets(t: Tables) -> DataFrame:
    """Each customer as a key-value sheet, built by Spark from the table."""

    def cell(kind: str, value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNotNull(), F.struct(F.lit(kind).alias("kind"), text.alias("text")))

    def line(row: int, label: str, *cells: Column) -> Column:
        blank = F.lit(None).cast("struct<kind:string,text:string>")
        return F.struct(
            F.lit(row).alias("row_idx"), F.array(blank, cell("s", F.lit(label)), *cells).alias("cells")
        )

    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    lines = F.array(
        line(0, "Rated entity", cell("s", F.lit("first, overwritten"))),
        line(1, " Rated entity ", cell("s", F.concat(F.lit(" "), F.col("c_name"), F.lit("\t")))),
        line(2, "CorporateSector", cell("s", F.col("c_mktsegment"))),
        line(3, "Industry weight", cell("n", F.lit(0.25)), cell("s", F.lit("n/k"))),
        line(4, "Liquidity", cell("s", F.lit("+1 notch"))),
        line(6, "[Scope Credit Metrics]", cell("n", F.lit("2020.0")), cell("s", F.lit("2021E")),
             F.lit(None).cast("struct<kind:string,text:string>"), cell("n", F.lit("2023"))),
        line(7, "Scope-adjusted FFO/debt", cell("n", balance), cell("s", F.lit("Locked")), cell("n", key)),
        line(8, "Liquidity", cell("n", key), cell("s", F.lit("  "))),
    )
    name = F.concat(F.lit("customer_"), key.cast("string"), F.lit(".xlsm"))
    return t.customer.select(name.alias("source_filename"), F.inline(lines))


@query("""
    SELECT 'customer_' || c_custkey || '.xlsm' AS source_filename, row_idx, texts
    FROM customer, LATERAL (VALUES
        (0, '|Rated entity|first, overwritten'), (1, '|Rated entity|' || c_name),
        (2, '|CorporateSector|' || c_mktsegment), (3, '|Industry weight|0.25|n/k'),
        (4, '|Liquidity|+1 notch'), (6, '|[Scope Credit Metrics]|2020.0|2021E||2023'),
        (7, '|Scope-adjusted FFO/debt|' || c_acctbal || '|Locked|' || c_custkey),
        (8, '|Liquidity|' || c_custkey || '|')) v(row_idx, texts)
""")
def stripped_cells(t: Tables) -> DataFrame:
    rows = kvsheet.strip_cells(_customer_sheets(t))
    texts = F.transform("cells", lambda c: F.coalesce(c["text"], F.lit("")))
    return rows.select("source_filename", "row_idx", F.array_join(texts, "|").alias("texts"))


@query("""
    SELECT 'customer_' || c_custkey || '.xlsm' AS source_filename, c_name AS rated_entity,
           c_mktsegment AS sector, 0.25 :: DOUBLE AS industry_weight_1,
           CAST(NULL AS DOUBLE) AS industry_weight_2, '+1 notch' AS liquidity_adjustment,
           CAST(NULL AS VARCHAR) AS country, CAST(2 AS INTEGER) AS metrics
    FROM customer
""")
def sheet_records(t: Tables) -> DataFrame:
    records = kvsheet.parse_records(_customer_sheets(t))
    return records.select(
        "source_filename", "rated_entity", "sector", "industry_weight_1", "industry_weight_2",
        "liquidity_adjustment", "country", F.size("scope_credit_metrics").alias("metrics"),
    )


@query("""
    SELECT 'customer_' || c_custkey || '.xlsm' AS source_filename, m.metric_name, m.year, m.metric_value
    FROM customer, LATERAL (VALUES
        ('Scope-adjusted FFO/debt', '2020', CAST(c_acctbal AS VARCHAR)),
        ('Scope-adjusted FFO/debt', '2021E', 'Locked'),
        ('Liquidity (time-series)', '2020', CAST(c_custkey AS VARCHAR)),
        ('Liquidity (time-series)', '2021E', NULL)) m(metric_name, year, metric_value)
""")
def sheet_series(t: Tables) -> DataFrame:
    rows = reshape.nested_map_to_rows(
        kvsheet.parse_records(_customer_sheets(t)), ["source_filename"], F.col("scope_credit_metrics"),
        "metric_name", "year", "cell",
    )
    return rows.select("source_filename", "metric_name", "year", F.col("cell.text").alias("metric_value"))


# --- scalar functions -------------------------------------------------------------------


@query("""
    SELECT p_partkey, raw,
           CASE WHEN raw = ' March ' THEN 3 WHEN raw = 'DECEMBER' THEN 12
                WHEN p_size % 4 = 0 AND p_size <= 12 THEN p_size END AS month
    FROM (SELECT *, CASE p_size % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN ' March '
                    WHEN 2 THEN 'DECEMBER' ELSE 'Q' || p_size END AS raw FROM part)
""")
def month_parse(t: Tables) -> DataFrame:
    size = F.col("p_size")
    raw = (
        F.when(size % 4 == 0, size.cast("string")).when(size % 4 == 1, " March ")
        .when(size % 4 == 2, "DECEMBER").otherwise(F.concat(F.lit("Q"), size.cast("string")))
    )
    rows = t.part.select("p_partkey", raw.alias("raw"))
    return rows.select("p_partkey", "raw", tx.month_number(F.col("raw")).alias("month"))


@query("""
    SELECT p_partkey, nullif(trim(raw), '') AS clean_text, TRY_CAST(trim(raw) AS DOUBLE) AS clean_number
    FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN ' ' || p_name || ' '
                 WHEN 1 THEN '   ' WHEN 2 THEN ' ' || p_retailprice ELSE p_size || '.5' END AS raw FROM part)
""")
def clean_cast(t: Tables) -> DataFrame:
    size = F.col("p_size")
    raw = (
        F.when(size % 4 == 0, F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")))
        .when(size % 4 == 1, "   ")
        .when(size % 4 == 2, F.concat(F.lit(" "), F.col("p_retailprice").cast("string")))
        .otherwise(F.concat(size.cast("string"), F.lit(".5")))
    )
    rows = t.part.select("p_partkey", raw.alias("raw"))
    return rows.select(
        "p_partkey", tx.clean_str(F.col("raw")).alias("clean_text"),
        tx.clean_float(F.col("raw")).alias("clean_number"),
    )


@query("""
    SELECT c_custkey,
           sha256('{"c_acctbal":' || c_acctbal || ',"c_custkey":' || c_custkey || ',"c_mktsegment":"'
                  || c_mktsegment || '","c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}')
               AS data_hash
    FROM customer
""")
def content_hash_of_row(t: Tables) -> DataFrame:
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"]
    return t.customer.select("c_custkey", content_hash(t.customer, columns).alias("data_hash"))


@query("""
    SELECT page_id, regexp_extract(url, '[^/]*$') AS file_name,
           upper(substr(regexp_extract(url, '^[a-z]+'), 1, 3)) AS currency,
           length(sha256(html)) AS hash_length, substr(sha256(html), 1, 12) AS hash_prefix
    FROM pages
""")
def file_names_and_hashes(t: Tables) -> DataFrame:
    digest = F.sha2("html", 256)
    return t.pages.select(
        "page_id", tx.file_name(F.col("url")).alias("file_name"),
        F.upper(F.left(F.regexp_extract("url", "^[a-z]+", 0), F.lit(3))).alias("currency"),
        F.length(digest).cast("long").alias("hash_length"),
        tx.hash_prefix(digest).alias("hash_prefix"),
    )


@query("""
    SELECT event_id, epoch_us(ts) AS micros, make_timestamp(epoch_us(ts)) AS from_micros,
           strptime(strftime(ts, '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%dT%H:%M:%S') AS from_text
    FROM events
""")
def time_parse(t: Tables) -> DataFrame:
    micros = F.unix_micros(F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC"))
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return t.events.select(
        "event_id", micros.alias("micros"),
        F.timestamp_micros(micros).cast("timestamp_ntz").alias("from_micros"),
        F.to_timestamp_ntz(text).alias("from_text"),
    )


# --- sets -------------------------------------------------------------------------------


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def expected_minus_present(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").join(t.labels.select("doc_id"), "doc_id", "left_anti")


@query("""
    WITH expected AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS e),
    days AS (SELECT DISTINCT user_id, CAST(day(ts) AS INTEGER) AS d FROM events)
    SELECT user_id, d,
           coalesce(string_agg(e, ', ' ORDER BY e)
                    FILTER (NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = days.user_id
                                        AND day(x.ts) = days.d AND x.event_type = e)), '') AS missing
    FROM days, expected GROUP BY user_id, d
""")
def missing_names_in_row(t: Tables) -> DataFrame:
    expected = ["click", "error", "purchase", "signup", "view"]
    # Other names become null, which a set leaves out: it holds the expected ones at most.
    known = F.when(F.col("event_type").isin(expected), F.col("event_type"))
    days = t.events.groupBy("user_id", F.dayofmonth("ts").alias("d")).agg(
        F.collect_set(known).alias("present")
    )
    missing = F.array_except(F.array(*[F.lit(e) for e in expected]), F.col("present"))
    return days.select("user_id", "d", F.array_join(F.array_sort(missing), ", ").alias("missing"))


@query("""
    SELECT o_orderkey AS record_id, 'accepted' AS origin FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, 'batch' FROM orders WHERE o_orderstatus <> 'F'
""")
def history_plus_batch(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    accepted = t.orders.filter(status == "F").select(
        F.col("o_orderkey").alias("record_id"), F.lit("accepted").alias("origin")
    )
    batch = t.orders.filter(status != "F").select(
        F.lit("batch").alias("origin"), F.col("o_orderkey").alias("record_id")
    )
    return accepted.unionByName(batch)


@query("SELECT doc_id, 100 + row_number() OVER (ORDER BY sha256(text), doc_id) AS id FROM documents")
def serial_ids(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", _text_hash().alias("data_hash"))
    return dense_ids(rows, ["data_hash", "doc_id"], "id", 100).select("doc_id", "id")


# --- audits -----------------------------------------------------------------------------


@query("""
    SELECT 'orders' AS table_name, 'NOT NULL o_orderkey' AS "constraint",
           count(*) FILTER (o_orderkey IS NULL) AS violations FROM orders
    UNION ALL SELECT 'orders', 'CHECK status', count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) FROM orders
    UNION ALL SELECT 'orders', 'CHECK price', count(*) FILTER (NOT o_totalprice BETWEEN 0 AND 400000) FROM orders
    UNION ALL SELECT 'orders', 'UNIQUE o_custkey, o_orderdate', count(*) - count(DISTINCT (o_custkey, o_orderdate)) FROM orders
    UNION ALL SELECT 'orders', 'FOREIGN KEY o_custkey -> customer.c_custkey',
           count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'lineitem', 'CHECK discount', count(*) FILTER (NOT l_discount BETWEEN 0 AND 0.07) FROM lineitem
    UNION ALL SELECT 'lineitem', 'UNIQUE l_orderkey, l_linenumber',
           count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
    UNION ALL SELECT 'lineitem', 'FOREIGN KEY l_orderkey -> orders.o_orderkey',
           count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'documents', 'FOREIGN KEY doc_id -> labels.doc_id',
           count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT 'documents', 'UNIQUE text', count(*) - count(DISTINCT text) FROM documents
""")
def constraint_audit(t: Tables) -> DataFrame:
    return audit.constraint_audit({n: getattr(t, n) for n in AUDITED}, star_constraints())


AUDITED = ["orders", "lineitem", "customer", "documents", "labels"]


def star_constraints() -> dict[str, audit.Constraints]:
    """Constraints of the test tables, some of them broken."""
    return {
        "orders": audit.Constraints(
            not_null=["o_orderkey"],
            unique=[["o_custkey", "o_orderdate"]],
            checks={
                "status": F.col("o_orderstatus").isin("O", "F"),
                "price": F.col("o_totalprice").between(0, 400000),
            },
            foreign_keys=[("o_custkey", "customer", "c_custkey")],
        ),
        "lineitem": audit.Constraints(
            unique=[["l_orderkey", "l_linenumber"]],
            checks={"discount": F.col("l_discount").between(0, 0.07)},
            foreign_keys=[("l_orderkey", "orders", "o_orderkey")],
        ),
        "documents": audit.Constraints(
            unique=[["text"]], foreign_keys=[("doc_id", "labels", "doc_id")]
        ),
    }


@query("""
    SELECT o_orderkey, CAST(4 AS BIGINT) AS declared, count(l_orderkey) AS actual
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey HAVING count(l_orderkey) <> 4
""")
def reconcile_counts(t: Tables) -> DataFrame:
    parents = t.orders.withColumn("declared", F.lit(4).cast("long"))
    children = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return audit.reconcile_counts(parents, children, "o_orderkey", "declared")


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def duplicate_keys(t: Tables) -> DataFrame:
    return audit.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT count(*) AS total, count(DISTINCT text) AS distinct_values FROM documents")
def total_and_distinct(t: Tables) -> DataFrame:
    return audit.total_and_distinct(t.documents, "text")


@query("""
    SELECT l_partkey, count(*) AS n FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey - p_size FROM part) GROUP BY l_partkey
""")
def orphan_keys(t: Tables) -> DataFrame:
    moved = t.part.select((F.col("p_partkey") - F.col("p_size")).alias("p_partkey"))
    return audit.orphans(t.lineitem, moved, "l_partkey", "p_partkey")


@query("""
    SELECT count(*) FILTER (source IS NULL OR source = '') AS no_source,
           count(*) FILTER (length(sha256(text)) <> 64) AS bad_hash,
           count(*) FILTER (n_chars > 1000) AS long_texts,
           count(*) FILTER (lang = 'en' AND n_chars < 100) AS short_english
    FROM documents
""")
def conditional_counts(t: Tables) -> DataFrame:
    return audit.conditional_counts(
        t.documents,
        {
            "no_source": F.col("source").isNull() | (F.col("source") == ""),
            "bad_hash": F.length(_text_hash()) != 64,
            "long_texts": F.col("n_chars") > 1000,
            "short_english": (F.col("lang") == "en") & (F.col("n_chars") < 100),
        },
    )


# --- run state --------------------------------------------------------------------------

_RUNS_SQL = """
    WITH state AS (
        SELECT user_id AS run_id, CAST(user_id AS VARCHAR) AS dag_run_id, ts AS event_at,
               CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed'
                    ELSE 'running' END AS status,
               CASE WHEN event_type IN ('purchase', 'error') THEN ts END AS completed_at_utc,
               row_number() OVER (PARTITION BY user_id
                   ORDER BY ts DESC, event_type IN ('purchase', 'error') DESC) AS rn
        FROM events)
"""


def _runs(t: Tables) -> DataFrame:
    """Each user as a run: a purchase ends it well, an error badly, the rest are starts."""
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "success").when(kind == "error", "failed").otherwise("running")
    events = t.events.select(
        F.col("user_id").alias("run_id"), F.col("user_id").cast("string").alias("dag_run_id"),
        F.col("ts").alias("event_at"), status.alias("status"),
        F.when(kind.isin("purchase", "error"), F.col("ts")).alias("completed_at_utc"),
    )
    return run_state(events)


@query(_RUNS_SQL + "SELECT run_id, dag_run_id, event_at, status, completed_at_utc FROM state WHERE rn = 1")
def run_state_latest(t: Tables) -> DataFrame:
    return _runs(t)


@query(_RUNS_SQL + """
    SELECT max(completed_at_utc) AS completed_at_utc FROM state WHERE rn = 1 AND status = 'success'
""")
def last_success_time(t: Tables) -> DataFrame:
    return last_success(_runs(t))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
    WHERE l_shipdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F')
    ORDER BY l_shipdate
""")
def changed_since_watermark(t: Tables) -> DataFrame:
    """Rows newer than the last success; the mark is one value, pushed into the scan."""
    runs = t.orders.select(
        F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("status"),
        F.col("o_orderdate").alias("completed_at_utc"),
    )
    watermark = last_success(runs).first()[0]
    rows = t.lineitem
    if watermark is not None:
        rows = rows.filter(F.col("l_shipdate") > tx.moment(watermark))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").orderBy("l_shipdate")


__all__ = ["QUERIES", "SQL", "Tables", "query"]
