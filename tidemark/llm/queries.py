"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    exact_dedup,
    filter_audit,
    fingerprints,
    html_extract,
    kd_shards,
    near_dedup,
    piece_sampling,
    substring_dedup,
    token_files,
    token_rollups,
    toxicity,
    whitening,
)
from tidemark.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_SMALL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_SMALL}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
    ELSE array_to_string(list_slice(w, i, i + 4), ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))
),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least l ON l.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

REPEATS_SQL = rf"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 19), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
),
later AS (
  SELECT doc_id, i FROM windows
  QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
  FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.t, '')) AS kept_sha256
FROM words d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

EXACT_SQL = """
WITH found AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM found WINDOW same AS (PARTITION BY t)
"""


AUDIT_SQL = rf"""
WITH marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
),
found AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM found LEFT JOIN marks USING (doc_id)
),
counts AS (SELECT part, good, toxic, fails, count(*) AS n FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
),
places AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
seen AS (
  SELECT part, filter_order, step, own, n, good, toxic, contains(fails, own) AS bad, fails = own AS only_own,
    translate(fails, before, '') <> fails AS gone
  FROM counts, places
),
steps AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (NOT gone AND NOT bad), 0) AS kept,
    coalesce(sum(n) FILTER (bad AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (bad AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (only_own), 0) AS unique_fails,
    coalesce(sum(n) FILTER (bad AND NOT gone AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (bad AND NOT gone AND toxic), 0) AS toxic_lost
  FROM seen GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM steps
"""


@query("op1_near_dedup", NEAR_SQL)
def _near(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


@query("op2_substring_dedup", REPEATS_SQL)
def _repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op3_exact_dedup", EXACT_SQL)
def _exact(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


@query("op4_kd_shards")
def _shards(spark: SparkSession, folder: str) -> DataFrame:
    found = kd_shards.kd_shards(table(spark, folder, "documents"), shards=16)
    return found.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


@query("op5_decontaminate")
def _contaminated(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_token_files")
def _files(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_dir(spark, 'tokens')}/files"
    token_files.write_tokens(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, path)


@query("op7_piece_sampling")
def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    return piece_sampling.sample_pieces(documents, path)


@query("op8_token_rollups")
def _rollups(spark: SparkSession, folder: str) -> DataFrame:
    """All documents are inserted, those labelled unfit get a revised count (white space runs
    made one space), those labelled toxic are deleted, with their revised count if they have one;
    the second batch is committed twice."""
    path, version = public_tokenizers.path("byte_bpe_50k.tiktoken"), F.lit("byte_bpe_50k").alias("tokenizer")
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rows = documents.select("doc_id", "text", "source", "lang", version)
    marks = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    root = shared_dir(spark, "token-rollup")
    tidy = {"n_tidy": F.regexp_replace("text", r"\s+", " ")}
    counted = token_rollups.with_token_counts(rows, path, also=tidy).join(marks, "doc_id", "left")
    counted.write.parquet(f"{root}-counts")
    counted = spark.read.parquet(f"{root}-counts")
    rollup = token_rollups.Rollup(spark, root)
    rollup.commit("1-insert", token_rollups.deltas(counted, 1))
    unfit = counted.filter("quality = 0")
    changes = token_rollups.deltas(unfit, -1).union(token_rollups.deltas(unfit, 1, "n_tidy"))
    for _ in range(2):
        rollup.commit("2-revise", changes)
    toxic = counted.filter("toxic = 1").withColumn("n_last", F.expr("CASE WHEN quality = 0 THEN n_tidy ELSE n_tokens END"))
    rollup.commit("3-delete", token_rollups.deltas(toxic, -1, "n_last"))
    return rollup.totals()


@query("op9_toxicity")
def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, folder, "labels")))


@query("op10_html_extract")
def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, folder, "pages"))


@query("op11_whitening")
def _whitened(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


@query("op12_filter_audit", AUDIT_SQL)
def _audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op13_fingerprints")
def _fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))
