"""Exact de-duplication by skew-safe combining."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stash import Stash

SALTS = 16


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical; a null text counts as empty. Of equal texts
    the row with the largest key stays. The group is combined three times, each time by
    the whole text, the digest being only the first part of the grouping key:

    1. each task keeps one row per text it has read (the partial aggregate),
    2. these are merged within (digest, salt), the salt being the task's number, so one
       text reaches at most ``salts`` reducers however many rows have it,
    3. the salts' winners are merged within the digest: at most ``salts`` rows per text.

    Only digests, keys and counts go back to the documents. Two texts with one digest are
    looked up by their text.

    A null key loses against every other; a group with null keys only has a null keep_id
    and all its rows are kept. Rows that share text and largest key are all kept. An empty
    table gives no rows; further columns are ignored.
    """
    stash = Stash(docs.sparkSession, "exact-dedup")
    rows = docs.select(
        F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    ).withColumn("_digest", F.sha2("_text", 256))
    salted = (
        rows.withColumn("_salt", F.spark_partition_id() % salts)
        .groupBy("_digest", "_salt", "_text")
        .agg(F.max("_id").alias("_keep"), F.count("*").alias("_n"))
    )
    winners = (
        salted.repartition("_digest")
        .groupBy("_digest", "_text")
        .agg(F.max("_keep").alias("_keep"), F.sum("_n").alias("_n"))
        .groupBy("_digest")
        .agg(F.max("_keep").alias("_keep"), F.max("_n").alias("_n"), F.count("*").alias("_texts"))
    )
    winners = stash.put(winners, "winners")
    clashing = winners.filter("_texts > 1").select("_digest")
    found = rows.drop("_text").join(winners.filter("_texts = 1"), "_digest")
    if not clashing.isEmpty():
        same_digest = rows.join(clashing, "_digest", "left_semi")
        by_text = same_digest.groupBy("_digest", "_text").agg(
            F.max("_id").alias("_keep"), F.count("*").alias("_n")
        )
        found = found.drop("_texts").unionByName(
            same_digest.join(by_text, ["_digest", "_text"]).drop("_text")
        )
    return found.select(
        F.col("_id").alias(key),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows that ``exact_groups`` keeps, with the columns of ``docs``.

    A null key is never dropped unless another row has its text and a key; rows that are
    equal in key and text all stay.
    """
    kept = exact_groups(docs, key, text, salts).filter("kept").select(
        F.col(key).alias("_kept_id"), F.col("text_sha256").alias("_kept_digest")
    ).distinct()
    digest = F.sha2(F.coalesce(docs[text], F.lit("")), 256)
    return docs.join(
        kept,
        docs[key].eqNullSafe(kept["_kept_id"]) & (digest == kept["_kept_digest"]),
        "left_semi",
    )
