"""Staging of files by modification time, and the lookup of an upload's source file."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import file_name


def list_files(spark: SparkSession, folder: str, pattern: str = "*.xlsm") -> DataFrame:
    """One row per matching file: path, modificationTime, length, content.

    ``content`` is only read when a query uses it.
    """
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def modified_since(
    spark: SparkSession, folder: str, watermark: datetime | None, pattern: str = "*.xlsm"
) -> DataFrame:
    """Files changed strictly after the watermark, all files when it is None.

    The comparison is pushed into the file source, so older files are not opened.
    """
    files = list_files(spark, folder, pattern)
    if watermark is not None:
        files = files.filter(F.col("modificationTime") > F.lit(watermark))
    return files.withColumn("source_filename", file_name(F.col("path")))


def staged_names(files: DataFrame) -> DataFrame:
    """The staged files in path order, without their content."""
    return files.select("path", "source_filename", "modificationTime", "length").orderBy("path")


def source_file_status(uploads: DataFrame, files: DataFrame) -> DataFrame:
    """Each upload with the path of its source file and found / missing_file.

    ``files`` is a listing with ``path`` and ``source_filename``; an id that is
    not in ``uploads`` gives no row at all.
    """
    listing = files.groupBy("source_filename").agg(F.max("path").alias("path"))
    return uploads.join(listing, "source_filename", "left").withColumn(
        "status", F.when(F.col("path").isNull(), "missing_file").otherwise("found")
    )
