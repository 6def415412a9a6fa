"""Tables written between the steps of an operator, in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir


class Stash:
    """Writes tables, reads them again, and can drop those that nothing reads any more.

    A written table cuts the lineage and survives lost executors.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark = spark
        self.root = shared_dir(spark, purpose)
        self._count = 0

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{name}"

    def put(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        path = self.path(name)
        writer = df.write.mode("error")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Removes the files of a table made by ``put``. Only for tables without later readers."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if self.root.rsplit("/", 1)[1] in folder:
                path.getFileSystem(conf).delete(path, True)


def total_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of a text column over all rows."""
    found = df.select(F.sum(F.octet_length(F.col(column))).alias("n")).first()
    return int((found and found["n"]) or 0)


def tasks_for(df: DataFrame) -> int:
    """How many tasks a shuffle of this session has at least."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
