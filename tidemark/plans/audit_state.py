"""Constraints of tables that grow by loads, audited from the new rows and stored keys."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.audit import Constraints, row_checks
from tidemark.operators.ordered import in_ranges
from tidemark.sources.buckets import inline_rows

KEYS_PER_TASK = 1_000_000  # that are sorted by folder together

_FOUND = T.StructType(
    [T.StructField("table_name", T.StringType()), T.StructField("constraint", T.StringType()),
     T.StructField("violations", T.LongType())]
)
_KEYS = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("n", T.LongType()),
     T.StructField("constraint", T.StringType()), T.StructField("digit", T.StringType())]
)


def _joined_key(columns: list[str]) -> Column:
    """A key as one text, null where a part of it is null."""
    parts = [F.col(c).cast("string") for c in columns]
    some_null = reduce(lambda a, b: a | b, [p.isNull() for p in parts])
    # a JSON array: no two different keys read alike
    return F.when(~some_null, F.to_json(F.array(*parts)))


class AuditState:
    """The result of ``constraint_audit`` over all rows so far, kept up load by load.

    A load writes what it adds to each constraint's count; the counts of all loads together
    are the audit. Single-row constraints are counted in the new rows. A unique key gains the
    rows of the batch less its keys that no earlier load had. A foreign key gains the child
    rows that have no parent yet, and loses earlier child rows whose parent comes now. For
    this the keys of all loads are stored by a prefix of their hash, and a load reads only
    the folders that a key of its own can lie in.

    Loads come one after another, each under an id of its own; ``loads`` are those that count
    so far, in order. ``digits`` of a key's hash name its folder: 16 to that power for each
    constraint, so that a folder's keys fit a task.
    """

    def __init__(
        self, spark: SparkSession, root: str, constraints: Mapping[str, Constraints],
        loads: list[str] | None = None, digits: int = 2,
    ):
        self.digits = digits
        self.spark, self.root, self.constraints = spark, root.rstrip("/"), constraints
        self.loads = list(loads or [])
        # what a stored key counts for: the row of the audit that it changes
        self.unique = {
            f"UNIQUE {name} {', '.join(k)}": (name, list(k), f"UNIQUE {', '.join(k)}")
            for name, c in constraints.items() for k in c.unique
        }
        self.child = {
            f"CHILD {name} {fk[0]} {fk[1]} {fk[2]}": (name, [fk[0]], f"FOREIGN KEY {fk[0]} -> {fk[1]}.{fk[2]}")
            for name, c in constraints.items() for fk in c.foreign_keys
        }
        self.parent_of = {
            f"CHILD {name} {fk[0]} {fk[1]} {fk[2]}": f"PARENT {fk[1]} {fk[2]}"
            for name, c in constraints.items() for fk in c.foreign_keys
        }
        self.parent = {
            f"PARENT {fk[1]} {fk[2]}": (fk[1], [fk[2]], "")
            for c in constraints.values() for fk in c.foreign_keys
        }

    def _read(self, what: str, schema, loads: list[str]) -> DataFrame:
        paths = [f"{self.root}/{what}/load_id={i}" for i in loads]
        if not paths:
            return inline_rows(self.spark, schema, [])
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{what}")
        return reader.parquet(*paths).select(*schema.names)

    def load(self, tables: Mapping[str, DataFrame], load_id: str) -> None:
        """Bring in the new rows of some or all tables."""
        batch, rows = self._batch_keys(tables, load_id)
        stored = self._read("keys", _KEYS, self.loads)
        is_child = F.col("constraint").startswith("CHILD")
        same = ["constraint", "digit", "key"]

        marks = batch.filter(~is_child)
        # keys of a constraint that no earlier load has stored are all new: nothing to compare
        earlier = F.col("constraint").isin([r[0] for r in stored.select("constraint").distinct().collect()])
        known = stored.join(marks.filter(earlier).select(*same), same, "left_semi")
        fresh = marks.filter(earlier).join(known.select(*same), same, "left_anti").unionByName(marks.filter(~earlier))
        place = f"{self.root}/keys/load_id={load_id}"
        folders = ["constraint", "digit"]
        kept = fresh.unionByName(batch.filter(is_child)).select(*_KEYS.names)
        # a task sorts its rows by folder: large folders come in several pieces, one file each
        pieces = in_ranges(rows, KEYS_PER_TASK * 16**self.digits)
        pieced = kept.repartition(*folders) if pieces == 1 else kept.repartition(
            pieces * 16**self.digits, *folders, F.pmod(F.hash("key"), F.lit(pieces))
        )
        pieced.write.mode("overwrite").partitionBy(*folders).parquet(place)
        fresh = self.spark.read.schema(_KEYS).parquet(place).filter(~is_child)

        repeated = batch.filter(F.col("constraint").startswith("UNIQUE")).select("constraint", "n").unionByName(
            fresh.filter(F.col("constraint").startswith("UNIQUE")).select("constraint", F.lit(-1).cast("long").alias("n"))
        )
        parents = fresh.filter(F.col("constraint").startswith("PARENT")).select(
            F.col("constraint").alias("parent"), "digit", "key"
        )
        to_parent = ["parent", "digit", "key"]
        children = self._with_parent(batch.filter(is_child))
        wanted = children.select(F.col("parent").alias("constraint"), "digit", "key")
        had = stored.join(wanted, same, "left_semi").select(F.col("constraint").alias("parent"), "digit", "key")
        lost = children.join(parents.unionByName(had), to_parent, "left_anti").select("constraint", "n")
        waiting = self._with_parent(stored.filter(is_child))
        cured = waiting.join(parents, to_parent, "left_semi").select("constraint", (-F.col("n")).alias("n"))

        named = self._names()
        changes = repeated.unionByName(lost).unionByName(cured).groupBy("constraint").agg(F.sum("n").alias("violations"))
        rows = changes.withColumn("_row", F.element_at(named, F.col("constraint"))).select(
            F.col("_row.table_name"), F.col("_row.constraint").alias("constraint"), "violations"
        )
        for name, df in tables.items():
            for part in row_checks(name, df, self.constraints.get(name, Constraints())):
                rows = rows.unionByName(part)
        rows.write.mode("overwrite").parquet(f"{self.root}/rows/load_id={load_id}")
        self.loads.append(load_id)

    def _batch_keys(self, tables: Mapping[str, DataFrame], load_id: str) -> tuple[DataFrame, int]:
        """The keys of the new rows with how often they occur, written once, and their number."""
        parts = []
        for label, (name, columns, _) in (self.unique | self.child | self.parent).items():
            if name in tables:
                keys = tables[name].select(_joined_key(columns).alias("key")).filter("key IS NOT NULL")
                counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
                digit = F.substring(F.sha2("key", 256), 1, self.digits)
                named = counted.withColumns({"constraint": F.lit(label), "digit": digit})
                parts.append(named.select(*_KEYS.names))
        place = f"{self.root}/batch/load_id={load_id}"
        empty, seen = inline_rows(self.spark, _KEYS, []), Observation()
        found = reduce(DataFrame.unionByName, parts, empty).observe(seen, F.count(F.lit(1)).alias("n"))
        found.write.mode("overwrite").parquet(place)
        return self.spark.read.schema(_KEYS).parquet(place), seen.get["n"]

    def _with_parent(self, children: DataFrame) -> DataFrame:
        pairs = [F.lit(x) for pair in self.parent_of.items() for x in pair]
        named = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
        return children.withColumn("parent", F.element_at(named, F.col("constraint")))

    def _names(self) -> Column:
        """The row of the audit for each stored key's constraint."""
        pairs = [
            x
            for label, (name, _, text) in (self.unique | self.child).items()
            for x in (F.lit(label), F.struct(F.lit(name).alias("table_name"), F.lit(text).alias("constraint")))
        ]
        return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,struct<table_name:string,constraint:string>>")

    def violations(self) -> DataFrame:
        """One row per constraint: table_name, constraint, violations. Reads no keys."""
        zero = [
            (name, text, 0)
            for name, c in self.constraints.items()
            for text in [
                *[f"NOT NULL {col}" for col in c.not_null], *[f"CHECK {label}" for label in c.checks],
                *[f"UNIQUE {', '.join(k)}" for k in c.unique],
                *[f"FOREIGN KEY {fk[0]} -> {fk[1]}.{fk[2]}" for fk in c.foreign_keys],
            ]
        ]
        found = self._read("rows", _FOUND, self.loads).unionByName(inline_rows(self.spark, _FOUND, zero))
        return found.groupBy("table_name", "constraint").agg(F.sum("violations").alias("violations"))
