"""Token counts by source, language and tokenizer version, kept up by signed deltas."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSIONS = ("source", "lang", "tokenizer")
_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """The byte-level BPE whose ranks are in ``path``; loaded once per worker."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines)}
        _ENCODERS[path] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _ENCODERS[path]


def with_token_counts(
    docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens", also: Mapping[str, Column] | None = None
) -> DataFrame:
    """The rows without their text, with the number of tokens of the whole text; a null text has none.

    ``also`` names further counts, each of a changed form of the text. They come from the same
    pass, so no text is shuffled to find them; a form that equals the text is not encoded again.
    Columns that are called like the new ones are replaced.
    """
    also = dict(also or {})
    names, extra = [name, *also], len(also)
    kept = [c for c in docs.columns if c != text and c not in names]
    forms = [F.when(form != F.col(text), form).alias(f"_form{i}") for i, form in enumerate(also.values())]
    rows = docs.select(*(F.col(c) for c in kept), F.col(text).alias("_text"), *forms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            counts = [np.fromiter((len(encode(v.as_py() or "")) for v in batch.column(len(kept))), np.int64, batch.num_rows)]
            for i in range(extra):
                form = batch.column(len(kept) + 1 + i)
                changed = np.flatnonzero(form.is_valid().to_numpy(zero_copy_only=False))
                counts.append(counts[0].copy())
                counts[-1][changed] = [len(encode(form[at].as_py())) for at in changed.tolist()]
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c) for c in counts)], [*kept, *names])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    return rows.mapInArrow(run, ", ".join([*fields, *(f"`{n}` long" for n in names)]))


def deltas(rows: DataFrame, sign: int, tokens: str = "n_tokens") -> DataFrame:
    """Inserted (sign 1) or deleted (sign -1) documents as changes of the totals.

    A revised count is a delete with the old count and an insert with the new one.
    """
    return rows.select(
        *DIMENSIONS,
        F.lit(sign).cast("long").alias("d_docs"),
        (F.coalesce(F.col(tokens), F.lit(0)) * sign).cast("long").alias("d_tokens"),
    )


class Rollup:
    """Additive totals in a shared folder, one sub-folder per committed batch.

    A batch is added up before it is written, and its folder counts once Spark's committer
    has put the success mark there; a batch that broke off leaves none and is written anew.
    Committing a batch id that is already there changes nothing, so a replay is harmless.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, path: str) -> bool:
        found = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(found)

    def _batches(self) -> list[str]:
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        system = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(root):
            return []
        folders = [str(s.getPath()) for s in system.listStatus(root)]
        return sorted(f for f in folders if self._exists(f"{f}/_SUCCESS"))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Adds a batch of ``deltas``; False if it had been committed before."""
        path = f"{self.root}/batch-{batch_id}"
        if self._exists(f"{path}/_SUCCESS"):
            return False
        summed = changes.groupBy(*DIMENSIONS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
        summed.coalesce(1).write.mode("overwrite").parquet(path)
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of all batches; empty groups are left out.

        Null dimensions are values of their own. Without batches there are no rows.
        """
        schema = "source string, lang string, tokenizer string, d_docs long, d_tokens long"
        batches = self._batches()
        rows = self.spark.read.schema(schema).parquet(*batches) if batches else self.spark.createDataFrame([], schema)
        summed = rows.groupBy(*DIMENSIONS).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
        return summed.filter("n_docs <> 0 OR n_tokens <> 0")
