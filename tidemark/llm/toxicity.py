"""Toxicity by a classifier chain of linear models over hashed words.

The models are fitted on at most ``FIT_ROWS`` labelled rows, chosen by a hash of their key, in
one task. Each category's model sees the probabilities of the categories before it; while
fitting, these come from models that have not seen the row (out-of-fold).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import Words, mixed, small_batches, text_buffer, word_hashes, words_of

FIT_ROWS = 8_000
FOLDS = 5
BUCKET_BITS = 18
PREFIX_BYTES = (4, 5)
MIN_ROWS, MIN_Z, MAX_FEATURES = 4, 3.5, 3000
RIDGE, STEPS = 1e-3, 300
SHAPES = 3  # shape features: spread of words, capitals, signs
LEVELS = 16
#: category, and the label column and value that mean it; later ones see earlier ones
CATEGORIES = (("unfit", "quality", 0), ("toxic", "toxic", 1))


def _levels(share: np.ndarray, which: int) -> np.ndarray:
    return which * LEVELS + np.minimum((np.nan_to_num(share) * LEVELS).astype(np.int64), LEVELS - 1)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each distinct feature of each row, by row.

    Features are words, the first bytes of longer words (so inflected forms share one), and
    a level for each of three shapes of the text. Buckets under ``SHAPES * LEVELS`` are shapes.
    """
    words = words_of(texts, lower=True, letters_only=True)
    counts = np.diff(words.first)
    row = np.repeat(np.arange(words.rows), counts)
    whole = word_hashes(words)
    found = [(row, whole)]
    for size in PREFIX_BYTES:
        long = words.ends - words.starts > size
        heads = Words(words.data, words.starts[long], words.starts[long] + size, words.first)
        found.append((row[long], mixed(word_hashes(heads) ^ np.uint64(size))))
    shift, shapes = np.uint64(64 - BUCKET_BITS), SHAPES * LEVELS
    keys = [at * (1 << 20) + (h >> shift).astype(np.int64) + shapes for at, h in found]
    distinct = np.unique(np.concatenate(keys))
    data, offsets = text_buffer(texts)
    with np.errstate(divide="ignore", invalid="ignore"):
        sums = [
            np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets]) / np.diff(offsets)
            for mask in ((data >= 0x41) & (data <= 0x5A), ((data > 0x20) & (data < 0x30)) | (data == 0x7C) | (data == 0x40))
        ]
        per_row = np.bincount(np.unique(row * (1 << 32) + (whole >> np.uint64(32)).astype(np.int64)) >> 32, minlength=words.rows)
        shares = [per_row / counts, *sums]
    base = np.arange(words.rows) * (1 << 20)
    distinct = np.sort(np.concatenate([distinct, *(base + _levels(s, i) for i, s in enumerate(shares))]))
    return distinct >> 20, distinct & ((1 << 20) - 1)


class Linear:
    """A logistic model over chosen buckets and the logits of earlier categories."""

    def __init__(self, row: np.ndarray, bucket: np.ndarray, before: np.ndarray, y: np.ndarray) -> None:
        """``before`` has a row per document and a column per earlier category."""
        n, size = len(y), (1 << BUCKET_BITS) + SHAPES * LEVELS
        good = max(int(y.sum()), 1)
        hits, all_ = np.bincount(bucket[y[row] == 1], minlength=size), np.bincount(bucket, minlength=size)
        share = all_ / max(n, 1)
        z = np.abs(hits / good - share) / np.sqrt(share * (1 - share) / good + 1e-12)
        z[(all_ < MIN_ROWS) | (share >= 1)] = 0
        best = np.argsort(-z, kind="stable")[:MAX_FEATURES]
        self.buckets = np.sort(best[z[best] >= MIN_Z])
        place = np.searchsorted(self.buckets, bucket)
        inside = place < len(self.buckets)
        inside[inside] = self.buckets[place[inside]] == bucket[inside]
        row, place = row[inside], place[inside]
        width = len(self.buckets) + before.shape[1] + 1
        weight, mean, spread = np.zeros(width), np.zeros(width), np.zeros(width)
        for step in range(1, STEPS + 1):  # Adam on the whole sample
            p = 1 / (1 + np.exp(-self._score(weight, row, place, before, n)))
            error = (p - y) / max(n, 1)
            slope = np.concatenate(
                (np.bincount(place, error[row], minlength=len(self.buckets)), before.T @ error, [error.sum()])
            )
            slope[:-1] += RIDGE * weight[:-1] / max(n, 1)
            mean = 0.9 * mean + 0.1 * slope
            spread = 0.999 * spread + 0.001 * slope**2
            weight -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-9)
        self.weight = weight

    def _score(self, weight: np.ndarray, row: np.ndarray, place: np.ndarray, before: np.ndarray, n: int) -> np.ndarray:
        k = len(self.buckets)
        return np.bincount(row, weight[place], minlength=n) + before @ weight[k:-1] + weight[-1]

    def logit(self, row: np.ndarray, bucket: np.ndarray, before: np.ndarray, n: int) -> np.ndarray:
        """Clipped logits of ``n`` documents."""
        table = np.full((1 << BUCKET_BITS) + SHAPES * LEVELS, -1)
        table[self.buckets] = np.arange(len(self.buckets))
        place = table[bucket]
        use = place >= 0
        return np.clip(self._score(self.weight, row[use], place[use], before, n), -8, 8)


def fit_chain(row: np.ndarray, bucket: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> list[Linear]:
    """One model per column of ``labels``, each fed with out-of-fold logits of those before."""
    often = np.bincount(bucket) >= MIN_ROWS  # rarer features enter no model, nor a fold's
    use = often[bucket]
    row, bucket = row[use], bucket[use]
    n, before, models = len(labels), np.zeros((len(labels), 0)), []
    for y in labels.T:
        models.append(Linear(row, bucket, before, y))
        held_out = np.zeros(n)
        for fold in range(FOLDS):
            out = folds == fold
            number = np.cumsum(~out) - 1
            inside = ~out[row]
            model = Linear(number[row[inside]], bucket[inside], before[~out], y[~out])
            held_out[out] = model.logit(row, bucket, before, n)[out]
        before = np.column_stack((before, held_out))
    return models


def fit(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[tuple[str, str, int]] = CATEGORIES,
    key: str = "doc_id",
    text: str = "text",
    fit_rows: int = FIT_ROWS,
) -> list[Linear]:
    """The chain, fitted in one task on at most ``fit_rows`` labelled rows.

    Rows with a null key, text or label are not used. Without labelled rows every
    probability is one half less a bias of zero, that is, 0.5.
    """
    known = labels.select(F.col(key), *(F.col(c) for _, c, _ in categories)).dropna().dropDuplicates([key])
    known = known.orderBy(F.xxhash64(key), key).limit(fit_rows)
    rows = docs.select(F.col(key), F.col(text).alias("_text")).dropna().join(known, key)
    rows = rows.select(
        "_text",
        F.pmod(F.xxhash64(F.lit("fold"), F.col(key)), F.lit(FOLDS)).alias("_fold"),
        F.array(*((F.col(c) == v).cast("int") for _, c, v in categories)).alias("_y"),
    )

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 0):
            row, bucket = features(batch.column(0))
            parts = np.split(bucket.astype(np.int32), np.searchsorted(row, np.arange(1, batch.num_rows)))
            found = [p.tobytes() for p in parts[: batch.num_rows]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), batch.column(1), batch.column(2)], ["found", "fold", "y"]
            )

    def train(table: pa.Table) -> pa.Table:
        found = [np.frombuffer(v.as_buffer(), dtype=np.int32) for v in table.column("found")]
        row = np.repeat(np.arange(len(found)), [len(f) for f in found])
        models = fit_chain(
            row, np.concatenate(found).astype(np.int64),
            np.array(table.column("y").to_pylist(), dtype=float), table.column("fold").to_numpy(),
        )
        return pa.table({"model": pa.array([pickle.dumps([(m.buckets, m.weight) for m in models])], pa.binary())})

    sample = rows.mapInArrow(prepare, "found binary, fold long, y array<int>").withColumn("one", F.lit(1))
    sample = sample.groupBy("one").applyInArrow(lambda t: train(t.drop_columns("one")), "model binary")
    fitted = sample.first()
    none = (np.zeros(0, np.int64), None)
    models = []
    for i, (buckets, weight) in enumerate(pickle.loads(fitted["model"]) if fitted else [none] * len(categories)):
        model = Linear.__new__(Linear)
        model.buckets, model.weight = buckets, np.zeros(len(buckets) + i + 1) if weight is None else weight
        models.append(model)
    return models


def score(
    docs: DataFrame,
    models: list[Linear],
    categories: Sequence[tuple[str, str, int]] = CATEGORIES,
    key: str = "doc_id",
    text: str = "text",
    limit: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs``: key, p_<category> for each, and rejected.

    ``rejected`` says that the last category's probability is over ``limit``. A null text
    counts as empty, and a text without words is never rejected. Null keys and repeated rows
    are scored like others; an empty table gives no rows; further columns are ignored.
    """
    names = [f"p_{name}" for name, _, _ in categories]
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            n = batch.num_rows
            row, bucket = features(batch.column(1))
            before = np.zeros((n, 0))
            for model in models:
                before = np.column_stack((before, model.logit(row, bucket, before, n)))
            p = 1 / (1 + np.exp(-before))
            worded = np.bincount(row[bucket >= SHAPES * LEVELS], minlength=n) > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in p.T), pa.array((p[:, -1] > limit) & worded)],
                [key, *names, "rejected"],
            )

    columns = ", ".join([f"{key} {kind}", *(f"{n} double" for n in names), "rejected boolean"])
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, columns)


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the chain, fitted on ``labels``, does not reject."""
    models = fit(docs, labels, key=key, text=text)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, names.index(text)):
            n = batch.num_rows
            row, bucket = features(batch.column(names.index(text)))
            before = np.zeros((n, 0))
            for model in models:
                before = np.column_stack((before, model.logit(row, bucket, before, n)))
            worded = np.bincount(row[bucket >= SHAPES * LEVELS], minlength=n) > 0
            yield batch.filter(pa.array(~((before[:, -1] > 0) & worded)))

    return docs.mapInArrow(run, docs.schema)
