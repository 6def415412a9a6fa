"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The benchmark is taken in blocks of bounded size, each sent to all tasks. A first pass counts
in how many documents each n-gram of the block occurs. An item's seeds are the n-grams that
are rare, or no more frequent than the item itself can explain, so that an item keeps seeds
however often it was copied. A second pass aligns the words around each seed with the item.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stash import Stash, total_bytes
from tidemark.llm.words import ngram_hashes, ngram_starts, small_batches, word_hashes, words_of

SEED_WORDS = 3
BLOCK_BYTES = 8 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
SIMILARITY = 0.5  # of the score that the whole item would get
SPREAD, RARE_SHARE = 8, 0.001
BATCH = 512


def align(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each row of ``items`` with the same row of ``texts``,
    and the word of the text at which it ends. Words are numbers; 0 and 1 pad and match nothing.

    A cell takes the best of its diagonal and vertical neighbours; what horizontal gaps add
    is a running maximum along the row.
    """
    rows, width = items.shape
    slope = GAP * np.arange(width + 1, dtype=np.int32)
    line = np.zeros((rows, width + 1), dtype=np.int32)
    best, end = np.zeros(rows, dtype=np.int32), np.zeros(rows, dtype=np.int64)
    for at in range(texts.shape[1]):
        step = np.where(items == texts[:, at : at + 1], np.int32(MATCH), np.int32(MISMATCH))
        new = np.maximum(line + GAP, 0)
        np.maximum(new[:, 1:], line[:, :-1] + step, out=new[:, 1:])
        line = np.maximum.accumulate(new - slope, axis=1) + slope
        top = line.max(axis=1)
        end[top > best] = at
        np.maximum(best, top, out=best)
    return best, end


class _Block:
    """The words and n-grams of some items, as arrays that go to all tasks."""

    def __init__(self, rows: list) -> None:
        words = words_of(pa.array([r["text"] for r in rows], pa.string()), lower=True, letters_only=True)
        self.ids = [r["id"] for r in rows]
        self.first, self.words = words.first, word_hashes(words)
        lengths = np.diff(words.first)
        self.sizes = sorted({min(SEED_WORDS, int(n)) for n in lengths if n})
        hashes, items, places = [], [], []
        for size in self.sizes:
            starts, counts = ngram_starts(words.first, size)
            owner = np.repeat(np.arange(len(lengths)), counts)
            use = np.minimum(lengths[owner], SEED_WORDS) == size
            hashes.append(ngram_hashes(self.words, size)[starts][use])
            items.append(owner[use])
            places.append((starts - words.first[owner])[use])
        self.hashes = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        self.items, self.places = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (items, places))
        self.distinct = np.unique(self.hashes)

    def keep_rare(self, counts: dict[int, int], documents: int) -> None:
        """Leaves each item its n-grams that occur, but for those that are far more frequent
        than the item itself seems to be: over ``SPREAD`` times the upper quartile of its
        n-grams' counts and over ``RARE_SHARE`` of the documents."""
        often = np.array([counts.get(int(h), 0) for h in self.hashes.view(np.int64)], dtype=np.int64)
        most = np.zeros(len(self.ids))
        for item in np.unique(self.items[often > 0]).tolist():
            most[item] = SPREAD * np.quantile(often[(self.items == item) & (often > 0)], 0.75)
        keep = np.flatnonzero((often > 0) & (often <= np.maximum(most[self.items], RARE_SHARE * documents)))
        keep = keep[np.argsort(self.hashes[keep], kind="stable")]
        self.hashes, self.items, self.places = self.hashes[keep], self.items[keep], self.places[keep]
        self.distinct = np.unique(self.hashes)

    def hits(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Start words and hashes of the n-grams of a batch that are in the block."""
        for size in self.sizes:
            starts, _ = ngram_starts(first, size)
            grams = ngram_hashes(words, size)[starts]
            spot = np.minimum(np.searchsorted(self.distinct, grams), max(len(self.distinct) - 1, 0))
            found = self.distinct[spot] == grams if len(self.distinct) else np.zeros(len(grams), bool)
            yield starts[found], grams[found]


def _windows(block: _Block, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, item, first and last word of the stretches of text to align.

    Hits of one row and item whose stretches overlap make one stretch.
    """
    rows, items, lows, highs = [], [], [], []
    for starts, grams in block.hits(words, first):
        left, right = (np.searchsorted(block.hashes, grams, side=s) for s in ("left", "right"))
        many = right - left
        which = np.arange(int(many.sum())) + np.repeat(left - (np.cumsum(many) - many), many)
        at, item = np.repeat(starts, many), block.items[which]
        row = np.searchsorted(first, at, side="right") - 1
        length = np.diff(block.first)[item]
        low = np.maximum(at - block.places[which] - length // 2 - 1, first[row])
        high = np.minimum(at - block.places[which] + length + length // 2 + 1, first[row + 1])
        rows.append(row), items.append(item), lows.append(low), highs.append(high)
    row, item, low, high = (np.concatenate([*x, np.zeros(0, int)]).astype(np.int64) for x in (rows, items, lows, highs))
    order = np.lexsort((low, item, row))
    row, item, low, high = row[order], item[order], low[order], high[order]
    if not len(row):
        return row, item, low, high
    # a stretch starts where no earlier one of its row and item reaches; the word numbers of a
    # batch grow with the row, so the running maximum needs no reset within an item's group
    group = np.cumsum(np.concatenate(([True], (row[1:] != row[:-1]) | (item[1:] != item[:-1])))) - 1
    span = int(first[-1]) + 1
    reach = np.maximum.accumulate(high + group * span) - group * span
    new = np.concatenate(([True], (group[1:] != group[:-1]) | (low[1:] > reach[:-1])))
    begin = np.flatnonzero(new)
    return row[begin], item[begin], low[begin], np.maximum.reduceat(high, begin)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds: key, item_key, score,
    similarity, end_word.

    Words are runs of letters, digits and other bytes outside ASCII white space and
    punctuation, in lower case (A-Z). ``score`` is the best local alignment (match 2, mismatch
    and gap -1), ``similarity`` that over the score of the whole item; pairs under the limit
    are left out. ``end_word`` numbers the document's word at which the alignment ends.

    Null and empty texts match nothing; items under 3 words are sought as a whole. Rows that
    share a key give one pair with the best score; null keys are kept as a key. Empty tables
    give no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    stash = Stash(spark, "decontaminate")
    items = benchmark.select(F.col(item_key).alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    blocks = total_bytes(items, "text") // block_bytes + 1
    items = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    texts = docs.select(F.col(key), F.col(text))
    kinds = docs.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()
    schema = f"{key} {kinds[0]}, {item_key} {kinds[1]}, score int, similarity double, end_word long"
    documents = docs.count()
    item_type = pa.array([r["id"] for r in items.select("id").limit(1).collect()])

    def pairs_of(part: int) -> DataFrame:
        block = _Block(items.filter(F.col("block") == part).select("id", "text").collect())
        sent = spark.sparkContext.broadcast(block)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = sent.value
            counts = np.zeros(len(known.distinct), dtype=np.int64)
            for batch in small_batches(batches, 1):
                words = words_of(batch.column(1), lower=True, letters_only=True)
                for starts, grams in known.hits(word_hashes(words), words.first):
                    row = np.searchsorted(words.first, starts, side="right") - 1
                    both = np.unique(row * len(counts) + np.searchsorted(known.distinct, grams))
                    counts += np.bincount(both % max(len(counts), 1), minlength=len(counts))
            some = counts > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(known.distinct[some].view(np.int64)), pa.array(counts[some])], ["gram", "n"]
            )

        counted = texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        block.keep_rare({r["gram"]: r["n"] for r in counted.collect()}, documents)
        seeds = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = seeds.value
            for batch in small_batches(batches, 1):
                found = words_of(batch.column(1), lower=True, letters_only=True)
                words = word_hashes(found)
                row, item, low, high = _windows(known, words, found.first)
                score, end = np.zeros(len(row), np.int32), np.zeros(len(row), np.int64)
                sizes = np.diff(known.first)[item]
                order = np.lexsort((sizes, high - low))
                for at in range(0, len(order), BATCH):
                    part = order[at : at + BATCH]
                    pad = [np.arange(int(n.max()))[None, :] for n in (sizes[part], (high - low)[part])]
                    use = [p < n[:, None] for p, n in zip(pad, (sizes[part], (high - low)[part]), strict=True)]
                    spot = [
                        np.minimum(p + start[:, None], len(source) - 1)
                        for p, start, source in zip(pad, (known.first[item[part]], low[part]), (known.words, words), strict=True)
                    ]
                    left = np.where(use[0], known.words[spot[0]], np.uint64(0))
                    right = np.where(use[1], words[spot[1]], np.uint64(1))
                    score[part], end[part] = align(left, right)
                alike = score / (MATCH * np.maximum(sizes, 1))
                good = np.flatnonzero(alike >= similarity)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row[good])),
                        pa.array([known.ids[i] for i in item[good]], item_type.type),
                        pa.array(score[good]),
                        pa.array(alike[good]),
                        pa.array((low + end - found.first[row])[good], pa.int64()),
                    ],
                    [key, item_key, "score", "similarity", "end_word"],
                )

        return stash.put(texts.mapInArrow(search, schema), "pairs")

    used = [r["block"] for r in items.select("block").distinct().collect()]
    if not used:
        return spark.createDataFrame([], schema)
    pairs = reduce(DataFrame.union, [pairs_of(b) for b in sorted(used)])
    best = F.max(F.struct("score", "similarity", (-F.col("end_word")).alias("end"))).alias("best")
    return pairs.groupBy(key, item_key).agg(best).select(
        key, item_key, "best.score", "best.similarity", (-F.col("best.end")).alias("end_word")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; rows with a null key stay."""
    gone = contaminated(docs, benchmark, key, text).select(key).distinct()
    return docs.join(gone, key, "left_anti")
