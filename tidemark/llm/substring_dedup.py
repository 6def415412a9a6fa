"""Removal of repeated word windows: count-min prefilter, then exact grouping.

The documents are dealt once into chunks of a few megabytes and written as a table
bucketed by chunk, so that later passes bring the small side to the text, not the text to
the small side. Each chunk counts its windows in a sketch of its own. A sketch is cut into
slices by the window's hash, and only its non-zero counters travel; a slice of all chunks is
merged in one task of fixed memory, whatever the corpus. Each chunk gets back the counters
that reach two, which it knows to be too high at worst: a window that starts anywhere twice
is never missed. Only such windows are then grouped exactly, by a 96-bit hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stash import Stash, total_bytes
from tidemark.llm.words import Words, ngram_hashes, ngram_starts, word_hashes, words_of

WINDOW = 20
CHUNK_BYTES = 4 << 20
CHUNKS_PER_BUCKET = 4
SLICE_WINDOWS = 2_000_000
BYTES_PER_WORD = 6
DEPTH, WIDTH_BITS = 2, 23
_CELL_FACTORS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes; sorted ones should come as differences."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, dtype: type) -> np.ndarray:
    return np.cumsum(unpack(data, dtype), dtype=dtype)


def _ordered(table: pa.Table) -> pa.Table:
    """A chunk's rows in the order of (id, text), alike in every pass."""
    return table.sort_by([("id", "ascending"), ("text", "ascending")])


def _windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes and the first word of each window of a chunk."""
    starts, _ = ngram_starts(words.first, WINDOW)
    hashes = word_hashes(words)
    one, two = (ngram_hashes(hashes, WINDOW, family)[starts] for family in (0, 1))
    return one, two, starts


def _cells(hashes: np.ndarray, row: int, slices: int) -> np.ndarray:
    """Slice and counter of each window in one row of the sketch, as one number."""
    part = (hashes >> np.uint64(20)) % np.uint64(slices)
    return (part << np.uint64(WIDTH_BITS)) | ((hashes * _CELL_FACTORS[row]) >> np.uint64(64 - WIDTH_BITS))


def _split_by_slice(values: np.ndarray, slices: int) -> list[np.ndarray]:
    borders = np.arange(1, slices, dtype=np.uint64) << np.uint64(WIDTH_BITS)
    low = np.uint64((1 << WIDTH_BITS) - 1)
    return [(part & low).astype(np.uint32) for part in np.split(values, np.searchsorted(values, borders))]


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    slice_windows: int = SLICE_WINDOWS,
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_removed, kept_text.

    A window is 20 consecutive words of one document. Every word that is covered by a window
    whose word sequence also starts earlier (smaller key, or same document and earlier start)
    is removed; windows are judged on the input. ``kept_text`` holds the other words joined by
    one space.

    Keys are integers. A row with a null key is compared with nothing and loses no word. Rows
    that share a key count as consecutive documents in the order of their text. Null and
    empty texts have no words; texts under 20 words have no window. An empty table gives no
    rows; further columns are ignored.
    """
    spark = docs.sparkSession
    stash = Stash(spark, "substring-dedup")
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = total_bytes(rows, "text")
    chunks = size // chunk_bytes + 1
    buckets = chunks // CHUNKS_PER_BUCKET + 1
    slices = size // BYTES_PER_WORD // slice_windows + 1
    keyed = rows.filter("id IS NOT NULL").withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int"))
    name = f"chunks_{uuid.uuid4().hex}"
    writer = keyed.repartition(buckets, "chunk").write.bucketBy(buckets, "chunk")
    writer.option("path", stash.path("chunks")).format("parquet").saveAsTable(name)
    chunked = spark.table(name)

    def count(table: pa.Table) -> pa.Table:
        one, _, _ = _windows(words_of(_ordered(table).column("text")))
        out: dict[str, list] = {"slice": [], "depth": [], "chunk": [], "cells": [], "twice": []}
        for depth in range(DEPTH):
            cells = np.sort(_cells(one, depth, slices))
            again = np.concatenate((cells[1:] == cells[:-1], [False])) if len(cells) else np.zeros(0, bool)
            first = np.concatenate(([True], ~again[:-1])) if len(cells) else again
            parts = zip(
                _split_by_slice(cells[first], slices), _split_by_slice(np.unique(cells[again]), slices), strict=True
            )
            for at, (once, twice) in enumerate(parts):
                if len(once):
                    out["slice"].append(at)
                    out["depth"].append(depth)
                    out["cells"].append(pack_sorted(once))
                    out["twice"].append(pack_sorted(twice))
        out["chunk"] = [table.column("chunk")[0].as_py()] * len(out["slice"])
        return pa.table(out, pa.schema([("slice", pa.int32()), ("depth", pa.int32()), ("chunk", pa.int32()), ("cells", pa.binary()), ("twice", pa.binary())]))

    def merge(table: pa.Table) -> pa.Table:
        counts = np.zeros(1 << WIDTH_BITS, dtype=np.uint8)
        for once, twice in zip(table.column("cells"), table.column("twice"), strict=True):
            cells = unpack_sorted(once.as_py(), np.uint32)
            counts[cells] = np.minimum(counts[cells] + 1, 2)
            counts[unpack_sorted(twice.as_py(), np.uint32)] = 2
        found = []
        for once in table.column("cells"):
            cells = unpack_sorted(once.as_py(), np.uint32)
            found.append(pack_sorted(cells[counts[cells] >= 2]))
        return table.select(["slice", "depth", "chunk"]).append_column("cells", pa.array(found, pa.binary()))

    sketches = chunked.groupBy("chunk").applyInArrow(
        count, "slice int, depth int, chunk int, cells binary, twice binary"
    )
    repeated = sketches.groupBy("slice", "depth").applyInArrow(merge, "slice int, depth int, chunk int, cells binary")
    repeated = stash.put(repeated, "repeated")

    def candidates(table: pa.Table, cells: pa.Table) -> pa.Table:
        out: dict[str, list] = {"part": [], "chunk": [], "hashes": [], "checks": [], "ids": [], "at": []}
        if table.num_rows and cells.num_rows:
            table = _ordered(table)
            words = words_of(table.column("text"))
            one, two, starts = _windows(words)
            maybe = np.arange(len(one))
            for depth in range(DEPTH):
                known = [
                    (np.uint64(row["slice"]) << np.uint64(WIDTH_BITS)) | unpack_sorted(row["cells"], np.uint32).astype(np.uint64)
                    for row in cells.to_pylist()
                    if row["depth"] == depth
                ]
                known = np.sort(np.concatenate([*known, np.full(1, 2**64 - 1, np.uint64)]))
                own = _cells(one[maybe], depth, slices)
                maybe = maybe[known[np.searchsorted(known, own)] == own]
            check = (two[maybe] >> np.uint64(32)).astype(np.uint32)
            order = np.lexsort((maybe, check, one[maybe]))
            maybe, check = maybe[order], check[order]
            hashed = one[maybe]
            first = np.ones(len(maybe), dtype=bool)
            first[1:] = (hashed[1:] != hashed[:-1]) | (check[1:] != check[:-1])
            ids = table.column("id").to_numpy()[np.searchsorted(words.first, starts[maybe], side="right") - 1]
            chunk = table.column("chunk")[0].as_py()
            own_repeats = np.sort(maybe[~first]).astype(np.uint32)
            none = pack(np.zeros(0, np.uint32))
            for key_, value in zip(out, (-1, chunk, none, none, none, pack_sorted(own_repeats)), strict=True):
                out[key_].append(value)
            part = (hashed >> np.uint64(40)) % np.uint64(slices)
            for p in np.unique(part[first]).tolist():
                rows_ = np.flatnonzero(first & (part == np.uint64(p)))
                values = (int(p), chunk, pack_sorted(hashed[rows_]), pack(check[rows_]), pack(ids[rows_]), pack(maybe[rows_].astype(np.uint32)))
                for key_, value in zip(out, values, strict=True):
                    out[key_].append(value)
        return pa.table(out, pa.schema([("part", pa.int32()), ("chunk", pa.int32()), *((n, pa.binary()) for n in ("hashes", "checks", "ids", "at"))]))

    def exact(table: pa.Table) -> pa.Table:
        found = table.to_pylist()
        hashed = [unpack_sorted(row["hashes"], np.uint64) for row in found]
        source = np.repeat(np.arange(len(found)), [len(h) for h in hashed])
        hashed = np.concatenate(hashed)
        check = np.concatenate([unpack(row["checks"], np.uint32) for row in found])
        ids = np.concatenate([unpack(row["ids"], np.int64) for row in found])
        at = np.concatenate([unpack(row["at"], np.uint32) for row in found])
        order = np.lexsort((ids, check, hashed))
        later = np.zeros(len(order), dtype=bool)
        ranked, checked = hashed[order], check[order]
        later[1:] = (ranked[1:] == ranked[:-1]) & (checked[1:] == checked[:-1])
        again = np.sort(order[later])
        per_row = np.split(again, np.searchsorted(source[again], np.arange(1, len(found))))
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "at": pa.array([pack_sorted(np.sort(at[rows_])) for rows_ in per_row], pa.binary()),
            }
        )

    maybe = chunked.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInArrow(
        candidates, "part int, chunk int, hashes binary, checks binary, ids binary, at binary"
    )
    maybe = stash.put(maybe, "candidates")
    stash.drop(repeated)
    flagged = maybe.filter("part >= 0").groupBy("part").applyInArrow(exact, "chunk int, at binary")
    flagged = flagged.union(maybe.filter("part < 0").select("chunk", "at"))

    def cut(table: pa.Table, marks: pa.Table) -> pa.Table:
        table = _ordered(table)
        words = words_of(table.column("text"))
        starts, _ = ngram_starts(words.first, WINDOW)
        covered = np.zeros(len(words.starts) + WINDOW + 1, dtype=np.int32)
        for at in marks.column("at"):
            begun = starts[unpack_sorted(at.as_py(), np.uint32)]
            covered[begun] += 1
            covered[begun + WINDOW] -= 1
        keep = np.cumsum(covered)[: len(words.starts)] == 0
        return _joined(table.column("id"), words, keep)

    columns = "id long, n_words long, n_removed long, kept_text string"
    result = chunked.groupBy("chunk").cogroup(flagged.groupBy("chunk")).applyInArrow(cut, columns)

    def uncut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = words_of(batch.column(1))
            yield from _joined(batch.column(0), words, np.ones(len(words.starts), dtype=bool)).to_batches()

    unkeyed = rows.filter("id IS NULL").mapInArrow(uncut, columns)
    return result.union(unkeyed).select(F.col("id").cast(docs.schema[key].dataType).alias(key), "n_words", "n_removed", "kept_text")


def _joined(ids: pa.Array, words: Words, keep: np.ndarray) -> pa.Table:
    """The kept words of each row, joined by one space."""
    kept = np.flatnonzero(keep)
    row_first = np.searchsorted(kept, words.first)
    length = (words.ends - words.starts)[kept] + 1
    borders = np.zeros(len(kept) + 1, dtype=np.int64)
    np.cumsum(length, out=borders[1:])
    place = np.arange(int(borders[-1])) + np.repeat(words.starts[kept] - borders[:-1], length)
    data = words.data[np.minimum(place, len(words.data) - 1)] if len(place) else np.zeros(0, np.uint8)
    data[borders[1:] - 1] = 0x20
    body = data.tobytes()
    texts = [
        body[lo : hi - 1] if hi > lo else b""
        for lo, hi in zip(borders[row_first[:-1]].tolist(), borders[row_first[1:]].tolist(), strict=True)
    ]
    total = np.diff(words.first)
    return pa.table(
        {
            "id": ids,
            "n_words": pa.array(total, pa.int64()),
            "n_removed": pa.array(total - np.diff(row_first), pa.int64()),
            "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
        }
    )
