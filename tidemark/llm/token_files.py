"""Token ids of a corpus as files of coded blocks, and the way back.

A file set is a Parquet table of two kinds of rows: blocks (part, block, n_ids, crc32,
payload) and one or more index rows per part (block -1; the keys and token counts of the
documents of the part, in order). Parts are ranges of the key in ascending order.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.stash import total_bytes
from tidemark.llm.token_coder import decode_ids, encode_ids
from tidemark.llm.words import mixed, small_batches

PART_BYTES = 32 << 20  # a coder's step costs little more for many blocks than for few
FLUSH_IDS = 1 << 24  # ids coded together: about 18 bytes each in the coder's tables
READ_BLOCKS = 4096
KNOWN_WORDS = 1_000_000  # about 40 bytes each
LINES = 200
BASE = 0xD1342543DE82EF95
_ENCODERS: dict[str, "WordwiseEncoder"] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """Powers of an odd number modulo 2^64, built by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    done = 1
    while done < n:
        out[done : 2 * done] = out[: min(done, n - done)] * np.uint64(pow(base, done, 1 << 64))
        done *= 2
    return out


class WordwiseEncoder:
    """The tokenizers library, asked once per distinct pre-token.

    A byte-level BPE first cuts a text into words, numbers, signs and white space and then
    encodes each alone. Texts of Latin letters without apostrophes are cut here, all at once;
    other texts, and those that hold an added token, go to the library whole.
    """

    LATIN = 0x180

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)) if added else None  # matched before the text is cut
        self.kind = np.zeros(self.LATIN, dtype=np.uint8)
        for code in range(self.LATIN):
            text = chr(code)
            self.kind[code] = 0 if re.match(r"\s", text) and code not in range(0x1C, 0x20) else 1 if text.isalpha() else 2 if text.isnumeric() else 3
        self.usable = np.ones(self.LATIN + 1, dtype=bool)
        self.usable[[0x27, *range(0x1C, 0x20), 0x85, 0xAA, 0xBA, self.LATIN]] = False  # apostrophe, and what counts differently elsewhere
        self.values = mixed(np.arange(1, self.LATIN + 1, dtype=np.uint64))
        line = self.whole(["\n"])[0]
        self.line = int(line[0]) if len(line) == 1 else -1
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)  # hashes in order
        self.entry, self.at, self.size, self.ids = (np.zeros(0, dtype=np.int32) for _ in range(4))  # their places in at and size

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.int32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind one another, and how many each text has."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        use = np.ones(len(texts), dtype=bool)
        if self.added:
            use[[i for i, t in enumerate(texts) if self.added.search(t)]] = False
        codes = np.minimum(codes, np.uint32(self.LATIN)).astype(np.int64)
        odd = np.flatnonzero(~self.usable.take(codes))
        use[np.searchsorted(np.cumsum(lengths), odd, side="right")] = False
        if not use.all():
            codes = codes[np.repeat(use, lengths)]
        inside = np.where(use, lengths, 0)
        starts = self._starts(codes, inside)
        flat, counts = self._words(codes, starts)
        per_word = np.append(0, np.cumsum(counts))
        edges = per_word[np.searchsorted(starts, np.append(0, np.cumsum(inside)))]
        per_row = np.diff(edges)
        if use.all():
            return flat, per_row
        parts, left = np.split(flat, edges[1:-1]), np.flatnonzero(~use).tolist()
        for at, ids in zip(left, self.whole([texts[i] for i in left]), strict=True):
            parts[at], per_row[at] = ids, len(ids)
        return np.concatenate(parts), per_row

    def _starts(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin: a space before a word belongs to it, other white space is
        one token but for its last character before a word."""
        if not len(codes):
            return np.zeros(0, dtype=np.int64)
        kind = self.kind.take(codes)
        first = np.zeros(len(codes) + 1, dtype=bool)
        first[np.append(0, np.cumsum(lengths))] = True
        first, last = first[:-1], first[1:]
        before = np.concatenate(([0], kind[:-1])).astype(np.uint8)
        after = np.concatenate((kind[1:], [0])).astype(np.uint8)
        after_space = np.concatenate(([False], codes[:-1] == 0x20)) & ~first
        white = kind == 0
        begins = ~white & (first | (kind != before)) & ~after_space
        begins |= white & (first | (before != 0))
        begins |= white & ~last & (after != 0)
        return np.flatnonzero(begins)

    def _words(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(starts):
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        length = np.diff(np.append(starts, len(codes)))
        value = self.values.take(codes)
        value *= _powers(BASE, len(codes))
        value = np.add.reduceat(value, starts) * _powers(pow(BASE, -1, 1 << 64), len(codes)).take(starts)
        found = pa.array(mixed(value)).dictionary_encode()
        hashed, which = found.dictionary.to_numpy(), found.indices.to_numpy()
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        spot = np.searchsorted(self.known, hashed)
        new = np.ones(len(hashed), dtype=bool)
        inside = spot < len(self.known)
        new[inside] = self.known[spot[inside]] != hashed[inside]
        entry = np.empty(len(hashed), dtype=np.int64)
        entry[~new] = self.entry.take(spot[~new])
        if new.any():
            entry[new] = len(self.size) + np.arange(np.count_nonzero(new))
            example = np.empty(len(hashed), dtype=np.int64)
            example[which[::-1]] = np.arange(len(which))[::-1]
            ids, size = self._learn(codes, starts[example[new]], length[example[new]])
            order = np.argsort(hashed[new])
            place = np.searchsorted(self.known, hashed[new][order])
            self.known = np.insert(self.known, place, hashed[new][order])
            self.entry = np.insert(self.entry, place, len(self.size) + order)
            self.at = np.append(self.at, (len(self.ids) + np.cumsum(size) - size).astype(np.int32))
            self.size, self.ids = np.append(self.size, size.astype(np.int32)), np.append(self.ids, ids)
        count = self.size.take(entry).take(which).astype(np.int64)
        begin = self.at.take(entry).take(which).astype(np.int64)
        begin -= np.cumsum(count) - count
        place = np.repeat(begin, count)
        place += np.arange(len(place))
        return self.ids.take(place), count

    def _learn(self, codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words, and how many each has. The library gets many words that are not white
        space as one text of a word a line, where it cuts the same words; lines are told by their id."""
        lines = self.kind.take(codes.take(begin + size - 1)) != 0
        order = np.argsort(~lines, kind="stable")
        begin, size, n = begin[order], size[order], int(np.count_nonzero(lines))
        ends = np.cumsum(size + 1)
        text = np.full(int(ends[-1]), 0x0A, dtype="<u4")
        text[np.arange(len(text)) != np.repeat(ends - 1, size + 1)] = codes.take(np.arange(int(size.sum())) + np.repeat(begin - np.cumsum(size) + size, size))
        ends = np.append(0, ends)

        def words(a: int, b: int) -> str:
            return text[ends[a] : ends[b] - 1].tobytes().decode("utf-32-le")

        chunks = [(a, min(a + LINES, n)) for a in range(0, n, LINES)]
        ids, counts = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
        for (a, b), found in zip(chunks, self.whole([words(a, b) for a, b in chunks]), strict=True):
            line = found == self.line
            cuts = np.concatenate(([-1], np.flatnonzero(line), [len(found)]))
            if len(cuts) == b - a + 1 and (np.diff(cuts) > 1).all():
                ids.append(found[~line])
                counts.append(np.diff(cuts) - 1)
            else:
                alone = self.whole([words(i, i + 1) for i in range(a, b)])
                ids += alone
                counts.append(np.array([len(x) for x in alone]))
        white = self.whole([words(i, i + 1) for i in range(n, len(order))])
        size = np.concatenate([*counts, np.array([len(x) for x in white], dtype=np.int64)])
        flat = np.concatenate([*ids, *white])
        back = np.argsort(order)
        at = (np.cumsum(size) - size)[back]
        size = size[back]
        return flat[np.arange(len(flat)) + np.repeat(at - np.cumsum(size) + size, size)], size


def wordwise_encoder(path: str) -> WordwiseEncoder:
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        _ENCODERS[path] = WordwiseEncoder(path)
    return _ENCODERS[path]


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0
) -> None:
    """Encodes every whole text, adds ``end_id`` and writes the files to ``path``.

    Documents are in ascending order of key, then text; null keys come first, null and empty
    texts are the end id alone. Rows that share a key are documents of their own. Further
    columns are ignored; an empty table gives no files. Ids over 65535 raise an error.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    parts = total_bytes(rows, "_text") // PART_BYTES + 1
    ranged = rows.repartitionByRange(parts, key).sortWithinPartitions(key, "_text")
    fields = ["part", "block", "n_ids", "crc32", "payload", "keys", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, waiting = TaskContext.get().partitionId(), 0, [], 0
        encode = wordwise_encoder(tokenizer).encode

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, held, waiting
            held[:] = [np.concatenate(held)]
            coded, sizes = encode_ids(held.pop())  # which holds the only copy
            n = len(coded)
            columns = [
                pa.array([part] * n, pa.int32()), pa.array(range(block, block + n), pa.int32()), pa.array(sizes, pa.int64()),
                pa.array([zlib.crc32(c) for c in coded], pa.int64()), pa.array(coded, pa.binary()),
                pa.nulls(n, pa.list_(key_type)), pa.nulls(n, pa.list_(pa.int64())),
            ]
            block, held, waiting = block + n, [], 0
            yield pa.RecordBatch.from_arrays(columns, fields)

        key_type, order = pa.int64(), 0
        for batch in small_batches(batches, 1):
            key_type = batch.column(0).type
            texts = batch.column(1).to_pylist()
            ids, counts = encode(texts)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id)
            counts = counts + 1
            held.append(ids)
            waiting += len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([-1 - order], pa.int32()), pa.array([len(ids)], pa.int64()), pa.nulls(1, pa.int64()),
                    pa.nulls(1, pa.binary()), pa.array([batch.column(0).to_pylist()], pa.list_(key_type)), pa.array([counts], pa.list_(pa.int64())),
                ],
                fields,
            )
            order += 1
            if waiting >= FLUSH_IDS:
                yield from flush()
        if held:
            yield from flush()

    schema = f"part int, block int, n_ids long, crc32 long, payload binary, keys array<{kind}>, counts array<long>"
    ranged.mapInArrow(run, schema).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """From the files, one row per document: key, start (ids of all documents before it),
    n_tokens and ids_crc32 (of the ids as little-endian unsigned 32-bit integers).

    A block whose checksum is wrong raises an error.
    """
    table = spark.read.parquet(path)
    kind = table.schema["keys"].dataType.elementType.simpleString()
    sizes = table.filter("block < 0").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        numbers = rows.column("block").to_numpy()
        blocks = rows.filter(pa.array(numbers >= 0))
        index = rows.filter(pa.array(numbers < 0)).sort_by([("block", "descending")])
        payload = [p.as_py() for p in blocks.column("payload")]
        if [zlib.crc32(p) for p in payload] != blocks.column("crc32").to_pylist():
            raise ValueError("a block's checksum is wrong")
        size, ids = blocks.column("n_ids").to_pylist(), [np.zeros(0, np.uint16)]
        for at in range(0, len(payload), READ_BLOCKS):
            ids += decode_ids(payload[at : at + READ_BLOCKS], size[at : at + READ_BLOCKS])
        flat = np.concatenate(ids)
        keys = index.column("keys").combine_chunks().flatten()
        counts = index.column("counts").combine_chunks().flatten().to_numpy()
        ends = np.cumsum(counts)
        crcs = [zlib.crc32(flat[a:b].astype("<u4")) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
        part = np.full(len(counts), rows.column("part")[0].as_py(), dtype=np.int32)
        return pa.table({"part": part, key: keys, "start": ends - counts, "n_tokens": counts, "ids_crc32": pa.array(crcs, pa.int64())})

    found = table.groupBy("part").applyInArrow(run, f"part int, `{key}` {kind}, start long, n_tokens long, ids_crc32 long")
    return found.join(offsets, "part").select(key, (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
