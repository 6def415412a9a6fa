"""Words and word n-grams of whole Arrow batches as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D. Everything works on the
UTF-8 buffer of a text column at once; no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 4 << 20

_RANDOM = np.random.default_rng(20240229)
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = _RANDOM.integers(1, 2**63, (2, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_IS_LETTER = _IS_WORD.copy()
_IS_LETTER[[b for b in range(0x80) if not chr(b).isalnum()]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


@dataclass
class Words:
    """Words of a batch: byte ranges in ``data``, and the first word of each row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one entry per row and one past the end

    @property
    def rows(self) -> int:
        return len(self.first) - 1


def text_buffer(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows behind one another, and each row's offsets. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    if body is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(body, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def small_batches(batches: Iterator[pa.RecordBatch], column: int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, to bound a task's memory."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def words_of(texts: pa.Array | pa.ChunkedArray, lower: bool = False, letters_only: bool = False) -> Words:
    """All words of all rows; ``lower`` turns A-Z into a-z and nothing else.

    With ``letters_only`` all ASCII bytes but letters and digits separate words.
    """
    data, offsets = text_buffer(texts)
    if lower:
        data = _LOWER[data]
    inside = (_IS_LETTER if letters_only else _IS_WORD)[data]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets))


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits depend on all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(words: Words, block: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of each word's bytes, alike in every process."""
    out = np.empty(len(words.starts), dtype=np.uint64)
    lengths = words.ends - words.starts
    powers = _powers(int(lengths.max(initial=1)))
    for at in range(0, len(out), block):
        length = lengths[at : at + block]
        start = words.starts[at : at + block]
        borders = np.zeros(len(length), dtype=np.int64)
        np.cumsum(length[:-1], out=borders[1:])
        place = np.arange(int(length.sum()), dtype=np.int64)
        inner = place - np.repeat(borders, length)
        value = _BYTE_VALUES[words.data[inner + np.repeat(start, length)]] * powers[inner]
        out[at : at + block] = np.add.reduceat(value, borders)
    return mixed(out)


def ngram_hashes(hashes: np.ndarray, n: int, family: int = 0) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words; runs are built by doubling.

    Runs that cross from one row into the next are included: see ``ngram_starts``.
    """
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    factors = _MULTIPLIERS[family]
    power, size, level, done, total = hashes, 1, 0, 0, None
    rest = n
    while rest:
        if rest & 1:
            if total is None:
                total = power
            else:
                keep = len(hashes) - done - size + 1
                total = mixed(total[:keep] * factors[level + 32]) + power[done : done + keep]
            done += size
        rest >>= 1
        if rest:
            keep = len(power) - size
            power = mixed(power[:keep] * factors[level]) + power[size : size + keep]
            size, level = size * 2, level + 1
    return mixed(total[: len(hashes) - n + 1] + np.uint64(n))


def ngram_starts(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start words of the n-grams inside a row, in order, and how many each row has."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(first[:-1] - before, counts), counts


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its n-grams.

    A row with fewer words is one shingle, its whole sequence; a row without words has none.
    """
    hashes = word_hashes(words)
    grams = ngram_hashes(hashes, n)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if hi - lo >= n:
            found = np.sort(grams[lo : hi - n + 1])
            if len(found) > 1:
                found = found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif hi > lo:
            found = ngram_hashes(hashes[lo:hi], hi - lo)
        else:
            found = np.zeros(0, dtype=np.uint64)
        out.append(found)
    return out
