"""SentencePiece segmentations sampled by forward filtering and backward sampling.

The vocabulary has no piece in which a space mark follows another character, so the lattice
of a text falls apart at word starts and at characters outside the vocabulary; a segment's
lattice is filtered once however often the segment occurs, and each occurrence draws its own
way back. Draws depend on the row's key and the place in the text only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import mixed, small_batches

MARK, LITERAL_MARK = 0x2581, 0x110000  # the mark for spaces, and a mark that the text itself holds
SPAN = 1 << 21  # characters whose lattices are held at a time
BYTE_COST = -12.0
_MODELS: dict[tuple[str, float], "PieceModel"] = {}


class PieceModel:
    """Pieces of a model file, with log weights by rank: ids are in the order of merging, so
    -log of the rank stands in for the log probability that a BPE file does not hold."""

    def __init__(self, path: str, sharpness: float) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.byte_ids = np.zeros(256, dtype=np.int32)
        pieces: dict[int, str] = {}
        decoded = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                decoded.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                decoded.append(b"")
            else:
                pieces[i] = piece
                decoded.append(piece.replace("▁", " ").encode())
        if any("▁" in p.lstrip("▁") for p in pieces.values()):
            raise ValueError("a piece holds a space mark after another character")
        self.decoded_at = np.concatenate(([0], np.cumsum([len(d) for d in decoded])))
        self.decoded = np.frombuffer(b"".join(decoded), dtype=np.uint8)
        self.longest = max(map(len, pieces.values()))
        first = min(pieces)
        hashes = np.array([self._hash(np.array([ord(c) for c in p], np.uint32)) for p in pieces.values()])
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(list(pieces), dtype=np.int32)[order]
        self.weights = (-sharpness * np.log(self.ids - first + 10.0)).astype(np.float32)
        self.maybe = np.zeros(1 << 22, dtype=bool)
        self.maybe[self.hashes >> np.uint64(42)] = True
        self.single = np.zeros(LITERAL_MARK + 1, dtype=bool)
        self.single[[ord(p) for p in pieces.values() if len(p) == 1]] = True

    @staticmethod
    def _value(codes: np.ndarray) -> np.ndarray:
        return mixed(codes.astype(np.uint64) + np.uint64(1))

    def _hash(self, codes: np.ndarray) -> np.uint64:
        total = np.zeros(1, dtype=np.uint64)
        for value in self._value(codes):
            total = total * np.uint64(0x9E3779B97F4A7C15) + value
        return mixed(total)[0]

    def lattice(self, codes: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log weight and id of the piece of each length that starts at each character."""
        weight = np.full((self.longest, len(codes)), -np.inf, dtype=np.float32)
        ids = np.full((self.longest, len(codes)), -1, dtype=np.int32)
        value = self._value(codes)
        alive, total = np.arange(len(codes)), np.zeros(len(codes), dtype=np.uint64)
        for length in range(1, self.longest + 1):
            if length > 1:
                keep = room[alive] >= length
                alive, total = alive[keep], total[keep]
            total = total * np.uint64(0x9E3779B97F4A7C15) + value[alive + length - 1]
            hashed = mixed(total)
            some = np.flatnonzero(self.maybe[hashed >> np.uint64(42)])
            spot = np.minimum(np.searchsorted(self.hashes, hashed[some]), len(self.hashes) - 1)
            found = self.hashes[spot] == hashed[some]
            weight[length - 1, alive[some[found]]] = self.weights[spot[found]]
            ids[length - 1, alive[some[found]]] = self.ids[spot[found]]
        weight[0, ids[0] < 0] = BYTE_COST
        return weight, ids

    def sample(self, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts behind one another, and how many each text has."""
        lengths = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
        joined = "".join(" " + t for t in texts if t)
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).copy()
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        codes[codes == MARK] = LITERAL_MARK
        codes[codes == 0x20] = MARK
        row = np.repeat(np.arange(len(texts)), lengths)
        row_start = np.cumsum(lengths) - lengths
        outside = ~self.single[codes]
        begins = codes == MARK
        begins[1:] &= codes[:-1] != MARK
        begins |= outside
        begins[1:] |= outside[:-1]
        begins[row_start[lengths > 0]] = True
        start = np.flatnonzero(begins)
        length = np.diff(np.append(start, len(codes)))
        inner = np.arange(len(codes)) - np.repeat(start, length)
        powers = np.full(int(length.max()), 0xD1342543DE82EF95, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        hashed = np.add.reduceat(self._value(codes) * powers[inner], start)
        _, example, kind = np.unique(hashed, return_index=True, return_inverse=True)
        order = np.argsort(-length[example], kind="stable")
        example, rank = example[order], np.argsort(order)
        kind = rank[kind]
        size = length[example]  # falling
        base = np.cumsum(size) - size
        node = base + np.arange(len(size))
        local = np.arange(int(size.sum())) - np.repeat(base, size)
        weight, ids = self.lattice(codes[local + np.repeat(start[example], size)], np.repeat(size, size) - local)
        ways = self._filter(weight, base, node, size)
        return self._draw(codes, row, row_start, seeds, start, length, kind, base, node, ways, ids, len(texts))

    def _filter(self, weight: np.ndarray, base: np.ndarray, node: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each place of each segment the running chances of the lengths of its last piece."""
        ways = np.ones((int(size.sum()) + len(size), self.longest), dtype=np.float32)
        reached = np.zeros(len(ways), dtype=np.float64)
        counts = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right")
        for place, k in enumerate(counts.tolist(), 1):
            here = node[:k] + place
            steps = min(place, self.longest)
            parts = np.stack([reached[here - n] + weight[n - 1, base[:k] + place - n] for n in range(1, steps + 1)])
            top = parts.max(axis=0)
            chance = np.cumsum(np.exp(parts - top), axis=0)
            reached[here] = top + np.log(chance[-1])
            ways[here, :steps] = (chance / chance[-1]).T
        return ways

    def _draw(self, codes, row, row_start, seeds, start, length, kind, base, node, ways, ids, rows):  # noqa: ANN001, ANN202
        chosen = np.full(len(codes), -2, dtype=np.int32)
        left, at = length.copy(), np.arange(len(start))
        while len(at):
            end = start[at] + left[at] - 1
            doc = row[end]
            draw = mixed(seeds[doc] + mixed((end - row_start[doc]).astype(np.uint64)))
            chance = (draw >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)
            step = 1 + (ways[node[kind[at]] + left[at]] <= chance[:, None]).sum(axis=1)
            chosen[end] = ids[step - 1, base[kind[at]] + left[at] - step]
            left[at] -= step
            at = at[left[at] > 0]
        end = np.flatnonzero(chosen >= -1)
        found, many = chosen[end], np.ones(len(end), dtype=np.int64)
        as_bytes = np.flatnonzero(found < 0)
        out_codes, which = np.unique(codes[end[as_bytes]], return_inverse=True)
        spelled = [(chr(c) if c != LITERAL_MARK else chr(MARK)).encode() for c in out_codes.tolist()]
        many[as_bytes] = np.array([len(s) for s in spelled] or [0], dtype=np.int64)[which] if len(as_bytes) else 0
        flat = np.repeat(found, many)
        if len(as_bytes):
            byte_at = np.cumsum(many) - many
            text = np.frombuffer(b"".join(spelled), dtype=np.uint8)
            text_at = np.cumsum([0, *(len(s) for s in spelled)])[which]
            number = many[as_bytes]
            inner = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
            flat[np.repeat(byte_at[as_bytes], number) + inner] = self.byte_ids[text[np.repeat(text_at, number) + inner]]
        return flat, np.bincount(row[end], weights=many, minlength=rows).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts, as UTF-8, of the pieces of each row."""
        size = np.diff(self.decoded_at)[ids]
        begin = np.cumsum(size) - size
        inner = np.arange(int(size.sum())) - np.repeat(begin, size)
        data = self.decoded[np.repeat(self.decoded_at[ids], size) + inner].tobytes()
        edges = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(counts)))]
        return [data[lo + 1 : hi] for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def piece_model(path: str, sharpness: float = 1.0) -> PieceModel:
    """The model, loaded once per worker."""
    if (path, sharpness) not in _MODELS:
        _MODELS[path, sharpness] = PieceModel(path, sharpness)
    return _MODELS[path, sharpness]


def _spans(texts: list[str]) -> Iterator[slice]:
    begin, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= SPAN:
            yield slice(begin, at + 1)
            begin, size = at + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def sample_pieces(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 0,
    sharpness: float = 1.0,
    with_ids: bool = True,
) -> DataFrame:
    """Each row of ``docs`` without its text, with n_pieces, pieces_crc32, lossless and, if
    wanted, the piece ids.

    A segmentation is drawn with the chance of the product of its pieces' weights (rank to the
    power of minus ``sharpness``) among all segmentations; the same key, seed and text give the
    same one. Characters outside the vocabulary become byte pieces. ``lossless`` says that
    decoding the pieces gave the text again. Null and empty texts have no pieces; null keys and
    repeated rows are sampled like others; an empty table gives no rows. Columns that are
    called like the new ones are replaced.
    """
    new = ["n_pieces", "pieces_crc32", "lossless", "pieces"][: 4 if with_ids else 3]
    kept = [c for c in docs.columns if c != text and c not in new]
    start = F.xxhash64(F.lit(seed), F.col(key)).alias("_seed")
    rows = docs.select(*(F.col(c) for c in kept), F.col(text).alias("_text"), start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path, sharpness)
        for batch in small_batches(batches, len(kept)):
            texts = [t or "" for t in batch.column(batch.num_columns - 2).to_pylist()]
            seeds = batch.column(batch.num_columns - 1).to_numpy().view(np.uint64)
            for part in _spans(texts):
                ids, counts = model.sample(texts[part], seeds[part])
                again = model.decode(ids, counts)
                edges = np.concatenate(([0], np.cumsum(counts)))
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                same = [a == t.encode() for a, t in zip(again, texts[part], strict=True)]
                columns = [batch.column(i).slice(part.start, part.stop - part.start) for i in range(len(kept))]
                columns += [pa.array(counts), pa.array(crcs, pa.int64()), pa.array(same, pa.bool_())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(columns, [*kept, *new])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    fields += ["n_pieces long", "pieces_crc32 long", "lossless boolean", "pieces array<int>"][: len(new)]
    return rows.mapInArrow(run, ", ".join(fields))
