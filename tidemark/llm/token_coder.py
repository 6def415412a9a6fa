"""Adaptive range coding of token ids with mixed order-0 to order-2 predictions.

Ids are cut into blocks that start from an empty model, so each can be read alone. Blocks of
a file are coded side by side, one id of every block at a time, as numpy rows ("lanes").

A block numbers its distinct ids by first place; the model sees these numbers. For each the
order-2 context (two before) and the order-1 context (one before) name the number that followed
last, each with a confidence. One four-way symbol says which of them is right, that the id is
a new one, or none of this; its frequencies are the sum of two adaptive tables, one per
confidence. Numbers that neither context names are coded by how often the block codes each of
them so (order 0). They do not depend on the contexts and have a range coder of their own.

A block is words of 16 bits: how many ids are distinct, how many of their order-0 frequencies
are over 14, how many words the symbols take; the distinct ids; their frequencies in four bits
each, then those over 14, marked there by 15; the coded symbols; the coded numbers.
"""

from __future__ import annotations

import numpy as np

BLOCK_IDS = 4096
SLOTS = 4096  # a number has 12 bits: blocks hold at most this many ids
NOTHING = 0x8000
LOWEST = np.int64(1 << 32)  # a range is at least this, and under 1 << 48; two symbols leave it 2 or more
KIND_BITS = 16
KIND_RATE = 5
_SPREAD = np.uint64(0x0001000100010001)


def _kind_targets() -> np.ndarray:
    """What the starts of the four symbols move to once a symbol is seen: it takes all of 32768
    but for one of each other. The four starts of 16 bits are one number here."""
    at, seen = np.arange(4), np.arange(4)[:, None]
    return np.where(at <= seen, at, 32764 + at).astype(np.int16).view(np.int64).reshape(-1)


def _levels() -> np.ndarray:
    """From twice the confidence of a name (8 and up: nothing), one more if it was wrong: the
    confidence after, in bits 12 to 14, and below them ones if the name stays though it was wrong."""
    wrong = [(t >> 1) << 12 | (0xFFF if t > 1 else 0) for t in range(8)] + [0] * 8
    return np.array([x for t in range(16) for x in (min(t + 1, 7) << 12, wrong[t])], dtype=np.uint16)


KIND_TARGETS, LEVELS = _kind_targets(), _levels()


class Encoder:
    """A range encoder per lane. Carries are added to the words at the end."""

    def __init__(self, lanes: int, most: int) -> None:
        self.low = np.zeros(lanes, dtype=np.int64)
        self.range = np.full(lanes, (1 << 48) - 1, dtype=np.int64)
        self.out = np.zeros((lanes, most + 3), dtype=np.int32)
        self.place = np.arange(lanes) * (most + 3)

    def unit(self, k: int, total: np.ndarray | None) -> np.ndarray:
        return _unit(self.range[:k], total)

    def code(self, unit: np.ndarray, start: np.ndarray, freq: np.ndarray) -> None:
        """Codes a symbol in each of the first lanes."""
        self.low[: len(unit)] += unit * start
        np.multiply(unit, freq, out=self.range[: len(unit)])

    def widen(self, k: int) -> None:
        """After every second symbol: makes the ranges of the first ``k`` lanes wide again."""
        move = (self.range[:k] < LOWEST).nonzero()[0]
        while len(move):
            self._shift(move)
            width = self.range[move] << 16
            self.range[move] = width
            move = move[width < LOWEST]

    def _shift(self, move: np.ndarray) -> None:
        low, place = self.low[move], self.place[move]
        self.out.reshape(-1)[place] = low >> 32
        self.place[move] = place + 1
        self.low[move] = (low & (LOWEST - 1)) << 16

    def words(self) -> list[np.ndarray]:
        lanes = np.arange(len(self.low))
        for _ in range(3):
            self._shift(lanes)
        size = self.place - lanes * self.out.shape[1]
        out = self.out[:, : int(size.max(initial=0))]
        while (carry := out >> 16).any():
            out &= 0xFFFF
            out[:, :-1] += carry[:, 1:]
        return [row[:n].astype("<u2") for row, n in zip(out, size.tolist(), strict=True)]


class Decoder:
    """The same lanes the other way: words from ``place`` on."""

    def __init__(self, data: np.ndarray, place: np.ndarray) -> None:
        self.data, self.place = data, place + 3
        self.range = np.full(len(place), (1 << 48) - 1, dtype=np.int64)
        first = data[place[:, None] + np.arange(3)].astype(np.int64)
        self.value = first @ np.array([1 << 32, 1 << 16, 1])

    def unit(self, k: int, total: np.ndarray | None) -> np.ndarray:
        return _unit(self.range[:k], total)

    def point(self, unit: np.ndarray, last: int | np.ndarray) -> np.ndarray:
        """Where the next symbol of each of the first lanes lies, at most at ``last``. The value is
        under 1 << 48 and the quotient under 1 << 17, so a double rounds it down right."""
        return np.minimum((self.value[: len(unit)] / unit).astype(np.int64), last)

    def code(self, unit: np.ndarray, start: np.ndarray, freq: np.ndarray) -> None:
        """Takes the symbols just found."""
        self.value[: len(unit)] -= unit * start
        np.multiply(unit, freq, out=self.range[: len(unit)])

    def widen(self, k: int) -> None:
        move = (self.range[:k] < LOWEST).nonzero()[0]
        while len(move):
            place = self.place[move]
            self.value[move] = (self.value[move] << 16) | self.data.take(place)
            self.place[move] = place + 1
            width = self.range[move] << 16
            self.range[move] = width
            move = move[width < LOWEST]


def _unit(width: np.ndarray, total: np.ndarray | None) -> np.ndarray:
    """The share of a range for a frequency of one: of ``1 << KIND_BITS``, or of ``total`` up to
    4096, by doubles that are exact for 40 bits over 12 bits."""
    if total is None:
        return width >> KIND_BITS
    return ((width >> 8) / total).astype(np.int64) << 8


def _active(sizes: np.ndarray) -> list[int]:
    """How many lanes have a symbol at each step; ``sizes`` falls."""
    return np.searchsorted(-sizes, -np.arange(1, int(sizes.max(initial=0)) + 1), side="right").tolist()


def run_kinds(coder: Encoder | Decoder, sizes: np.ndarray, numbers: np.ndarray, begin: np.ndarray | None = None) -> np.ndarray:
    """Codes ``numbers`` (a row per step, a column per lane) but for those of order 0, and returns
    the symbols; or finds the numbers, given those of order 0 of each lane from ``begin`` on."""
    lanes, steps = len(sizes), _active(sizes)
    out = np.zeros((len(steps), lanes), dtype=np.uint16 if begin is not None else np.uint8)
    follow = np.full(2 * lanes * SLOTS, NOTHING, dtype=np.uint16)  # confidence << 12 | number, or nothing
    hits = np.tile(np.arange(4, dtype=np.int16) * 8192, (2 * lanes * 32, 1)).view(np.int64).reshape(-1)
    bases, contexts = (np.arange(2 * lanes).reshape(2, lanes) * n for n in (SLOTS, 32))
    columns, four = np.arange(lanes), np.arange(lanes) * 4
    one, two, count = (np.zeros(lanes, dtype=np.int64) for _ in range(3))
    row = np.zeros(0)
    for step, k in enumerate(steps):
        if k != row.size:
            one, two, count = one[:k], two[:k], count[:k]
            base, context, lane, at, row = bases[:, :k].copy(), contexts[:, :k].copy(), columns[:k], four[:k], columns[:k] * 0
            choice = np.zeros((4, k), dtype=np.uint16)
            named, both = choice[:2], np.zeros((2, k), dtype=np.int64)
        np.bitwise_and(two + one, SLOTS - 1, out=both[0])
        both[1] = one
        slots = base + both
        held = follow.take(slots)
        np.bitwise_and(held, NOTHING | 0xFFF, out=named)
        trust = held >> 11
        trust &= 30
        ctx = context + trust
        ctx[1] += named[0] == named[1]
        rows = hits.take(ctx).view(np.int16).reshape(2, -1)
        ends = (rows[0] + rows[1]).view(np.uint16)
        unit = coder.unit(k, None)
        if begin is None:
            found = numbers[step, :k]
            choice[3] = count
            same = (choice == found).view(np.int8)
            kind = ((1 - same[0]) * (2 - same[1] + same[3])).astype(np.int64)
            out[step, :k] = kind
        else:
            point = coder.point(unit, (1 << KIND_BITS) - 1).view(np.uint64) * _SPREAD
            kind = np.bitwise_count((ends <= point.view(np.uint16)).view(np.uint32)).astype(np.int64) - 1
            choice[2], choice[3] = numbers.take(begin[:k]), count
            found = choice.reshape(-1).take(kind * k + lane)
            begin[:k] += kind == 2
            out[step, :k] = found
        low = ends.take(at + kind)
        freq = ends.take(at + (kind + 1 & 3)) - low  # the end of the last symbol is 0 modulo 65536
        coder.code(unit, low.astype(np.int64), freq.astype(np.int64))
        if step & 1:
            coder.widen(k)
        change = KIND_TARGETS.take(kind).view(np.int16) - rows
        change >>= KIND_RATE
        rows += change
        hits[ctx] = rows.view(np.int64)
        differs = named ^ found
        trust += differs != 0
        level = LEVELS.take(trust)
        differs &= level & 0xFFF
        differs ^= found
        differs |= level & 0x7000
        follow[slots] = differs
        count += kind == 3
        two = one * 2531
        one = found.astype(np.int64)
    return out


def run_numbers(coder: Encoder | Decoder, sizes: np.ndarray, freqs: np.ndarray, begin: np.ndarray, numbers: np.ndarray | None = None) -> np.ndarray:
    """Codes the numbers of order 0 (a row per step, a column per lane), or finds them when None.
    The frequencies of a lane's numbers are in ``freqs`` from ``begin`` on, lane by lane, and add up
    to its size."""
    lanes, steps = len(sizes), _active(sizes)
    out = np.zeros((len(steps), lanes), dtype=np.uint16) if numbers is None else numbers
    total, last, base = sizes.astype(np.float64), sizes - 1, np.cumsum(sizes) - sizes
    of, distinct = np.arange(len(freqs)), np.diff(np.append(begin, len(freqs)))
    starts = np.cumsum(freqs) - freqs - np.repeat(base, distinct)
    table = (starts << 16 | freqs).astype(np.uint32)
    if numbers is None:
        owner = np.repeat((of - np.repeat(begin, distinct)).astype(np.uint16), freqs)
    for step, k in enumerate(steps):
        unit = coder.unit(k, total[:k])
        which = owner.take(base[:k] + coder.point(unit, last[:k])) if numbers is None else numbers[step, :k]
        if numbers is None:
            out[step, :k] = which
        found = table.take(begin[:k] + which).astype(np.int64)
        coder.code(unit, found >> 16, found & 0xFFFF)
        if step & 1:
            coder.widen(k)
    return out


def _number(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids by first place, and each id's number among them; ``first`` is scratch."""
    ids = ids.astype(np.int64)
    place = np.arange(len(ids), dtype=np.uint16)
    np.put(first, ids[::-1], place[::-1])
    at = first.take(ids)
    new = at == place
    return ids[new], (np.cumsum(new, dtype=np.uint16) - np.uint16(1)).take(at)


def encode_ids(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> tuple[list[bytes], list[int]]:
    """Blocks of coded ids (each under 65536, else an error) and the number of ids in each."""
    if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < 1 << 16:
        raise ValueError(f"ids from {ids.min()} to {ids.max()} do not fit into 16 bits")
    if not 0 < block_ids <= SLOTS:
        raise ValueError(f"a block of {block_ids} ids: 1 to {SLOTS} are possible")
    starts = range(0, len(ids), block_ids)
    sizes = np.array([min(block_ids, len(ids) - at) for at in starts], dtype=np.int64)
    lanes = len(sizes)
    numbers, new, first = np.zeros((lanes, block_ids), dtype=np.uint16), [], np.zeros(1 << 16, dtype=np.uint16)
    for lane, at in enumerate(starts):
        distinct, numbers[lane, : sizes[lane]] = _number(ids[at : at + block_ids], first)
        new.append(distinct.astype("<u2"))
    del ids  # as large as the tables to come
    coder = Encoder(lanes, block_ids)
    kinds = run_kinds(coder, sizes, np.ascontiguousarray(numbers.T)).T
    symbols = coder.words()
    plain = kinds == 2
    plain &= np.arange(plain.shape[1]) < sizes[:, None]
    counts = np.count_nonzero(plain, axis=1)
    order = np.argsort(-counts, kind="stable")
    ranked = counts[order]
    rest = np.zeros((lanes, int(counts.max(initial=0))), dtype=np.uint16)
    rest[np.arange(rest.shape[1]) < ranked[:, None]] = numbers[order, : plain.shape[1]][plain[order]]
    freqs = [np.bincount(row[:n], minlength=len(new[lane])) for row, n, lane in zip(rest, ranked.tolist(), order.tolist(), strict=True)]
    begin = np.cumsum([0, *map(len, freqs)])[:-1]
    coder = Encoder(lanes, rest.shape[1])
    run_numbers(coder, ranked, np.concatenate([np.zeros(0, np.int64), *freqs]), begin, np.ascontiguousarray(rest.T))
    coded = coder.words()
    blocks = [b""] * lanes
    for rank, lane in enumerate(order.tolist()):
        often = freqs[rank] > 14
        small = np.where(often, 15, freqs[rank]).astype(np.uint8)
        small = np.append(small, np.zeros(-len(small) % 4, np.uint8)).reshape(-1, 2)
        head = np.array([len(new[lane]), np.count_nonzero(often), len(symbols[lane])], dtype="<u2")
        tail = coded[rank] if counts[lane] else coded[rank][:0]
        body = (head, new[lane], small[:, 0] | small[:, 1] << 4, freqs[rank][often].astype("<u2"), symbols[lane], tail)
        blocks[lane] = b"".join(x.tobytes() for x in body)
    return blocks, sizes.tolist()


def decode_ids(blocks: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block; blocks may come in any order and number."""
    lanes = len(blocks)
    data = np.frombuffer(b"".join(blocks) + bytes(8), dtype="<u2")
    start = np.cumsum([0, *(len(b) // 2 for b in blocks)])[:-1]
    new, often, symbols = data[start + np.arange(3)[:, None]].astype(np.int64)
    small, freqs = start + 3 + new, []
    large = small + (new + 3) // 4
    for a, b, n in zip(small.tolist(), large.tolist(), new.tolist(), strict=True):
        pair = data[a:b].view(np.uint8)
        freq = np.stack((pair & 15, pair >> 4), axis=1).reshape(-1)[:n].astype(np.int64)
        more = (freq == 15).nonzero()[0]
        freq[more] = data[b : b + len(more)]
        freqs.append(freq)
    first = large + often
    counts = np.array([f.sum(dtype=np.int64) for f in freqs], dtype=np.int64)
    order = np.argsort(-counts, kind="stable")
    ranked = counts[order]
    coder = Decoder(data, np.where(counts, first + symbols, start)[order])
    flat = np.concatenate([np.zeros(0, np.int64), *(freqs[i] for i in order.tolist())])
    rest = run_numbers(coder, ranked, flat, np.cumsum(new[order]) - new[order]).T
    rest = np.append(rest[np.arange(rest.shape[1]) < ranked[:, None]], np.uint16(0))
    place = np.zeros(lanes, dtype=np.int64)
    place[order] = np.cumsum(ranked) - ranked
    length = np.array(sizes, dtype=np.int64)
    order = np.argsort(-length, kind="stable")
    numbers = run_kinds(Decoder(data, first[order]), length[order], rest, place[order])
    out: list[np.ndarray] = [np.zeros(0, np.uint16)] * lanes
    for lane, at in enumerate(order.tolist()):
        out[at] = data[start[at] + 3 + numbers[: length[at], lane].astype(np.int64)]
    return out
