"""PCA whitening of vectors by Chebyshev-filtered subspace iteration.

Each entry c becomes the whole number floor(SCALE * c) + OFFSET. The covariance V of the
vectors is never formed: a pass over the table gives V Q for a block Q of a few columns, as
the sum of Xc' (Xc Q) over all tasks, Xc being the centred vectors. A filter step runs the
three-term recurrence of a Chebyshev polynomial through such passes; it stays below 1 on the
unwanted part of the spectrum and grows fast above it. QR makes the filtered block
orthonormal, Rayleigh-Ritz takes the eigenvectors within it, and both are repeated until the
residuals certify the wanted pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stash import Stash

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
DEGREE = 10  # passes of one filter step
ROUNDS = 60  # filter steps after which the search is given up with an error
_ROWS = 8192  # vectors taken at once
_FLOOR = 4 * np.finfo(float).eps  # of the largest eigenvalue, times the dimension's root


class NotConverged(RuntimeError):
    """The residuals were not small enough after all filter steps."""


@dataclass(frozen=True)
class Moments:
    """Exact sums over the vectors: their number, per dimension the sum, and the trace of V."""

    n: int
    sums: np.ndarray  # of int64
    trace: float

    def gaps(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        return self.n * x - self.sums


@dataclass(frozen=True)
class Whitener:
    """Components in rows by falling eigenvalue, and what the passes have certified."""

    moments: Moments
    components: np.ndarray
    values: np.ndarray
    residuals: np.ndarray  # norms of V q - e q
    passes: int


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    """The vectors of Arrow batches as whole numbers, a bounded number of rows at once."""
    for batch in batches:
        vectors = batch.column(batch.num_columns - 1)
        for at in range(0, batch.num_rows, _ROWS):
            part = vectors.slice(at, _ROWS)
            yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), dimension)


def whole_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x): x the whole numbers of each vector that is usable."""
    sound = F.col(vector).isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )

    def whole(c: Column) -> Column:
        scaled = F.floor(c.cast("double") * SCALE)
        inside = F.abs(c.cast("double") * SCALE) < F.lit(float(1 << 53))
        return F.when(inside, scaled.cast("long") + OFFSET).otherwise(F.raise_error(F.lit("an entry is too large")))

    x = F.transform(vector, whole)
    return df.filter(sound).select(F.col(key).alias("_key"), x.alias("x"))


def _dimension(x: DataFrame) -> int:
    found = x.agg(F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    if found["low"] != found["high"]:
        raise ValueError(f"vectors of {found['low']} to {found['high']} entries cannot be whitened together")
    return found["low"] or 0


def moments_of(x: DataFrame, dimension: int) -> Moments:
    """Number, sums and trace, added up in whole numbers: tasks give partial sums only."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, most, sums, squares = 0, 0, np.zeros(dimension, object), np.zeros(dimension, object)
        for block in _blocks(batches, dimension):
            near = block - OFFSET
            # _ROWS squares must fit 63 bits; larger entries are added as Python integers
            small = max(abs(int(near.min())), abs(int(near.max()))) < 1 << 24
            near = near if small else near.astype(object)
            n, most = n + len(block), max(most, abs(int(block.min())), abs(int(block.max())))
            sums = sums + block.astype(np.int64 if small else object).sum(0).astype(object)
            squares = squares + (near * near).sum(0).astype(object)
        if n:
            yield pa.RecordBatch.from_pydict(
                {
                    "at": list(range(dimension)), "n": [n] * dimension, "most": [most] * dimension,
                    "s": [str(v) for v in sums], "q": [str(v) for v in squares],
                }
            )

    parts = x.select("x").mapInArrow(partial, "at long, n long, most long, s string, q string")
    whole = "decimal(38,0)"
    rows = parts.groupBy("at").agg(
        F.sum("n").alias("n"), F.max("most").alias("most"),
        F.sum(F.col("s").cast(whole)).alias("s"), F.sum(F.col("q").cast(whole)).alias("q")
    ).collect()  # one row per dimension
    rows.sort(key=lambda r: r["at"])
    n = rows[0]["n"] if rows else 0
    if rows and n * rows[0]["most"] >= 1 << 62:
        raise OverflowError("n times an entry does not fit into 63 bits")
    trace = Fraction(0)
    for r in rows:
        near = int(r["s"]) - OFFSET * n  # squares are about OFFSET
        trace += Fraction(n * int(r["q"]) - near * near, n * n)
    return Moments(n, np.array([int(r["s"]) for r in rows], dtype=np.int64), float(trace))


def covariance_times(x: DataFrame, moments: Moments) -> Callable[[np.ndarray], np.ndarray]:
    """A function that gives V Q by one pass over the vectors."""
    dimension, n = len(moments.sums), moments.n

    def product(q: np.ndarray) -> np.ndarray:
        columns = q.shape[1]

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((dimension, columns))
            for block in _blocks(batches, dimension):
                centred = moments.gaps(block) / n
                total += centred.T @ (centred @ q)
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], names=["v"])

        parts = x.select("x").mapInArrow(partial, "v array<double>")
        sums = parts.select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
        found = sums.collect()  # dimension x columns numbers, whatever the number of rows
        out = np.zeros(dimension * columns)
        out[[r["at"] for r in found]] = [r["v"] for r in found]
        return out.reshape(dimension, columns) / n

    return product


def _filtered(times: Callable, q: np.ndarray, vq: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """The block after a scaled Chebyshev polynomial that damps eigenvalues in [low, cut].

    ``vq`` is V q, known from Rayleigh-Ritz, so the first step takes no pass.
    """
    half, centre = (cut - low) / 2, (cut + low) / 2
    sigma = half / (top - centre)
    first, before = sigma, q
    now = (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        now, before = (times(now) - centre * now) * (2 * after / half) - before * (sigma * after), now
        sigma = after
    return now


class _LowEnd:
    """A lower bound of the spectrum by Lanczos steps, one column that rides along in the passes."""

    def __init__(self, start: np.ndarray) -> None:
        self.basis, self.diagonal, self.side = [start / np.linalg.norm(start)], [], []

    @property
    def vector(self) -> np.ndarray:
        return self.basis[-1]

    def step(self, image: np.ndarray) -> None:
        q = self.vector
        self.diagonal.append(float(q @ image))
        rest = image - self.diagonal[-1] * q - (self.side[-1] * self.basis[-2] if self.side else 0)
        for b in self.basis:
            rest = rest - b * (b @ rest)
        norm = float(np.linalg.norm(rest))
        self.side.append(norm)
        self.basis.append(rest / norm if norm > 0 else rest)

    def bound(self) -> float:
        if not self.diagonal:
            return 0.0
        tri = np.diag(self.diagonal) + np.diag(self.side[:-1], 1) + np.diag(self.side[:-1], -1)
        return max(0.0, float(np.linalg.eigvalsh(tri)[0]) - self.side[-1])


def principal_components(
    times: Callable[[np.ndarray], np.ndarray],
    moments: Moments,
    components: int = COMPONENTS,
    block: int | None = None,
    degree: int = DEGREE,
    rounds: int = ROUNDS,
    seed: int = 11,
) -> Whitener:
    """The ``components`` leading eigenpairs of V.

    A pair is certified when its residual is at the rounding error of a pass, or so small
    against the distance of its eigenvalue from the others that the eigenvector is right to
    1e-12. Equal eigenvalues have no such distance; there only the residual counts, and any
    orthonormal basis of their space is right.
    """
    dimension = len(moments.sums)
    wanted = min(components, dimension)
    size = min(dimension, block or max(4 * wanted, wanted + 8))
    random = np.random.default_rng(seed)
    q = np.linalg.qr(random.standard_normal((dimension, size)))[0]
    passes, lanczos = 0, _LowEnd(random.standard_normal(dimension))

    def with_bound(columns: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        if len(lanczos.basis) > min(degree, dimension - 1) or not np.any(lanczos.vector):
            return times(columns)
        image = times(np.column_stack([columns, lanczos.vector]))
        lanczos.step(image[:, -1])
        return image[:, :-1]

    for _ in range(rounds):
        vq = with_bound(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(values[0], 0.0)
        residuals = np.linalg.norm(vq - q * values, axis=0)
        floor = _FLOOR * top * np.sqrt(dimension)
        sound = True
        for i in range(wanted):
            others = np.delete(values, i)
            gap = np.abs(others - values[i]).min() if len(others) else top
            sound &= residuals[i] <= max(floor, 1e-12 * gap)
        if sound or top == 0:
            return Whitener(moments, q[:, :wanted].T, values[:wanted], residuals[:wanted], passes)
        cut = values[-1]
        low = min(lanczos.bound(), 0.9 * cut)
        if cut <= 0 or low >= cut:  # the block holds all that varies
            q = np.linalg.qr(vq)[0]
            continue
        q = np.linalg.qr(_filtered(with_bound, q, vq, low, cut, top, degree))[0]
    raise NotConverged(f"residuals {residuals[:wanted]} after {passes} passes")


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The whitener of a table of whole vectors, None if there is none."""
    dimension = _dimension(x)
    if not dimension:
        return None
    moments = moments_of(x, dimension)
    return principal_components(covariance_times(x, moments), moments, components)


def _identity_error(rows: DataFrame, count: int) -> float:
    """Largest distance of the covariance of the whitened entries from the identity."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(count), np.zeros((count, count))
        for block in _blocks(batches, count):
            n += len(block)
            sums += block.sum(0)
            products += block.T @ block
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([[n], sums, products.ravel()])])], names=["v"])

    parts = rows.select("whitened").mapInArrow(partial, "v array<double>")
    found = parts.select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    v = np.zeros(1 + count + count * count)
    v[[r["at"] for r in found]] = [r["v"] for r in found]
    mean = v[1 : 1 + count] / v[0]
    covariance = v[1 + count :].reshape(count, count) / v[0] - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(count)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: key, component, n, deviation, whitened,
    explained, identity_error.

    Vectors that are null or hold null or non-finite entries are dropped; the rest, repeated
    rows and null keys included, are the fit list and all returned. ``deviation`` is the sum
    of (n x - S)^2 over the dimensions. A component whose eigenvalue is zero up to rounding
    has a null ``whitened`` and stays out of ``identity_error``, which is null if there is no
    other. Vectors of fewer entries than ``components`` have one component per entry; a table
    without usable or with only empty vectors gives no rows. Vectors of different lengths,
    entries beyond 2^53 / SCALE and deviations beyond 63 bits raise an error. Further columns
    are ignored.

    A pass sends dimension x block numbers per task through a sum and as many to the driver,
    whatever the number of rows; the block has at most 4 x ``components`` columns.
    """
    stash = Stash(df.sparkSession, "whitening")
    x = stash.put(whole_vectors(df, key, vector), "whole")
    model = fit(x, components)
    kind = df.schema[key].dataType.simpleString()
    names = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or model.moments.n == 0:
        return df.sparkSession.createDataFrame([], f"`{key}` {kind}, {names}")
    moments, dimension = model.moments, len(model.moments.sums)
    known = model.values > _FLOOR * max(model.values[0], 0.0) * dimension
    scale = np.sqrt(np.where(known, model.values, 1.0))
    turn = (model.components / scale[:, None]).T

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                block = next(_blocks(iter([part]), dimension))
                gaps = moments.gaps(block)
                if float(np.abs(gaps).max()) ** 2 * dimension >= 2**63:
                    squares = (gaps.astype(object) ** 2).sum(1)
                    if max(squares) >= 2**63:
                        raise OverflowError("a deviation does not fit into 63 bits")
                else:
                    squares = (gaps * gaps).sum(1)
                white = (gaps / moments.n) @ turn
                borders = np.arange(0, white.size + 1, white.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(squares.astype(np.int64)), pa.ListArray.from_arrays(borders, white.ravel())],
                    names=["_key", "deviation", "whitened"],
                )

    projected = stash.put(x.mapInArrow(project, f"_key {kind}, deviation long, whitened array<double>"), "projected")
    count = int(known.sum())  # eigenvalues fall, so these come first
    leading = projected.select(F.slice("whitened", 1, count).alias("whitened"))
    error = F.lit(_identity_error(leading, count) if count else None).cast("double")
    explained = F.lit([float(v / moments.trace) if moments.trace else 0.0 for v in np.maximum(model.values, 0)])
    at = F.col("component") - 1
    return projected.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(known)))).alias("component")).select(
        F.col("_key").alias(key),
        "component",
        F.lit(moments.n).cast("long").alias("n"),
        "deviation",
        F.when(F.col("component") <= count, F.get("whitened", at)).alias("whitened"),
        F.get(explained, at).alias("explained"),
        error.alias("identity_error"),
    )
