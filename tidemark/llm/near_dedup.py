"""MinHash near-de-duplication with sequential Bayesian verification.

Signatures of 128 values in 32 bands of 4 propose candidates; at a similarity of 0.75
a pair shares no band with probability (1 - 0.75^4)^32, about 5e-6. A candidate's
signatures are then compared 16 values at a time, and it is given up as soon as the
posterior probability of reaching the similarity is under ``MISS``. Survivors are
confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.stash import Stash
from tidemark.llm.words import mixed, shingle_sets, small_batches, words_of

SHINGLE = 5
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS
STEP = 16
MISS = 1e-7
BLOCK = 512  # rows on either side of a block comparison
LARGE_GROUP = 64  # components with more members are visited instead of compared per bucket
BROADCAST_IDS = 1_000_000

_RANDOM = np.random.default_rng(7)
_FLIP = _RANDOM.integers(0, 2**32, (HASHES, 1), dtype=np.uint32)
_FACTOR = _RANDOM.integers(0, 2**31, (HASHES, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over one set of shingle hashes."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(low), 4096):
        np.minimum(out, ((low[at : at + 4096] ^ _FLIP) * _FACTOR).min(axis=1), out=out)
    return out


def least_matches(percent: int, miss: float = MISS) -> dict[int, int]:
    """For each number of compared values, the matches a pair needs in order to go on.

    With a uniform prior the posterior of the similarity after m of n matches is
    Beta(m + 1, n - m + 1); the chance that it reaches t is the binomial probability of
    at most m successes in n + 1 trials at t.
    """
    t, out = percent / 100, {}
    for n in range(STEP, HASHES + 1, STEP):
        reach, m = 0.0, -1
        while reach < miss:
            m += 1
            reach += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out[n] = m
    return out


def likely(left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of two signature matrices survive the sequential test."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), dtype=np.int64)
    for n, least in least_matches(percent).items():
        part = slice(n - STEP, n)
        matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1)
        go_on = matches >= least
        alive, matches = alive[go_on], matches[go_on]
    return alive


def _signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            sets = shingle_sets(words_of(batch.column(1), lower=True), SHINGLE)
            with np.errstate(over="ignore"):
                one = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                two = np.array([mixed(~s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(one.view(np.int64)),
                    pa.array(two.view(np.int64)),
                    pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                ],
                ["id", "n_shingles", "d1", "d2", "sig"],
            )

    return docs.select(F.col(key), F.col(text)).mapInArrow(
        run, f"id {kind}, n_shingles long, d1 long, d2 long, sig binary"
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, HASHES)


def _survivors(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that survive the sequential test."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive = likely(_matrix(batch.column("sig_a")), _matrix(batch.column("sig_b")), percent)
            yield batch.select(["a", "b"]).take(pa.array(alive))

    left = sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"))
    right = sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, f"a {kind}, b {kind}")


def _sets(docs: DataFrame, key: str, text: str, ids: DataFrame, stash: Stash) -> DataFrame:
    """The sorted shingle hashes (id, members) of the documents in ``ids``.

    Up to ``BROADCAST_IDS`` keys go to the scan; more of them are joined by a shuffle.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            sets = shingle_sets(words_of(batch.column(1), lower=True), SHINGLE)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "members"]
            )

    ids = stash.put(ids.distinct(), "ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    wanted = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(ids, "id", "left_semi")
    sets = wanted.mapInArrow(run, f"id {kind}, members binary")
    return stash.put(sets, "sets")


def _set(value: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=np.uint64)


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, percent: int, stash: Stash) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the similarity."""
    kind = pairs.schema["a"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("set_a"), batch.column("set_b"), strict=True)
            good = [_similar(_set(x), _set(y), percent) for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    pairs = stash.put(pairs, "survivors")
    sets = _sets(docs, key, text, pairs.select("a").union(pairs.select("b")).toDF("id"), stash)
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("set_b"))
    links = pairs.join(left, "a").join(right, "b").mapInArrow(compare, f"a {kind}, b {kind}")
    links = stash.put(links, "confirmed")
    stash.drop(sets)
    return links


def _labelled(members: DataFrame, column: str, labels: DataFrame, name: str) -> DataFrame:
    """Adds the component of ``column``; a node without links is its own."""
    found = labels.select(F.col("node").alias(column), F.col("component").alias("_found"))
    return (
        members.join(found, column, "left")
        .withColumn(name, F.coalesce("_found", column))
        .drop("_found")
    )


def _block_pairs(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a block's rows, of different components, that survive the sequential test.

    A pair is looked at in the first band that it shares.
    """
    sig, own = _matrix(table.column("sig")), table.column("own").to_numpy()
    x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
    comp = np.unique(np.array(table.column("comp").to_pylist()), return_inverse=True)[1]
    band = table.column("band_no")[0].as_py()
    left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
    for at in range(0, len(left), 64):
        i, j = (g.ravel() for g in np.meshgrid(left[at : at + 64], right, indexing="ij"))
        use = (comp[i] != comp[j]) & ((i < j) | (x != y))
        i, j = i[use], j[use]
        alive = likely(sig[i], sig[j], percent)
        i, j = i[alive], j[alive]
        earlier = (sig[i, : BAND_ROWS * band] == sig[j, : BAND_ROWS * band]).reshape(len(i), band, BAND_ROWS)
        fresh = ~earlier.all(axis=2).any(axis=1)
        if fresh.any():
            yield i[fresh], j[fresh]


def spanning_links(nodes: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node that the links (a, b) join to a smaller one, that node and the smallest."""
    label = np.arange(nodes)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(nodes))
    return moved, label[moved]


def _within_buckets(
    members: DataFrame, sigs: DataFrame, docs: DataFrame, key: str, text: str, percent: int, stash: Stash
) -> DataFrame:
    """Links (a, b) that join the different small components within each bucket (band, rep, comp).

    A bucket is cut into blocks of about ``BLOCK`` rows and each two blocks meet in one task.
    There signatures name the rows that a surviving pair needs; their full sets come to the
    block once per row, all surviving pairs are counted on them in the task, and the rows
    that are linked return with one link each. So no pair crosses a shuffle, however many
    survive.
    """
    kind = members.schema["rep"].dataType.simpleString()
    parts = members.groupBy("band").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("parts"))
    placed = members.join(parts, "band").join(sigs, "rep")
    own = F.pmod(F.xxhash64("rep"), F.col("parts"))
    placed = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other"))
    names = ["band", "band_no", "x", "y", "own", "rep", "comp", "sig"]
    types = f"band long, band_no int, x long, y long, own long, rep {kind}, comp {kind}, sig binary"

    def needed(table: pa.Table) -> pa.Table:
        rows = [np.concatenate(pair) for pair in _block_pairs(table, percent)]
        return table.select(names).take(pa.array(np.unique(np.concatenate([np.zeros(0, np.int64), *rows]))))

    def linked(table: pa.Table) -> pa.Table:
        members = [_set(v) for v in table.column("members")]
        sizes = np.array([len(m) for m in members])
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in _block_pairs(table, percent):
            left, right = np.unique(i), np.unique(j)
            shared = shared_counts([members[k] for k in left], [members[k] for k in right])
            shared = shared[np.searchsorted(left, i), np.searchsorted(right, j)]
            good = 100 * shared >= percent * (sizes[i] + sizes[j] - shared)
            a.append(i[good])
            b.append(j[good])
        moved, least = spanning_links(table.num_rows, np.concatenate(a), np.concatenate(b))
        rep = table.column("rep")
        return pa.table({"a": rep.take(pa.array(moved)), "b": rep.take(pa.array(least))})

    place = ["band", "x", "y"]
    rows = stash.put(placed.select(names).groupBy(*place).applyInArrow(needed, types), "compared")
    sets = _sets(docs, key, text, rows.select(F.col("rep").alias("id")), stash).withColumnRenamed("id", "rep")
    links = rows.join(sets, "rep").groupBy(*place).applyInArrow(linked, f"a {kind}, b {kind}")
    links = stash.put(links, "within")
    stash.drop(sets)
    return links


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    for at in range(0, len(common), columns):
        part = common[at : at + columns]
        sides = []
        for sets in (left, right):
            grid = np.zeros((len(sets), len(part)), dtype=np.float32)
            for row, members in enumerate(sets):
                grid[row] = np.isin(part, members, assume_unique=True)
            sides.append(grid)
        out += sides[0] @ sides[1].T
    return out


def _visits(
    members: DataFrame, large: DataFrame, sigs: DataFrame, docs: DataFrame, key: str, text: str, percent: int, stash: Stash
) -> DataFrame:
    """Links (a, b) between large components and what shares a bucket with them.

    A row visits each larger component of its bucket once, not once per bucket. Visitors and
    hosts meet in blocks; the sequential test goes first, the full sets of what survives are
    counted in the same task, and one link per visitor is returned, since the hosts are one
    component already.
    """
    kind = members.schema["rep"].dataType.simpleString()
    hosts = members.join(large, "comp").select("band", F.col("comp").alias("host"), F.col("n").alias("host_n")).distinct()
    guests = members.join(large, "comp", "left").select("band", "rep", "comp", F.coalesce("n", F.lit(0)).alias("n"))
    visits = guests.join(hosts, "band").filter(F.struct("n", "comp") < F.struct("host_n", "host"))
    visits = stash.put(visits.select("rep", "host").distinct(), "visits")
    homes = members.join(large, "comp").select("rep", F.col("comp").alias("host")).distinct()
    homes = homes.join(visits.select("host").distinct(), "host", "left_semi").select("rep", "host")
    both = visits.withColumn("guest", F.lit(True)).unionByName(homes.withColumn("guest", F.lit(False)))
    counts = both.groupBy("host").agg(
        F.ceil(F.count_if("guest") / F.lit(BLOCK)).alias("guests"),
        F.ceil(F.count_if(~F.col("guest")) / F.lit(BLOCK)).alias("homes"),
    )
    sets = _sets(docs, key, text, both.select(F.col("rep").alias("id")), stash).withColumnRenamed("id", "rep")
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("guest"), F.col("guests")).otherwise(F.col("homes")))
    other = F.sequence(F.lit(0), F.when(F.col("guest"), F.col("homes")).otherwise(F.col("guests")) - 1)
    placed = both.join(counts, "host").withColumn("own", own).withColumn("other", F.explode(other))
    placed = placed.withColumn("x", F.when(F.col("guest"), F.col("own")).otherwise(F.col("other")))
    placed = placed.withColumn("y", F.when(F.col("guest"), F.col("other")).otherwise(F.col("own")))
    placed = placed.join(sigs, "rep").join(sets, "rep").select("host", "x", "y", "guest", "rep", "sig", "members")

    def run(table: pa.Table) -> pa.Table:
        sig, guest = _matrix(table.column("sig")), table.column("guest").to_numpy()
        members = [_set(v) for v in table.column("members")]
        left, right = np.flatnonzero(guest), np.flatnonzero(~guest)
        a, b = [], []
        for at in range(0, len(left) if len(right) else 0, 64):
            i, j = (g.ravel() for g in np.meshgrid(left[at : at + 64], right, indexing="ij"))
            alive = likely(sig[i], sig[j], percent)
            if len(alive):
                i, j = np.unique(i[alive]), np.unique(j[alive])
                shared = shared_counts([members[k] for k in i], [members[k] for k in j])
                size = np.array([len(members[k]) for k in i])[:, None] + np.array([len(members[k]) for k in j])
                linked = 100 * shared >= percent * (size - shared)
                some = np.flatnonzero(linked.any(axis=1))
                a.extend(i[some])
                b.extend(j[linked[some].argmax(axis=1)])
        rep = table.column("rep")
        return pa.table({"a": rep.take(pa.array(a, pa.int64())), "b": rep.take(pa.array(b, pa.int64()))})

    links = stash.put(placed.groupBy("host", "x", "y").applyInArrow(run, f"a {kind}, b {kind}"), "visited")
    stash.drop(sets)
    return links


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75, large_group: int = LARGE_GROUP
) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, kept.

    Texts are lower-cased (A-Z) and cut into words; a row's set holds its distinct 5-word
    shingles, or its whole word sequence when that is shorter. Rows are linked when
    100 * intersection >= percent * union.

    1. Rows with equal sets are one class, stood for by its least key.
    2. Each bucket of a band names its least member as pivot; a class is compared with
       its least pivot first, then with the pivots that are not yet in its component.
    3. Buckets that still hold several components compare them in blocks; components with
       more than ``large_group`` rows in such buckets are compared once with all rows that
       share a bucket with them.

    So a group of copies costs one comparison per member and pivot, never all pairs, while
    every candidate pair that could still join two components is looked at.

    Empty and null texts have an empty set and are linked with nothing. Rows that share a
    key are one document for links. A null key has no component and is kept. An empty table
    gives no rows; further columns are ignored.
    """
    stash = Stash(docs.sparkSession, "near-dedup")
    sigs = stash.put(_signatures(docs, key, text), "signatures")
    same = ["d1", "d2", "n_shingles"]
    classes = sigs.filter("n_shingles > 0").groupBy(*same).agg(F.min("id").alias("rep")).filter("rep IS NOT NULL")
    classes = stash.put(classes, "classes")
    reps = sigs.withColumn("rep", F.col("id")).join(classes, [*same, "rep"], "left_semi")
    reps = reps.select("rep", "sig").dropDuplicates(["rep"])
    bands = reps.select(
        "rep",
        F.posexplode(
            F.expr(
                f"transform(sequence(0, {BANDS - 1}), "
                f"i -> xxhash64(substring(sig, i * {4 * BAND_ROWS} + 1, {4 * BAND_ROWS}), i))"
            )
        ).alias("band_no", "band"),
    )
    buckets = bands.groupBy("band").agg(F.min("rep").alias("pivot"), F.count("*").alias("n"))
    buckets = stash.put(buckets.filter("n > 1").drop("n"), "buckets")
    shared = stash.put(bands.join(buckets, "band"), "shared")
    candidates = stash.put(
        shared.select("rep").distinct().join(reps, "rep"), "candidates"
    )  # the signatures that any comparison needs

    proposed = shared.filter("rep > pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
    first = stash.put(proposed.groupBy("a").agg(F.min("b").alias("b")), "first")
    links = _confirmed(_survivors(first, candidates, percent), docs, key, text, percent, stash)
    labels = components(links, stash)

    rest = _labelled(proposed.distinct().join(first, ["a", "b"], "left_anti"), "a", labels, "ca")
    rest = _labelled(rest, "b", labels, "cb").filter("ca <> cb").select("a", "b")
    more = _confirmed(_survivors(rest, candidates, percent), docs, key, text, percent, stash)
    links = links.union(more)
    labels = components(links, stash)

    members = _labelled(shared.select("band", "band_no", "rep"), "rep", labels, "comp")
    mixed_buckets = members.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    mixed_buckets = mixed_buckets.filter("lo < hi").select("band")
    members = stash.put(members.join(mixed_buckets, "band", "left_semi"), "mixed")
    large = members.groupBy("comp").agg(F.count_distinct("rep").alias("n")).filter(F.col("n") > large_group)
    large = stash.put(large, "large")
    small = members.join(large, "comp", "left_anti")
    last = _within_buckets(small, candidates, docs, key, text, percent, stash)
    links = links.union(last).union(_visits(members, large, candidates, docs, key, text, percent, stash))
    labels = components(links, stash)

    linked = _labelled(classes, "rep", labels, "component").drop("rep")
    found = sigs.drop("sig").join(linked, same, "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return found.select(
        F.col("id").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """The row with the least key of each group of near duplicates, with the columns of ``docs``."""
    gone = near_duplicates(docs, key, text, percent).filter(~F.col("kept")).select(key).distinct()
    return docs.join(gone, key, "left_anti")
