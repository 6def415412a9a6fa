"""Sharding by a k-d tree over metadata: DataFrame operations only.

A node is split along its widest dimension at a weighted median, found by histograms: each
round adds up bytes in ``BINS`` bins of the interval that holds the median, of all nodes of
a level in one aggregation, and goes on in one bin. Only these sums reach the driver, at
most nodes x BINS rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.stash import Stash

BINS = 256
WHOLE_GROUP = 0.02  # equal texts stay together up to this share of a shard
CLOSE_ENOUGH = 1e-4  # of a shard's bytes, for a cut
ROWS_PER_CELL = 50_000
_LONG = 1 << 63


def _number(df: DataFrame, column: str) -> Column:
    """A column as a long that keeps its order; texts by their first seven bytes."""
    kind = df.schema[column].dataType.simpleString()
    if kind in ("tinyint", "smallint", "int", "bigint", "date", "timestamp", "boolean"):
        value = F.col(column).cast("int") if kind == "boolean" else F.col(column)
        value = F.unix_date(value) if kind == "date" else value
        value = value.cast("long")
    elif kind in ("float", "double") or kind.startswith("decimal"):
        value = (F.col(column) * 1000).cast("long")
    else:
        head = F.rpad(F.hex(F.substring(F.col(column).cast("string").cast("binary"), 1, 7)), 14, "0")
        value = F.conv(head, 16, 10).cast("long")
    return F.coalesce(value, F.lit(0).cast("long"))


def _of_node(values: dict[int, int | float], default: int | float = 0) -> Column:
    """A value per node, for the few nodes of a level."""
    found = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
    return F.coalesce(F.element_at(found, F.col("node")), F.lit(default))


def _histogram(rows: DataFrame, low: dict[int, int], step: dict[int, int], value: Column) -> dict[int, dict[int, int]]:
    inside = (value >= _of_node(low)) & (value - _of_node(low) < _of_node({n: s * BINS for n, s in step.items()}))
    bins = rows.filter(F.col("node").isin(list(low)) & inside).select(
        "node", "size", (value - _of_node(low)).alias("gap"), _of_node(step, 1).alias("step")
    )
    sums = bins.groupBy("node", F.expr("gap div step").alias("bin")).agg(F.sum("size").alias("bytes"))
    out: dict[int, dict[int, int]] = {n: {} for n in low}
    for row in sums.collect():
        out[row["node"]][row["bin"]] = row["bytes"]
    return out


def _cuts(
    rows: DataFrame, value: Column, low: dict[int, int], high: dict[int, int], want: dict[int, float], near: float
) -> tuple[dict[int, int], dict[int, float], dict[int, bool]]:
    """Per node the value at which ``want`` bytes are reached, the bytes still wanted there,
    and whether the value itself must be cut further."""
    low, want = dict(low), dict(want)
    width = {n: high[n] - low[n] + 1 for n in low}
    cut: dict[int, int] = {}
    further: dict[int, bool] = {}
    while low:
        step = {n: -(-width[n] // BINS) for n in low}
        for n, sums in _histogram(rows, low, step, value).items():
            done, inside = 0, 0
            for at in sorted(sums):
                inside = at
                if done + sums[at] > want[n]:
                    break
                done += sums[at]
            want[n] -= done
            weight = sums.get(inside, 0)
            low[n] += inside * step[n]
            width[n] = step[n]
            if weight <= near or want[n] <= 0 or want[n] >= weight:
                cut[n] = low[n] + (step[n] if 2 * want[n] > weight else 0)
                further[n] = False
            elif step[n] == 1:
                cut[n], further[n] = low[n], True
            if n in cut:
                low.pop(n), width.pop(n)
    return cut, want, further


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: Sequence[str] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, shard, slot.

    ``shards`` leaves, or as many as bring them to ``target_bytes``, get nearly equal bytes
    (size: UTF-8 bytes of the text plus 1). Each node is cut in proportion to the leaves on
    both sides, along the dimension that is widest against its range over all rows. Equal
    values are told apart by a hash of the text, so equal texts share a shard; a group of
    equal texts over ``WHOLE_GROUP`` of a shard, however large, is spread by a hash of the key.
    For that, a group counts with the least value of each dimension.

    ``dimensions`` default to those of lang, source and n_chars that are there. ``slot``
    counts from 0 without gaps in each shard; it is numbered in small cells whose sizes are
    summed up, so no task sorts a shard. Null texts are empty, null dimensions are 0, a null
    key is a key; repeated rows are rows. An empty table gives no rows.
    """
    stash = Stash(docs.sparkSession, "kd-shards")
    if dimensions is None:
        dimensions = [c for c in ("lang", "source", "n_chars") if c in docs.columns and c not in (key, text)]
    content = F.coalesce(F.col(text), F.lit(""))
    coordinates = [f"_d{i}" for i in range(len(dimensions) + 1)]
    base = docs.select(
        F.col(key).alias("id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("crc"),
        F.xxhash64(content).alias("unit"),
        *(_number(docs, c).alias(name) for c, name in zip(dimensions, coordinates, strict=False)),
        F.octet_length(content).cast("long").alias(coordinates[-1]),
    )
    base = stash.put(base, "sizes")
    total = base.agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).first()
    n_bytes, n_rows = total["bytes"] or 0, total["n"]
    leaves = shards or max(1, round(n_bytes / target_bytes))
    target = n_bytes / leaves
    groups = base.groupBy("unit").agg(
        F.sum("size").alias("unit_bytes"), *(F.min(c).alias(c) for c in coordinates)
    )
    heavy = F.col("unit_bytes") > F.lit(target * WHOLE_GROUP)
    own, row = F.xxhash64("unit"), F.xxhash64("id", "unit")
    tie = F.when(heavy, F.shiftleft(F.shiftright(own, 32), 32) + F.pmod(row, F.lit(1 << 32))).otherwise(own)
    rows = base.select("id", "size", "crc", "unit").join(groups, "unit")
    rows = rows.select(
        "id", "size", "crc", *coordinates, F.shiftright(tie, 2).alias("tie"), F.lit(0).alias("node")
    )
    rows = stash.put(rows, "rows")
    limits = [(F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi")) for c in coordinates]
    limits = [x for pair in limits for x in pair]
    nodes, whole = {0: leaves} if leaves > 1 and n_rows else {}, None
    while nodes:
        found = rows.filter(F.col("node").isin(list(nodes))).groupBy("node").agg(F.sum("size").alias("bytes"), *limits)
        found = {r["node"]: r for r in found.collect()}
        first = found.get(0)
        whole = whole or {c: max(1, first[f"{c}_hi"] - first[f"{c}_lo"]) for c in coordinates}
        nodes = {n: k for n, k in nodes.items() if n in found}
        if not nodes:
            break
        widest = {
            n: max(range(len(coordinates)), key=lambda i, r=found[n]: (r[f"_d{i}_hi"] - r[f"_d{i}_lo"]) / whole[f"_d{i}"])
            for n in nodes
        }
        value = F.element_at(F.array(*coordinates), _of_node({n: i + 1 for n, i in widest.items()}, 1).cast("int"))
        low = {n: found[n][f"_d{i}_lo"] for n, i in widest.items()}
        high = {n: found[n][f"_d{i}_hi"] for n, i in widest.items()}
        left = {n: (k + 1) // 2 for n, k in nodes.items()}
        want = {n: found[n]["bytes"] * left[n] / nodes[n] for n in nodes}
        near = target * CLOSE_ENOUGH
        cut, rest, further = _cuts(rows, value, low, high, want, near)
        tied = [n for n in nodes if further[n]]
        ties: dict[int, int] = {}
        if tied:
            same = rows.filter(value == _of_node({n: cut[n] for n in tied}))
            ties, _, exact = _cuts(
                same, F.col("tie"), {n: -(_LONG >> 2) for n in tied}, {n: (_LONG >> 2) - 1 for n in tied},
                {n: rest[n] for n in tied}, near,
            )
            ties = {n: t + bool(exact[n]) for n, t in ties.items()}
        lowest = -_LONG
        at_cut = value == _of_node(cut)
        right = (value > _of_node(cut)) | (at_cut & (F.col("tie") >= _of_node({n: ties.get(n, lowest) for n in nodes})))
        moved = _of_node({n: n + left[n] for n in nodes})
        rows = rows.withColumn("node", F.when(F.col("node").isin(list(nodes)) & right, moved).otherwise(F.col("node")).cast("int"))
        rows = stash.put(rows, "level")
        children = [(n, left[n]) for n in nodes] + [(n + left[n], nodes[n] - left[n]) for n in nodes]
        nodes = {n: k for n, k in children if k > 1}
    cells = n_rows // ROWS_PER_CELL + 1
    placed = rows.withColumn("cell", F.pmod(F.xxhash64("id", "crc"), F.lit(cells)))
    counts = placed.groupBy("node", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("node").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("node", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("node", "cell").orderBy("id", "crc", "size")
    numbered = placed.withColumn("at", F.row_number().over(inside)).join(counts, ["node", "cell"])
    return numbered.select(
        F.col("id").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.col("node").alias("shard"),
        (F.col("before") + F.col("at") - 1).alias("slot"),
    )
