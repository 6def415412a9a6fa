"""Interaction audit of five quality filters by the potential of their removal game.

The players of the game are the filters, a coalition's worth is the number of documents that
at least one of its filters rejects. The Hart-Mas-Colell potential follows from the worths by

    P(empty) = 0,  |S| P(S) = worth(S) + sum of P(S without i) over i in S,

and P(all) - P(all without i) is the Shapley value of filter i: what it removes on average
over all orders. What it removes at one place of one order is the difference of the worths
of the filters up to it and of those before it. So 32 worths per part give all 600 rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.stash import Stash

FILTERS = "ABCDE"
_ALL = (1 << len(FILTERS)) - 1
_ORDERS = 120  # of five filters; also makes all potentials whole numbers
_COPY = 1 << FILTERS.index("E")


def failures(text: Column) -> Column:
    """The filters A to D that a text fails, as a bit mask.

    A: fewer than 200 words. B: 100 * distinct words < 50 * words. C: 100 * letters A-Z
    > 3 * code points. D: holds any of # $ % & * |. Words are runs of characters other than
    space and 0x09-0x0D.
    """
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    tests = [
        F.size(words) < 200,
        F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * 50,
        capitals * 100 > F.length(text).cast("long") * 3,
        text.rlike("[#$%&*|]"),
    ]
    mask = F.lit(0)
    for bit, failed in enumerate(tests):
        mask = mask + F.when(failed, 1 << bit).otherwise(0)
    return mask


def _of_equal_texts(rows: DataFrame) -> DataFrame:
    """Rows (part, mask, good, toxic, n), with filter E in the mask.

    E rejects a row if an equal text has a smaller id. Equal texts are grouped by id first
    and then by what the game asks for, each time with a partial aggregate, so a text that a
    third of all rows share comes to few rows before its digest brings them together: one
    per part and label.
    """
    same = ["_digest", "part", "mask", "good", "toxic"]
    per_id = rows.groupBy("_id", *same).agg(F.count("*").alias("n"))
    known = F.when(F.col("_id").isNotNull(), F.struct("_id", "n"))
    kinds = per_id.groupBy(*same).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("_id").isNotNull(), F.col("n"))).alias("with_id"),
        F.min(known).alias("least"),
    )
    # a digest has at most one row per part and label here
    joined = kinds.withColumn("_first", F.min("least._id").over(Window.partitionBy("_digest")))
    originals = F.when(F.col("least._id") == F.col("_first"), F.col("least.n")).otherwise(0)
    copies = F.coalesce(F.col("with_id") - originals, F.lit(0))
    split = joined.select(
        "part", "good", "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask"), (F.col("n") - copies).alias("n")),
                F.struct((F.col("mask") + _COPY).alias("mask"), copies.alias("n")),
            )
        ).alias("_s"),
    )
    return split.select("part", "good", "toxic", "_s.*").groupBy("part", "good", "toxic", "mask").agg(
        F.sum("n").alias("n")
    )


def worths(counts: DataFrame) -> DataFrame:
    """Per part: n documents, and arrays indexed by coalition of the documents it rejects
    (``worth``), of the good ones (``good``) and of the toxic ones (``toxic``) among them."""
    coalition = F.explode(F.sequence(F.lit(0), F.lit(_ALL))).alias("s")
    met = counts.select("*", coalition).withColumn(
        "hit", F.when(F.col("mask").bitwiseAND(F.col("s")) != 0, F.col("n")).otherwise(0)
    )
    per_part = met.groupBy("part", "s").agg(
        F.sum("n").alias("n"),
        F.sum("hit").alias("worth"),
        F.sum(F.when(F.col("good"), F.col("hit")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("hit")).otherwise(0)).alias("toxic"),
    )
    whole = per_part.groupBy("part").agg(
        F.array_sort(F.collect_list(F.struct("s", "n", "worth", "good", "toxic"))).alias("_c")
    )
    return whole.select(
        "part",
        F.get("_c", F.lit(0))["n"].alias("n"),
        *[F.col("_c").getField(name).alias(name) for name in ("worth", "good", "toxic")],
    )


def potentials(worth: Column) -> Column:
    """``_ORDERS`` times the potential of every coalition, indexed like ``worth``.

    A coalition's number is larger than those of its parts, so one pass over the numbers
    finds all that a step needs. P(S) times the factorial of |S| is whole, so all divisions
    are without rest.
    """

    def step(known: Column, s: Column) -> Column:
        without = F.lit(0).cast("long")
        for bit in range(len(FILTERS)):
            part = F.get(known, s - (1 << bit))
            without = without + F.when(s.bitwiseAND(F.lit(1 << bit)) != 0, part).otherwise(0)
        total = F.get(worth, s) * _ORDERS + without
        return F.concat(known, F.array((total / F.bit_count(s)).cast("long")))

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(_ALL)), F.array(F.lit(0).cast("long")), step
    )


def _places() -> Column:
    """Every order and place: the order, the step, its filter, the coalitions before and with it."""
    found = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            own = 1 << FILTERS.index(name)
            found.append(("".join(order), step, own, before))
            before |= own
    columns = list(zip(*found, strict=True))
    names = ("filter_order", "step", "own", "before")
    return F.explode(F.arrays_zip(*[F.lit(list(c)).alias(n) for c, n in zip(columns, names, strict=True)]))


def audit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    quality: str = "quality",
    toxic: str = "toxic",
) -> DataFrame:
    """One row per part, order of the five filters and step.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley (of the step's filter: the Shapley value times 120).

    Null texts and parts count as empty. E looks for equal texts in the whole table, by
    SHA-256 and length of the text; a null key is never a copy and has none. Rows equal in
    key and text are none of them copies of each other. A document is good (toxic) if any of
    its labels has quality = 1 (toxic = 1); labels of unknown or null keys count nowhere. An
    empty table gives no rows; further columns are ignored.
    """
    stash = Stash(docs.sparkSession, "filter-audit")
    body = F.coalesce(F.col(text), F.lit(""))
    # every text is read once; from here on a row is its key, part, digest and mask
    narrow = stash.put(
        docs.select(
            F.col(key).alias("_id"),
            F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
            F.concat(F.unhex(F.sha2(body, 256)), F.unhex(F.hex(F.octet_length(body)))).alias("_digest"),
            failures(body).alias("mask"),
        ),
        "masks",
    )
    marks = (
        labels.select(F.col(key).alias("_id"), F.col(quality) == 1, F.col(toxic) == 1)
        .toDF("_id", "good", "toxic")
        .filter(F.col("_id").isNotNull())
        .groupBy("_id")
        .agg(F.bool_or("good").alias("good"), F.bool_or("toxic").alias("toxic"))
    )
    no = F.lit(False)
    marked = narrow.join(marks, "_id", "left").withColumns(
        {"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)}
    )
    game = worths(_of_equal_texts(marked))
    solved = stash.put(game.withColumn("_p", potentials(F.col("worth"))), "game")
    rows = solved.select("*", _places().alias("_place")).select("*", "_place.*").drop("_place")
    own, before = F.col("own"), F.col("before")

    def gain(name: str) -> Column:
        return F.get(name, before.bitwiseOR(own)) - F.get(name, before)

    worth = F.col("worth")
    alone = F.get(worth, own)
    return rows.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        (F.col("n") - F.get(worth, before.bitwiseOR(own))).alias("kept"),
        gain("worth").alias("removed"),
        (alone - gain("worth")).alias("redundant"),
        (F.get(worth, F.lit(_ALL)) - F.get(worth, F.lit(_ALL) - own)).alias("unique_fails"),
        gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"),
        (F.get("_p", F.lit(_ALL)) - F.get("_p", F.lit(_ALL) - own)).alias("shapley"),
    )
