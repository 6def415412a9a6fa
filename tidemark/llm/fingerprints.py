"""Document fingerprints by consistent weighted sampling: DataFrame functions only.

A text is the weighted set of its words, the weight being how often a word occurs. For each
of ``samples`` draws and each term the term and the number of the draw alone give
r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1). A term of weight w stands at the step
t = floor(ln w / r + b) and scores c exp(-r (t - b + 1)); the draw takes the term with the
least score. Two texts take the same (term, step) with a probability equal to their
generalised Jaccard similarity, sum of min(w) over sum of max(w). The score is a function of
(term, step) and of nothing else, so the least score itself names the sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.stash import Stash

SAMPLES = 40
_AT_ONCE = 2  # draws computed side by side in one row: more make a method too long for the JIT
_NO_ID = -(1 << 63)  # stands for a null key in joins
_KEY = ["_id", "_h"]


def _words(text: Column) -> Column:
    """Runs of characters other than space and 0x09-0x0D."""
    return F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")


def _tagged(words: Column, tag: int) -> Column:
    """Words as 62-bit hashes, the two low bits telling where the word stands."""
    return F.transform(words, lambda w: F.shiftleft(F.shiftrightunsigned(F.xxhash64(w), 2), 2).bitwiseOR(F.lit(tag)))


def weighted_terms(df: DataFrame, head: Column, tail: Column, other_tail: Column, name: str) -> DataFrame:
    """Adds ``name``: array of (term, here, there), the distinct words of two texts that begin alike.

    ``head`` holds the words of both texts, ``tail`` the other words of the first and
    ``other_tail`` those of the second; ``here`` and ``there`` are the counts in each. The
    occurrences are sorted within the row and its runs counted, so no shuffle is needed.
    """
    tagged = F.concat(_tagged(head, 0), _tagged(tail, 1), _tagged(other_tail, 2))
    df = df.withColumn("_codes", F.sort_array(tagged))

    def term(at: Column) -> Column:
        return F.shiftright(F.get("_codes", at), 2)

    last = F.filter(
        F.sequence(F.lit(1), F.size("_codes")), lambda i: (i == F.size("_codes")) | (term(i - 1) != term(i))
    )
    df = df.withColumn("_ends", F.when(F.size("_codes") > 0, last).otherwise(F.array().cast("array<int>")))
    # counts of both texts in one number: the first in the low half, the second in the high half
    both = 1 << 32
    weights = F.array(F.lit(both + 1), F.lit(1), F.lit(both))
    runs = F.zip_with(
        F.concat(F.array(F.lit(0)), F.slice("_ends", 1, F.greatest(F.size("_ends") - 1, F.lit(0)))),
        "_ends",
        lambda begin, end: F.when(
            end.isNotNull(),
            F.struct(
                term(begin).alias("term"),
                F.aggregate(
                    F.slice("_codes", begin + 1, end - begin),
                    F.lit(0).cast("long"),
                    lambda total, code: total + F.get(weights, code.bitwiseAND(F.lit(3)).cast("int")),
                ).alias("counts"),
            ),
        ),
    )
    return df.withColumn(name, F.when(F.size("_ends") > 0, runs)).drop("_codes", "_ends")


def _uniform(bits: Column, shift: int) -> Column:
    """A number between 0 and 1, ends excluded, of 24 bits of a hash."""
    return (F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << 24) - 1)) + F.lit(0.5)) * F.lit(1 / float(1 << 24))


def _gamma(u: Column) -> Column:
    """Gamma(2, 1) from the product of two uniform numbers; log1p costs half of ln in the JVM."""
    return -F.log1p(u - 1)


def samples_of(
    terms: DataFrame, keys: list[str], samples: int = SAMPLES, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Rows (term, counts) per ``keys`` to one row per ``keys`` with the samples of both texts.

    ``carried`` names further long columns, alike in all rows of a key, that pass to the
    result without widening the grouping key. ``here`` and ``there`` are arrays of ``samples`` 32-bit numbers, or null for a text
    without words. The aggregate keeps one minimum per draw, so a text's length costs
    no memory.
    """
    groups = -(-samples // _AT_ONCE)
    logs = terms.select(
        *keys,
        *carried,
        "term",
        F.ln(F.col("counts").bitwiseAND(F.lit((1 << 32) - 1))).alias("_lo"),
        F.ln(F.shiftright("counts", 32)).alias("_le"),
    )
    # ln 0 is null: a term that a text does not hold takes no part
    rows = logs.withColumn("_g", F.explode(F.array(*[F.lit(g) for g in range(groups)])))
    draws = range(_AT_ONCE)
    number = {j: F.col("_g") * _AT_ONCE + j for j in draws}
    rows = rows.withColumns({f"_a{j}": F.xxhash64("term", number[j]) for j in draws})
    rows = rows.withColumns({f"_b{j}": F.xxhash64(f"_a{j}") for j in draws})
    low = F.lit((1 << 16) - 1)

    def gamma(bits: str) -> Column:
        return _gamma(_uniform(F.col(bits), 40) * _uniform(F.col(bits), 16))

    rows = rows.withColumns(
        {f"_r{j}": gamma(f"_a{j}") for j in draws}
        | {f"_c{j}": gamma(f"_b{j}") for j in draws}
        | {
            f"_u{j}": (F.shiftleft(F.col(f"_a{j}").bitwiseAND(low), 16) + F.col(f"_b{j}").bitwiseAND(low))
            * F.lit(1 / float(1 << 32))
            for j in draws
        }
    )

    def score(log: str, j: int) -> Column:
        r, b = F.col(f"_r{j}"), F.col(f"_u{j}")
        return F.col(f"_c{j}") * F.exp(r * (b - F.floor(F.col(log) / r + b) - 1))

    def other(j: int) -> Column:
        """A term that both texts hold equally often has one score."""
        return F.when(F.col("_le") == F.col("_lo"), F.col(f"_s{j}")).otherwise(score("_le", j))

    rows = rows.withColumns({f"_s{j}": score("_lo", j) for j in draws})
    whole = [F.max(c).alias(c) for c in carried]
    least = rows.groupBy(*keys, "_g").agg(
        *whole,
        *[F.min(f"_s{j}").alias(f"_o{j}") for j in draws],
        *[F.min(other(j)).alias(f"_e{j}") for j in draws],
    )

    def numbers(side: str) -> Column:
        return F.array(*[F.shiftright(F.xxhash64(f"_{side}{j}"), 32).cast("int") for j in draws]).alias(side)

    def signature(side: str) -> Column:
        drawn = F.flatten(F.transform(F.array_sort("_parts"), lambda p: p[side]))
        return F.when(F.col(f"_some_{side}"), F.slice(drawn, 1, samples))

    with_sides = least.select(
        *keys, *carried, "_g", numbers("o"), numbers("e"),
        F.col("_o0").isNotNull().alias("_has_o"), F.col("_e0").isNotNull().alias("_has_e"),
    )
    parts = with_sides.groupBy(*keys).agg(
        *whole,
        F.collect_list(F.struct("_g", "o", "e")).alias("_parts"),
        F.bool_or("_has_o").alias("_some_o"), F.bool_or("_has_e").alias("_some_e"),
    )
    return parts.select(*keys, *carried, signature("o").alias("here"), signature("e").alias("there"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples. Two texts without words are alike, one without is like no other."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(
        same / F.size(a)
    )


def as_text(signature: Column) -> Column:
    """Eight hexadecimal digits per sample; empty for a text without words."""
    digits = F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit((1 << 32) - 1)))), 8, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def _shared_words(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """The words that text and edited text begin with, and the other words of each.

    A word that the cut runs through belongs to the tails.
    """
    cut = F.col("n_chars") - F.floor(F.col("n_chars") / 3)
    split = pairs.withColumns(
        {
            "_begin": F.substring("_text", F.lit(1), cut),
            "_rest": F.substring("_text", cut + 1, F.col("n_chars")),
        }
    ).withColumns(
        {
            "_words": _words(F.col("_begin")),
            "_open": ~F.right("_begin", F.lit(1)).rlike("[\\x20\\x09-\\x0D]") & (F.col("_begin") != ""),
            "_sha": F.sha2(F.concat("_begin", "_borrowed"), 256),
        }
    )
    part = F.when(F.col("_open"), F.element_at("_words", -1)).otherwise(F.lit(""))
    head = F.when(F.col("_open"), F.slice("_words", 1, F.size("_words") - 1)).otherwise(F.col("_words"))
    return split.select(
        *keep,
        head.alias("_head"),
        _words(F.concat(part, "_rest")).alias("_tail"),
        _words(F.concat(part, "_borrowed")).alias("_new_tail"),
    )


def _in_turn(narrow: DataFrame, stash: Stash) -> DataFrame:
    """Adds the key before and the key after each row of a table ordered by descending key.

    The rows are range-partitioned by key and stored with the number of their range; what
    crosses a border comes from one row per range. After the last row comes the first.
    """
    ranged = stash.put(
        narrow.repartitionByRange(*_KEY).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    row = F.struct(*_KEY, "n_chars").alias("_row")
    ends = ranged.groupBy("_range").agg(F.min(row).alias("_least"), F.max(row).alias("_most"))
    ends = stash.put(ends, "ends")
    total = ends.agg(F.min("_least").alias("least"), F.max("_most").alias("most")).first()
    if total["least"] is None:
        least = most = F.lit(None).cast(ranged.select(row).schema["_row"].dataType)
    else:
        kinds = ranged.select(row).schema["_row"].dataType
        least, most = (F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(kinds, total[side])]) for side in ("least", "most"))
    across = Window.orderBy("_range")  # at most one row per range
    borders = stash.put(
        ends.select(
            "_range",
            F.lag("_most").over(across).alias("_below"),
            F.lead("_least").over(across).alias("_above"),
        ),
        "borders",
    )
    inside = Window.partitionBy("_range").orderBy(*_KEY)
    near = ranged.withColumns({"_lag": F.lag(row).over(inside), "_lead": F.lead(row).over(inside)}).join(
        borders, "_range"
    )
    following = F.coalesce("_lag", "_below", most)
    before = F.coalesce("_lead", "_above", least)
    return near.select(
        *narrow.columns,
        following["_id"].alias("_next_id"), following["_h"].alias("_next_h"),
        before["_id"].alias("_prev_id"), before["_h"].alias("_prev_h"),
        F.floor(before["n_chars"] / 3).alias("_lent"),
    )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """One row per row of ``docs``: key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The edited text of a document is its own but for the last floor(n_chars / 3) code points,
    which give way to the first as many (or all) of the next document by descending key;
    after the last comes the first. ``near_edited`` and ``near_next`` are the shares of equal
    samples with the edited text and with the next document.

    A null text counts as empty; a text without words has an empty fingerprint. A null key
    comes last and stays null. Rows equal in key and text are one document, returned once
    per row; rows with one key and several texts are documents of their own, ordered by a
    hash of the text. An empty table gives no rows; further columns are ignored.

    The whole text crosses one shuffle, a third of it (the lent heads) a second.
    """
    stash = Stash(docs.sparkSession, "fingerprints")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), body.alias("_text")).withColumns(
        {"_id": F.coalesce(F.col("_key").cast("long"), F.lit(_NO_ID)), "_h": F.xxhash64("_text")}
    )
    narrow = rows.groupBy("_key", *_KEY, F.length("_text").cast("long").alias("n_chars")).agg(
        F.count("*").alias("_rows")
    )
    order = stash.put(_in_turn(narrow, stash), "order")
    placed = rows.drop("_key").dropDuplicates(_KEY).join(order, _KEY)
    lent = placed.select(
        F.col("_prev_id").alias("_id"),
        F.col("_prev_h").alias("_h"),
        F.substring("_text", F.lit(1), F.col("_lent")).alias("_borrowed"),
    )
    kind = docs.schema[key].dataType
    placed = placed.withColumn("_key", F.col("_key").cast("long"))
    carried = ["_key", "n_chars", "_rows", "_next_id", "_next_h"]
    pairs = _shared_words(placed.join(lent, _KEY), [*_KEY, *carried, "_sha"])
    # the digest as four numbers, so that the aggregates below need no text
    digits = {f"_sha{i}": F.conv(F.substring("_sha", 16 * i + 1, 16), 16, -10).cast("long") for i in range(4)}
    carried += digits
    runs = weighted_terms(
        pairs.withColumns(digits).drop("_sha"), F.col("_head"), F.col("_tail"), F.col("_new_tail"), "_terms"
    )
    terms = runs.select(*_KEY, *carried, F.explode_outer("_terms").alias("_t")).select(*_KEY, *carried, "_t.*")
    signed = stash.put(samples_of(terms, _KEY, samples, tuple(carried)), "signed")
    digest = F.lower(F.concat(*[F.lpad(F.hex(d), 16, "0") for d in digits]))
    following = signed.select(
        F.col("_id").alias("_next_id"), F.col("_h").alias("_next_h"), F.col("here").alias("_next")
    )
    found = signed.join(following, ["_next_id", "_next_h"]).select(
        F.col("_key").cast(kind).alias(key),
        "n_chars",
        digest.alias("edited_sha256"),
        as_text(F.col("here")).alias("fingerprint"),
        as_text(F.col("there")).alias("edited_fingerprint"),
        likeness(F.col("here"), F.col("there")).alias("near_edited"),
        likeness(F.col("here"), F.col("_next")).alias("near_next"),
        "_rows",
    )
    return found.withColumn("_rows", F.explode(F.sequence(F.lit(1), F.col("_rows")))).drop("_rows")
