"""The filter audit, whitening and fingerprints against plain Python and numpy."""

import hashlib
import math
import re
from collections import Counter
from itertools import permutations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import filter_audit, fingerprints, queries, whitening

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")


# --- filter audit ---------------------------------------------------------------------------


def fails(name, row, rows):
    text = row[1] or ""
    words = WORD.findall(text)
    if name == "A":
        return len(words) < 200
    if name == "B":
        return 100 * len(set(words)) < 50 * len(words)
    if name == "C":
        return 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)
    if name == "D":
        return re.search(r"[#$%&*|]", text) is not None
    return any(r[0] is not None and row[0] is not None and r[0] < row[0] and (r[1] or "") == text for r in rows)


def plain_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], {n for n in "ABCDE" if fails(n, r, rows)}) for r in rows if (r[2] or "") == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [m for m in left if name in m[1]]
                before = set(order[: step - 1])
                left = [m for m in left if name not in m[1]]
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in f and bool(f & before) for _, f in mine),
                    sum(f == {name} for _, f in mine), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return out


def audited(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    found = {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in rows}
    assert len(found) == len(rows)
    return found


def test_audit_like_plain_python(spark):
    long = " ".join(f"w{i}" for i in range(220))
    rows = [
        (1, long, "en"), (2, long, "de"), (3, long, "en"), (4, "short", "en"), (5, "SHORT #", None), (6, None, ""),
        (7, "", "en"), (8, "same " * 300, "en"), (9, "same " * 300 + "%", "en"), (None, long, "en"), (None, "short", "de"),
        (10, long + " | ABCDEFGHIJKLMNOPQRSTUVWXYZ ABCDEFGHIJKLMNOPQRSTUVWXYZ", "de"), (4, "short", "en"), (11, "short", "en"),
        (12, "ÄÖ   #", "fr"), (13, "a\x0bb\x1cc", "fr"), (14, "X" * 50_000 + " y" * 100_000, "fr"),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (3, 1, 0), (4, 0, 1), (5, 1, None), (8, None, 1), (99, 1, 1), (None, 1, 1), (11, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("mask", F.lit("x")).withColumn("n", F.lit(1))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("lang", F.lit("zz"))
    assert audited(filter_audit.audit(docs, marks)) == plain_audit(rows, labels)
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    assert set(audited(filter_audit.audit(docs, marks.limit(0)))) == set(plain_audit(rows, labels))


def test_potential_gives_the_shapley_value(spark):
    """On a game with arbitrary worths, against the mean over all orders."""
    worth = [0, *np.random.default_rng(1).integers(-1000, 1000, 31).tolist()]
    row = spark.createDataFrame([(worth,)], "w array<long>").select(filter_audit.potentials(F.col("w")).alias("p")).first()
    for bit in range(5):
        total = 0
        for order in permutations(range(5)):
            before = sum(1 << b for b in order[: order.index(bit)])
            total += worth[before | 1 << bit] - worth[before]
        assert row.p[31] - row.p[31 - (1 << bit)] == total


# --- whitening ------------------------------------------------------------------------------


def test_components_like_numpy(spark):
    random = np.random.default_rng(5)
    vectors = random.standard_normal((400, 40)) @ np.diag(np.linspace(1, 3, 40)) + 2
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors.astype(np.float32))]
    rows += [(900, None), (901, [None] * 40), (902, [float("nan")] + [0.0] * 39), (903, [float("-inf")] + [0.0] * 39), (None, rows[0][1]), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n", F.lit("x")).withColumn("x", F.lit(1))
    found = whitening.whiten(df.repartition(5)).collect()
    used = [*rows[:400], rows[404], rows[405]]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in used])
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(found) == 8 * n and Counter(r.vec_id for r in found)[0] == 16 and Counter(r.vec_id for r in found)[None] == 8
    by_id = {r.vec_id: {} for r in found}
    for r in found:
        by_id[r.vec_id][r.component] = r
    for (key, _), row in zip(used, x, strict=True):
        for k, r in by_id[key].items():
            assert (r.n, r.deviation) == (n, int(((n * row - sums) ** 2).sum()))
            assert abs(abs(r.whitened) - abs((row - sums / n) @ axes[:, k - 1]) / math.sqrt(values[k - 1])) < 1e-9
            assert abs(r.explained - values[k - 1] / values.sum()) < 1e-12 and r.identity_error < 1e-9
    for k in range(1, 9):  # one sign for all rows
        signs = {np.sign(by_id[key][k].whitened * ((row - sums / n) @ axes[:, k - 1])) for (key, _), row in zip(used, x, strict=True)}
        assert signs <= {-1.0, 0.0} or signs <= {1.0, 0.0}


def test_whitening_of_odd_tables(spark):
    kind = "vec_id long, embedding array<double>"
    whiten = lambda rows: whitening.whiten(spark.createDataFrame(rows, kind)).collect()
    assert whiten([]) == [] and whiten([(1, None)]) == [] and whiten([(1, [])]) == []
    # one vector, and equal vectors: no variance, nothing to whiten
    for rows in ([(1, [1.0, 2.0, 3.0])], [(i, [1.0, 2.0, 3.0]) for i in range(4)]):
        found = whiten(rows)
        assert len(found) == 3 * len(rows)
        assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in found} == {(0, None, 0.0, None)}
    # less rank than components, ties of eigenvalues
    found = whiten([(i, [float(i % 2), float(i // 2 % 2), 0.5] + [0.0] * 20) for i in range(8)])
    assert len(found) == 64 and {r.whitened is None for r in found if r.component > 2} == {True}
    assert all(abs(r.identity_error) < 1e-9 for r in found) and abs(sum({r.component: r.explained for r in found}.values()) - 1) < 1e-12
    with pytest.raises(ValueError):
        whiten([(1, [1.0]), (2, [1.0, 2.0])])
    with pytest.raises(Exception, match="too large"):
        whiten([(1, [1e300]), (2, [1.0])])


@needs_tables
def test_whitening_query(spark):
    rows = queries.QUERIES["op11_whitening"](spark, FOLDER).collect()
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    assert len(rows) == 8 * len(table)
    x = np.array([[math.floor(1024 * c) + 100000 for c in r.embedding] for r in table])
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    where = {r.vec_id: i for i, r in enumerate(table)}
    for r in rows:
        k = -r.component
        assert abs(abs(r.whitened) - abs((x[where[r.vec_id]] - x.mean(0)) @ axes[:, k]) / math.sqrt(values[k])) < 1e-8


# --- fingerprints ---------------------------------------------------------------------------


def similarity(a, b):
    a, b = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    both = set(a) | set(b)
    return sum(min(a[t], b[t]) for t in both) / sum(max(a[t], b[t]) for t in both) if both else 1.0


def edited_texts(rows):
    """(key, text, edited, next) in descending order of distinct (key, text), one key per text."""
    turn = sorted({(k, t or "") for k, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for i, (key, text) in enumerate(turn):
        other, cut = turn[(i + 1) % len(turn)][1], len(text) // 3
        out[key] = (text, text[: len(text) - cut] + other[:cut], other)
    return out


def check_fingerprints(found, rows, samples):
    expected, errors, seen = edited_texts(rows), [], {}
    assert Counter(r.doc_id for r in found) == Counter(k for k, _ in rows)
    for r in found:
        text, edited, other = expected[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint
        assert seen.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        for estimate, truth in ((r.near_edited, similarity(text, edited)), (r.near_next, similarity(text, other))):
            assert (truth not in (0, 1)) or estimate == truth
            errors.append((estimate - truth) / math.sqrt(1 / samples))
    return np.array(errors)


@needs_tables
def test_fingerprints_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = queries.QUERIES["op13_fingerprints"](spark, FOLDER).collect()
    errors = check_fingerprints(found, [(d.doc_id, d.text) for d in docs], fingerprints.SAMPLES)
    # a share of n independent samples: standard deviation of at most half a unit, no bias
    assert abs(errors.mean()) < 0.06 and errors.std() < 0.55 and np.abs(errors).max() < 3


def test_fingerprints_of_odd_rows(spark):
    rows = [
        (1, "one two three four five six seven"), (2, None), (3, ""), (4, " \t\n"), (5, "x"), (6, "ä\U0001f600 ä\U0001f600 b c d e f"),
        (7, "one two three four five six seven"), (8, "w" * 30_000 + " v" * 30_000), (None, "no key"), (9, "a a a b"), (9, "a a a b"), (-5, "last one of all"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_id", F.lit(1)).withColumn("n_chars", F.lit("q"))
    found = fingerprints.fingerprints(df.repartition(4)).collect()
    check_fingerprints(found, rows, fingerprints.SAMPLES)
    empty = {r.doc_id for r in found if r.fingerprint == ""}
    assert empty == {2, 3, 4}
    assert fingerprints.fingerprints(df.limit(0)).count() == 0
    alone = fingerprints.fingerprints(df.filter("doc_id = 1")).collect()
    assert [r.near_next for r in alone] == [1.0]
    two = spark.createDataFrame([(1, "a b c"), (1, "d e f")], "doc_id long, text string")
    assert {r.near_next for r in fingerprints.fingerprints(two).collect()} == {0.0} and fingerprints.fingerprints(two).count() == 2


def test_weights_count(spark):
    """Counts matter: the estimate follows sum of min over sum of max, not the sets."""
    a, b = "x " * 30 + "y z", "x " * 10 + "y z"
    rows = []
    for i in range(150):
        rows.append((i, a.replace("x", f"x{i}").replace("y", f"y{i}").replace("z", f"z{i}")))
    terms = spark.createDataFrame([(i, w, a.split().count(w), b.split().count(w)) for i in range(150) for w in "xyz"], "i int, w string, p long, q long")
    found = fingerprints.samples_of(
        terms.select("i", F.xxhash64("w", "i").alias("term"), (F.col("p") + F.shiftleft("q", 32)).alias("counts")), ["i"], 40
    ).select(fingerprints.likeness(F.col("here"), F.col("there")).alias("l"))
    assert abs(found.agg(F.avg("l")).first()[0] - 12 / 32) < 0.03
