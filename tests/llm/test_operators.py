"""Operators on small tables: odd rows, planted cases, brute force."""

import itertools
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    exact_dedup,
    html_extract,
    kd_shards,
    near_dedup,
    piece_sampling,
    substring_dedup,
    token_coder,
    token_files,
    token_rollups,
    toxicity,
)
from tidemark.llm.stash import Stash

LONG = " ".join(f"w{i % 97}x{i}" for i in range(30_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tie long, size long, rep long, band string"
ODD = [
    (1, None, None, None, None, 0, 0, 0, "a"),
    (2, "", "en", "s", 0, 0, 0, 0, "a"),
    (3, " \n\t ", "en", "s", 4, 0, 0, 0, None),
    (4, "one two", "en", None, 7, 0, 0, 0, "a"),
    (4, "one two", "en", None, 7, 0, 0, 0, "a"),
    (5, "One two", None, "s", 7, 0, 0, 0, "a"),
    (None, "one two", "en", "s", 7, 0, 0, 0, "a"),
    (7, LONG, "en", "s", len(LONG), 0, 0, 0, "a"),
    (8, LONG + " end", "en", "s", len(LONG) + 4, 0, 0, 0, "a"),
    (9, "日本語 😀 ▁ it's <|endoftext|>\xa0x", "ja", "s", 1, 0, 0, 0, "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(rng, n, size=400):
    return " ".join(f"v{i}" for i in rng.integers(0, size, n))


def test_exact_groups(odd, empty):
    rows = exact_dedup.exact_groups(odd).collect()
    assert len(rows) == len(ODD) and exact_dedup.exact_groups(empty).count() == 0
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in rows if r.doc_id in (1, 2, 4, None)) == [
        (0, 4, 3, False), (1, 2, 2, False), (2, 2, 2, True), (4, 4, 3, True), (4, 4, 3, True),
    ]
    assert exact_dedup.drop_exact_copies(odd).columns == odd.columns


def brute_components(sets, percent=75):
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a] | sets[b])):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def shingles(text, n=5):
    found = text.split()
    return {tuple(found[i : i + n]) for i in range(max(len(found) - n + 1, 1))} if found else set()


@pytest.mark.parametrize("large", [3, 64])
def test_near_duplicates_of_families(spark, large):
    """Families of looser and looser copies, with many pairs around the limit."""
    rng, texts = np.random.default_rng(5), []
    for _ in range(4):
        base = words(rng, 150, 100_000).split()
        for edits in range(40):
            copy = list(base)
            for at in rng.integers(0, len(copy), edits % 9):
                copy[at] = f"e{rng.integers(1e9)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = brute_components({i: shingles(t) for i, t in enumerate(texts)})
    rows = near_dedup.near_duplicates(docs, large_group=large).collect()
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(shingles(t)) for i, t in enumerate(texts)}


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = near_dedup.near_duplicates(odd).collect()
    assert near_dedup.near_duplicates(empty).count() == 0 and len(rows) == len(ODD)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert found[1] == (0, 1, True) and found[2] == (0, 2, True) and found[3] == (0, 3, True)
    assert found[5] == (1, 4, False) and found[8][1] == 7 and found[None][1:] == (None, True)
    assert near_dedup.drop_near_duplicates(odd).columns == odd.columns


def test_sequential_test_keeps_likely_pairs():
    least = near_dedup.least_matches(75)
    assert all(0 < m < n * 0.75 for n, m in least.items())
    same = np.zeros((3, near_dedup.HASHES), np.uint32)
    other = same.copy()
    other[1, ::5] = 1
    other[2] = 1
    assert near_dedup.likely(same, other, 75).tolist() == [0, 1]


def brute_repeats(rows, n=20):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        found = text.split()
        gone = set()
        for i in range(len(found) - n + 1):
            window = tuple(found[i : i + n])
            if window in seen:
                gone |= set(range(i, i + n))
            seen.add(window)
        out[doc_id] = (len(found), len(gone), " ".join(w for i, w in enumerate(found) if i not in gone))
    return out


def test_repeats_over_many_chunks(spark):
    rng = np.random.default_rng(3)
    passage, rows = words(rng, 60, 10_000), []
    for i in range(60):
        text = words(rng, int(rng.integers(1, 200)), 10_000)
        if i % 3 == 0:
            text += " " + passage + " " + words(rng, 30, 10_000)
        if i % 20 == 0:
            text = " ".join([text, "loop"] + ["again and"] * 30)
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring_dedup.remove_repeats(docs, chunk_bytes=3000, slice_windows=500).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in found} == brute_repeats(rows)


def test_repeats_of_odd_rows(odd, empty):
    rows = substring_dedup.remove_repeats(odd).collect()
    assert substring_dedup.remove_repeats(empty).count() == 0 and len(rows) == len(ODD)
    found = {r.doc_id: (r.n_words, r.n_removed) for r in rows}
    assert found[1] == (0, 0) and found[None] == (2, 0) and found[7] == (30_000, 0) and found[8] == (30_001, 30_000)


def test_shards_keep_law_and_groups(spark, odd, empty):
    assert kd_shards.kd_shards(empty, shards=4).count() == 0
    assert {r.shard for r in kd_shards.kd_shards(odd, shards=1).collect()} == {0}
    assert kd_shards.kd_shards(odd, shards=3).count() == len(ODD)
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the same text")).otherwise(F.concat(F.lit("t"), F.col("id") % 3500)).alias("text"),
        F.lit("en").alias("lang"), F.concat(F.lit("s"), F.col("id") % 7).alias("source"),
    )
    rows = kd_shards.kd_shards(docs, target_bytes=9000).collect()
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    mean = sum(size.values()) / len(size)
    assert max(abs(s - mean) for s in size.values()) < 0.03 * mean
    small = Counter((r.text_crc32, r.shard) for r in rows if r.size < 8)
    assert len(small) == len({crc for crc, _ in small})


def brute_score(item, text):
    best, line = 0, [0] * (len(item) + 1)
    for word in text:
        new = [0]
        for j, other in enumerate(item, 1):
            new.append(max(0, line[j - 1] + (2 if word == other else -1), line[j] - 1, new[-1] - 1))
        line, best = new, max(best, *new)
    return best


def test_alignment_is_exact():
    rng = np.random.default_rng(2)
    items, texts = rng.integers(2, 8, (40, 12)), rng.integers(2, 8, (40, 30))
    score, _ = decontaminate.align(items.astype(np.uint64), texts.astype(np.uint64))
    assert score.tolist() == [brute_score(list(a), list(b)) for a, b in zip(items, texts, strict=True)]


def test_contaminated_finds_edited_copies(spark, odd, empty):
    rng = np.random.default_rng(9)
    items = [words(rng, 40, 5000) for _ in range(12)]
    rows = []
    for i in range(150):
        text = words(rng, 120, 5000)
        if i < 12:
            copy = items[i].upper().replace(" ", ", ").split(" ")
            for at in rng.integers(0, 40, i):
                copy[at] = "changed"
            text += " " + " ".join(copy) + " " + words(rng, 20, 5000)
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(items), (50, ""), (51, None), (52, "tiny")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, bench).collect()}
    low = lambda t: t.lower().replace(",", " ").split()
    expected = {
        (i, j): s for i, t in rows for j, item in enumerate(items) if (s := brute_score(low(item), low(t))) >= 40
    }
    assert found == expected and len(found) >= 11
    assert decontaminate.drop_contaminated(docs, bench).count() == 150 - len({d for d, _ in found})
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(odd, bench.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(odd, bench).count() == len(ODD)


def test_coder_round_trip():
    rng = np.random.default_rng(4)
    for ids in (
        np.zeros(0, np.int64), np.array([65535]), rng.integers(0, 65536, 5000), rng.zipf(1.3, 20_000) % 50_000,
        np.tile([1, 2, 3, 50_000], 3000),
    ):
        blocks, sizes = token_coder.encode_ids(ids, block_ids=700)
        back = token_coder.decode_ids(blocks, sizes)
        assert np.array_equal(np.concatenate([np.zeros(0, np.int64), *back]), ids)
        if len(blocks) > 2:
            assert np.array_equal(token_coder.decode_ids(blocks[1:2], sizes[1:2])[0], ids[700:1400])
    assert sum(map(len, token_coder.encode_ids(np.tile([1, 2, 3, 50_000], 3000))[0])) < 600


def test_words_encode_like_the_library():
    encoder = token_files.WordwiseEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(8)
    letters = list("ab Zé9 1.,!  \n\n\t-_\xa0ß½²ªÖ$' ") + ["\r\n", "日"]
    texts = ["", *("".join(rng.choice(letters, int(n))) for n in rng.integers(1, 60, 600))]
    flat, counts = encoder.encode(texts)
    again = np.split(flat, np.cumsum(counts)[:-1])
    for text, found, wanted in zip(texts, again, encoder.whole(texts), strict=True):
        assert found.tolist() == wanted.tolist(), text


def test_new_words_go_to_the_library_together(monkeypatch):
    encoder = token_files.WordwiseEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    whole, calls = encoder.whole, []
    monkeypatch.setattr(encoder, "whole", lambda texts: calls.extend(texts) or whole(texts))
    texts = [" ".join(f"{a}{b} {a}{i}\n{b}{a}?" for b in "abcdefghijklm") for i, a in enumerate("nopqrstuvwxyzé")]
    flat, counts = encoder.encode(texts)
    assert len(encoder.known) > 300 and len(calls) < 20
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [x.tolist() for x in whole(texts)]
    calls.clear()
    again, _ = encoder.encode(texts[::-1])
    assert not calls and sorted(again.tolist()) == sorted(flat.tolist())


def test_blocks_of_any_ids_come_back():
    rng = np.random.default_rng(3)
    for ids in (
        np.arange(65_535, 65_535 - 2 * 4096, -1), np.repeat([7, 0, 65_535], 3000), np.zeros(4097, np.int64), np.array([5]),
        rng.zipf(1.3, 20_000) % 65_536, np.concatenate([rng.permutation(300) for _ in range(40)]),
    ):
        blocks, sizes = token_coder.encode_ids(ids)
        order = rng.permutation(len(blocks))
        back = token_coder.decode_ids([blocks[i] for i in order], [sizes[i] for i in order])
        assert np.array_equal(np.concatenate([back[i] for i in np.argsort(order)]), ids)
    assert token_coder.decode_ids([], []) == []
    with pytest.raises(ValueError, match="a block of 5000"):
        token_coder.encode_ids(np.arange(3), block_ids=5000)


def test_token_files_of_odd_rows(spark, odd, empty):
    root, path = Stash(spark, "files").root, public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(odd, f"{root}/odd", path)
    rows = sorted(token_files.read_tokens(spark, f"{root}/odd").collect(), key=lambda r: r.start)
    assert len(rows) == len(ODD) and rows[0].doc_id is None and rows[0].start == 0
    assert [a.start + a.n_tokens for a in rows[:-1]] == [b.start for b in rows[1:]]
    token_files.write_tokens(empty, f"{root}/empty", path)
    assert token_files.read_tokens(spark, f"{root}/empty").count() == 0


def test_pieces_of_odd_rows(odd, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    one = piece_sampling.sample_pieces(odd, path).collect()
    two = piece_sampling.sample_pieces(odd.repartition(5), path, seed=0).collect()
    assert all(r.lossless for r in one) and piece_sampling.sample_pieces(empty, path).count() == 0
    assert sorted(map(str, one)) == sorted(map(str, two))
    assert {r.doc_id: r.n_pieces for r in one}[1] == 0
    plain = odd.select("doc_id", F.lit("there is another segmentation of this").alias("text")).filter("doc_id = 9")
    assert len({str(piece_sampling.sample_pieces(plain, path, seed=s).first().pieces) for s in range(5)}) > 1


def test_pieces_follow_the_lattice():
    """Shares of the segmentations of one word against all of them, enumerated."""
    model = piece_sampling.PieceModel(public_tokenizers.path("piece_bpe_32k.model"), 1.0)
    word = "▁there"
    codes = np.array([ord(c) for c in word], np.uint32)
    weight, ids = model.lattice(codes, np.arange(len(word), 0, -1))
    chance = {}
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(word)]
        steps = list(zip([0, *ends[:-1]], ends, strict=True))
        total = sum(weight[b - a - 1, a] for a, b in steps)
        if math.isfinite(total):
            chance[tuple(int(ids[b - a - 1, a]) for a, b in steps)] = math.exp(total)
    n, norm = 20_000, sum(chance.values())
    flat, counts = model.sample(["there"] * n, np.arange(n).astype(np.uint64) * np.uint64(7919))
    found = Counter(tuple(x.tolist()) for x in np.split(flat, np.cumsum(counts)[:-1]))
    assert set(found) <= set(chance)
    for way, p in chance.items():
        p /= norm
        assert abs(found[way] / n - p) < 5 * math.sqrt(p / n) + 1e-3


def test_rollup_is_idempotent(spark):
    rollup = token_rollups.Rollup(spark, Stash(spark, "rollup").root)
    assert rollup.totals().count() == 0
    schema = "source string, lang string, tokenizer string, n_tokens long"
    rows = spark.createDataFrame([("a", "en", "v1", 5), ("a", "en", "v1", 7), (None, "de", "v1", None)], schema)
    assert rollup.commit("1", token_rollups.deltas(rows, 1)) and not rollup.commit("1", token_rollups.deltas(rows, 1))
    rollup.commit("2", token_rollups.deltas(rows.limit(1), -1).union(token_rollups.deltas(rows.filter("n_tokens = 7"), 1)))
    rollup.commit("3", token_rollups.deltas(rows.filter("source IS NULL"), -1))
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v1", 2, 14)]


def test_chain_on_held_out_rows(spark):
    """About a tenth of the toxic labels of this table belong to texts without any toxic word."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.filter(F.xxhash64("doc_id") % 2 == 0)
    unseen = labels.join(seen, "doc_id", "left_anti")
    found = toxicity.score(docs.join(unseen, "doc_id", "left_semi"), toxicity.fit(docs, seen)).join(unseen, "doc_id")
    count = {(r.toxic, r.rejected): r["count"] for r in found.groupBy("toxic", "rejected").count().collect()}
    assert count[1, True] / (count[1, True] + count.get((1, False), 0)) > 0.85
    assert count.get((0, True), 0) / count[0, False] < 0.01


def test_chain_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1, 0), (7, 0, 1), (None, 1, 1), (8, None, 1)], "doc_id long, quality int, toxic int")
    models = toxicity.fit(odd, labels)
    rows = toxicity.score(odd, models).collect()
    assert len(rows) == len(ODD) and not any(r.rejected for r in rows if r.doc_id in (1, 2, 3))
    assert toxicity.score(empty, models).count() == 0
    assert toxicity.drop_toxic(odd, labels.limit(0)).columns == odd.columns


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
<header class="site-header">Top</header><nav><ul><li>Menu<li>More</ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div>
<article><h1>Head &amp; tail</h1><p>One  <b>bo</b>ld<br>line<p>Two &lt;x&gt; &#233;<script>var t="</p>";</script>
<aside>Side</aside><form><p>Mail</p></form><div class="comments"><p>Nice!</p></div></article>
<footer>&copy; foot</footer></body></html>"""


def test_page_text(spark):
    assert html_extract.extract(PAGE, set(), None) == "Head & tail One bold line Two <x> é"
    plain = [
        (i, f"http://h.example/{i}", f"<body><div class=top>Site of news</div><div class=c><p>Story {i} tells {i * i}.</p>"
         f"<p>More {i}</p></div><div class=low>All rights reserved</div>")
        for i in range(8)
    ]
    rows = [*plain, (20, "http://one.example/", PAGE), (21, None, None), (None, "http://h.example/x", ""), (23, "nonsense", "just < text")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()}
    assert found[3] == "Story 3 tells 9. More 3" and found[20].startswith("Head & tail")
    assert found[21] == "" and found[None] == "" and found[23] == "just < text"
    assert html_extract.extract_pages(pages.limit(0)).count() == 0
