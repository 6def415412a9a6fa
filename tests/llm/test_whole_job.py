"""Cases in which an operator once did less than its whole job."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import html_extract, piece_sampling, queries, token_files
from tidemark.llm.token_rollups import encoder


def test_added_tokens_as_in_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["see <|endoftext|> here", "plain words", "", "<|endoftext|>", "a<|endoftext|><|endoftext|>b", "<|endoftext|", "it's <|endoftext|>"]
    flat, counts = token_files.WordwiseEncoder(path).encode(texts)
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(e) for e in expected]
    assert flat.tolist() == [i for e in expected for i in e] and 50256 in expected[0]


def test_toxic_rows_are_deleted_after_their_revision(spark, tmp_path):
    texts = {1: "a  b\t\tc", 2: "d   e", 3: "f  g", 4: "h \n i", 5: "j  k"}
    documents = [(i, t, "s", "en" if i < 5 else "de") for i, t in texts.items()]
    spark.createDataFrame(documents, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(1, 0, 0), (2, 0, 1), (3, None, 1), (4, 1, 1), (5, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = queries.QUERIES["op8_token_rollups"](spark, str(tmp_path)).collect()
    encode = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken")).encode_ordinary
    assert [(r.source, r.lang, r.n_docs, r.n_tokens) for r in rows] == [("s", "en", 1, len(encode("a b c")))]


def test_slots_in_all_containers_are_kept(spark):
    rows = [
        (i, f"http://a.example/{i}", f"<body><div class=top>Site</div><div class=content><h1>Title {i}</h1><div class=text>"
         f"<p>Story {i} tells {i * i}.</p><p>More {i}</p></div></div><div class=second><p>Tail {i}</p></div><div class=low>Rights</div></body>")
        for i in range(6)
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()}
    assert found == {i: f"Title {i} Story {i} tells {i * i}. More {i} Tail {i}" for i in range(6)}


def test_template_is_made_of_ordered_nested_classes(spark):
    """A block on most pages is the site's only with an element of its class, in one place."""

    def page(i):
        share = "<p class=tip>Tell your friends</p>"
        note = "<div class=extra>Holiday hours</div>" if i != 2 else ""
        common = "<p>Many wrote to us.</p>" if i not in (0, 4) else ""
        return (
            f"<body><article><h1>Title {i}</h1><p>Story {i} tells {i * i} things.</p>{share}</article></body>" if i >= 10 else
            f"<body><div class=top>Site</div>{note}<div class=text><h1>Title {i}</h1><p>Story {i}.</p>{common}"
            f"{'<p>Moved</p><p>End</p>' if i % 2 else '<p>End</p><p>Moved</p>'}</div></body>"
        )

    rows = [(i, f"http://{'b' if i >= 10 else 'a'}.example/{i}", page(i)) for i in (*range(6), *range(10, 15))]
    copies = [(i, f"http://c.example/{i}", "<body><article><h1>One</h1><p>Same story.</p></article></body>") for i in range(20, 24)]
    pages = spark.createDataFrame([*rows, *copies], "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()}
    assert found[1] == "Title 1 Story 1. Many wrote to us. Moved End"  # no element comes as often; two change places
    assert found[2] == "Title 2 Story 2. Many wrote to us. End Moved" and found[4] == "Title 4 Story 4. End Moved"
    assert {found[i] for i in range(10, 15)} == {f"Title {i} Story {i} tells {i * i} things." for i in range(10, 15)}
    assert {found[i] for i in range(20, 24)} == {"One Same story."}


def test_piece_query_returns_the_sampled_pieces(spark, tmp_path):
    texts = {1: "some words, some more words", 2: "", 3: "日本 x"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    model = piece_sampling.piece_model(public_tokenizers.path("piece_bpe_32k.model"))
    rows = queries.QUERIES["op7_piece_sampling"](spark, str(tmp_path)).collect()
    assert len(rows) == 3
    for r in rows:
        ids = np.array(r.pieces, dtype="<i4")
        assert r.n_pieces == len(ids) and r.pieces_crc32 == zlib.crc32(ids.tobytes())
        assert model.decode(ids.astype(np.int64), np.array([len(ids)])) == [texts[r.doc_id].encode()]


def test_wide_ids_are_no_silent_loss():
    import pytest

    from tidemark.llm.token_coder import decode_ids, encode_ids

    ids = np.array([0, 65535, 7])
    assert decode_ids(*encode_ids(ids))[0].tolist() == ids.tolist()
    for wrong in (65536, 70000, -1):
        with pytest.raises(ValueError):
            encode_ids(np.array([1, wrong]))


def test_near_misses_in_a_bucket_come_to_few_links(spark, monkeypatch):
    """300 texts that share buckets but, most of them, no link: brute force, and rows in proportion."""
    from tidemark.llm import near_dedup

    random = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(300):
        words = list(base)
        for at in random.choice(200, 5, replace=False):
            words[at] = f"x{i}_{at}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(196)} for t in texts]
    group = list(range(300))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(300):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    links = []
    within = near_dedup._within_buckets

    def counted(*args):
        found = within(*args)
        links.append(found.count())
        return found

    monkeypatch.setattr(near_dedup, "_within_buckets", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert found == {i: find(i) for i in range(300)}
    assert links[0] <= 300 * near_dedup.BANDS


def test_token_ids_are_held_in_four_bytes():
    import public_tokenizers

    from tidemark.llm.token_files import wordwise_encoder

    encoder = wordwise_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    ids, counts = encoder.encode(["Plain words, twice: plain words.", "", "日本 it's odd"])
    assert ids.dtype.itemsize == 4 and counts[1] == 0
    whole = [encoder.library.encode(t, add_special_tokens=False).ids for t in ("Plain words, twice: plain words.", "日本 it's odd")]
    assert ids.tolist() == whole[0] + whole[1]
