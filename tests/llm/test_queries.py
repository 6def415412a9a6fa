"""The registered text queries against SQL, and against plain Python where SQL has no words."""

import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.mark.parametrize("name", list(queries.SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = con.execute(queries.SQL[name])
    names = [d[0] for d in cursor.description]
    found = queries.QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(names)
    assert sorted(tuple(r[n] for n in names) for r in found.collect()) == sorted(cursor.fetchall())


def test_shards(spark, documents):
    rows = queries.QUERIES["op4_kd_shards"](spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == set(documents) and len(rows) == len(documents)
    totals = np.zeros(16)
    for r in rows:
        data = documents[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        totals[r.shard] += r.size
    for shard in range(16):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert totals.max() - totals.min() <= 2 * max(r.size for r in rows)


def test_token_files(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = {r.doc_id: r for r in queries.QUERIES["op6_token_files"](spark, FOLDER).collect()}
    at = 0
    for doc_id in sorted(documents):
        ids = np.array([*library.encode(documents[doc_id].text, add_special_tokens=False).ids, 0], dtype="<u4")
        r = rows.pop(doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not rows


def test_rollups(spark, documents):
    import tiktoken

    from tidemark.llm.token_rollups import encoder

    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    expected: dict = {}
    encode = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken")).encode_ordinary
    assert isinstance(encoder(public_tokenizers.path("byte_bpe_50k.tiktoken")), tiktoken.Encoding)
    for doc_id, d in documents.items():
        label, text = labels.get(doc_id), d.text
        if label and label.toxic == 1:
            continue
        if label and label.quality == 0:
            for white in "\t\n\x0b\x0c\r":
                text = text.replace(white, " ")
            while "  " in text:
                text = text.replace("  ", " ")
        group = expected.setdefault((d.source, d.lang), [0, 0])
        group[0] += 1
        group[1] += len(encode(text))
    rows = queries.QUERIES["op8_token_rollups"](spark, FOLDER).collect()
    assert {(r.source, r.lang): [r.n_docs, r.n_tokens] for r in rows} == expected


def test_pieces_are_lossless(spark, documents):
    rows = queries.QUERIES["op7_piece_sampling"](spark, FOLDER).collect()
    assert len(rows) == len(documents) and all(r.lossless for r in rows)


def test_pages(spark):
    """The generator puts the article into an article element: a plain pattern finds it too."""
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = queries.QUERIES["op10_html_extract"](spark, FOLDER).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.DOTALL).group(1)
        body = re.sub(r"</?b>", "", body)
        parts = [" ".join(html.unescape(p).split()) for p in re.split(r"<[^>]*>", body)]
        assert r.text == " ".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_pipeline(spark, documents):
    """Each stage against a plain version of its rule, or of what its rule must keep."""
    import corpus_pipeline
    from tidemark.llm.stash import Stash

    stash, docs = Stash(spark, "test-pipeline"), spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stash.put(stage(spark, docs, FOLDER), name)
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert name == "sentencepiece" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    last: dict = {}
    for doc_id in sorted(kept[0]):
        last[documents[doc_id].text] = doc_id
    assert kept[1] == set(last.values())
    assert kept[0] >= kept[1] >= kept[2] >= kept[3] == kept[4]
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    holding = {d for d in kept[2] if any(" ".join(i.split()) in " ".join(documents[d].text.split()) for i in items)}
    assert not holding & kept[3]
    assert {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()} == kept[4]
