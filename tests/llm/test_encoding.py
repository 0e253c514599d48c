from collections import Counter

import pytest

from marlstone.llm import encoding, queries

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "\r\n\t", "plain words", "<|endoftext|> is text", "naïve café 日本語 😀", "don't we'll I'M", "a" * 50_000, "1234567 89", "x ​ y z", "same", "same", "﻿", " the the the the"]


def _want(texts):
    tok = encoding.tokenizer("/opt/tokenizers/byte_bpe_50k.json")
    return [tok.encode(t, add_special_tokens=False).ids if t else [] for t in texts]


@pytest.mark.parametrize("size", [1, 3, 10_000])
def test_ids_equal_the_tokenizer_for_any_chunks(spark, monkeypatch, size):
    monkeypatch.setattr(encoding, "CHUNK_DOCS", size)
    df = spark.createDataFrame([(i % 12 if i else None, t, [i]) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids array<int>").repartition(3)
    got = encoding.encode_corpus(df)
    assert got.columns == ["doc_id", "ids"]
    want = Counter((i % 12 if i else None, tuple(x)) for i, x in enumerate(_want(TEXTS)))
    assert Counter((r.doc_id, tuple(r.ids)) for r in got.collect()) == want


def test_texts_that_end_a_chunk_by_length(spark, monkeypatch):
    monkeypatch.setattr(encoding, "CHUNK_CHARS", 5)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in encoding.encode_corpus(df).collect()}
    assert [got[i] for i in range(len(TEXTS))] == _want(TEXTS)


def test_every_run_joins_distinct_words(spark):
    plan = encoding.encode_corpus(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Generate posexplode" in plan and "Join" in plan


def test_no_rows_and_string_keys(spark):
    df = spark.createDataFrame([("k", "a b")], "name string, body string")
    assert [(r.name, len(r.ids)) for r in encoding.encode_corpus(df, "name", "body").collect()] == [("k", 2)]
    assert encoding.encode_corpus(df.limit(0), "name", "body").count() == 0


def test_every_document_comes_back(spark):
    rows = queries.QUERIES["p7_decoded"](spark, SF).collect()
    source = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(source) and {r.doc_id: r.text for r in rows} == source and all(r.same for r in rows)


def test_null_empty_and_unknown_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [31373, 995]), (None, [220])], "doc_id long, ids array<int>").repartition(1)
    assert {r.doc_id: r.text for r in encoding.decode_corpus(df).collect()} == {1: None, 2: "", 3: "hello world", None: " "}
    for bad in ([10**8], [-1], [None], [50256]):
        with pytest.raises(Exception, match="unknown token id"):
            encoding.decode_corpus(spark.createDataFrame([(1, bad)], "doc_id long, ids array<int>")).collect()


def test_cut_characters_become_replacements(spark):
    ids = _want(["😀"])[0]
    got = encoding.decode_corpus(spark.createDataFrame([(1, ids), (2, ids[:1])], "doc_id long, ids array<int>")).collect()
    assert {r.doc_id: r.text for r in got} == {1: "😀", 2: "�"}
