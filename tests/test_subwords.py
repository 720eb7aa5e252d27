"""Sub-word frames and counts against the tokenizer library on whole texts."""

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paths import SF001
from verbena.operators.subwords import encode_subwords, subword_counts, subword_vocab

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "word " * 9000), (5, "x" * 4000), (6, "tab\tand\n\nnew  lines   end  "), (7, "naïve 字 ελ é　a b\x1cc!\x1d"),
       (8, "<|endoftext|> it's <|startoftext|>"), (9, " sep  x "), (9, "twice the id")]


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    return spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").unionByName(odd).withColumns(
        {c: F.lit("clash") for c in ("n", "unit", "piece_id", "input_ids")}).repartition(3).cache()


@pytest.mark.parametrize("name", FILES)
def test_frames(docs, name):
    t = library(name)
    got = encode_subwords(docs, "text", public_tokenizers.path(name), 64).collect()
    assert len(got) == 200 + len(ODD) and got[0].unit == "clash"
    for r in got:
        body = [i + 4 for i in t.encode(r.text or "", add_special_tokens=False).ids[:62]]
        assert r.input_ids == [0, *body, 2] + [1] * (62 - len(body))
        assert r.attention_mask == [1] * (len(body) + 2) + [0] * (62 - len(body))
        assert 3 not in r.input_ids


@pytest.mark.parametrize("name", FILES)
def test_counts_and_vocab(docs, name):
    t = library(name)
    want = Counter(i for r in docs.collect() for i in t.encode(r.text or "", add_special_tokens=False).ids)
    counts = subword_counts(docs, "text", public_tokenizers.path(name))
    vocab = subword_vocab(counts).collect()
    assert {r.piece_id: r.n for r in vocab} == want
    assert [r.piece_id for r in sorted(vocab, key=lambda r: r.token_id)] == sorted(want, key=lambda i: (-want[i], i))
    assert min(r.token_id for r in vocab) == 4


def test_dense_ids_and_round_trip(spark, docs):
    path, t = public_tokenizers.path(FILES[0]), library(FILES[0])
    some = docs.where("doc_id < 50")
    vocab = subword_vocab(subword_counts(some, "text", path)).cache()
    back = {r.token_id: r.piece_id for r in vocab.collect()}
    seen = 0
    for r in encode_subwords(some, "text", path, 4096, vocab).collect():
        n = sum(r.attention_mask)
        if n < 4096:
            assert t.decode([back[i] for i in r.input_ids[1: n - 1]], skip_special_tokens=False) == (r.text or "")
            seen += 1
    assert seen > 20
    other = spark.createDataFrame([("Ωmega ζζ never seen",)], "text string")
    assert 3 in encode_subwords(other, "text", path, 32, vocab).first().input_ids


def test_empty_table(docs):
    path = public_tokenizers.path(FILES[0])
    assert encode_subwords(docs.limit(0), "text", path).collect() == [] == subword_counts(docs.limit(0), "text", path).collect()
    with pytest.raises(ValueError):
        encode_subwords(docs, "text", path, 1)


def test_python_workers_get_small_batches(spark):
    """Sub-words and emoji names: a worker holds at most a thousand texts at once."""
    import public_tokenizers
    from verbena.operators.emoji_table import demojize_with_table
    from verbena.operators.subwords import encode_subwords
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    df = spark.createDataFrame([("a b",)], "text string")
    try:
        for run in (lambda: encode_subwords(df, "text", public_tokenizers.path("byte_bpe_50k.json")),
                    lambda: demojize_with_table(df, "text", spark.createDataFrame([("x", "y")], "emoji string, name string"))):
            spark.conf.set(key, "10000")
            assert run().count() == 1 and int(spark.conf.get(key)) <= 1000
    finally:
        spark.conf.set(key, was)
