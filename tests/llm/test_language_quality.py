"""Language filters and importance resampling: held-out accuracy, filters against plain sets, odd rows."""

import numpy as np
import pytest
from llm_samples import SF001
from pyspark.sql import functions as F

from verbena.llm.common import texts
from verbena.llm.langid import LanguageFilter, fit_language_filter, grams, predict_language
from verbena.llm.queries import is_target, q_langid
from verbena.llm.quality import best_cut, importance_resample, keep_quality, kth_largest


def test_held_out_accuracy(spark, documents):
    got = q_langid(spark, SF001).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 20
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(1)
    key = rng.integers(0, 1 << 32, 20_000).astype(np.uint64)
    lang = rng.integers(0, 70, len(key))  # more than one word of language bits
    f = LanguageFilter.build([f"l{i}" for i in range(70)], key, lang, 4)
    for i in (0, 63, 64, 69):
        n, hits = f.hits(key[lang == i], np.zeros((lang == i).sum(), dtype=np.int64), 1)
        assert hits[0, i] == n[0]
    other = rng.integers(1 << 33, 1 << 40, 50_000).astype(np.uint64)
    n, hits = f.hits(other, np.zeros(len(other), dtype=np.int64), 1)
    assert np.all(np.abs(hits[0] / n[0] - f.false_rate) < 0.002)


def test_grams_by_hand():
    import pyarrow as pa
    batch = pa.record_batch([pa.array(["Ab, c", None, "é"])], names=["t"])
    offsets, data = texts(batch, 0)
    key, row = grams(offsets, data, 0, 3, 3)
    assert [int(k).to_bytes(3, "big") for k in key] == [b" ab", b"ab ", b"b c", " é".encode()]
    assert row.tolist() == [0, 0, 0, 2]


def test_odd_rows_of_language_id(spark, documents, odd, none):
    model = fit_language_filter(documents)
    got = predict_language(odd, model).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    for k in (1, 2, 3):
        assert (by[k].lang_pred, by[k].score) == ("und", 0.0)
    assert by[4].lang_pred in model.languages
    nothing = fit_language_filter(none)
    assert {r.lang_pred for r in predict_language(odd, nothing).collect()} == {"und"}
    assert predict_language(none, model).collect() == []
    digits = spark.createDataFrame([(1, "123 !!"), (2, "字"), (3, "“”")], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in predict_language(digits, model).orderBy("doc_id").collect()] == [True, False, True]


def test_quality_separates_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = importance_resample(docs, labels, is_target())
    assert got.count() == docs.count()
    seen = got.join(labels, "doc_id").collect()
    assert np.mean([r.kept for r in seen if r.quality and not r.toxic]) > 0.97
    assert np.mean([r.kept for r in seen if not r.quality]) < 0.2
    assert got.where("kept").count() > 0.7 * got.count()  # unlabelled clean documents stay too


def test_quality_rejects_documents_with_offensive_words(spark):
    """Three of the words that only toxic documents have, spread over a long clean text, are enough."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    words = F.regexp_count("text", F.lit(r"(?i)\b(trash|pathetic|idiot|worthless|disgusting|stupid|clown|scum|loser|moron)\b"))
    got = importance_resample(docs, labels, is_target()).join(docs.select("doc_id", words.alias("words")), "doc_id")
    assert got.where("words > 2").agg(F.avg(F.col("kept").cast("int"))).first()[0] < 0.05
    clean = got.join(labels.where("quality = 1 and toxic = 0"), "doc_id")
    assert clean.agg(F.avg(F.col("kept").cast("int"))).first()[0] > 0.98


@pytest.mark.xfail(reason="open: toxic documents in other languages carry no word that clean ones lack", strict=False)
def test_quality_rejects_toxic_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    seen = importance_resample(docs, labels, is_target()).join(labels.where("toxic = 1"), "doc_id").collect()
    assert np.mean([r.kept for r in seen]) < 0.1


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(3)
    keys = [int(x) for x in rng.integers(0, 1 << 48, 500)] + [77] * 40
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    for k in (1, 7, 250, 500, 510, 540):
        assert kth_largest(df, k) == sorted(keys, reverse=True)[k - 1]


def test_k_and_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (7, 0, 0), (7, 1, 0), (None, 1, 0), (8, None, 1), (9, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    got = importance_resample(odd, labels, is_target()).collect()
    assert len(got) == odd.count()
    assert {r.log_weight for r in got if r.doc_id in (1, 2, 3)} == {0.0}
    assert len({(r.log_weight, r.kept) for r in got if r.doc_id == 5}) == 1
    three = importance_resample(odd.where("doc_id not in (5, 10)"), labels, is_target(), k=3).collect()
    assert sum(r.kept for r in three) == 3
    no_labels = importance_resample(odd, labels.limit(0), is_target()).collect()
    assert all(r.kept for r in no_labels)
    assert importance_resample(none, labels, is_target()).collect() == []
    kept = keep_quality(odd, labels, is_target())
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in got)


@pytest.mark.parametrize("w,g,cut", [([3, 2, 1, 0], [1, 1, 0, 0], 1.5), ([3, 2], [0, 0], np.inf), ([3, 2], [1, 1], 1.0),
                                     ([2, 2, 1], [1, 1, 0], 1.5)])
def test_best_cut(w, g, cut):
    assert best_cut(np.array(w, dtype=float), np.array(g, dtype=bool)) == cut


def test_sample_of_labels_is_bounded(spark):
    from verbena.llm.quality import labelled_sample
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    n = labelled_sample(labels, is_target(), fit_rows=1000).count()
    assert 850 < n < 1150


def test_signs_that_training_knows_are_no_letters(spark):
    """Dashes, quotes and full stops that are frequent in one language do not make a text of that language."""
    from verbena.llm.langid import fit_language_filter, predict_language
    train = [(i, "— he said — “well” … — “and so” 。。 — " * 20, "en") for i in range(20)] + [(100 + i, "und sie sagte nichts dazu " * 20, "de") for i in range(20)]
    model = fit_language_filter(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    odd = [(1, "————"), (2, "“” “” “”"), (3, "。。。 …"), (4, "😀 12"), (5, ""), (6, None), (7, "— “so” —"), (8, "é"), (9, "字"), (10, "\u0301\u2014")]
    got = {r.doc_id: r.lang_pred for r in predict_language(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()}
    assert {k for k, v in got.items() if v == "und"} == {1, 2, 3, 4, 5, 6, 10}
