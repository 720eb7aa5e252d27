"""X1 phrase model: the Spark re-aim of the reference's word segmentation.

Fit: unigram and bigram counts over whole texts (two partial aggregations),
score ``(n_ab - delta) / (n_a * n_b)`` (word2vec phrase score, Mikolov et al.
2013), keep bigrams with ``n_ab >= min_count`` and ``score > threshold``.
Apply: greedy left-to-right joining with ``_`` (``functions.phrases``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.phrases import greedy_join, next_tokens
from ..functions.text import tokens
from .grams import LOOKUP_BYTES, gram_counts, join_known, shuffles_removed, spaced
from .segment import _texts, _written, apart


def _bigrams(toks):
    pairs = F.zip_with(toks, next_tokens(toks), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.filter(pairs, lambda s: s["b"].isNotNull() & s["a"].isNotNull())


def phrase_scores(df: DataFrame, text: str, min_count: int = 5, delta: float = 5.0,
                  threshold: float = 0.0, written: bool = False) -> DataFrame:
    """``(a, b, n_ab, n_a, n_b, score)`` for bigrams passing both cuts.

    The texts are written once, or read as they are from a table (``written``); unigrams and bigrams are added up in the
    tasks before they are shuffled (``operators.grams``), and the counts are
    written once as tables for the joins.
    """
    texts = _texts(df, text, written)
    with shuffles_removed(df.sparkSession):
        uni = _written(gram_counts(texts, 1).select(F.col("phrase").alias("w"), "n"), "phrase-counts")
        common = uni.where(F.col("n") >= min_count).select("w")
        bi = _written(gram_counts(texts, 2, min_count, common).select(
            F.substring_index("phrase", " ", 1).alias("a"), F.substring_index("phrase", " ", -1).alias("b"), F.col("n").alias("n_ab")), "phrase-counts")
    ua = uni.select(F.col("w").alias("a"), F.col("n").alias("n_a"))
    ub = uni.select(F.col("w").alias("b"), F.col("n").alias("n_b"))
    scored = bi.join(ua, "a").join(ub, "b").withColumn(
        "score", (F.col("n_ab") - F.lit(delta)) / (F.col("n_a").cast("double") * F.col("n_b")))
    return scored.filter(F.col("score") > F.lit(threshold)).select(
        "a", "b", "n_ab", "n_a", "n_b", "score")


def apply_phrases(df: DataFrame, text: str, phrases: DataFrame, out: str = "phrased",
                  key: str | None = None, limit: int = LOOKUP_BYTES) -> DataFrame:
    """Join known phrases inside ``text`` into ``out``.

    A phrase table of up to ``limit`` bytes is held by every worker and each row
    is joined where it lies; a larger one goes over the rows in several passes.
    Rows whose ``key`` repeats or is null are always joined to it (all, with a
    ``limit`` of 0): every bigram position is exploded and looked up by a join,
    hit flags are put back in order per row and the greedy pass runs; without a
    key the rows are numbered for that in a table in the shared folder.  A null
    text stays null.
    """
    pair = F.concat_ws(" ", "a", "b")
    with shuffles_removed(df.sparkSession):
        known = _written(phrases.select(pair.alias("p"), F.lit(2).alias("n")).where(
            (F.size(tokens("p")) == 2) & (F.col("p") == spaced(F.col("p")))).distinct(), "phrases")
    once, more = (df, None) if key is None else apart(df, key)
    done = join_known(once, F.col(text).cast("string"), known, out, limit)
    if done is None:
        return _apply_by_join(df, text, phrases, out, key)
    return done if more is None else done.unionByName(_apply_by_join(more, text, phrases, out, key))


def _apply_by_join(df: DataFrame, text: str, phrases: DataFrame, out: str, key: str | None) -> DataFrame:
    if key is None:
        numbered = _written(df.withColumn("__vb_row", F.monotonically_increasing_id()), "phrases")
        return _apply_by_join(numbered, text, phrases, out, "__vb_row").drop("__vb_row")
    keyed = phrases.select(F.concat_ws(" ", "a", "b").alias("k"), F.lit(True).alias("v")).distinct()
    t = tokens(F.col(text))
    pos = df.select(F.col(key).alias("__vb_k"), F.posexplode(_bigrams(t)).alias("__vb_p", "bg"))
    pos = pos.select("__vb_k", "__vb_p", F.concat_ws(" ", "bg.a", "bg.b").alias("k"))
    hits = (pos.join(keyed, "k", "left")
            .groupBy("__vb_k").agg(F.array_sort(F.collect_list(
                F.struct("__vb_p", F.coalesce("v", F.lit(False)).alias("h")))).alias("__vb_h")))
    joined = df.join(hits, df[key] == hits["__vb_k"], "left")
    hit = F.concat(F.coalesce(F.transform("__vb_h", lambda s: s["h"]), F.array().cast("array<boolean>")),
                   F.array(F.lit(False)))
    return joined.withColumn(out, greedy_join(t, hit)).drop("__vb_k", "__vb_h")
