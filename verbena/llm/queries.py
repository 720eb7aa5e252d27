"""Registered queries of the training-data operators, and the pipeline's query."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .bm25 import top_k
from .clustering import cluster_vectors
from .common import table_of
from .decontaminate import contaminated
from .exact_dedup import exact_duplicates
from .hard_negatives import hard_negatives
from .langid import fit_language_filter, predict_language
from .near_dedup import near_duplicates
from .packing import pack_documents
from .quality import importance_resample
from .suffix_dedup import remove_repeats
from .suffix_tree_lm import score_texts
from .surrogates import replace_entities
from .sql import SQL  # noqa: F401  (registered beside QUERIES)
from .token_counts import token_counts

TOKENIZER = "word_bpe_49k.json"
#: Key of the surrogates in the registered queries; a user passes a secret of their own.
SURROGATE_KEY = b"verbena-surrogates"


def remainder(ident: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(ident).cast("string").cast("binary")) % n


def is_target() -> Column:
    return (F.col("quality") == 1) & (F.col("toxic") == 0)


def q_langid(spark: SparkSession, sf: str) -> DataFrame:
    docs = table_of(spark, sf, "documents")
    model = fit_language_filter(docs.where(remainder("doc_id", 5) != 0))
    pred = predict_language(docs, model)
    return pred.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def q_quality(spark, sf):
    return importance_resample(table_of(spark, sf, "documents"), table_of(spark, sf, "labels"), is_target())


def q_decontaminate(spark, sf):
    return contaminated(table_of(spark, sf, "documents"), table_of(spark, sf, "benchmark"))


def q_token_counts(spark, sf):
    return token_counts(table_of(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


def q_suffix_dedup(spark, sf):
    return remove_repeats(table_of(spark, sf, "documents"))


def q_bm25(spark, sf):
    docs = table_of(spark, sf, "documents")
    return top_k(docs, docs.where(F.col("doc_id") % 20 == 0))


def q_near_dedup(spark, sf):
    return near_duplicates(table_of(spark, sf, "documents"), width=4)


def q_suffix_tree(spark, sf):
    held = remainder("doc_id", 7) == 2
    return score_texts(table_of(spark, sf, "documents"), ~held,
                       extra={"held_out": F.coalesce(held, F.lit(False))})


def q_surrogates(spark, sf):
    return replace_entities(table_of(spark, sf, "documents").select("doc_id", "text"), SURROGATE_KEY,
                            count_col="n_entities")


def q_packing(spark, sf):
    return pack_documents(table_of(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


def q_clustering(spark, sf):
    start = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    return cluster_vectors(table_of(spark, sf, "embeddings"), start_order=start)


def q_exact_dedup(spark, sf):
    return exact_duplicates(table_of(spark, sf, "documents"))


def q_hard_negatives(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table_of(spark, sf, "embeddings").withColumn("label", label), F.col("id") % 100 == 0)


QUERIES = {
    "op1_language_filters": q_langid,
    "op2_importance_resampling": q_quality,
    "op3_simhash_decontamination": q_decontaminate,
    "op4_token_counts": q_token_counts,
    "op5_suffix_dedup": q_suffix_dedup,
    "op6_bm25_top_k": q_bm25,
    "op7_odd_sketch_dedup": q_near_dedup,
    "op8_suffix_tree_scores": q_suffix_tree,
    "op9_surrogates": q_surrogates,
    "op10_best_fit_packing": q_packing,
    "op11_centroid_clustering": q_clustering,
    "op12_exact_dedup": q_exact_dedup,
    "op13_hard_negatives": q_hard_negatives,
}
