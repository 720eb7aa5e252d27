"""Corpus pipeline: quality, near-duplicates, decontamination, personal data, packing.

``run(spark, sf_dir)`` applies ``STAGES`` to ``documents``; each stage gets the
written result of the one before and returns the columns of ``documents``
(the last: the packed pieces).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from verbena.llm.common import ROW, keep_ids, materialise, numbered, small_batches, table_of
from verbena.llm.decontaminate import drop_contaminated
from verbena.llm.near_dedup import near_duplicates
from verbena.llm.packing import pack_documents
from verbena.llm.quality import keep_quality
from verbena.llm.queries import SURROGATE_KEY, TOKENIZER, is_target
from verbena.llm.surrogates import replace_entities


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling keeps."""
    small_batches(spark)
    return keep_quality(docs, table_of(spark, sf_dir, "labels"), is_target())


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five words, similarity 0.8): the one with the smallest id.

    Rows without an id come last in a group; of rows that repeat id and text one stays.  Wordless texts are no
    copies, unless the id is repeated with them."""
    small_batches(spark)
    rows = numbered(docs)
    found = near_duplicates(rows, ROW).select(F.col("doc_id").alias("__vl_found"), "component_id", "n_shingles") \
        .join(rows.select(ROW, "doc_id", F.when(F.col("doc_id").isNotNull(), F.col("text")).alias("text")), F.col(ROW) == F.col("__vl_found"))
    wordless = F.col("n_shingles") == 0
    group = [F.when(~wordless | F.col("doc_id").isNull(), F.col("component_id")).alias("c"),
             F.when(wordless, F.col("doc_id")).alias("d"), F.when(wordless, F.col("text")).alias("t")]
    first = F.min(F.struct(F.isnull("doc_id").alias("nameless"), "doc_id", ROW))
    stay = materialise(found.groupBy(*group).agg(first.alias("x")).select(F.col(f"x.{ROW}").alias(ROW)), "stay")
    return keep_ids(rows, stay, ROW, "left_semi").drop(ROW)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, also of benchmark rows without an id."""
    passages = numbered(table_of(spark, sf_dir, "benchmark").select("text").distinct())
    return drop_contaminated(docs, passages, item_col=ROW)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and secrets replaced."""
    small_batches(spark)
    return replace_entities(docs, SURROGATE_KEY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences."""
    small_batches(spark)
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("surrogates", surrogates), ("packing", packing)]

#: The stages are learned models, hashes and tokenizers, which SQL cannot express; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table_of(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name}")
    return docs
