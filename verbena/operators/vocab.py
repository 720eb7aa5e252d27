"""E2 fit_vocab and E1 encode_fixed.

Token ids: 0 ``<s>``, 1 ``<pad>``, 2 ``</s>``, 3 ``<unk>``; corpus tokens from
4 on, most frequent first, ties by token.  Encoding: ``<s>``, the ids of the
first ``max_len - 2`` whitespace tokens, ``</s>``, then ``<pad>`` up to
``max_len``; the mask is 1 on real positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import tokens
from .index import row_index

# Special token ids
BOS, PAD, EOS, UNK = 0, 1, 2, 3
FIRST_ID = 4


def token_counts(df: DataFrame, text: str) -> DataFrame:
    """``(token, n)`` over whole texts; partial aggregation before the shuffle."""
    return (df.select(F.explode(tokens(F.col(text))).alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))


def fit_vocab(df: DataFrame, text: str, size: int | None = None,
              min_count: int = 1) -> DataFrame:
    """``(token, token_id, n)``.  ``size`` keeps the ``size`` most frequent tokens."""
    counts = token_counts(df, text).filter(F.col("n") >= min_count)
    order = [F.col("n").desc(), F.col("token").asc()]
    if size is not None:
        # top-k is the feature here: per-partition top-k, then one merge of k rows
        top = counts.orderBy(*order).limit(int(size))
        return top.select("token", (F.row_number().over(Window.orderBy(*order)) - 1 + FIRST_ID)
                          .cast("int").alias("token_id"), "n")
    ranked = row_index(counts, order, "__vb_i")
    return ranked.select("token", (F.col("__vb_i") + FIRST_ID).cast("int").alias("token_id"), "n")


def _frame(ids, max_len: int):
    body = F.slice(ids, 1, max_len - 2)
    n = F.size(body)
    input_ids = F.concat(F.array(F.lit(BOS)), body, F.array(F.lit(EOS)),
                         F.array_repeat(F.lit(PAD), F.lit(max_len - 2) - n))
    mask = F.concat(F.array_repeat(F.lit(1), n + 2), F.array_repeat(F.lit(0), F.lit(max_len - 2) - n))
    return input_ids, mask


def encode_fixed(df: DataFrame, text: str, vocab: DataFrame, max_len: int = 128,
                 key: str | None = None) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask`` (``array<int>`` of ``max_len``).

    The first ``max_len - 2`` tokens of each row are exploded (bounded per
    row), joined to the vocabulary (broadcast by AQE where it is small, whatever
    its size otherwise) and put back in order.  ``key`` is a unique row key;
    without one the rows are numbered in a table in the shared folder.  A null
    text is encoded like an empty one.
    """
    if max_len < 2:
        raise ValueError("max_len must be at least 2")
    if key is None:
        from ..session import shared_dir
        path = shared_dir(df.sparkSession, "encode")
        df.withColumn("__vb_row", F.monotonically_increasing_id()).write.parquet(path)
        return encode_fixed(df.sparkSession.read.parquet(path), text, vocab, max_len, "__vb_row").drop("__vb_row")
    toks = F.slice(tokens(F.col(text)), 1, max_len - 2)
    exploded = df.select(F.col(key).alias("__vb_k"), F.posexplode(toks).alias("__vb_p", "token"))
    looked = exploded.join(vocab.select("token", "token_id"), "token", "left")
    ids = (looked.groupBy("__vb_k").agg(F.array_sort(F.collect_list(F.struct(
        "__vb_p", F.coalesce("token_id", F.lit(UNK)).alias("id")))).alias("__vb_ids")))
    out = df.join(ids, df[key] == ids["__vb_k"], "left").drop("__vb_k")
    body = F.coalesce(F.transform("__vb_ids", lambda s: s["id"]), F.array().cast("array<int>"))
    input_ids, mask = _frame(body, max_len)
    return out.withColumns({"input_ids": input_ids, "attention_mask": mask}).drop("__vb_ids")
