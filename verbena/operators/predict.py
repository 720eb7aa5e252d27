"""Prediction shapes (M8-M10) from logits or probabilities.

Softmax, argmax (first index on ties) and confidence are array expressions,
so scoring a table is one projection: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import SENTIMENT_NAMES, TASK_NAMES, decode_label
from ..functions.scoring import argmax, confidence, softmax


def _probs(df: DataFrame, col: str, are_logits: bool) -> Column:
    c = F.transform(F.col(col), lambda v: v.cast("double"))
    return softmax(c) if are_logits else c


def predict_codes(df: DataFrame, id_col: str, sentiment: str, task: str,
                  logits: bool = True) -> DataFrame:
    """M9: ``id_text, sentiment 0-2, sentiment_confidence, task 1-9, task_confidence``."""
    tmp = df.select(F.col(id_col).cast("string").alias("id_text"),
                    _probs(df, sentiment, logits).alias("__vb_ps"),
                    _probs(df, task, logits).alias("__vb_pt"))
    return tmp.select(
        "id_text",
        argmax(F.col("__vb_ps")).alias("sentiment"),
        confidence(F.col("__vb_ps")).alias("sentiment_confidence"),
        (argmax(F.col("__vb_pt")) + F.lit(1)).alias("task"),
        confidence(F.col("__vb_pt")).alias("task_confidence"))


def predict_named(df: DataFrame, text: str, sentiment: str, task: str,
                  processed_text: str | None = None, logits: bool = True) -> DataFrame:
    """M8: ``text, [processed_text,] sentiment, sentiment_confidence, task, task_confidence``
    with class names; an unknown class gives ``Unknown``."""
    keep = [F.col(text).alias("text")] + (
        [F.col(processed_text).alias("processed_text")] if processed_text else [])
    tmp = df.select(*keep, _probs(df, sentiment, logits).alias("__vb_ps"),
                    _probs(df, task, logits).alias("__vb_pt"))
    names = ["text"] + (["processed_text"] if processed_text else [])
    return tmp.select(
        *names,
        decode_label(argmax(F.col("__vb_ps")), SENTIMENT_NAMES).alias("sentiment"),
        confidence(F.col("__vb_ps")).alias("sentiment_confidence"),
        decode_label(argmax(F.col("__vb_pt")) + F.lit(1), TASK_NAMES).alias("task"),
        confidence(F.col("__vb_pt")).alias("task_confidence"))


def predict_emotion(df: DataFrame, text: str, sentiment: str,
                    processed_text: str | None = None, logits: bool = True) -> DataFrame:
    """``text, [processed_text,] emotion, confidence`` (one head)."""
    keep = [F.col(text).alias("text")] + (
        [F.col(processed_text).alias("processed_text")] if processed_text else [])
    tmp = df.select(*keep, _probs(df, sentiment, logits).alias("__vb_ps"))
    names = ["text"] + (["processed_text"] if processed_text else [])
    return tmp.select(
        *names,
        decode_label(argmax(F.col("__vb_ps")), SENTIMENT_NAMES).alias("emotion"),
        confidence(F.col("__vb_ps")).alias("confidence"))
