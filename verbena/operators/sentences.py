"""T12 explode_sentences: one row per sentence, parent columns kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import sentences


def explode_sentences(df: DataFrame, comment: str = "comment", sentence: str = "sentence",
                      index: str = "sentence_no") -> DataFrame:
    """Rows with no sentence vanish (as in the reference).  No shuffle."""
    return df.select("*", F.posexplode(sentences(F.col(comment))).alias(index, sentence))
