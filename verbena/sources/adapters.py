"""Training sources (S8-S10) and their union.

Each adapter takes a user table and returns ``(*keep, text, label)`` with label an
int in 0..2 or null when the code is unknown (L1, D11).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import BINARY_TO_SENTIMENT, NEG_NEU_POS, recode_label


def adapter_a(df: DataFrame, text: str = "sentence", label: str = "sentiment",
              keep: list[str] = ()) -> DataFrame:
    """``sentence, sentiment`` (already 0..2)."""
    return df.select(*keep, F.col(text).cast("string").alias("text"),
                     recode_label(F.col(label), {"0": 0, "1": 1, "2": 2}).alias("label"))


def adapter_b(df: DataFrame, text: str = "comment", label: str = "label",
              keep: list[str] = ()) -> DataFrame:
    """``NEG``/``NEU``/``POS`` to 0/1/2.  For the test file pass ``text='content'``."""
    return df.select(*keep, F.col(text).cast("string").alias("text"),
                     recode_label(F.col(label), NEG_NEU_POS).alias("label"))


def adapter_c(df: DataFrame, text: str = "comment", label: str = "label",
              keep: list[str] = ()) -> DataFrame:
    """``0``/``1`` to 0/2."""
    return df.select(*keep, F.col(text).cast("string").alias("text"),
                     recode_label(F.col(label), {str(k): v for k, v in BINARY_TO_SENTIMENT.items()})
                     .alias("label"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows kept (``unionByName``, no shuffle)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
