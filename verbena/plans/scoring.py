"""M11 score_with: any user model over a table, in Arrow batches.

The model is built once per Python worker (``predict_batch_udf`` caches the
``make_predict_fn`` result) and called on numpy batches; Spark partitions the
table, so scoring scales with executors.  Output: class index + confidence.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType


def linear_scorer(width: int = 3) -> Callable:
    """A fixed linear model for tests: logits = x[:, 0:w] + x[:, w:2w], softmax."""
    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            x = x.astype(np.float64)
            logits = x[:, 0:width] + x[:, width:2 * width]
            z = np.exp(logits - logits.max(axis=1, keepdims=True))
            return z / z.sum(axis=1, keepdims=True)
        return predict
    return make


def score_with(df: DataFrame, features: str, make_predict_fn: Callable, n_classes: int,
               width: int | None = None, batch_size: int = 1024) -> DataFrame:
    """Add ``probabilities``, ``pred`` (argmax, first on ties) and ``confidence``.

    ``make_predict_fn()`` returns ``f(np.ndarray[n, width]) -> np.ndarray[n, n_classes]``.
    ``width`` is the feature length; when omitted it is read from one row.
    """
    try:
        from pyspark.ml.functions import predict_batch_udf
    except ImportError as e:  # pragma: no cover - needs pyspark.ml
        raise RuntimeError("pyspark.ml is required for score_with") from e
    if width is None:
        first = df.select(F.size(F.col(features))).first()
        width = int(first[0]) if first is not None else 1
    udf = predict_batch_udf(make_predict_fn, return_type=ArrayType(DoubleType()),
                            batch_size=batch_size, input_tensor_shapes=[[width]])
    from ..functions.scoring import argmax, confidence
    out = df.withColumn("probabilities", udf(F.col(features).cast("array<double>")))
    return out.withColumns({"pred": argmax(F.col("probabilities")),
                            "confidence": confidence(F.col("probabilities"))})
