"""Score arithmetic on logit / probability arrays (M6, M7, O2, A7 per row)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


#: Probabilities count as at least this in a loss (a zero would make it infinite).
LOSS_FLOOR = 1e-15


def softmax(logits: Column) -> Column:
    """M6: numerically stable softmax of an ``array<double>``; linear in its width
    (the maximum and the sum are repeated into arrays, not recomputed per element)."""
    x = F.transform(logits, lambda v: v.cast("double"))
    ex = F.zip_with(x, F.array_repeat(F.array_max(x), F.size(x)), lambda v, m: F.exp(v - m))
    total = F.aggregate(ex, F.lit(0.0), lambda acc, v: acc + v)
    return F.zip_with(ex, F.array_repeat(total, F.size(ex)), lambda v, t: v / t)


def argmax(p: Column) -> Column:
    """O2: 0-based index of the largest value; first index on ties."""
    return (F.array_position(p, F.array_max(p)) - F.lit(1)).cast("int")


def confidence(p: Column) -> Column:
    """M7: probability of the chosen class."""
    return F.array_max(p)


def vector_to_array(v: Column) -> Column:
    from pyspark.ml.functions import vector_to_array as _v2a
    return _v2a(v)


def row_log_loss(p: Column, actual: Column) -> Column:
    """-log p[actual] for one row (``actual`` 0-based); ``p`` counts as ``LOSS_FLOOR`` at
    least, and a label outside the array gives null (an unscorable row)."""
    q = F.get(p, actual.cast("int"))
    return F.when(q.isNotNull(), -F.log(F.greatest(q, F.lit(LOSS_FLOOR))))


def logit_log_loss(logits: Column, actual: Column) -> Column:
    """Cross entropy from logits, ``log(sum(exp(x))) - x[actual]``: finite for any finite logits."""
    x = F.transform(logits, lambda v: v.cast("double"))
    top = F.array_max(x)
    ex = F.zip_with(x, F.array_repeat(top, F.size(x)), lambda v, m: F.exp(v - m))
    return top + F.log(F.aggregate(ex, F.lit(0.0), lambda acc, v: acc + v)) - F.get(x, actual.cast("int"))
