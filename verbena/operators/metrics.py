"""Evaluation.

The data is read once: a single ``groupBy(head, actual, predicted).count()``
(partial aggregation, so the shuffle carries at most heads x classes^2 rows
per task).  Everything else - accuracy, per-class precision / recall / F1,
macro and weighted averages - is arithmetic on that tiny confusion table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.scoring import row_log_loss
from ..functions.labels import SENTIMENTS, TASKS


@dataclass(frozen=True)
class Head:
    name: str
    actual: str
    predicted: str
    domain: Sequence[int]
    prob: str | None = None   # optional probability array: adds the mean loss (A7)
    offset: int = 0           # class index = actual - offset (topic: 1)


SENTIMENT_HEAD = Head("sentiment", "label", "pred_label", SENTIMENTS)
TASK_HEAD = Head("task", "task", "pred_task", TASKS)


def confusion_long(df: DataFrame, heads: Sequence[Head], materialize: bool = True) -> DataFrame:
    """A2, dense long form ``(head, actual, predicted, n, loss_sum, loss_n)`` over each domain.

    The input is read once (one partial aggregation); the small result is
    materialized (``small_table``) because every metric reads it again.
    """
    def loss(h: Head):
        if not h.prob:
            return F.lit(None).cast("double")
        return row_log_loss(F.col(h.prob), F.col(h.actual).cast("int") - F.lit(h.offset))

    pairs = F.explode(F.array(*[
        F.struct(F.lit(h.name).alias("head"), F.col(h.actual).try_cast("int").alias("actual"),
                 F.col(h.predicted).try_cast("int").alias("predicted"), loss(h).alias("loss"))
        for h in heads]))
    counts = (df.select(pairs.alias("p")).select("p.*")
              .groupBy("head", "actual", "predicted")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("loss").alias("loss_sum"),
                   F.count("loss").alias("loss_n")))
    spark = df.sparkSession
    grid = spark.createDataFrame(
        [(h.name, a, p, 0, None, 0) for h in heads for a in h.domain for p in h.domain],
        "head string, actual int, predicted int, n long, loss_sum double, loss_n long")
    # codes outside the domain are kept (they count against accuracy)
    cm = (counts.unionByName(grid).groupBy("head", "actual", "predicted")
          .agg(F.sum("n").alias("n"), F.sum("loss_sum").alias("loss_sum"),
               F.sum("loss_n").alias("loss_n")))
    return small_table(cm) if materialize else cm


# Largest confusion table kept on the driver (one row per head, actual, predicted)
SMALL_TABLE_ROWS = 100_000


def small_table(df: DataFrame, limit: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Run ``df`` once and keep its (few) rows as a local table.

    Every metric is read from the confusion table several times (support,
    predictions, diagonal, averages); without this each read would scan and
    aggregate the input again.  The table has one row per (head, actual,
    predicted): bounded by the label domains, not by the data.  A table
    above ``limit`` rows (labels far outside the domains) is persisted
    instead of being brought to the driver.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df.persist()
    return df.sparkSession.createDataFrame(rows, df.schema)


def head_losses(cm: DataFrame) -> DataFrame:
    """A7 per head from the same pass: ``(head, loss)`` (null without probabilities)."""
    return cm.groupBy("head").agg((F.sum("loss_sum") / F.sum("loss_n")).alias("loss"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str,
                     domain: Sequence[int]) -> DataFrame:
    """A2 for one head, long form ``(actual, predicted, n)``."""
    return confusion_long(df, [Head("h", actual, predicted, domain)]).select(
        "actual", "predicted", "n")


def confusion_wide(cm_long: DataFrame, domain: Sequence[int]) -> DataFrame:
    """Rows = actual, one column per predicted class (``p0``, ``p1`` ...)."""
    return (cm_long.groupBy("actual").pivot("predicted", list(domain)).agg(F.sum("n"))
            .select("actual", *[F.coalesce(F.col(str(v)), F.lit(0)).alias(f"p{v}") for v in domain]))


def _safe_div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def per_class(cm: DataFrame) -> DataFrame:
    """``(head, cls, tp, support, predicted_n, precision, recall, f1)``; 0 on zero division."""
    tp = cm.filter(F.col("actual") == F.col("predicted")).select(
        "head", F.col("actual").alias("cls"), F.col("n").alias("tp"))
    sup = cm.groupBy("head", F.col("actual").alias("cls")).agg(F.sum("n").alias("support"))
    prd = cm.groupBy("head", F.col("predicted").alias("cls")).agg(F.sum("n").alias("predicted_n"))
    t = (sup.join(prd, ["head", "cls"], "full").join(tp, ["head", "cls"], "left")
         .na.fill(0, ["tp", "support", "predicted_n"]))
    p = _safe_div(F.col("tp"), F.col("predicted_n"))
    r = _safe_div(F.col("tp"), F.col("support"))
    t = t.withColumn("precision", p).withColumn("recall", r)
    return t.withColumn("f1", _safe_div(2 * F.col("precision") * F.col("recall"),
                                        F.col("precision") + F.col("recall")))


def weighted_metrics(cm: DataFrame) -> DataFrame:
    """A3-A5: ``(head, accuracy, precision, recall, f1, support)`` (weighted by support)."""
    pc = per_class(cm)
    total = F.sum("support")
    return pc.groupBy("head").agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("f1"),
        total.alias("support"))


def classification_report(cm: DataFrame) -> DataFrame:
    """Per-class rows, then ``accuracy``, ``macro avg``, ``weighted avg``.

    Classes are those seen as actual or as predicted; ``accuracy`` carries its value in ``f1`` like the usual text
    report, with null precision / recall.
    """
    pc = per_class(cm).filter((F.col("support") > 0) | (F.col("predicted_n") > 0))
    rows = pc.select("head", F.col("cls").cast("string").alias("row"), "precision", "recall",
                     "f1", "support")
    total = F.sum("support")
    acc = pc.groupBy("head").agg(
        F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"), (F.sum("tp") / total).alias("f1"),
        total.alias("support"))
    macro = pc.groupBy("head").agg(
        F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), total.alias("support"))
    weighted = weighted_metrics(cm).select(
        "head", F.lit("weighted avg").alias("row"), "precision", "recall", "f1", "support")
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def mean_loss(df: DataFrame, prob: str, actual: str, offset: int = 0) -> F.Column:
    """A7 expression: mean of ``-log p[actual - offset]`` over the scorable rows."""
    return F.avg(row_log_loss(F.col(prob), F.col(actual) - F.lit(offset)))


def unscorable(prob: str, actual: str, offset: int = 0) -> F.Column:
    """Rows that ``mean_loss`` leaves out: no label, no probabilities, or a label outside them."""
    return F.count_if(row_log_loss(F.col(prob), F.col(actual) - F.lit(offset)).isNull())


def dataset_counts(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows and distinct labels (the class count of a head), one pass."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct(F.col(label)).alias("n_classes"))


def joint_score(f1_a, f1_b):
    """The mean of the two weighted F1 scores (model selection)."""
    return (f1_a + f1_b) / 2.0


def evaluate(df: DataFrame, heads: Sequence[Head] = (SENTIMENT_HEAD, TASK_HEAD)) -> dict:
    """One pass over ``df``; returns small DataFrames keyed by name."""
    cm = confusion_long(df, heads)  # one pass over df, kept as a small local table
    summary = weighted_metrics(cm).join(head_losses(cm), "head", "left")
    return {
        "confusion": cm,
        "report": classification_report(cm),
        "summary": summary,
    }
