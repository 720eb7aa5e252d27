"""P1 validate_domain and P4 empty-input guard."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import SENTIMENTS, TASKS


class InvalidLabels(ValueError):
    pass


def _bad_label(label: str) -> F.Column:
    return ~F.coalesce(F.col(label).cast("string").isin([str(v) for v in SENTIMENTS]), F.lit(False))


def _bad_task(task: str) -> F.Column:
    return ~F.coalesce(F.col(task).cast("string").isin([str(v) for v in TASKS]), F.lit(False))


def domain_report(df: DataFrame, label: str = "label", task: str | None = "task") -> DataFrame:
    """One-pass report: rows, bad sentiment codes, bad topic codes (one row)."""
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_if(_bad_label(label)).alias("bad_label")]
    if task:
        aggs.append(F.count_if(_bad_task(task)).alias("bad_task"))
    else:
        aggs.append(F.lit(0).cast("long").alias("bad_task"))
    return df.agg(*aggs)


def validate_domain(df: DataFrame, label: str = "label", task: str | None = "task",
                    mode: str = "fail") -> DataFrame:
    """Sentiment in 0..2, topic in 1..9.

    ``mode='fail'`` (the reference): one bad row rejects the whole set; the
    check is one aggregate pass, and the labels come back as ints.
    ``mode='quarantine'``: keep good rows only (see ``quarantined`` for the rest).
    """
    bad = _bad_label(label) | (_bad_task(task) if task else F.lit(False))
    if mode == "quarantine":
        out = df.filter(~bad)
    elif mode == "fail":
        r = domain_report(df, label, task).first()
        if r["bad_label"] or r["bad_task"]:
            raise InvalidLabels(
                f"{r['bad_label']} rows with sentiment outside 0..2, "
                f"{r['bad_task']} rows with topic outside 1..9")
        out = df
    else:
        raise ValueError("mode must be 'fail' or 'quarantine'")
    cols = {label: F.col(label).cast("string").cast("int")}
    if task:
        cols[task] = F.col(task).cast("string").cast("int")
    return out.withColumns(cols)


def quarantined(df: DataFrame, label: str = "label", task: str | None = "task") -> DataFrame:
    bad = _bad_label(label) | (_bad_task(task) if task else F.lit(False))
    return df.filter(bad)


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Stop early on an empty input (one row is read, not the table)."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")
    return df
