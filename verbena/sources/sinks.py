"""Sinks (K1-K3).  Writers append or overwrite whole datasets, never rewrite a file row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_labelled(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """K1: labelled rows; CSV gets a header row."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def write_metrics(summary: DataFrame, path: str) -> None:
    """K2: the metric summary (a handful of rows) as JSON lines, one file."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def write_report(report: DataFrame, path: str, fmt: str = "csv") -> None:
    """K3: class reports as CSV (header) or parquet."""
    w = report.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
