"""Resume without redoing work (J1, J2) and append-only output."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def resume_by_id(todo: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``todo`` whose key is not in ``done``.

    Keys are compared as strings (D1: the reference compared cleaned string
    ids with numbers read back from its CSV, so it never skipped).  A left
    anti join: AQE turns it into a broadcast when ``done`` is small, and it
    stays a shuffle join when both sides are large.
    """
    done_keys = done.select(F.col(key).cast("string").alias("__vb_key")).distinct()
    return (todo.withColumn("__vb_key", F.col(key).cast("string"))
            .join(done_keys, "__vb_key", "left_anti").drop("__vb_key"))


def resume_by_sentence(todo: DataFrame, done: DataFrame, sentence: str = "sentence",
                       done_sentence: str = "source_sentence") -> DataFrame:
    """Sentences not labelled before.

    Compared with the **source** sentence kept in the output (D3: the
    reference compared with the corrected text, so corrected rows were redone).
    """
    done_keys = done.select(F.col(done_sentence).alias("__vb_s")).distinct()
    return (todo.withColumn("__vb_s", F.col(sentence))
            .join(done_keys, "__vb_s", "left_anti").drop("__vb_s"))


def append_results(new_rows: DataFrame, path: str, fmt: str = "parquet",
                   header: bool = True) -> None:
    """Earlier output stays, new rows are added (linear, never rewritten)."""
    w = new_rows.write.mode("append")
    if fmt == "csv":
        w.option("header", header).csv(path)
    else:
        w.format(fmt).save(path)
