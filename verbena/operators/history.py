"""Resume against a growing history (J1, J2) without shuffling it again.

Earlier output is kept as a table bucketed by its key (``path`` may lie on any
shared store; the definition is made anew in each session).  Every append adds
files of the same buckets, so the anti-join of a resume reads the history bucket
by bucket: only the new rows are shuffled, however long the history has grown.
Keys are compared as strings (D1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

KEY = "history_key"


def open_history(spark: SparkSession, name: str, path: str, buckets: int = 64) -> None:
    """Define the table ``name`` over ``path`` in this session (the same ``buckets`` as ever for one path)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({KEY} STRING) USING parquet "
              f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'")


def add_to_history(done: DataFrame, name: str, key: str) -> None:
    """Append the keys of finished rows (null keys are no work to resume); one file for each bucket of an append."""
    keys = done.select(F.col(key).cast("string").alias(KEY)).where(F.col(KEY).isNotNull()).distinct()
    n = int(next(r.data_type for r in done.sparkSession.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Num Buckets"))
    keys.repartition(n, KEY).write.insertInto(name)


def resume_from_history(todo: DataFrame, name: str, key: str) -> DataFrame:
    """Rows of ``todo`` whose key is not in the history; a null key stays."""
    return todo.withColumn("__vb_key", F.col(key).cast("string")).join(
        todo.sparkSession.table(name).select(F.col(KEY).alias("__vb_key")), "__vb_key", "left_anti").drop("__vb_key")
