"""Comment tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.index import row_index

COMMENT_SCHEMA = "id string, comment string, label string, task string"


def read_comments(spark: SparkSession, path: str, sep: str = ",",
                  schema: str | StructType | None = None, fmt: str = "csv",
                  multi_line: bool = True) -> DataFrame:
    """A delimited file with a header row (quoted, multi-line cells allowed).

    Without a schema every column is read as a string (no inference pass over
    the data); parquet / orc / json go through the generic reader.  A
    multi-line CSV file cannot be split, so each file is one task: for very
    large files whose cells hold no line breaks pass ``multi_line=False``
    (files are then split), or convert them to parquet once.
    """
    if fmt != "csv":
        r = spark.read.format(fmt)
        return (r.schema(schema) if schema is not None else r).load(path)
    r = (spark.read.option("header", True).option("sep", sep).option("multiLine", multi_line)
         .option("quote", '"').option("escape", '"').option("inferSchema", False))
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fail with the missing names."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def default_column(df: DataFrame, name: str = "task", value: str = "9") -> DataFrame:
    """S3: add ``name`` with a constant when it is absent."""
    return df if name in df.columns else df.withColumn(name, F.lit(value))


def with_read_order(df: DataFrame, name: str = "read_order") -> DataFrame:
    """A file-order key for tables that have none (W1 needs an explicit order).

    ``(input file, generated id)``: within one file the splits keep their
    offset order and the ids grow with it.  Call it directly on the read
    DataFrame, before any shuffle.
    """
    return df.withColumn(name, F.struct(F.input_file_name().alias("file"),
                                        F.monotonically_increasing_id().alias("pos")))


def skip_rows(df: DataFrame, start_row: int, order_by: Sequence,
              index_col: str | None = None) -> DataFrame:
    """Drop the first ``start_row`` rows in ``order_by`` order.

    As in the reference, ``start_row`` past the end is an error.  The row
    index is distributed (``row_index``), never one task.
    """
    if start_row <= 0:
        return df
    idx = index_col or "__vb_row"
    ranked = row_index(df, order_by, idx)
    if ranked.filter(F.col(idx) >= start_row).isEmpty():
        raise ValueError(f"start row {start_row} is not below the number of rows")
    out = ranked.filter(F.col(idx) >= start_row)
    return out if index_col else out.drop(idx)


def read_progress(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: str = COMMENT_SCHEMA) -> DataFrame:
    """Earlier output, or an empty frame ``id, comment, label, task``."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return spark.createDataFrame([], schema)
    if fmt == "csv":
        return read_comments(spark, path)
    return spark.read.format(fmt).load(path)
