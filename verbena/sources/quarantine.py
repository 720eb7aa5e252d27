"""Rejected rows as data (S1, S5-S7, P1): file, line, text and reason next to the good rows.

Every reader returns ``(good, rejected)``; ``rejected`` has ``REJECTED``'s
columns and goes to a quarantine table with ``write_quarantine``.  Nothing is
dropped: each input line or record is in exactly one of the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.labels import SENTIMENTS, TASKS
from ..operators.sizes import small_side
from ..session import shared_dir
from .abbreviations import parse_abbreviation_lines

REJECTED = "source_file string, line_no long, line string, reason string"
_CORRUPT = "__vb_corrupt"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(source_file, line_no, value)``: the lines of all text files under ``path``, numbered from 1 in each file.

    The generated ids grow along the splits of a file, so a first pass counts
    the lines of each file in each task and running sums of these counts (one
    row a split) turn an id into its line number: no file is read by one task
    alone, nothing is sorted but the counts.
    """
    lines = spark.read.text(path).select(F.input_file_name().alias("source_file"), "value", F.monotonically_increasing_id().alias("i"),
                                         F.spark_partition_id().alias("p"))
    counts = lines.groupBy("source_file", "p").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("first"))
    before = Window.partitionBy("source_file").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source_file", "p", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    out = shared_dir(spark, "line-starts")
    starts.write.parquet(out)
    starts = small_side(spark.read.schema(starts.schema).parquet(out))
    return lines.join(starts, ["source_file", "p"]).select(
        "source_file", (F.col("before") + F.col("i") - F.col("first") + 1).alias("line_no"), "value")


def read_abbreviation_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S7 over a file or a folder of files: ``key:value`` lines, and the others with ``no colon`` or ``several colons``."""
    lines = numbered_lines(spark, path)
    parsed = parse_abbreviation_lines(lines.withColumn("__vb_n", F.struct("line_no", "value")), "value", "__vb_n")
    good = parsed.where("ok").select("source_file", F.col("__vb_n.line_no").alias("line_no"), "abbr", "full")
    reason = F.when(F.col("has_colon"), "several colons").otherwise("no colon")
    rejected = parsed.where(~F.col("ok")).select("source_file", F.col("__vb_n.line_no").alias("line_no"),
                                                 F.col("__vb_n.value").alias("line"), reason.alias("reason"))
    return good, rejected


def read_comments_checked(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", label: str | None = None,
                          task: str | None = None, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 + P1 over CSV files (with a header unless told otherwise): rows that fit ``schema`` and the label domains, and the records that do not.

    A record with a missing, extra or unreadable cell has the reason
    ``malformed``; a readable one with a code outside its domain ``label`` or
    ``task`` (``line`` is then the row as JSON).  Cells hold no line breaks
    here (files are split); ``line_no`` of a record is null, Spark's CSV reader
    does not know it.
    """
    fields = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    raw = spark.read.option("header", header).option("sep", sep).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE") \
        .option("enforceSchema", True).option("columnNameOfCorruptRecord", _CORRUPT) \
        .schema(StructType([*fields, StructField(_CORRUPT, StringType())])).csv(path).withColumn("source_file", F.input_file_name())
    # written once: the reader would prune the cells that decide whether a record is malformed
    out = shared_dir(spark, "checked")
    raw.write.parquet(out)
    raw = spark.read.schema(raw.schema).parquet(out)

    def outside(name: str | None, domain) -> Column:
        return F.lit(False) if name is None else ~F.coalesce(F.col(name).cast("string").isin([str(v) for v in domain]), F.lit(False))

    reason = F.when(F.col(_CORRUPT).isNotNull(), "malformed").when(outside(label, SENTIMENTS), "label").when(outside(task, TASKS), "task")
    judged = raw.withColumn("reason", reason)
    good = judged.where(F.col("reason").isNull()).select(*[F.col(f"`{f.name}`") for f in fields])
    rejected = judged.where(F.col("reason").isNotNull()).select(
        "source_file", F.lit(None).cast("long").alias("line_no"),
        F.coalesce(F.col(_CORRUPT), F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in fields]))).alias("line"), "reason")
    return good, rejected


def write_quarantine(rejected: DataFrame, path: str) -> DataFrame:
    """Append the rejects to the quarantine table; returns their counts by file and reason."""
    rejected.write.mode("append").parquet(path)
    return rejected.sparkSession.read.schema(REJECTED).parquet(path).groupBy("source_file", "reason").agg(F.count(F.lit(1)).alias("n"))
