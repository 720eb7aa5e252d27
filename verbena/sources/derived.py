"""Engine tables derived from the driver's test tables (see FIXTURES.md §2-§3).

``documents`` plays the comment table, ``labels`` the labelled set,
``embeddings`` the model logits.  Every function is a plain projection or
join of those tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


#: Session setting: deal the rows of a table out over this many partitions after reading (unset: as read).
SPREAD = "spark.verbena.spread"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  A small file of long texts may be one split; a session that wants
    its rows spread says so with ``spark.verbena.spread`` (the rows are the same)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    spread = spark.conf.get(SPREAD, None)
    return df.repartition(int(spread)) if spread else df


def balance(df: DataFrame) -> DataFrame:
    """The same rows, dealt out over the session's cores if there are fewer splits than these."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def sentiment_of_labels() -> F.Column:
    return (F.when(F.col("toxic") == 1, F.lit(0)).when(F.col("quality") == 1, F.lit(2))
            .otherwise(F.lit(1))).cast("int")


def task_of_source() -> F.Column:
    return (F.substring(F.col("source"), 4, 1000).try_cast("int") % 9 + 1).cast("int")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment table ``(doc_id, id, comment, source)``: id is the doc id as text."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("doc_id").cast("string").alias("id"),
                    F.col("text").alias("comment"), "source")


def labelled_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` inner join ``labels``: ``(doc_id, id, comment, label, task)``."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id").select(
        "doc_id", F.col("doc_id").cast("string").alias("id"), F.col("text").alias("comment"),
        sentiment_of_labels().alias("label"), task_of_source().alias("task"))


def with_predictions(df: DataFrame) -> DataFrame:
    """Made-up predictions with known errors (every 5th sentiment, every 7th topic)."""
    return df.withColumns({
        "pred_label": ((F.col("label") + (F.col("doc_id") % 5 == 0).cast("int")) % 3).cast("int"),
        "pred_task": ((F.col("task") - 1 + (F.col("doc_id") % 7 == 0).cast("int")) % 9 + 1)
        .cast("int"),
    })


def with_emoji(df: DataFrame, text: str = "text") -> DataFrame:
    """Inject emoji: a grinning face at the end of every 4th text, a heart in front of the next."""
    k = F.col("doc_id") % 4
    return df.withColumn(text, F.when(k == 0, F.concat(F.col(text), F.lit(" \U0001F600")))
                         .when(k == 1, F.concat(F.lit("❤️"), F.col(text)))
                         .otherwise(F.col(text)))


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, sentiment_logits[3], task_logits[9], actual_label, actual_task)``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        "vec_id",
        F.slice("embedding", 1, 3).alias("sentiment_logits"),
        F.slice("embedding", 4, 9).alias("task_logits"),
        (F.col("label") % 3).cast("int").alias("actual_label"),
        (F.col("label") % 9 + 1).cast("int").alias("actual_task"))


def response_part(comment: F.Column, doc_id: F.Column) -> F.Column:
    """The made-up labeler's answer for one row (FIXTURES §3)."""
    s = F.regexp_replace(comment, r"[|()\n\r]", " ")
    lab = (doc_id % 3).cast("string")
    tsk = (doc_id % 9 + 1).cast("string")
    k = doc_id % 10
    return (F.when(k < 5, F.concat(s, F.lit("("), lab, F.lit("-"), tsk, F.lit(")")))
            .when(k == 5, s)
            .when(k == 6, F.lit(""))
            .when(k == 7, F.concat(s, F.lit("(2-1-3)")))
            .when(k == 8, F.concat(s, F.lit("(21)")))
            .otherwise(F.concat(s, F.lit("(7-12)"))))


def synthetic_responses(rows: DataFrame, comment: str = "comment",
                        doc_id: str = "doc_id") -> DataFrame:
    """``(batch_id, response)`` for ``batch_rows`` output: parts joined by ``|``;
    every 11th batch (``% 11 = 3``) has no answer, ``% 11 = 5`` one extra part."""
    parts = rows.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct(
        "pos", response_part(F.col(comment), F.col(doc_id)).alias("part")))).alias("ps"))
    joined = F.array_join(F.transform("ps", lambda p: p["part"]), "|")
    b = F.col("batch_id") % 11
    resp = (F.when(b == 3, F.lit(None).cast("string"))
            .when(b == 5, F.concat(joined, F.lit("|extra(1-1)")))
            .otherwise(joined))
    return parts.select("batch_id", resp.alias("response"))


def single_responses(sentences: DataFrame, sentence: str = "sentence",
                     doc_id: str = "doc_id", index: str = "sentence_no") -> DataFrame:
    """One made-up answer per sentence (parts by ``(doc_id + sentence_no) % 10``)."""
    key = F.col(doc_id) + F.col(index)
    return sentences.withColumn("response", F.when(key % 11 == 3, F.lit(None).cast("string"))
                                .otherwise(response_part(F.col(sentence), key)))
