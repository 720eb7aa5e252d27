"""Answers that never come (ST1, R7): two live streams and an event-time deadline.

``label_with_timeout`` joins the stream of asked batches to the stream of
answers (stream-stream left outer join over event time).  A batch that is
answered before its deadline is labelled by its first answer taken; when the
watermark passes the deadline of a batch without an answer, its rows get their
own comment and the default labels, as the batch job gives them.  Spark keeps
one state row for each open batch and each answer whose deadline may still come,
nothing for closed ones.

Rules: an answer counts if ``asked_at <= answered_at <= asked_at + timeout``;
null answers are failures and count as none; further answers to a batch are
ignored; ``late_answers`` lists the answers that took no effect because the
deadline had closed the batch, also those that Spark drops below the watermark.
Input order inside ``delay`` does not matter.  The watermark is the older of
the two streams' latest times, less ``delay``: a stream that rests holds it, so
the asking job sends a ``heartbeat`` to both.  A heartbeat is a batch of one null
item and its empty answer: Spark moves filters below the watermark, so rows that
a filter drops would not move it.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.responses import apply_labels, label_of, split_response

ANSWERS = "batch_id long, response string, answered_at timestamp"
BATCHES = "batch_id long, asked_at timestamp, items array<struct<pos:int,doc_id:long,id:string,comment:string>>"

#: Batch id of rows that only move the watermark.
HEARTBEAT = -1


def _labelled(batches: DataFrame) -> DataFrame:
    """One labelled row for each item of each ``(batch_id, asked_at, items, response)``."""
    # split in a select of its own: beside the explode Spark would split the whole answer again for each of its items
    split = batches.select("batch_id", "asked_at", F.col("response").isNotNull().alias("answered"),
                           split_response(F.col("response")).alias("__vb_parts"), "items")
    rows = split.select("batch_id", "asked_at", "answered", "__vb_parts", F.explode("items").alias("__vb_item"))
    rows = rows.where(F.col("__vb_item").isNotNull()).select("batch_id", "asked_at", "answered", "__vb_parts", "__vb_item.*")
    part = F.get(F.col("__vb_parts"), F.col("pos").cast("int"))
    return apply_labels(rows.withColumn("__vb_lab", label_of(part, F.col("comment"))).drop("__vb_parts"), "__vb_lab")


def _deadline(timeout: str):
    return F.col("asked_at") + F.expr(f"INTERVAL {timeout}")


def label_with_timeout(batches: DataFrame, answers: DataFrame, timeout: str, delay: str) -> DataFrame:
    """The stream of labelled rows of two streams (schemas ``BATCHES`` and ``ANSWERS``).

    ``timeout`` and ``delay`` are intervals (``"30 minutes"``).  ``answered``
    says whether an answer or the deadline closed the row's batch.
    """
    asked = batches.withWatermark("asked_at", delay)
    got = answers.withWatermark("answered_at", delay).where(F.col("response").isNotNull()) \
        .select(F.col("batch_id").alias("__vb_of"), "response", "answered_at")
    in_time = (F.col("batch_id") == F.col("__vb_of")) & (F.col("answered_at") >= F.col("asked_at")) \
        & (F.col("answered_at") <= _deadline(timeout))
    closed = asked.join(got, in_time, "leftOuter").select("batch_id", "asked_at", "items", "response")
    # keyed by the event time too: the state of a batch goes when its deadline has passed, not before
    return _labelled(closed.dropDuplicates(["batch_id", "asked_at"]))


def label_in_time(batches: DataFrame, answers: DataFrame, timeout: str) -> DataFrame:
    """The batch twin: the same rows from two tables, the earliest answer in time of each batch counting."""
    got = answers.where(F.col("response").isNotNull()).select(F.col("batch_id").alias("__vb_of"), "response", "answered_at")
    in_time = (F.col("batch_id") == F.col("__vb_of")) & (F.col("answered_at") >= F.col("asked_at")) \
        & (F.col("answered_at") <= _deadline(timeout))
    first = batches.select("batch_id", "asked_at").join(got, in_time).groupBy("batch_id").agg(
        F.min_by("response", F.struct("answered_at", "response")).alias("response"))
    return _labelled(batches.join(first, "batch_id", "left"))


def start_labelling(batches: DataFrame, answers: DataFrame, output: str, checkpoint: str, timeout: str,
                    delay: str, trigger: dict | None = None):
    """Start the stream; every micro-batch writes its own ``epoch=N`` folder of ``output`` (replays overwrite it)."""
    target = output.rstrip("/")

    def write(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    return (label_with_timeout(batches, answers, timeout, delay).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def late_answers(answers: DataFrame, labelled: DataFrame) -> DataFrame:
    """Non-null answers to batches that the deadline closed: ``(batch_id, response, answered_at)``.

    ``labelled`` is the stream's output; ``answers`` the table behind the
    answer stream.
    """
    closed = labelled.where(~F.col("answered")).select("batch_id").distinct()
    return answers.where(F.col("response").isNotNull()).join(closed, "batch_id", "left_semi") \
        .select("batch_id", "response", "answered_at")


def heartbeat(spark: SparkSession, batches: str, answers: str, at: str) -> None:
    """Add a row to the folders of both streams that only moves the watermark, to ``at`` (UTC) less the delay."""
    time = F.to_timestamp(F.lit(at))
    item = spark.createDataFrame([], BATCHES).schema["items"].dataType
    spark.range(1).select(F.lit(HEARTBEAT).cast("long").alias("batch_id"), time.alias("asked_at"),
                          F.array(F.lit(None)).cast(item).alias("items")).write.mode("append").parquet(batches)
    spark.range(1).select(F.lit(HEARTBEAT).cast("long").alias("batch_id"), F.lit("").alias("response"),
                          time.alias("answered_at")).write.mode("append").parquet(answers)


@contextmanager
def _small_state(spark: SparkSession):
    """Inside, a stream that starts packs its state closer (its files hold the texts that wait)."""
    key = "spark.sql.streaming.stateStore.compression.codec"
    before = spark.conf.get(key)
    spark.conf.set(key, "zstd")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _delete(spark: SparkSession, *folders: str) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def label_with_timeout_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelling job over the driver's tables as two streams, in two sittings on one checkpoint.

    Stand-in input: batches asked one a second; the made-up answers come within
    five minutes, one batch in eleven is never answered, one in eleven is
    answered late (delivered in the second sitting), and some are answered twice.
    """
    from ..llm.common import discard, shuffles_removed
    from ..queries import _batched
    from ..session import shared_dir
    from ..sources.derived import synthetic_responses

    base = shared_dir(spark, "label-timeout")
    rows, batches = _batched(spark, sf_dir, ("doc_id", "id", "comment"))
    start = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    asked_at = F.timestamp_add("SECOND", F.col("batch_id").cast("int"), start)
    asked = batches.select("batch_id", asked_at.alias("asked_at"), "items")
    late = F.col("batch_id") % 11 == 7
    wait = F.when(late, 45).otherwise(F.col("batch_id") % 5).cast("int")
    twice = F.col("batch_id") % 13 == 0
    half = rows.agg(F.max("batch_id")).first()[0]
    half = -1 if half is None else half // 2

    def answers(rows: DataFrame) -> DataFrame:
        one = synthetic_responses(rows).select("batch_id", "response", F.timestamp_add("MINUTE", wait, asked_at).alias("answered_at"))
        first = F.struct("response", "answered_at")
        again = F.struct(F.lit("again(0-1)").alias("response"), F.timestamp_add("MINUTE", F.lit(50), F.col("answered_at")).alias("answered_at"))
        all_ = F.when(twice & F.col("response").isNotNull(), F.array(first, again)).otherwise(F.array(first))
        return one.select("batch_id", F.explode(all_).alias("a")).select("batch_id", "a.*")

    def sitting(some: DataFrame, answered: DataFrame, used_up: DataFrame | None = None) -> None:
        # straight to the streams' folders: texts lie on the disk once on either side, and go when both have taken them
        with shuffles_removed(spark):
            some.write.mode("append").parquet(f"{base}/in-batches", compression="zstd")
            answered.write.mode("append").parquet(f"{base}/in-answers", compression="zstd")
        if used_up is not None:
            discard(used_up)
        with _small_state(spark):
            start_labelling(spark.readStream.schema(BATCHES).parquet(f"{base}/in-batches"),
                            spark.readStream.schema(ANSWERS).parquet(f"{base}/in-answers"),
                            f"{base}/out", f"{base}/ckpt", "30 minutes", "1 hour", {"availableNow": True}).awaitTermination()
        _delete(spark, f"{base}/in-batches", f"{base}/in-answers")
        spark.sparkContext._jvm.System.gc()  # Spark removes the streams' shuffle files when the driver's garbage goes

    early = (F.col("batch_id") <= half) & ~late & (F.col("response").isNull() | (F.col("response") != "again(0-1)"))
    sitting(asked.where(F.col("batch_id") <= half), answers(rows.where((F.col("batch_id") <= half) & ~late)).where(early))
    heartbeat(spark, f"{base}/in-batches", f"{base}/in-answers", "2100-01-01 00:00:00")
    sitting(asked.where(F.col("batch_id") > half),
            answers(rows.where((F.col("batch_id") > half) | late | twice)).where(~F.coalesce(early, F.lit(False))), rows)
    _delete(spark, f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out")
