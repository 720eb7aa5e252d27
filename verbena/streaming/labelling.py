"""Streaming (ST1-ST3).

``label_stream``: the labeler's answers arrive as files; each micro-batch is
joined to the (static, already written) table of rows waiting for labels,
parsed and aligned (R1-R8) and written to its own folder of the output
dataset (a replayed micro-batch overwrites its folder, so nothing is added
twice).  Offsets live in the checkpoint folder; rows labelled before the
stream existed are removed from the waiting table once (ST2, J1).

``score_stream``: a fitted ``PipelineModel`` (or any DataFrame function) on a
stream of texts, appended to a sink (ST3).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.responses import align_responses
from ..operators.resume import resume_by_id
from ..sources.comments import read_progress

RESPONSE_SCHEMA = "batch_id long, response string"


# batches per folder of the waiting-rows table (the unit of partition pruning)
BATCH_GROUP = 4096


def write_waiting_rows(rows: DataFrame, path: str, output: str | None = None,
                       key: str = "id", group: int = BATCH_GROUP) -> None:
    """Write the rows still to label, partitioned by ``batch_id div group``.

    Rows already in ``output`` are removed first (J1, once).  A micro-batch of
    answers then reads only the folders of its own batch ids.
    """
    r = pending_rows(rows, output, key) if output else rows
    (r.withColumn("batch_group", F.floor(F.col("batch_id") / F.lit(group)).cast("long"))
     .write.mode("overwrite").partitionBy("batch_group").parquet(path))


def label_stream(spark: SparkSession, responses_dir: str, rows: DataFrame | str, output: str,
                 checkpoint: str, trigger: dict | None = None,
                 output_columns: list[str] | None = None, group: int = BATCH_GROUP):
    """Start the labelling stream; returns the ``StreamingQuery``.

    ``rows``: the rows waiting for labels (``batch_id``, ``pos``, ``id``,
    ``comment``, ...).  Best given as the path of a table written by
    ``write_waiting_rows``: each micro-batch then reads only the
    ``batch_group`` folders between its smallest and largest batch id
    (partition pruning), instead of scanning every waiting row.  A DataFrame
    is joined to the stream as a static side (simple, but read whole for
    every micro-batch).  ``trigger`` defaults to every 10 seconds, the
    reference's flush interval; ``{"availableNow": True}`` drains and stops.
    Each micro-batch writes its own ``epoch=N`` folder in overwrite mode, so
    a replay after a failure replaces its rows instead of adding them.
    """
    answers = spark.readStream.schema(RESPONSE_SCHEMA).parquet(responses_dir)
    target = output.rstrip("/")

    def finish(df: DataFrame, epoch_id: int) -> None:
        if output_columns:
            df = df.select(*output_columns)
        df.write.mode("overwrite").parquet(f"{target}/epoch={epoch_id}")

    if isinstance(rows, str):
        rows_path = rows

        def write(batch: DataFrame, epoch_id: int) -> None:
            batch = batch.withColumn("batch_group", F.floor(F.col("batch_id") / F.lit(group)).cast("long"))
            batch = batch.persist()  # read twice: its range, then the join
            try:
                lo, hi = batch.agg(F.min("batch_group"), F.max("batch_group")).first()
                if lo is None:
                    return
                waiting = (batch.sparkSession.read.parquet(rows_path)
                           .filter(F.col("batch_group").between(lo, hi)))
                # only rows whose batch is answered in this micro-batch; the rest wait
                labelled = align_responses(waiting.drop("batch_group"), batch.drop("batch_group"),
                                           key="batch_id", answered_only=True)
                finish(labelled, epoch_id)
            finally:
                batch.unpersist()

        w = answers.writeStream.foreachBatch(write)
    else:
        labelled = align_responses(rows, answers, answered_only=True)
        w = labelled.writeStream.foreachBatch(finish)
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return w.start()


def pending_rows(rows: DataFrame, output: str, key: str = "id") -> DataFrame:
    """ST2 / J1: rows whose key is not in the output written so far."""
    done = read_progress(rows.sparkSession, output)
    return resume_by_id(rows, done.select(key), key) if key in done.columns else rows


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], output: str,
                 checkpoint: str, trigger: dict | None = None, fmt: str = "parquet"):
    """ST3: ``score`` (e.g. ``model.transform`` + a prediction shape) on every micro-batch."""
    w = (score(stream).writeStream.format(fmt).outputMode("append")
         .option("path", output).option("checkpointLocation", checkpoint))
    w = w.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return w.start()


def label_stream_from_tables(spark: SparkSession, sf_dir: str, drops: int = 3) -> DataFrame:
    """The batch labelling job run as a stream over the driver's tables.

    Rows to label are written once to the shared folder; the made-up answers
    (derived from ``documents``) are dropped into the answer folder in
    ``drops`` files, the stream drains them (``availableNow``) and the output
    is read back.  It must equal the batch result (``align_responses``).
    """
    from ..queries import _batched
    from ..session import shared_dir
    from ..sources.derived import synthetic_responses

    base = shared_dir(spark, "label-stream")
    rows, _ = _batched(spark, sf_dir)
    write_waiting_rows(rows, f"{base}/rows", f"{base}/out")
    answers = synthetic_responses(spark.read.parquet(f"{base}/rows"))
    for d in range(drops):
        (answers.filter(F.col("batch_id") % drops == d)
         .write.mode("append").parquet(f"{base}/answers"))
    cols = ["doc_id", "id", "comment", "label", "task", "batch_id"]
    q = label_stream(spark, f"{base}/answers", f"{base}/rows", f"{base}/out", f"{base}/ckpt",
                     {"availableNow": True}, output_columns=cols)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def score_stream_from_tables(spark: SparkSession, sf_dir: str, drops: int = 3) -> DataFrame:
    """ST3 over the driver's tables: logits rows arrive as files in ``drops``
    drops, each micro-batch is scored (codes shape, M9), the output is read back.
    It must equal the batch scoring of the same rows."""
    from ..operators.predict import predict_codes
    from ..session import shared_dir
    from ..sources.derived import logits

    base = shared_dir(spark, "score-stream")
    lg = logits(spark, sf_dir).select("vec_id", "sentiment_logits", "task_logits")
    for d in range(drops):
        lg.filter(F.col("vec_id") % drops == d).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(lg.schema).parquet(f"{base}/in")
    q = score_stream(stream, lambda df: predict_codes(df, "vec_id", "sentiment_logits", "task_logits"),
                     f"{base}/out", f"{base}/ckpt", {"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")
