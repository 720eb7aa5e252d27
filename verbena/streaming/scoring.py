"""ST3 + M5: a fitted model on a stream of texts; new versions are taken up between micro-batches.

Models lie under ``root/version=N`` as M5 saves them; ``publish`` makes a version
count by a file written after the model, so a half-saved model is never loaded.
Every micro-batch takes the newest published version, notes it for its epoch
(a replay after a failure uses the same version) and writes its rows, with the
version, to its own folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.commits import _put_new, committed, exists


def publish(model: PipelineModel, root: str, version: int) -> None:
    """Save a model as ``version`` and make it count; a published version never changes."""
    from ..plans.training import save_model
    spark = SparkSession.active()
    root = root.rstrip("/")
    if exists(spark, f"{root}/_commits/{version}"):
        raise ValueError(f"version {version} is published already")
    save_model(model, f"{root}/version={version}")
    _put_new(spark, f"{root}/_commits/{version}", str(version))


def newest(spark: SparkSession, root: str) -> int:
    versions = [int(v) for v in committed(spark, root)]
    if not versions:
        raise ValueError(f"no model is published under {root}")
    return max(versions)


def score_texts(stream: DataFrame, root: str, score: Callable[[PipelineModel, DataFrame], DataFrame], output: str, checkpoint: str,
                trigger: dict | None = None):
    """Start the stream: ``score(model, rows)`` on every micro-batch, appended with ``model_version``.

    The model is loaded when its version is first used and kept by the driver
    until a newer one is.
    """
    from ..plans.training import load_model
    target, held = output.rstrip("/"), {}

    def write(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        noted = f"{target}/_versions/_commits/{epoch}"
        if not exists(spark, noted):
            _put_new(spark, noted, str(newest(spark, root)))
        version = int(spark.read.text(noted, wholetext=True).first()[0])
        if version not in held:
            held.clear()
            held[version] = load_model(f"{root.rstrip('/')}/version={version}")
        score(held[version], rows).withColumn("model_version", F.lit(version)).write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())
