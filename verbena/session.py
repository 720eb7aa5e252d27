"""Session helpers.

The library never builds its own session in library code paths: every
operator takes a DataFrame.  These helpers exist for tests, ``bench.py`` and
small command-line uses, and for finding the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "verbena") -> SparkSession:
    """A local session tuned for tests and the bench (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.verbena.spread", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VERBENA_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session.  Where it is unset, a
    local session (one machine) gets a scratch folder; on a cluster, whose
    executors could not see it, that is an error.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="verbena-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    base = base.rstrip("/")
    # unique child per call: jobs never share or clear each other's folders
    leaf = f"{name}-{os.getpid()}-{next(_counter)}-{os.urandom(4).hex()}"
    return f"{base}/{leaf}"


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
