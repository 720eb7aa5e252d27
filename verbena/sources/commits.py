"""An append that a retry cannot double (U2, K1): staged files and one commit per batch.

``append_once(df, path, batch)`` writes the rows to a folder of this attempt and
then commits: a small file named after the batch, moved into place with a rename
that fails where the file exists, names the attempt that counts.  An attempt that
fails before the commit leaves files that no reader looks at; a retry of a batch
that is committed writes nothing; of two concurrent attempts one commits.
``read_committed`` reads the committed folders only.

Layout: ``path/data/<batch>-<attempt>/*.parquet`` and ``path/_commits/<batch>``.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_BATCH = re.compile(r"[A-Za-z0-9][A-Za-z0-9.=-]*\Z")


def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()


def exists(spark: SparkSession, path: str) -> bool:
    fs, conf = _hadoop(spark)
    p = fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def _put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole or not at all; False where it exists already."""
    from py4j.protocol import Py4JJavaError
    fs, conf = _hadoop(spark)
    target = fs.Path(path)
    draft = fs.Path(f"{target.getParent()}/.{target.getName()}.{uuid.uuid4().hex}")
    system = target.getFileSystem(conf)
    out = system.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    context = fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else system.getUri(), conf)
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.NONE  # never overwrite
    try:
        context.rename(draft, target, options)
        return True
    except Py4JJavaError as e:
        system.delete(draft, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName() or system.exists(target):
            return False
        raise


def stage(df: DataFrame, path: str, batch: str) -> str:
    """Write an attempt's files; returns the attempt's name, which ``commit`` makes count."""
    if not _BATCH.match(batch):
        raise ValueError("a batch name has letters, digits, '.', '=' and '-' only")
    attempt = f"{batch}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path.rstrip('/')}/data/{attempt}")
    return attempt


def commit(spark: SparkSession, path: str, batch: str, attempt: str) -> bool:
    return _put_new(spark, f"{path.rstrip('/')}/_commits/{batch}", attempt)


def append_once(df: DataFrame, path: str, batch: str) -> bool:
    """Append ``df`` as ``batch``; False (and nothing written) where that batch is committed already."""
    spark = df.sparkSession
    if exists(spark, f"{path.rstrip('/')}/_commits/{batch}"):
        return False
    return commit(spark, path, batch, stage(df, path, batch))


def committed(spark: SparkSession, path: str) -> dict[str, str]:
    """Batch name to attempt, in order of name (one entry a batch)."""
    root = f"{path.rstrip('/')}/_commits"
    if not exists(spark, root):
        return {}
    rows = spark.read.text(root, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("batch"), "value")
    return {r.batch: r.value for r in rows.orderBy("batch").collect()}


def read_committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all committed batches; empty before the first."""
    folders = [f"{path.rstrip('/')}/data/{attempt}" for attempt in committed(spark, path).values()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
