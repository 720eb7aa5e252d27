"""Helpers shared by the operators of this subpackage.

Text work runs in ``mapInArrow`` tasks: a batch's UTF-8 bytes are viewed as
numpy arrays in chunks of about ``CHUNK_BYTES`` (a longer text is its own
chunk), so memory per task stays bounded however many rows a batch has.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..session import shared_dir

CHUNK_BYTES = 1 << 20
#: A table of at most this many rows of a few numbers may be broadcast (under 64 MB); beyond it joins shuffle.
BROADCAST_ROWS = 1_000_000

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def pick(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, so that other columns can never clash with an operator's own."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def id_field(docs: DataFrame, name: str = "doc_id") -> StructField:
    return StructField(name, docs.schema[name].dataType, True)


def materialise(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read it back:
    several consumers share one computation, and lost executors do not lose it.  ``options``: of the writer."""
    path = shared_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the table of a ``materialise``d frame; nothing that still has to be computed may read it."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Inside, Spark removes the shuffle files of a query when its result is written or fetched."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def sized(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are few enough, else as it is."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


#: Name of the key that ``numbered`` gives each row.
ROW = "__vl_row"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` written with a key of its own for each row: decisions about one row cannot reach another."""
    return materialise(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def keep_ids(docs: DataFrame, ids: DataFrame, id_col: str, how: str) -> DataFrame:
    """``docs`` with (``left_semi``) or without (``left_anti``) the ids of the materialised one-column ``ids``.

    Rows that share an id share its fate; a null id is never in ``ids``.
    """
    ids = ids.toDF("__vl_id")
    return docs.join(sized(ids), docs[id_col] == F.col("__vl_id"), how)


def texts(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, memoryview]:
    """Byte offsets (n + 1) and the bytes of a string column; null counts as empty."""
    arr = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset: arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    return offsets, memoryview(data) if data is not None else memoryview(b"")


def byte_rows(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    """Every text of the column as UTF-8 bytes; null counts as empty."""
    offsets, data = texts(batch, column)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield bytes(data[a:b])


def chunk_rows(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def joined(offsets: np.ndarray, data: memoryview, lo: int, hi: int, sep: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Rows lo..hi as one byte array with one ``sep`` byte before each row; and where each row starts."""
    off = offsets[lo: hi + 1].tolist()
    buf = sep + sep.join([data[a:b] for a, b in zip(off[:-1], off[1:], strict=True)])
    starts = offsets[lo:hi] - offsets[lo] + np.arange(1, hi - lo + 1)
    return np.frombuffer(buf, dtype=np.uint8), starts


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits (splitmix constants)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h = h * _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^0..P^n and P^-0..P^-n modulo 2^64."""
    if len(_powers.get("p", ())) <= n:
        for k, base in (("p", _P), ("q", _P_INV)):
            a = np.full(n + 1, base, dtype=np.uint64)
            a[0] = 1
            _powers[k] = np.cumprod(a, dtype=np.uint64)
    return _powers["p"], _powers["q"]


#: Byte ranges longer than this are hashed one by one: a polynomial modulo 2^64 has fixed collisions from 1024 bytes on.
LONG_RANGE = 256


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """What ``range_hashes`` takes differences of."""
    s = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + _U(1)) * powers(len(buf))[0][: len(buf)], out=s[1:])
    return s


def range_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each byte range [start, end), by value and length only; ``sums``: ``prefix_sums`` made before."""
    s, q = prefix_sums(buf) if sums is None else sums, powers(len(buf))[1]
    h = (s[ends] - s[starts]) * q[starts]
    h = mix64(h ^ ((ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93)))
    long = np.flatnonzero(ends - starts > LONG_RANGE)
    if len(long):
        import xxhash
        h[long] = [xxhash.xxh3_64_intdigest(buf[a:b].tobytes()) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
    return h


def word_spans(buf: np.ndarray, row_start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words ``[^\\x20\\x09-\\x0D]+`` of a joined byte array start and end, and each row's word count."""
    space = SPACE[buf]
    starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    if len(buf) and not space[-1]:
        ends = np.append(ends, len(buf))
    return starts, ends, np.diff(np.searchsorted(starts, np.append(row_start, len(buf) + 1)))


def word_hashes(offsets: np.ndarray, data: memoryview, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased) of rows lo..hi, in order, and each row's word count."""
    buf, row_start = joined(offsets, data, lo, hi, b" ")
    buf = LOWER[buf]
    starts, ends, counts = word_spans(buf, row_start)
    return range_hashes(buf, starts, ends), counts


def out_batch(schema: StructType, columns: list) -> pa.RecordBatch:
    """A record batch of ``columns`` in the types of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    want = to_arrow_schema(schema)
    arrays = []
    for f, c in zip(want, columns, strict=True):
        c = c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, from_pandas=False)
        arrays.append(c.cast(f.type) if c.type != f.type else c)
    return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in want])


def give_back() -> None:
    """At the end of a task: free memory goes back to the system (workers stay, and would keep it)."""
    import ctypes
    import gc
    _powers.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: Rows of an Arrow batch between Spark and its Python workers; both sides hold a whole batch of texts.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let this session send texts to Python in batches of at most ``BATCH_ROWS`` rows (fewer, if it is set so)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    spark.conf.set(key, str(min(now, BATCH_ROWS) if now > 0 else BATCH_ROWS))


def table_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
