"""Centroid clustering over subvector dictionaries, in exact integers.

Vectors are cut into blocks of ``BLOCK`` dimensions.  Shards of ``SHARD``
vectors are written once in the shared folder: for each block the distinct
subvectors of the shard and, for every vector, the code of its subvector, so
nothing is lost and repeated vectors or parts cost one entry.  A round reads
the shards: it computes the distances of the distinct subvectors to the
centroids' parts once, adds them up by code, and sends one row of sums for each
shard and cluster.  Only the centroids (``k`` times the dimensions) pass through
the driver.

Defined results: vectors that are null, of another length, or with a null or
non-finite component are left out; a null id is kept as it is but never starts
a centroid unless too few others are there; of equal ids the smaller vector
starts first.  With fewer than ``k`` vectors each starts a centroid; an empty
table gives an empty result.  Distances must fit in a long (an overflow is an
error, not a wrong number); components beyond the range of a long are cut to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DecimalType, IntegerType, LongType, StringType, StructField,
                               StructType)

from .common import id_field, materialise, out_batch

BLOCK, SHARD = 4, 8192


def whole_components(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def is_finite(vector: Column) -> Column:
    """No component is null, NaN or infinite."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))


def small_type(values: np.ndarray) -> np.dtype:
    """The smallest integer type that holds ``values``."""
    lo, hi = (int(values.min()), int(values.max())) if values.size else (0, 0)
    return next(np.dtype(t) for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= lo and hi <= np.iinfo(t).max)


def matrices(batches: Iterator[pa.RecordBatch], column: int, rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """``rows`` rows at a time: the rows, and their array column as a matrix (shorter arrays end in zeros)."""
    held: list[pa.RecordBatch] = []

    def given(table: pa.Table):
        lists = table.column(column).combine_chunks()
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        out = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=np.int64)
        out[np.arange(out.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        return table, out

    def cut(least: int):
        table = pa.Table.from_batches(held)
        held.clear()
        while table.num_rows >= least and table.num_rows:
            yield given(table.slice(0, rows))
            table = table.slice(rows)
        held.extend(table.to_batches())

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield from cut(rows)
    if held:
        yield from cut(1)


def distinct_rows(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a matrix, and for each row its number among them."""
    if block.shape[1] * 2 == 8 and small_type(block).itemsize == 2:
        key, code = np.unique(np.ascontiguousarray(block.astype("<i2")).view("<i8").ravel(), return_inverse=True)
        return key.view("<i2").reshape(-1, block.shape[1]).astype(np.int64), code
    values, code = np.unique(block, axis=0, return_inverse=True)
    return values, code.ravel()


def encode(vectors: DataFrame, dims: int, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """Shards of ``(vec_id, v)``: ids, and for each block of dimensions its distinct subvectors and the vectors' codes."""
    parts = StructType([StructField("values", BinaryType()), StructField("type", StringType()), StructField("codes", BinaryType())])
    schema = StructType([StructField("ids", ArrayType(vectors.schema["vec_id"].dataType)),
                         StructField("blocks", ArrayType(parts))])

    def run(batches):
        for table, m in matrices(batches, 1, shard):
            blocks = []
            for at in range(0, dims, block):
                values, code = distinct_rows(m[:, at: at + block])
                kind = small_type(values)
                blocks.append({"values": values.astype(kind).tobytes(), "type": kind.str, "codes": code.astype("<i4").tobytes()})
            ids = table.column(0).combine_chunks()
            yield out_batch(schema, [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), [blocks]])

    return materialise(vectors.select("vec_id", "v").mapInArrow(run, schema), "subvectors")


def decoded(blocks: list[dict], dims: int, block: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    for i, b in enumerate(blocks):
        at = slice(i * block, min((i + 1) * block, dims))
        yield at, np.frombuffer(b["values"], b["type"]).reshape(-1, at.stop - at.start), np.frombuffer(b["codes"], "<i4")


def nearest(blocks: list[dict], centroids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each vector of a shard the nearest centroid (smallest number of equals) and the squared distance."""
    k, dims = centroids.shape
    total = 0
    for at, values, codes in decoded(blocks, dims, block):
        c = centroids[:, at]
        far = max([0, *(abs(int(x)) for a in (values, c) if a.size for x in (a.min(), a.max()))])
        kind = np.int64 if 4 * far * far * dims < 1 << 62 else object  # wide components: Python's integers
        part = ((values.astype(kind)[:, None, :] - c.astype(kind)[None]) ** 2).sum(axis=2)
        total = total + part[codes]
    cluster = np.argmin(total, axis=1)
    return cluster, total[np.arange(len(cluster)), cluster]


def sums(blocks: list[dict], cluster: np.ndarray, k: int, dims: int, block: int) -> list[list[int]]:
    """The vectors of each cluster summed: each distinct subvector times its number of vectors there."""
    out = [[0] * dims for _ in range(k)]
    for at, values, codes in decoded(blocks, dims, block):
        n = np.bincount(codes.astype(np.int64) * k + cluster, minlength=len(values) * k).reshape(-1, k)
        far = int(np.abs(values.astype(object)).max()) if values.dtype.itemsize == 8 else 1 << 31
        kind = np.int64 if far * len(codes) < 1 << 62 else object
        s = n.astype(kind).T @ values.astype(kind)
        for c in range(k):
            out[c][at] = [int(x) for x in s[c]]
    return out


def _round(shards: DataFrame, centroids: np.ndarray, block: int) -> np.ndarray:
    """The centroids moved once; exact sums, floored means, empty clusters stay."""
    from decimal import Decimal
    k, dims = centroids.shape
    schema = StructType([StructField("cluster", IntegerType()), StructField("n", LongType()),
                         StructField("s", ArrayType(DecimalType(25, 0)))])

    def run(batches):
        for batch in batches:
            for blocks in batch.column(0):
                blocks = blocks.as_py()
                cluster, _ = nearest(blocks, centroids, block)
                s = sums(blocks, cluster, k, dims, block)
                yield out_batch(schema, [np.arange(k), np.bincount(cluster, minlength=k), [[Decimal(x) for x in r] for r in s]])

    got = shards.select("blocks").mapInArrow(run, schema).groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(dims)]).alias("s")).collect()
    out = centroids.copy()
    for r in got:
        if r.n:
            out[r.cluster] = [int(x) // r.n for x in r.s]
    return out


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024,
                    id_col: str = "vec_id", vector_col: str = "embedding", start_order: Column | None = None,
                    block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``, one row for each kept vector.

    ``start_order`` (of ``vec_id``) orders the vectors of which the first ``k``
    are the first centroids; by default the SHA-256 of the id's text.
    """
    v = vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].alias("v"))
    kept = v.where(F.col("v").isNotNull() & (F.size("v") == dims) & is_finite(F.col("v"))) \
        .select("vec_id", whole_components(F.col("v"), scale).alias("v"))
    order = F.sha2(F.col("vec_id").cast("string").cast("binary"), 256) if start_order is None else start_order
    first = kept.select(order.alias("o"), "v").orderBy(F.col("o").asc_nulls_last(), "v").limit(k).collect()
    schema = StructType([id_field(vectors.select(vectors[id_col].alias("vec_id")), "vec_id"),
                         StructField("cluster", IntegerType()), StructField("distance", LongType())])
    if not first:
        none = StructType([*schema, StructField("cluster_inertia", LongType()), StructField("inertia", LongType()),
                           StructField("centroid_sha256", StringType())])
        return vectors.sparkSession.createDataFrame([], none)
    centroids = np.array([r.v for r in first], dtype=np.int64)
    shards = encode(kept, dims, block, shard)
    for _ in range(rounds):
        centroids = _round(shards, centroids, block)

    def run(batches):
        for batch in batches:
            for ids, blocks in zip(batch.column(0), batch.column(1), strict=True):
                cluster, far = nearest(blocks.as_py(), centroids, block)
                yield out_batch(schema, [ids.values, cluster, far.tolist() if far.dtype == object else far])

    placed = materialise(shards.mapInArrow(run, schema), "placed")
    inertia = {r.cluster: r.d for r in placed.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    of_cluster = placed.sparkSession.createDataFrame(
        [(c, d, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
         for c, d in inertia.items()], "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(of_cluster), F.col("cluster") == F.col("c")).drop("c")  # at most k rows
