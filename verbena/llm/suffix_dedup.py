"""Exact removal of repeated byte strings with sharded suffix arrays.

Which strings must meet in one shard is decided by minimizers: a window of
``length`` bytes belongs to the least hash of its ``GRAM``-byte substrings, so
equal windows have equal minimizers.  Runs of windows with one minimizer are a
segment of about 290 bytes; only segments whose minimizer occurs again can hold
a repeated window.

1. One pass lists the segments (minimizer, text, start, windows, content hash),
   a thin table in the shared folder.
2. Segments of equal minimizer and content are one row with a count; a counted
   segment is repeated as a whole.  Other minimizers with several contents go
   on, one representative a content.
3. Their bytes are dealt out by minimizer; a task builds suffix arrays of a few
   megabytes at a time by induced sorting and marks the windows whose common
   prefix with a neighbour reaches ``length``.
4. A minimizer with more than ``GROUP_SEGMENTS`` contents (a passage in very
   many documents, cut differently in each) is dealt out by whole windows
   instead, so that it spreads over all tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .common import CHUNK_BYTES, byte_rows, id_field, materialise, mix64, out_batch, pick, powers, sized, texts
from .suffix_arrays import repeated_starts

GRAM, RUN = 20, 512
GROUP_SEGMENTS = 20_000
SHARD_BYTES = 1 << 18
_U = np.uint64


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values (block prefix and suffix minima)."""
    n = len(v) - w + 1
    pad = (-len(v)) % w
    x = np.append(v, np.full(pad, np.iinfo(v.dtype).max, dtype=v.dtype)).reshape(-1, w)
    pre = np.minimum.accumulate(x, axis=1).ravel()
    suf = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suf[:n], pre[w - 1: w - 1 + n])


def segments(buf: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, first window, windows, periodic) of each run of windows with one minimizer, at most ``RUN`` windows.

    Equal windows in one segment need its minimizer twice in it: then it is ``periodic``."""
    gram = min(GRAM, length)
    p, q = powers(len(buf))
    s = np.append(_U(0), np.cumsum((buf.astype(np.uint64) + _U(1)) * p[: len(buf)], dtype=np.uint64))
    h = mix64((s[gram:] - s[:-gram]) * q[: len(s) - gram])
    m = sliding_min(h, length - gram + 1)
    first = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
    size = np.diff(np.append(first, len(m)))
    if size.max() > RUN:
        extra = (size - 1) // RUN
        first = np.repeat(first, extra + 1) + RUN * (np.arange(int((extra + 1).sum())) - np.repeat(
            np.cumsum(extra + 1) - extra - 1, extra + 1))
        size = np.diff(np.append(first, len(m)))
    span = size + length - gram
    begin = np.cumsum(span) - span
    at = np.repeat(first - begin, span) + np.arange(int(span.sum()))
    times = np.add.reduceat((h[at] == np.repeat(m[first], span)).astype(np.int32), begin)
    return m[first], first, size, times > 1


def text_key(raw: bytes) -> bytes:
    return xxhash.xxh3_128_digest(raw)


def with_text_id(base: DataFrame) -> DataFrame:
    """``(doc_id, text)`` and the hash that equal texts share."""
    schema = StructType([*base.schema.fields, StructField("text_id", BinaryType())])

    def run(batches):
        for batch in batches:
            yield out_batch(schema, [*batch.columns, pa.array([text_key(t) for t in byte_rows(batch, 1)], pa.binary())])

    return base.mapInArrow(run, schema)


def list_segments(base: DataFrame, length: int) -> DataFrame:
    """``text_id, m, start, windows, content, periodic`` for every segment of every ``(doc_id, text)``."""
    schema = StructType([StructField("text_id", BinaryType()), StructField("m", LongType()),
                         StructField("start", LongType()), StructField("windows", IntegerType()),
                         StructField("content", LongType()), StructField("periodic", IntegerType())])

    def run(batches):
        for batch in batches:
            offsets, data = texts(batch, 1)
            held, size = [], 0
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                if b - a < length:
                    continue
                raw = bytes(data[a:b])
                m, first, n, periodic = segments(np.frombuffer(raw, np.uint8), length)
                end = (first + n + length - 1).tolist()
                content = [xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip(first.tolist(), end, strict=True)]
                held.append((text_key(raw), m, first, n, np.array(content, dtype=np.uint64), periodic))
                size += len(m)
                if size > 50_000:
                    yield rows(held)
                    held, size = [], 0
            if held:
                yield rows(held)

    def rows(held):
        ids = [k for k, m, *_ in held for _ in range(len(m))]
        return out_batch(schema, [pa.array(ids, pa.binary()), *[
            np.concatenate([h[i] for h in held]).astype(np.int64) for i in (1, 2, 3, 4, 5)]])

    return base.mapInArrow(run, schema)


_SPOT = [StructField("text_id", BinaryType()), StructField("start", LongType())]


def _cut(base: DataFrame, todo: DataFrame, length: int, single: bool) -> DataFrame:
    """``key, text_id, start, part`` of the wanted segments (``text_id, start, windows, m``): whole, or window by window.

    One text of each ``text_id`` is enough, as equal texts have equal segments."""
    lists = materialise(todo.groupBy("text_id").agg(F.flatten(F.collect_list(F.array(
        "start", F.col("windows").cast("long"), "m"))).alias("todo")), "todo")
    schema = StructType([StructField("key", LongType()), *_SPOT, StructField("part", BinaryType())])
    wanted = with_text_id(base).drop("doc_id").join(sized(lists), "text_id").select("text_id", "text", "todo")

    def run(batches):
        for batch in batches:
            offsets, data = texts(batch, 1)
            out, size = [], 0
            for i, (tid, todo_) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                raw = bytes(data[offsets[i]: offsets[i + 1]])
                for start, windows, m in zip(todo_[::3], todo_[1::3], todo_[2::3], strict=True):
                    for a, w in ((start + j, 1) for j in range(windows)) if single else ((start, windows),):
                        part = raw[a: a + w + length - 1]
                        out.append((xxhash.xxh3_64_intdigest(part) - (1 << 63) if single else m, tid, a, part))
                        size += len(part)
                if size > 4 * CHUNK_BYTES:
                    yield out_batch(schema, [pa.array(c, type=k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)])
                    out, size = [], 0
            if out:
                yield out_batch(schema, [pa.array(c, type=k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)])

    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary()]
    return wanted.mapInArrow(run, schema)


def _in_shards(parts: DataFrame, length: int) -> DataFrame:
    """``text_id, first, last``: runs of repeated window starts, from suffix arrays of all parts of a few keys at a time."""
    schema = StructType([StructField("text_id", BinaryType()), StructField("first", LongType()), StructField("last", LongType())])

    def solve(rows):
        ids, first, last = [], [], []
        for (_, tid, start, part), hit in zip(rows, repeated_starts([r[3] for r in rows], length), strict=True):
            if len(hit):
                cut = np.flatnonzero(np.diff(hit) > 1)
                a, b = hit[np.append(0, cut + 1)], hit[np.append(cut, len(hit) - 1)]
                ids += [tid] * len(a)
                first.append(a + start)
                last.append(b + start)
        if ids:
            yield out_batch(schema, [pa.array(ids, pa.binary()), np.concatenate(first), np.concatenate(last)])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if size > SHARD_BYTES and row[0] != held[-1][0]:  # all parts of a key stay together
                    yield from solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield from solve(held)

    return parts.select("key", "text_id", "start", "part").repartition("key").sortWithinPartitions("key") \
        .mapInArrow(run, schema)


def repeated_windows(base: DataFrame, length: int, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """``text_id, first, last``: runs of window starts whose ``length`` bytes also start elsewhere in ``(doc_id, text)``."""
    segs = materialise(list_segments(base, length), "segments")
    again = segs.groupBy("m").agg(F.count("*").alias("c"), F.min("content").alias("lo"), F.max("content").alias("hi"), F.max("periodic").alias("periodic")) \
        .where("c > 1 or periodic = 1") \
        .select("m", ((F.col("lo") != F.col("hi")) | (F.col("periodic") == 1)).alias("mixed"))
    again = materialise(segs.drop("periodic").join(again, "m"), "again")
    counted = again.groupBy("m", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("text_id", "start", "windows")).alias("one"), F.first("mixed").alias("mixed"))
    counted = materialise(counted.select("m", "content", "n", "one.*", "mixed"), "counted")
    many = counted.where("n > 1").select("m", "content")
    whole = again.join(many, ["m", "content"], "left_semi").select(
        "text_id", F.col("start").alias("first"), (F.col("start") + F.col("windows") - 1).alias("last"))

    mixed = counted.where("mixed")
    crowded = materialise(mixed.groupBy("m").agg(F.count("*").alias("k")).where(F.col("k") > group_segments).select("m"), "crowded")
    usual = _in_shards(_cut(base, mixed.join(sized(crowded), "m", "left_anti"), length, False).dropDuplicates(["text_id", "start"]), length)
    out = whole.unionAll(usual)
    if not crowded.isEmpty():
        single = _cut(base, mixed.join(sized(crowded), "m"), length, True).dropDuplicates(["text_id", "start"])
        twice = single.groupBy("key", "part").agg(F.count("*").alias("c")).where("c > 1").select("key", "part")
        out = out.unionAll(single.join(twice, ["key", "part"]).select(
            "text_id", F.col("start").alias("first"), F.col("start").alias("last")))
    return out


def _merged(lists: DataFrame, length: int) -> DataFrame:
    """Window runs ``[first, last, ...]`` as disjoint byte spans ``[begin, end, ...]``, left to right."""
    schema = lists.schema

    def run(batches):
        for batch in batches:
            out = []
            for runs in batch.column(1).to_pylist():
                flat = []
                for a, b in sorted(zip(runs[::2], runs[1::2], strict=True)):
                    if flat and a <= flat[-1]:
                        flat[-1] = max(flat[-1], b + length)
                    else:
                        flat += a, b + length
                out.append(flat)
            yield out_batch(schema, [batch.column(0), pa.array(out, pa.list_(pa.int64()))])

    return lists.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                   with_text: bool = False, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256 [, kept_bytes]`` for every row of ``docs``.

    Every byte is removed that a ``length``-byte string covers which also
    starts anywhere else in the table (same text included, matches do not
    cross texts, all judged on the input).  Null and empty texts, and texts
    shorter than ``length``, lose nothing; equal rows lose all of their bytes
    from ``length`` on; rows with a null id are treated alike.
    """
    base = pick(docs, id_col, text_col)
    spans = repeated_windows(base, length, group_segments)
    lists = materialise(_merged(spans.groupBy("text_id").agg(
        F.flatten(F.collect_list(F.array("first", "last"))).alias("spans")), length), "spans")
    ids = id_field(base)
    schema = StructType([ids, StructField("n_bytes", LongType()), StructField("n_removed", LongType()),
                         StructField("n_spans", LongType()), StructField("kept_sha256", StringType()),
                         *([StructField("kept_bytes", BinaryType())] if with_text else [])])

    def run(batches):
        for batch in batches:
            offsets, data = texts(batch, 1)
            removed, count, sha, kept = [], [], [], []
            for i, runs in enumerate(batch.column(2).to_pylist()):
                raw = bytes(data[offsets[i]: offsets[i + 1]])
                runs = runs or []
                rest = b"".join(raw[a:b] for a, b in zip([0, *runs[1::2]], [*runs[::2], len(raw)], strict=True))
                removed.append(len(raw) - len(rest))
                count.append(len(runs) // 2)
                sha.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    kept.append(rest)
            yield out_batch(schema, [batch.column(0), np.diff(offsets), pa.array(removed, pa.int64()),
                                     pa.array(count, pa.int64()), pa.array(sha, pa.string()),
                                     *([pa.array(kept, pa.binary())] if with_text else [])])

    return with_text_id(base).join(sized(lists), "text_id", "left") \
        .select("doc_id", "text", "spans").mapInArrow(run, schema)
