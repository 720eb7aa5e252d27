"""Best-fit packing planned over a histogram of lengths.

1. One pass turns texts into pieces (document, start, length, checksum), a
   thin table in the shared folder.
2. The counts per length (at most ``capacity`` numbers) go to the driver,
   where best fit runs over counts, longest first: all pieces of one length
   that fill bins of one remaining space are placed in one step.
3. Pieces take the planned slots by their rank within their length.  A length
   with many pieces is ranked in salted parts whose sizes are added up, so one
   hot length is never one task.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import chunk_rows, give_back, id_field, materialise, out_batch, pick, texts
from .pretokens import CHUNK, chunk_words, remembered, rest

#: Pieces that one ranking task group holds at most (fewer on small inputs).
RANK_ROWS = 100_000


@dataclass
class Plan:
    """Slots by (length, first rank): ``fill`` pieces a sequence, from ``sequence`` on, at ``offset`` in it."""

    length: np.ndarray
    rank: np.ndarray
    fill: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def best_fit_plan(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit, longest first, over ``counts`` (pieces per length, each 1..capacity).

    A piece goes to the fullest sequence that has room, or else opens one.
    Runs of sequences with the same remaining space are handled at once; the
    steps depend on the number of lengths, not on the number of pieces.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # remaining space -> runs (first sequence, how many)
    spaces: list[int] = []  # sorted keys of room
    rows: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def put(space: int, first: int, n: int) -> None:
        if n and space:
            if space not in room:
                bisect.insort(spaces, space)
            room[space].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, n = room[space].pop()
                if not room[space]:
                    del room[space]
                    spaces.pop(at)
            else:
                space = capacity
                first, n = opened, -(-left // (capacity // length))
                opened += n
            fill = min(space // length, left)
            used = min(n, left // fill)
            rows.append((length, rank, fill, first, capacity - space))
            put(space - fill * length, first, used)
            if n > used:  # the rest of the run stays as it was (a new run is never longer than it is needed)
                put(space, first + used, n - used)
            rank += used * fill
            left -= used * fill
    cols = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T
    return Plan(*cols, sequences=opened)


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int, separator: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` from ``(doc_id, text)``: ids, then ``separator``, cut at ``capacity``.

    A worker tokenizes each pre-token that it meets once.
    """
    schema = StructType([id_field(docs), StructField("piece", IntegerType()), StructField("start", LongType()),
                         StructField("length", LongType()), StructField("ids_crc32", LongType())])
    step = 4 * capacity

    def run(batches):
        pieces = remembered(tokenizer_path)
        for batch in batches:
            offsets, data = texts(batch, 1)
            row, piece, size, crc = [], [], [], []
            for lo, hi in chunk_rows(offsets, CHUNK):
                buf, starts, ends, h, counts = chunk_words(offsets, data, lo, hi, pieces.fold)
                at = pieces.numbers(buf, starts, ends, h)
                length, first, flat = pieces.length[at], pieces.first[at], pieces.ids
                # one separator behind the words of each row
                end = np.cumsum(counts)
                length = np.insert(length, end, 1)
                first = np.insert(first, end, len(flat))
                flat = np.append(flat, np.array([separator], dtype="<u4"))
                stop = np.cumsum(length)
                out = flat[np.repeat(first - (stop - length), length) + np.arange(stop[-1] if len(stop) else 0)]
                raw = out.astype("<u4").tobytes()
                row_end = 4 * stop[end + np.arange(len(end))]
                for i, (a, b) in enumerate(zip(np.append(0, row_end[:-1]).tolist(), row_end.tolist(), strict=True), lo):
                    for k, c in enumerate(range(a, b, step)):
                        part = raw[c: min(c + step, b)]
                        row.append(i)
                        piece.append(k)
                        size.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            piece = np.array(piece, dtype=np.int64)
            yield out_batch(schema, [batch.column(0).take(pa.array(row, pa.int64())), piece, piece * capacity,
                                     pa.array(size, pa.int64()), pa.array(crc, pa.int64())])
        pieces = None
        rest()
        give_back()

    return docs.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 2048, separator: int = 0) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its ids and ``separator``; only documents longer than
    ``capacity`` are cut, into pieces of ``capacity`` (the last may be
    shorter).  Sequences hold at most ``capacity`` ids, gapless from offset 0.
    A null or empty text is one piece of length 1.  Rows that repeat an id are
    documents of their own.  An empty table gives no rows.  The driver holds at
    most ``capacity`` counts, the plan, and one count per ranking group.
    """
    spark = docs.sparkSession
    pieces = materialise(pieces_of(pick(docs, id_col, text_col), tokenizer_path, capacity, separator)
                         .withColumn("__vl_no", F.monotonically_increasing_id()), "pieces")
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = best_fit_plan(counts, capacity)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = max(1, min(RANK_ROWS, sum(counts.values()) // (4 * tasks)))
    lens = StructType([StructField("length", LongType()), StructField("__vl_parts", LongType())])
    parts = spark.createDataFrame([(k, -(-n // target)) for k, n in counts.items()], lens)  # at most capacity rows
    salted = pieces.join(F.broadcast(parts), "length").withColumn(
        "__vl_salt", F.pmod(F.xxhash64("__vl_no"), F.col("__vl_parts"))).drop("__vl_parts")
    sizes = np.array(sorted((int(r["length"]), int(r["__vl_salt"]), int(r["n"])) for r in salted.groupBy(
        "length", "__vl_salt").agg(F.count("*").alias("n")).collect()), dtype=np.int64).reshape(-1, 3)
    before = np.cumsum(sizes[:, 2]) - sizes[:, 2]
    first = {int(k): int(b) for k, b in reversed(list(zip(sizes[:, 0], before, strict=True)))}
    before -= np.array([first[int(k)] for k in sizes[:, 0]], dtype=np.int64)
    group_key = (sizes[:, 0] << 40) + sizes[:, 1]
    slot_key = (plan.length << 48) + plan.rank
    w = Window.partitionBy("length", "__vl_salt").orderBy("__vl_no")
    ranked = salted.withColumn("__vl_rank", F.row_number().over(w).cast("long") - 1)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = StructType([pieces.schema[n] for n in names] + [StructField("sequence_id", LongType()),
                                                            StructField("offset", LongType())])

    def place(batches):
        for batch in batches:
            length = batch.column(3).to_numpy()
            key = (length << 40) + batch.column(5).to_numpy()
            rank = before[np.searchsorted(group_key, key)] + batch.column(6).to_numpy()
            at = np.searchsorted(slot_key, (length << 48) + rank, side="right") - 1
            nth, fill = rank - plan.rank[at], plan.fill[at]
            yield out_batch(schema, [*batch.columns[:5], plan.sequence[at] + nth // fill,
                                     plan.offset[at] + nth % fill * length])
        give_back()

    return ranked.select(*names, "__vl_salt", "__vl_rank").mapInArrow(place, schema)
