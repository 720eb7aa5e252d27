"""Ordered indexes without a single-task window (W1, A1, O1, and exact ranks for W2).

``row_index`` gives a stable 0-based position in a total order:

1. range-partition on the order key into a fixed number of partitions and sort
   within each partition (one range exchange, sampled bounds; rows with equal
   keys stay together, so the order should be unique);
2. count rows per partition (and per group, if ranking within a few groups);
3. prefix-sum those counts (a table of at most partitions x groups rows, the
   only thing broadcast) and add each row's position inside its partition.

The position inside a partition comes from ``monotonically_increasing_id``,
which is consecutive within a partition.  The explicit partition count keeps
AQE from coalescing the range exchange.  The numbered rows (with their
partition number and position stored as columns) are written as a table in
the shared checkpoint folder before they are counted, so the counting pass
and the numbering pass read identical numbers; ``materialize=False`` skips
that only for inputs whose range exchange is known to be reused.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_PID, _MID, _LOC = "__vb_pid", "__vb_mid", "__vb_loc"


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    """Range partitions: as asked for, or ``spark.sql.shuffle.partitions``, which the
    cluster sizes to its data (AQE does not resize an exchange with an explicit count)."""
    return int(num_partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _as_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def row_index(df: DataFrame, order_by: Sequence, name: str = "row_idx",
              group_by: Sequence[str] = (), num_partitions: int | None = None,
              materialize: bool = True, group_size: str | None = None,
              prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add ``name``: 0-based position of each row in ``order_by`` order.

    With ``group_by`` the position restarts in every group (rank within a
    group).  Use ``group_by`` only for a small, known set of groups (the
    broadcast table has partitions x groups rows); many groups should use a
    window partitioned by the group instead.  ``group_size`` adds each
    group's row count, taken from the same small table.  ``order_by`` must be a total
    order (unique), otherwise ties take an arbitrary but consistent order.
    ``prepare`` is a projection of the rows that keeps the order and group
    columns as they are: it is done after the range exchange, whose sampling
    would do it a second time for every row.
    """
    group_by = list(group_by)
    keys = _as_cols(group_by) + _as_cols(order_by)
    n = _partitions(df, num_partitions)
    base = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    base = prepare(base) if prepare else base
    base = (base.withColumn(_PID, F.spark_partition_id())
            .withColumn(_MID, F.monotonically_increasing_id()))
    base = base.withColumn(_LOC, F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33))
    if materialize:
        # Both passes must see the very same partition of every row.  Range
        # bounds are sampled each time an exchange runs, and the counting pass
        # reads fewer columns (so it is a different exchange): the sorted,
        # numbered rows are written once to the shared checkpoint folder
        # (a lost executor does not lose them) and read twice.
        # A parquet table (not an RDD checkpoint) so that the counting pass
        # reads only the two small columns it needs.
        from ..session import shared_dir
        path = shared_dir(df.sparkSession, "row-index")
        base.write.mode("overwrite").parquet(path)
        base = df.sparkSession.read.parquet(path)
    counts = base.groupBy(_PID, *group_by).agg(
        F.count(F.lit(1)).alias("__vb_n"), F.min(_LOC).alias("__vb_first"))
    w = Window.partitionBy(*group_by).orderBy(_PID) if group_by else Window.orderBy(_PID)
    extra = []
    if group_size:
        whole = Window.partitionBy(*group_by) if group_by else Window.partitionBy()
        extra = [F.sum("__vb_n").over(whole).alias(group_size)]
    offsets = counts.select(
        _PID, *group_by, "__vb_first",
        (F.sum("__vb_n").over(w) - F.col("__vb_n")).alias("__vb_off"), *extra)
    # The offsets table has one row per (partition, group): its size is bounded
    # by the partition count times the (few) groups, never by the data, so it
    # is broadcast and the numbered rows are not shuffled again.
    if group_by:
        # null-safe: a null group is a group too
        ren = {g: f"__vb_g{i}" for i, g in enumerate(group_by)}
        offs = offsets.select(F.col(_PID).alias("__vb_opid"), "__vb_first", "__vb_off",
                              *([group_size] if group_size else []),
                              *[F.col(g).alias(r) for g, r in ren.items()])
        cond = [F.col(_PID) == F.col("__vb_opid")] + [
            F.col(g).eqNullSafe(F.col(r)) for g, r in ren.items()]
        out = base.join(F.broadcast(offs), cond).drop("__vb_opid", *ren.values())
    else:
        out = base.join(F.broadcast(offsets), _PID)
    idx = F.col("__vb_off") + F.col(_LOC) - F.col("__vb_first")
    return out.withColumn(name, idx).drop(_PID, _MID, _LOC, "__vb_first", "__vb_off")


def batch_rows(df: DataFrame, order_by: Sequence, size: int = 5,
               columns: Sequence[str] = ("id", "comment"), index_col: str = "row_idx",
               num_partitions: int | None = None,
               prepare: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """A1: consecutive rows in groups of ``size``; the last group may be short.

    Returns ``(rows, batches)``: ``rows`` is the input with ``row_idx``,
    ``batch_id`` and ``pos`` (0-based place in its batch); ``batches`` has one
    row per batch with ``items = array<struct<pos, ...columns>>`` sorted by
    ``pos``.  Every group holds at most ``size`` rows.  ``prepare``: as for ``row_index``.
    """
    rows = row_index(df, order_by, index_col, num_partitions=num_partitions, prepare=prepare)
    rows = (rows.withColumn("batch_id", F.floor(F.col(index_col) / F.lit(size)).cast("long"))
            .withColumn("pos", (F.col(index_col) % F.lit(size)).cast("int")))
    item = F.struct(F.col("pos"), *[F.col(c) for c in columns])
    batches = rows.groupBy("batch_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return rows, batches


def shuffle_rows(df: DataFrame, key: str = "id", seed: int = 42) -> DataFrame:
    """O1: a repeatable random order: by ``md5('seed:key')``, then key."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.col(key))
