"""Hard-negative mining by threshold joins over inverted indexes (after L2AP).

Rows are packed into shards.  A shard's index lists, for each dimension (in
falling order of energy), the rows with a value there, and leaves out the
dimensions of a row whose suffix norm cannot reach the threshold of any anchor
in the block.  A search adds up the listed products strip by strip, drops pairs
whose partial score plus the product of the remaining norms stays under the
anchor's threshold, and computes the exact integer score of the rest.  An
anchor's threshold starts high and is lowered until its window is full: first
for the positives (best rows of the same label), then for the negatives of each
positive (best rows of other labels in its score window).  What earlier shards
of a task have found is the first threshold in the next one.

Anchors (a stated share of the rows) are searched against all rows in blocks:
shards and anchor blocks are dealt into a grid of cells of bounded size, and
each cell sends the few best rows of each anchor; windows over anchors merge
them.  No label is gathered anywhere, so a label that a third of all rows carry
is spread like any other.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; components that a shorter vector lacks
count as zero.  Rows that repeat an id are rows of their own, each repeated
anchor gives its own result.  A positive with a negative score has an empty
window.  An empty table, or one without anchors, gives an empty result.  Scores
must fit in a long (an overflow is an error).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .clustering import is_finite, matrices, small_type, whole_components
from .common import materialise, out_batch

#: Rows of a shard, anchors of a block, and rows or anchors that a cell of the grid holds at most (about 16 MB of short integers at 64 dimensions).
SHARD, GROUP, CELL = 2048, 256, 1 << 17
STRIP = 8
_PACKED = StructType([StructField("n", IntegerType()), StructField("dims", IntegerType()),
                      *[StructField(c, BinaryType()) for c in ("row", "id", "label")],
                      StructField("type", StringType()), StructField("v", BinaryType()),
                      StructField("scores", ArrayType(ArrayType(LongType())))])
_FOUND = StructType([StructField(c, LongType()) for c in ("anchor_row", "of_score", "id", "score")])


def _pack(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``(row, id, label, v, scores)`` as blocks of ``size`` rows, each with a number of its own."""
    def run(batches):
        for table, m in matrices(batches, 3, size):
            kind = small_type(m)
            cols = [[table.column(i).to_numpy().astype("<i8").tobytes()] for i in range(3)]
            yield out_batch(_PACKED, [[len(m)], [m.shape[1]], *cols, [kind.str], [m.astype(kind).tobytes()],
                                      [table.column(4).to_pylist()]])

    packed = rows.select("row", "id", "label", "v", "scores").mapInArrow(run, _PACKED)
    return materialise(packed.withColumn("no", F.monotonically_increasing_id()), name)


class Packed:
    """A shard or a block of anchors: ids, labels, windows' scores, and the matrix padded to ``dims`` columns."""

    def __init__(self, packed: dict, dims: int):
        self.row, self.id, self.label = (np.frombuffer(packed[c], "<i8") for c in ("row", "id", "label"))
        m = np.frombuffer(packed["v"], packed["type"]).reshape(packed["n"], packed["dims"])
        self.v = np.zeros((len(m), dims), dtype=np.int64)
        self.v[:, : m.shape[1]] = m
        self.scores = packed["scores"]


def suffix_norms(v: np.ndarray) -> np.ndarray:
    """Norm of the columns from j on, for each row and j (a trifle too large rather than too small)."""
    s = np.zeros((v.shape[0], v.shape[1] + 1))
    s[:, :-1] = np.cumsum((v.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(s) * (1 + 1e-9)


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """Doubles where every sum of products is an exact integer in them, else Python's integers."""
    far = max(a.shape[1], 1)
    for x in (a, b):
        far *= max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    return np.float64 if far < 1 << 53 else object


class Index:
    """Inverted index of one shard over its dimensions in falling order of energy."""

    def __init__(self, shard: Packed):
        self.order = np.argsort(-(shard.v.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.shard, self.v = shard, shard.v[:, self.order]
        self.rest = suffix_norms(self.v)
        self.longest = float(self.rest[:, 0].max(initial=0.0))

    def search(self, x: np.ndarray, rest: np.ndarray, least: np.ndarray, wanted: np.ndarray):
        """Every ``wanted`` pair (anchor, row) whose score is at least the anchor's ``least``, with its score.

        ``x``: the anchors in this index's order of dimensions; ``rest``: their suffix norms.
        """
        dims, kind = self.v.shape[1], exact_type(x, self.v)
        # L2AP: the suffix of a row that no anchor of the block can turn into its threshold is not listed
        listed = (self.rest[:, :dims] >= np.min(least / np.maximum(rest[:, 0], 1e-300))).sum(axis=1)
        by_length = np.argsort(-listed, kind="stable")  # so the rows listed under a dimension come first
        length, v, norms = listed[by_length], self.v[by_length], self.rest[by_length]
        alive = wanted[:, by_length] & (rest[:, :1] * norms[:, 0] >= least[:, None])
        if kind is np.float64:
            partial = np.zeros(alive.shape)
            for at in range(0, int(length.max(initial=0)), STRIP):
                n = int(np.searchsorted(-length, -at, side="left"))
                here = slice(at, min(at + STRIP, dims))
                postings = np.where(np.arange(here.start, here.stop) < length[:n, None], v[:n, here], 0)
                partial[:, :n] += x[:, here].astype(np.float64) @ postings.T.astype(np.float64)
                seen = np.minimum(length[:n], here.stop)
                alive[:, :n] &= partial[:, :n] + rest[:, seen] * norms[np.arange(n), seen] >= least[:, None]
        a, b = np.nonzero(alive)
        whole = np.int64 if kind is np.float64 else object
        score = np.empty(len(a), dtype=np.int64)
        for lo in range(0, len(a), 1 << 16):
            p = slice(lo, lo + (1 << 16))
            score[p] = (x[a[p]].astype(whole) * v[b[p]].astype(whole)).sum(axis=1)
        good = score >= least[a]
        return a[good], by_length[b[good]], score[good]


class Windows:
    """Up to ``slots`` score windows for each anchor of a block, and the best ``n`` rows found in each so far."""

    def __init__(self, low: np.ndarray, high: np.ndarray, n: int):
        self.low, self.high, self.n = low, high, n  # anchors x slots; an empty window has low > high
        self.open = low <= high
        self.key, self.id, self.score = (np.empty(0, dtype=np.int64) for _ in range(3))
        self.kth = np.full(low.size, -np.inf)

    def within(self, anchor: np.ndarray, ident: np.ndarray, score: np.ndarray):
        """The pairs of each window, by the window's key."""
        slots = self.low.shape[1]
        for j in range(slots):
            fits = self.open[anchor, j] & (score >= self.low[anchor, j]) & (score <= self.high[anchor, j])
            yield anchor[fits] * slots + j, ident[fits], score[fits]

    def full(self, anchor: np.ndarray, score: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Anchors whose every window has ``n`` rows at or above ``least``, the held ones included."""
        slots = self.low.shape[1]
        count = np.zeros(self.low.size, dtype=np.int64)
        for key, _, _ in self.within(anchor, anchor, score):
            count += np.bincount(key, minlength=len(count))
        held = self.score >= least[self.key // slots]
        count += np.bincount(self.key[held], minlength=len(count))
        return ((count.reshape(self.low.shape) >= self.n) | ~self.open).all(axis=1)

    def take(self, anchor: np.ndarray, ident: np.ndarray, score: np.ndarray) -> None:
        parts = [(self.key, self.id, self.score), *self.within(anchor, ident, score)]
        key, ident, score = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((ident, -score, key))
        key, ident, score = key[order], ident[order], score[order]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        best = rank < self.n
        self.key, self.id, self.score = key[best], ident[best], score[best]
        last = rank[best] == self.n - 1
        self.kth[self.key[last]] = self.score[last]

    def carried(self) -> np.ndarray:
        """For each anchor the score that fills its windows already, else minus infinity."""
        return np.where(self.open, self.kth.reshape(self.low.shape), np.inf).min(axis=1)


def search_shard(index: Index, anchors: Packed, windows: Windows, same_label: bool) -> None:
    """Add a shard's rows to the windows: thresholds fall until every window is full or searched to its end."""
    x = anchors.v[:, index.order]
    rest = suffix_norms(x)
    shard = index.shard
    wanted = (anchors.label[:, None] == shard.label) == same_label
    if same_label:
        wanted &= anchors.row[:, None] != shard.row
    has = windows.open.any(axis=1)
    floor = np.where(windows.open, windows.low, np.inf).min(axis=1).astype(np.float64)
    top = np.where(windows.open, windows.high, np.inf).min(axis=1).astype(np.float64)
    floor = np.nextafter(floor, -np.inf)
    carried = np.nextafter(windows.carried(), -np.inf)
    start = np.minimum(0.5 * rest[:, 0] * index.longest, top)
    least = np.maximum(np.where(np.isfinite(carried), carried, start), floor)
    left = np.flatnonzero(has)
    for step in range(6):
        if not len(left):
            break
        if step == 5:
            least[left] = floor[left]
        a, b, score = index.search(x[left], rest[left], least[left], wanted[left])
        a = left[a]
        done = windows.full(a, score, least) | (least <= floor)
        mine = done[a]
        windows.take(a[mine], shard.id[b[mine]], score[mine])
        left = left[~done[left]]
        least[left] = floor[left] + (least[left] - floor[left]) / 2


def _search(shards: DataFrame, groups: DataFrame, same_label: bool, best: int, low: int, high: int) -> DataFrame:
    """``(anchor_row, of_score, id, score)``: of every cell, the best rows of each window."""
    spark = shards.sparkSession
    n_shards, n_groups = shards.count(), groups.count()
    buckets = max(1, min(n_shards, max(-(-n_shards * SHARD // CELL), int(spark.conf.get("spark.sql.shuffle.partitions")))))
    batches = max(1, -(-n_groups * GROUP // CELL))

    def cells(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.select("*", F.pmod(F.xxhash64("no"), F.lit(n)).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other)).groupBy("bucket", "batch")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        shard_rows, group_rows = left.to_pylist(), right.to_pylist()
        found = []
        if shard_rows and group_rows:
            dims = max(r["dims"] for r in shard_rows + group_rows)
            anchors = [Packed(r, dims) for r in group_rows]
            windows = []
            for g in anchors:
                if same_label:
                    lo, hi = np.zeros((len(g.row), 1), dtype=np.int64), np.full((len(g.row), 1), np.iinfo(np.int64).max)
                else:
                    slots = max([1, *map(len, g.scores)])
                    lo, hi = (np.full((len(g.row), slots), v, dtype=np.int64) for v in (1, 0))
                    for i, scores in enumerate(g.scores):
                        for j, s in enumerate(scores):
                            lo[i, j], hi[i, j] = -(-low * s // 100), high * s // 100
                windows.append(Windows(lo, hi, best))
            for r in shard_rows:
                index = Index(Packed(r, dims))
                for g, w in zip(anchors, windows, strict=True):
                    search_shard(index, g, w, same_label)
            for g, w in zip(anchors, windows, strict=True):
                slots = w.low.shape[1]
                of = [0 if same_label else g.scores[k // slots][k % slots] for k in w.key.tolist()]
                found.append(out_batch(_FOUND, [g.row[w.key // slots], of, w.id, w.score]))
        return pa.Table.from_batches(found or [out_batch(_FOUND, [[], [], [], []])])

    return cells(shards, "bucket", buckets, "batch", batches).cogroup(
        cells(groups, "batch", batches, "bucket", buckets)).applyInArrow(run, _FOUND)


def _best(found: DataFrame, by: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group, with their rank (cells send a few each, cut before the shuffle as well)."""
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", scale: int = 256, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on ``id`` and ``label``.  Scores are inner
    products of ``floor(scale * x)``; for each anchor and each of its first
    ``positives`` rows of the same label, the first ``negatives`` rows of
    another label with ``low`` to ``high`` percent of the positive's score.
    """
    if not 0 < low <= high:
        raise ValueError("low and high are percentages with 0 < low <= high")
    raw = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[label_col].cast("long").alias("label"),
                         vectors[vector_col].alias("v"))
    kept = raw.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & is_finite(F.col("v")))
    no_scores = F.array().cast("array<long>").alias("scores")
    rows = materialise(kept.select(F.monotonically_increasing_id().alias("row"), "id", "label",
                                   whole_components(F.col("v"), scale).alias("v"), no_scores), "rows")
    shards = _pack(rows, SHARD, "shards")
    anchors = rows.where(is_anchor)
    near = _best(_search(shards, _pack(anchors, GROUP, "anchors"), True, positives, low, high), ["anchor_row"], positives)
    pairs = materialise(near.select("anchor_row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    windows = pairs.groupBy("anchor_row").agg(F.collect_set("positive_score").alias("scores"))  # at most `positives` values
    asked = anchors.drop("scores").join(windows, F.col("row") == F.col("anchor_row")).drop("anchor_row")
    far = _best(_search(shards, _pack(asked, GROUP, "windows"), False, negatives, low, high), ["anchor_row", "of_score"], negatives)
    p, n, a = pairs.alias("p"), far.alias("n"), anchors.select("row", F.col("id").alias("anchor_id")).alias("a")
    return p.join(n, (F.col("p.anchor_row") == F.col("n.anchor_row")) & (F.col("p.positive_score") == F.col("n.of_score"))) \
        .join(a, F.col("p.anchor_row") == F.col("a.row")) \
        .select("a.anchor_id", "p.positive_id", F.col("n.rank").cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
                "p.positive_score", F.col("n.score").alias("negative_score"))
